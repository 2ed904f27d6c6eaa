"""Removal of byte strings that repeat anywhere in the corpus, by suffix arrays.

A string of ``length`` bytes that starts in two places is removed in both.
Every such window holds ``length // 2`` bytes (its anchor) with the smallest
hash among all its runs of that length, so equal windows have equal anchors
in equal places. The work goes:

1. Texts are scanned where they lie; each anchor stands for the run of
   windows that share it (about one anchor per quarter of ``length``).
   Anchors whose whole run of windows repeats within a task are settled there
   and only one of them moves on, so a passage that a third of all documents
   hold costs one row per task.
2. Anchors meet by hash. Where a whole run repeats, it is settled. Anchors
   that are shared by runs that differ are candidates: their surroundings
   are fetched from the documents.
3. Candidates that share an anchor and half of the bytes still open, on the
   left or on the right, meet in a block; a block's suffix array puts equal
   windows side by side, where they are compared in full. Groups that are too
   large for a block are split by half of the bytes open then, and so on; at
   the last step all that is left in a group is equal.

Memory in a task is bounded by one Arrow batch, ``_FLUSH`` anchors and
``BLOCK`` symbols. Texts are shuffled once, for the last join; the fetch of
step 2 broadcasts the list of candidates only if it has at most
``BROADCAST_ROWS`` documents, and is a plain join beyond.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_batches, scratch, utf8
from strata.llm.suffix_array import suffix_array

LENGTH = 200
BLOCK = 60_000
GROUP_ROWS = 256
BROADCAST_ROWS = 200_000
_FLUSH = 300_000
_CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15  # any odd number
_ONCE, _MANY, _SETTLED = 0, 1, 2


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _hashes(data: bytes, k: int) -> np.ndarray:
    """A mixed polynomial hash modulo 2^64 of every run of ``k`` bytes."""
    n = len(data)
    size = _CHUNK + k
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)) * _powers(pow(_BASE, -1, 1 << 64), size)[:n], out=sums[1:])
    h = (sums[k:] - sums[: n - k + 1]) * _powers(_BASE, size)[: n - k + 1]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    out, have = values, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(data: bytes, length: int = LENGTH) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Arrays of anchors: position, first and last window start, and hash of the anchor.

    Windows are taken in chunks, so memory doesn't grow with the text. The
    anchor of a window is the leftmost of its runs whose hash is smallest in
    its upper half.
    """
    k = length // 2
    low = np.uint64(0xFFFFFFFF)
    for start in range(0, max(0, len(data) - length + 1), _CHUNK - length):
        part = data[start : start + _CHUNK]
        if len(part) < length:
            break
        h = _hashes(part, k)
        key = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        at = (_sliding_min(key, length - k + 1) & low).astype(np.int64)
        if start + _CHUNK < len(data):
            at = at[: _CHUNK - length]
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        last = np.concatenate((first[1:], [len(at)])) - 1
        p = at[first]
        yield p + start, first + start, last + start, h[p]


def _scan(docs: DataFrame, length: int) -> DataFrame:
    """Rows ``(id, th, p, a, b, kh, sh, state)``: an anchor at ``p`` for the windows from ``p - a`` to ``p - b``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[pa.Array] = []
        parts: list[tuple[np.ndarray, ...]] = []
        held = 0

        def flush() -> pa.RecordBatch:
            # Anchors with equal runs of windows meet here first.
            row, th, p, a, b, kh, sh = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((sh, kh))
            same = np.zeros(len(order) + 1, bool)
            same[1:-1] = (kh[order][1:] == kh[order][:-1]) & (sh[order][1:] == sh[order][:-1])
            state = np.empty(len(order), np.int8)
            state[order] = np.where(same[:-1], _SETTLED, np.where(same[1:], _MANY, _ONCE))
            # The first of equal ones goes on and is settled beside; the others need no more company.
            extra = np.flatnonzero(state == _MANY)
            pick = np.concatenate((np.arange(len(order)), extra))
            state = np.concatenate((state, np.full(len(extra), _SETTLED, np.int8)))
            spread = np.where(state == _SETTLED, (th[pick] ^ (p[pick] * np.int64(0x9E3779B1))).view(np.uint64), kh[pick])
            whole = pa.concat_arrays(ids)
            return pa.RecordBatch.from_arrays(
                [whole.take(pa.array(row[pick])), *map(pa.array, (th[pick], p[pick], a[pick], b[pick], spread.view(np.int64), np.where(state == _SETTLED, 0, sh[pick]), state))],
                ["id", "th", "p", "a", "b", "kh", "sh", "state"],
            )

        base = 0
        for batch in batches:
            ids.append(batch["id"])
            for k, (th, data) in enumerate(zip(batch["th"].to_pylist(), batch["text"].to_pylist())):
                for p, lo, hi, kh in anchors(data, length):
                    a, b = p - lo, p - hi
                    # The run's bytes, and where the anchor lies in them, as one hash.
                    geometry = (a * 4096 + b).tolist()
                    digest = xxhash.xxh3_64_intdigest
                    sh = np.fromiter((digest(data[x : y + length], g) for x, y, g in zip(lo.tolist(), hi.tolist(), geometry)), np.uint64, len(p)).view(np.int64)
                    parts.append((np.full(len(p), base + k), np.full(len(p), th, np.int64), p.astype(np.int32), a.astype(np.int32), b.astype(np.int32), kh, sh))
                    held += len(p)
                    if held >= _FLUSH:
                        yield flush()
                        parts, held = [], 0
            base += batch.num_rows
            if not parts:
                ids, base = [], 0
        if parts:
            yield flush()

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, th bigint, p int, a int, b int, kh bigint, sh bigint, state tinyint")


def _meet(rows: DataFrame) -> DataFrame:
    """The scanned anchors brought together: ``done`` where the whole run repeats, ``open`` where the anchor has other runs too."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        before = (None, None)

        def emit(rows: pa.Table, kh: np.ndarray, sh: np.ndarray, state: np.ndarray, after) -> pa.RecordBatch | None:
            n = len(kh)
            same_key = np.zeros(n + 1, bool)
            same_run = np.zeros(n + 1, bool)
            same_key[1:-1] = kh[1:] == kh[:-1]
            same_run[1:-1] = same_key[1:-1] & (sh[1:] == sh[:-1])
            for at, (other_kh, other_sh), k in ((0, before, 0), (n, after, n - 1)):
                same_key[at] = other_kh is not None and other_kh == kh[k]
                same_run[at] = same_key[at] and other_sh == sh[k]
            done = (state != _ONCE) | same_run[:-1] | same_run[1:]
            differs = (same_key & ~same_run)
            candidate = (state != _SETTLED) & (differs[:-1] | differs[1:])
            keep = np.flatnonzero(done | candidate)
            if not len(keep):
                return None
            part = rows.take(pa.array(keep)).select(["id", "th", "p", "a", "b", "kh"])
            part = part.append_column("done", pa.array(done[keep])).append_column("open", pa.array(candidate[keep]))
            return part.combine_chunks().to_batches()[0]

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table])
            kh, sh, state = (table[c].to_numpy() for c in ("kh", "sh", "state"))
            if len(kh) > 1:
                out = emit(table.slice(0, len(kh) - 1), kh[:-1], sh[:-1], state[:-1], (kh[-1], sh[-1]))
                if out is not None:
                    yield out
                before = (kh[-2], sh[-2])
            held = table.slice(len(kh) - 1)
        if held is not None:
            kh, sh, state = (held[c].to_numpy() for c in ("kh", "sh", "state"))
            out = emit(held, kh, sh, state, (None, None))
            if out is not None:
                yield out

    kind = rows.schema["id"].dataType.simpleString()
    sorted_rows = rows.repartition("kh").sortWithinPartitions("kh", "sh")
    return sorted_rows.mapInArrow(judge, f"id {kind}, th bigint, p int, a int, b int, kh bigint, done boolean, open boolean")


def _fetch(docs: DataFrame, candidates: DataFrame, length: int) -> DataFrame:
    """The candidates with the bytes beside their anchors, and a second hash of the anchor's bytes."""
    k = length // 2
    per_doc = scratch(
        candidates.groupBy("id", "th").agg(F.collect_list(F.struct("p", "a", "b", "kh", "done")).alias("at")).withColumnsRenamed({"id": "cid", "th": "cth"}),
        "candidates",
    )
    small = per_doc.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    joined = docs.join(F.broadcast(per_doc) if small else per_doc, F.col("id").eqNullSafe(F.col("cid")) & (F.col("th") == F.col("cth")))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        row: list[int] = []
        for n, (data, at) in enumerate(zip(batch["text"].to_pylist(), batch["at"].to_pylist())):
            for c in at:
                p, a, b = c["p"], c["a"], c["b"]
                row.append(n)
                kx = xxhash.xxh3_64_intdigest(data[p : p + k])
                out.append((p, a, b, c["kh"], kx - (1 << 64) if kx >> 63 else kx, data[p - a : p], data[p + k : p - b + length], c["done"]))
        p, a, b, kh, kx, left, right, done = zip(*out)
        yield pa.RecordBatch.from_arrays(
            [
                batch["id"].take(pa.array(row)),
                batch["th"].take(pa.array(row)),
                *(pa.array(x, pa.int32()) for x in (p, a, b)),
                *(pa.array(x, pa.int64()) for x in (kh, kx)),
                *(pa.array(x, pa.binary()) for x in (left, right)),
                pa.array(done, pa.bool_()),
            ],
            ["id", "th", "p", "a", "b", "kh", "kx", "left", "right", "done"],
        )

    kind = docs.schema["id"].dataType.simpleString()
    return map_batches(joined.select("id", "th", "text", "at"), run, f"id {kind}, th bigint, p int, a int, b int, kh bigint, kx bigint, left binary, right binary, done boolean")


def repeated_windows(segments: list[tuple[int, bytes, bytes]], width: int) -> list[np.ndarray]:
    """For each segment (anchor number, bytes before and after it): which of its windows of ``width`` symbols recur.

    A segment reads as its bytes with the anchor as a single symbol between
    them; all its positions with ``width`` symbols left are windows.
    """
    text: list[int] = []
    starts = []
    names: dict[int, int] = {}
    for anchor, left, right in segments:
        starts.append(len(text))
        text += [c + 2 for c in left]
        text.append(258 + names.setdefault(anchor, len(names)))
        text += [c + 2 for c in right]
        text.append(1)
    order = np.array(suffix_array(text), np.int64)
    flat = np.array(text, np.int32)
    ends = np.array([*starts[1:], len(text)]) - 1
    room = np.repeat(ends, np.diff([*starts, len(text)])) - np.arange(len(text))
    order = order[room[order] >= width]
    recurs = np.zeros(len(text), bool)
    if len(order) > 1:
        views = np.lib.stride_tricks.sliding_window_view(flat, width)
        for at in range(0, len(order) - 1, 20_000):
            x, y = order[at : at + 20_000], order[at + 1 : at + 20_001]
            x = x[: len(y)]
            equal = (views[x] == views[y]).all(axis=1)
            recurs[x[equal]] = True
            recurs[y[equal]] = True
    return [recurs[s : max(s, e - width + 1)] for s, e in zip(starts, ends)]


def _blocks(rows: DataFrame, width: int, block: int) -> DataFrame:
    """Window ranges ``(id, th, lo, hi)`` that recur within a group of ``rows``, by suffix arrays of whole groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def resolve(groups: list[dict]) -> Iterator[tuple]:
            hits = repeated_windows([(r["key"], r["left"], r["right"]) for r in groups], width)
            for r, hit in zip(groups, hits):
                if r["done"]:
                    continue
                edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
                first = r["p"] - r["a"]
                for x, y in zip(edges[::2].tolist(), edges[1::2].tolist()):
                    yield r["id"], r["th"], first + x, first + y - 1

        def batch_of(found: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
            ids, th, lo, hi = zip(*found)
            return pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(th, pa.int64()), pa.array(lo, pa.int32()), pa.array(hi, pa.int32())], ["id", "th", "lo", "hi"])

        waiting: list[dict] = []  # whole groups
        group: list[dict] = []  # the group being read
        size = 0
        kind = pa.null()
        for batch in batches:
            kind = batch.schema.field("id").type
            for r in batch.to_pylist():
                if group and group[0]["key"] != r["key"]:
                    if len(group) > 1:
                        waiting += group
                        size += sum(len(g["left"]) + len(g["right"]) + 2 for g in group)
                    group = []
                    if size >= block:
                        if found := list(resolve(waiting)):
                            yield batch_of(found, kind)
                        waiting, size = [], 0
                group.append(r)
        if len(group) > 1:
            waiting += group
        if waiting and (found := list(resolve(waiting))):
            yield batch_of(found, kind)

    kind = rows.schema["id"].dataType.simpleString()
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(run, f"id {kind}, th bigint, lo int, hi int")


def _resolve(candidates: DataFrame, length: int, block: int, group_rows: int) -> DataFrame:
    """Window ranges ``(id, th, lo, hi)`` of the candidates that recur."""
    free = length - length // 2
    rows = candidates.withColumns({"x": F.lit(0), "y": F.lit(0)})
    known, found = 0, []
    while known < free:
        half = (free - known + 1) // 2
        known += half
        # Equal windows share the anchor, x bytes before and y after it, and
        # half of the open bytes on one side at least.
        grown = [rows.withColumn("x", F.col("x") + half).where("a >= x"), rows.withColumn("y", F.col("y") + half).where("length(right) >= y")]
        rows = reduce(DataFrame.unionByName, grown)
        if found:  # the same two sides can be reached in two orders; a row must not meet itself
            rows = rows.dropDuplicates(["id", "th", "p", "x", "y"])
        near = F.expr("substring(left, length(left) - x + 1, x)"), F.expr("substring(right, 1, y)")
        rows = rows.withColumn("key", F.xxhash64("kh", "kx", "x", "y", *near))
        sizes = scratch(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "sizes")
        rows = rows.join(sizes, "key")
        if known == free:  # a single window is left: where keys agree, it is the same
            found.append(rows.where("not done").select("id", "th", (F.col("p") - F.col("x")).alias("lo"), (F.col("p") - F.col("x")).alias("hi")))
            break
        found.append(_blocks(rows.where(F.col("n") <= group_rows).select("id", "th", "p", "a", "key", "left", "right", "done"), free + 1, block))
        if not sizes.where(F.col("n") > group_rows).take(1):
            break
        rows = scratch(rows.where(F.col("n") > group_rows).drop("key", "n"), "large")
    return reduce(DataFrame.unionByName, found)


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    block: int = BLOCK,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """One row per document: id, ``n_bytes``, ``spans`` (removed byte ranges) and ``kept`` (the bytes left).

    A byte goes if any string of ``length`` bytes that covers it also starts
    elsewhere, in this or another row; strings are those of the input and
    never cross rows. Bytes may be cut inside a character, so ``kept`` is
    binary.

    Null and empty texts have no bytes; texts shorter than ``length`` stay
    whole; of repeated rows every one loses its bytes, as each repeats the
    other. An empty table gives an empty result.
    """
    if length < 4:
        raise ValueError("length must be at least 4 bytes")
    src = docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("text")).withColumn("th", F.xxhash64("text"))
    met = scratch(_meet(_scan(src.select("id", "th", "text"), length)), "anchors")
    candidates = scratch(_fetch(src, met.where("open"), length), "segments")
    found = scratch(_resolve(candidates, length, block, group_rows), "windows")
    settled = met.where("done").select("id", "th", (F.col("p") - F.col("a")).alias("lo"), (F.col("p") - F.col("b")).alias("hi"))
    runs = settled.unionByName(found).distinct()
    per_doc = runs.groupBy("id", "th").agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("runs")).withColumnsRenamed({"id": "rid", "th": "rth"})
    joined = src.join(per_doc, F.col("id").eqNullSafe(F.col("rid")) & (F.col("th") == F.col("rth")), "left").select("id", "text", "runs")

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        spans, kept = [], []
        for data, windows in zip(batch["text"].to_pylist(), batch["runs"].to_pylist()):
            merged: list[list[int]] = []
            for w in windows or ():
                if merged and w["lo"] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], w["hi"] + length)
                else:
                    merged.append([w["lo"], w["hi"] + length])
            edges = [0, *(e for m in merged for e in m), len(data)]
            spans.append([{"start": a, "end": b} for a, b in merged])
            kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
        n_bytes = pa.array([len(t) for t in batch["text"].to_pylist()], pa.int64())
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        yield pa.RecordBatch.from_arrays([batch["id"], n_bytes, pa.array(spans, kind), pa.array(kept, pa.binary())], ["id", "n_bytes", "spans", "kept"])

    kind = src.schema["id"].dataType.simpleString()
    out = map_batches(joined, cut, f"id {kind}, n_bytes bigint, spans array<struct<start: int, end: int>>, kept binary")
    return out.withColumnRenamed("id", id_col)
