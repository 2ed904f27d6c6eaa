"""Benchmark decontamination by a generalised suffix automaton.

The benchmark's words go into one suffix automaton; every document's words
are streamed through it, which keeps the length of the longest benchmark
passage that ends at each word. Where that length reaches ``width`` words (or
covers a whole shorter item) the words are marked.

Scale: documents are only mapped, never shuffled. The benchmark is cut into
shards of at most ``shard_bytes`` of text and only one shard is broadcast at
a time; a benchmark of more than one shard takes one pass per shard, with the
marks carried in a table of the shared folder.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache, partial, reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import free_name, map_batches, scratch, utf8

WIDTH = 10
SHARD_BYTES = 1 << 20
MAX_COVERAGE = 0.5

# Words: runs of a-z, 0-9 and everything beyond ASCII, after lower-casing A-Z.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
_WORD = re.compile(rb"[^ ]+")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class SuffixAutomaton:
    """All word sequences of the given items, as a generalised suffix automaton.

    Keeps, for each state, the items with a ``width``-word window in it and
    the items of fewer words that end in it.
    """

    def __init__(self, items: Sequence[tuple[str, Sequence[bytes]]], width: int = WIDTH):
        self.width = width
        self.next: list[dict[bytes, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        for _, words in items:
            last = 0
            for w in words:
                last = self._extend(last, w)
        n = len(self.next)
        order = sorted(range(n), key=self.length.__getitem__)
        # The state on the suffix chain that holds the last `width` words.
        self.window = [-1] * n
        for v in order[1:]:
            above = self.window[self.link[v]]
            self.window[v] = above if above >= 0 else v if self.length[v] >= width else -1
        self.items_at: dict[int, set[str]] = {}
        ends: dict[int, list[tuple[int, str]]] = {}
        for name, words in items:
            v = 0
            for k, w in enumerate(words):
                v = self.next[v][w]
                if k + 1 >= width:
                    self.items_at.setdefault(self.window[v], set()).add(name)
            if 0 < len(words) < width:
                ends.setdefault(v, []).append((len(words), name))
        # Short items that end at a state or anywhere up its suffix chain.
        self.short: list[tuple[tuple[int, str], ...]] = [()] * n
        for v in order[1:]:
            self.short[v] = (*ends.get(v, ()), *self.short[self.link[v]])
        self.has_short = any(self.short)

    def _extend(self, last: int, w: bytes) -> int:
        known = self.next[last].get(w)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._clone(last, w, known)
        cur = self._state(self.length[last] + 1, {})
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = cur
            p = self.link[p]
        if p < 0:
            self.link[cur] = 0
        else:
            q = self.next[p][w]
            self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._clone(p, w, q)
        return cur

    def _state(self, length: int, edges: dict[bytes, int]) -> int:
        self.next.append(edges)
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _clone(self, p: int, w: bytes, q: int) -> int:
        copy = self._state(self.length[p] + 1, dict(self.next[q]))
        self.link[copy] = self.link[q]
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def scan(self, words: Sequence[bytes]) -> tuple[bytearray | None, set[str]]:
        """A mark for each word inside a benchmark window (None: no mark), and the items found."""
        step, link, length, window, short = self.next, self.link, self.length, self.window, self.short
        width, has_short = self.width, self.has_short
        root = step[0]
        marks: bytearray | None = None
        found: set[str] = set()
        v = size = 0
        for at, w in enumerate(words):
            to = step[v].get(w)
            if to is None:
                if w not in root:
                    v = size = 0
                    continue
                while to is None:
                    v = link[v]
                    to = step[v].get(w)
                size = length[v]
            v = to
            size += 1
            if size >= width:
                marks = marks or bytearray(len(words))
                marks[at + 1 - width : at + 1] = b"\1" * width
                found |= self.items_at[window[v]]
            if has_short and short[v]:
                for n, name in short[v]:
                    if n <= size:
                        marks = marks or bytearray(len(words))
                        marks[at + 1 - n : at + 1] = b"\1" * n
                        found.add(name)
        return marks, found


def _runs(marks: bytes) -> Iterator[tuple[int, int]]:
    for m in re.finditer(rb"\x01+", marks):
        yield m.span()


def spans_of(text: bytes, marks: bytes) -> list[tuple[int, int]]:
    """The byte spans from the first to the last word of each marked run."""
    at = [m.span() for m in _WORD.finditer(text.translate(_FOLD))]
    return [(at[a][0], at[b - 1][1]) for a, b in _runs(marks)]


def cut(text: bytes, spans: Iterable[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for a, b in spans:
        kept.append(text[at:a])
        at = b
    return b"".join([*kept, text[at:]])


def _shards(benchmark: DataFrame, id_col: str, text_col: str, width: int, shard_bytes: int) -> DataFrame:
    """The benchmark as rows of at most ``shard_bytes`` of words each, built by tasks.

    An item longer than a shard is cut with an overlap of ``width - 1``
    words, so that none of its windows is lost.
    """
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), utf8(text_col).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[str] = []
        texts: list[bytes] = []
        size = 0

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([names], pa.list_(pa.string())), pa.array([texts], pa.list_(pa.binary()))], ["items", "texts"])

        for batch in batches:
            for name, text in zip(batch["item"].to_pylist(), batch["text"].to_pylist()):
                words = words_of(text)
                while words:
                    part, used = [], 0
                    for w in words:
                        if used > shard_bytes and len(part) >= width:
                            break
                        part.append(w)
                        used += len(w) + 1
                    if size and size + used > shard_bytes:
                        yield row()
                        names, texts, size = [], [], 0
                    names.append(name)
                    texts.append(b" ".join(part))
                    size += used
                    words = words[len(part) - width + 1 :] if len(part) < len(words) else []
        if names:
            yield row()

    return scratch(items.repartition(max(1, -(-int(total) // shard_bytes))).mapInArrow(pack, "items array<string>, texts array<binary>"), "benchmark")


@lru_cache(maxsize=1)
def _automaton(names: tuple[str, ...], texts: tuple[bytes, ...], width: int) -> SuffixAutomaton:
    return SuffixAutomaton([(n, t.split()) for n, t in zip(names, texts)], width)


def _scanned(docs: DataFrame, text_col: str, packed_items: DataFrame, width: int, finish, schema: str) -> DataFrame:
    """``finish(batch, texts, marks, items, automaton)`` after every shard has been scanned."""
    marks_col, items_col = free_name(docs, "marks"), free_name(docs, "items")
    spark = docs.sparkSession
    state = docs.withColumn(marks_col, F.lit(None).cast("binary")).withColumn(items_col, F.array().cast("array<string>"))
    carried = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in state.schema.fields)
    shards = packed_items.toLocalIterator()
    shard = next(shards, None)
    while True:
        after = next(shards, None)
        packed = spark.sparkContext.broadcast((tuple(shard["items"]), tuple(bytes(t) for t in shard["texts"])) if shard else ((), ()))
        last = after is None

        def scan(batch: pa.RecordBatch, packed=packed, last=last) -> Iterator[pa.RecordBatch]:
            automaton = _automaton(*packed.value, width)
            texts = [t or b"" for t in batch[text_col].cast(pa.binary()).to_pylist()]
            marks, items = [], []
            for text, old, seen in zip(texts, batch[marks_col].to_pylist(), batch[items_col].to_pylist()):
                new, found = automaton.scan(words_of(text))
                if old:
                    new = bytes(map(int.__or__, old, new)) if new else old
                marks.append(bytes(new) if new else None)
                items.append(sorted({*seen, *found}))
            if last:
                yield from finish(batch, texts, marks, items, automaton)
            else:
                kept = [batch[n] for n in batch.schema.names if n not in (marks_col, items_col)]
                names = [n for n in batch.schema.names if n not in (marks_col, items_col)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(marks, pa.binary()), pa.array(items, pa.list_(pa.string()))], [*names, marks_col, items_col])

        state = map_batches(state, scan, schema if last else carried, _automaton.cache_clear)
        if last:
            return state
        state, shard = scratch(state, "decontam"), after


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """One row per document: its words, marked words, benchmark items and byte spans.

    Columns: the id, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``
    (of the item ids sorted as strings and joined by commas),
    ``contaminated``, ``coverage`` (marked share of the words) and ``spans``
    (start and end byte of each marked run).

    Null or empty texts have no words and are never contaminated; items
    without words mark nothing; repeated documents each get their row, and
    repeated item ids count once. Empty tables give an empty result, or
    clean documents.
    """
    key = "strata_id"
    src = docs.select(F.col(id_col).alias(key), utf8(text_col).alias("text"))
    kind = src.schema[key].dataType.simpleString()

    def finish(batch, texts, marks, items, automaton) -> Iterator[pa.RecordBatch]:
        n_words = [len(words_of(t)) for t in texts]
        n_hit = [sum(m) if m else 0 for m in marks]
        spans = [[{"start": a, "end": b} for a, b in spans_of(t, m)] if m else [] for t, m in zip(texts, marks)]
        yield pa.RecordBatch.from_arrays(
            [
                batch[key],
                pa.array(n_words, pa.int64()),
                pa.array(n_hit, pa.int64()),
                pa.array([len(i) for i in items], pa.int64()),
                pa.array([hashlib.sha256(",".join(i).encode()).hexdigest() for i in items], pa.string()),
                pa.array([h > 0 for h in n_hit], pa.bool_()),
                pa.array([h / n if n else 0.0 for h, n in zip(n_hit, n_words)], pa.float64()),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
            ],
            [key, "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "coverage", "spans"],
        )

    schema = (
        f"{key} {kind}, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, "
        "coverage double, spans array<struct<start: int, end: int>>"
    )
    out = _scanned(src, "text", _shards(benchmark, item_id, item_text, width, shard_bytes), width, finish, schema)
    return out.withColumnRenamed(key, id_col)


def remove_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
    max_coverage: float = MAX_COVERAGE,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """``docs`` without benchmark passages; all columns are kept as they are but the text.

    Marked runs are cut out of the text, again and again until no window is
    left (a cut may join two halves of another window); with more than one
    shard, what was cut goes over all shards again. A document of which
    more than ``max_coverage`` is marked goes whole. Untouched texts are
    returned byte for byte, nulls included.
    """
    columns, cut_col = docs.columns, free_name(docs, "cut")
    shards = _shards(benchmark, item_id, item_text, width, shard_bytes)
    alone = shards.limit(2).count() < 2

    def finish(batch, texts, marks, items, automaton, first=True) -> Iterator[pa.RecordBatch]:
        keep, changed = [], {}
        for k, (text, m) in enumerate(zip(texts, marks)):
            if first and m and sum(m) > max_coverage * len(m):
                keep.append(False)
                continue
            keep.append(True)
            while m:
                text = cut(text, spans_of(text, m))
                changed[k] = text
                m = automaton.scan(words_of(text))[0] if alone else None
        arrays = [batch[c] for c in columns]
        if changed:
            at = columns.index(text_col)
            whole = arrays[at].to_pylist()
            for k, text in changed.items():
                whole[k] = text.decode("utf-8", errors="replace")
            arrays[at] = pa.array(whole, arrays[at].type)
        arrays.append(pa.array([k in changed for k in range(len(keep))], pa.bool_()))
        yield pa.RecordBatch.from_arrays(arrays, [*columns, cut_col]).filter(pa.array(keep, pa.bool_()))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields) + f", `{cut_col}` boolean"
    out = _scanned(docs, text_col, shards, width, finish, schema)
    if alone:
        return out.drop(cut_col)
    parts = []
    while True:
        out = scratch(out, "decontam")
        parts.append(out.where(~F.col(cut_col)).drop(cut_col))
        rest = out.where(F.col(cut_col)).drop(cut_col)
        if not rest.take(1):
            return reduce(DataFrame.unionByName, parts)
        out = _scanned(rest, text_col, shards, width, partial(finish, first=False), schema)
