"""SimHash near-duplicates by tiled exact comparison of fingerprints.

1. Each text's fingerprint is computed where the text lies; only ids and
   fingerprints move on. Equal fingerprints are one class from here on, so
   copies cost nothing further.
2. Two fingerprints within ``radius`` bits agree on at least two of
   ``radius + 2`` bands of bits, so each class is sent to one group per pair
   of bands (nothing is lost). Groups that are still large are split the same
   way over their remaining bits, so a hot group doesn't meet in one task.
3. Each task sorts its classes by group and population count, cuts them into
   tiles and compares tile pairs exactly with exclusive-or and bit counts. A
   tile pair is skipped when the groups differ, or when the population
   counts differ by more than the radius. A task hands on a spanning forest
   of the links found, not the pairs.
4. Components come from joins over that forest.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import released, map_batches, scratch, utf8
from strata.llm.components import connected_components, local_roots

SHINGLE = 3
RADIUS = 3
SEED = 42
TILE = 512
HOT_GROUP = 50_000

_UPPER = bytes.maketrans(bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B)))
_BLOCK = 1 << 14


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash over the word shingles of a UTF-8 text (0 without words).

    Words are runs of bytes that are not ASCII white space, with A-Z lower-cased.
    """
    words = text.translate(_UPPER).split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = ends[shingle - 1 :] if len(words) > shingle else ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts[:n].tolist(), last.tolist())), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _BLOCK):
        part = hashes[at : at + _BLOCK]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """``(id, text_hash, fp)`` for every row; ``fp`` is the fingerprint's bits as a signed bigint."""
    src = docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash"))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        fps = np.array([fingerprint(t, shingle) for t in batch["text"].to_pylist()], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch["id"], batch["text_hash"], pa.array(fps)], ["id", "text_hash", "fp"])

    return map_batches(src, run, f"id {src.schema['id'].dataType.simpleString()}, text_hash bigint, fp bigint")


def _pick(fp: Column, bits: list[int]) -> Column:
    """The given ascending bits of the bigint column, packed into a small bigint."""
    runs: list[list[int]] = []
    for b in bits:
        if runs and runs[-1][-1] == b - 1:
            runs[-1].append(b)
        else:
            runs.append([b])
    packed, at = F.lit(0).cast("bigint"), 0
    for run in runs:
        part = F.shiftrightunsigned(fp, run[0]).bitwiseAND(F.lit((1 << len(run)) - 1).cast("bigint"))
        packed = packed.bitwiseOR(F.shiftleft(part, at))
        at += len(run)
    return packed


def _cut(bits: list[int], parts: int) -> list[list[int]]:
    """``bits`` cut into ``parts`` runs of nearly equal length."""
    at = [round(k * len(bits) / parts) for k in range(parts + 1)]
    return [bits[a:b] for a, b in zip(at, at[1:])]


def _choices(radius: int) -> list[list[int]]:
    """All pairs of ``radius + 2`` bands: fingerprints within the radius agree on one pair at least."""
    return [sorted(a + b) for a, b in combinations(_cut(list(range(64)), radius + 2), 2)]


def grouped(classes: DataFrame, radius: int, hot_group: int = HOT_GROUP) -> DataFrame:
    """``(key, sub, fp)``: every fingerprint once for each pair of bands, with ``sub = 0``.

    Groups of more than ``hot_group`` fingerprints are split once more by
    ``radius + 1`` bands of the bits that their key leaves open (``sub``);
    fingerprints within the radius again agree on one of them.
    """
    fp = F.col("fp")
    choices = _choices(radius)
    keys = [(_pick(fp, bits) + F.lit(c << 48)).alias("key") for c, bits in enumerate(choices)]
    rows = classes.select(F.explode(F.array(*keys)).alias("key"), F.lit(0).cast("bigint").alias("sub"), "fp")
    hot = scratch(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_group).select("key"), "hot")
    if not hot.take(1):
        return rows
    large = rows.join(hot, "key", "left_semi")
    split = None
    for c, bits in enumerate(choices):
        left = _cut([b for b in range(64) if b not in bits], radius + 1)
        subs = [_pick(fp, run) + F.lit((k + 1) << 48) for k, run in enumerate(left)]
        part = large.where(F.shiftright("key", 48) == c).select("key", F.explode(F.array(*subs)).alias("sub"), "fp")
        split = part if split is None else split.unionByName(part)
    return rows.join(hot, "key", "left_anti").unionByName(split)


class _Tile:
    """Consecutive rows of the sorted input: group number, population count and fingerprint of each."""

    def __init__(self, group: np.ndarray, ones: np.ndarray, fp: np.ndarray):
        self.group, self.ones, self.fp = group, ones, fp

    def links(self, later: _Tile, radius: int) -> tuple[np.ndarray, np.ndarray] | None:
        """Forest edges among the links between this tile and ``later`` (or within it)."""
        near = np.bitwise_count(self.fp[:, None] ^ later.fp[None, :]) <= radius
        if self.group[0] != later.group[-1]:
            near &= self.group[:, None] == later.group[None, :]
        if later is self:
            near = np.triu(near, 1)
        a, b = np.nonzero(near)
        if not len(a):
            return None
        fps = self.fp if later is self else np.concatenate([self.fp, later.fp])
        root = local_roots(len(fps), a, b if later is self else b + len(self.fp))
        child = np.flatnonzero(root != np.arange(len(fps)))
        return fps[child], fps[root[child]]


def _tiles(batches: Iterator[pa.RecordBatch], tile: int) -> Iterator[_Tile]:
    """The sorted rows as tiles; group numbers count the changes of ``(key, sub)``."""
    last, number = None, 0
    rest = [np.empty(0, np.int64), np.empty(0, np.uint8), np.empty(0, np.uint64)]
    for batch in batches:
        if not batch.num_rows:
            continue
        key, sub, fp = (batch[c].to_numpy(zero_copy_only=False) for c in ("key", "sub", "fp"))
        change = np.empty(len(key), np.int64)
        change[0] = last is not None and last != (key[0], sub[0])
        change[1:] = (key[1:] != key[:-1]) | (sub[1:] != sub[:-1])
        group = number + np.cumsum(change)
        last, number = (key[-1], sub[-1]), int(group[-1])
        bits = fp.view(np.uint64)
        rest = [np.concatenate(x) for x in zip(rest, (group, np.bitwise_count(bits), bits))]
        while len(rest[0]) >= tile:
            yield _Tile(*(x[:tile] for x in rest))
            rest = [x[tile:] for x in rest]
    if len(rest[0]):
        yield _Tile(*rest)


def links(classes: DataFrame, radius: int = RADIUS, tile: int = TILE, hot_group: int = HOT_GROUP) -> DataFrame:
    """A spanning forest ``(u, v)`` of the links between distinct fingerprints within ``radius`` bits."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_tiles: list[_Tile] = []
        for new in _tiles(batches, tile):
            # Rows come by group and population count: an earlier tile matters
            # only while its last group goes on, within the radius.
            open_tiles = [t for t in open_tiles if t.group[-1] == new.group[0] and int(new.ones[0]) - int(t.ones[-1]) <= radius]
            found = [x for t in (*open_tiles, new) if (x := t.links(new, radius))]
            open_tiles.append(new)
            if found:
                u, v = (np.concatenate(x).view(np.int64) for x in zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    rows = grouped(classes, radius, hot_group).repartition("key", "sub")
    return rows.sortWithinPartitions("key", "sub", F.bit_count("fp"), "fp").mapInArrow(released(compare), "u bigint, v bigint")


def _members(docs: DataFrame, id_col: str, text_col: str, shingle: int, radius: int, tile: int, hot_group: int) -> DataFrame:
    """``(id, text_hash, fp, root, component_id)`` for every row."""
    fps = scratch(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    classes = scratch(fps.groupBy("fp").agg(F.min("id").alias("least")), "classes")
    joined = connected_components(links(classes.select("fp"), radius, tile, hot_group)).withColumnRenamed("node", "fp")
    rooted = scratch(classes.join(joined, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "roots")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return fps.join(rooted.join(named, "root").select("fp", "root", "component_id"), "fp")


def simhash_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    tile: int = TILE,
    hot_group: int = HOT_GROUP,
) -> DataFrame:
    """One row per document: id, ``fingerprint`` (16 hex digits), ``component_id``, ``kept``.

    ``component_id`` is the smallest id reachable over links of at most
    ``radius`` differing bits, the row's own included; ``kept`` marks the
    row whose id it is (each of them, where a row is repeated).

    Null, empty and blank texts have the fingerprint 0 and link like any
    other. Rows with a null id take part, but give a component no id unless
    all its ids are null. An empty table gives an empty result.
    """
    return _members(docs, id_col, text_col, shingle, radius, tile, hot_group).select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def keep_one(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    tile: int = TILE,
    hot_group: int = HOT_GROUP,
) -> DataFrame:
    """``docs`` with one row of each SimHash component, all columns as they are.

    The row that stays has the component's smallest id, and of several texts
    with it (an id that is repeated inside a component) the one with the
    smallest hash; of equal rows any one stays. An id that is repeated in
    different components stays in each, as does a null id where a component
    has no other.
    """
    kept = _members(docs, id_col, text_col, shingle, radius, tile, hot_group).where(F.col("id").eqNullSafe(F.col("component_id")))
    kept = kept.groupBy(F.col("root").alias("strata_root")).agg(F.first("id").alias("strata_id"), F.min("text_hash").alias("strata_hash"))
    same = F.col(id_col).eqNullSafe(F.col("strata_id")) & (F.xxhash64(text_col) == F.col("strata_hash"))
    return docs.join(kept, same).dropDuplicates(["strata_root"]).drop("strata_root", "strata_id", "strata_hash")
