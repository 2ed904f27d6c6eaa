"""Embedding near-duplicates by binary codes of randomly rotated vectors.

1. Equal vectors become one class with its number of copies, so a vector that
   a third of all rows hold costs one row from here on.
2. Each class's unit vector is rotated by a fixed random rotation; the signs
   are its code, and the sum of the rotated vector's absolute components is
   the stored correction factor. The code's inner product with another
   rotated vector, divided by the factor, estimates their cosine without
   bias, within an error that shrinks with the dimension.
3. Classes meet in cells around centres picked from a bounded sample: each at
   home in its nearest cell and as a visitor in the next nearest ones. Cells
   are cut into blocks of at most ``BLOCK`` classes at home; visitors stream
   past a block in Arrow batches.
4. Where the estimate plus its confidence bound reaches the threshold, the
   cosine is computed in double precision; only that decides on a link. A
   pair that could meet in two cells is counted in one of them. Tasks hand on
   link counts and a spanning forest, never pairs.

The index is approximate in step 3 alone: a linked pair is missed if neither
vector visits the other's cell. The tests measure recall against brute force.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_batches, scratch
from strata.llm.components import connected_components, local_roots

THRESHOLD = 0.9
PROBES = 8
SAMPLE = 20_000
BLOCK = 4_096
CONFIDENCE = 5.0
SEED = 7
_SPREAD = 0.6
_TILE = 1_024
_PAIRS = 50_000


@lru_cache(maxsize=8)
def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix, the same on every worker."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def units(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def codes(rotated: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed signs and correction factors of rotated unit vectors."""
    return np.packbits(rotated > 0, axis=1), np.abs(rotated).sum(axis=1)


def estimates(queries: np.ndarray, packed: np.ndarray, factors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unbiased cosine estimates (queries x coded), and one standard deviation's bound for each coded vector."""
    dim = queries.shape[1]
    signs = np.unpackbits(packed, axis=1, count=dim).astype(np.float32) * 2 - 1
    estimate = (queries.astype(np.float32) @ signs.T) / factors.astype(np.float32)
    f2 = np.minimum(factors**2 / dim, 1.0)
    return estimate, np.sqrt((1 - f2) / f2 / max(dim - 1, 1)).astype(np.float32)


def _rows(embeddings: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(id, vec, dim)``: a usable vector's components as doubles' bytes, else null."""
    kind = embeddings.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out: list[bytes | None] = []
        dims = []
        for v in batch["vec"]:
            data = None
            if v.is_valid and len(v) and not v.values.null_count:
                x = v.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
                if np.isfinite(x).all() and x.any():
                    data = x.tobytes()
            out.append(data)
            dims.append(len(data) // 8 if data else None)
        yield pa.RecordBatch.from_arrays([batch["id"], pa.array(out, pa.binary()), pa.array(dims, pa.int32())], ["id", "vec", "dim"])

    src = embeddings.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    return map_batches(src, run, f"id {kind}, vec binary, dim int")


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dim)


def _centres(classes: DataFrame, dims: list[tuple[int, int]], sample: int) -> dict[int, np.ndarray]:
    """For each dimension, mutually distant unit vectors of a bounded sample, about half the root of the classes."""
    centres = {}
    for dim, n in dims:
        cells = max(1, math.ceil(math.sqrt(n) / 2))
        rows = classes.where(F.col("dim") == dim).orderBy(F.xxhash64("cid"), "cid").limit(min(sample, 16 * cells)).select("vec").collect()
        vectors = units(np.stack([np.frombuffer(r["vec"], np.float64) for r in rows]))
        chosen: list[np.ndarray] = []
        for v in vectors:
            if len(chosen) == cells:
                break
            if not chosen or float(np.max(np.stack(chosen) @ v)) < _SPREAD:
                chosen.append(v)
        centres[dim] = np.stack(chosen)
    return centres


def _index(classes: DataFrame, centres: dict[int, np.ndarray], probes: int) -> DataFrame:
    """Every class with its code, factor, home cell and the cells it probes."""
    shared = classes.sparkSession.sparkContext.broadcast(centres)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        dims = batch["dim"].to_numpy()
        for dim in np.unique(dims).tolist():
            part = batch.filter(pa.array(dims == dim))
            unit = units(_matrix(part["vec"], dim))
            packed, factors = codes(unit @ rotation(dim))
            near = unit @ shared.value[dim].T
            k = min(probes, near.shape[1])
            cells = np.argsort(-near, axis=1, kind="stable")[:, :k].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part["cid"], part["dim"], part["copies"], part["vec"], pa.array([x.tobytes() for x in packed], pa.binary()), pa.array(factors), pa.array(cells.tolist(), pa.list_(pa.int32()))],
                ["cid", "dim", "copies", "vec", "code", "factor", "cells"],
            )

    return map_batches(classes.select("cid", "dim", "copies", "vec"), run, "cid bigint, dim int, copies bigint, vec binary, code binary, factor double, cells array<int>")


class _Rows:
    """Rows of one block, as arrays."""

    def __init__(self, batch: pa.RecordBatch, dim: int):
        self.cid = batch["cid"].to_numpy()
        self.copies = batch["copies"].to_numpy()
        self.unit = units(_matrix(batch["vec"], dim))
        self.rotated = self.unit @ rotation(dim)
        self.code = np.frombuffer(b"".join(batch["code"].to_pylist()), np.uint8).reshape(len(self.cid), -1)
        self.factor = batch["factor"].to_numpy()
        cells = batch["cells"].to_pylist()
        self.home = np.array([c[0] for c in cells], np.int32)
        self.cells = np.array(cells, np.int32)
        self.links = np.zeros(len(self.cid), np.int64)

    @staticmethod
    def joined(parts: list[_Rows]) -> _Rows:
        out = object.__new__(_Rows)
        for name in ("cid", "copies", "unit", "rotated", "code", "factor", "home", "cells", "links"):
            setattr(out, name, np.concatenate([getattr(p, name) for p in parts]))
        return out


def _links(index: DataFrame, threshold: float, confidence: float, block: int) -> DataFrame:
    """Rows ``(cid, links, u, v)``: link counts to add up, and edges of a spanning forest."""
    homes = index.groupBy("dim", F.col("cells")[0].alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    # As many rows as centres, which the sample bounds.
    blocks = F.broadcast(homes.select("dim", "cell", F.ceil(F.col("n") / block).cast("int").alias("blocks")))
    visits = index.select("*", F.posexplode("cells").alias("place", "cell"))
    home = F.col("place") == 0
    own = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    visits = visits.join(blocks, ["dim", "cell"]).withColumn("own", F.when(home, own))
    # At home in one block and a visitor of the later ones; elsewhere a visitor of every block.
    first = F.when(home, F.col("own")).otherwise(F.lit(0))
    visits = visits.select("*", F.explode(F.sequence(first, F.col("blocks") - 1)).alias("block"))
    visits = visits.withColumn("guest", ~(home & (F.col("block") == F.col("own")))).drop("place", "own", "blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here: list[_Rows] = []
        hosts: _Rows | None = None
        key = None

        def compare(a: _Rows, b: _Rows, cell: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            """Counts the links from ``a`` to ``b`` and yields forest edges."""
            for at in range(0, len(a.cid), _TILE):
                rows = slice(at, at + _TILE)
                estimate, bound = estimates(a.rotated[rows], b.code, b.factor)
                maybe = estimate + confidence * bound >= threshold
                if a is b:
                    maybe &= np.arange(len(b.cid))[None, :] > np.arange(at, at + len(maybe))[:, None]
                x, y = np.nonzero(maybe)
                x += at
                if not len(x):
                    continue
                exact = np.concatenate([np.einsum("ij,ij->i", a.unit[x[k : k + _PAIRS]], b.unit[y[k : k + _PAIRS]]) for k in range(0, len(x), _PAIRS)])
                hit = exact >= threshold
                x, y = x[hit], y[hit]
                # A guest that lives elsewhere, and whose host visits it there, is counted in the lower cell.
                away = a.home[x] != cell
                both = away & (b.cells[y] == a.home[x][:, None]).any(axis=1)
                once = ~both | (cell < a.home[x])
                x, y = x[once], y[once]
                if not len(x):
                    continue
                a.links += np.bincount(x, b.copies[y], len(a.cid)).astype(np.int64)
                b.links += np.bincount(y, a.copies[x], len(b.cid)).astype(np.int64)
                names, place = np.unique(np.concatenate([a.cid[x], b.cid[y]]), return_inverse=True)
                root = local_roots(len(names), place[: len(x)], place[len(x) :])
                child = np.flatnonzero(root != np.arange(len(names)))
                yield names[child], names[root[child]]

        def edges(found: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
            for u, v in found:
                none = pa.nulls(len(u), pa.int64())
                yield pa.RecordBatch.from_arrays([none, none, pa.array(u), pa.array(v)], ["cid", "links", "u", "v"])

        def counts(rows: _Rows) -> Iterator[pa.RecordBatch]:
            k = np.flatnonzero(rows.links)
            if len(k):
                none = pa.nulls(len(k), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(rows.cid[k]), pa.array(rows.links[k]), none, none], ["cid", "links", "u", "v"])

        def settle() -> Iterator[pa.RecordBatch]:
            """All at home in the block have come: compares them with each other."""
            nonlocal hosts
            if hosts is None and here:
                hosts = _Rows.joined(here)
                yield from edges(compare(hosts, hosts, key[1]))

        for batch in batches:
            if not batch.num_rows:
                continue
            dim, cell, block_no = (batch[c].to_numpy() for c in ("dim", "cell", "block"))
            guest = batch["guest"].to_numpy(zero_copy_only=False)
            change = np.flatnonzero((dim[1:] != dim[:-1]) | (cell[1:] != cell[:-1]) | (block_no[1:] != block_no[:-1]) | (guest[1:] != guest[:-1])) + 1
            cuts = [0, *change.tolist(), batch.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                now = (int(dim[lo]), int(cell[lo]), int(block_no[lo]))
                if now != key:
                    yield from settle()
                    if hosts is not None:
                        yield from counts(hosts)
                    key, here, hosts = now, [], None
                rows = _Rows(batch.slice(lo, hi - lo), now[0])
                if not guest[lo]:
                    here.append(rows)
                    continue
                yield from settle()
                if hosts is not None:
                    yield from edges(compare(rows, hosts, now[1]))
                    yield from counts(rows)
        yield from settle()
        if hosts is not None:
            yield from counts(hosts)

    ordered = visits.repartition("dim", "cell", "block").sortWithinPartitions("dim", "cell", "block", "guest")
    return ordered.mapInArrow(run, "cid bigint, links bigint, u bigint, v bigint")


def embedding_components(
    embeddings: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    threshold: float = THRESHOLD,
    probes: int = PROBES,
    sample: int = SAMPLE,
    block: int = BLOCK,
    confidence: float = CONFIDENCE,
) -> DataFrame:
    """One row per vector: id, ``n_links``, ``component_id``, ``kept``.

    ``n_links`` counts the other vectors of cosine ``threshold`` or more,
    copies included; ``component_id`` is the smallest id reachable;
    ``kept`` says whether it is the row's own.

    Vectors that are null, empty, zero, or hold a null or non-finite
    component link with nothing, and neither do vectors of different
    lengths. Rows that repeat a vector link with each other. Null ids take
    part, but name a component only if all its ids are null. An empty table
    gives an empty result.
    """
    spark = embeddings.sparkSession
    rows = scratch(_rows(embeddings, id_col, vec_col), "vectors")
    classes = scratch(
        rows.where("vec is not null").groupBy("vec").agg(F.first("dim").alias("dim"), F.min("id").alias("least"), F.count(F.lit(1)).alias("copies")).withColumn("cid", F.monotonically_increasing_id()),
        "classes",
    )
    dims = [(r["dim"], r["n"]) for r in classes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy("dim").collect()]
    if dims:
        index = scratch(_index(classes, _centres(classes, dims, sample), probes), "index")
        found = scratch(_links(index, threshold, confidence, block), "links")
    else:
        found = spark.createDataFrame([], "cid bigint, links bigint, u bigint, v bigint")
    counts = found.where("cid is not null").groupBy("cid").agg(F.sum("links").alias("links"))
    joined = connected_components(found.where("u is not null")).withColumnRenamed("node", "cid")
    known = classes.join(counts, "cid", "left").join(joined, "cid", "left")
    known = scratch(known.select("vec", "least", F.coalesce("root", "cid").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "members")
    named = known.groupBy("root").agg(F.min("least").alias("component_id"))
    member = known.join(named, "root").select("vec", "n_links", "component_id")
    out = rows.join(member, "vec", "left")
    component = F.when(F.col("vec").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
