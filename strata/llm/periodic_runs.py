"""Periodic runs of words: Kruskal over descending LCPs, and texts without their repeats.

Inside one document, suffixes are sorted by prefix doubling and the common
prefix of each with the one sorted before it is found (their LCP). Neighbours
in that order are united from the greatest LCP down. Each class keeps its
positions in order, so a union shows which positions become neighbours in the
text: two of them at a distance within the LCP seed a run, whose period is the
distance and whose length is distance plus LCP. A seed counts where the words
before its two positions differ, which is where the run starts.

Why that finds each run once, with its smallest period: at the LCP ``l`` of a
run's start ``i`` with ``i + q``, a class member between the two would give
the run a smaller period (``l`` is at least ``q``), so the two are neighbours
when the class of that LCP is complete. They were not in one class before,
since their LCP is not greater. For the same reason a seed's distance is the
smallest period: a smaller one divides it and would put a member between.

Only positions whose next ``lcp_floor`` words occur again in the document can
start a run that is long enough. A window hash finds candidates, which may
hold too many but never too few; everything after it compares words.

Memory: documents are taken in chunks of ``CHUNK`` bytes of text, a longer
document alone; a document of ``n`` words needs about 200 bytes a word while
it is solved, and time ``n log n``.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_batches, utf8

MIN_LENGTH = 24
MIN_EXPONENT = 3
CHUNK = 4 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BLOCK = 1024

Run = tuple[int, int, int]  # start, length, period


def lcp_floor(min_length: int, min_exponent: int) -> int:
    """The least LCP of a run's start with the place one period on, over all periods."""
    return max(1, min(max(min_length, min_exponent * q) - q for q in range(1, min_length + 2)))


class Positions:
    """An ordered set of positions in sorted blocks, so that adding one moves a block at most."""

    def __init__(self, first: int):
        self.blocks = [[first]]
        self.least = [first]
        self.size = 1

    def add(self, x: int) -> tuple[int, int]:
        """Adds ``x``; the positions before and after it, -1 where there is none."""
        at = max(bisect_right(self.least, x) - 1, 0)
        block = self.blocks[at]
        k = bisect_left(block, x)
        before = block[k - 1] if k else -1
        after = block[k] if k < len(block) else self.least[at + 1] if at + 1 < len(self.least) else -1
        block.insert(k, x)
        self.least[at] = block[0]
        self.size += 1
        if len(block) > _BLOCK:
            self.blocks.insert(at + 1, block[_BLOCK // 2 :])
            del block[_BLOCK // 2 :]
            insort(self.least, self.blocks[at + 1][0])
        return before, after

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block


def _window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of the ``width`` words from each place, from hashes of blocks of 1, 2, 4, ... words."""
    out = np.zeros(len(hashes), np.uint64)
    block, size, covered, factor = hashes.copy(), 1, 0, _BASE

    def ahead(a: np.ndarray, by: int) -> np.ndarray:
        return np.concatenate([a[by:], np.zeros(min(by, len(a)), np.uint64)])

    while size <= width:
        if width & size:
            out = out * factor + ahead(block, covered)
            covered += size
        block = block * factor + ahead(block, size)
        factor = factor * factor
        size *= 2
    return out


def _repeated(texts: list[list[bytes]], width: int) -> list[bool]:
    """Which documents may hold ``width`` words in a row twice; never False for one that does."""
    sizes = np.array([len(w) for w in texts])
    flat = np.fromiter((hash(w) for words in texts for w in words), np.int64, sizes.sum()).view(np.uint64)
    doc = np.repeat(np.arange(len(texts)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(flat))
    whole = left >= width
    with np.errstate(over="ignore"):
        keys = (_window_hashes(flat, width) ^ (doc.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)))[whole]
    order = np.argsort(keys)
    again = keys[order[1:]] == keys[order[:-1]]
    found = np.zeros(len(texts), bool)
    found[doc[whole][order[1:][again]]] = True
    return found.tolist()


def _ranked(symbols: np.ndarray, width: int) -> tuple[int, np.ndarray]:
    """The greatest power of two up to ``width``, and the positions whose next so many words occur again, in suffix order.

    A rank is the number of smaller suffixes as far as they are told apart, so
    a round renames only the positions that are still tied.
    """
    n = len(symbols)
    rank = np.empty(n, np.int64)
    tied = np.arange(n)
    second = np.zeros(n, np.int64)
    first, size, wide, chosen = symbols.astype(np.int64), 0, 1, tied
    while len(tied):
        order = np.lexsort((second, first))
        a, b, tied = first[order], second[order], tied[order]
        new_group = np.concatenate([[True], a[1:] != a[:-1]])
        new_key = new_group | np.concatenate([[True], b[1:] != b[:-1]])
        places = np.arange(len(tied))
        group_at = np.maximum.accumulate(np.where(new_group, places, 0))
        key_at = np.maximum.accumulate(np.where(new_key, places, 0))
        # In the first round all positions are one group of rank 0.
        rank[tied] = key_at if size == 0 else a + key_at - group_at
        lone = new_key & np.concatenate([new_key[1:], [True]])
        tied = tied[~lone]
        size = max(1, size * 2)
        if size <= width:
            wide, chosen = size, tied
        first = rank[tied]
        ahead = tied + size
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)], -1)
    return wide, chosen[np.argsort(rank[chosen])]


def _lcps(symbols: list[int], order: list[int], wide: int) -> list[int]:
    """The common prefix of each listed suffix with the one listed before it (0 for the first).

    All suffixes that share ``wide`` words with another are listed, so a common
    prefix of more carries over to the next position, less one word.
    """
    before = dict(zip(order[1:], order))
    found = dict.fromkeys(order[:1], 0)
    n, length, last = len(symbols), 0, -2
    for i in sorted(before):
        length = length - 1 if i == last + 1 and length > wide else 0
        j = before[i]
        while i + length < n and j + length < n and symbols[i + length] == symbols[j + length]:
            length += 1
        found[i], last = length, i
    return [found[i] for i in order]


def runs_of(words: list[bytes], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[Run]:
    """All runs of ``words`` by start, then period; see :func:`find_runs`."""
    floor = lcp_floor(min_length, min_exponent)
    number: dict[bytes, int] = {}
    symbols = [number.setdefault(w, len(number)) for w in words]
    n = len(symbols)
    if n < 2:
        return []
    wide, chosen = _ranked(np.array(symbols), floor)
    order = chosen.tolist()
    lcps = np.array(_lcps(symbols, order, wide), np.int64)
    links = np.flatnonzero(lcps >= floor)
    links = links[np.argsort(-lcps[links], kind="stable")]
    parent: dict[int, int] = {}
    members: dict[int, Positions] = {}
    runs = []

    def find(i: int) -> int:
        while (up := parent.setdefault(i, i)) != i:
            parent[i] = parent[up]
            i = up
        return i

    def unite(i: int, j: int) -> Iterator[tuple[int, int]]:
        """Joins two classes; yields pairs of neighbours that come from different ones."""
        a, b = find(i), find(j)
        mine, other = members.pop(a, None) or Positions(a), members.pop(b, None) or Positions(b)
        if mine.size < other.size:
            a, b, mine, other = b, a, other, mine
        parent[b] = a
        members[a] = mine
        added = [*other, n]
        last = -1
        for x, following in zip(added, added[1:]):
            before, after = mine.add(x)
            if before > last:
                yield before, x
            if 0 <= after < following:
                yield x, after
            last = x

    for level in np.split(links, np.flatnonzero(np.diff(lcps[links])) + 1) if len(links) else ():
        lcp = int(lcps[level[0]])
        # A later union of the same level may put a member between two
        # neighbours, so the nearest place after each start counts.
        nearest: dict[int, int] = {}
        for at in level.tolist():
            for i, j in unite(order[at - 1], order[at]):
                if j - i <= lcp:
                    nearest[i] = min(j, nearest.get(i, j))
        for i, j in nearest.items():
            length, period = lcp + j - i, j - i
            if length >= max(min_length, min_exponent * period) and (i == 0 or symbols[i - 1] != symbols[j - 1]):
                runs.append((i, length, period))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """``words`` joined by single spaces, without what any run holds after its first period."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return b" ".join(w for w, inside in zip(words, np.cumsum(change).tolist()) if not inside)


def _chunks(texts: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``limit`` bytes, one row at least."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        n = len(text.as_buffer())
        if size + n > limit and i > start:
            yield start, i
            start, size = i, 0
        size += n
    yield start, len(texts)


def find_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_exponent: int = MIN_EXPONENT,
) -> DataFrame:
    """One row per document: id, ``n_words``, ``runs`` and ``collapsed``.

    Words are stretches without ASCII white space, numbered from 0. A run is a
    stretch of consecutive words with smallest period ``period`` (words that
    far apart are identical), at least ``min_length`` words and
    ``min_exponent`` (2 or more) periods long, that can't be extended at
    either end. ``runs`` lists ``start, length, period`` by start, then
    period. ``collapsed`` keeps each word that no run holds after its first
    period, joined by single spaces.

    Null and empty texts have no words, no runs and an empty ``collapsed``.
    Runs may overlap; all are listed. A null id stays null; repeated rows each
    get their row; an empty table gives an empty result. Texts of any length
    are taken whole. Other columns of ``docs`` are left out, so none clashes.
    """
    if min_exponent < 2:
        raise ValueError("min_exponent must be 2 or more")
    key = "strata_id"
    src = docs.select(F.col(id_col).alias(key), utf8(text_col).alias("text"))
    kind = src.schema[key].dataType.simpleString()
    floor = lcp_floor(min_length, min_exponent)

    def solve(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for start, end in _chunks(batch["text"], CHUNK):
            texts = [t.split() for t in batch["text"].slice(start, end - start).to_pylist()]
            found = [runs_of(w, min_length, min_exponent) if maybe else [] for w, maybe in zip(texts, _repeated(texts, floor))]
            flat = np.array([r for runs in found for r in runs], np.int64).reshape(-1, 3)
            runs = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], ["start", "length", "period"])
            offsets = np.concatenate([[0], np.cumsum([len(r) for r in found])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch[key].slice(start, end - start),
                    pa.array([len(w) for w in texts], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), runs),
                    pa.array([collapsed(w, r).decode("utf-8", errors="replace") for w, r in zip(texts, found)], pa.string()),
                ],
                [key, "n_words", "runs", "collapsed"],
            )

    struct = "struct<start:bigint,length:bigint,period:bigint>"
    out = map_batches(src, solve, f"{key} {kind}, n_words bigint, runs array<{struct}>, collapsed string")
    return out.withColumnRenamed(key, id_col)


def with_cycles(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with a repeating tail in the texts whose id hash ``h`` divides by ten.

    ``h`` is the CRC-32 of the decimal id and ``g`` its tenth. From word
    ``a = g % n`` on, word ``i`` becomes word ``a + (i - a) % p`` with
    ``p = 1 + floor((n - a) / (3 + g % 8))``; the words are joined by single
    spaces. Other texts, texts without words and rows without an id are left
    as they are.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    g = F.floor(h / 10)
    plain = F.col(text_col)
    # Only texts that change are split: the condition guards the columns below.
    words = F.filter(F.split(plain, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    state, cycled = "_strata_cycle", "_strata_words"
    out = docs.withColumn(cycled, F.when((h % 10 == 0) & plain.rlike(r"[^\x20\x09-\x0D]"), words))
    n = F.size(cycled)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    out = out.withColumn(state, F.when(F.col(cycled).isNotNull(), F.struct(n.alias("n"), a.alias("a"), p.alias("p"))))
    s = F.col(state)
    period = F.slice(cycled, s["a"] + 1, s["p"])
    tail = F.transform(F.sequence(s["a"], s["n"] - 1), lambda i: F.get(period, (i - s["a"]) % s["p"]))
    text = F.array_join(F.concat(F.slice(cycled, F.lit(1), s["a"]), tail), " ")
    return out.withColumn(text_col, F.when(s.isNull(), plain).otherwise(text)).drop(state, cycled)
