"""Token counts by a two-tier lookup of pre-token lengths on the map side.

Tier one is a broadcast table with the lengths of the corpus's most frequent
pre-tokens; tier two is a bounded cache in each Python worker that encodes
what tier one misses, once. Counts are then sums of table lookups; texts and
pre-tokens are never shuffled.

A pre-token here is a run without ASCII white space. The tokenizer drops
white space and no merge, normalisation or special string spans it, so a
text's count is the sum over its pre-tokens.

Bounds: tier one holds ``frequent`` entries of at most ``max_bytes`` bytes
(1 MB by default), chosen by counts over all documents, of which each task
contributes a bounded summary; tier two holds ``cache`` entries and starts
anew when it is full. Longer pre-tokens are encoded each time they occur.
The tables only decide what is looked up, never the counts.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import decode, map_batches, utf8

FREQUENT = 32_768
MAX_BYTES = 32
CACHE = 400_000
_SUMMARY = 4_096
_COUNTER = 200_000


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _fold(text: bytes) -> bytes:
    """Lower-cased A-Z: the tokenizer does so itself, but for its special strings."""
    return text if b"<|" in text else text.lower()


def encoded_lengths(path: str, words: list[bytes]) -> list[int]:
    tokenizer = _tokenizer(path)
    return [len(e.ids) for e in tokenizer.encode_batch_fast([decode(w) for w in words], add_special_tokens=False)]


def frequent_pretokens(docs: DataFrame, text_col: str = "text", entries: int = FREQUENT, max_bytes: int = MAX_BYTES) -> list[bytes]:
    """The most frequent pre-tokens over all documents, at most ``entries``.

    Each task keeps a bounded counter (the rarer half is dropped when it is
    full) and hands on its ``_SUMMARY`` most frequent pre-tokens, so what is
    shuffled and collected is bounded by tasks and entries.
    """

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch["text"].to_pylist():
                counts.update(_fold(text).split())
                if len(counts) > _COUNTER:
                    counts = Counter(dict(counts.most_common(_COUNTER // 2)))
        top = [(w, n) for w, n in counts.most_common(_SUMMARY) if len(w) <= max_bytes]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in top], pa.binary()), pa.array([n for _, n in top], pa.int64())], ["word", "n"])

    summaries = docs.select(utf8(text_col).alias("text")).mapInArrow(summarise, "word binary, n bigint")
    ranked = summaries.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(entries)
    return [bytes(r["word"]) for r in ranked.select("word").collect()]


class _Lengths(dict):
    """Pre-token lengths: the pinned frequent ones, and a bounded cache of others."""

    def __init__(self, path: str, frequent: dict[bytes, int], limit: int, max_bytes: int):
        super().__init__(frequent)
        self.path, self.frequent, self.limit, self.max_bytes = path, frequent, limit, max_bytes

    def learn(self, words: set[bytes]) -> None:
        """Encodes the unknown short ones among ``words`` in one call."""
        new = [w for w in words if w not in self and len(w) <= self.max_bytes]
        if len(self) + len(new) > self.limit + len(self.frequent):
            self.clear()
            self.update(self.frequent)
        self.update(zip(new, encoded_lengths(self.path, new)))

    def __missing__(self, word: bytes) -> int:
        return encoded_lengths(self.path, [word])[0]


def token_counts(
    docs: DataFrame,
    tokenizer_path: str,
    limit: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
    frequent: int = FREQUENT,
    max_bytes: int = MAX_BYTES,
    cache: int = CACHE,
) -> DataFrame:
    """One row per document: id, ``n_bytes``, ``n_tokens``, ``over_limit`` (more than ``limit`` tokens).

    Counts equal the library's ``encode`` of the whole text without added
    special tokens, truncation or padding. Null and empty texts have no bytes
    and no tokens; repeated rows each get their row; an empty table gives an
    empty result.
    """
    key = "strata_id"
    src = docs.select(F.col(id_col).alias(key), utf8(text_col).alias("text"))
    kind = src.schema[key].dataType.simpleString()
    words = frequent_pretokens(docs, text_col, frequent, max_bytes)
    shared = docs.sparkSession.sparkContext.broadcast(dict(zip(words, encoded_lengths(tokenizer_path, words))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = _Lengths(tokenizer_path, shared.value, cache, max_bytes)
        for batch in batches:
            texts = batch["text"].to_pylist()
            counts = []
            for at in range(0, len(texts), 256):
                split = [_fold(t).split() for t in texts[at : at + 256]]
                lengths.learn(set().union(*split))
                counts += [sum(map(lengths.__getitem__, ws)) for ws in split]
            n_bytes = [len(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch[key], pa.array(n_bytes, pa.int64()), pa.array(counts, pa.int64()), pa.array([n > limit for n in counts], pa.bool_())],
                [key, "n_bytes", "n_tokens", "over_limit"],
            )

    out = src.mapInArrow(count, f"{key} {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
    return out.withColumnRenamed(key, id_col)
