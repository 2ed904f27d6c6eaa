"""Alignment of two tokenizers' tokens over the same bytes, in windows between white-space anchors.

Each text is tokenised in full by both, ``A`` (byte-level BPE) and ``B``
(SentencePiece). Byte offsets where a token of each ends cut the tokens into
groups; all pairs of an A and a B token of one group are linked. A shared end
that is followed by a space-marked token on both sides is an anchor. Anchors
split a document into windows of token ids, mostly one word long, and a
window's alignment depends on its two id tuples alone, so it is solved once
per task and looked up afterwards.

Corpus counts (in how many documents a pair of ids is linked) are exact:
documents hold each linked pair once with its number of links, written to the
shared folder; counts are summed map-side first. The ``FREQUENT`` most common
pairs are broadcast to look their counts up; all others meet their counts in
a shuffle join, in which no key is hot, because a pair outside the frequent
ones is in no more documents than the rarest of those.

Bounds: ``CHUNK`` characters of text at a time (a longer document alone);
the memo of windows starts anew when it is full; windows of more than
``KEY / 4`` tokens on a side are aligned each time. The broadcast
holds ``FREQUENT`` pairs of ids with their counts at any size of the corpus.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import free_name, released, scratch, utf8

CHUNK = 1 << 20
MEMO_WINDOWS = 120_000
KEY = 32
FREQUENT = 1 << 19

# Scripts whose letters, digits and spaces have long been settled, so that two
# libraries cut them into pre-tokens alike (checked for each character in the
# tests). Texts with any other character are encoded by the file's own library.
_OTHER = regex.compile("[^\x00-ɏΑ-ΡΣ-ωА-я‐-‧‰-⁞€ぁ-ゖァ-ヺ一-龥가-힣！-～]")


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable Latin-1 characters stand for themselves, the other bytes for
    the characters from U+0100 on, in order.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(0x100 + k): b for k, b in enumerate(others)}


class Tokens:
    """Both tokenizers, with the bytes of every token id; built per task."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        alphabet = byte_alphabet()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            bytes_a[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.bytes_a, self.bytes_b = bytes_a, bytes_b
        self.size_a = np.array([len(t) for t in bytes_a], np.int64)
        self.size_b = np.array([len(t) for t in bytes_b], np.int64)
        self.space_a = np.array([t[:1] == b" " for t in bytes_a])
        self.space_b = np.array([p[:1] == "▁" for p in pieces])
        # Decimal ids as they stand in groups: the first of a side, and those after it.
        marks = (("", bytes_a), (",", bytes_a), ("|", bytes_b), (",", bytes_b))
        self.names = pa.array([mark + str(i) for mark, side in marks for i in range(len(side))], pa.string())
        self.names_b = 2 * len(bytes_a)
        self._ranks = self._by_rank(path_a, bytes_a)

    def _by_rank(self, path_a: str, bytes_a: list[bytes]) -> tiktoken.Encoding | None:
        """The same vocabulary for the quicker encoder, where ids follow the merges and each merge makes a token of its own."""
        with open(path_a, encoding="utf-8") as file:
            model = json.load(file)["model"]
        made = [m.replace(" ", "") if isinstance(m, str) else "".join(m) for m in model["merges"]]
        order = [model["vocab"].get(m, -1) for m in made]
        if len(set(made)) < len(made) or order != sorted(order) or order[:1] != [256]:
            return None
        ranks = {bytes_a[i]: i for i in model["vocab"].values()}
        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        """Ids of each whole text."""
        out: list[list[int]] = [[]] * len(texts)
        rest = []
        for k, text in enumerate(texts):
            if self._ranks is None or _OTHER.search(text):
                rest.append(k)
            else:
                out[k] = self._ranks.encode_ordinary(text)
        for k, e in zip(rest, self.a.encode_batch_fast([texts[k] for k in rest], add_special_tokens=False)):
            out[k] = e.ids
        return out

    def encode_b(self, texts: list[str]) -> list[list[int]]:
        return self.b.encode(texts, num_threads=1)


def _offsets(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def _spread(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places ``begin .. begin + size`` of each entry, one after another."""
    return np.repeat(begin - _offsets(size)[:-1], size) + np.arange(size.sum())


def shared_ends(a: np.ndarray, b: np.ndarray, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens of each side end at or before every byte offset where both end."""
    end_a, end_b = np.cumsum(tokens.size_a[a]), np.cumsum(tokens.size_b[b])
    place = np.full(int(end_a[-1]) + 1 if len(a) else 1, -1, np.int64)
    place[end_b] = np.arange(len(b))
    match = place[end_a]
    found = np.flatnonzero(match >= 0)
    return found + 1, match[found] + 1


class Windows:
    """Aligned windows, memoised by their two id tuples and numbered in the order they were met.

    The memo is columnar: a key of ``KEY`` bytes holds up to eight ids of
    each side (plus one, so that an absent id is 0), and equal keys are equal
    id tuples. Longer windows are aligned each time they occur.
    """

    def __init__(self, tokens: Tokens):
        self.tokens = tokens
        self.packs = max(len(tokens.size_a), len(tokens.size_b)) < 1 << 16
        self.clear()

    def clear(self) -> None:
        self.keys = pa.array([], pa.binary(KEY))
        self.texts = pa.array([], pa.string())
        self.groups, self.links, self.pairs = (np.zeros(0, np.int64) for _ in range(3))

    def full(self) -> bool:
        return len(self.texts) > MEMO_WINDOWS or len(self.pairs) > 10 * MEMO_WINDOWS

    def numbers(self, a: np.ndarray, b: np.ndarray, from_a: np.ndarray, to_a: np.ndarray, from_b: np.ndarray, to_b: np.ndarray) -> np.ndarray:
        """The number of each window ``a[from_a:to_a]``, ``b[from_b:to_b]``; new ones are aligned."""
        size_a, size_b = to_a - from_a, to_b - from_b
        short = (size_a <= KEY // 4) & (size_b <= KEY // 4) & self.packs
        packed = np.zeros((int(short.sum()), KEY // 2), np.uint16)
        for half, ids, begin, size in ((0, a, from_a[short], size_a[short]), (KEY // 4, b, from_b[short], size_b[short])):
            for k in range(KEY // 4):
                there = np.flatnonzero(size > k)
                packed[there, half + k] = ids[begin[there] + k] + 1
        kinds = pa.Array.from_buffers(pa.binary(KEY), len(packed), [None, pa.py_buffer(packed.tobytes())]).dictionary_encode()
        same = kinds.indices.to_numpy(zero_copy_only=False)
        number = pc.index_in(kinds.dictionary, value_set=self.keys).to_numpy(zero_copy_only=False).astype(np.float64)
        new = np.flatnonzero(np.isnan(number))
        number[new] = len(self.texts) + np.arange(len(new))
        # The aligned ones: the first window of each new kind, then all long ones.
        first = np.empty(len(kinds.dictionary), np.int64)
        first[same[::-1]] = np.flatnonzero(short)[::-1]
        long = np.flatnonzero(~short)
        at = np.concatenate([first[new], long])
        out = np.empty(len(from_a), np.int64)
        out[short] = number.astype(np.int64)[same]
        out[long] = len(self.texts) + len(new) + np.arange(len(long))
        self.keys = pa.concat_arrays([self.keys, kinds.dictionary.take(pa.array(new)), pa.nulls(len(long), pa.binary(KEY))])
        self._align(a[_spread(from_a[at], size_a[at])], b[_spread(from_b[at], size_b[at])], size_a[at], size_b[at])
        return out

    def _align(self, a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> None:
        """Adds windows whose tokens lie one after another in ``a`` and ``b``."""
        to_a, to_b = shared_ends(a, b, self.tokens)
        count_a, count_b = np.diff(to_a, prepend=0), np.diff(to_b, prepend=0)
        window = np.searchsorted(np.cumsum(size_a), to_a, side="left")
        # Pairs: each A token of a group with each B token of it, the B side running fastest.
        per_a = np.repeat(count_b, count_a)
        pair_a = np.repeat(a.astype(np.int64), per_a)
        pair_b = b[_spread(np.repeat(to_b - count_b, count_a), per_a)]
        groups = np.bincount(window, minlength=len(size_a))
        links = np.bincount(window, weights=count_a * count_b, minlength=len(size_a)).astype(np.int64)
        # Names: the A ids of a group, then its B ids; the first of each side has its own mark.
        total = count_a + count_b
        rank = np.arange(total.sum()) - np.repeat(_offsets(total)[:-1], total)
        split = np.repeat(count_a, total)
        on_a = rank < split
        code = np.empty(len(rank), np.int64)
        code[on_a] = a + np.where(rank[on_a] == 0, 0, len(self.tokens.size_a))
        code[~on_a] = self.tokens.names_b + b + np.where(rank[~on_a] == split[~on_a], 0, len(self.tokens.size_b))
        spelled = _joined(self.tokens.names.take(pa.array(code)), _offsets(total), "")
        self.texts = pa.concat_arrays([self.texts, _joined(spelled, _offsets(groups), ";")])
        self.groups = np.concatenate([self.groups, groups])
        self.links = np.concatenate([self.links, links])
        self.pairs = np.concatenate([self.pairs, pair_a << 32 | pair_b])


def _joined(parts: pa.StringArray, offsets: np.ndarray, separator: str) -> pa.StringArray:
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), parts), separator)


def _lossless(texts: list[bytes], ids: list[list[int]], spelled: list[bytes]) -> list[bool]:
    """Whether the tokens of each text give its bytes."""
    return [b"".join(map(spelled.__getitem__, i)) == t for t, i in zip(texts, ids)]


def _chunk(texts: list[str], tokens: Tokens, windows: Windows) -> dict[str, pa.Array]:
    """The aligned columns of some documents."""
    if windows.full():
        windows.clear()
    n = len(texts)
    with_text = [k for k in range(n) if texts[k]]
    spaced = [" " + texts[k] for k in with_text]
    ids_a = tokens.encode_a(spaced)
    ids_b = tokens.encode_b([texts[k] for k in with_text]) if with_text else []
    whole = [t.encode() for t in spaced]
    good = zip(_lossless(whole, ids_a, tokens.bytes_a), _lossless(whole, ids_b, tokens.bytes_b))
    sides: list[tuple[list[int], list[int]]] = [([], [])] * n
    for k, a, b, ok in zip(with_text, ids_a, ids_b, good):
        if all(ok):
            sides[k] = (a, b)
    count_a = np.array([len(a) for a, _ in sides], np.int64)
    count_b = np.array([len(b) for _, b in sides], np.int64)
    a = np.fromiter(chain.from_iterable(s[0] for s in sides), np.int32, count_a.sum())
    b = np.fromiter(chain.from_iterable(s[1] for s in sides), np.int32, count_b.sum())

    # Documents lie one after another in one range of bytes; both sides end with each.
    to_a, to_b = shared_ends(a, b, tokens)
    doc_ends = np.cumsum(count_a)
    marked = np.zeros(len(to_a), bool)
    inside = to_a < len(a)
    marked[inside] = tokens.space_a[a[to_a[inside]]] & tokens.space_b[b[to_b[inside]]]
    anchor = marked | np.isin(to_a, doc_ends)
    to_a, to_b = to_a[anchor], to_b[anchor]
    numbers = windows.numbers(a, b, np.concatenate([[0], to_a[:-1]]).astype(np.int64)[: len(to_a)], to_a, np.concatenate([[0], to_b[:-1]]).astype(np.int64)[: len(to_b)], to_b)

    doc = np.searchsorted(doc_ends, to_a, side="left")
    per_doc = _offsets(np.bincount(doc, minlength=n))
    groups, links = windows.groups[numbers], windows.links[numbers]
    pair = windows.pairs[_spread(_offsets(windows.links)[numbers], links)]
    pair_doc = np.repeat(doc, links)
    if len(tokens.size_a) <= 1 << 16 and len(tokens.size_b) <= 1 << 16 and n < 1 << 30:
        keys, times = np.unique(pair_doc << 32 | pair >> 32 << 16 | pair & 0xFFFF, return_counts=True)
        pair_doc, left, right = keys >> 32, keys >> 16 & 0xFFFF, keys & 0xFFFF
    else:
        (pair_doc, pair), times = np.unique(np.stack([pair_doc, pair]), axis=1, return_counts=True)
        left, right = pair >> 32, pair & 0xFFFFFFFF
    struct = pa.StructArray.from_arrays([pa.array(left.astype(np.int32)), pa.array(right.astype(np.int32)), pa.array(times.astype(np.int64))], ["a", "b", "n"])
    return {
        "n_a": pa.array(count_a),
        "n_b": pa.array(count_b),
        "n_groups": pa.array(np.diff(_offsets(groups)[per_doc])),
        "n_links": pa.array(np.diff(_offsets(links)[per_doc])),
        "groups": _joined(windows.texts.take(pa.array(numbers)), per_doc, ";"),
        "pairs": pa.ListArray.from_arrays(pa.array(_offsets(np.bincount(pair_doc, minlength=n)).astype(np.int32)), struct),
    }


def align_tokens(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups`` and ``pairs``.

    A space and the text are encoded by the ``tokenizers`` file ``path_a``,
    the text (to which it adds the space) by the SentencePiece model
    ``path_b``; strings of special tokens are plain text. ``groups`` reads
    ``a1,a2|b1;a3|b2,b3``: decimal ids in order. ``pairs`` lists each linked
    pair of ids ``a, b`` once with its ``n`` links in the document.

    Null and empty texts, and texts that either side does not give back byte
    by byte (U+2581 in the text, say), have no tokens: zeros, an empty string
    and an empty list. Repeated rows each get their row, an empty table gives
    an empty result, texts of any length are taken whole, and other columns
    are left out, so none clashes.
    """
    key = "strata_id"
    src = docs.select(F.col(id_col).alias(key), utf8(text_col).alias("text"))
    kind = src.schema[key].dataType.simpleString()

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(path_a, path_b)
        windows = Windows(tokens)
        for batch in batches:
            texts = [t.decode("utf-8", errors="replace") for t in batch["text"].to_pylist()]
            start, size = 0, 0
            for i in range(len(texts) + 1):
                if i == len(texts) or i > start and size + len(texts[i]) > CHUNK:
                    if i > start:
                        columns = _chunk(texts[start:i], tokens, windows)
                        yield pa.RecordBatch.from_arrays([batch[key].slice(start, i - start), *columns.values()], [key, *columns])
                    start, size = i, 0
                size += len(texts[i]) if i < len(texts) else 0

    schema = f"{key} {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, pairs array<struct<a:int,b:int,n:bigint>>"
    return src.mapInArrow(released(align), schema).withColumnRenamed(key, id_col)


def link_counts(aligned: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """``aligned`` with ``n_best`` and ``count_sum`` in place of ``pairs``.

    A pair's count is the number of rows of ``aligned`` that hold it.
    ``count_sum`` adds the counts over a row's links; ``n_best`` is how many
    links have the highest count of their A id, ties included. Rows without
    pairs get zeros; repeated and null ids are separate rows.
    """
    row = free_name(aligned, "strata_row")
    base = scratch(aligned.withColumn(row, F.monotonically_increasing_id()), "aligned")
    linked = base.select(row, F.explode("pairs").alias("pair")).select(row, _pair("pair").alias("pair"), F.col("pair.n").alias("n"))
    counted = linked.groupBy("pair").agg(F.count(F.lit(1)).alias("docs"))
    highest = Window.partitionBy(F.shiftright("pair", 32))
    counted = scratch(counted.withColumn("best", F.col("docs") == F.max("docs").over(highest)), "pair-counts")

    top = scratch(counted.orderBy(F.desc("docs"), "pair").limit(frequent).coalesce(1), "frequent-pairs")
    known = F.broadcast(top)
    rest = linked.join(known, "pair", "left_anti").join(counted.hint("merge"), "pair")
    sums = [F.sum(F.col("n") * F.col("docs")).alias("count_sum"), F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best")]
    by_row = linked.join(known, "pair").groupBy(row).agg(*sums).unionByName(rest.groupBy(row).agg(*sums))
    by_row = by_row.groupBy(row).agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))
    out = base.drop("pairs").join(by_row, row, "left")
    return out.withColumns({c: F.coalesce(c, F.lit(0)).cast("bigint") for c in ("n_best", "count_sum")}).drop(row)


def _pair(pair: str):
    return F.shiftleft(F.col(f"{pair}.a").cast("bigint"), 32).bitwiseOR(F.col(f"{pair}.b").cast("bigint"))
