"""Quality classifier: an interpolated modified Kneser-Ney model over characters.

Training counts the character n-grams of all trusted text, by language;
continuation counts, discounts and context totals follow by grouping and
joining the count tables on their keys, spread over the cluster. Each n-gram
gets its interpolated probability and each context its back-off weight.

Characters are numbered by language. A language with more characters than
``BITS`` bits can number writes its rarer ones as two symbols, so that no
trusted character is lost.

Scoring needs no shuffle of texts: models of whole languages are put together
to packs of at most ``PACK_ROWS`` rows, each broadcast and joined with the
n-grams of its languages' documents where they lie. The model of a language
beyond that is cut into shards by the last symbol but one (which an n-gram,
the shorter ones it backs off to and the contexts involved have in common);
its packs are broadcast one after another, every n-gram is scored in exactly
one, and the documents' sums and symbol scores are carried on.

A document is accepted if its perplexity is at most its language's quantile
over trusted documents that were held out of training (one in ``HOLDOUT``, by
a hash of the id), times a margin, and if none of its stretches is out of the
ordinary: the costliest word, and the costliest and the cheapest window of
``WINDOW`` characters, are each held against the same quantile over the
held-out documents, adjusted for the document's length. Instead of a margin
these limits are widened by ``ERRORS`` standard errors, which matters where few
documents were held out. A language has these limits only if enough documents
were held out to tell the quantile (200 for 0.995): the largest of fewer would
turn away more of the clean ones than the quantile says.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import released, decode, map_batches, scratch, utf8

ORDER = 5
BITS = 12
PACK_ROWS = 1_000_000
QUANTILE = 0.995
MARGIN = 1.25
HOLDOUT = 5
WINDOW = 128
WORD = 64
ERRORS = 3.0
BROADCAST_IDS = 1_000_000
_KEYS = 500_000
_START = 1


_TRAIL_BITS = 11
_LEADS = 0x110000 >> _TRAIL_BITS
_SPACES = np.array([c for c in range(0x110000) if chr(c).isspace()], np.uint32)
_STRETCHES = ("word", "high", "low")


def _points(text: bytes) -> np.ndarray:
    return np.frombuffer(decode(text).encode("utf-32-le", "replace"), np.uint32)


class Alphabet:
    """The symbols of one language's characters, given with the most frequent first.

    Symbol 0 is any character that the language lacks, 1 stands before the
    text. Characters beyond what ``BITS`` bits can number are two symbols: a
    leading one that stands for nothing else, and one for the rest of the bits.
    """

    def __init__(self, points: list[int]):
        room = (1 << BITS) - 2
        wide = len(points) > room
        single = room - _LEADS if wide else room
        self.size = 1 << BITS if wide else len(points) + 2
        codes = [k + 2 if k < single else (2 + single + (p >> _TRAIL_BITS)) << BITS | 2 + (p & ((1 << _TRAIL_BITS) - 1)) for k, p in enumerate(points)]
        known = np.array(points, np.uint32)
        ascending = np.argsort(known)
        self.points, self.codes = known[ascending], np.array(codes, np.uint32)[ascending]

    def symbols(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of a text, and where each character's first one is."""
        at = np.minimum(np.searchsorted(self.points, points), len(self.points) - 1)
        codes = np.where(self.points[at] == points, self.codes[at], 0).astype(np.uint64)
        leads = codes >> np.uint64(BITS)
        starts = np.arange(len(codes))
        if not leads.any():
            return codes, starts
        lengths = 1 + (leads > 0)
        starts = np.cumsum(lengths) - lengths
        symbols = np.repeat(codes & np.uint64((1 << BITS) - 1), lengths)
        symbols[starts[leads > 0]] = leads[leads > 0]
        return symbols, starts


def ngram_keys(symbols: np.ndarray, order: int = ORDER) -> np.ndarray:
    """For each symbol, the n-gram of ``order`` that ends in it, ``BITS`` bits a symbol."""
    ids = np.concatenate([np.full(order - 1, _START, np.uint64), symbols])
    keys = np.zeros(len(symbols), np.uint64)
    for k in range(order):
        keys = (keys << np.uint64(BITS)) | ids[k : k + len(symbols)]
    return keys


def _alphabets(texts: DataFrame) -> dict[str, Alphabet]:
    """Each language's alphabet: all characters of its texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
                points, n = np.unique(_points(text), return_counts=True)
                total = totals.get(lang, np.zeros(0, np.int64))
                if len(total) <= points[-1]:
                    total = np.concatenate([total, np.zeros(int(points[-1]) + 1 - len(total), np.int64)])
                total[points] += n
                totals[lang] = total
        for lang, total in totals.items():
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used.astype(np.int32)), pa.array(total[used])], ["lang", "point", "n"])

    counts = texts.select("lang", "text").mapInArrow(released(count), "lang string, point int, n bigint").groupBy("lang", "point").agg(F.sum("n").alias("n"))
    found: dict[str, list[int]] = {}
    # At most one row for each language and character.
    for r in counts.orderBy("lang", F.desc("n"), "point").collect():
        found.setdefault(r["lang"], []).append(r["point"])
    return {lang: Alphabet(points) for lang, points in found.items()}


def _counts(texts: DataFrame, alphabets: dict[str, Alphabet], order: int) -> DataFrame:
    """``(lang, key, n)``: counts of the n-grams of ``order``, added up in the tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                keys, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n)], ["lang", "key", "n"])

        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
                keys = ngram_keys(alphabets[lang].symbols(_points(text))[0], order)
                held.setdefault(lang, []).append(keys)
                size += len(keys)
                if size >= _KEYS:
                    yield from flush()
                    held, size = {}, 0
        yield from flush()

    return texts.select("lang", "text").mapInArrow(released(run), "lang string, key bigint, n bigint").groupBy("lang", "key").agg(F.sum("n").alias("n"))


def _low(key: Column, chars: int) -> Column:
    return key.bitwiseAND(F.lit((1 << (BITS * chars)) - 1).cast("bigint"))


def _discounts(counts: DataFrame) -> DataFrame:
    """``(lang, d1, d2, d3)`` by the counts of counts; halves where too few are known to estimate them."""
    seen = [F.sum((F.col("n") == c).cast("double")).alias(f"n{c}") for c in (1, 2, 3, 4)]
    y = F.expr("n1 / (n1 + 2 * n2)")
    raw = [F.try_divide(y * (c + 1) * F.col(f"n{c + 1}"), F.col(f"n{c}")) for c in (1, 2, 3)]
    bounded = [F.when(r.isNull(), 0.5 * c).otherwise(F.greatest(F.lit(0.05), F.least(F.lit(c - 0.05), c - r))) for c, r in zip((1, 2, 3), raw)]
    return counts.groupBy("lang").agg(*seen).where("n1 + n2 > 0").select("lang", *[b.alias(f"d{c}") for c, b in zip((1, 2, 3), bounded)])


def train(texts: DataFrame, alphabets: dict[str, Alphabet], order: int = ORDER) -> DataFrame:
    """The model as rows ``(lang, k, kind, key, value)`` of all trusted ``texts (lang, text)``.

    ``kind`` 'p': natural logarithm of an n-gram's interpolated probability;
    'g': of a context's back-off weight (``k`` counts the predicted character too).
    """
    sizes = F.broadcast(texts.sparkSession.createDataFrame([(lang, a.size) for lang, a in alphabets.items()], "lang string, size int"))
    tables = {order: scratch(_counts(texts, alphabets, order), "ngrams")}
    for k in range(order - 1, 0, -1):
        tables[k] = scratch(tables[k + 1].groupBy("lang", _low(F.col("key"), k).alias("key")).agg(F.count(F.lit(1)).alias("n")), "ngrams")
    parts = []
    lower = None
    for k in range(1, order + 1):
        # A row for each language: as many as there are models.
        d = F.broadcast(_discounts(tables[k]))
        n = F.col("n")
        rows = tables[k].join(d, "lang", "left").na.fill({"d1": 0.5, "d2": 1.0, "d3": 1.5})
        cut = F.when(n == 1, F.col("d1")).when(n == 2, F.col("d2")).otherwise(F.col("d3"))
        rows = rows.select("lang", "key", F.shiftrightunsigned("key", BITS).alias("context"), (n - cut).alias("left"), cut.alias("cut"), "n")
        # A context has at most as many rows as there are symbols.
        same = Window.partitionBy("lang", "context")
        rows = rows.withColumns({"total": F.sum("n").over(same), "freed": F.sum("cut").over(same)}).withColumn("weight", F.col("freed") / F.col("total"))
        contexts = rows.groupBy("lang", "context").agg(F.first("weight").alias("weight"))
        if lower is None:
            rows = rows.join(sizes, "lang")
            below = F.lit(1.0) / F.col("size")
        else:
            rows = rows.withColumn("suffix", _low(F.col("key"), k - 1)).join(lower.select("lang", F.col("key").alias("suffix"), F.col("p").alias("q")), ["lang", "suffix"])
            below = F.col("q")
        lower = scratch(rows.select("lang", "key", (F.col("left") / F.col("total") + F.col("weight") * below).alias("p")), "probabilities")
        parts.append(lower.select("lang", F.lit(k).alias("k"), F.lit("p").alias("kind"), "key", F.log("p").alias("value")))
        parts.append(contexts.select("lang", F.lit(k).alias("k"), F.lit("g").alias("kind"), F.col("context").alias("key"), F.log("weight").alias("value")))
    return scratch(reduce(DataFrame.unionByName, parts), "model")


def _shard() -> Column:
    """The last character but one; -1 for what every shard needs."""
    last = F.col("key").bitwiseAND(F.lit((1 << BITS) - 1).cast("bigint"))
    before = F.shiftrightunsigned("key", BITS).bitwiseAND(F.lit((1 << BITS) - 1).cast("bigint"))
    return F.when(F.col("k") == 1, F.lit(-1)).when(F.col("kind") == "p", before).otherwise(last)


def _packs(model: DataFrame, pack_rows: int) -> list[list[dict[str, np.ndarray]]]:
    """Packs of at most ``pack_rows`` rows (or one shard): which shards of which languages each scores.

    Those in one list go over the same documents in turn; they are more than
    one only for a language whose model is larger than a pack.
    """
    sizes = model.groupBy("lang", _shard().alias("shard")).agg(F.count(F.lit(1)).alias("n")).orderBy("lang", "shard").collect()
    langs: dict[str, dict[int, int]] = {}
    for r in sizes:
        langs.setdefault(r["lang"], {})[r["shard"]] = r["n"]
    whole: list[list[dict[str, np.ndarray]]] = []
    cut: list[list[dict[str, np.ndarray]]] = []
    room = 0
    for lang, shards in langs.items():
        total = sum(shards.values())
        if total <= pack_rows:
            if not whole or total > room:
                whole.append([{}])
                room = pack_rows
            whole[-1][0][lang] = np.ones(1 << BITS, bool)
            room -= total
            continue
        packs: list[dict[str, np.ndarray]] = []
        left = 0
        for shard, n in shards.items():
            if shard < 0:
                continue
            if not packs or n > left:
                packs.append({lang: np.zeros(1 << BITS, bool)})
                left = pack_rows
            packs[-1][lang][shard] = True
            left -= n
        # Symbols never seen before another belong to no shard but the first.
        packs[0][lang] |= ~reduce(np.logical_or, (p[lang] for p in packs))
        cut.append(packs)
    return whole + cut


class Scorer:
    """The rows of one pack: for each language and order, sorted keys and their values."""

    def __init__(self, rows: pa.Table, pack: dict[str, np.ndarray], alphabets: dict[str, Alphabet], order: int):
        self.shards, self.order = pack, order
        self.alphabets = {lang: alphabets[lang] for lang in pack}
        self.tables: dict[tuple[str, int, str], tuple[np.ndarray, np.ndarray]] = {}
        for name in product(pc.unique(rows["lang"]).to_pylist(), range(1, order + 1), "pg"):
            same = [pc.equal(rows[column], value) for column, value in zip(("lang", "k", "kind"), name)]
            part = rows.filter(pc.and_(pc.and_(same[0], same[1]), same[2]))
            keys = part["key"].to_numpy().astype(np.uint64)
            ascending = np.argsort(keys)
            self.tables[name] = (keys[ascending], part["value"].to_numpy()[ascending])

    def _find(self, lang: str, k: int, kind: str, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        known, values = self.tables.get((lang, k, kind), (np.empty(0, np.uint64), np.empty(0)))
        if not len(known):
            return np.zeros(len(keys), bool), np.zeros(len(keys))
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        hit = known[at] == keys
        return hit, np.where(hit, values[at], 0.0)

    def score(self, lang: str, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The log probability of each symbol of the text (0 where another pack scores it), and each character's first symbol."""
        alphabet = self.alphabets[lang]
        symbols, starts = alphabet.symbols(points)
        keys = ngram_keys(symbols, self.order)
        at = np.flatnonzero(self.shards[lang][((keys >> np.uint64(BITS)) & np.uint64((1 << BITS) - 1)).astype(np.int64)])
        at = at[np.argsort(keys[at])]
        keys, out = keys[at], np.zeros(len(symbols))
        for k in range(self.order, 0, -1):
            hit, values = self._find(lang, k, "p", keys)
            out[at] += values
            keys, at = keys[~hit], at[~hit]
            if not len(keys):
                break
            out[at] += self._find(lang, k, "g", keys >> np.uint64(BITS))[1]
            keys = keys & np.uint64((1 << (BITS * (k - 1))) - 1)
        out[at] -= math.log(alphabet.size)
        return out, starts


def stretches(points: np.ndarray, cost: np.ndarray) -> tuple[float, float | None, float | None]:
    """Of a text's characters and their negative log probabilities: the costliest
    word (its sum over its length and two, so that short ones need more), and
    the mean of the costliest and, negated, of the cheapest window (None in
    texts shorter than a window).

    Words are runs up to the next white space, cut after ``WORD`` characters.
    """
    n = len(points)
    ends = np.isin(points, _SPACES)
    ends[0] = True
    firsts = np.flatnonzero(ends)
    place = np.arange(n) - np.repeat(firsts, np.diff(firsts, append=n))
    firsts = np.flatnonzero(place % WORD == 0)
    words = np.add.reduceat(cost, firsts) / (np.diff(firsts, append=n) + 2)
    if n < WINDOW:
        return float(words.max()), None, None
    sums = np.concatenate([[0.0], np.cumsum(cost)])
    windows = (sums[WINDOW:] - sums[:-WINDOW]) / WINDOW
    return float(words.max()), float(windows.max()), -float(windows.min())


def _scores(texts: DataFrame, model: DataFrame, alphabets: dict[str, Alphabet], order: int, pack_rows: int) -> DataFrame:
    """``(id, lang, row_hash, n_chars, logprob, word, high, low)`` of every row of ``texts (id, lang, text, row_hash)``.

    What has no characters or no model of its language has no stretches.
    """
    spark = texts.sparkSession
    groups = _packs(model, pack_rows)
    judged = [lang for packs in groups for lang in packs[0]]
    kind = texts.schema["id"].dataType.simpleString()
    shape = f"id {kind}, lang string, row_hash bigint, n_chars bigint, logprob double"
    names = ["id", "lang", "row_hash", "n_chars", "logprob"]
    ends = f"{shape}, " + ", ".join(f"{s} double" for s in _STRETCHES)

    def unjudged(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        n = [len(_points(t)) for t in batch["text"].to_pylist()]
        none = pa.nulls(len(n), pa.float64())
        yield pa.RecordBatch.from_arrays([batch["id"], batch["lang"], batch["row_hash"], pa.array(n, pa.int64()), pa.array([0.0] * len(n)), none, none, none], [*names, *_STRETCHES])

    others = texts.where(~F.col("lang").isin(judged)) if judged else texts
    parts = [map_batches(others, unjudged, ends)]
    for packs in groups:
        # "part": for each symbol, the rounded log probability, or 0 before its pack.
        state = texts.where(F.col("lang").isin(list(packs[0]))).withColumns({"logprob": F.lit(0.0), "part": F.lit(None).cast("binary")})
        for number, pack in enumerate(packs):
            last = number == len(packs) - 1
            rows = model.where(F.col("lang").isin(list(pack)))
            if len(packs) > 1:
                (wanted,) = pack.values()
                rows = rows.where((_shard() < 0) | _shard().isin(np.flatnonzero(wanted).tolist()))
            shared = spark.sparkContext.broadcast(Scorer(rows.toArrow(), pack, alphabets, order))

            def run(batch: pa.RecordBatch, shared=shared, last=last) -> Iterator[pa.RecordBatch]:
                scorer = shared.value
                n, sums, kept, found = [], batch["logprob"].to_pylist(), [], []
                for k, (lang, text, old) in enumerate(zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), batch["part"].to_pylist())):
                    points = _points(text)
                    got, starts = scorer.score(lang, points)
                    n.append(len(points))
                    sums[k] += float(got.sum())
                    part = got.astype(np.float16)
                    if old:
                        part = part + np.frombuffer(old, np.float16)
                    if last:
                        found.append(stretches(points, -np.add.reduceat(part.astype(np.float64), starts)) if len(points) else (None,) * len(_STRETCHES))
                    else:
                        kept.append(part.tobytes())
                out = [batch["id"], batch["lang"], batch["row_hash"], pa.array(n, pa.int64()), pa.array(sums, pa.float64())]
                if last:
                    yield pa.RecordBatch.from_arrays([*out, *(pa.array(x, pa.float64()) for x in zip(*found))], [*names, *_STRETCHES])
                else:
                    yield pa.RecordBatch.from_arrays([*out, batch["text"], pa.array(kept, pa.binary())], [*names, "text", "part"])

            state = map_batches(state, run, ends if last else f"{shape}, text binary, part binary")
            state = scratch(state, "scores")
            shared.destroy()
        parts.append(state)
    return scratch(reduce(DataFrame.unionByName, parts), "scores")


def _with_ids(rows: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """The rows whose ``key`` is among ``ids (trusted)``; that list is broadcast only while it is short."""
    small = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return rows.join(F.broadcast(ids) if small else ids, F.col(key) == F.col("trusted"), "left_semi")


def _judged(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, lang_col: str, order: int, quantile: float, margin: float, pack_rows: int, holdout: int) -> DataFrame:
    """``(id, lang, row_hash, n_chars, perplexity, threshold, accepted)`` of every row."""
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(""))
    texts = docs.select(F.col(id_col).alias("id"), lang.alias("lang"), utf8(text_col).alias("text")).withColumn("row_hash", F.xxhash64("text", "lang"))
    trusted = scratch(labels.where("quality = 1 and coalesce(toxic, 0) = 0").select(F.col(id_col).alias("trusted")).where("trusted is not null").distinct(), "trusted")
    held = F.pmod(F.xxhash64("id"), holdout) == 0 if holdout else F.lit(False)
    sample = _with_ids(texts, "id", trusted).where((F.octet_length("text") > 0) & ~held)
    alphabets = _alphabets(sample)
    model = train(sample, alphabets, order)
    scores = _scores(texts, model, alphabets, order, pack_rows)
    scores = scores.withColumn("perplexity", F.when((F.col("n_chars") > 0) & (F.col("logprob") < 0), F.exp(-F.col("logprob") / F.col("n_chars"))))
    known = _with_ids(scores, "id", trusted)
    # How the stretches of a language's held-out documents grow with the length: one row.
    length = F.log("n_chars")
    sums = [agg(F.when(held, F.col(s)), length).alias(f"{s}_{name}") for s in _STRETCHES for name, agg in (("xy", F.regr_sxy), ("xx", F.regr_sxx))]
    slope = known.groupBy("lang").agg(*sums).agg(*[F.try_divide(F.sum(f"{s}_xy"), F.sum(f"{s}_xx")).alias(s) for s in _STRETCHES]).first()
    rests = {s: F.col(s) - round(slope[s] or 0.0, 6) * length for s in _STRETCHES}
    # A row for each language.
    limit = [F.percentile_approx(p, quantile, 10_000) for p in (F.when(held, F.col("perplexity")), F.col("perplexity"))]
    limits = [(F.coalesce(*limit) * margin).alias("threshold")]
    for s, rest in rests.items():
        of_held = F.when(held, rest)
        unsure = F.lit(ERRORS) * F.try_divide(F.stddev_samp(of_held), F.sqrt(F.count(of_held)))
        enough = F.count(of_held) * (1 - quantile) >= 1 - 1e-9
        limits.append(F.when(enough, F.percentile_approx(of_held, quantile, 10_000) + unsure).alias(f"{s}_limit"))
    judged = scores.join(F.broadcast(scratch(known.groupBy("lang").agg(*limits), "thresholds")), "lang", "left")
    fits = [F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)), *(F.coalesce(rest <= F.col(f"{s}_limit"), F.lit(True)) for s, rest in rests.items())]
    accepted = (F.col("n_chars") > 0) & (F.col("threshold").isNull() | reduce(Column.__and__, fits))
    return judged.withColumn("accepted", accepted)


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    order: int = ORDER,
    quantile: float = QUANTILE,
    margin: float = MARGIN,
    pack_rows: int = PACK_ROWS,
    holdout: int = HOLDOUT,
) -> DataFrame:
    """One row per document: id, ``lang``, ``n_chars``, ``perplexity``, ``threshold``, ``accepted``.

    Trusted are all documents labelled with quality 1 and not toxic; the
    model learns from all but one in ``holdout`` of them (0: from all).
    ``threshold`` is the language's ``quantile`` of the perplexities of those
    held out (of all trusted ones, if it has none), times ``margin``;
    documents up to it are accepted, unless their costliest word or their
    costliest or cheapest window is beyond its limit, from those held out
    alone (only where they are enough to tell the quantile).

    Null and empty texts have no perplexity and are not accepted. A null
    language is a language of its own. Documents of a language without any
    trusted text can't be judged: they have no perplexity or threshold and
    are accepted. Repeated rows each get their row; with empty labels all
    texts but the empty are accepted; an empty table gives an empty result.
    """
    judged = _judged(docs, labels, id_col, text_col, lang_col, order, quantile, margin, pack_rows, holdout)
    return judged.select(
        F.col("id").alias(id_col),
        F.when(F.col("lang") != "", F.col("lang")).alias("lang"),
        "n_chars",
        F.when(F.col("threshold").isNotNull(), F.col("perplexity")).alias("perplexity"),
        "threshold",
        "accepted",
    )


def keep_accepted(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    order: int = ORDER,
    quantile: float = QUANTILE,
    margin: float = MARGIN,
    pack_rows: int = PACK_ROWS,
    holdout: int = HOLDOUT,
) -> DataFrame:
    """The rows of ``docs`` that ``quality_scores`` accepts, with all their columns.

    The list of rejected rows is broadcast only while it is short, and joined
    by a shuffle beyond.
    """
    judged = _judged(docs, labels, id_col, text_col, lang_col, order, quantile, margin, pack_rows, holdout)
    rejected = scratch(judged.where(~F.col("accepted")).select(F.col("id").alias("strata_id"), F.col("row_hash").alias("strata_hash")).distinct(), "rejected")
    small = rejected.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    row_hash = F.xxhash64(utf8(text_col), F.coalesce(F.col(lang_col).cast("string"), F.lit("")))
    same = F.col(id_col).eqNullSafe(F.col("strata_id")) & (row_hash == F.col("strata_hash"))
    return docs.join(F.broadcast(rejected) if small else rejected, same, "left_anti")
