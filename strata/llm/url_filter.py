"""URL verdicts: host and path rules, and a character language-model ratio for the rest.

Two variable-order Markov models of characters are trained on the URLs that
the rules decide: one on the accepted, one on the rejected. Each interpolates
all context lengths up to ``ORDER`` by Witten and Bell's weights, so a context
counts as far as it was seen. A URL's score is the difference of its two log
likelihoods, divided by its number of symbols. The limit is calibrated on
rule-decided URLs that are left out of training: it is where the share of
accepted URLs above it exceeds that of rejected ones most.

Everything is DataFrame functions. URLs are cut into character n-grams once;
model tables hold one row per different n-gram, so what is joined level by
level is vocabulary, not text, and it grows with the corpus without a cap. A
URL's n-grams meet their log ratios in one join (hot n-grams are split by
Spark's skew join) and are summed per URL. Both sides of every join grow with
the corpus, so all carry a ``merge`` hint: Spark's size check before a
broadcast sees compressed files, which hold many times their size in rows, and
the driver would build the table of them. Log ratios are whole millionths, so sums don't depend on their order.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import free_name, scratch


class Rule(NamedTuple):
    """A verdict for a host with all its subdomains, under a path prefix."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)
ORDER = 5
# First hex digits of the MD5 of a URL's text that leave it out of training.
HELD_OUT = "012"
# Scores are counted in steps of a thousandth, between plus and minus this many.
STEPS = 20_000
_START, _END = "\x02", "\x03"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """``(host, path, judged text)`` of a URL.

    The host lies between the first ``://`` and the next ``/``, ``?``, ``#``
    or the end, A-Z lower-cased; the path goes on up to ``?``, ``#`` or the
    end. Without ``://`` both are empty. The judged text is the URL without
    its scheme, its host lower-cased; without ``://`` it is all of it.
    """
    url = F.coalesce(url, F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise("")
    raw_host = F.regexp_extract(rest, "^[^/?#]*", 0)
    host = F.translate(raw_host, _UPPER, _LOWER)
    after = F.substring(rest, F.length(raw_host) + 1, F.length(rest))
    return host, F.regexp_extract(after, "^[^?#]*", 0), F.when(at > 0, F.concat(host, after)).otherwise(url)


def rule_of(host: Column, path: Column, rules: Sequence[Rule], give: str = "name") -> Column:
    """``give`` (name or verdict) of the longest rule that fits, else null; among equals the one with the longer host, then the first."""
    out = F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: (len(r.name), len(r.host))):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        out = F.when(fits, F.lit(getattr(rule, give))).otherwise(out)
    return out


def grams_of(text: Column, order: int) -> Column:
    """Each symbol of the text and its end, with up to ``order`` symbols before it (the text's start is one)."""
    symbols = F.filter(F.split(F.concat(F.lit(_START), text, F.lit(_END)), ""), lambda c: c != "")

    def cut(s: Column) -> Column:
        window = lambda i: F.array_join(F.slice(s, F.greatest(F.lit(1), i - order), F.least(i, F.lit(order + 1))), "")
        return F.transform(F.sequence(F.lit(2), F.size(s)), window)

    # The array is bound once; named inside the function, it would be split again for every symbol.
    return F.flatten(F.transform(F.array(symbols), cut))


def _log_ratios(grams: DataFrame, order: int) -> DataFrame:
    """``(gram, ratio)``: millionths of ``ln P(accepted) - ln P(rejected)`` of each gram's last symbol after the others.

    ``grams`` has one row per different gram with its training counts
    ``accepted`` and ``rejected`` (both 0 where it only needs a value).
    """
    counted = grams.select(
        F.explode(F.transform(F.sequence(F.lit(1), F.length("gram")), lambda k: F.right(F.col("gram"), k))).alias("gram"),
        (F.length("gram")).alias("whole"),
        "accepted",
        "rejected",
    )
    counted = counted.groupBy("gram").agg(
        F.sum("accepted").alias("accepted"),
        F.sum("rejected").alias("rejected"),
        # Whether it is itself a gram to be scored, and not only the end of one.
        F.max(F.col("whole") == F.length("gram")).alias("asked"),
    )
    after_context = Window.partitionBy(F.substring("gram", F.lit(1), F.length("gram") - 1), F.length("gram"))
    columns = {"size": F.length("gram"), "symbols": F.count(F.when(F.col("accepted") + F.col("rejected") > 0, 1)).over(after_context)}
    for side in ("accepted", "rejected"):
        columns[f"{side}_seen"] = F.sum(side).over(after_context)
        columns[f"{side}_kinds"] = F.count(F.when(F.col(side) > 0, 1)).over(after_context)
    model = scratch(counted.withColumns(columns), "url-grams")

    def probability(side: str, shorter: Column) -> Column:
        weighed = F.col(side) + F.col(f"{side}_kinds") * shorter
        total = F.col(f"{side}_seen") + F.col(f"{side}_kinds")
        return F.when(total > 0, weighed / total).otherwise(shorter)

    uniform = F.lit(1.0) / (F.col("symbols") + 1)
    level = model.where("size = 1").select(
        "gram", "asked", probability("accepted", uniform).alias("p"), probability("rejected", uniform).alias("q")
    )
    done = level
    for size in range(2, order + 2):
        shorter = level.select(F.col("gram").alias("ending"), F.col("p").alias("shorter_p"), F.col("q").alias("shorter_q"))
        longer = model.where(F.col("size") == size).withColumn("ending", F.substring("gram", F.lit(2), F.length("gram")))
        level = longer.join(shorter.hint("merge"), "ending").select(
            "gram",
            "asked",
            probability("accepted", F.col("shorter_p")).alias("p"),
            probability("rejected", F.col("shorter_q")).alias("q"),
        )
        level = scratch(level, f"url-level{size}")
        done = done.unionByName(level)
    millionths = F.round((F.log("p") - F.log("q")) * 1_000_000).cast("bigint")
    return scratch(done.where("asked").select("gram", millionths.alias("ratio")), "url-ratios")


def _scores(rows: DataFrame, ratios: DataFrame, order: int) -> DataFrame:
    """``(row, total, n)``: the log ratios of a URL's symbols summed, and how many there are."""
    grams = rows.select("row", F.explode(grams_of(F.col("text"), order)).alias("gram"))
    return grams.join(ratios.hint("merge"), "gram").groupBy("row").agg(F.sum("ratio").alias("total"), F.count(F.lit(1)).alias("n"))


def _calibrated(scores: DataFrame) -> int:
    """The step from which on to allow; ``scores`` has ``total``, ``n`` and ``accepted`` of held-out URLs.

    Of all steps, the one where the share of accepted URLs at or above it
    exceeds the share of rejected ones most, the highest among equals; 0 if
    none does. One row reaches the driver; it is folded from a histogram of
    at most ``2 * STEPS + 1`` entries.
    """
    step = F.floor(F.col("total") / (F.col("n") * 1000)).cast("bigint")
    step = F.greatest(F.lit(-STEPS).cast("bigint"), F.least(F.lit(STEPS).cast("bigint"), step))
    ones = [F.count(F.when(F.col("accepted") == side, 1)).alias(name) for name, side in (("good", True), ("bad", False))]
    steps = scores.groupBy(step.alias("step")).agg(*ones)
    listed = steps.agg(F.reverse(F.array_sort(F.collect_list(F.struct("step", "good", "bad")))).alias("steps"), F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    start = F.struct(*(F.lit(0).cast("bigint").alias(c) for c in ("good", "bad", "gain", "step")))

    def fold(state: Column, entry: Column) -> Column:
        good, bad = state["good"] + entry["good"], state["bad"] + entry["bad"]
        gain = good * F.col("bad") - bad * F.col("good")
        better = gain > state["gain"]
        return F.struct(
            good.alias("good"),
            bad.alias("bad"),
            F.when(better, gain).otherwise(state["gain"]).alias("gain"),
            F.when(better, entry["step"]).otherwise(state["step"]).alias("step"),
        )

    return listed.select(F.aggregate("steps", start, fold)["step"].alias("step")).first()["step"]


def url_verdicts(
    pages: DataFrame,
    rules: Sequence[Rule] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    order: int = ORDER,
) -> DataFrame:
    """One row per page: id, ``host``, ``path``, ``rule``, ``verdict``, and ``score`` where the models decided.

    The longest fitting rule decides (see :func:`rule_of`); all other URLs,
    null and malformed ones included, are allowed if their score reaches the
    calibrated limit. The score is in millionths of a nat per symbol, null
    where a rule decided. A null URL is judged as an empty one. Without
    rule-decided URLs of both kinds the limit is 0 and an equal chance allows.
    Equal URLs get equal verdicts; repeated rows each get their row; an empty
    table gives an empty result; URLs of any length are judged whole. Other
    columns of ``pages`` are left out, so none clashes.
    """
    host, path, text = url_parts(F.col(url_col))
    page = free_name(pages, "strata_page")
    rows = pages.select(F.col(id_col).alias(page), host.alias("host"), path.alias("path"), text.alias("text"))
    rows = rows.withColumns({"rule": rule_of(F.col("host"), F.col("path"), rules), "ruled": rule_of(F.col("host"), F.col("path"), rules, "verdict")})
    held = F.col("ruled").isNotNull() & F.md5(F.col("text").cast("binary")).substr(1, 1).isin(*HELD_OUT)
    rows = scratch(rows.withColumns({"held": held, "row": F.monotonically_increasing_id()}), "urls")

    def trains(verdict: str) -> Column:
        return F.sum(F.when((F.col("ruled") == verdict) & ~F.col("held"), 1).otherwise(0))

    grams = rows.select("ruled", "held", F.explode(grams_of(F.col("text"), order)).alias("gram"))
    grams = grams.groupBy("gram").agg(trains("allow").alias("accepted"), trains("block").alias("rejected"))
    ratios = _log_ratios(grams, order)
    asked = rows.where("ruled is null or held")
    scores = scratch(_scores(asked, ratios, order).join(asked.select("row", "ruled").hint("merge"), "row"), "url-scores")
    limit = _calibrated(scores.where("ruled is not null").withColumn("accepted", F.col("ruled") == "allow"))
    judged = scores.where("ruled is null").select("row", "total", "n")
    allowed = F.col("total") >= F.col("n") * F.lit(limit * 1000)
    return rows.join(judged.hint("merge"), "row", "left").select(
        F.col(page).alias(id_col),
        "host",
        "path",
        "rule",
        F.coalesce("ruled", F.when(allowed, "allow").otherwise("block")).alias("verdict"),
        (F.col("total") / F.col("n")).alias("score"),
    )
