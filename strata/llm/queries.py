"""Registered queries of this subpackage: ``name -> (spark, sf_dir) -> DataFrame``.

Each applies one operator, with production parameters, to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.chat import format_chats
from strata.llm.common import table
from strata.llm.decontam import find_contamination
from strata.llm.embedding_dedup import embedding_components
from strata.llm.periodic_runs import find_runs, with_cycles
from strata.llm.pii import replace_pii
from strata.llm.quality_lm import quality_scores
from strata.llm.sentencepiece_topk import sample_segmentations
from strata.llm.simhash import simhash_components
from strata.llm.suffix_dedup import remove_repeats
from strata.llm.token_alignment import align_tokens, link_counts
from strata.llm.token_counts import token_counts
from strata.llm.url_filter import url_verdicts
from strata.llm.warc import derivatives, response_records

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derivatives(response_records(table(spark, sf_dir, "pages"))).drop("block")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_segmentations(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_components(table(spark, sf_dir, "embeddings"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    replaced = replace_pii(docs, entities_col="entities")
    kinds = F.sort_array(F.array_distinct(F.transform("entities", lambda e: e["kind"])))
    return replaced.select("doc_id", "text", F.size("entities").cast("bigint").alias("n_entities"), kinds.alias("kinds"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizers = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    aligned = align_tokens(table(spark, sf_dir, "documents"), *tokenizers)
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    return link_counts(aligned.withColumn("groups_sha256", digest).drop("groups"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(with_cycles(table(spark, sf_dir, "documents")))
    first = F.get("runs", F.lit(0))
    # Runs are sorted by start, then period, so the first of equals stays.
    best = F.aggregate("runs", first, lambda best, run: F.when(run["length"] * best["period"] > best["length"] * run["period"], run).otherwise(best))
    found = found.withColumn("best", best)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Query] = {
    "op1_decontamination": op1_decontamination,
    "op2_simhash": op2_simhash,
    "op3_chat_format": op3_chat_format,
    "op4_warc": op4_warc,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_token_counts": op6_token_counts,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_pii": op8_pii,
    "op9_quality": op9_quality,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_token_alignment": op11_token_alignment,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_url_filter": op13_url_filter,
}

_WORDS = r"""
SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
FROM {table}
"""

# DuckDB SQL where SQL can express the whole query and is quick enough; the
# others are compared with brute force in tests/llm.
ORACLES: dict[str, str] = {
    "op1_decontamination": f"""
WITH item AS ({_WORDS.format(key="CAST(item_id AS VARCHAR) AS item", table="benchmark")}),
item_window AS (
  SELECT item, k, array_to_string(words[i : i + k - 1], ' ') AS gram
  FROM (SELECT item, words, k, unnest(range(1, len(words) - k + 2)) AS i
        FROM (SELECT *, least(10, len(words)) AS k FROM item) a WHERE k > 0) b),
doc AS ({_WORDS.format(key="doc_id", table="documents")}),
hit AS (
  SELECT doc_id, p, k, item
  FROM (SELECT doc_id, k, p, array_to_string(words[p : p + k - 1], ' ') AS gram
        FROM (SELECT doc_id, words, k, unnest(range(1, len(words) - k + 2)) AS p
              FROM doc, (SELECT DISTINCT k FROM item_window) s WHERE len(words) >= k) c) d
  JOIN item_window USING (k, gram)),
marked AS (SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(p, p + k)) AS place FROM hit) e GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, item FROM hit) f GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(marked.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
       sha256(coalesce(named.items, '')) AS items_sha256, coalesce(marked.n, 0) > 0 AS contaminated,
       CASE WHEN len(words) = 0 THEN 0.0 ELSE coalesce(marked.n, 0) / len(words) END AS coverage
FROM doc LEFT JOIN marked USING (doc_id) LEFT JOIN named USING (doc_id)
""",
    "op7_embedding_dedup": """
WITH RECURSIVE vec AS (
  SELECT vec_id, v FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings) a
  WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND list_aggregate(list_transform(v, lambda x: abs(x)), 'max') > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vec a JOIN vec b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(least_id, vec_id)) AS component_id,
       vec_id <= coalesce(least_id, vec_id) AS kept
FROM embeddings
LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM link GROUP BY a) c USING (vec_id)
LEFT JOIN (SELECT a AS vec_id, min(b) AS least_id FROM reach GROUP BY a) r USING (vec_id)
""",
}


def _url_oracle(order: int = 5) -> str:
    """The URL models in SQL, one pair of CTEs per context length."""
    share = "(n{side} + kinds{side} * {shorter}) / (seen{side} + kinds{side})"
    sides = {"p": "a", "q": "r"}

    def probability(name: str, shorter: str) -> str:
        side = sides[name]
        return f"CASE WHEN seen{side} + kinds{side} > 0 THEN {share.format(side=side, shorter=shorter)} ELSE {shorter} END AS {name}"

    first = ", ".join(probability(name, "(1.0::DOUBLE / (symbols + 1))") for name in sides)
    levels = [f"level1 AS (SELECT gram, asked, {first} FROM model WHERE length(gram) = 1)"]
    for size in range(2, order + 2):
        columns = ", ".join(probability(name, f"s.{name}") for name in sides)
        levels.append(f"level{size} AS (SELECT m.gram, m.asked, {columns} FROM model m JOIN level{size - 1} s ON substr(m.gram, 2) = s.gram WHERE length(m.gram) = {size})")
    union = " UNION ALL ".join(f"SELECT * FROM level{size}" for size in range(1, order + 2))
    fits = "(host = '{0}' OR host LIKE '%.{0}') AND path LIKE '{1}%'"
    cases = [("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"), ("net", "/", "block")]
    rule = " ".join(f"WHEN {fits.format(h, p)} THEN '{h}{p}'" for h, p, _ in cases)
    ruled = " ".join(f"WHEN {fits.format(h, p)} THEN '{v}'" for h, p, v in cases)
    return f"""
WITH url AS (SELECT page_id, row_number() OVER () AS k, coalesce(url, '') AS u FROM pages),
rest AS (SELECT *, strpos(u, '://') AS mark, CASE WHEN strpos(u, '://') > 0 THEN substr(u, strpos(u, '://') + 3) ELSE '' END AS rest FROM url),
cut AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS raw FROM rest),
part AS (SELECT *, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, substr(rest, length(raw) + 1) AS after FROM cut),
pathed AS (SELECT *, regexp_extract(after, '^[^?#]*') AS path, CASE WHEN mark > 0 THEN host || after ELSE u END AS text FROM part),
page AS (SELECT page_id, k, host, path, text, CASE {rule} END AS rule, CASE {ruled} END AS ruled, substr(md5(text), 1, 1) IN ('0', '1', '2') AS aside FROM pathed),
held AS (SELECT *, ruled IS NOT NULL AND aside AS held FROM page),
gram AS (SELECT k, ruled, held, substr(s, greatest(1, i - {order}), i + 1 - greatest(1, i - {order})) AS gram
         FROM (SELECT *, chr(2) || text || chr(3) AS s, unnest(range(2, length(text) + 3)) AS i FROM held) a),
trained AS (SELECT gram, count(*) FILTER (ruled = 'allow' AND NOT held) AS na, count(*) FILTER (ruled = 'block' AND NOT held) AS nr FROM gram GROUP BY gram),
ending AS (SELECT right(gram, m) AS gram, sum(na)::BIGINT AS na, sum(nr)::BIGINT AS nr, bool_or(m = length(gram)) AS asked
           FROM (SELECT *, unnest(range(1, length(gram) + 1)) AS m FROM trained) b GROUP BY right(gram, m)),
model AS (SELECT *, sum(na) OVER w AS seena, count(*) FILTER (na > 0) OVER w AS kindsa, sum(nr) OVER w AS seenr, count(*) FILTER (nr > 0) OVER w AS kindsr,
                 count(*) FILTER (na + nr > 0) OVER w AS symbols
          FROM ending WINDOW w AS (PARTITION BY substr(gram, 1, length(gram) - 1), length(gram))),
{", ".join(levels)},
ratio AS (SELECT gram, round((ln(p) - ln(q)) * 1000000)::BIGINT AS ratio FROM ({union}) c WHERE asked),
score AS (SELECT k, any_value(ruled) AS ruled, sum(ratio)::BIGINT AS total, count(*) AS n FROM gram JOIN ratio USING (gram) WHERE ruled IS NULL OR held GROUP BY k),
step AS (SELECT greatest(-20000, least(20000, floor(total / (n * 1000))))::BIGINT AS step, count(*) FILTER (ruled = 'allow') AS good, count(*) FILTER (ruled = 'block') AS bad
         FROM score WHERE ruled IS NOT NULL GROUP BY 1),
above AS (SELECT step, sum(good) OVER (ORDER BY step DESC) * sum(bad) OVER () - sum(bad) OVER (ORDER BY step DESC) * sum(good) OVER () AS gain FROM step),
best AS (SELECT coalesce((SELECT step FROM above WHERE gain > 0 ORDER BY gain DESC, step DESC LIMIT 1), 0) AS step)
SELECT page_id, host, path, rule, coalesce(held.ruled, CASE WHEN total >= n * best.step * 1000 THEN 'allow' ELSE 'block' END) AS verdict,
       CASE WHEN held.ruled IS NULL THEN total / n END AS score
FROM held LEFT JOIN score USING (k) CROSS JOIN best
"""


ORACLES["op13_url_filter"] = _url_oracle()
