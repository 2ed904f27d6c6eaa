"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the driver tables under ``sf_dir`` (or data Spark derives
from them) in full, so its work grows with the tables. Queries that exercise
sinks write to fresh folders under the shared checkpoint folder and return a
read of what they wrote.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.config import LayerConfig, preset
from strata.operators import (
    add_audit_columns,
    clean_orders,
    daily_country_sales,
    deduplicate_latest,
    derive_amount,
    normalise_orders,
    valid_orders,
)
from strata.functions.columns import python_lines
from strata.operators import quality as Q
from strata.operators import text as T
from strata.plans import medallion as M
from strata.schemas import RAW_COLUMNS
from strata.session import released_shuffles, scratch_path
from strata.sources.feeds import load, load_text, log_lines, orders_feed, workflow_texts
from strata.sources.files import (
    number_lines,
    read_csv_with_corrupt,
    read_log_lines,
    read_packed_corpus,
    read_raw_csv,
    rejected_fields,
    rejection_report,
    write_packed_corpus,
    write_raw_csv,
)
from strata.sources.tables import ensure_schemas, read_layer, write_layer
from strata.streaming.landing import ingest_bronze

Query = Callable[[SparkSession, str], DataFrame]

BATCH_ID = "B-001"
LINEITEM_KEYS = ("l_orderkey", "l_linenumber")
LINEITEM_TIES = (
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
)
LINES_PER_FILE = 50_000
BROKEN_CONTRACT = (
    StructType()
    .add("l_orderkey", "long")
    .add("l_linenumber", "integer")
    .add("l_quantity", "double")
    .add("l_shipdate", "date")
    .add("l_returnflag", "string")
)
# Rule set of the corpus scan: the two workflow line rules plus the
# key/value credential pattern, which the prose corpus does contain.
CORPUS_RULES = T.LINE_RULES + (
    ("credential_assignment", T.REDACTION_PATTERNS[3][1], "credential assigned in plain text"),
)


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The feed comes out of its joins' shuffle.
    return clean_orders(orders_feed(spark, sf_dir), spread=False)


def _gold(spark: SparkSession, sf_dir: str, sort: bool = True) -> DataFrame:
    # Cleansing leaves one row per order.
    return daily_country_sales(_clean(spark, sf_dir), sort=sort, unique_orders=True)


def _stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once and read back, for queries that read it several times."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with released_shuffles(spark):
        df.write.parquet(path)
    return spark.read.parquet(path)


def _feed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(orders_feed(spark, sf_dir), "feed")


def _unique(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


# --------------------------------------------------------------------------- silver / gold


def q_normalise_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise_orders(orders_feed(spark, sf_dir))


def q_valid_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_orders(normalise_orders(orders_feed(spark, sf_dir)))


def q_derive_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_amount(valid_orders(normalise_orders(orders_feed(spark, sf_dir))))


def q_clean_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean(spark, sf_dir)


def q_daily_country_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir)


def q_dedupe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = load(spark, sf_dir, "lineitem")
    return deduplicate_latest(lineitem, keys=list(LINEITEM_KEYS), order_by="l_shipdate", tie_breakers=LINEITEM_TIES)


# --------------------------------------------------------------------------- quality


def q_quality_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = _feed_table(spark, sf_dir)
    return Q.profile(feed, clean_orders(feed))


def q_quality_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = [(c.env, c.max_rejection_rate, c.fail_on_violation) for c in (preset("qa"), preset("prod"))]
    return Q.verdicts(q_quality_profile(spark, sf_dir), settings)


def q_quality_gate_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts where each rule fires: without dedup, with every row rejected, and with none."""
    feed = _feed_table(spark, sf_dir)
    valid = valid_orders(normalise_orders(feed))
    lines = valid.withColumn("order_id", F.regexp_extract("order_id", "^ORD-([0-9]+)", 1))
    cleaned = clean_orders(feed)
    cases = {"repeated": Q.profile(lines, lines), "rejected": Q.profile(feed, feed.filter(F.lit(False))), "kept": Q.profile(cleaned, cleaned)}
    parts = [
        Q.verdict(profile, 0.05, case != "repeated", case, keep_counts=True).drop("rejection_rate")
        for case, profile in cases.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.duplicate_keys(load(spark, sf_dir, "lineitem"), LINEITEM_KEYS)


def q_table_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = _feed_table(spark, sf_dir)
    normalised = normalise_orders(feed).select(*RAW_COLUMNS)
    cleaned = clean_orders(feed).select(*RAW_COLUMNS)
    return Q.multiset_difference(normalised, cleaned)


def q_table_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = preset("qa")
    feed = _feed_table(spark, sf_dir)
    clean = _stored(clean_orders(feed), "silver")
    return Q.table_row_counts(
        {
            cfg.table("bronze", M.BRONZE_TABLE): feed,
            cfg.table("silver", M.SILVER_TABLE): clean,
            cfg.table("gold", M.GOLD_TABLE): daily_country_sales(clean, sort=False, unique_orders=True),
        }
    )


def q_min_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.minimum_check(_gold(spark, sf_dir, sort=False), "gross_revenue", 0.0, name="revenue")


# --------------------------------------------------------------------------- sources / sinks / steps


def q_bronze_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = load(spark, sf_dir, "lineitem")
    return add_audit_columns(lineitem, BATCH_ID, source_detail="name").drop("_ingested_at")


def q_csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = write_raw_csv(orders_feed(spark, sf_dir), f"{scratch_path(spark, 'landing')}/orders")
    raw = read_raw_csv(spark, landing)
    return raw.withColumn("order_ts", F.col("order_ts").cast("timestamp_ntz"))


def q_layer_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = LayerConfig(env="qa").with_prefix(_unique("rt"))
    ensure_schemas(spark, cfg, scratch_path(spark, "layers"))
    write_layer(_clean(spark, sf_dir), cfg, "silver", M.SILVER_TABLE, partition_by=["order_date"])
    return read_layer(spark, cfg, "silver", M.SILVER_TABLE)


def q_medallion_e2e(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "e2e")
    landing = write_raw_csv(orders_feed(spark, sf_dir), f"{root}/landing/orders", compression="gzip")
    cfg = preset("qa", catalog=None).with_prefix(_unique("e2e"))
    M.run_all(spark, cfg, BATCH_ID, source_path=landing, location_root=root)
    return read_layer(spark, cfg, "gold", M.GOLD_TABLE)


def q_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "stream")
    write_raw_csv(orders_feed(spark, sf_dir), f"{root}/landing/orders")
    cfg = LayerConfig(env="qa").with_prefix(_unique("st"))
    ingest_bronze(spark, cfg, BATCH_ID, f"{root}/landing/orders", f"{root}/checkpoint", root)
    bronze = read_layer(spark, cfg, "bronze", M.BRONZE_TABLE)
    return bronze.select(*RAW_COLUMNS).withColumn("order_ts", F.col("order_ts").cast("timestamp_ntz"))


def q_stage_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three step metric lines, from one profile and one gold count.

    Bronze rows equal the profile's ``input_rows``, so the bronze and silver
    lines come from the same one-row profile.
    """
    cfg = preset("qa")
    feed = _feed_table(spark, sf_dir)
    # Profile and gold count read it; cleansing would shuffle all rows for each.
    clean = _stored(clean_orders(feed), "silver")
    batch = F.lit(BATCH_ID).alias("batch_id")
    report = Q.profile(feed, clean)
    bronze_line = M.metric_record(
        "bronze", [F.lit(cfg.table("bronze", M.BRONZE_TABLE)).alias("table"), F.col("input_rows").alias("rows"), batch]
    )
    silver_line = M.metric_record(
        "silver",
        [F.lit(cfg.table("silver", M.SILVER_TABLE)).alias("table"), batch, *[F.col(c) for c in report.columns]],
    )
    layers = report.select(F.explode(F.array(bronze_line, silver_line)).alias("m")).select("m.*")
    gold = M.metrics_frame(
        daily_country_sales(clean, sort=False).agg(F.count(F.lit(1)).alias("rows")),
        "gold",
        [F.lit(cfg.table("gold", M.GOLD_TABLE)).alias("table"), F.col("rows"), batch],
    )
    return layers.unionByName(gold)


# --------------------------------------------------------------------------- text and logs


def q_redact_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.redact_text(load_text(spark, sf_dir, "documents"))


def q_redaction_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.redaction_counts(load_text(spark, sf_dir, "documents"))


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.extract_metrics(log_lines(spark, sf_dir))


def q_extract_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _metrics(spark, sf_dir)
    return m.select(
        "line_id",
        "payload",
        F.col("metrics")["stage"].alias("stage"),
        F.size("metrics").cast("bigint").alias("n_keys"),
    )


def q_metrics_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.metrics_long(_metrics(spark, sf_dir))


def q_metrics_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.metrics_wide(_metrics(spark, sf_dir))


def q_metrics_wide_rare_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide table where one line in 499 has a key of its own, which nobody has named."""
    lines = log_lines(spark, sf_dir)
    rare = (F.pmod("line_id", F.lit(499)) == 3) & F.col("line").endswith("}")
    extra = F.concat(F.col("line").substr(F.lit(1), F.length("line") - 1), F.lit(', "retry": '), F.pmod("line_id", F.lit(5)).cast("string"), F.lit("}"))
    return T.metrics_wide(T.extract_metrics(lines.withColumn("line", F.when(rare, extra).otherwise(F.col("line")))))


def q_metric_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.metric_keys(_metrics(spark, sf_dir))


def q_metrics_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.metrics_report(log_lines(spark, sf_dir))


def q_log_file_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log lines written as text files, scanned again and parsed."""
    path = scratch_path(spark, "logs")
    log_lines(spark, sf_dir).select("line").write.text(path)
    return T.extract_metrics(read_log_lines(spark, path)).select("payload", F.col("metrics")["stage"].alias("stage"))


def q_log_line_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log lines in files of up to ``LINES_PER_FILE``, numbered through splittable scans."""
    path = scratch_path(spark, "numbered")
    lines = log_lines(spark, sf_dir).withColumn("part", F.floor(F.col("line_id") / LINES_PER_FILE))
    lines.repartition("part").sortWithinPartitions("part", "line_id").select("line", "part").write.partitionBy("part").text(path)
    part = F.regexp_extract("source_file", "part=(-?[0-9]+)", 1).cast("bigint").alias("part")
    return number_lines(spark, path).select(part, "line_no", "line")


def q_stage_metrics_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metric lines of a batch that runs twice, read from the table that keeps each once."""
    cfg = LayerConfig(env="qa").with_prefix(_unique("mt"))
    ensure_schemas(spark, cfg, scratch_path(spark, "metrics"))
    # Three writes read the lines; they are made once.
    lines = _stored(q_stage_metrics(spark, sf_dir), "lines")
    table = cfg.table("gold", "run_metrics")
    for _ in range(2):
        M.write_metrics(lines, table, BATCH_ID)
    M.write_metrics(lines.where("stage = 'gold'"), table, "B-002")
    return spark.read.table(table).select("batch_id", "stage", "line")


def _broken_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as CSV whose numbers and dates are broken in places, read under its contract."""
    lineitem = load(spark, sf_dir, "lineitem")
    key = F.col("l_orderkey") + F.col("l_linenumber")
    text = {
        "l_orderkey": F.col("l_orderkey").cast("string"),
        "l_linenumber": F.when(key % 61 == 0, F.lit("first")).otherwise(F.col("l_linenumber").cast("string")),
        "l_quantity": F.when(key % 37 == 0, F.concat(F.lit("q"), F.pmod(key, F.lit(10)).cast("string"))).otherwise(F.col("l_quantity").cast("string")),
        "l_shipdate": F.when(key % 53 == 0, F.lit("someday")).when(key % 59 == 0, F.lit(None)).otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")),
        "l_returnflag": F.col("l_returnflag"),
    }
    landing = write_raw_csv(lineitem.select(*[c.alias(n) for n, c in text.items()]), f"{scratch_path(spark, 'broken')}/lineitem")
    return read_csv_with_corrupt(spark, landing, BROKEN_CONTRACT)


def q_csv_rejections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejection_report(_broken_csv(spark, sf_dir), BROKEN_CONTRACT)


def q_csv_rejected_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _broken_csv(spark, sf_dir)
    return rejected_fields(raw, BROKEN_CONTRACT).select("column", "value", F.split("record", ",")[0].cast("bigint").alias("l_orderkey"))


def q_workflow_file_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The workflow texts packed into a few files, read again, with each text's lines counted."""
    path = write_packed_corpus(workflow_texts(spark, sf_dir), scratch_path(spark, "workflows"))
    # As a file of its own, a text would end with a line break.
    n_lines = F.size(python_lines(F.concat("text", F.lit("\n")))).cast("bigint")
    corpus = read_packed_corpus(spark, path).withColumn("doc_id", F.struct(F.col("doc_id").cast("bigint").alias("doc_id"), n_lines.alias("n_lines")))
    return T.required_markers(corpus).select("doc_id.doc_id", "rule", "message", "doc_id.n_lines")


def q_workflow_redaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.redact_text(workflow_texts(spark, sf_dir))


def q_workflow_redaction_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = workflow_texts(spark, sf_dir).withColumn("part", F.pmod("doc_id", F.lit(3)))
    return T.redaction_counts(texts, by=("part",))


def q_workflow_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.scan_findings(workflow_texts(spark, sf_dir))


def q_rule_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.rule_scan(load_text(spark, sf_dir, "documents"), CORPUS_RULES)


def q_required_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.required_markers(load_text(spark, sf_dir, "documents"))


def q_rule_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.scan_findings(load_text(spark, sf_dir, "documents"), CORPUS_RULES)


def q_findings_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.findings_verdict(load_text(spark, sf_dir, "documents"), CORPUS_RULES)


def q_clip_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.clip_text(load_text(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "daily_country_sales": q_daily_country_sales,
    "normalise_orders": q_normalise_orders,
    "valid_orders": q_valid_orders,
    "derive_amount": q_derive_amount,
    "clean_orders": q_clean_orders,
    "dedupe_latest": q_dedupe_latest,
    "quality_profile": q_quality_profile,
    "quality_verdict": q_quality_verdict,
    "quality_gate_rules": q_quality_gate_rules,
    "duplicate_keys": q_duplicate_keys,
    "table_diff": q_table_diff,
    "table_row_counts": q_table_row_counts,
    "min_revenue": q_min_revenue,
    "bronze_audit": q_bronze_audit,
    "csv_ingest": q_csv_ingest,
    "layer_roundtrip": q_layer_roundtrip,
    "medallion_e2e": q_medallion_e2e,
    "stream_ingest": q_stream_ingest,
    "stage_metrics": q_stage_metrics,
    "redact_text": q_redact_text,
    "redaction_counts": q_redaction_counts,
    "extract_metrics": q_extract_metrics,
    "metrics_long": q_metrics_long,
    "metrics_wide": q_metrics_wide,
    "metrics_wide_rare_key": q_metrics_wide_rare_key,
    "metrics_report": q_metrics_report,
    "metric_keys": q_metric_keys,
    "log_file_metrics": q_log_file_metrics,
    "log_line_numbers": q_log_line_numbers,
    "stage_metrics_table": q_stage_metrics_table,
    "csv_rejections": q_csv_rejections,
    "csv_rejected_fields": q_csv_rejected_fields,
    "workflow_redaction": q_workflow_redaction,
    "workflow_redaction_counts": q_workflow_redaction_counts,
    "workflow_findings": q_workflow_findings,
    "workflow_file_findings": q_workflow_file_findings,
    "rule_scan": q_rule_scan,
    "required_markers": q_required_markers,
    "rule_findings": q_rule_findings,
    "findings_verdict": q_findings_verdict,
    "clip_text": q_clip_text,
}
