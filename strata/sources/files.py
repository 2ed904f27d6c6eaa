"""File sources and sinks: the CSV landing contract, log files and text corpora."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.functions.columns import EXTRA_LINE_BREAKS, python_lines
from strata.schemas import RAW_ORDERS
from strata.session import released_shuffles, scratch_path


def read_raw_csv(spark: SparkSession, path: str, schema: StructType = RAW_ORDERS) -> DataFrame:
    """Scan a CSV file or folder under the explicit contract schema.

    ``header`` is skipped and columns are taken by position; PERMISSIVE mode
    turns an unparsable field into NULL and keeps the rest of the row.
    """
    return spark.read.option("header", "true").option("mode", "PERMISSIVE").schema(schema).csv(path)


# The raw line of a row in which a field could not be parsed.
CORRUPT = "_corrupt"


def read_csv_with_corrupt(spark: SparkSession, path: str, schema: StructType = RAW_ORDERS) -> DataFrame:
    """``read_raw_csv``, with the raw line in ``_corrupt`` where a field was rejected or the number of fields differs.

    The parser fills that column only for the columns that it reads, and a
    query that asks for few would have the others pruned. An observation of
    all columns stands above the scan, so all are always parsed, whatever is
    selected.
    """
    whole = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    reader = spark.read.option("header", "true").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    raw = reader.schema(whole).csv(path)
    parsed = [F.count(f"`{f.name}`").alias(f"column{k}") for k, f in enumerate(schema.fields)]
    return raw.observe(f"csv-contract-{uuid.uuid4().hex[:12]}", *parsed)


def rejected_fields(raw: DataFrame, schema: StructType = RAW_ORDERS) -> DataFrame:
    """``(column, value, record)`` for each field that the contract scan turned into NULL.

    ``raw`` comes from ``read_csv_with_corrupt``. Only its corrupt records
    are split again, as text; a field with text whose typed value is NULL was
    rejected. A record that is corrupt for its number of fields (a surplus
    one with text, or nothing else that was rejected) gives a row with a NULL
    column; its surplus or missing fields as such are not listed.
    """
    texts = ", ".join(f"c{k} STRING" for k in range(len(schema) + 1))
    # The extra last field shows a surplus; the parser would drop it.
    parsed = F.from_csv(F.col(CORRUPT), F.lit(texts))
    bad = raw.where(F.col(CORRUPT).isNotNull()).withColumn("fields", parsed)
    fields = [
        F.when(F.col(f"fields.c{k}").isNotNull() & F.col(f"`{f.name}`").isNull(), F.struct(F.lit(f.name).alias("column"), F.col(f"fields.c{k}").alias("value")))
        for k, f in enumerate(schema.fields)
    ]
    listed = F.filter(F.array(*fields), lambda f: f.isNotNull())
    surplus = F.col(f"fields.c{len(schema)}").isNotNull()
    whole = F.struct(F.lit(None).cast("string").alias("column"), F.lit(None).cast("string").alias("value"))
    listed = F.when(surplus | (F.size(listed) == 0), F.array_append(listed, whole)).otherwise(listed)
    return bad.select(F.explode(listed).alias("f"), F.col(CORRUPT).alias("record")).select("f.column", "f.value", "record")


def rejection_report(raw: DataFrame, schema: StructType = RAW_ORDERS) -> DataFrame:
    """``(column, rejected, example)`` for every column of the contract, those without rejected fields included.

    ``example`` is the smallest rejected text. One row per column: the
    rejected fields are counted in the tasks first.
    """
    found = rejected_fields(raw, schema).where("column is not null")
    counts = found.groupBy("column").agg(F.count(F.lit(1)).alias("rejected"), F.min("value").alias("example"))
    names = raw.sparkSession.createDataFrame([(f.name,) for f in schema.fields], "column string")
    return names.join(counts, "column", "left").select("column", F.coalesce("rejected", F.lit(0).cast("bigint")).alias("rejected"), "example")


# One task reads a compressed file whole, so none holds more rows than this.
ROWS_PER_COMPRESSED_FILE = 2_000_000


def write_raw_csv(df: DataFrame, path: str, mode: str = "overwrite", compression: str | None = None) -> str:
    """Write ``df`` as CSV with a header, keeping leading/trailing blanks intact.

    The CSV writer trims values by default; the two whitespace options keep
    padded keys such as ``' ORD-1'`` byte-exact for a later contract scan.
    With ``compression`` (``gzip``, ...) the scan reads the same rows from
    files of a bounded number of rows each.
    """
    writer = (
        df.write.mode(mode)
        .option("header", "true")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
    )
    if compression:
        writer = writer.option("compression", compression).option("maxRecordsPerFile", ROWS_PER_COMPRESSED_FILE)
    with released_shuffles(df.sparkSession):
        writer.csv(path)
    return path


def read_text_corpus(spark: SparkSession, path: str, glob: str = "*.{yml,yaml}") -> DataFrame:
    """One row per file under ``path`` matching ``glob``: ``(doc_id, file_name, text)``.

    ``doc_id`` is the full file path, so it is unique across folders.
    """
    raw = spark.read.text(path, wholetext=True, pathGlobFilter=glob)
    return raw.select(
        F.col("_metadata.file_path").alias("doc_id"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("value").alias("text"),
    )


# A packed corpus holds many texts in a file: each record is a name, a unit
# separator and the text (none after the name for a NULL text), and ends with
# a record separator. Inside a record both separators, and the escape itself,
# are written as an escape and a letter.
_RECORD, _UNIT, _ESCAPE = "\x1e", "\x1f", "\x1b"
_ESCAPES = ((_ESCAPE, "e"), (_RECORD, "r"), (_UNIT, "u"))


def _escaped(text: Column) -> Column:
    for char, letter in _ESCAPES:
        text = F.replace(text, F.lit(char), F.lit(_ESCAPE + letter))
    return text


def _unescaped(text: Column) -> Column:
    for char, letter in reversed(_ESCAPES):
        text = F.replace(text, F.lit(_ESCAPE + letter), F.lit(char))
    return text


def write_packed_corpus(df: DataFrame, path: str, name_col: str = "doc_id", text_col: str = "text") -> str:
    """Write texts to as many files as ``df`` has partitions, however many texts there are.

    A NULL name is written as an empty one. Any text comes back as it was,
    separators and line breaks included.
    """
    name = F.coalesce(F.col(name_col).cast("string"), F.lit(""))
    text = F.col(text_col)
    record = F.concat(_escaped(name), F.when(text.isNull(), F.lit("")).otherwise(F.concat(F.lit(_UNIT), _escaped(text))))
    df.select(record.alias("value")).write.option("lineSep", _RECORD).text(path)
    return path


def read_packed_corpus(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, text)`` of a packed corpus.

    Splittable: a record belongs to the split in which it begins, so a large
    file is read by many tasks and the driver lists files, not texts.
    """
    record = spark.read.option("lineSep", _RECORD).text(path).select(F.split("value", _UNIT, 2).alias("r"))
    return record.select(_unescaped(F.col("r")[0]).alias("doc_id"), _unescaped(F.get("r", F.lit(1))).alias("text"))


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """Log files as ``(source_file, line_pos, line)``; ``line_pos`` orders lines within a file.

    Splittable: a large file is read by many tasks and nothing is shuffled.
    ``line_pos`` is ``struct(block, seq, part)``: the byte offset of the
    file split, the read position inside that split (increasing within a
    task) and the sub-line index. The reader ends lines at \n, \r\n and \r;
    each such line is split again at Python's other line boundaries, so the
    lines and their order are those of ``str.splitlines()``.
    """
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        F.split(F.col("value"), EXTRA_LINE_BREAKS, -1).alias("parts"),
    )
    lines = raw.select("source_file", "block", "seq", F.posexplode("parts").alias("part", "line"))
    return lines.select(
        "source_file",
        F.struct("block", "seq", "part").alias("line_pos"),
        "line",
    )


# Line offsets are joined by a broadcast up to this many file splits (about
# 100 bytes each), by a shuffle beyond.
BROADCAST_SPLITS = 200_000


def number_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text files of any size as ``(source_file, line_no, line)`` with exact 1-based line numbers.

    Splittable: a distributed prefix sum. The lines of every file split are
    counted first, the counts of a file's splits are summed in the order of
    their offsets, and each split's share is joined back, so that no task
    reads a whole file and no line is shuffled. Inside a split the number
    follows from the position in the task, which reads a split from front to
    back. Lines end as in ``read_log_lines``. Files must not change between
    the two passes: a line that falls outside the count of its split is an
    error, not a wrong number.
    """
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.split(F.col("value"), EXTRA_LINE_BREAKS, -1).alias("parts"),
    )
    lines = raw.select("source_file", "block", F.explode("parts").alias("line")).withColumn("seq", F.monotonically_increasing_id())
    counts = lines.groupBy("source_file", "block").agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("n"))
    # One row for each split; those of one file meet in a window.
    earlier = Window.partitionBy("source_file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    folder = scratch_path(spark, "line-offsets")
    offsets.write.parquet(folder)
    offsets = spark.read.schema(offsets.schema).parquet(folder)
    if offsets.limit(BROADCAST_SPLITS + 1).count() <= BROADCAST_SPLITS:
        offsets = F.broadcast(offsets)
    place = F.col("seq") - F.col("first")
    inside = (place >= 0) & (place < F.col("n"))
    moved = F.raise_error(F.concat(F.lit("lines moved while they were numbered: "), F.col("source_file"))).cast("bigint")
    return lines.join(offsets, ["source_file", "block"], "left").select(
        "source_file", F.when(F.coalesce(inside, F.lit(False)), F.col("before") + place + 1).otherwise(moved).alias("line_no"), "line"
    )


def read_numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Small text files as ``(source_file, line_no, line)`` with 1-based line numbers.

    Each file is one row (one task reads it whole), which exact numbering
    needs; meant for files such as workflow definitions, not large logs
    (use ``read_log_lines``). Lines split like ``str.splitlines()``.
    """
    files = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("source_file"), F.col("value").alias("text")
    )
    return files.select(
        "source_file", F.posexplode(python_lines(F.col("text"))).alias("pos", "line")
    ).select("source_file", (F.col("pos") + F.lit(1)).alias("line_no"), "line")
