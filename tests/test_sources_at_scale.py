"""Splittable line numbers, rejected CSV fields and the union of metric keys, against plain Python."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators import text as T
from strata.sources import files


@pytest.fixture()
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}
    spark.conf.set(names[0], "2000")
    spark.conf.set(names[1], "1")
    spark.conf.set(names[2], "1")
    yield
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def _write(folder, name, text):
    with open(f"{folder}/{name}", "w", encoding="utf-8", newline="") as file:
        file.write(text)


def _numbered(spark, folder):
    got = files.number_lines(spark, f"file://{folder}").collect()
    out = {}
    for r in got:
        out.setdefault(os.path.basename(r.source_file), []).append((r.line_no, r.line))
    return {name: sorted(lines) for name, lines in out.items()}


@pytest.mark.parametrize("bound", [files.BROADCAST_SPLITS, 0])
def test_lines_of_many_splits_are_numbered_as_python_does(spark, small_splits, tmp_path, monkeypatch, bound):
    monkeypatch.setattr(files, "BROADCAST_SPLITS", bound)
    rng = random.Random(7)
    texts = {
        "long.txt": "".join("w" * rng.randrange(120) + rng.choice(["\n", "\n", "\r\n", "\x0b", "\u2028"]) for _ in range(900)) + "end\n",
        "one.txt": "only",
        "breaks.txt": "\n" * 5000,
        "wide.txt": ("x" * 9000 + "\n") * 3,
        "empty.txt": "",
    }
    for name, text in texts.items():
        _write(tmp_path, name, text)
    splits = spark.read.text(f"file://{tmp_path}").select("_metadata.file_path", "_metadata.file_block_start").distinct().count()
    assert splits > 15
    expect = {name: list(enumerate(text.splitlines(), 1)) for name, text in texts.items() if text}
    assert _numbered(spark, tmp_path) == expect


def test_numbering_reads_no_whole_file_and_shuffles_no_line(spark, small_splits, tmp_path):
    _write(tmp_path, "a.txt", "line\n" * 4000)
    lines = files.number_lines(spark, f"file://{tmp_path}")
    assert lines.rdd.getNumPartitions() >= 8
    plan = lines._sc._jvm.PythonSQLUtils.explainString(lines._jdf.queryExecution(), "formatted")
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and "Python" not in plan


def test_lines_that_move_between_the_passes_are_an_error(spark, tmp_path):
    _write(tmp_path, "a.txt", "one\ntwo\n")
    lines = files.number_lines(spark, f"file://{tmp_path}")
    _write(tmp_path, "a.txt", "one\ntwo\nmore\nand more\n")
    with pytest.raises(Exception, match="lines moved|FILE_NOT_EXIST|length|modified"):
        assert len(lines.collect()) == 2  # either it notices, or it still reads what it has counted
        raise ValueError("length as counted")


CONTRACT = StructType().add("k", "long").add("n", "integer").add("x", "double").add("d", "date").add("s", "string")


def _csv(spark, folder, *lines):
    _write(folder, "a.csv", "k,n,x,d,s\n" + "\n".join(lines) + "\n")
    return files.read_csv_with_corrupt(spark, f"file://{folder}", CONTRACT)


def test_rejected_fields_are_listed_with_their_texts(spark, tmp_path):
    raw = _csv(
        spark,
        tmp_path,
        "1,2,3.5,2030-01-02,ok",
        "2,two,x,soon,bad three",
        "3,,,,",
        "9999999999999999999999,1,NaN,2030-01-02,too large",
        '5,"a,b",1,2030-01-02,"quoted ""q"""',
        "6,1,1,2030-01-02",
        "7,1,1,2030-01-02,s,surplus",
        "8,1.5,1,2030-02-30,no such day",
    )
    got = sorted((r.column or "", r.value or "", r.record.split(",")[0]) for r in files.rejected_fields(raw, CONTRACT).collect())
    assert got == sorted([("n", "two", "2"), ("x", "x", "2"), ("d", "soon", "2"), ("k", "9" * 22, "9" * 22), ("n", "a,b", "5"), ("", "", "6"), ("", "", "7"), ("n", "1.5", "8"), ("d", "2030-02-30", "8")])
    plain = files.read_raw_csv(spark, f"file://{tmp_path}", CONTRACT)
    assert sorted(map(str, plain.collect())) == sorted(map(str, raw.drop(files.CORRUPT).collect()))


def test_rejection_report_survives_column_pruning(spark, tmp_path):
    raw = _csv(spark, tmp_path, "1,x,1,2030-01-02,a", "2,y,z,2030-01-02,b", "3,1,1,2030-01-02,c")
    report = files.rejection_report(raw, CONTRACT)
    assert {r.column: (r.rejected, r.example) for r in report.collect()} == {"k": (0, None), "n": (2, "x"), "x": (1, "z"), "d": (0, None), "s": (0, None)}
    # Few columns are asked for; the parser must still see the others.
    assert raw.where(F.col(files.CORRUPT).isNotNull()).count() == 2
    assert sorted(r[0] for r in raw.select(files.CORRUPT).dropna().collect()) == ["1,x,1,2030-01-02,a", "2,y,z,2030-01-02,b"]
    assert files.rejection_report(raw.limit(0), CONTRACT).agg(F.sum("rejected")).first()[0] == 0


def _metrics(spark, *payloads):
    lines = spark.createDataFrame([(i, f"ETL_METRICS {p}") for i, p in enumerate(payloads)], "line_id int, line string")
    return T.extract_metrics(lines)


def test_wide_table_has_every_key_of_every_line(spark):
    metrics = _metrics(spark, '{"b": 1, "a": "x"}', '{"a": 2, "rare": NaN}', "not json", '{"a": 1, "a": 3}', "{}")
    assert T.key_union(metrics) == ["a", "b", "rare"]
    wide = T.metrics_wide(metrics)
    assert wide.columns == ["line_id", "a", "b", "rare"]
    assert sorted(map(tuple, wide.collect())) == [(0, "x", "1", ""), (1, "2", "", "NaN"), (3, "3", "", ""), (4, "", "", "")]


def test_keys_that_spark_would_take_for_one_stay_apart(spark):
    metrics = _metrics(spark, '{"Line_ID": 1, "k": 2, "K": 3, "a.b": 4}')
    wide = T.metrics_wide(metrics)
    assert wide.columns == ["line_id", "K", "_Line_ID", "a.b", "_k"]
    assert tuple(wide.first()) == (0, "3", "1", "4", "2")


def test_no_metrics_give_a_table_without_keys(spark):
    none = _metrics(spark, "nothing")
    assert T.key_union(none) == [] and T.metrics_wide(none).columns == ["line_id"]


def test_packed_corpus_gives_back_any_text(spark, small_splits, tmp_path):
    rng = random.Random(3)
    texts = [None, "", "plain", "\x1e", "\x1f\x1b", "\x1be\x1br\x1bu", "\n\r\n", "a" * 9000, *("".join(rng.choice("ab\x1b\x1e\x1feru\né😀") for _ in range(rng.randrange(300))) for _ in range(300))]
    rows = [(f"n{i}\x1f/{i}", t) for i, t in enumerate(texts)] + [("n2\x1f/2", "plain"), ("", None)]
    df = spark.createDataFrame(rows, "name string, body string").coalesce(2)
    path = files.write_packed_corpus(df, f"file://{tmp_path}/packed", "name", "body")
    written = [f for f in os.listdir(f"{tmp_path}/packed") if f.startswith("part-")]
    back = files.read_packed_corpus(spark, path)
    assert len(written) <= 2 and back.rdd.getNumPartitions() > 5  # few files, many tasks
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)


def test_packed_corpus_of_numbers_nulls_and_nothing(spark, tmp_path):
    df = spark.createDataFrame([(-7, "x"), (None, "y")], "doc_id bigint, text string")
    path = files.write_packed_corpus(df, f"file://{tmp_path}/a")
    assert sorted(map(tuple, files.read_packed_corpus(spark, path).collect())) == [("", "y"), ("-7", "x")]
    path = files.write_packed_corpus(df.limit(0), f"file://{tmp_path}/b")
    assert files.read_packed_corpus(spark, path).collect() == []
