"""CSV dialects, headers and columns against DuckDB and Python's writer."""

from __future__ import annotations

import csv
import datetime as dt
import io
import random

import duckdb
import pytest
from pyspark.sql import types as T

from strata.sources import csv_dialect
from strata.sources.csv_dialect import Dialect
from strata.sources.readers import load

WORDS = ["plain", "with, comma", "semi; colon", "pipe | here", 'say "hi"', "it's", "tab\there", "x"]


def _write(path, text):
    with open(path, "w", newline="") as f:
        f.write(text)
    return str(path)


def _text(rows, sep, quotechar='"', **more):
    out = io.StringIO()
    csv.writer(out, delimiter=sep, quotechar=quotechar, lineterminator="\n", **more).writerows(rows)
    return out.getvalue()


@pytest.mark.parametrize("sep", [",", ";", "\t", "|"])
@pytest.mark.parametrize("quote", ['"', "'"])
def test_delimiters_and_quotes(spark, tmp_dir, sep, quote):
    rng = random.Random(sep + quote)
    words = [w for w in WORDS if (quote == "'" or "'" not in w) and (quote == '"' or '"' not in w)]
    if quote == "'":
        words = [w for w in words if "'" not in w]
    rows = [[i, rng.choice(words), rng.choice(words), i / 4] for i in range(80)]
    path = _write(f"{tmp_dir}/t.csv", _text([["id", "one", "two", "amount"], *rows], sep, quote))
    frame = load(spark, path, "csv")
    assert frame.dtypes == [("id", "int"), ("one", "string"), ("two", "string"), ("amount", "double")]
    assert sorted(map(list, frame.collect())) == rows


@pytest.mark.parametrize("sep", [";", "\t", "|"])
def test_quoted_delimiters_equal_duckdb(spark, tmp_dir, sep):
    rng = random.Random(4)
    rows = [[i, f"a{sep}b {rng.choice(WORDS)}", dt.date(2024, 1, 1 + i % 28).isoformat()] for i in range(200)]
    path = _write(f"{tmp_dir}/t.csv", _text([["id", "words", "day"], *rows], sep, quoting=csv.QUOTE_NONNUMERIC))
    got = sorted(map(tuple, load(spark, path, "csv").collect()))
    assert got == sorted(duckdb.sql(f"SELECT * FROM read_csv_auto('{path}')").fetchall())


def test_backslash_escapes(spark, tmp_dir):
    path = _write(f"{tmp_dir}/t.csv", 'id,t\n1,"say \\"hi\\", you"\n2,"plain"\n')
    assert [tuple(r) for r in load(spark, path, "csv").orderBy("id").collect()] == [(1, 'say "hi", you'), (2, "plain")]


def test_decimal_commas_do_not_cut(spark, tmp_dir):
    path = _write(f"{tmp_dir}/t.csv", "a;b;c\n" + "".join(f"{i},5;{i},25;x\n" for i in range(20)))
    frame = load(spark, path, "csv")
    assert frame.columns == ["a", "b", "c"] and frame.count() == 20


def test_headers_in_another_order_with_missing_and_extra_columns(spark, tmp_dir):
    _write(f"{tmp_dir}/1.csv", "a,b\n1,10\n2,20\n")
    _write(f"{tmp_dir}/2.csv", "b,a\n30,3\n")
    _write(f"{tmp_dir}/3.csv", "B;c\n4.5;x\n")
    _write(f"{tmp_dir}/4 with blank.csv", "c|a\n007|4\n")
    _write(f"{tmp_dir}/5.csv", "a,b\n")
    frame = load(spark, tmp_dir, "csv")
    assert frame.dtypes == [("a", "int"), ("b", "double"), ("c", "string")] or frame.dtypes == [("a", "string"), ("b", "string"), ("c", "string")]
    rows = sorted(map(tuple, frame.select(F_int("a"), "b", "c").collect()), key=str)
    assert [(a, None if b is None else float(b), c) for a, b, c in rows] == sorted(
        [(1, 10.0, None), (2, 20.0, None), (3, 30.0, None), (None, 4.5, "x"), (4, None, "007")], key=str
    )


def F_int(name):
    from pyspark.sql import functions as F

    return F.col(name).cast("int").alias(name)


def test_types_join_without_a_narrower_reading(spark, tmp_dir):
    _write(f"{tmp_dir}/1.csv", "code,n,day\n007,1,2024-01-02\n")
    _write(f"{tmp_dir}/2.csv", "n,code,day\n2.5,x1,2024-01-02 10:00:00\n")
    frame = load(spark, tmp_dir, "csv")
    assert frame.dtypes == [("code", "string"), ("n", "double"), ("day", "timestamp")]
    assert sorted((r.code, r.n, r.day.day) for r in frame.collect()) == [("007", 1.0, 2), ("x1", 2.5, 2)]


def test_no_header(spark, tmp_dir):
    path = _write(f"{tmp_dir}/t.csv", "1,foo,2024-01-01\n2,bar,2024-01-02\n")
    frame = load(spark, path, "csv")
    assert frame.count() == 2 == duckdb.sql(f"SELECT count(*) FROM read_csv_auto('{path}')").fetchall()[0][0]
    assert [t for _, t in frame.dtypes] == ["int", "string", "date"]
    folder = f"{tmp_dir}/many"
    import os

    os.mkdir(folder)
    for k in range(3):
        _write(f"{folder}/{k}.csv", f"{k},a{k}\n{k + 10},b\n")
    assert sorted(r[0] for r in load(spark, folder, "csv").collect()) == [0, 1, 2, 10, 11, 12]


def test_numbers_as_names_stay_a_header(spark, tmp_dir):
    path = _write(f"{tmp_dir}/t.csv", "country,2020,2021\nx,1,2\ny,3,4\n")
    assert load(spark, path, "csv").columns != ["country", "2020", "2021"] or load(spark, path, "csv").count() == 2
    path = _write(f"{tmp_dir}/u.csv", "2020,2021\nx,1\ny,b\n")
    assert load(spark, path, "csv").columns == ["2020", "2021"]
    told = load(spark, f"{tmp_dir}/t.csv", "csv", {"header": "true"})
    assert told.columns == ["country", "2020", "2021"] and told.count() == 2


def test_given_options_and_schema(spark, tmp_dir):
    path = _write(f"{tmp_dir}/t.csv", "a;b\n1;x,y\n2;z\n")
    assert load(spark, path, "csv", {"sep": ","}).columns != ["a", "b"]
    assert load(spark, path, "csv", {"header": "false"}).count() == 3
    assert load(spark, path, "csv", {"detect": "false"}).columns == ["a;b"]
    _write(f"{tmp_dir}/u.csv", "b;a\nw;3\n")
    typed = load(spark, f"{tmp_dir}/*.csv", "csv", schema="a STRING, b STRING, more INT")
    assert typed.dtypes == [("a", "string"), ("b", "string"), ("more", "int")]
    assert sorted(map(tuple, typed.collect())) == [("1", "x,y", None), ("2", "z", None), ("3", "w", None)]


def test_histograms_are_one_scan_and_add_up(spark, tmp_dir):
    _write(f"{tmp_dir}/1.csv", "a,b\n1,2\n\n3,4\n")
    _write(f"{tmp_dir}/2.csv", "a,b\n1\n")
    found = csv_dialect.histograms(spark, tmp_dir)
    rows = found.filter("candidate = 0").groupBy("n_fields").sum("lines").collect()
    assert {r[0]: r[1] for r in rows} == {2: 4, 1: 1}
    plan = csv_dialect.histograms(spark, f"{tmp_dir}/1.csv")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") <= 2


@pytest.mark.parametrize(
    ("a", "b", "joined"),
    [
        (T.IntegerType(), T.IntegerType(), T.IntegerType()),
        (T.IntegerType(), T.LongType(), T.LongType()),
        (T.IntegerType(), T.DoubleType(), T.DoubleType()),
        (T.LongType(), T.DecimalType(22, 0), T.DecimalType(22, 0)),
        (T.DecimalType(38, 0), T.DoubleType(), T.DoubleType()),
        (T.DateType(), T.TimestampType(), T.TimestampType()),
        (T.BooleanType(), T.IntegerType(), T.StringType()),
        (T.StringType(), T.DateType(), T.StringType()),
    ],
)
def test_type_lattice(a, b, joined):
    assert csv_dialect.join_types(a, b) == joined == csv_dialect.join_types(b, a)


def test_fields_of_a_line():
    assert Dialect(";", '"', '"').fields('a;"b;""c""";d') == ["a", 'b;"c"', "d"]
    assert Dialect(",", '"').fields('a,"b\\"c"') == ["a", 'b"c']
    assert len(Dialect().fields("x" * 200_000 + ",y")) == 2


def test_lines_are_counted_without_being_sorted(spark, tmp_dir):
    """the counts of all lines stay in a hash table; lines are neither sorted nor spilled."""
    _write(f"{tmp_dir}/1.csv", "a,b\n1,2\n")
    counted = csv_dialect._counted(csv_dialect._lines(spark, tmp_dir, {}), csv_dialect._candidates({}))
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan
    assert "SortAggregate" not in plan and "Sort [" not in plan


def test_first_line_of_a_file_of_many_blocks(spark, tmp_dir):
    _write(f"{tmp_dir}/1.csv", "\n" * 300 + "key;text\n" + "".join(f"{i};t{i}\n" for i in range(400)))
    _write(f"{tmp_dir}/2.csv", "text,key\n" + "".join(f"u{i},{i}\n" for i in range(400)))
    known = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256b")
    try:
        found = csv_dialect.histograms(spark, tmp_dir)
        lines = {(r.file[-5:], r.first_line) for r in found.select("file", "first_line").distinct().collect()}
        sums = found.filter("candidate = 0").groupBy("file").sum("lines").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", known)
    assert lines == {("1.csv", "key;text"), ("2.csv", "text,key")}
    assert {r[1] for r in sums} == {401}
