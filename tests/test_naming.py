"""Pure name functions (T1, T8, T9) and format/intake rules."""

from __future__ import annotations

import pytest

from strata.functions.naming import make_slug, standardize_name, standardize_names
from strata.sources.manifest import (
    MSG_EXTENSION,
    MSG_INVALID_NAME,
    MSG_NO_EXTENSION,
    MSG_XLS,
    detect_format,
    validate_filename,
)
from strata.sources.readers import normalize_format


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("Region Name", "region_name"),
        ("  Order  ID ", "order_id"),
        ("region-name", "region_name"),
        ("2nd", "c_2nd"),
        ("", "column"),
        ("___", "column"),
        ("a__b--c", "a_b_c"),
        ("Prix (€)", "prix"),
    ],
)
def test_standardize_name(raw, expected):
    assert standardize_name(raw) == expected


def test_standardize_names_collisions_are_recorded():
    # a, A, a_2: the generated a_2 is recorded, so the literal a_2 moves on.
    assert standardize_names(["a", "A", "a_2"]) == ["a", "a_2", "a_2_2"]
    assert standardize_names(["Region Name", "region-name", "2nd", "", "a", "A", "a_2"]) == [
        "region_name",
        "region_name_2",
        "c_2nd",
        "column",
        "a",
        "a_2",
        "a_2_2",
    ]
    names = standardize_names(["x"] * 5)
    assert names == ["x", "x_2", "x_3", "x_4", "x_5"] and len(set(names)) == 5


def test_make_slug():
    job = "1234abcd-ef56-7890-abcd-ef1234567890"
    assert make_slug("Sales Data.csv", job) == "sales_data_1234abcdef56"
    assert make_slug("2024 report.xlsx", job) == "t_2024_report_1234abcdef56"
    assert make_slug("!!!.csv", job) == "dataset_1234abcdef56"
    long = make_slug("a" * 40 + ".csv", job)
    assert long == "a" * 28 + "_1234abcdef56"


def test_slug_column_matches_python(spark):
    from pyspark.sql import functions as F

    from strata.functions.naming import slug_column

    job = "1234abcd-ef56-7890-abcd-ef1234567890"
    names = ["Sales Data.csv", "2024 report.xlsx", "!!!.csv", "a" * 40 + ".csv", "archive.tar.gz", "x.y.z.json"]
    df = spark.createDataFrame([(n, job) for n in names], "name STRING, job STRING")
    got = [r[0] for r in df.select(slug_column(F.col("name"), F.col("job"))).collect()]
    assert got == [make_slug(n, job) for n in names]


def test_normalize_format():
    assert normalize_format("CSV ") == "csv"
    assert normalize_format("xlsx") == "excel"
    assert normalize_format("xls") == "excel"
    assert normalize_format("Parquet") == "parquet"
    with pytest.raises(ValueError):
        normalize_format("avro")


def test_detect_format():
    assert detect_format("a.pq") == "parquet"
    assert detect_format("a.parquet") == "parquet"  # D8: mapped by name
    assert detect_format("a.XLSX") == "excel"
    assert detect_format("a.csv", b"PAR1") == "csv"  # the name wins
    assert detect_format("blob", b"PAR1....") == "parquet"
    assert detect_format("blob", b"  \n[{\"a\": 1}]") == "json"
    assert detect_format("blob", b"{\"a\": 1}") == "json"
    assert detect_format("blob", b"a,b\n1,2") == "csv"


def test_validate_filename():
    assert validate_filename("sales.csv") == (True, "sales.csv")
    assert validate_filename("my sales (1).csv") == (True, "my_sales__1_.csv")
    assert validate_filename("dir/sales.json") == (True, "sales.json")
    assert validate_filename("") == (False, MSG_INVALID_NAME)
    assert validate_filename("../x.csv") == (False, MSG_INVALID_NAME)
    assert validate_filename("/etc/x.csv") == (False, MSG_INVALID_NAME)
    assert validate_filename("notes.txt") == (False, MSG_EXTENSION)
    assert validate_filename("README") == (False, MSG_NO_EXTENSION)
    assert validate_filename("old.xls") == (False, MSG_XLS)
    ok, reason = validate_filename("big.csv", size=600 * 1024 * 1024, max_bytes=500 * 1024 * 1024)
    assert not ok and reason == "File exceeds 500 MB limit"
    assert validate_filename("edge.csv", size=500 * 1024 * 1024, max_bytes=500 * 1024 * 1024)[0]
    assert validate_filename("huge.csv", size=1 << 50)[0]  # no limit by default
