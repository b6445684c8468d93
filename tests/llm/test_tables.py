"""Vector search and URL filters against DuckDB, and the registered queries."""

from __future__ import annotations

import random

import duckdb
import pytest

import __spark_entry__ as E
from strata.llm import urls, vector_search
from tests.conftest import SF0001, SF001
from tests.oracle_harness import _rows, compare


def _same(frame, sql, **views):
    con = duckdb.connect()
    for name, path in views.items():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}/*.parquet')")
    cur = con.execute(sql)
    expected = _rows([d[0] for d in cur.description], cur.fetchall())
    assert _rows(frame.columns, [tuple(r) for r in frame.collect()]) == expected


def test_vector_search_on_odd_vectors(spark, tmp_dir):
    rng = random.Random(1)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, 1.0, 0.1]) for _ in range(4)]) for i in range(300)]
    rows += [(400, None), (450, [1.0, None, 0.0, 0.0]), (500, [float("nan")] * 4), (550, [1.0, 2.0]), (600, [0.5, 0.5])]
    rows += [(650, []), (None, [1.0] * 4), (700, [float("inf"), 0.0, 0.0, 0.0])]
    rows += [(1000 + i, [0.5] * 4) for i in range(100)]  # one common vector
    path = f"{tmp_dir}/vectors"
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4).write.parquet(path)
    vectors = spark.read.parquet(path)
    _same(vector_search.top_inner_products(vectors, vectors.filter("vec_id % 50 = 0")), vector_search.ORACLE_SQL, embeddings=path)
    assert vector_search.top_inner_products(vectors.filter("false"), vectors).count() == 0


def test_vector_search_on_repeated_rows(spark, tmp_dir):
    """Query ids that come twice: with equal vectors beside them, alone as their own best, and common ones."""
    rng = random.Random(3)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, 0.5]) for _ in range(4)]) for i in range(300, 350)]
    rows += [(50, [1.0] * 4)] * 2 + [(50 + i, [1.0] * 4) for i in range(1, 7)]
    rows += [(100, [8.0, 0.0, 0.0, 0.0]), (200, [0.25] * 4), (200, [0.0, 0.0, 2.0, 0.0])] + [(100, [8.0, 0.0, 0.0, 0.0])] + [(150, [0.0, 4.0, 0.0, 0.0])] * 9 + [(151, [0.0, 4.0, 0.0, 0.0])] * 9
    path = f"{tmp_dir}/vectors"
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4).write.parquet(path)
    vectors = spark.read.parquet(path)
    _same(vector_search.top_inner_products(vectors, vectors.filter("vec_id % 50 = 0")), vector_search.ORACLE_SQL, embeddings=path)
    once = vector_search.top_inner_products(vectors, vectors.filter("vec_id = 50").dropDuplicates(["vec_id"])).collect()
    assert [r.vec_id for r in sorted(once, key=lambda r: r.rank)] == [100, 100, 51, 52, 53]
    line = vectors.filter("vec_id BETWEEN 50 AND 56")
    once = vector_search.top_inner_products(line, line.filter("vec_id = 50").dropDuplicates(["vec_id"])).collect()
    assert [r.vec_id for r in sorted(once, key=lambda r: r.rank)] == [51, 52, 53, 54, 55]


def test_url_filters_on_odd_urls(spark, tmp_dir):
    rng = random.Random(2)
    hosts = ["a.example.net", "EXAMPLE.com", "x.org", "net", "b.net", "spam.biz", "www.spam.biz", "notexample.net"]
    paths = ["/en/1", "/fr/?a=/de/", "/de/#x", "", "?q=://z.com/en/", "#t", "/"]
    good, bad = "<p>" + "word " * 40 + "</p>", "<b>buy $$$</b>"
    rows = [(i, f"{rng.choice(['http', 'HTTPS'])}://{rng.choice(hosts)}{rng.choice(paths)}", good) for i in range(300)]
    rows = [(i, u, bad if "spam" in u else h) for i, u, h in rows]
    rows += [(900, None, good), (901, "", None), (902, "no scheme", bad), (903, "a://b://c/x", good), (904, "://", ""), (904, "://", "")]
    path = f"{tmp_dir}/pages"
    spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3).write.parquet(path)
    got = urls.filter_urls(spark.read.parquet(path), ["page_id"])
    from pyspark.sql import functions as F

    _same(got.withColumn("bound", F.round("bound", 6)), urls.ORACLE_SQL, pages=path)
    verdicts = {r.host: r.verdict for r in got.collect() if r.rule is None}
    assert verdicts["spam.biz"] == "block" and verdicts["example.com"] == "allow"
    assert got.filter("host = 'notexample.net'").select("rule").distinct().count() == 2  # net/ or, without a path, none
    assert urls.filter_urls(spark.read.parquet(path).filter("false"), ["page_id"]).count() == 0


@pytest.mark.parametrize("name", ["op6_vector_search", "op10_url_filters"])
def test_queries_match_their_sql(spark, name):
    result = compare(spark, name, SF001)
    assert result["columns_match"] and result["values_match"], result


def test_every_operator_is_registered():
    names = list(E.queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names


def test_pipeline_stages(spark):
    import corpus_pipeline as P
    from strata.llm.common import materialise, table
    from strata.llm.near_dup import near_duplicates
    from strata.llm.pii import base_spans
    from strata.llm.quality import quality_rules

    docs = table(spark, SF0001, "documents")
    columns, results = docs.columns, {}
    for name, stage in P.STAGES:
        before, docs = docs, materialise(stage(spark, docs, SF0001), name)
        results[name] = docs
        if name != "packing":
            assert docs.columns == columns and docs.schema == before.schema
    ids = {n: [r.doc_id for r in d.select("doc_id").collect()] for n, d in results.items()}
    source = table(spark, SF0001, "documents")
    kept = [r.doc_id for r in quality_rules(source, table(spark, SF0001, "labels")).filter("kept").collect()]
    assert sorted(ids["quality_rules"]) == sorted(kept)
    alone = [r.doc_id for r in near_duplicates(results["quality_rules"]).filter("kept").collect()]
    assert sorted(ids["near_dedup"]) == sorted(alone)
    assert sorted(ids["substring_dedup"]) == sorted(ids["pii"]) == sorted(alone) and set(ids["packing"]) == set(alone)
    for r in results["pii"].collect():
        assert not any(base_spans(r.text).values()) and r.n_chars == len(r.text)
