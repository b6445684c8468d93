"""Hard-negative mining against DuckDB and against plain products."""

from __future__ import annotations

import random

import duckdb
import numpy as np
import pytest

from strata.llm import negatives
from tests.oracle_harness import _rows


def _mined(spark, path):
    vectors = spark.read.parquet(f"{path}/embeddings.parquet")
    frame = negatives.op12_hard_negatives(spark, path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{path}/embeddings.parquet/*.parquet')")
    cur = con.execute(negatives.ORACLE_SQL)
    want = _rows([d[0] for d in cur.description], cur.fetchall())
    assert _rows(frame.columns, [tuple(r) for r in frame.collect()]) == want
    return vectors, want


SCHEMA = "vec_id long, embedding array<float>, label int, anchor string, rank string"


def _write(spark, path, rows):
    frame = spark.createDataFrame([(*r, "own", None) for r in rows], SCHEMA)
    frame.repartition(3).write.parquet(f"{path}/embeddings.parquet")


def test_odd_rows(spark, tmp_dir):
    rng = random.Random(8)
    pick = [-0.5, 0.0, 0.25, 1.0, 0.1]
    rows = [(i, [rng.choice(pick) for _ in range(5)], rng.randint(0, 3)) for i in range(400)]
    rows += [(1000, None, 1), (1050, [1.0, None, 0.0, 0.0, 0.0], 1), (1100, [float("nan")] * 5, 1), (1150, [1.0, 0.5], 1), (1151, [1.0, 0.5], 1)]
    rows += [(1152, [1.0, 0.0], 2), (1200, [], 1), (None, [1.0] * 5, 1), (1250, [float("inf")] + [0.0] * 4, 1), (1300, [0.25] * 5, None)]
    rows += [(-50, [0.25, 0.5, 1.0, 0.1, 0.0], 2), (1350, [1.0] * 5, 9), (1400, [1.0] * 5, -3)]
    rows += [(2000 + i, [0.5] * 5, rng.randint(0, 1)) for i in range(300)]  # one common vector
    rows += [rows[50]] * 2 + [rows[51]] * 3 + [(100, [0.75] * 5, 3), (100, [0.75] * 5, 1)]  # repeated rows and ids
    _write(spark, tmp_dir, rows)
    _, want = _mined(spark, tmp_dir)
    assert sum(want[1].values()) > 20


def test_large_components(spark, tmp_dir):
    rng = random.Random(9)
    rows = [(i, [rng.choice([1e6, 2e6, -1e6, 3e5, 1e7]) for _ in range(3)], i % 3) for i in range(300)]  # scores near 2**63
    rows += [(400 + i, [1e4, 2.0 + i % 7, -5e6], i % 2) for i in range(30)]
    _write(spark, tmp_dir, rows)
    _, want = _mined(spark, tmp_dir)
    assert sum(want[1].values()) > 5


def test_no_rows(spark, tmp_dir):
    _write(spark, tmp_dir, [])
    frame = negatives.op12_hard_negatives(spark, tmp_dir)
    assert frame.count() == 0 and frame.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_heaps_handed_on_early(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(negatives, "HELD", 3)
    monkeypatch.setattr(negatives, "BLOCK", 16)
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", 2)
    rng = random.Random(10)
    _write(spark, tmp_dir, [(i, [rng.random() for _ in range(8)], rng.randint(0, 4)) for i in range(500)])
    _, want = _mined(spark, tmp_dir)
    assert sum(want[1].values()) > 5


@pytest.mark.parametrize("shape", [(1, 1, 1), (3, 5, 7), (64, 64, 64), (33, 70, 129), (2, 100, 2), (0, 5, 3)])
def test_strassen_equals_the_plain_product(shape):
    rng = np.random.default_rng(5)
    n, k, m = shape
    a, b = rng.integers(-(2**31), 2**31, (n, k)), rng.integers(-(2**20), 2**20, (k, m))
    assert (negatives.strassen(a, b, 4) == a @ b).all()
    assert (negatives.strassen(a, b) == a @ b).all()


def test_scores_beyond_a_long():
    huge = np.full((2, 40), 2**62)
    assert negatives.tile_scores(huge, -huge).tolist() == [[-(2**63 - 1)] * 2] * 2
    mixed = np.array([[2**40, 2**40, 7]]), np.array([[2**40, -(2**40), 3]])  # parts beyond a long, the score is not
    assert negatives.tile_scores(*mixed).tolist() == [[21]]


def test_heaps_merge():
    one, two, both = (negatives.Heaps(3) for _ in range(3))
    rng = np.random.default_rng(6)
    for heaps in (one, two):
        for _ in range(10):
            scores, ids = -np.sort(-rng.integers(0, 5, 3)), np.sort(rng.integers(0, 50, 3))
            heaps.add((1,), scores, ids)
            both.add((1,), scores, ids)
    rows = [(-s, i) for _, s, i in one.take() + two.take()]
    assert sorted(rows)[:3] == sorted((-s, i) for _, s, i in both.take()) and one.size == 0
