"""Threshold-scaled fingerprints against whole shingle sets and a plain loop."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pandas as pd
import pytest

from strata.llm import fingerprints as fp
from tests.conftest import SF0001


def _plain(rows):
    """The query's rows one after the other, in the order that the module states."""
    texts = [t or "" for _, t in rows]
    out = []
    for k, (i, _) in enumerate(rows):
        text, following = texts[k], texts[(k + 1) % len(rows)]
        n = len(text) // 4
        changed = text[: len(text) - n] + following[:n]
        own, other, after = (fp.decoded(fp.fingerprint(t)) for t in (text, changed, following))
        out.append(
            (i, len(text), hashlib.sha256(changed.encode()).hexdigest(), fp.fingerprint(text), fp.fingerprint(changed),
             fp.likeness(own, other), fp.likeness(own, after))
        )
    return sorted(out, key=str)


def _in_order(spark, docs):
    frame = docs.selectExpr("doc_id", "coalesce(text, '') AS text").selectExpr("*", "xxhash64(text) AS h")
    return [(r.doc_id, r.text) for r in frame.orderBy("doc_id", "h", "text").collect()]


def test_query(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    got = fp.op13_fingerprints(spark, SF0001).collect()
    assert sorted(map(tuple, got), key=str) == _plain(_in_order(spark, docs))


def test_odd_texts(spark, odd_docs):
    got = fp.edited_fingerprints(odd_docs).collect()
    assert sorted(map(tuple, got), key=str) == _plain(_in_order(spark, odd_docs))
    by_text = {}
    for r in fp.fingerprints(odd_docs, ["text", "kept"]).collect():
        by_text.setdefault(r.text or "", set()).add(r.fingerprint)
    assert all(len(f) == 1 for f in by_text.values())


@pytest.mark.parametrize("n", [0, 1, 2])
def test_few_rows(spark, n):
    rows = [(5, "a" * 30), (3, "one two")][:n]
    got = fp.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=str) == _plain(sorted(rows))


def test_a_common_id_is_dealt_to_many_ranges(spark):
    rows = [(7, f"text {i % 500} " * 9) for i in range(3000)] + [(i, f"other {i}") for i in range(1000)]
    rows += [(None, f"none {i}") for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = fp.edited_fingerprints(docs).collect()
    assert sorted(map(tuple, got), key=str) == _plain(_in_order(spark, docs))


def test_ranges_follow_the_order():
    rng = random.Random(2)
    rows = [(rng.choice([None, 3, 3, 3, rng.randint(0, 20)]), rng.randint(-(2**63), 2**63 - 1)) for _ in range(4000)]
    rows += [(i, h) for i in (None, 3) for h in (-(2**63), 2**63 - 1)]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    ranges = fp.Ranges([1, 3, 3, 3, 3, 8], 3)
    ids, hashes = (pd.Series([r[k] or 0 for r in rows]) for k in (0, 1))
    at = ranges.of_rows(ids, pd.Series([r[0] is not None for r in rows]), hashes)
    assert (np.diff(at) >= 0).all() and at[0] == 0 and at[-1] == ranges.n - 1
    assert np.bincount(at).max() < len(rows) / 4


def _words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n))


def test_likeness_and_containment_of_unequal_texts():
    rng = random.Random(3)
    errors = []
    for _ in range(40):
        long = _words(rng, 3000)
        start = rng.randint(0, 15_000)
        part = long[start : start + 4000] + _words(rng, 300)
        a, b = (fp.sketch(fp.shingle_hashes(t)) for t in (part, long))
        x, y = (set(fp.shingle_hashes(t).tolist()) for t in (part, long))
        errors.append(fp.containment(a, b) - len(x & y) / len(x))
        assert abs(fp.likeness(a, b) - len(x & y) / len(x | y)) < 0.12
        assert abs(errors[-1]) < 0.2 and fp.containment(b, a) < 0.45
    assert abs(np.mean(errors)) < 0.03
    short = [fp.sketch(fp.shingle_hashes(t)) for t in ("one short text, a few words", "one short text, a few words more")]
    x, y = (set(h.tolist()) for _, h in short)
    assert short[0][0] == short[1][0] == fp.COMPLETE and fp.likeness(*short) == len(x & y) / len(x | y)


def test_parts_merge_to_the_whole():
    rng = random.Random(4)
    for sizes in ((1, 2), (5, 900), (30, 2), (600, 700), (4, 4, 4), (0, 50)):
        parts = [fp.shingle_hashes(_words(rng, n)) for n in sizes]
        whole = fp.encoded(*fp.sketch(np.unique(np.concatenate(parts))))
        merged = fp.merged(*[fp.encoded(*fp.sketch(h)) for h in parts])
        bound, kept = fp.decoded(merged)
        every = np.unique(np.concatenate(parts))
        assert (kept == every[every <= bound]).all() and len(kept) >= min(len(every), fp.FLOOR)
        if all(len(h) <= fp.FLOOR for h in parts) or all(len(fp.sketch(h)[1]) > fp.FLOOR for h in parts):
            assert merged == whole


def test_hashes_of_parts_of_a_text(monkeypatch):
    text = _words(random.Random(5), 500) + "日本🎉" * 20
    whole = fp.shingle_hashes(text)
    runs = {text[i : i + fp.SHINGLE] for i in range(len(text) - fp.SHINGLE + 1)}
    assert len(whole) == len(runs)
    monkeypatch.setattr(fp, "CHUNK", 7)
    assert (fp.shingle_hashes(text) == whole).all()


def test_containments_of_pairs(spark):
    one, two = fp.fingerprint("a text of some words that goes on and on"), fp.fingerprint("")
    frame = spark.createDataFrame([(one, one, 1), (one, two, 2), (None, one, 3)], "a string, b string, likeness int").drop("likeness")
    rows = [(r.a_in_b, r.b_in_a, r.likeness) for r in fp.containments(frame).collect()]
    assert rows == [(1.0, 1.0, 1.0), (0.0, 1.0, 0.0), (None, None, None)]
