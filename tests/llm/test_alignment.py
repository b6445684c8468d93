"""Cross-tokenizer alignment against the two libraries over whole texts, token by token."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from strata.llm import alignment
from tests.conftest import SF0001

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pair():
    return alignment.TokenPair(*PATHS)


def whole_text(pair, text):
    """(ids of A, ids of B, links as positions, groups) of one text, encoded whole."""
    raw = (" " + text).encode() if text else b""
    a = pair.a.encode(" " + text, add_special_tokens=False).ids if text else []
    b = pair.b.encode(text, num_threads=1) if text else []
    if b"".join(pair.a_bytes[i] for i in a) != raw or b"".join(pair.b_bytes[i] for i in b) != raw:
        return [], [], [], ""
    ends = {e: j for j, e in enumerate(np.cumsum([len(pair.b_bytes[i]) for i in b]).tolist())}
    links = [(i, ends[e]) for i, e in enumerate(np.cumsum([len(pair.a_bytes[i]) for i in a]).tolist()) if e in ends]
    groups, x, y = [], 0, 0
    for i, j in links:
        groups.append(",".join(map(str, a[x : i + 1])) + "|" + ",".join(map(str, b[y : j + 1])))
        x, y = i + 1, j + 1
    return a, b, links, ";".join(groups)


def expected(pair, rows):
    found = [(i, whole_text(pair, t)) for i, t in rows]
    counts = Counter((a[x], b[y]) for _, (a, b, links, _) in found for x, y in links)
    best = Counter()
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    out = []
    for i, (a, b, links, groups) in found:
        own = [(counts[a[x], b[y]], best[b[y]]) for x, y in links]
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        n_groups = groups.count(";") + 1 if groups else 0
        out.append((i, len(a), len(b), n_groups, len(links), sum(n == m for n, m in own), sum(n for n, _ in own), digest))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_query_equals_the_libraries(spark, pair):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    got = alignment.op11_alignment(spark, SF0001).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == expected(pair, rows)


def test_query_on_odd_texts(spark, pair, odd_docs, odd_texts, tmp_dir):
    odd_docs.write.parquet(f"{tmp_dir}/documents.parquet")
    got = alignment.op11_alignment(spark, tmp_dir).select(*COLUMNS).collect()
    want = expected(pair, odd_texts)
    assert sorted(map(tuple, got), key=str) == want
    assert 0 < sum(r[1] == 0 for r in want) < len(want)


def test_no_documents(spark, no_docs, tmp_dir):
    no_docs.write.parquet(f"{tmp_dir}/documents.parquet")
    assert alignment.op11_alignment(spark, tmp_dir).columns == [*COLUMNS[:5], "groups_sha256", "n_best", "count_sum"]
    assert alignment.op11_alignment(spark, tmp_dir).count() == 0


def test_kept_columns_and_texts(spark, odd_docs):
    rows = alignment.aligned(odd_docs.filter("doc_id = 4").withColumn("links", odd_docs.kept), *PATHS, ["kept", "links"])
    assert rows.columns == ["kept", "n_a", "n_b", "n_groups", "n_links", "groups", "links"]
    (row,) = rows.collect()
    assert row.kept == "own" and row.groups.count("|") == row.n_groups == len(row.links) // 4


def test_products_against_dense():
    rng = np.random.default_rng(4)
    for _ in range(20):
        x, y = rng.integers(0, 2, (rng.integers(1, 9), 7)), rng.integers(0, 3, (7, rng.integers(1, 9)))
        a, b = (alignment.CSR.of_rows(*np.nonzero(m), *m.shape) for m in (x, y))
        b.data[:] = y[np.nonzero(y)]
        c = a @ b
        dense = np.zeros((len(x), y.shape[1]), np.int64)
        dense[c.rows(), c.indices] = c.data
        assert (dense == x @ y).all()
        t = b.transposed()
        dense = np.zeros(y.T.shape, np.int64)
        dense[t.rows(), t.indices] = t.data
        assert (dense == y.T).all()


def test_overlaps_and_groups():
    a, b = np.array([2, 3, 1, 4]), np.array([1, 4, 5])  # ends 2 5 6 10 and 1 5 10
    shared = alignment.overlap_links(a, b)
    assert list(zip(shared.rows().tolist(), shared.indices.tolist(), shared.data.tolist())) == [
        (0, 0, 1), (0, 1, 1), (1, 1, 3), (2, 2, 1), (3, 2, 4),
    ]
    grouped = alignment.shared_group_links(a, b)
    assert list(zip(grouped.rows().tolist(), grouped.indices.tolist())) == [(0, 0), (0, 1), (1, 0), (1, 1), (2, 2), (3, 2)]


def test_the_cache_forgets_and_batches(pair, monkeypatch):
    monkeypatch.setattr(alignment, "CACHE_STRETCHES", 3)
    monkeypatch.setattr(alignment, "BATCH_CHARS", 10)
    cache = alignment.StretchCache(pair)
    texts = ["one two three", "▁ four", "two  three\n", "x" * 100, "one two three"]
    for _ in range(2):
        for text, found in zip(texts, cache.results([alignment.CUT.split(t) for t in texts])):
            a, b, links, groups = whole_text(pair, text)
            assert (groups == "") if None in found else groups == ";".join(f[0] for f in found)
    assert all(len(s) <= alignment.CACHE_CHARS for s in cache.new)
