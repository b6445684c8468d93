"""Operators on single texts against their libraries or brute force."""

from __future__ import annotations

import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strata.llm import packing, pii, quality, sentencepieces, token_counts
from tests.conftest import SF0001

PIECE = public_tokenizers.path("piece_bpe_32k.model")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def test_sentencepiece_matches_the_library(odd_docs, no_docs):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    rows = sentencepieces.encode_decode(odd_docs, PIECE, ["doc_id", "text", "kept"]).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        ids = library.encode(r.text or "")
        assert (r.n_tokens, r.ids, r.kept) == (len(ids), ",".join(map(str, ids)), "own")
        assert r.decoded == library.decode(ids)
    assert sentencepieces.encode_decode(no_docs, PIECE, ["doc_id"]).count() == 0


def test_sentencepiece_decodes_any_ids():
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    model = sentencepieces.PieceModel(PIECE)
    rng = np.random.default_rng(3)
    for _ in range(200):
        ids = [int(i) for i in rng.integers(3, 32_000, 12)]
        assert model.decode(ids) == library.decode(ids)


def test_token_counts_do_not_depend_on_the_sample(odd_docs, monkeypatch):
    """the frequent pre-tokens come from all documents or a sample; every length is the tokenizer's."""
    library = Tokenizer.from_file(BYTE)
    rows = {}
    for size in (10, 10**9):
        monkeypatch.setattr(token_counts, "SAMPLE_DOCS", size)
        rows[size] = token_counts.token_counts(odd_docs, BYTE, ["doc_id", "text"]).collect()
    assert collections.Counter(map(tuple, rows[10])) == collections.Counter(map(tuple, rows[10**9]))
    for r in rows[10]:
        assert r.n_tokens == len(library.encode(r.text or "", add_special_tokens=False))


def test_token_counts_match_the_library(odd_docs, no_docs):
    library = Tokenizer.from_file(BYTE)
    rows = token_counts.token_counts(odd_docs, BYTE, ["doc_id", "text", "n_words"]).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        text = r.text or ""
        assert (r.n_bytes, r.n_tokens, r.n_words) == (len(text.encode()), len(library.encode(text, add_special_tokens=False)), -1)
    assert token_counts.token_counts(no_docs, BYTE, ["doc_id"]).count() == 0


def test_a_small_cache_gives_the_same_counts(odd_docs, monkeypatch):
    monkeypatch.setattr(token_counts, "FREQUENT", 5)
    library = Tokenizer.from_file(BYTE)
    for r in token_counts.token_counts(odd_docs, BYTE, ["text"]).collect():
        assert r.n_tokens == len(library.encode(r.text or "", add_special_tokens=False))


def test_packing_places_every_token_once(odd_docs, no_docs):
    library = Tokenizer.from_file(WORD)
    docs = odd_docs.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    texts = dict(docs.select("doc_id", "text").collect())
    pieces = packing.pack_documents(docs, WORD).toPandas().sort_values(["doc_id", "start"])
    assert set(pieces["doc_id"]) == set(texts)
    for doc_id, own in pieces.groupby("doc_id"):
        ids = [*library.encode(texts[doc_id] or "", add_special_tokens=False).ids, 1]
        assert own["length"].sum() == len(ids) and (own["doc_tokens"] == len(ids)).all()
        for r in own.itertuples():
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    placed = pieces.sort_values(["sequence_id", "offset"])
    ends = placed.groupby("sequence_id")["length"].cumsum()
    assert (ends - placed["length"] == placed["offset"]).all() and ends.max() <= packing.WINDOW
    assert packing.pack_documents(no_docs, WORD).count() == 0


def test_packing_sends_only_words_that_are_not_plain_through_the_tokenizer():
    tokenizer = packing.load_tokenizer(WORD)
    sent = []

    class Counting:
        model, get_vocab = tokenizer.model, tokenizer.get_vocab

        def encode_batch_fast(self, words, **options):
            sent.extend(words)
            return tokenizer.encode_batch_fast(words, **options)

    plain = ["Hello hello, hello### IT'S 12 e1f2 \u00c9t\u00e9s \u0120\u01e7 soft\u00adhy", "", " x" * 3]
    odd = ["\u0181b \u018fx \u023a \u212a \u0130 <|endoftext|>z a\x1cb \x00", "e\u0301 \u4e2d\u6587 'S 'll"]
    words = packing.WordIds(Counting())
    for texts in (plain, odd, plain + odd):
        found = [np.frombuffer(x, "<u4").tolist() for x in words.results(texts)]
        assert found == [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    assert not set(sent) & {w for text in plain for w in text.split()}


def test_packing_plan_uses_the_histogram_up():
    rng = np.random.default_rng(1)
    counts = np.bincount(rng.integers(1, 513, 20_000), minlength=513)
    planned = packing.plan(counts, 512)
    used = np.zeros_like(counts)
    for combo, n in planned:
        assert sum(combo) <= 512 and n > 0
        np.add.at(used, np.array(combo), n)
    assert (used == counts).all()
    windows = sum(n for _, n in planned)
    tokens = (counts * np.arange(513)).sum()
    assert windows * 512 <= 1.02 * tokens + 512


def _base_rules(text):
    words = WORDS.findall(text or "")
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {p for v in windows.values() if len(v) > 1 for i in v for p in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_quality_rules_match_brute_force(odd_docs, labels, no_docs):
    xxhash = pytest.importorskip("xxhash")
    docs = odd_docs.drop("n_words", "kept")
    rows = quality.quality_rules(docs, labels).collect()
    assert len(rows) == docs.count()

    def grams(text):
        h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in WORDS.findall(text or "")]
        pairs = [xxhash.xxh64_intdigest(b.to_bytes(8, "little"), xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42)) for a, b in zip(h, h[1:])]  # noqa: B905
        return [(x - (x >> 63 << 64)) % quality.BUCKETS for x in h + pairs]

    trusted = {i for i in range(20) if i % 2}
    raw, target = np.full(quality.BUCKETS, quality.SMOOTHING), np.zeros(quality.BUCKETS)
    for r in rows:
        found = grams(r.text)
        np.add.at(raw, found, 1)
        if r.doc_id in trusted:
            np.add.at(target, found, 1)
    share = raw / raw.sum()
    ratio = np.round(np.log((target + quality.PRIOR_GRAMS * share) / (target.sum() + quality.PRIOR_GRAMS)) - np.log(share), 6)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == _base_rules(r.text)
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        found = grams(r.text)
        score = float(ratio[found].mean()) if found else 0.0
        assert abs(r.score - score) < 5e-6
        if abs(score - quality.MIN_SCORE) > 1e-4:
            assert r.kept == (not r.base_failed and score >= quality.MIN_SCORE)
    kept = {r.doc_id for r in rows if r.kept}
    assert {r.doc_id for r in quality.kept_documents(odd_docs.drop("n_words", "kept"), labels).collect()} == kept
    assert quality.quality_rules(no_docs, labels).count() == 0
    assert {r.score for r in quality.quality_rules(docs, labels.filter("false")).collect()} == {0.0}


def test_quality_plan_has_no_python_and_no_text_shuffle(spark, labels):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    plan = quality.quality_rules(docs, labels)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def _luhn(digits):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(digits[::-1])) % 10 == 0


def _pii(text):
    text, digits = text or "", lambda m: re.sub("[^0-9]", "", m.group())
    return {
        "email": [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)],
        "ip": [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))],
        "card": [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(digits(m)) <= 19 and _luhn(digits(m))],
        "phone": [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m)) <= 15],
    }


def test_pii_base_spans_match_brute_force(odd_docs, no_docs):
    rows = pii.find_pii(odd_docs, ["doc_id", "text", "kept"]).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        found = [(k, s, e) for k, v in _pii(r.text).items() for s, e in v]
        assert [tuple(x) for x in r.base] == found
        assert set(found) <= {tuple(x) for x in r.spans} and r.kept == "own"
    assert pii.find_pii(no_docs, ["doc_id"]).count() == 0


def test_pii_discovers_by_context_and_redacts(spark):
    rows = [(i, f"call hotline: +1 (5{i:02d}) 555-01{i:02d} now") for i in range(30)]
    rows += [(200, "call hotline: 555-0199 x"), (201, None), (202, "room 555-0100 is free")]
    found = pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id", "text"])
    spans = {r.doc_id: [tuple(x) for x in r.spans] for r in found.collect()}
    assert spans[200] == [("phone", 14, 22)] and spans[201] == [] and spans[202] == []
    texts = {r.doc_id: r.text for r in pii.redact(found).collect()}
    assert texts[200] == "call hotline: <PHONE> x" and texts[201] is None and texts[202] == rows[-1][1]


def _discovered(edges):
    """The fixpoint over the pattern-instance graph, in plain Python."""
    known = {(v, k) for _, v, k in edges if k}
    graph = {(p, v) for p, v, _ in edges}
    candidates = {(p, v) for p, v, k in edges if not k}
    size = collections.Counter(p for p, _ in graph)
    found, rounds = {}, 0
    while True:
        support = collections.Counter((p, k) for p, v in graph for w, k in known | set(found.items()) if v == w)
        sure = {pk: n / (size[pk[0]] + 1) for pk, n in support.items() if n >= pii.MIN_KNOWN and n / (size[pk[0]] + 1) >= pii.MIN_CONFIDENCE}
        doubt = {}
        for p, v in candidates:
            for (q, k), c in sure.items():
                if p == q:
                    doubt[v, k] = doubt.get((v, k), 1.0) * (1 - c)
        new = {}
        for (v, k), d in sorted(doubt.items(), key=lambda x: (round(x[1], 9), x[0][1])):
            if round(1 - d, 9) >= pii.MIN_SCORE and v not in found:
                new.setdefault(v, k)
        if not new:
            return found, rounds
        found |= new
        rounds += 1


def test_pii_graph_goes_on_to_the_fixpoint(spark):
    levels = [[f"v{n}.{i}" for i in range(size)] for n, size in enumerate((1400, 140, 14, 5, 1))]
    edges = [("p0", v, "phone") for v in levels[0]] + [("p0", v, None) for v in levels[1]]
    edges += [("p1", v, None) for v in levels[1] + levels[2]]
    edges += [(p, v, None) for p in ("p2a", "p2b") for v in levels[2] + levels[3]]
    edges += [(p, v, None) for p in ("p3a", "p3b") for v in levels[3] + levels[4]]
    edges += [("q", f"m{i}", "email") for i in range(40)] + [("q", "w", None), ("q", "both", None), ("p0", "both", None), ("r", "lost", None)]
    want, rounds = _discovered(edges)
    assert rounds >= 4 and "v4.0" in want and "lost" not in want
    found = pii.discover(spark.createDataFrame(edges, "pattern string, value string, kind string"))
    assert {r.value: r.kind for r in found.collect()} == want


def test_pii_columns_that_clash(spark):
    docs = spark.createDataFrame([(1, "a@b.co", "mine")], "doc_id long, text string, spans string").withColumn("_row", F.lit(7))
    (row,) = pii.find_pii(docs.withColumn("base", F.lit(1)), ["doc_id", "spans", "_row", "base"]).collect()
    assert row.doc_id == 1 and [tuple(x) for x in row.spans] == [("email", 0, 6)] == [tuple(x) for x in row.base]


def test_pii_digest(spark):
    text = "a@b.co 1.2.3.4"
    spans = pii.find_pii(spark.createDataFrame([(1, text)], "doc_id long, text string"), ["doc_id"])
    got = spans.select(F.sha2(pii.spans_text(F.col("base")), 256)).first()[0]
    assert got == hashlib.sha256(b"email:0:6,ip:7:14").hexdigest()
