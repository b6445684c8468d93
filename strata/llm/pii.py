"""Personal data: base patterns, then bootstrapped contextual extraction.

One pass over the texts finds the base entities of four kinds and, besides
them, *candidates*: other words with a digit or an at sign. The word before a
mention, and the two words before it, are its lexical patterns; patterns and
values form a bipartite graph whose distinct edges Spark scores in rounds:

* a pattern's confidence for a kind is the share of its distinct values that
  are known instances of the kind, ``known / (all + 1)``, counted over all
  documents;
* a value's score is the noisy-or of the confident patterns it occurs with;
  values that reach the limit become instances and support patterns in turn,
until a round finds nothing new.

New instances are then marked wherever they were seen as candidates. Base
entities are never removed or changed.

Cases: a null or empty text has no entity; repeated rows give repeated
results; no two spans of the method overlap a base span; ties between kinds go
to the first by name; without any confident pattern the base spans are all.
Values are compared by their whole text, however long a text is. Extra columns
named in ``keep`` pass through, unless a column of the method has their name.
Offsets are code points, end exclusive. An empty table gives an empty result.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import map_texts, materialise, table

KINDS = ("email", "ip", "card", "phone")
#: A pattern needs this many distinct known values, and this confidence.
MIN_KNOWN = 3
MIN_CONFIDENCE = 0.7
#: A value becomes an instance from this score on.
MIN_SCORE = 0.9
#: Characters before a mention that its context is taken from.
CONTEXT_CHARS = 80

_EMAIL_NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_EMAIL_HOST = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: A match can only start where a run of digits does: the part before it would match too.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_CANDIDATE = re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*")
_TRIM = ".,;:!?\"'()[]{}<>|*#$%&"
_DIGITS = re.compile(r"[0-9]+")

FIELDS = (
    "n_email long, n_ip long, n_card long, n_phone long, "
    "_base array<struct<kind: string, first: int, stop: int>>, "
    "_mentions array<struct<kind: string, value: string, patterns: array<string>, first: int, stop: int>>"
)


def _emails(text: str) -> list[tuple[int, int]]:
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _EMAIL_NAME:
            start -= 1
        host = _EMAIL_HOST.match(text, at + 1) if start < at else None
        if host:
            done = host.end()
            out.append((start, done))
        else:
            done = max(done, at + 1)
        at = text.find("@", done)
    return out


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) << (k & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """The base entities of each kind: leftmost matches, failing ones dropped."""
    out = {k: [] for k in KINDS}
    if "@" in text:
        out["email"] = _emails(text)
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) < 3 or (len(p) == 3 and p <= "255") for p in parts):
            out["ip"].append(m.span())
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 13 <= len(digits) <= 19 and _luhn(digits):
            out["card"].append(m.span())
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                out["phone"].append(m.span())
    return out


def patterns_of(text: str, start: int) -> list[str]:
    """The word, and the two words, before a mention (digits as 9)."""
    before = ["^", "^", *_DIGITS.sub("9", text[max(0, start - CONTEXT_CHARS) : start].lower()).split()]
    return [before[-1], f"{before[-2]} {before[-1]}"]


def _find(texts: list[str]):
    counts, bases, mentions = [[] for _ in KINDS], [], []
    for text in texts:
        spans = base_spans(text)
        base = [(k, s, e) for k in KINDS for s, e in spans[k]]
        seen = [(k, text[s:e], patterns_of(text, s), s, e) for k, s, e in base]
        taken = sorted((s, e) for _, s, e in base)
        reach, k = 0, 0  # base spans that start before the candidate ends reach this far
        for m in _CANDIDATE.finditer(text):
            word = m.group()
            start = m.start() + len(word) - len(word.lstrip(_TRIM))
            value = word.strip(_TRIM)
            stop = start + len(value)
            while k < len(taken) and taken[k][0] < stop:
                reach = max(reach, taken[k][1])
                k += 1
            if reach <= start and value and ("@" in value or _DIGITS.search(value)):
                seen.append((None, value, patterns_of(text, start), start, stop))
        for n, kind in zip(counts, KINDS, strict=True):
            n.append(len(spans[kind]))
        bases.append([{"kind": a, "first": b, "stop": c} for a, b, c in base])
        mentions.append([dict(zip(("kind", "value", "patterns", "first", "stop"), x, strict=True)) for x in seen])
    return [*counts, bases, mentions]


def mentions(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` with counts, ``_base`` spans and all ``_mentions`` (kind null: candidate)."""
    return map_texts(docs, lambda: _find, FIELDS, keep, text)


def discover(edges: DataFrame) -> DataFrame:
    """(value, kind) of instances found beyond the base ones.

    ``edges``: distinct (pattern, value, kind), kind null for candidates.
    Instances stay once they are found, so confidences and scores only grow
    and the rounds end when one finds nothing new.
    """
    spark = edges.sparkSession
    known = edges.filter("kind IS NOT NULL").select("value", "kind").distinct()
    graph = edges.select("pattern", "value").distinct()
    size = graph.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    candidates = edges.filter("kind IS NULL").select("pattern", "value")
    found = spark.createDataFrame([], "value string, kind string")
    while True:
        confident = (
            graph.join(known.union(found), "value")
            .groupBy("pattern", "kind")
            .agg(F.count(F.lit(1)).alias("known"))
            .filter(F.col("known") >= MIN_KNOWN)
            .join(size, "pattern")
            .withColumn("confidence", F.col("known") / (F.col("n") + 1))
            .filter(F.col("confidence") >= MIN_CONFIDENCE)
        )
        score = 1 - F.exp(F.sum(F.log(1 - F.col("confidence"))))
        scored = (
            candidates.join(confident.select("pattern", "kind", "confidence"), "pattern")
            .groupBy("value", "kind")
            .agg(F.round(score, 9).alias("score"))
            .filter(F.col("score") >= MIN_SCORE)
            .groupBy("value")
            .agg(F.min(F.struct(-F.col("score"), F.col("kind").alias("kind"))).alias("best"))
        )
        new = materialise(scored.select("value", "best.kind").join(found, "value", "left_anti"), "instances")
        if new.isEmpty():
            return found
        found = materialise(found.union(new), "found")


#: Names of the method's own columns; kept columns of these names are left out.
_OWN = {"base", "spans", "_base", "_mentions", "_more", "_row"}


def find_pii(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` with n_email .. n_phone, ``base`` and ``spans`` (arrays of kind, first, stop) of every row."""
    keep = [c for c in keep if c.lower() not in _OWN]
    seen = materialise(
        mentions(docs, keep, text).withColumn("_row", F.monotonically_increasing_id()), "mentions"
    )
    rows = seen.select("_row", F.explode("_mentions").alias("m")).select("_row", "m.*")
    edges = materialise(rows.select(F.explode("patterns").alias("pattern"), "value", "kind").distinct(), "edges")
    found = discover(edges)
    marked = (
        rows.filter("kind IS NULL")
        .select("_row", "value", "first", "stop")
        .join(found, "value")
        .groupBy("_row")
        .agg(F.collect_list(F.struct("kind", "first", "stop")).alias("_more"))  # of one text
    )
    spans = F.concat("_base", F.coalesce("_more", F.expr("CAST(array() AS array<struct<kind: string, first: int, stop: int>>)")))
    return (
        seen.drop("_mentions")
        .join(marked, "_row", "left")
        .withColumn("spans", _by_kind(spans))
        .withColumnRenamed("_base", "base")
        .drop("_row", "_more")
    )


def _by_kind(spans: Column) -> Column:
    """Spans by kind as listed, then start."""
    order = F.array(*[F.lit(k) for k in KINDS])
    keyed = F.transform(
        spans, lambda s: F.struct(F.array_position(order, s["kind"]).alias("k"), s["first"].alias("first"), s["stop"].alias("stop"), s["kind"].alias("kind"))
    )
    return F.transform(F.sort_array(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["first"].alias("first"), s["stop"].alias("stop")))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["first"].cast("string"), s["stop"].cast("string"))), ",")


def redact(found: DataFrame, text: str = "text") -> DataFrame:
    """Replaces every span of ``spans`` in the text by its kind in angle brackets.

    Spans that overlap are replaced together, under the kind that starts first.
    """
    @F.pandas_udf("string")
    def replaced(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for t, s in zip(texts, spans, strict=True):
            if t is None or not len(s):
                out.append(t)
                continue
            parts, done = [], 0
            for x in sorted(s, key=lambda x: (x["first"], -x["stop"])):
                if x["first"] >= done:
                    parts += [t[done : x["first"]], f"<{x['kind'].upper()}>"]
                done = max(done, x["stop"])
            out.append("".join(parts) + t[done:])
        return pd.Series(out, dtype=object)

    return found.withColumn(text, replaced(text, "spans"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents"), ["doc_id"])
    return found.select(
        "doc_id",
        *[f"n_{k}" for k in KINDS],
        F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
    )

