"""The corpus pipeline: quality rules, near-dedup, substring dedup, PII, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame: all but the last the columns of ``docs``. :func:`run`
writes every stage's result as Parquet in the shared folder and reads it back
as the next stage's ``docs``. Any further columns of ``docs`` travel in one
struct, so their names cannot clash with those of an operator.

Cases: rows with a null id take part in everything but the two dedup stages,
which pass them through; rows with equal ids stay or go by their own texts in
near-dedup and are one document in substring dedup; a null text is rejected by the quality rules; an empty table gives
empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import materialise, table
from strata.llm.near_dup import near_duplicates
from strata.llm.packing import pack_documents
from strata.llm.pii import find_pii, redact
from strata.llm.quality import kept_documents
from strata.llm.substring_dup import repeated_passages, without_passages

TOKENIZER = "word_bpe_49k.json"
#: A column that ``docs`` does not have.
_KEY = "_near_dup_stage_text_hash"


def _narrow(docs: DataFrame) -> DataFrame:
    """(doc_id, text, _rest): all other columns in one struct."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in rest] or [F.lit(0).alias("_none")]).alias("_rest"))


def _widen(rows: DataFrame, docs: DataFrame, edited: bool = False) -> DataFrame:
    """The columns of ``docs`` again; ``n_chars`` follows an edited text."""

    def column(name: str):
        if name in ("doc_id", "text"):
            return F.col(name)
        if edited and name == "n_chars":
            return F.length("text").cast(docs.schema[name].dataType).alias(name)
        return F.col("_rest").getField(name).alias(name)

    return rows.select(*[column(c) for c in docs.columns])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return _widen(kept_documents(_narrow(docs), table(spark, sf_dir, "labels")), docs)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of every group of near-duplicates (5-word shingles, 0.8).

    Of rows with equal ids each stays or goes by its own text: a group's smallest id keeps all its rows of the group.
    """
    gone = near_duplicates(docs).filter("NOT kept").select("doc_id", "text_hash").distinct()
    keyed = docs.withColumn(_KEY, F.xxhash64("text"))
    gone = gone.withColumnRenamed("text_hash", _KEY)
    return keyed.join(gone, ["doc_id", _KEY], "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document has."""
    rows = _narrow(docs)
    return _widen(without_passages(rows, repeated_passages(docs)), docs, edited=True)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by the kind in angle brackets."""
    return _widen(redact(find_pii(_narrow(docs), ["doc_id", "text", "_rest"])), docs, edited=True)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into windows."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality_rules", quality_stage),
    ("near_dedup", near_dup_stage),
    ("substring_dedup", substring_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: The stages cannot be expressed in SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
