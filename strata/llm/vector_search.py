"""Exact top-k inner products by a vector-approximation file.

*Scan.* Every component is approximated by one of 64 cells. Blocks of queries
meet blocks of cells; for every query and vector two matrix products give an
upper and a lower bound of the score, and vectors whose upper bound reaches
the k-th best lower bound of their block go on, as (query, vector, bound).

*Refine.* Exact vectors are read in the order of their bounds until the k-th
result is certain: first the best-bounded ones of each query, which give an
exact k-th score; then only those whose bound still reaches it.

Scores are integers, so bounds and results are exact. Equal vectors are one
class that carries its k+1 smallest different ids, each up to k times (no query
needs more of them), however many there are.

Cases: vectors that are null, empty or hold null or non-finite components take
no part, neither do rows without id; queries only meet vectors of their
length; ties go to the smaller id; fewer than k candidates give fewer rows;
rows with equal ids count as often as they come, queries too (their candidates
are ranked together), and a query never meets its own id; other columns do not matter.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import materialise, table

TOP = 5
#: Components become floor(SCALE * x); they must stay below 2**26 in size.
SCALE = 256
CELLS = 64
#: Vectors and queries in a block.
BLOCK, QUERY_BLOCK = 2_048, 512
#: Slices that blocks of queries and of cells meet in.
SALTS = 64
#: Best-bounded candidates whose exact vectors are read first.
FIRST_READ = 16
QUERY_EVERY = 50


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): the usable vectors with integer components."""
    doubles = F.transform(F.col("embedding"), lambda x: x.cast("double"))
    usable = F.forall("d", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        vectors.filter("vec_id IS NOT NULL AND embedding IS NOT NULL")
        .select("vec_id", doubles.alias("d"))
        .filter((F.size("d") > 0) & usable)
        .select("vec_id", F.transform("d", lambda x: F.floor(x * SCALE).cast("long")).alias("v"))
    )


def classes(rows: DataFrame, k: int) -> DataFrame:
    """(c, v, ids): distinct vectors with their k + 1 smallest distinct ids, each as often as it comes (up to k); c is the first."""
    smallest = Window.partitionBy("v").orderBy("vec_id")
    counted = rows.groupBy("v", "vec_id").agg(F.least(F.count(F.lit(1)), F.lit(k)).cast("int").alias("times"))
    return (
        counted.withColumn("r", F.row_number().over(smallest))
        .filter(F.col("r") <= k + 1)
        .groupBy("v")
        .agg(F.sort_array(F.flatten(F.collect_list(F.array_repeat("vec_id", F.col("times"))))).alias("ids"))  # at most k (k + 1)
        .select(F.element_at("ids", 1).alias("c"), "v", "ids")
    )


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows (id, single, v) packed: (n, dim, ids, singles, data), bytes of int64 and int32."""
    import pyarrow as pa

    names = ["n", "dim", "ids", "singles", "data"]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size).to_pydict()
                lengths = np.array([len(v) for v in part["v"]])
                for dim in np.unique(lengths).tolist():
                    own = np.flatnonzero(lengths == dim)
                    ids = np.array([part["id"][i] for i in own], np.int64)
                    single = np.array([part["single"][i] for i in own], np.int64)
                    data = np.array([part["v"][i] for i in own], np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([len(own)], pa.int32()), pa.array([dim], pa.int32())]
                        + [pa.array([x.tobytes()], pa.binary()) for x in (ids, single, data)],
                        names=names,
                    )

    return rows.mapInArrow(run, "n int, dim int, ids binary, singles binary, data binary")


def _bounds(pairs: DataFrame, low: int, width: int, k: int) -> DataFrame:
    """(query_id, c, upper, lower) of the vectors that may be among a query's best in their block."""
    import pyarrow as pa

    names = ["query_id", "c", "upper", "lower"]

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, singles = (np.frombuffer(row[c], np.int64) for c in ("ids", "singles"))
                cells = np.frombuffer(row["data"], np.int32).reshape(len(ids), -1)
                queries = np.frombuffer(row["q_data"], np.int32).reshape(row["q_n"], -1).astype(np.float64)
                q_ids = np.frombuffer(row["q_ids"], np.int64)
                floor = (low + cells.astype(np.float64) * width).T
                up, down = np.maximum(queries, 0), np.minimum(queries, 0)
                base = queries @ floor
                upper = base + (width - 1) * up.sum(axis=1)[:, None]
                lower = base + (width - 1) * down.sum(axis=1)[:, None]
                own = singles[None, :] == np.frombuffer(row["q_own"], np.int64)[:, None]  # classes of nothing but the query itself
                upper[own] = lower[own] = -np.inf
                if len(ids) > k:
                    limit = np.partition(lower, len(ids) - k, axis=1)[:, len(ids) - k]
                else:
                    limit = np.full(len(q_ids), -np.inf)
                i, j = np.nonzero((upper >= limit[:, None]) & ~own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_ids[i]), pa.array(ids[j])] + [pa.array(x[i, j].astype(np.int64)) for x in (upper, lower)],
                    names=names,
                )

    return pairs.mapInArrow(run, "query_id long, c long, upper long, lower long")


def _exact(wanted: DataFrame, queries: DataFrame, known: DataFrame) -> DataFrame:
    """(query_id, vec_id, score) of all ids of the wanted (query_id, c) classes."""
    score = F.aggregate(F.zip_with("q", "v", lambda a, b: a * b), F.lit(0).cast("long"), lambda s, x: s + x)
    return (
        wanted.join(known, "c")
        .join(queries, "query_id")
        .select("query_id", "own", "ids", score.alias("score"))
        .select("query_id", "own", F.explode("ids").alias("vec_id"), "score")
        .filter("vec_id <> own")
        .drop("own")
    )


def top_inner_products(vectors: DataFrame, queries: DataFrame, k: int = TOP) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best vectors of every query.

    ``vectors`` and ``queries`` have vec_id and embedding.
    """
    spark = vectors.sparkSession
    known = materialise(classes(integer_vectors(vectors), k), "vectors")
    # Rows of one query id are asked one by one, by a number, and ranked together at the end.
    asked = integer_vectors(queries).groupBy(F.col("vec_id").alias("own"), F.col("v").alias("q"))
    asked = asked.agg(F.least(F.count(F.lit(1)), F.lit(k)).cast("int").alias("times"))
    asked = materialise(asked.withColumn("query_id", F.monotonically_increasing_id()), "queries")
    ends = known.agg(F.min(F.array_min("v")).alias("lo"), F.max(F.array_max("v")).alias("hi")).first()
    result = "query_id long, rank int, vec_id long, score long"
    if ends["lo"] is None:
        return spark.createDataFrame([], result)
    low, width = ends["lo"], (ends["hi"] - ends["lo"]) // CELLS + 1
    cells = F.transform("v", lambda x: F.floor((x - low) / width).cast("long"))
    single = F.when(F.element_at("ids", 1) == F.element_at("ids", -1), F.col("c"))
    scanned = _blocks(known.select(F.col("c").alias("id"), F.coalesce(single, F.lit(-(2**63))).alias("single"), cells.alias("v")), BLOCK)
    scanned = scanned.withColumn("salt", F.pmod(F.xxhash64("ids"), F.lit(SALTS)).cast("int"))
    blocks = _blocks(asked.select(F.col("query_id").alias("id"), F.col("own").alias("single"), F.col("q").alias("v")), QUERY_BLOCK).select(
        F.col("n").alias("q_n"), "dim", F.col("ids").alias("q_ids"), F.col("singles").alias("q_own"), F.col("data").alias("q_data"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"),
    )
    met = scanned.join(blocks, ["dim", "salt"]).select("ids", "singles", "data", "q_n", "q_ids", "q_own", "q_data")
    bounds = materialise(_bounds(met, low, width, k), "bounds")

    best = Window.partitionBy("query_id").orderBy(F.desc("lower"))
    limits = (
        bounds.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k).groupBy("query_id")
        .agg(F.min("lower").alias("limit"), F.count(F.lit(1)).alias("n"))
    )
    certain = bounds.join(limits, "query_id").filter((F.col("n") < k) | (F.col("upper") >= F.col("limit")))
    order = Window.partitionBy("query_id").orderBy(F.desc("upper"), "c")
    turns = materialise(certain.select("query_id", "c", "upper", F.row_number().over(order).alias("turn")), "turns")
    first = materialise(_exact(turns.filter(F.col("turn") <= FIRST_READ).select("query_id", "c"), asked, known), "exact")
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    kth = (
        first.withColumn("r", F.row_number().over(by_score)).filter(F.col("r") <= k).groupBy("query_id")
        .agg(F.min("score").alias("kth"), F.count(F.lit(1)).alias("n"))
    )
    rest = turns.filter(F.col("turn") > FIRST_READ).join(kth, "query_id", "left")
    rest = rest.filter((F.coalesce("n", F.lit(0)) < k) | (F.col("upper") >= F.col("kth")))
    scored = first.union(_exact(rest.select("query_id", "c"), asked, known))
    each = scored.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k)
    repeated = F.explode(F.array_repeat(F.lit(0), F.col("times"))).alias("_")
    each = each.join(asked, "query_id").select(F.col("own").alias("query_id"), "vec_id", "score", repeated)
    return each.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_inner_products(vectors, vectors.filter(F.col("vec_id") % QUERY_EVERY == 0))


ORACLE_SQL = f"""
WITH x AS (SELECT vec_id, list_transform(embedding, lambda c: CAST(floor({SCALE} * CAST(c AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = len(embedding)),
s AS (SELECT q.vec_id AS query_id, x.vec_id, CAST(list_sum(list_transform(list_zip(q.v, x.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM x q JOIN x ON q.vec_id <> x.vec_id AND len(q.v) = len(x.v) WHERE q.vec_id % {QUERY_EVERY} = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {TOP}
"""
