"""Stupid-backoff language-model scores, computed relationally.

The model is two count tables, words and word pairs, keyed by hashes of 32 bits
a word. A document's score is the mean over its words of ``log S(word | word
before)``: ``c(pair) / c(word before)`` where the pair is counted, else backed
off to ``ALPHA * c(word) / N`` (N: words of the corpus); the first word scores
``c(word) / N``. Under its own corpus a document's pairs are counted in the other
documents only, so what nobody else writes backs off; words are counted in all.

The sum splits into terms that each need one count only:

* Words go through one aggregate. The most frequent ones, chosen by a histogram
  of the counts, are a bounded broadcast; the others are joined.
* Pairs go once through a shuffle by hash. What a batch of documents sends to a
  bucket is one row of sorted, byte-planed arrays, which Spark compresses to less
  than nine bytes a pair. A task has a bucket's pairs of all documents, so it
  counts them, joins the counts back and adds up the terms. Pairs without a
  count ask for the counts of their two words, which their key names.
* Pairs that many documents of a sample have are counted with the words and
  scored on the map side, so no bucket is filled by one of them. (The sample
  changes only where a pair is scored.)

Cases: a null or empty text has 0 words and a null score; rows with equal ids,
or none, are documents of their own; a word that the corpus does not have counts
as seen once; very long texts are arrays of a task's batch; an empty table gives
an empty result; other columns do not matter. Rows are told apart by their place in
``docs``, which must be a table or anything else that is read alike twice.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import WordHasher, _mix, materialise, table, worker_state

ALPHA = 0.4
#: Words whose counts are broadcast, at most (the most frequent ones).
FREQUENT = 200_000
#: Pairs that a bucket holds, about.
BUCKET_PAIRS = 1_000_000
#: A pair that more than one in HOT_SHARE sampled documents has is hot; HOT_PAIRS at most.
HOT_SHARE, HOT_PAIRS, SAMPLE_DOCS = 100, 20_000, 20_000
#: Rows that a task hands on at once.
_ROWS = 100_000

_LOW = np.uint64(0xFFFFFFFF)
_SPOT_BITS = 20


def word_ids(text: str | None) -> np.ndarray:
    """32-bit hashes of the words, in order."""
    return worker_state("word_hasher", WordHasher).words(text) >> np.uint64(32)


def _pair_keys(words: np.ndarray) -> np.ndarray:
    return words[:-1] << np.uint64(32) | words[1:]


def _numbered(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))


def _blobs(values: np.ndarray) -> bytes:
    """Bytes plane by plane: equal high bytes lie together."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def _values(raw: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).view(kind).ravel()


# ------------------------------------------------------------ counts


def _counts(docs: DataFrame, hot: np.ndarray) -> DataFrame:
    """(pair, key, n): the words of all texts (pair false) and their hot pairs (pair true)."""
    import pyarrow as pa

    def run(batches):
        spots = _spots(hot)
        for batch in filter(len, batches):
            words, pairs = [], []
            for own in map(word_ids, batch.column(0).to_pylist()):
                words.append(own.astype(np.uint32))  # sorts faster than 64 bits
                keys = _pair_keys(own) if len(hot) else own[:0]
                pairs.append(keys[_in_hot(keys, hot, spots)])
            for kind, found in ((False, words), (True, pairs)):
                found = np.concatenate(found)
                keys, n = np.unique(found, return_counts=True)
                keys = keys.astype(np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind)), pa.array(keys), pa.array(n)], names=["pair", "key", "n"])

    return docs.select("text").mapInArrow(run, "pair boolean, key long, n long").groupBy("pair", "key").agg(F.sum("n").alias("n"))


def hot_pairs(docs: DataFrame) -> np.ndarray:
    """Sorted keys of pairs that many documents of a bounded sample have."""
    import pyarrow as pa

    n = docs.count()
    sample = docs.select("text").sample(min(1.0, SAMPLE_DOCS / n), 7) if n > SAMPLE_DOCS else docs.select("text")

    def run(batches):
        for batch in filter(len, batches):
            found = [np.unique(_pair_keys(word_ids(t))) for t in batch.column(0).to_pylist()]
            keys, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], names=["key", "n"])

    counted = sample.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    often = counted.filter(F.col("n") * HOT_SHARE > min(n, SAMPLE_DOCS)).orderBy(F.desc("n"), "key").limit(HOT_PAIRS)
    return np.sort(often.select("key").toPandas()["key"].to_numpy(np.int64).view(np.uint64))  # at most HOT_PAIRS


def frequent_words(counts: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys of at most ``limit`` of the most frequent words, and the logarithms of their counts."""
    step = F.floor(F.log2("n") * 8).cast("int")
    sizes = counts.groupBy(step.alias("step")).count().collect()  # some hundred rows
    taken, least = 0, None
    for r in sorted(sizes, key=lambda r: -r["step"]):
        taken += r["count"]
        if taken > limit:
            break
        least = r["step"]
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0)
    top = counts.filter(step >= least).select("key", "n").toPandas()
    keys = top["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], np.log(top["n"].to_numpy(np.float64))[order]


def _looked_up(keys: np.ndarray, known: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether a key is known, its value or 0)."""
    if not len(known):
        return np.zeros(len(keys), bool), np.zeros(len(keys))
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    hit = known[at] == keys
    return hit, np.where(hit, values[at], 0)


def _places(keys: np.ndarray) -> np.ndarray:
    return ((keys ^ keys >> np.uint64(32)) & np.uint64((1 << _SPOT_BITS) - 1)).view(np.int64)


def _spots(hot: np.ndarray) -> np.ndarray:
    """A table of the places of hot pairs, which tells most others apart at once."""
    table = np.zeros(1 << _SPOT_BITS, bool)
    table[_places(hot)] = True
    return table


def _in_hot(pairs: np.ndarray, hot: np.ndarray, spots: np.ndarray) -> np.ndarray:
    """Whether each pair is hot."""
    out = spots[_places(pairs)]
    at = np.flatnonzero(out)
    out[at] = _looked_up(pairs[at], hot, np.zeros(len(hot)))[0]
    return out


# ------------------------------------------------------------ pairs


def _bucketed(docs: DataFrame, hot: np.ndarray, buckets: int, side: str) -> DataFrame:
    """(bucket, side, base, keys, rows, times): the distinct pairs of every document but the hot ones.

    A row holds what one batch of documents sends to one bucket; documents are
    numbered from ``base``, the place of the batch.
    """
    import pyarrow as pa

    names = ["bucket", "side", "base", "keys", "rows", "times"]

    def run(batches):
        spots = _spots(hot)
        for batch in filter(len, batches):
            keys, rows, times = [], [], []
            places = batch.column(2).to_numpy()
            for i, text in enumerate(batch.column(1).to_pylist()):
                own, n = np.unique(_pair_keys(word_ids(text)), return_counts=True)
                cold = ~_in_hot(own, hot, spots)
                own, n = own[cold], n[cold]
                keys.append(own)
                rows.append(np.full(len(own), i, np.uint32))
                times.append(n.astype(np.uint32))
            keys, rows, times = (np.concatenate(x) for x in (keys, rows, times))
            # By bucket, then key; the documents of a key come in any order.
            order = np.argsort(keys)
            keys, rows, times = keys[order], rows[order], times[order]
            bucket = (_mix(keys) % np.uint64(buckets)).astype(np.min_scalar_type(buckets))
            order = np.argsort(bucket, kind="stable")
            keys, rows, times, bucket = keys[order], rows[order], times[order], bucket[order]
            del order
            for first, stop in zip(*_runs(bucket)):
                part = slice(first, stop)
                arrays = (np.diff(keys[part], prepend=np.uint64(0)), rows[part], times[part])
                values = (int(bucket[first]), side, int(places[0]), *map(_blobs, arrays))
                yield pa.RecordBatch.from_arrays([pa.array([x]) for x in values], names=names)

    fields = "bucket long, side string, base long, keys binary, rows binary, times binary"
    # The columns of the other pass over the documents: places must not depend on what is pruned.
    return docs.select("doc_id", "text", "row").mapInArrow(run, fields)


def _runs(values: np.ndarray) -> tuple[list[int], list[int]]:
    """First and last places of the runs of equal values."""
    if not len(values):
        return [], []
    cuts = np.flatnonzero(np.diff(values)) + 1
    return [0, *cuts.tolist()], [*cuts.tolist(), len(values)]


def _terms(pairs: DataFrame, known: np.ndarray, logs: np.ndarray, fixed: float) -> DataFrame:
    """(row, key, weight, part): the terms of all pairs of ``pairs`` (dealt and sorted by bucket).

    With a null key ``part`` is a sum of terms; else ``weight * log c(key)`` is one that is still to be looked up.
    """
    import pyarrow as pa

    names = ["row", "key", "weight", "part"]

    def batch(rows, keys, weights, parts):
        keys = pa.nulls(len(rows), pa.int64()) if keys is None else pa.array(keys.view(np.int64))
        weights, parts = (np.zeros(len(rows)) if x is None else x for x in (weights, parts))
        return pa.RecordBatch.from_arrays([pa.array(rows), keys, pa.array(weights.astype(float)), pa.array(parts.astype(float))], names=names)

    def bucket_terms(blobs):
        sides = []
        for b in blobs:
            rows, times = (_values(b[c], np.uint32).astype(np.int64) for c in ("rows", "times"))
            sides.append((b["side"], np.cumsum(_values(b["keys"], np.uint64)), b["base"] + rows, times))
        counted = [(k, n) for side, k, _, n in sides if side != "asked"]
        asked = [(k, r, n, np.full(len(k), side == "both")) for side, k, r, n in sides if side != "counted"]
        if not asked:
            return
        own, rows, times, left_out = (np.concatenate(x) for x in zip(*asked))
        every, n = (np.concatenate(x) for x in zip(*counted)) if counted else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        keys, at = np.unique(every, return_inverse=True)
        hit, count = _looked_up(own, keys, np.bincount(at, n, len(keys)))
        count = count - np.where(left_out, times, 0)
        seen = hit & (count > 0)
        part = np.where(seen, times * np.log(np.where(seen, count, 1)), times * fixed)
        asks, weights, where = [], [], []
        for half in (own >> np.uint64(32), own & _LOW):
            got, log = _looked_up(half, known, logs)
            part += np.where(~seen & got, times * log, 0)
            rest = ~seen & ~got
            asks.append(half[rest])
            weights.append(times[rest])
            where.append(rows[rest])
        places, at = np.unique(rows, return_inverse=True)
        yield batch(places, None, None, np.bincount(at, part, len(places)))
        asks, weights, where = (np.concatenate(x) for x in (asks, weights, where))
        for k in range(0, len(asks), _ROWS):
            yield batch(where[k : k + _ROWS], asks[k : k + _ROWS], weights[k : k + _ROWS], None)

    def run(batches):
        held, bucket = [], None
        for each in batches:
            for i in range(each.num_rows):
                row = each.slice(i, 1).to_pylist()[0]
                if row["bucket"] != bucket and held:
                    yield from bucket_terms(held)
                    held = []
                bucket = row["bucket"]
                held.append(row)
        if held:
            yield from bucket_terms(held)

    return pairs.mapInArrow(run, "row long, key long, weight double, part double")


def _own_terms(docs: DataFrame, known, logs, hot, hot_counts, leave_out: bool, fixed: float) -> DataFrame:
    """(row, doc_id, n_words, key, weight, part): first words, contexts and hot pairs of every document.

    Every document has one row with a null key; the others are words still to be looked up.
    """
    import pyarrow as pa

    names = ["row", "doc_id", "n_words", "key", "weight", "part"]

    def terms(words, spots):
        """(words, weights of their logarithms, sum of the rest) of one document."""
        if not len(words):
            return words, np.zeros(0), 0.0
        pairs = _pair_keys(words)
        pairs, n = np.unique(pairs[_in_hot(pairs, hot, spots)], return_counts=True)
        count = _looked_up(pairs, hot, hot_counts)[1] - (n if leave_out else 0)
        seen = count > 0
        part = float((n[seen] * np.log(count[seen])).sum() + n[~seen].sum() * fixed)
        more = [pairs[~seen] >> np.uint64(32), pairs[~seen] & _LOW]
        keys, at = np.unique(np.concatenate([words[:1], words[:-1], *more]), return_inverse=True)
        weights = np.concatenate([[1.0], np.full(len(words) - 1, -1.0), n[~seen], n[~seen]])
        return keys, np.bincount(at, weights, len(keys)), part

    def run(batches):
        spots = _spots(hot)
        for batch in batches:
            out = [[] for _ in names]
            for doc, text, row in zip(*(batch.column(i).to_pylist() for i in range(3))):
                words = word_ids(text)
                keys, weights, part = terms(words, spots)
                hit, log = _looked_up(keys, known, logs)
                rest = ~hit & (weights != 0)
                part += float((weights * log).sum())
                for column, value, filler in zip(out, (row, doc, len(words), None, 0.0, part), (row, None, None, None, None, 0.0)):
                    column.append(value)
                    column.extend([filler] * int(rest.sum()))
                n = int(rest.sum())
                if n:
                    out[3][-n:] = keys[rest].view(np.int64).tolist()
                    out[4][-n:] = weights[rest].tolist()
            types = (pa.int64(), batch.column(0).type, pa.int64(), pa.int64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", "row").mapInArrow(run, f"row long, doc_id {kind}, n_words long, key long, weight double, part double")


# ------------------------------------------------------------ scores


def lm_scores(docs: DataFrame, corpus: DataFrame | None = None, frequent: int = FREQUENT) -> DataFrame:
    """(doc_id, n_words, score) of every row of ``docs`` (doc_id, text).

    Counts are those of ``corpus``, or of the other documents of ``docs`` if it is not given.
    """
    own = corpus is None
    counted = docs if own else corpus
    hot = hot_pairs(counted)
    counts = materialise(_counts(counted, hot), "counts")
    words = counts.filter("NOT pair").select("key", "n")
    total = words.agg(F.sum("n")).first()[0] or 0
    known, logs = frequent_words(words, frequent)
    found = counts.filter("pair").select("key", "n").toPandas().sort_values("key")  # at most HOT_PAIRS
    hot_counts = np.zeros(len(hot))
    hot_counts[np.searchsorted(hot, found["key"].to_numpy(np.int64).view(np.uint64))] = found["n"]
    fixed = float(np.log(ALPHA / max(total, 1)))

    buckets = max(1, int(total // BUCKET_PAIRS))
    docs = _numbered(docs)
    sent = _bucketed(docs, hot, buckets, "both" if own else "asked")
    if not own:
        sent = sent.union(_bucketed(_numbered(corpus), hot, buckets, "counted"))
    terms = _terms(sent.repartition("bucket").sortWithinPartitions("bucket"), known, logs, fixed)
    mine = materialise(_own_terms(docs, known, logs, hot, hot_counts, own, fixed), "own")

    sums = terms.filter("key IS NULL").select("row", "part")
    asked = terms.filter("key IS NOT NULL").select("row", "key", "weight").union(mine.filter("key IS NOT NULL").select("row", "key", "weight"))
    looked = asked.join(words, "key").select("row", (F.col("weight") * F.log("n")).alias("part"))  # an unknown word: log 1
    parts = sums.union(looked).groupBy("row").agg(F.sum("part").alias("more"))
    score = (F.col("part") + F.coalesce("more", F.lit(0.0)) - F.lit(float(np.log(max(total, 1))))) / F.col("n_words")
    return (
        mine.filter("key IS NULL").join(parts, "row", "left")
        .select("doc_id", "n_words", F.when(F.col("n_words") > 0, F.round(score, 6)).alias("score"))
    )


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))
