"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text's features are its distinct n-grams of 4 to 7 characters (lower case, white space as one
space), hashed into ``BUCKETS``. From labelled rows the log-count ratio of every bucket is taken;
the buckets whose ratio is surest become the features of a logistic regression, in which feature
j has the value of its ratio. The model is one weight for each bucket, so a whole text of any
length is scored in one pass without keeping its n-grams.

The fit uses at most ``PER_CLASS`` labelled rows of each class (the smallest hashes of the id);
class weights restore the shares of all labelled rows. Rows whose crc32(doc_id as text) mod 5 is 0
are held out and never learned from. Null and empty texts have no features and get the score of
the intercept. Without labelled rows of both classes the score is the share of label 1 (one half
if there are no rows). Documents without a label, repeated rows and ties need nothing special.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.common import ship, small_slices, table
from vigil.session import write_table

ORDERS = (4, 5, 6, 7)
BITS = 20
BUCKETS = 1 << BITS
PER_CLASS = 8000            # labelled rows of a class that the fit may use
FEATURES = 8192             # buckets that carry weight
RIDGE = 1.0                 # L2 penalty on the weights of the scaled features
STEPS = 250
CHUNKS = 64                 # counts travel in this many pieces
SLICE_BYTES = 8 << 20
LONGEST = 1 << 20           # characters hashed at a time


def buckets_of(text: str | None) -> Iterator[np.ndarray]:
    """Buckets of the n-grams of a text, piece by piece (pieces overlap, so no n-gram is lost), with repeats."""
    words = (text or "").lower().split()
    if not words:
        return
    codes = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    reach = max(ORDERS) - 1
    for start in range(0, len(codes), LONGEST):
        piece = codes[start:start + LONGEST + reach]
        found, h = [], piece
        for n in range(2, max(ORDERS) + 1):
            h = h[:-1] * np.uint32(0x01000193) + piece[n - 1:]
            if n in ORDERS:
                mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x9E3779B1 + 2 * n & 0xFFFFFFFF)
                found.append(mixed >> np.uint32(32 - BITS))
        yield np.concatenate(found)


@dataclass
class Model:
    weights: np.ndarray         # of every bucket, float32
    intercept: float

    def score(self, text: str | None) -> float:
        hits = [b[self.weights[b] != 0] for b in buckets_of(text)]
        z = self.intercept
        if hits:
            z += float(self.weights[np.unique(np.concatenate(hits))].sum(dtype=np.float64))
        return 1.0 / (1.0 + np.exp(-min(max(z, -500.0), 500.0)))


def _distinct(text: str | None) -> np.ndarray:
    parts = [np.unique(b) for b in buckets_of(text)]
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint32)


def bucket_counts(sample: DataFrame) -> np.ndarray:
    """Rows of each class that hold each bucket, ``(2, BUCKETS)``; ``sample`` has ``text`` and ``toxic``."""
    width = BUCKETS // CHUNKS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BUCKETS), np.int64)
        for batch in small_slices(batches, "text", SLICE_BYTES):
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                total[label, _distinct(text)] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(CHUNKS), pa.int32()), pa.array([total[:, i * width:(i + 1) * width].tobytes() for i in range(CHUNKS)], pa.binary())],
            names=["chunk", "counts"])

    def add(group: pa.Table) -> pa.Table:
        total = np.zeros(2 * width, np.int64)
        for x in group.column("counts").to_pylist():
            total += np.frombuffer(x, np.int64)
        return pa.table({"chunk": group.column("chunk").slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})

    shape = "chunk int, counts binary"
    out = np.zeros((2, BUCKETS), np.int64)
    for row in sample.select("text", "toxic").mapInArrow(count, shape).groupBy("chunk").applyInArrow(add, shape).collect():
        out[:, row.chunk * width:(row.chunk + 1) * width] = np.frombuffer(row.counts, np.int64).reshape(2, width)
    return out


def log_count_ratios(counts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ratio of every bucket (add-one smoothing), and how many of its standard errors it is from zero."""
    p, q = counts[1] + 1.0, counts[0] + 1.0
    ratio = np.log(p / (rows[1] + 2.0)) - np.log(q / (rows[0] + 2.0))
    error = np.sqrt(np.maximum(1 / p - 1 / (rows[1] + 2.0), 0) + np.maximum(1 / q - 1 / (rows[0] + 2.0), 0)) + 1e-9
    return ratio, np.abs(ratio) / error


def fit_weights(row_of: np.ndarray, col_of: np.ndarray, labels: np.ndarray, scale: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression on sparse features ``scale[col]`` by accelerated gradient steps; the intercept isn't penalised."""
    n, d = len(labels), len(scale)
    values = scale[col_of]
    weight = weight / weight.sum()

    def forward(w: np.ndarray) -> np.ndarray:
        return np.bincount(row_of, values * w[:d][col_of], n) + w[d]

    def back(r: np.ndarray) -> np.ndarray:
        return np.append(np.bincount(col_of, values * r[row_of], d), r.sum())

    ridge = np.append(np.full(d, RIDGE / n), 0.0)
    v = np.ones(d + 1)
    for _ in range(15):                     # largest curvature, by the power method
        v = back(weight * forward(v))
        top = float(np.linalg.norm(v))
        v /= top or 1.0
    step = 1.0 / (0.25 * top * 1.05 + RIDGE / n)
    w = y = np.zeros(d + 1)
    for k in range(STEPS):
        z = 1.0 / (1.0 + np.exp(-np.clip(forward(y), -500, 500)))
        after = y - step * (back(weight * (z - labels)) + ridge * y)
        y = after + k / (k + 3) * (after - w)
        w = after
    return w[:d], float(w[d])


def is_held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """The model from labelled rows (``labels``: ``doc_id``, ``toxic``) that aren't held out."""
    ship(docs.sparkSession)
    marked = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~is_held_out(F.col("doc_id"))).groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic"))
    shares = dict(marked.groupBy("toxic").count().collect())            # two classes
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [marked.where(F.col("toxic") == c).orderBy(*order).limit(per_class) for c in (0, 1)]
    # 2 * per_class rows of 12 bytes at most: the one broadcast, of a fixed bound
    sample = write_table(docs.select("doc_id", "text").join(F.broadcast(chosen[0].union(chosen[1])), "doc_id").select("text", "toxic"), "toxic-sample")
    rows = np.array([0, 0])
    for c, n in sample.groupBy("toxic").count().collect():
        rows[c] = n
    if not rows.all():
        known = sum(shares.values())
        share = min(max(shares.get(1, 0) / known, 1e-6), 1 - 1e-6) if known else 0.5
        return Model(np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share))))
    ratio, sure = log_count_ratios(bucket_counts(sample), rows)
    chosen_buckets = np.sort(np.argsort(-sure, kind="stable")[:FEATURES])
    place = np.full(BUCKETS, -1, np.int32)
    place[chosen_buckets] = np.arange(FEATURES)

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches, "text", SLICE_BYTES):
            found = [place[_distinct(t)] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array([f[f >= 0].astype(np.uint16).tobytes() for f in found], pa.binary())], names=["toxic", "cols"])

    # bounded: 2 * per_class rows of FEATURES two-byte numbers at most
    got = sample.mapInArrow(thin, "toxic int, cols binary").orderBy("toxic", F.xxhash64("cols"), "cols").collect()
    cols = [np.frombuffer(r.cols, np.uint16) for r in got]
    y = np.array([r.toxic for r in got], np.float64)
    share = np.array([shares[0], shares[1]]) / rows
    w, b = fit_weights(np.repeat(np.arange(len(cols)), [len(c) for c in cols]), np.concatenate(cols).astype(np.int64), y,
                       ratio[chosen_buckets], share[y.astype(int)])
    weights = np.zeros(BUCKETS, np.float32)
    weights[chosen_buckets] = w * ratio[chosen_buckets]
    return Model(weights, b)


def toxicity_scores(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score)`` of every document, from its text alone."""
    spark = docs.sparkSession
    ship(spark)
    kept = spark.sparkContext.broadcast(model)          # BUCKETS four-byte numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = kept.value
        for batch in small_slices(batches, "text", SLICE_BYTES):
            scores = [own.score(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity_scores(docs, fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic")))
    return scored.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
