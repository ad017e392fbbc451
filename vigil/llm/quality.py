"""Quality rules: hashed n-gram log-likelihood ratio between a trusted target and the raw corpus.

Words and word pairs of every text are hashed into ``BUCKETS``. Two multinomials are counted over
the whole corpus: all documents (raw) and those whose label says quality 1 (target). A document's
score is the mean, over its n-grams, of the logarithm of the ratio of the two; it is rejected if
the score is below ``LOWEST`` or if a base rule fails. Base rules look at one text: words,
characters, symbols, repeated lines and repeated three-word windows.

Only DataFrame functions run on the main path. The counts are two numbers for each bucket, the one
thing that goes through the driver. Null and blank texts have no words, score 0 and fail a base
rule. Without trusted documents every score is 0. Repeated rows count each time; a label names
all rows with its id.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.common import WORD_GAP, packed, table, unpacked, words

BUCKETS = 1 << 16
LOWEST = -0.2               # mean log ratio of a document that is kept, at least
WINDOW = 3                  # fixed by the contract
FEWEST_WORDS = 50           # fixed by the contract
SYMBOLS = "#*$%&|<>"        # fixed by the contract


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def repeated_words(w: Column) -> Column:
    """Words that stand in a three-word window found twice or more in the text."""
    def covered(starts: Column) -> Column:
        steps = F.transform(starts, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - p, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def again(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        starts = let(placed, lambda s: F.sort_array(F.transform(F.filter(s, lambda x, i: (
            x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"])), lambda x: x["i"])))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(starts, covered))

    windows = F.slice(F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))), 1, F.greatest(F.size(w) - (WINDOW - 1), F.lit(0)))
    return F.when(F.size(w) < WINDOW, F.lit(0)).otherwise(let(windows, again))


def grams(w: Column, buckets: int = BUCKETS) -> Column:
    """Buckets of the words and of the pairs of neighbouring words."""
    ones = F.transform(w, lambda x: F.hash(x).bitwiseAND(F.lit(buckets - 1)))
    twos = F.slice(F.transform(w, lambda x, i: F.hash(x, F.get(w, i + 1)).bitwiseAND(F.lit(buckets - 1))), 1, F.greatest(F.size(w) - 1, F.lit(0)))
    return F.concat(ones, twos)


def gram_weights(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> list[float]:
    """Log ratio of target and raw share of every bucket, each with one added; zeros if nothing is trusted.
    ``trusted`` has the ids of the target documents."""
    names = trusted.select(F.col("doc_id").alias("_trusted")).where("_trusted is not null").distinct()
    # both sides grow with the corpus: dealt by id at any size
    marked = docs.select("doc_id", "text").join(names.hint("merge"), F.col("doc_id") == F.col("_trusted"), "left")
    found = marked.select(F.col("_trusted").isNotNull().alias("good"), F.explode(let(words(F.col("text")), lambda w: grams(w, buckets))).alias("bucket"))
    counts = found.groupBy("bucket").agg(F.count("*").alias("raw"), F.count_if("good").alias("target")).collect()    # one row a bucket
    raw, target = [1] * buckets, [1] * buckets
    for r in counts:
        raw[r.bucket] += r.raw
        target[r.bucket] += r.target
    all_raw, all_target = sum(raw), sum(target)
    if all_target == buckets:
        return [0.0] * buckets
    return [math.log(t / all_target) - math.log(r / all_raw) for t, r in zip(target, raw, strict=True)]


def quality(docs: DataFrame, weights: list[float], lowest: float = LOWEST) -> DataFrame:
    """``(row, quality)``: the document's columns as a struct, and the base figures, ``score``, ``base_failed`` and ``kept``."""
    text = F.coalesce(F.col("row.text"), F.lit(""))
    known = F.split(F.lit(",".join(f"{x:.6f}" for x in weights)), ",").cast("array<double>")     # folded into one literal
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def score(g: Column) -> Column:
        return F.when(F.size(g) == 0, F.lit(0.0)).otherwise(
            F.aggregate(g, F.lit(0.0), lambda a, b: a + F.get(known, b)) / F.size(g))

    figures = let(words(F.col("row.text")), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        repeated_words(w).cast("long").alias("n_repeat_words"),
        let(grams(w, len(weights)), score).alias("score")))
    n, again, score_ = (F.col(f"figures.{c}") for c in ("n_words", "n_repeat_words", "score"))
    failed = (n < FEWEST_WORDS) | (100 * again > 50 * n)
    return packed(docs).withColumn("figures", figures).select("row", F.struct(
        n.alias("n_words"), F.length(F.regexp_replace(text, WORD_GAP, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        again.alias("n_repeat_words"), failed.alias("base_failed"),
        (~failed & (score_ >= lowest)).alias("kept"), score_.alias("score")).alias("quality"))


def keep_good(docs: DataFrame, weights: list[float], lowest: float = LOWEST) -> DataFrame:
    """The documents that are kept."""
    return unpacked(quality(docs, weights, lowest).where("quality.kept"), docs.columns)


def trusted_ids(labels: DataFrame) -> DataFrame:
    return labels.where("quality = 1").select("doc_id")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = gram_weights(docs, trusted_ids(table(spark, sf_dir, "labels")))
    return quality(docs, weights).select("row.doc_id", "quality.*").drop("score")
