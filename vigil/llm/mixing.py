"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source should be taken ``target / source_size`` times. The whole part is
certain; the rest is a copy probability. Pivotal rounding settles the probabilities in pairs:
two documents give each other mass, with the chances that keep both expectations, until one of
them is whole; the other goes on to the next pair. Inside a block the documents come by falling
size and what a pair changes in words is spread over those that follow, so the words taken stay
near the target as well as the copies. Each block leaves one undecided document at most, mostly
a short one; these residuals meet in the next level of a reduction tree (``FAN`` blocks in each
node), and the last one of a source is drawn by its own probability.

Blocks are fixed by a hash of the id and the number of documents of the source, random numbers
by a hash of the id, so partitions and reruns change nothing, and a source of any size is split.
Null and blank texts have size 0; null sources are one source, the last in order. Rows that repeat
an id are separate documents.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.llm.common import packed, ship, table, unpacked, word_count
from vigil.operators.ordered import row_index
from vigil.session import write_table

WEIGHTS = (1, 2, 3)         # fixed by the contract: repeated over the sources in code point order, null last
MOST = 3                    # fixed by the contract: no source gives more than this many times its size
BLOCK = 2048                # documents in a block, about
FAN = 1024                  # blocks whose residuals meet in a node of the tree
SEED = 20
NEAR = 1e-9                 # closer to 0 or 1 counts as integral


def source_targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST) -> DataFrame:
    """``(source, n_docs, source_size, target)``: all words shared by weight, no source above ``most`` times its size,
    the excess shared again by weight until none is above."""
    sums = write_table(sized.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size")), "sources")
    placed = row_index(sums.select("*", F.col("source").isNull().alias("_last"), F.coalesce("source", F.lit("")).alias("_name")),
                       ["_last", "_name"])
    k = F.col("row_idx") % len(weights)
    weighed = write_table(placed.df.select("source", "n_docs", "source_size",
                                           F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (k + 1).cast("int")).alias("weight")), "weighed")
    placed.release()
    total, mass = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    share = (total / mass) if mass else 0.0          # words for each unit of weight
    limit = F.lit(float(most)) * F.col("source_size")
    while mass:
        above = F.col("weight") * F.lit(share) > limit
        kept, free = weighed.agg(F.sum(F.when(above, limit).otherwise(0.0)), F.sum(F.when(above, 0.0).otherwise(F.col("weight")))).first()
        raised = (total - kept) / free if free else share
        if raised <= share:
            break
        share = raised
    return weighed.select("source", "n_docs", "source_size", F.least(F.col("weight") * F.lit(float(share)), limit).alias("target"))


def pair_up(p: float, q: float, u: float) -> tuple[float, float]:
    """One pivotal step: mass moves between two probabilities until one is 0 or 1; both keep their expectation."""
    s = p + q
    if s <= 1:
        return (0.0, s) if u * s < q else (s, 0.0)
    return (1.0, s - 1) if u * (2 - s) < 1 - q else (s - 1, 1.0)


def settle(p: list[float], u: list[float], size: list[int] | None = None, most: float = MOST) -> tuple[list[float], int]:
    """Settle the copies ``p`` one after another: whole numbers, but for the position that comes second (-1: none is left).

    With sizes, all ``p`` are one rate. What a step changes in words is then spread over the documents that follow: each
    takes the rate that still leads to the words of the block. It is fair as well (the rate keeps its expectation), and as
    the sizes fall, the long documents are made good for by many short ones."""
    out = list(p)
    held, rest = -1, sum(size) if size else 0
    due = p[0] * rest if size else 0.0
    for j in range(len(out)):
        if size:
            if rest:
                out[j] = min(max(due / rest, 0.0), most)
            rest -= size[j]
            due -= out[j] * size[j]
        whole = round(out[j])
        if abs(out[j] - whole) <= NEAR:
            out[j] = float(whole)
        elif held < 0:
            held = j
        else:
            before = (out[held], out[j])
            base = (int(out[held]), int(out[j]))
            a, b = pair_up(out[held] - base[0], out[j] - base[1], u[j])
            out[held], out[j] = base[0] + a, base[1] + b
            if size:
                due -= (out[held] - before[0]) * size[held] + (out[j] - before[1]) * size[j]
            left = [k for k in (held, j) if abs(out[k] - round(out[k])) > NEAR]
            for k in (held, j):
                if k not in left:
                    out[k] = float(round(out[k]))
            held = left[0] if left else -1
    return out, held


def _settle(level: int, last: bool):
    def run(group: pa.Table) -> pa.Table:
        rows = group.sort_by([("size", "descending"), ("doc_id", "ascending")])
        u = rows.column("u").to_pylist()
        p, held = settle(rows.column("p").to_pylist(), u, None if level else rows.column("size").to_pylist())
        if held >= 0 and last:
            p[held] = int(p[held]) + float(u[held] < p[held] % 1)
            held = -1
        done = [i != held for i in range(len(p))]
        return rows.set_column(rows.schema.get_field_index("p"), "p", pa.array(p, pa.float64())).append_column("settled", pa.array(done))
    return run


def mix(sized: DataFrame, targets: DataFrame, seed: int = SEED) -> DataFrame:
    """``sized`` (``doc_id, source, size``) with ``source_size``, ``target`` and ``copies``, the times each document is taken."""
    spark = sized.sparkSession
    ship(spark)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rated = targets.select(F.col("source").alias("_source"), "n_docs", "source_size", "target", rate.alias("rate"))
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id"), 11) / F.lit(float(1 << 53))
    blocks = F.ceil(F.col("n_docs") / BLOCK).cast("long")
    rows = sized.join(rated, sized["source"].eqNullSafe(rated["_source"])).select(
        "doc_id", "source", "size", "source_size", "target", F.col("rate").alias("p"), draw.alias("u"),
        F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), blocks).alias("block"))
    shape = "doc_id {id}, source {src}, size long, source_size long, target double, p double, u double, block long".format(
        id=rows.schema["doc_id"].dataType.simpleString(), src=rows.schema["source"].dataType.simpleString())
    most = targets.agg(F.max("n_docs")).first()[0] or 0
    width = -(-most // BLOCK)
    parts, undecided, depth = [], rows, 0
    while True:
        level = write_table(undecided.groupBy("source", "block").applyInArrow(_settle(depth, width <= 1), shape + ", settled boolean"), "mix")
        parts.append(level.where("settled"))
        if width <= 1:
            break
        undecided = level.where("not settled").drop("settled").withColumn("block", F.expr(f"block div {FAN}"))
        width, depth = -(-width // FAN), depth + 1
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out.select("doc_id", "source", "size", "source_size", "target", F.round("p").cast("long").alias("copies"))


def sized_documents(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, size)``, written once: the texts are read a single time."""
    return write_table(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sized")


def mix_documents(docs: DataFrame) -> DataFrame:
    sized = sized_documents(docs)
    return mix(sized, source_targets(sized))


def take(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """``docs`` with every row as often as ``mixed`` takes it. Rows that share an id get the copies of that id in turn,
    the highest first."""
    wanted = mixed.groupBy(F.col("doc_id").alias("_id")).agg(*(F.count_if(F.col("copies") >= k).alias(f"_at_least_{k}") for k in range(1, MOST + 1)))
    named = packed(docs).withColumn("key", F.col("row.doc_id"))
    numbered = named.withColumn("nth", F.row_number().over(Window.partitionBy("key").orderBy("key")))
    met = numbered.join(wanted, F.col("key").eqNullSafe(F.col("_id")))
    copies = sum(((F.col("nth") <= F.col(f"_at_least_{k}")).cast("int") for k in range(1, MOST + 1)), start=F.lit(0))
    return unpacked(met.withColumn("copy", F.explode(F.sequence(F.lit(0), copies))).where("copy > 0"), docs.columns)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
