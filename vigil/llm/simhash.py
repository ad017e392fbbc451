"""SimHash near-duplicates by tiled exact comparison.

Fingerprints are reduced to distinct values first, so copies cost one row. The distinct
values are dealt into tiles by their number of set bits (and a hash, beyond ``TILE`` rows).
Two values within the radius differ in population count by the radius at most, so only
tiles whose counts are that close meet; each meeting is one group, compared block by block
with exclusive-or and bit counts in numpy. A meeting gives back one link for each value that
has a partner there (to the root of its local component), so a group of thousands of near
copies gives thousands of links, not millions, and no connection is lost.

Null and blank texts have fingerprint zero. Rows without an id have a fingerprint and the
component of their class, if any row of it has an id. Repeated rows and ids are kept.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.common import packed, ship, small_slices, table, text_bytes, unpacked
from vigil.llm.components import connected_components
from vigil.session import write_table

SHINGLE = 3                 # fixed by the contract
RADIUS = 3                  # fixed by the contract
SEED = 42                   # fixed by the contract
TILE = 32_768               # distinct fingerprints of one population count in a tile, about
BLOCK = 1 << 18             # comparisons at a time
HASHES = 1 << 16            # shingle hashes unpacked at a time
SLICE_BYTES = 16 << 20


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """64 bits, each set if more than half of the shingle hashes have it (unsigned)."""
    import xxhash

    words = text.lower().split() if text else []
    if not words:
        return 0
    if len(words) < shingle:
        grams: Iterator[bytes] = iter([b" ".join(words)])
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    hashes = map(xxhash.xxh64_intdigest, grams, itertools.repeat(SEED))
    total = max(1, len(words) - shingle + 1)
    counts = np.zeros(64, np.int64)
    for start in range(0, total, HASHES):
        h = np.fromiter(itertools.islice(hashes, HASHES), "<u8", min(HASHES, total - start))
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``(id_col, fp)``: the fingerprint of every row as a signed long with the same 64 bits."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches, "text", SLICE_BYTES):
            fp = np.array([fingerprint(t, shingle) for t in text_bytes(batch.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(fp.view(np.int64))], names=[id_col, "fp"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"`{id_col}` {kind}, fp long")


def link_tiles(a: np.ndarray, b: np.ndarray | None, radius: int) -> np.ndarray:
    """Local components of the values ``a`` and ``b`` (of ``a`` alone if ``b`` is None) under links between the two
    tiles: for each value, the position of the first value of its component."""
    other = a if b is None else b
    shift = 0 if b is None else len(a)
    root = np.arange(shift + len(other))
    step = max(1, BLOCK // max(1, len(other)))
    for start in range(0, len(a), step):
        low = start if b is None else 0
        near = np.bitwise_count(a[start:start + step, None] ^ other[None, low:]) <= radius
        rows, cols = np.nonzero(near)
        rows, cols = rows + start, cols + low + shift
        while True:
            x, y = root[rows], root[cols]
            apart = x != y
            if not apart.any():
                break
            np.minimum.at(root, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
            while (root[root] != root).any():
                root = root[root]
    return root


def near_links(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints (column ``fp``) whose components are those of all pairs within ``radius``."""
    ship(distinct.sparkSession)
    sized = distinct.select("fp", F.bit_count("fp").alias("p"))
    rows = dict(sized.groupBy("p").count().collect())                 # 65 population counts at most
    chunks = F.array(*(F.lit(-(-rows.get(p, 0) // tile)) for p in range(65)))
    placed = sized.select("fp", "p", F.pmod(F.xxhash64("fp"), F.get(chunks, F.col("p"))).cast("int").alias("c"))
    around = F.flatten(F.transform(
        F.sequence(F.greatest(F.col("p") - radius, F.lit(0)), F.least(F.col("p") + radius, F.lit(64))),
        lambda q: F.when(F.get(chunks, q) > 0, F.transform(
            F.sequence(F.lit(0), F.get(chunks, q) - 1), lambda k: F.struct(q.alias("p"), k.cast("int").alias("c"))))
        .otherwise(F.array().cast("array<struct<p:int,c:int>>"))))
    own = F.struct(F.col("p").cast("int").alias("p"), F.col("c").alias("c"))
    met = placed.select("fp", own.alias("own"), F.explode(around).alias("other")).select(
        F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
        (F.col("own") > F.col("other")).alias("upper"), "fp")

    def compare(group: pa.Table) -> pa.Table:
        fp = group.column("fp").to_numpy().view(np.uint64)
        upper = group.column("upper").to_numpy().astype(bool)
        a, b = fp[~upper], fp[upper]
        same = group.column("lo")[0] == group.column("hi")[0]
        order = np.concatenate([a, b]).view(np.int64)
        root = link_tiles(a, None if same else b, radius)
        linked = np.flatnonzero(root != np.arange(len(root)))
        return pa.table({"a": order[linked], "b": order[root[linked]]})

    return met.groupBy("lo", "hi").applyInArrow(compare, "a long, b long")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                       radius: int = RADIUS) -> DataFrame:
    """``(id_col, fp, component_id)``: the component is named by the smallest id that can be reached over links."""
    fps = write_table(fingerprints(docs, id_col, text_col, shingle), "simhash")
    classes = fps.groupBy("fp").agg(F.min(id_col).alias("first"))
    roots = connected_components(near_links(classes, radius))
    linked = classes.join(roots.withColumnRenamed("node", "fp").union(
        roots.select(F.col("root").alias("fp"), "root").distinct()), "fp")
    named = linked.join(linked.groupBy("root").agg(F.min("first").alias("least")), "root").select("fp", "least")
    component = classes.join(named, "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id"))
    return fps.join(component, "fp").select(id_col, "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of each component: the document whose id names it. Documents without an id all stay. Rows that share an id
    and have different texts are told apart by a hash of the text, so that each names a component of its own."""
    named = packed(docs.where("doc_id is not null")).withColumn("key", F.struct("row.doc_id", F.xxhash64("row.text").alias("h")))
    found = simhash_components(named.select("key", F.col("row.text").alias("text")), "key", shingle=shingle, radius=radius)
    kept = found.where("key = component_id").select("key").distinct()
    return unpacked(named.join(kept, "key", "left_semi").dropDuplicates(["key"]), docs.columns).union(docs.where("doc_id is null"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
