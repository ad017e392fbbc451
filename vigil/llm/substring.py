"""Repeated passages by hashing units of lines.

A text is cut into units: at line ends and, because passages are also pasted into the middle of
a line, after a full stop, question or exclamation mark and before a capitalised word. Every
unit is normalised (lower case, white space). The shortest ranges of neighbouring units with
``MIN_WORDS`` words, from each unit on and up to each unit, are windows, hashed to 128 bits. Digests
are grouped over the whole corpus; the occurrence with the smallest (doc_id, unit) is kept, all
others are repeats (a text that goes round in a circle keeps its first round). So a unit goes only as part of a sequence that stands
elsewhere as a whole, however often it occurs by itself; and as windows cover every longer
range, all units of a repeated sequence of ``MIN_WORDS`` words go. Windows that overlap or touch
are one span. Lines are windows as well, whatever their length: every line that equals an earlier
whole line goes. Spans keep their offsets in the original text.

Only a digest's first occurrence and its count are gathered, by partial aggregation, so a window
that a third of all documents share is one row. Null and empty texts have no units. Rows with a
null id come last in rank; rows that share an id (or have none) are told apart by a hash of their texts, so
that only rows with equal texts are one document.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.llm.common import ship, small_slices, table, unpacked
from vigil.session import write_table

MIN_WORDS = 10              # words of the shortest window; whole lines of any length are removed
CUTS = r"\n+|(?<=[.!?])\s+|\s+(?=\p{Lu})"
SLICE_BYTES = 4 << 20


def units_of(text: str, cutter) -> Iterator[tuple[int, int, int, str]]:
    """Start, end, number of words and normalised text of each unit with a word."""
    at = 0
    for end, after in [*((m.start(), m.end()) for m in cutter.finditer(text)), (len(text), len(text))]:
        words = text[at:end].lower().split()
        if words:
            yield at, end, len(words), " ".join(words)
        at = after


def windows_of(counts: list[int], least: int) -> list[tuple[int, int]]:
    """The shortest ranges ``(from, to)`` of units with ``least`` words, one from each unit on and one up to each unit, as far
    as the text has them. Any range with ``least`` words is covered by those inside it."""
    out = set()
    to = total = 0
    for at, n in enumerate(counts):
        while to < len(counts) and total < least:
            total += counts[to]
            to += 1
        if total < least:
            break
        out.add((at, to))
        total -= n
    at = total = 0
    for to, n in enumerate(counts, 1):
        total += n
        while total - counts[at] >= least:
            total -= counts[at]
            at += 1
        if total >= least:
            out.add((at, to))
    return sorted(out)


def lines_of(units: list[tuple[int, int, int, str]], text: str) -> Iterator[tuple[int, int]]:
    """The ranges ``(from, to)`` of units that are the lines of the text."""
    at = 0
    for to in range(1, len(units) + 1):
        if to == len(units) or text.find("\n", units[to - 1][1], units[to][0]) >= 0:
            yield at, to
            at = to


def row_key(docs: DataFrame, id_col: str, text_col: str) -> Column:
    """What tells rows with one id apart: a hash of the text if an id (or none) stands in several rows, else 0."""
    ids = docs.select(F.col(f"`{id_col}`").alias("id")).groupBy("id").count()
    return F.xxhash64(F.col(f"`{text_col}`")) if ids.where("count > 1").limit(1).count() else F.lit(0).cast("long")


def text_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                 key: Column | None = None) -> DataFrame:
    """``(id, key, unit, to, start, end, before, n_words, h, g)`` of all windows and lines of all texts: the first unit and the one
    behind the last, offsets, words of the text before it and in it, and the digest. Lines of fewer words than a window
    have digests of their own, so that they only meet whole lines."""
    ship(docs.sparkSession)
    names = ["id", "key", "unit", "to", "start", "end", "before", "n_words", "h", "g"]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex
        import xxhash

        cutter = regex.compile(CUTS)
        for batch in small_slices(batches, "text", SLICE_BYTES):
            ids, keys = batch.column("id"), batch.column("key")
            rows, cols, digests = [], [[] for _ in kinds], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                units = list(units_of(text or "", cutter))
                counts = [n for _, _, n, _ in units]
                sums = [0, *itertools.accumulate(counts)]
                for at, to in sorted({*windows_of(counts, min_words), *lines_of(units, text or "")}):
                    rows.append(i)
                    words = " ".join([u[3] for u in units[at:to]])
                    if sums[to] - sums[at] < min_words:
                        words = "\n" + words
                    digests.append(xxhash.xxh3_128_digest(words.encode("utf-8", "surrogatepass")))
                    for col, value in zip(cols, (at, to, units[at][0], units[to - 1][1], sums[at], sums[to] - sums[at]), strict=True):
                        col.append(value)
            halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            at_rows = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays([ids.take(at_rows), keys.take(at_rows), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True)),
                                              pa.array(halves[:, 0]), pa.array(halves[:, 1])], names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    key = row_key(docs, id_col, text_col) if key is None else key
    return docs.select(F.col(id_col).alias("id"), key.alias("key"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, key long, unit int, to int, start long, end long, before int, n_words int, h long, g long")


def keyed_spans(docs: DataFrame, key: Column, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """``(id, key, start, end, n_words, kept)``; a row is named by its id and ``key``."""
    windows = write_table(text_windows(docs, id_col, text_col, min_words, key), "windows")
    place = F.struct(F.col("id").isNull().alias("unnamed"), "id", "key", "unit", "start")
    # written, so that the shuffle files of the grouping are gone before the join has its own
    first = write_table(windows.groupBy("h", "g").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "firsts")
    later = windows.join(first, ["h", "g"]).where(
        ~F.col("id").eqNullSafe(F.col("first.id")) | (F.col("key") != F.col("first.key")) | (F.col("unit") != F.col("first.unit")))
    order = Window.partitionBy("id", "key").orderBy("unit", "to")
    reach = F.max("to").over(order.rowsBetween(Window.unboundedPreceding, -1))
    apart = later.withColumn("apart", F.coalesce(F.col("unit") > reach, F.lit(True)).cast("int"))
    runs = apart.withColumn("run", F.sum("apart").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return runs.groupBy("id", "key", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"),
        (F.max(F.col("before") + F.col("n_words")) - F.min("before")).cast("long").alias("n_words"), F.min_by("first", "unit").alias("kept"))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``(id_col, start, end, n_words, kept_id, kept_start)``: spans to remove, in code points with ``end`` exclusive, and
    where the first window of each is kept."""
    spans = keyed_spans(docs, row_key(docs, id_col, text_col), id_col, text_col, min_words)
    return spans.select(F.col("id").alias(id_col), "start", "end", "n_words", F.col("kept.id").alias("kept_id"), F.col("kept.start").alias("kept_start"))


def without(text: Column, spans: Column) -> Column:
    """``text`` without the spans (sorted, disjoint; an array of structs with ``start`` and ``end``)."""
    piece = F.aggregate(spans, F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")), lambda acc, s: F.struct(
        F.concat(acc["out"], F.substring(text, acc["at"].cast("int") + 1, (s["start"] - acc["at"]).cast("int"))).alias("out"),
        s["end"].alias("at")))
    return F.concat(piece["out"], F.substring(text, piece["at"].cast("int") + 1, F.length(text)))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """The documents with repeated passages cut out of ``text_col``; other columns stay as they are."""
    key = row_key(docs, id_col, text_col)
    spans = keyed_spans(docs, key, id_col, text_col, min_words).groupBy(F.col("id").alias("_span_id"), F.col("key").alias("_span_key")).agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_spans"))
    joined = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), key.alias("_key")).join(
        spans, F.col(f"row.`{id_col}`").eqNullSafe(F.col("_span_id")) & (F.col("_key") == F.col("_span_key")), "left")
    text = F.col(f"row.`{text_col}`")
    return unpacked(joined, docs.columns, **{text_col: F.when(F.col("_spans").isNull(), text).otherwise(without(text, F.col("_spans")))})


def op7_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each removed span; documents without one have no row."""
    return repeated_spans(table(spark, sf_dir, "documents"))
