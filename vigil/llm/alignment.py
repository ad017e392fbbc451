"""Alignment of two tokenizers' tokens over whole texts, by whitespace-token anchors.

Texts are tokenized by both, whole. Offsets where a space-marked token starts in both, so that both have a token
that ends there, are the anchors; the joined token bytes of both are compared with the text before, so an anchor's
offset is the same place in it. Anchors cut a document into windows of token ids. Runs of text between single spaces that
return are not tokenized again: no token reaches over such a space, so their windows are looked up in a bounded table per worker. A window's alignment hangs on its
ids alone, so it is looked up by its two (packed) id tuples in a bounded table per worker; windows that are not there, or too
long to keep, are walked along the ends of their tokens. It gives groups (cut where tokens of both end) and links
(pairs of tokens that share a byte).

How many documents link a pair of ids is counted over the whole corpus: each document brings its different pairs,
summed before and after one shuffle. A document then needs the counts of its own pairs. The pairs counted most often
(``HOT_PAIRS`` at most, by a count that is found from a histogram of all counts) go to all tasks as two arrays;
documents' other pairs meet their counts in a join. Both ways give the same numbers.

Texts that are null or empty, or that a tokenizer doesn't give back byte by byte, have no tokens: zeros and empty
groups. Rows with equal ids or texts are rows, and documents, of their own; null ids stay. Other columns are not read.
Empty tables give empty results.
"""

from __future__ import annotations

import functools
import gc
import json
import os
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain
from typing import Generic, TypeVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.bpe import byte_alphabet, tokenizer_path
from vigil.llm.common import ship, small_slices, table
from vigil.session import write_table

BLOCK_BYTES = 512 << 10         # text that is tokenized and aligned at once
KEPT_WINDOWS = 5_000            # window alignments kept per worker, and as many older ones
KEPT_RUNS = 200_000             # runs of text whose ids are kept per worker, and as many older ones
LONGEST_KEPT = 64               # longer windows (in tokens) and runs (in characters) are not kept
#: A space between two characters that are neither white space nor joined to what stands beside them: both tokenizers start
#: a token at each such space, whatever else the text holds.
CUT = re.compile(" (?<=[!-~\u00c0-\u024f] )(?=[!-~\u00c0-\u024f])")
PLAIN = frozenset(map(chr, [*range(0x21, 0x7F), *range(0xC0, 0x250)]))
BETWEEN = b"\xff" * 4           # stands between the two id tuples (32-bit integers) of a window: no id
HOT_PAIRS = 1 << 18             # pairs whose counts are sent to all tasks, at most (17 bytes each)
FIRST, SECOND = "byte_bpe_50k.json", "piece_bpe_32k.model"


K, V = TypeVar("K"), TypeVar("V")
Aligned = tuple[int, int, int, bytes, str]


class Aligner:
    """Two tokenizers, the bytes of their tokens, and the table of window alignments."""

    def __init__(self, first: str, second: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(first)
        self.a.encode_special_tokens = True         # their strings in a text are ordinary text
        self.a.no_padding()
        self.a.no_truncation()
        self.b = sentencepiece.SentencePieceProcessor(model_file=second)
        with open(first, encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        byte = {c: i for i, c in enumerate(byte_alphabet())}
        self.bytes_a = [b""] * (max(vocab.values(), default=-1) + 1)
        for text, i in vocab.items():
            if all(c in byte for c in text):
                self.bytes_a[i] = bytes(map(byte.__getitem__, text))
        self.bytes_a += [b""] * (self.a.get_vocab_size() - len(self.bytes_a))
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))]
        self.sizes_a, self.sizes_b = (np.array([len(x) for x in held], np.int64) for held in (self.bytes_a, self.bytes_b))
        # an id as text, with what stands behind it: within a group and at its end
        self.shown = [str(i) + c for n, last in ((len(self.sizes_a), "|"), (len(self.sizes_b), ";")) for i in range(n) for c in (",", last)]
        self.marked_a = np.array([x[:1] == b" " for x in self.bytes_a], bool)
        self.marked_b = np.array([x[:1] == b" " for x in self.bytes_b], bool)
        # no token of either reaches over a cut of CUT, and nothing outside a run changes its ids
        self.by_runs = (spec.get("normalizer") is None and spec.get("post_processor") is None
                        and spec.get("pre_tokenizer") == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
                        and not any(b" " in x.lstrip(b" ") for x in self.bytes_b))
        self.runs: Kept[str, list[Aligned] | None] = Kept(KEPT_RUNS)
        self.kept: Kept[bytes, Aligned] = Kept(KEPT_WINDOWS)

    def windows(self, texts: list[str]) -> list[tuple[np.ndarray, list[bytes]] | None]:
        """Byte offsets and ids of the windows of each text; None if a tokenizer doesn't give the text back. Texts are not
        empty and tokenized whole."""
        out = []
        for text, first, second in zip(texts, self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False),
                                       self.b.encode(texts, num_threads=1), strict=True):
            a, b, raw = first.ids, second, b" " + text.encode()
            if b"".join(map(self.bytes_a.__getitem__, a)) != raw or b"".join(map(self.bytes_b.__getitem__, b)) != raw:
                out.append(None)
                continue
            a, b = np.array(a, "<i4"), np.array(b, "<i4")
            (at_a, from_a), (at_b, from_b) = _marked(a, self.sizes_a, self.marked_a), _marked(b, self.sizes_b, self.marked_b)
            # the bytes are the same: a common offset is the same place, and a token of each ends there
            starts, in_a, in_b = np.intersect1d(from_a, from_b, assume_unique=True, return_indices=True)
            cut_a, cut_b = (4 * at_a[in_a]).tolist(), (4 * at_b[in_b]).tolist()
            a, b = a.tobytes(), b.tobytes()
            out.append((starts, [a[i:k] + BETWEEN + b[j:m] for i, k, j, m in zip(
                cut_a, [*cut_a[1:], len(a)], cut_b, [*cut_b[1:], len(b)], strict=True)]))
        return out

    def read(self, runs: list[str]) -> dict[str, list[bytes] | None]:
        """The windows of each run; None if its bytes don't come back. Runs are read as one text with spaces between, and by
        themselves if a run can't stand in it or a window reaches over such a space."""
        out: dict[str, list[bytes] | None] = {}
        joined = [r for r in runs if r[0] in PLAIN and r[-1] in PLAIN]
        if joined and (found := self.windows([" ".join(joined)])[0]):
            starts, whole = found
            own = np.cumsum([0, *[len(r.encode()) + 1 for r in joined[:-1]]])
            place = np.searchsorted(starts, own)
            if (starts[np.minimum(place, len(starts) - 1)] == own).all():
                place = place.tolist()
                out = {r: whole[i:k] for r, i, k in zip(joined, place, [*place[1:], len(whole)], strict=True)}
        rest = [r for r in runs if r not in out]
        for r, found in zip(rest, self.windows(rest) if rest else [], strict=True):
            out[r] = None if found is None else found[1]
        return out

    def walk(self, windows: list[bytes]) -> list[Aligned]:
        """The alignment of each window: numbers of tokens of both, number of groups, links (first id times 2^32 plus second id) and
        groups as text. The windows are laid side by side: a byte range between two ends of tokens is a link, an end of
        tokens of both closes a group."""
        ids = np.frombuffer(b"".join(windows), "<i4").astype(np.int64)
        lasts = np.cumsum([len(w) // 4 for w in windows])               # behind each window
        bars = np.flatnonzero(ids < 0)
        is_a = np.repeat(np.tile([True, False], len(windows)), np.diff(np.column_stack([bars, lasts]).ravel(), prepend=0))
        is_a[bars] = False
        is_b = ~is_a
        is_b[bars] = False
        ids_a, ids_b = ids[is_a], ids[is_b]
        n_all = np.diff(lasts, prepend=0) - 1
        n_a = bars - (lasts - n_all - 1)
        ends_a, ends_b = np.cumsum(self.sizes_a[ids_a]), np.cumsum(self.sizes_b[ids_b])
        ends = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")    # two sorted runs: a merge
        again = np.append(ends[1:] == ends[:-1], False)
        shared, ends = ends[again], ends[~again]
        links = ids_a[np.searchsorted(ends_a, ends)] << 32 | ids_b[np.searchsorted(ends_b, ends)]
        group_a, group_b = np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b)
        # the groups' texts: ids of the first, the last with a bar, ids of the second, the last with a semicolon
        shown = np.concatenate([2 * ids_a + (shared[group_a] == ends_a), 2 * (ids_b + len(self.sizes_a)) + (shared[group_b] == ends_b)])
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        shown = list(map(self.shown.__getitem__, shown[order].tolist()))
        ends_of = ends_a[np.cumsum(n_a) - 1]                # every window ends with a token of both
        at_byte, at_group = ([0, *(np.searchsorted(x, ends_of) + 1).tolist()] for x in (ends, shared))
        at_shown = np.cumsum(n_all).tolist()
        held = links.tobytes()
        return [(a, n - a, h - g, held[8 * i:8 * k], "".join(shown[m - n:m])[:-1]) for a, n, g, h, i, k, m in zip(
            n_a.tolist(), n_all.tolist(), at_group, at_group[1:], at_byte, at_byte[1:], at_shown, strict=False)]

    def align_runs(self, runs: list[str]) -> list[list[Aligned] | None]:
        """The alignments of each run's windows; None if its bytes don't come back."""
        windows = self.read(runs)
        aligned = self.kept.look_up({w for ws in windows.values() if ws is not None for w in ws}, self.walk, lambda w: len(w) <= 4 * LONGEST_KEPT)
        return [None if (ws := windows[r]) is None else [aligned[w] for w in ws] for r in runs]

    def align(self, texts: list[str | None]) -> list[tuple[int, int, int, np.ndarray, str]]:
        """``(n_a, n_b, n_groups, links, groups)`` of each text."""
        cut = [(CUT.split(t) if self.by_runs else [t]) if t else [] for t in texts]
        done = self.runs.look_up(set(chain.from_iterable(cut)), self.align_runs, lambda r: len(r) <= LONGEST_KEPT)
        out = []
        for runs in cut:
            own = list(map(done.__getitem__, runs))
            own = [] if None in own else list(chain.from_iterable(own))
            links = np.frombuffer(b"".join([w[3] for w in own]), np.int64)
            out.append((*(sum([w[k] for w in own]) for k in range(3)), links, ";".join([w[4] for w in own])))
        return out


class Kept(Generic[K, V]):
    """A bounded table: the last ``limit`` entries used, and up to ``limit`` older ones."""

    def __init__(self, limit: int):
        self.limit = limit
        self.newer: dict[K, V] = {}
        self.older: dict[K, V] = {}

    def look_up(self, keys: Iterable[K], make: Callable[[list[K]], list[V]], keep: Callable[[K], bool]) -> dict[K, V]:
        """Values of all keys; ``make`` gives those that are not here, ``keep`` says which of them to keep."""
        newer, older = self.newer, self.older
        out, new = {}, []
        for k in keys:
            if k in newer:
                out[k] = newer[k]
            elif k in older:
                out[k] = newer[k] = older[k]
            else:
                new.append(k)
        for k, v in zip(new, make(new) if new else [], strict=True):
            out[k] = v
            if keep(k):
                newer[k] = v
        if len(newer) > self.limit:
            self.newer, self.older = {}, newer
        return out


def _marked(ids: np.ndarray, sizes: np.ndarray, marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and byte offsets of the first token and of those that start with a space."""
    mark = marked[ids]
    mark[:1] = True
    at, long = np.flatnonzero(mark), sizes[ids]
    return at, (np.cumsum(long) - long)[at]


@functools.lru_cache(maxsize=2)
def aligner(first: str, second: str) -> Aligner:
    return Aligner(first, second)


def align_tokens(docs: DataFrame, first: str, second: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_a, n_b, n_groups, n_links, groups, pairs, times)`` of every row: groups as text (``a1,a2|b1;a3|b2``, ids
    in order), its different linked pairs (first id times 2^32 plus second id) and how often each is linked."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(first, second)
        collects = gc.isenabled()
        gc.disable()            # the tables hold no cycles, and walking them costs a tenth of the time
        try:
            for batch in small_slices(batches, "text", BLOCK_BYTES):
                rows = own.align(batch.column("text").to_pylist())
                different = [np.unique(r[3], return_counts=True) for r in rows]
                ends = pa.array(np.cumsum([0, *(len(p) for p, _ in different)]), pa.int32())
                pairs, times = (pa.array(np.concatenate(x), pa.int64()) for x in zip(*different, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), *(pa.array([r[k] for r in rows], pa.int64()) for k in range(3)),
                     pa.array([len(r[3]) for r in rows], pa.int64()), pa.array([r[4] for r in rows], pa.string()),
                     pa.ListArray.from_arrays(ends, pairs), pa.ListArray.from_arrays(ends, times)],
                    names=[id_col, "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"])
        finally:
            if collects:
                gc.enable()

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(
        run, f"`{id_col}` {kind}, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<long>")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``(pair, n, best)``: in how many rows of ``aligned`` a pair is linked, and whether no pair of its first id has more."""
    counts = write_table(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")), "pair-counts")
    one = F.shiftright("pair", 32)
    most = counts.groupBy(one.alias("a")).agg(F.max("n").alias("most"))     # as many rows as the first vocabulary at most
    return counts.join(most, one == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def hot_pairs(counts: DataFrame, limit: int = HOT_PAIRS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs, counts and best marks of all pairs whose count reaches the least power of two that ``limit`` pairs or fewer reach."""
    level = F.floor(F.log2("n")).cast("int")
    sizes = {r.level: r["count"] for r in counts.groupBy(level.alias("level")).count().collect()}       # 63 rows at most
    least, held = max(sizes, default=0) + 1, 0
    while least - 1 >= min(sizes, default=0) and held + sizes.get(least - 1, 0) <= limit:
        least -= 1
        held += sizes.get(least, 0)
    hot = counts.where(level >= least).orderBy("pair").toArrow()
    return tuple(hot.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in ("pair", "n", "best"))


def link_counts(aligned: DataFrame, counts: DataFrame, limit: int = HOT_PAIRS) -> DataFrame:
    """The rows of ``aligned`` (with a ``row`` number) without pairs; with ``n_best``, the links that no other second id
    beats, and ``count_sum``, the sum of all links' counts."""
    spark = aligned.sparkSession
    known = spark.sparkContext.broadcast(hot_pairs(counts, limit))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, numbers, marks = known.value
        for batch in batches:
            ends = np.cumsum([0, *(x or 0 for x in pa.compute.list_value_length(batch.column("pairs")).to_pylist())])
            pairs = batch.column("pairs").flatten().to_numpy(zero_copy_only=False)
            times = batch.column("times").flatten().to_numpy(zero_copy_only=False)
            place = np.minimum(np.searchsorted(hot, pairs), max(len(hot) - 1, 0))
            is_hot = hot[place] == pairs if len(hot) else np.zeros(len(pairs), bool)
            weight = np.where(is_hot, times, 0)
            totals = [np.concatenate([[0], np.cumsum(x)]) for x in (
                (weight * marks[place], weight * numbers[place]) if len(hot) else (weight, weight))]
            cold = pa.array(np.concatenate([[0], np.cumsum(~is_hot)])[ends], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *(pa.array(t[ends[1:]] - t[ends[:-1]], pa.int64()) for t in totals),
                 pa.ListArray.from_arrays(cold, pa.array(pairs[~is_hot], pa.int64())),
                 pa.ListArray.from_arrays(cold, pa.array(times[~is_hot], pa.int64()))],
                names=["row", "n_best", "count_sum", "pairs", "times"])

    ship(spark)
    looked_up = aligned.select("row", "pairs", "times").mapInArrow(
        run, "row long, n_best long, count_sum long, pairs array<long>, times array<long>")
    others = looked_up.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", "x.pairs", "x.times").join(
        counts, F.col("pairs") == F.col("pair"))
    # hot and other parts of a row are summed in one exchange
    parts = looked_up.select("row", "n_best", "count_sum").unionByName(others.select(
        "row", F.when(F.col("best"), F.col("times")).otherwise(F.lit(0)).alias("n_best"), (F.col("times") * F.col("n")).alias("count_sum")))
    sums = parts.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return aligned.drop("pairs", "times").join(sums, "row")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document aligned between the byte-level and the piece tokenizer."""
    found = align_tokens(table(spark, sf_dir, "documents"), tokenizer_path(FIRST), tokenizer_path(SECOND))
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2("groups", 256))
    aligned = write_table(found.withColumn("groups", digest).withColumnRenamed("groups", "groups_sha256").withColumn(
        "row", F.monotonically_increasing_id()), "alignments")
    out = link_counts(aligned, pair_counts(aligned))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
