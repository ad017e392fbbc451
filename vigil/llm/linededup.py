"""Line deduplication by an exact set-similarity join.

The tokens of a line are 32-bit hashes of its distinct words, one for each word: different words with one hash can only let
more lines meet. Pairs are verified on the words themselves. A line is removed if an earlier line
(smaller ``(doc_id, line)``) has a Jaccard similarity of at least 4/5. Equal lines are reduced to
their first occurrence beforehand, so copies cost one row each and never meet in pairs.

Tokens are ordered by rarity: how often they occur in different lines, counted in a table of
``RARITY`` hashed places (any order that all lines share is exact; a full place only makes a token
look more common, and only the magnitude of its count is kept), then by hash. Two similar lines share a token among the first ``n - ceil(0.8 n) + 1``
of each. Lines that meet in such a token pass the length filter, the positional filter (tokens left
behind both positions), a bound from 192-bit sketches and one from the number of tokens that the two
prefixes share; all four only drop pairs that can't reach the threshold. The rest is verified.

Many variants of one line would give a pair for each two of them. A line is therefore compared with
the first line of its token group, and with the others only where that first one is ruled out by the
filters; a line whose candidates all fail verification is then compared with all. Of a line's
candidates the one with the nearest sketch is verified first, the others only if it fails. So every line finds an earlier partner if there is one, and a hot group stays linear.

Only DataFrame functions run on the main path. Lines without a word stay. Documents without an id
stay as they are and take no part; rows that share an id count as one document, in ``line_dedup`` only if
their texts are equal. Null texts stay null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vigil.llm.common import WORD_GAP, packed, table, unpacked
from vigil.llm.quality import let
from vigil.session import drop_path, table_path, write_table

BLANKS = " \t\n\x0b\x0c\r"
NUM, DEN = 4, 5             # similarity of at least NUM / DEN
RARITY = 1 << 17            # places of the rarity table
SKETCHES = ("s1", "s2", "s3")   # longs of a line's sketch
FILTER_WORDS = 1 << 15      # 64-bit words of the bitmap that thins the lines before verification


def document_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(d, line, text)`` of all lines of all documents with an id."""
    return docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("d"), F.posexplode_outer(F.split(F.col(text_col), "\n")).alias("line", "text"))     # no filter that splits the text first


def _line_key() -> list[Column]:
    return [F.xxhash64("text").alias("h"), F.hash("text").alias("g")]


def _word_lines(lines: DataFrame) -> DataFrame:
    """The lines that have a word."""
    return lines.where(F.ltrim("text", F.lit(BLANKS)) != "")


def line_words() -> Column:
    """The different words of ``text``, which has one at least."""
    return F.array_distinct(F.split(F.btrim("text", F.lit(BLANKS)), WORD_GAP))


def line_classes(lines: DataFrame) -> DataFrame:
    """One row for each different line with a word: ``(d, line)`` of its first occurrence, its key, how often
    it occurs, its tokens and their sketches.

    A sketch holds the parity of the number of tokens of each of its bits, ``len(SKETCHES)`` longs. They are gathered from one row for each token: generated code, where a
    function over the array would be interpreted for every token. Both sides of the join stand on the one exchange by key."""
    found = _word_lines(lines).select("d", "line", *_line_key(), F.transform(line_words(), lambda w: F.hash(w)).alias("tokens"))
    first = found.groupBy("h", "g").agg(F.min(F.struct("d", "line")).alias("first"), F.first("tokens").alias("tokens"),
                                        F.count(F.lit(1)).alias("copies"))
    part, bit = F.pmod(F.shiftright("t", 6), F.lit(len(SKETCHES))), F.call_function("shiftleft", F.lit(1).cast("long"), F.col("t"))
    sketches = first.select("h", "g", "first", "copies", F.explode("tokens").alias("t")).groupBy("h", "g", "first", "copies").agg(
        *(F.bit_xor(F.when(part == i, bit).otherwise(F.lit(0).cast("long"))).alias(s) for i, s in enumerate(SKETCHES)))
    return first.join(sketches.drop("first", "copies").hint("merge"), ["h", "g"]).select("first.d", "first.line", "h", "g", "copies", "tokens", *SKETCHES)


def _place(token: Column) -> Column:
    return token.bitwiseAND(F.lit(RARITY - 1))


def rarity_table(classes: DataFrame) -> list[int]:
    """The rank of every place: eight times the binary logarithm of how many lines hold a token of it; ``RARITY`` numbers."""
    counts = classes.select(F.explode("tokens").alias("t")).groupBy(_place(F.col("t")).alias("place")).count().select(
        "place", F.floor(8 * F.log2("count")).cast("int").alias("rank")).toArrow()
    out = [0] * RARITY
    for place, rank in zip(counts.column("place").to_pylist(), counts.column("rank").to_pylist(), strict=True):
        out[place] = rank
    return out


def _shift(bits: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), bits.cast("int"))


def _literal(numbers: list[int], kind: str) -> Column:
    """A constant array of a fixed number of entries (folded into one literal by the optimizer)."""
    return F.split(F.lit(",".join(map(str, numbers))), ",").cast(f"array<{kind}>")


def line_prefixes(classes: DataFrame, rarity: list[int]) -> DataFrame:
    """``(d, line, h, g, copies, n, sketches, prefix)``: the number of tokens and the keys of the rarest ones, in order. A key is the
    token's rank times 2^33 and the token: different tokens have different keys."""
    known = _literal(rarity, "long")
    ordered = F.sort_array(F.transform("tokens", lambda t: F.shiftleft(F.get(known, _place(t)), 33) + t))
    size = F.expr(f"size(tokens) - ({NUM} * size(tokens) + {DEN - 1}) div {DEN} + 1").cast("int")
    return classes.select("d", "line", "h", "g", "copies", F.size("tokens").alias("n"), *SKETCHES, F.slice(ordered, 1, size).alias("prefix"))


def prefix_index(prefixes: DataFrame) -> DataFrame:
    """``(token, d, line, n, pos, sketches)`` for the tokens of every line's prefix; pos counts from 0."""
    entries = prefixes.select("d", "line", "n", *SKETCHES, F.posexplode("prefix").alias("pos", "token"))
    # nothing is null here; saying so keeps the optimizer from putting different filters before the one exchange
    def filled(c: str) -> Column:
        kind = entries.schema[c].dataType
        return F.col(c) if isinstance(kind, StructType) else F.coalesce(F.col(c), F.lit(0).cast(kind)).alias(c)

    return entries.select(*(filled(c) for c in ("token", "d", "line", "n", "pos", *SKETCHES)))


def _apart(a: str, b: str) -> Column:
    """Bits that one of the sketches of ``a`` and ``b`` has alone: for each there is a token of one line only."""
    return sum((F.bit_count(F.col(f"{a}{s}").bitwiseXOR(F.col(f"{b}{s}"))) for s in SKETCHES[1:]),
               F.bit_count(F.col(f"{a}{SKETCHES[0]}").bitwiseXOR(F.col(f"{b}{SKETCHES[0]}"))))


def may_match(a: str, b: str) -> Column:
    """Length, positional and sketch filter between the index entries ``a`` and ``b`` (column prefixes)."""
    c = {f"{k}_{s}": F.col(f"{x}{k}") for s, x in (("a", a), ("b", b)) for k in ("n", "pos")}
    both = c["n_a"] + c["n_b"]
    reach = F.least(c["pos_a"], c["pos_b"]) + F.least(c["n_a"] - c["pos_a"], c["n_b"] - c["pos_b"])
    # overlap >= NUM / (NUM + DEN) * both is what the threshold asks for
    return ((DEN * F.least(c["n_a"], c["n_b"]) >= NUM * F.greatest(c["n_a"], c["n_b"])) & ((NUM + DEN) * reach >= NUM * both)
            & ((NUM + DEN) * (both - _apart(a, b)) >= 2 * NUM * both))


def _before(a: str, b: str) -> Column:
    """Line ``a`` stands before line ``b``."""
    return (F.col(f"{a}d") < F.col(f"{b}d")) | ((F.col(f"{a}d") == F.col(f"{b}d")) & (F.col(f"{a}line") < F.col(f"{b}line")))


def _far(a: str, b: str) -> Column:
    """How far the sketches are apart for the lines' length, in thousandths."""
    return F.floor(1000 * _apart(a, b) / (F.col(f"{a}n") + F.col(f"{b}n"))).alias("far")


def _pairs(index: DataFrame, left: DataFrame) -> DataFrame:
    """``(x, y, n_x, n_y, far)`` for every entry of ``left`` and each earlier one of the index with the same token that passes the filters."""
    right = index.select(*(F.col(c).alias(f"o_{c}") for c in index.columns))
    return left.join(right, (F.col("token") == F.col("o_token")) & _before("o_", "") & may_match("", "o_")).select(
        F.struct("d", "line").alias("x"), F.struct(F.col("o_d").alias("d"), F.col("o_line").alias("line")).alias("y"),
        F.col("n").alias("n_x"), F.col("o_n").alias("n_y"), _far("", "o_"))


def enough_shared() -> Column:
    """Whether ``shared`` common tokens of the prefixes leave the threshold in reach. Of the line whose prefix ends with
    the more common token, only tokens behind the prefix can be shared besides; the longer of the two ends is taken."""
    behind = [F.expr(f"({NUM} * {n} + {DEN - 1}) div {DEN} - 1") for n in ("n_x", "n_y")]
    return (NUM + DEN) * (F.col("shared") + F.greatest(*behind)) >= NUM * (F.col("n_x") + F.col("n_y"))


def _counted(pairs: DataFrame, *more: Column) -> DataFrame:
    return pairs.groupBy("x", "y").agg(F.count(F.lit(1)).alias("shared"), F.max("n_x").alias("n_x"), F.max("n_y").alias("n_y"),
                                    F.min("far").alias("far"), *more)


def first_candidates(index: DataFrame) -> DataFrame:
    """``(x, y, far, by_first)``: candidates with the first line of each token group, or, where the filters rule that one out,
    with every earlier line of the group. A line without candidates of the first kind has met all lines it shares a
    token with, so how many tokens it shares with each is known and rules out most of them."""
    index = index.repartition("token")          # the window and the join share this exchange
    group = Window.partitionBy("token").orderBy("d", "line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = index.withColumn("first", F.first(F.struct("d", "line", "n", "pos", *SKETCHES)).over(group)).where(_before("first.", ""))
    likely = may_match("", "first.")
    near = seen.where(likely).select(F.struct("d", "line").alias("x"), F.struct("first.d", "first.line").alias("y"),
                                     F.col("n").alias("n_x"), F.col("first.n").alias("n_y"), _far("", "first."), F.lit(True).alias("by_first"))
    rest = _pairs(index, seen.where(~likely).drop("first")).withColumn("by_first", F.lit(False))
    met = write_table(_counted(near.union(rest), F.max("by_first").alias("by_first")), "line-meetings")
    partly = met.where("by_first").select("x", F.lit(True).alias("partly")).distinct()
    return met.join(partly, "x", "left").where(F.col("partly") | enough_shared()).select("x", "y", "far", "by_first")


def _thinned(rows: DataFrame, key: list[str], wanted: DataFrame) -> DataFrame:
    """Rows whose ``key`` may be in ``wanted``: a bitmap of ``FILTER_WORDS`` longs keeps all that are and drops most others."""
    bits = FILTER_WORDS * 64
    spot = F.pmod(F.xxhash64(*key), F.lit(bits))
    words_ = wanted.select(spot.alias("spot")).groupBy(F.expr("spot div 64").cast("int").alias("w")).agg(
        F.bit_or(_shift(F.col("spot") % 64)).alias("bits")).toArrow()
    out = [0] * FILTER_WORDS
    for w, b in zip(words_.column("w").to_pylist(), words_.column("bits").to_pylist(), strict=True):
        out[w] = b
    word = F.get(_literal(out, "long"), F.expr(f"pmod(xxhash64({', '.join(key)}), {bits}) div 64").cast("int"))
    return rows.where(word.bitwiseAND(_shift(spot % 64)) != 0)


def _similar(a: Column, b: Column, shared: Column) -> Column:
    return DEN * shared >= NUM * (F.size(a) + F.size(b) - shared)


def verified(pairs: DataFrame, prefixes: DataFrame, lines: DataFrame) -> DataFrame:
    """The pairs whose Jaccard similarity, of the sets of words, reaches the threshold. Only the lines of pairs are cut into
    words again; where rows share an id, only the texts that stand for a class."""
    named = ["d", "line", "h", "g"]
    ends = pairs.select(F.explode(F.array("x", "y")).alias("e")).select("e.*")
    there = _thinned(prefixes.select(*named), ["d", "line"], ends)
    held = _thinned(_word_lines(lines), ["d", "line"], ends).select("d", "line", "text", *_line_key()).join(there, named, "left_semi")
    keyed = write_table(held.select(F.struct("d", "line").alias("key"), line_words().alias("v")), "line-words")      # both sides read it
    a, b = F.col("a"), F.col("b")
    return pairs.select("x", "y").join(keyed.select(F.col("key").alias("x"), F.col("v").alias("a")), "x").join(
        keyed.select(F.col("key").alias("y"), F.col("v").alias("b")), "y").where(
        _similar(a, b, F.size(F.array_intersect(a, b)))).select("x", "y")


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(d, line, exact)`` for every line with an earlier line of the needed similarity; ``exact`` if that one is equal."""
    spark, path = docs.sparkSession, table_path(docs.sparkSession, "lines")
    lines = document_lines(docs, id_col, text_col)
    classes = write_table(line_classes(lines), "lines", path=path)
    prefixes = write_table(line_prefixes(classes, rarity_table(classes)), "line-prefixes")
    drop_path(spark, path)                      # the tokens are not needed any more
    index = prefix_index(prefixes)
    pairs = write_table(first_candidates(index), "line-pairs")
    nearest = write_table(pairs.groupBy("x").agg(F.min(F.struct("far", "y")).alias("best")).select("x", "best.y"), "line-pairs")
    found = write_table(verified(nearest, prefixes, lines).select("x"), "line-matches")
    rest = write_table(pairs.join(found, "x", "left_anti").join(nearest, ["x", "y"], "left_anti"), "line-pairs")
    if not rest.isEmpty():
        found = write_table(found.union(verified(rest, prefixes, lines).select("x").distinct()), "line-matches")
    open_ = write_table(pairs.where("by_first").select("x").distinct().join(found, "x", "left_anti").select("x.d", "x.line"), "line-open")
    if not open_.isEmpty():
        left = write_table(_thinned(index, ["d", "line"], open_).join(open_, ["d", "line"], "left_semi").select(*index.columns), "line-open")
        again = _counted(_pairs(_thinned(index, ["token"], left), left)).where(enough_shared()).select("x", "y")
        again = write_table(again.join(pairs.select("x", "y"), ["x", "y"], "left_anti"), "line-pairs")
        if not again.isEmpty():
            found = found.union(verified(again, prefixes, lines).select("x").distinct())
    firsts = prefixes.where("copies > 1").select("h", "g", F.col("d").alias("first_d"), F.col("line").alias("first_line"))
    copies = _word_lines(lines).select("d", "line", *_line_key()).join(firsts, ["h", "g"]).where(
        "d <> first_d or line <> first_line").select("d", "line", F.lit(True).alias("exact"))
    return copies.union(found.select("x.d", "x.line", F.lit(False)))


def _flags(gone: Column) -> Column:
    """For the sorted numbers 2, 5: false, false, true, false, false, true."""
    steps = F.transform(gone, lambda x, i: F.concat(
        F.array_repeat(F.lit(False), x - F.coalesce(F.get(gone, i - 1), F.lit(-1)) - 1), F.array(F.lit(True))))
    return F.flatten(steps)


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without their removed lines; all columns stay, texts of other documents are untouched."""
    before, key = F.col(f"row.`{text_col}`"), F.col(f"row.`{id_col}`")
    ids = docs.select(F.col(f"`{id_col}`").alias("d")).where("d is not null")
    if ids.groupBy("d").count().where("count > 1").limit(1).count():     # ids don't name the rows: the text does besides
        key = F.when(key.isNotNull(), F.struct(key.alias("id"), F.xxhash64(before).alias("h")))
    keyed = packed(docs).select(key.alias("key"), before.alias("text"))
    gone = removed_lines(keyed, "key", "text").groupBy("d").agg(F.collect_set("line").alias("_gone"))    # at most a document's lines
    joined = packed(docs).join(gone, key == F.col("d"), "left")
    # one flag for each line up to the last removed one, so that a line is looked up by its number
    flags = let(F.sort_array("_gone"), _flags)
    kept = let(flags, lambda f: F.array_join(F.filter(F.split(before, "\n"), lambda _, i: ~F.coalesce(F.get(f, i), F.lit(False))), "\n"))
    return unpacked(joined, docs.columns, **{text_col: F.when(F.col("_gone").isNull(), before).otherwise(kept)})


def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each removed line."""
    return removed_lines(table(spark, sf_dir, "documents")).select(F.col("d").alias("doc_id"), F.col("line").cast("long").alias("line"), "exact")


#: Lines by brute force over token sets: every pair of different lines that share a token of the exactly ordered prefix.
LINES_SQL = r"""
with l as (
  select doc_id, unnest(string_split(text, chr(10))) as line_text, unnest(range(len(string_split(text, chr(10))))) as line from documents
  where doc_id is not null and text is not null),
w as (
  select doc_id, line, line_text, list_distinct(list_filter(regexp_split_to_array(line_text, '[\x20\x09-\x0D]+'), lambda x: x <> '')) as toks from l),
k as (select *, row_number() over (partition by line_text order by doc_id, line) as nth from w where len(toks) > 0),
u as (select doc_id, line, toks, len(toks) as n, row_number() over () as id from k where nth = 1),
t as (select id, n, doc_id, line, unnest(toks) as tok from u),
df as (select tok, count(*) as c from t group by tok),
o as (select t.*, row_number() over (partition by id order by c, t.tok) as pos from t join df using (tok)),
p as (select * from o where pos <= n - cast(ceil(n * 4 / 5.0) as bigint) + 1),
c as (
  select distinct a.id as x, b.id as y from p a join p b on a.tok = b.tok and (b.doc_id, b.line) < (a.doc_id, a.line)
    and 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)),
m as (
  select distinct x from c join u a on a.id = c.x join u b on b.id = c.y
  where 5 * len(list_intersect(a.toks, b.toks)) >= 4 * (a.n + b.n - len(list_intersect(a.toks, b.toks))))
select doc_id, cast(line as bigint) as line, true as exact from k where nth > 1
union all
select doc_id, cast(line as bigint), false from u join m on m.x = u.id
"""
