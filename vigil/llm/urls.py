"""URL filter: host rules first, else naive Bayes over the words of host and path.

Host and path are cut by position: the host stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, the path
after it up to ``?``, ``#`` or the end. A rule fits its host and all subdomains if the path starts with the rule's; the
longest (host and path together, then the host) wins. A path without a character starts with no rule's ``/``.

URLs without a rule are scored. Host names are written without spaces, so the letters between dots, hyphens and digits
are split into words by the unigram model's most probable way (Viterbi). The model counts words where they stand apart:
in the text of the pages, in paths and in hyphenated names. A word that was never seen has the probability that one
occurrence would have, and a tenth of it for each further letter. Runs of more than ``NAME`` letters, which no host
label can hold, are one word. Host words and path words (runs of letters or of digits, digits as ``0``) are the tokens of
a multinomial naive Bayes model, trained on all URLs that a rule decides: the rules' verdicts are its labels. Tokens that
no such URL has take no part. A positive score blocks.

Costs and weights are whole micro-units of the natural logarithm, so sums are exact and ties are real ties: of equally
probable splits the one with the longest last word, then the longest before it, and so on, is taken; a score of zero allows.

Work is done per different name, host and path; the counts are joined, never collected. Keys that hold more than one row
in ``SHARE`` (fewer than ``SHARE`` keys can) are spread over ``SPREAD`` parts of a join.

URLs that are null or have no ``://`` have an empty host and path, and no tokens: the classes' sizes decide. Null texts have no words. Without rules'
labels everything is allowed. Repeated rows and ids are judged each; null ids stay. Extra columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.common import ship, table
from vigil.session import write_table

NAME = 63                   # letters of a host label, at most
UNIT = 1_000_000            # parts of a natural logarithm's unit
SHARE, SPREAD = 1024, 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUNS = r"(\p{L}+|\p{N}+)"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: Fixed by the contract.
RULES = [Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
         Rule("block", "net", "/es/"), Rule("block", "net", "/fr/")]


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct of ``rule`` and ``verdict`` of the longest rule that fits; null if none does."""
    out = [F.when(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
                  F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict")))
           for r in sorted(rules, key=lambda r: (len(r.text), len(r.host)), reverse=True)]
    return F.coalesce(*out, F.lit(None).cast("struct<rule:string,verdict:string>"))


def runs(text: Column) -> Column:
    """Runs of letters, and ``0`` for each run of digits."""
    return F.transform(F.regexp_extract_all(text, F.lit(RUNS), F.lit(0)), lambda x: F.when(x.rlike(r"^\p{N}"), F.lit("0")).otherwise(x))


def micro(number: Column) -> Column:
    return F.round(number * UNIT).cast("long")


def spread_join(rows: DataFrame, by_key: DataFrame, key: str, salt: Column, how: str = "left") -> DataFrame:
    """``rows`` joined with ``by_key``, which has one row for each key. Keys that hold more than one in ``SHARE`` of the
    rows are dealt over ``SPREAD`` parts by ``salt``, a hash that tells rows apart."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    heavy = [r[0] for r in counts.where(F.col("n") * SHARE > total).select(key).collect()]      # fewer than SHARE keys
    if not heavy:
        return rows.join(by_key, key, how)
    is_heavy = F.col(key).isin(heavy)
    part = F.when(is_heavy, F.pmod(salt, F.lit(SPREAD))).otherwise(F.lit(0)).cast("int").alias("_part")
    parts = F.when(is_heavy, F.sequence(F.lit(0), F.lit(SPREAD - 1))).otherwise(F.array(F.lit(0)))
    return rows.select("*", part).join(by_key.select("*", F.explode(parts).alias("_part")), [key, "_part"], how).drop("_part")


def word_counts(pages: DataFrame, urls: DataFrame) -> DataFrame:
    """``(word, n)`` of the words that stand apart: in the texts of ``pages`` (lower case, marks left out), in paths, and in
    hyphenated host labels."""
    def counted(words: Column, source: DataFrame) -> DataFrame:
        return source.select(F.explode(words).alias("word")).where("word <> ''").groupBy("word").agg(F.count(F.lit(1)).alias("n"))

    text = F.lower(F.regexp_replace("html", "<[^>]*>", " "))
    hyphenated = F.flatten(F.transform(F.filter(F.split("host", r"\."), lambda x: x.contains("-")), lambda x: F.split(x, r"[^\p{L}]+")))
    return counted(F.split(text, r"[^\p{L}]+"), pages).unionByName(
        counted(F.concat(F.split(F.lower("path"), r"[^\p{L}]+"), hyphenated), urls)).groupBy("word").agg(F.sum("n").alias("n"))


def viterbi(name: str, known: dict[tuple[int, int], int], total: int) -> list[str]:
    """The cheapest split of a name; ``known`` has the counts of its parts (start, end) that are words."""
    all_ = math.log(max(total, 1))
    best: list[tuple[int, int]] = [(0, 0)]
    for end in range(1, len(name) + 1):
        best.append(min((best[start][0] + (round(UNIT * (all_ - math.log(n))) if (n := known.get((start, end)))
                                           else round(UNIT * (all_ + (end - start - 1) * math.log(10)))), start) for start in range(end)))
    out, end = [], len(name)
    while end:
        out.append(name[best[end][1]:end])
        end = best[end][1]
    return out[::-1]


def segments(names: DataFrame, words: DataFrame) -> DataFrame:
    """``(name, words)``: every different name (a run of letters) of column ``name`` in its words."""
    spark = names.sparkSession
    total = words.agg(F.sum("n")).first()[0] or 0
    names = names.select("name").distinct()
    long = F.length("name") > NAME
    short = names.where(~long)
    parts = short.select("name", F.explode(F.sequence(F.lit(0), F.length("name") - 1)).alias("start")).select(
        "name", "start", F.explode(F.sequence(F.col("start") + 1, F.length("name"))).alias("end"))
    parts = parts.select("name", "start", "end", F.substring("name", F.col("start") + 1, F.col("end") - F.col("start")).alias("word"))
    # a short part ("s", "th") stands in very many names
    found = spread_join(parts, words, "word", F.xxhash64("name", "start"), "inner").groupBy("name").agg(
        F.collect_list(F.struct("start", "end", "n")).alias("known"))       # NAME * (NAME + 1) / 2 parts at most
    ship(spark)

    @F.pandas_udf("array<string>")
    def split(name: pd.Series, known: pd.Series) -> pd.Series:
        return pd.Series([viterbi(x, {(k["start"], k["end"]): k["n"] for k in (ks if ks is not None else ())}, total)
                          for x, ks in zip(name, known, strict=True)], dtype=object)

    return short.join(found, "name", "left").select("name", split("name", "known").alias("words")).unionByName(
        names.where(long).select("name", F.array("name").alias("words")))


def token_weights(host_tokens: DataFrame, path_tokens: DataFrame) -> DataFrame:
    """``(token, weight)``: logarithm of a token's share among the tokens of blocked URLs over that among allowed ones (one
    added to each), for all tokens of URLs with a label."""
    counts = host_tokens.unionByName(path_tokens).groupBy("token").agg(
        F.sum("blocked").alias("blocked"), F.sum("allowed").alias("allowed")).where("blocked + allowed > 0")
    sums = counts.agg(F.sum("blocked"), F.sum("allowed"), F.count(F.lit(1))).first()
    blocked, allowed, different = (x or 0 for x in sums)
    scale = math.log(max(allowed + different, 1)) - math.log(max(blocked + different, 1))
    return counts.select("token", micro(F.log(F.col("blocked") + 1) - F.log(F.col("allowed") + 1) + F.lit(scale)).alias("weight"))


def judge(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url", text_col: str = "html") -> DataFrame:
    """``(id_col, host, path, rule, verdict, score)`` of every row; score is null where a rule decides."""
    url = F.col(f"`{url_col}`")
    split = pages.select(F.col(f"`{id_col}`").alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    urls = split.withColumn("found", rule_of(F.col("host"), F.col("path"), rules)).withColumn("key", F.array_join(runs(F.lower("path")), " "))
    texts = pages.select(F.col(f"`{text_col}`").alias("html"))

    classes = [F.count_if(F.col("found.verdict") == "block").alias("blocked"), F.count_if(F.col("found.verdict") == "allow").alias("allowed"),
               F.count_if(F.col("found").isNull()).alias("open")]
    hosts = write_table(urls.groupBy("host").agg(*classes), "url-hosts")
    paths = write_table(urls.groupBy("key").agg(*classes), "url-paths")
    words = write_table(word_counts(texts, split), "url-words")

    pieces = hosts.select("host", "blocked", "allowed", "open", F.posexplode(runs(F.col("host"))).alias("k", "name"))
    split_names = segments(pieces.where("name <> '0'"), words)
    # digits, and nothing else, are words already
    host_tokens = write_table(
        spread_join(pieces.where("name <> '0'"), split_names, "name", F.xxhash64("host", "k"), "inner").select(
            "host", "blocked", "allowed", "open", F.explode("words").alias("token")).unionByName(
            pieces.where("name = '0'").select("host", "blocked", "allowed", "open", F.col("name").alias("token"))).select(
            "host", "blocked", "allowed", "open", F.concat(F.lit("."), "token").alias("token")), "url-tokens")
    path_tokens = paths.where("key <> ''").select(
        "key", "blocked", "allowed", "open", F.posexplode(F.split("key", " ")).alias("k", "token")).withColumn("token", F.concat(F.lit("/"), "token"))
    labels = ("token", "blocked", "allowed")
    weights = write_table(token_weights(host_tokens.select(*labels), path_tokens.select(*labels)), "url-weights")

    by_host = spread_join(host_tokens.where("open > 0").select("host", "token"), weights, "token", F.xxhash64("host"), "inner").groupBy(
        "host").agg(F.sum("weight").alias("host_score"))
    by_path = spread_join(path_tokens.where("open > 0").select("key", "k", "token"), weights, "token", F.xxhash64("key", "k"), "inner").groupBy(
        "key").agg(F.sum("weight").alias("path_score"))
    blocked, allowed = (x or 0 for x in hosts.agg(F.sum("blocked"), F.sum("allowed")).first())
    prior = round(UNIT * (math.log(blocked + 1) - math.log(allowed + 1)))
    row = F.monotonically_increasing_id()       # rows come straight from the scan: the same number in a repeated task
    open_ = urls.where("found is null").select("id", "host", "path", "key", F.xxhash64(row).alias("row"))
    scored = spread_join(spread_join(open_, by_host, "host", F.col("row")), by_path, "key", F.col("row")).withColumn(
        "score", F.lit(prior).cast("long") + F.coalesce("host_score", F.lit(0)) + F.coalesce("path_score", F.lit(0)))
    known = F.lit(bool(blocked + allowed))
    return urls.where("found is not null").select(
        F.col("id").alias(id_col), "host", "path", "found.rule", "found.verdict", F.lit(None).cast("long").alias("score")).unionByName(
        scored.select(F.col("id").alias(id_col), "host", "path", F.lit(None).cast("string").alias("rule"),
                      F.when(known & (F.col("score") > 0), F.lit("block")).otherwise(F.lit("allow")).alias("verdict"), "score"))


def op11_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's URL."""
    return judge(table(spark, sf_dir, "pages"), RULES).drop("score")


#: The same in SQL: the splits are found end by end, with the cheapest costs up to each end in a list.
URLS_SQL = r"""
with recursive u as (
  select page_id, html, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path from pages),
r as (
  select *, case
    when (host = 'www.example.com' or ends_with(host, '.www.example.com')) and starts_with(path, '/en/') then 'www.example.com/en/'
    when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/en/') then 'example.com/en/'
    when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/es/') then 'net/es/'
    when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/fr/') then 'net/fr/'
    when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/') then 'com/' end as rule from u),
v as (select *, case when rule in ('www.example.com/en/', 'com/') then 'allow' when rule is not null then 'block' end as label, row_number() over () as id from r),
w as (
  select word, count(*) as n from (
    select unnest(regexp_split_to_array(lower(regexp_replace(html, '<[^>]*>', ' ', 'g')), '[^\p{L}]+')) as word from v
    union all select unnest(regexp_split_to_array(lower(path), '[^\p{L}]+')) from v
    union all select unnest(regexp_split_to_array(part, '[^\p{L}]+')) from (select unnest(string_split(host, '.')) as part from v) where contains(part, '-'))
  where word <> '' group by word),
total as (select ln(greatest(sum(n), 1)) as ln_all from w),
hosts as (
  select host, count(*) filter (label = 'block') as blocked, count(*) filter (label = 'allow') as allowed from v group by host),
names as (
  select host, blocked, allowed, case when regexp_matches(x, '^\p{N}') then '0' else x end as name
  from (select *, unnest(regexp_extract_all(host, '\p{L}+|\p{N}+')) as x from hosts)),
short as (select distinct name from names where name <> '0' and length(name) <= 63),
starts as (select name, unnest(range(length(name))) as a from short),
parts as (select name, a, unnest(range(a + 1, length(name) + 1)) as z from starts),
costs as (
  select p.name, a, z, coalesce(cast(round(1000000 * (ln_all - ln(n))) as bigint), cast(round(1000000 * (ln_all + (z - a - 1) * ln(10))) as bigint)) as cost
  from parts p left join w on w.word = substring(p.name, cast(a as int) + 1, cast(z - a as int)), total),
grown as (
  select name, 0::bigint as z, [0::bigint] as best, [0::bigint] as cut from short
  union all
  select name, z, list_append(best, least_[1]), list_append(cut, least_[2]) from (
    select g.name, c.z, any_value(g.best) as best, any_value(g.cut) as cut, min([g.best[c.a + 1] + c.cost, c.a]) as least_
    from grown g join costs c on c.name = g.name and c.z = g.z + 1 group by g.name, c.z)),
walk as (
  select name, z, cut[z + 1] as a, cut from grown where z = length(name)
  union all
  select name, a, cut[a + 1], cut from walk where a > 0),
words as (select name, substring(name, cast(a as int) + 1, cast(z - a as int)) as word from walk
  union all select distinct name, name from names where name = '0' or length(name) > 63),
host_tokens as (select host, blocked, allowed, '.' || word as token from names join words using (name)),
path_tokens as (
  select id, label, '/' || case when regexp_matches(x, '^\p{N}') then '0' else x end as token
  from (select id, label, unnest(regexp_extract_all(lower(path), '\p{L}+|\p{N}+')) as x from v)),
counted as (
  select token, sum(blocked) as blocked, sum(allowed) as allowed from (
    select token, blocked, allowed from host_tokens
    union all select token, case when label = 'block' then 1 else 0 end, case when label = 'allow' then 1 else 0 end from path_tokens)
  group by token having sum(blocked) + sum(allowed) > 0),
sums as (select ln(greatest(sum(allowed) + count(*), 1)) - ln(greatest(sum(blocked) + count(*), 1)) as scale from counted),
weights as (select token, cast(round(1000000 * (ln(blocked + 1) - ln(allowed + 1) + scale)) as bigint) as weight from counted, sums),
host_score as (select host, sum(weight) as s from host_tokens join weights using (token) group by host),
path_score as (select id, sum(weight) as s from path_tokens join weights using (token) group by id),
classes as (select count(label) as labels, cast(round(1000000 * (ln(count(*) filter (label = 'block') + 1) - ln(count(*) filter (label = 'allow') + 1))) as bigint) as prior from v)
select page_id, v.host, path, rule, case when label is not null then label
    when labels > 0 and prior + coalesce(h.s, 0) + coalesce(p.s, 0) > 0 then 'block' else 'allow' end as verdict
from v left join host_score h on h.host = v.host left join path_score p on p.id = v.id, classes
"""
