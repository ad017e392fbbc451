"""Secret scans with a trigram inverted index.

From each rule's regular expression a Boolean query over trigrams is derived: literal stretches
must be there (AND), alternatives may be (OR). The index has postings (trigram, doc_id) for the
trigrams that the queries ask for, in lower case; the postings are intersected and united per
document, and only candidates are verified with the expression itself. Rules without a mandatory
trigram scan every text.

Only DataFrame functions run on the main path. Positions come from cutting the text at a rule's
matches: the pieces between and the matches add up to the text. Documents are found again by
``doc_id`` (null ids match each other); rows that share an id share their candidates, which only
means more texts to verify, and are scanned each on its own. Null and empty texts have no secrets.
"""

from __future__ import annotations

import re
import re._parser as sre
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.common import table
from vigil.session import write_table


@dataclass(frozen=True)
class Rule:
    """``pattern`` is leftmost and non-overlapping; a match is dropped if group ``group`` is shorter than ``least``."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0


#: Fixed by the contract.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]+", 24),
)
#: Fixed forms of public services' keys.
MORE = (
    Rule("github", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE + MORE
MOST_STRINGS = 64           # alternatives that are followed before a stretch is closed

#: A trigram query: None (any text), a trigram, or ("and" | "or", frozenset of queries).
Query = None | str | tuple


def _join(op: str, parts: list[Query]) -> Query:
    if op == "and":
        parts = [p for p in parts if p is not None]
    elif any(p is None for p in parts):
        return None
    found = frozenset(parts)
    if not found:
        return None
    return next(iter(found)) if len(found) == 1 else (op, found)


def _of_strings(strings: set[str]) -> Query:
    """What a text must hold if it holds one of the strings."""
    return _join("or", [_join("and", [s[i:i + 3] for i in range(len(s) - 2)]) for s in strings])


def trigram_query(pattern: str) -> Query:
    """The Boolean trigram query of a regular expression, in lower case; None if no trigram is mandatory."""
    def walk(items) -> tuple[set[str] | None, Query]:
        """All strings that the items can match (None: too many or unknown), and what they demand besides."""
        open_: set[str] = {""}
        demands: list[Query] = []
        whole = True
        for op, arg in items:
            name = str(op)
            if name == "LITERAL":
                strings, demand = {chr(arg).lower()}, None
            elif name == "SUBPATTERN":
                strings, demand = walk(arg[-1])
            elif name == "BRANCH":
                each = [walk(b) for b in arg[1]]
                strings = set().union(*(s for s, _ in each)) if all(s is not None for s, _ in each) else None
                demand = None if strings is not None else _join("or", [_join("and", [_of_strings(s) if s is not None else None, d]) for s, d in each])
            elif name == "IN" and all(str(o) == "LITERAL" for o, _ in arg):
                strings, demand = {chr(a).lower() for _, a in arg}, None
            elif name in ("MAX_REPEAT", "MIN_REPEAT"):
                low, high, inner = arg
                strings, demand = walk(inner)
                if (low, high) == (0, 1) and strings is not None:
                    strings = strings | {""}
                elif low == high == 1:
                    pass
                else:
                    demand = _join("and", [_of_strings(strings) if strings is not None else None, demand]) if low else None
                    strings = None
            else:
                strings, demand = None, None
            demands.append(demand)
            if strings is not None and len(open_) * len(strings) <= MOST_STRINGS:
                open_ = {a + b for a in open_ for b in strings}
                continue
            demands.append(_of_strings(open_))
            open_ = strings if strings is not None else {""}
            whole = False
        if whole and not any(d is not None for d in demands):
            return open_, None
        return None, _join("and", [*demands, _of_strings(open_)])

    strings, demand = walk(sre.parse(pattern))
    return _of_strings(strings) if strings is not None else demand


def trigrams_of(query: Query) -> set[str]:
    if query is None or isinstance(query, str):
        return {query} - {None}
    return set().union(*(trigrams_of(q) for q in query[1]))


def _holds(query: Query, has: dict[str, Column]) -> Column:
    """The query over a document's flags, one for each trigram."""
    if query is None:
        return F.lit(True)
    if isinstance(query, str):
        return has[query]
    parts = [_holds(q, has) for q in sorted(query[1], key=str)]
    return reduce((lambda a, b: a & b) if query[0] == "and" else (lambda a, b: a | b), parts)


def postings(docs: DataFrame, trigrams: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The inverted index: ``(trigram, id_col)`` for every asked trigram in the lower-case text (its number in the list)."""
    low = docs.select(id_col, F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("_low"))
    found = F.filter(F.array(*(F.when(F.contains("_low", F.lit(t)), F.lit(i)) for i, t in enumerate(trigrams))), lambda x: x.isNotNull())
    return low.select(F.explode(found).alias("trigram"), id_col)


def candidates(index: DataFrame, trigrams: list[str], queries: dict[str, Query], id_col: str = "doc_id") -> DataFrame:
    """``id_col`` and one flag for each rule: the postings' lists intersected and united as its query says. Documents
    without a flag have no row."""
    bits = index.groupBy(id_col).agg(F.bit_or(F.shiftleft(F.lit(1).cast("long"), F.col("trigram"))).alias("_bits")) if len(trigrams) <= 63 else None
    if bits is not None:
        has = {t: F.col("_bits").bitwiseAND(F.lit(1 << i)) != 0 for i, t in enumerate(trigrams)}
    else:
        bits = index.groupBy(id_col).agg(F.collect_set("trigram").alias("_set"))       # at most one number a trigram
        has = {t: F.array_contains("_set", i) for i, t in enumerate(trigrams)}
    flags = bits.select(id_col, *(_holds(q, has).alias(k) for k, q in queries.items()))
    return flags.where(reduce(lambda a, b: a | b, (F.col(k) for k in queries)))


def rule_spans(text: Column, rule: Rule) -> Column:
    """Spans ``(start, kind, end)`` of one rule's matches, in code points."""
    matches = F.regexp_extract_all(text, F.lit(f"({rule.pattern})"), 1)
    measured = F.regexp_extract_all(text, F.lit(f"({rule.pattern})"), rule.group + 1 if rule.group else 1)
    between = F.transform(F.split(text, rule.pattern), F.length)
    place = RULES.index(rule) if rule in RULES else len(RULES)
    step = F.aggregate(
        F.arrays_zip(between.alias("b"), F.transform(matches, F.length).alias("m"), F.transform(measured, F.length).alias("g")),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,place:int,end:int,kind:string>>").alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + x["b"] + F.coalesce(x["m"], F.lit(0))).alias("at"),
            F.when(x["m"].isNotNull() & (x["g"] >= rule.least), F.concat(acc["out"], F.array(F.struct(
                (acc["at"] + x["b"]).alias("start"), F.lit(place).alias("place"),
                (acc["at"] + x["b"] + x["m"]).alias("end"), F.lit(rule.kind).alias("kind"))))).otherwise(acc["out"]).alias("out")))
    return step["out"]


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, spans)``: the spans of all rules in the order of start, then rule."""
    asked = {r.kind: q for r in rules if (q := trigram_query(r.pattern)) is not None}
    none = F.array().cast("array<struct<start:int,place:int,end:int,kind:string>>")
    trigrams = sorted(set().union(*(trigrams_of(q) for q in asked.values()))) if asked else []
    base = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    if asked:
        index = write_table(postings(docs.select(id_col, text_col), trigrams, id_col, text_col), "postings")
        flags = candidates(index, trigrams, asked, id_col)
        base = base.join(flags, F.col("_id").eqNullSafe(flags[id_col]), "left")
    spans = [F.when(F.col(r.kind), rule_spans(F.col("_text"), r)).otherwise(none) if r.kind in asked else rule_spans(F.col("_text"), r) for r in rules]
    return base.select(F.col("_id").alias(id_col), F.array_sort(F.concat(*spans)).alias("spans"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))

    def of_kind(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select("doc_id", *(of_kind(r.kind) for r in BASE), F.sha2(listed(F.filter("spans", lambda s: s["place"] < len(BASE))).cast("binary"), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"))


def _kind_sql(place: int, rule: Rule) -> str:
    """Spans of one rule, by the pieces between its matches as well."""
    spelled = re.sub(r"\(\?i:(\(.*?\))\)", lambda m: re.sub("[a-z]", lambda c: f"[{c[0]}{c[0].upper()}]", m[1]), rule.pattern)
    pattern = spelled.replace("'", "''")          # DuckDB's (?i) would take more than the two cases of ASCII
    return f"""select d.row, {place} as place, '{rule.kind}' as kind,
      cast(list_sum(list_transform(pieces[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) as bigint) as start_,
      length(m[i]) as n
    from (select *, unnest(range(1, len(m) + 1)) as i from (
      select row, regexp_extract_all(text, '{pattern}', 0) as m, regexp_extract_all(text, '{pattern}', {rule.group}) as g,
        string_split_regex(text, '{pattern}') as pieces from d) where len(m) > 0) d
    where length(g[i]) >= {rule.least}"""


SECRETS_SQL = f"""
with d as (select row_number() over () as row, doc_id, coalesce(text, '') as text from documents),
s as ({" union all ".join(_kind_sql(i, r) for i, r in enumerate(RULES))}),
a as (
  select row, {", ".join(f"count(*) filter (kind = '{r.kind}') as n_{r.kind}" for r in BASE)},
    coalesce(string_agg(kind || ':' || start_ || ':' || (start_ + n), ',' order by start_, place) filter (place < {len(BASE)}), '') as base,
    string_agg(kind || ':' || start_ || ':' || (start_ + n), ',' order by start_, place) as spans
  from s group by row)
select doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) as n_{r.kind}" for r in BASE)}, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from d left join a using (row)
"""
