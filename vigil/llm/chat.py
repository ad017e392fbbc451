"""Chat formatting by incremental black-box rendering.

A template is any function from a list of ``(role, text)`` turns to a string; nothing is
known about its inside. The successive prefixes of a conversation are rendered, and each
output is compared with the one before: if it starts with it, the rest is the span of the
new turn; if it doesn't, the template rewrites history (drops old reasoning, moves a system
prompt) and the conversation is flagged, without spans. Inside a span the text is located by
two probes: the same prefix with the texts "0" and "1" in the last turn gives outputs that
differ in that one character only, so what stands before and after it is the turn's frame.

Rows are formatted by conversation in the order of ``turn`` (nulls first; equal turns by role,
then text, so repeated rows are kept and the order is fixed). Null roles and texts are empty;
rows with a null conversation id are one conversation. A conversation's rows are streamed to
one task, one conversation at a time in memory; any number of conversations share a task.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.common import ship, table

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

#: Opening and closing strings of the roles that the instruct template knows.
FRAMES = {"system": ("<s>[SYS] ", " [/SYS]"), "user": ("<s>[INST] ", " [/INST]"), "assistant": (" ", " </s>")}
OTHER = ("<s>[ROLE] ", " [AS] ", " [/ROLE]")
CONTROLS = ["<s>", "</s>", "[SYS]", "[/SYS]", "[INST]", "[/INST]", "[ROLE]", "[AS]", "[/ROLE]"]
_CONTROL_HEAD = re.compile("|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROLS) + r"|\\")


def escape(text: str) -> str:
    """A text without control strings: backslashes are doubled, and a control string gets one after its first character."""
    return _CONTROL_HEAD.sub(lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def instruct(turns: list[Turn]) -> str:
    """The default template: instruct marks around every turn, control strings inside texts escaped."""
    out = []
    for role, text in turns:
        if role in FRAMES:
            head, tail = FRAMES[role]
        else:
            head, tail = OTHER[0] + escape(role) + OTHER[1], OTHER[2]
        out.append(head + escape(text) + tail)
    return "".join(out)


def read_back(formatted: str) -> list[Turn]:
    """The turns of an output of ``instruct``."""
    turns, at = [], 0
    while at < len(formatted):
        role = next((r for r in ("system", "user") if formatted.startswith(FRAMES[r][0], at)), None)
        if role:
            at += len(FRAMES[role][0])
        elif formatted.startswith(OTHER[0], at):
            end = formatted.index(OTHER[1], at + len(OTHER[0]))
            role, at = unescape(formatted[at + len(OTHER[0]):end]), end + len(OTHER[1])
        else:
            role, at = "assistant", at + len(FRAMES["assistant"][0])
        close = FRAMES[role][1] if role in FRAMES else OTHER[2]
        end = formatted.index(close, at)
        turns.append((role, unescape(formatted[at:end])))
        at = end + len(close)
    return turns


def _common_prefix(a: str, b: str) -> int:
    if a == b:
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[:mid] == b[:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def locate(turns: list[Turn], template: Template) -> tuple[str, list[tuple[int, int, int, int]] | None]:
    """The output for all turns and, for each turn, where its span and its text start and end (code points);
    None for the spans if a prefix's output isn't the beginning of the next one or a text can't be located."""
    before, spans = template([]), []
    first = before
    for k, (role, _) in enumerate(turns):
        done = template(turns[:k + 1])
        if spans is not None and not done.startswith(before):
            spans = None                            # history was rewritten
        if spans is not None:
            zero, one = (template([*turns[:k], (role, probe)]) for probe in "01")
            head = _common_prefix(zero, one)
            tail = len(zero) - head - 1
            if zero[head:head + 1] == "0" and one[head:] == "1" + zero[head + 1:] and head >= len(before) and head + tail <= len(done):
                spans.append((len(before), len(done), head, len(done) - tail))
            else:
                spans = None                        # the text isn't shown once as it is
        before = done
        if spans is None:
            before = template(turns)
            break
    return (before if turns else first), spans


def format_conversations(df: DataFrame, template: Template = instruct, id_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text", learn: str = "assistant") -> DataFrame:
    """One row per conversation: id, ``formatted``, ``rewrites_history``, ``spans`` (role; start and end of the turn and
    of its text) and ``loss_spans`` (start and end of the texts of role ``learn``)."""
    ship(df.sparkSession)
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.col(turn_col).alias("turn"),
                     F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                     F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    dealt = rows.repartition("id").sortWithinPartitions(F.col("id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text")
    span = pa.struct([("role", pa.string()), *((n, pa.int64()) for n in ("start", "end", "text_start", "text_end"))])
    loss = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def batch_of(done: list, kind_of_id: pa.DataType) -> pa.RecordBatch:
        ids, outs, flags, spans, losses = (list(x) for x in zip(*done, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, kind_of_id), pa.array(outs, pa.string()), pa.array(flags, pa.bool_()),
             pa.array(spans, pa.list_(span)), pa.array(losses, pa.list_(loss))],
            names=[id_col, "formatted", "rewrites_history", "spans", "loss_spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen_type: list[pa.DataType] = []

        def stream():
            for b in batches:
                seen_type[:] = [b.schema.field("id").type]
                yield from zip(*(b.column(c).to_pylist() for c in ("id", "role", "text")), strict=True)

        done, size = [], 0
        for key, group in itertools.groupby(stream(), key=lambda r: r[0]):
            turns = [(role, text) for _, role, text in group]
            out, spans = locate(turns, template)
            named = [dict(zip(("start", "end", "text_start", "text_end"), s, strict=True), role=r)
                     for (r, _), s in zip(turns, spans or [], strict=False)]
            done.append((key, out, spans is None, named,
                         [{"start": s["text_start"], "end": s["text_end"]} for s in named if s["role"] == learn]))
            size += len(out)
            if size > 4 << 20:
                yield batch_of(done, seen_type[0])
                done, size = [], 0
        if done:
            yield batch_of(done, seen_type[0])

    return dealt.mapInArrow(run, f"`{id_col}` {kind}, formatted string, rewrites_history boolean, "
                                 "spans array<struct<role:string,start:long,end:long,text_start:long,text_end:long>>, "
                                 "loss_spans array<struct<start:long,end:long>>")


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from the formatted conversations alone: turns, and the texts under the loss mask."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewrites_history"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text, spans in zip(b.column("formatted").to_pylist(), b.column("loss_spans").to_pylist(), strict=True):
                turns = read_back(text)
                loss = "".join(unescape(text[s["start"]:s["end"]]) for s in spans)
                out.append((len(turns), _digest("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), _digest(loss), len(text)))
            cols = list(zip(*out, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True)),
                                              b.column("rewrites_history")], names=names)

    return formatted.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                     "loss_sha256 string, formatted_chars long, rewrites_history boolean")


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and the fixed conversation -7, whose texts hold control strings."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], given.schema)
    return digests(format_conversations(given.unionByName(extra)))


#: The turns and their frames in SQL; what the template adds to a text are its frame and one backslash for each escape.
CHAT_SQL = r"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e as (
  select *, length(regexp_replace(replace(text, '\', '\\'), '([<\[])(s>|/s>|SYS\]|/SYS\]|INST\]|/INST\]|ROLE\]|AS\]|/ROLE\])', '\1\\\2', 'g'))
    + case role when 'system' then 16 when 'user' then 18 when 'assistant' then 6
      else 24 + length(regexp_replace(replace(role, '\', '\\'), '([<\[])(s>|/s>|SYS\]|/SYS\]|INST\]|/INST\]|ROLE\]|AS\]|/ROLE\])', '\1\\\2', 'g')) end as shown
  from t)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(shown) as bigint) as formatted_chars, false as rewrites_history
from e group by conv_id
"""
