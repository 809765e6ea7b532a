"""Preference formatting: chosen and rejected conversations to a shared prompt and two masked completions.

For each pair the longest common prefix of turns (equal role and text) is rendered once as the
prompt; what follows is rendered as the chosen and the rejected completion. A completion's loss
spans are the character ranges of its assistant turns, end mark included; all else in it and the whole prompt
is masked.

DataFrame functions only; one shuffle, by pair. A row holds one pair, as the output does.

Turns are put in order by turn, then role, then text (nulls first). A null role renders as ``unknown``,
a null text as empty; null equals null in the prefix. A pair with equal sides has empty completions and is
not usable. A pair that lacks a side has an empty one. Rows with a null pair id form one pair. An empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def _render(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), _role(turn), F.lit("\n"), F.coalesce(turn["text"], F.lit("")), F.lit(CLOSE))


def _role(turn: Column) -> Column:
    return F.coalesce(turn["role"], F.lit("unknown"))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _render), "")


def _spans(turns: Column) -> Column:
    """``[start, end)`` of every assistant turn's text and end mark in the rendered turns."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def add(done: Column, turn: Column) -> Column:
        end = done["at"] + F.length(_render(turn))
        body = done["at"] + F.length(_role(turn)) + len(OPEN) + 1
        span = F.array(F.struct(body.alias("start"), end.alias("end")))
        return F.struct(
            end.alias("at"),
            F.when(turn["role"] == "assistant", F.concat(done["spans"], span)).otherwise(done["spans"]).alias("spans"),
        )

    return F.aggregate(turns, start, add, lambda done: done["spans"])


def format_pairs(chosen: DataFrame, rejected: DataFrame, pair: str = "conv_id") -> DataFrame:
    """One row per pair: pair id, prompt_turns, prompt, chosen, rejected, chosen_spans, rejected_spans, usable.

    Both inputs hold ``(pair, turn, role, text)`` rows, one per turn.
    """
    side = lambda df, name: df.select(F.col(pair), F.lit(name).alias("side"), F.struct("turn", "role", "text").alias("t"))
    turns = lambda name: F.sort_array(F.collect_list(F.when(F.col("side") == name, F.col("t"))))
    both = side(chosen, "c").unionByName(side(rejected, "r")).groupBy(pair).agg(turns("c").alias("c"), turns("r").alias("r"))
    same = F.zip_with(
        "c",
        "r",
        lambda x, y: x.isNotNull() & y.isNotNull() & x["role"].eqNullSafe(y["role"]) & x["text"].eqNullSafe(y["text"]),
    )
    first = F.array_position(same, False).cast("int")
    shared = F.when(first > 0, first - 1).otherwise(F.size(same))
    cut = both.withColumn("k", shared)
    rest = lambda c: F.slice(c, F.col("k") + 1, F.greatest(F.lit(0), F.size(c) - F.col("k")))
    cut = cut.select(pair, "k", F.slice("c", F.lit(1), F.col("k")).alias("p"), rest("c").alias("c"), rest("r").alias("r"))
    return cut.select(
        pair,
        F.col("k").alias("prompt_turns"),
        _rendered(F.col("p")).alias("prompt"),
        _rendered(F.col("c")).alias("chosen"),
        _rendered(F.col("r")).alias("rejected"),
        _spans(F.col("c")).alias("chosen_spans"),
        _spans(F.col("r")).alias("rejected_spans"),
        (F.size(_spans(F.col("c"))) > 0).alias("usable"),
    )


def worse_answers(turns: DataFrame) -> DataFrame:
    """A rejected side for whole conversations: the last assistant turn says again what the first one
    said, or nothing if it is the only one. Conversations without an assistant turn stay as they are."""
    spoken = turns.where("role = 'assistant'")
    ends = spoken.groupBy("conv_id").agg(F.max("turn").alias("last"), F.min(F.struct("turn", "text")).alias("first"))
    last = (F.col("role") == "assistant") & (F.col("turn") == F.col("last"))
    text = F.when(F.col("first")["turn"] < F.col("last"), F.col("first")["text"]).otherwise(F.lit(""))
    return turns.join(ends, "conv_id", "left").select("conv_id", "turn", "role", F.when(last, text).otherwise(F.col("text")).alias("text"))


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws("-", s["start"], s["end"])), ",")


SQL = r"""
with ends as (
  select conv_id, max(turn) as last, min(turn) as first, min_by(text, turn) as first_text
  from conversations where role = 'assistant' group by conv_id),
t as (
  select c.conv_id, c.turn, c.role, c.text as chosen,
    case when c.role = 'assistant' and c.turn = e.last then case when e.first < e.last then e.first_text else '' end else c.text end as rejected
  from conversations c left join ends e on e.conv_id = c.conv_id),
k as (
  select conv_id, count(*) as n, coalesce(min(case when chosen <> rejected then turn end), max(turn) + 1) as cut from t group by conv_id),
r as (
  select t.conv_id, turn, role, turn < cut as shared,
    '<|im_start|>' || role || chr(10) as head,
    '<|im_start|>' || role || chr(10) || chosen || '<|im_end|>' || chr(10) as c,
    '<|im_start|>' || role || chr(10) || rejected || '<|im_end|>' || chr(10) as r
  from t join k on k.conv_id = t.conv_id),
o as (
  select *, coalesce(sum(length(c)) filter (where not shared) over w, 0) as c_at, coalesce(sum(length(r)) filter (where not shared) over w, 0) as r_at
  from r window w as (partition by conv_id order by turn rows between unbounded preceding and 1 preceding))
select conv_id, cast(count(*) filter (where shared) as integer) as prompt_turns,
  coalesce(string_agg(c, '' order by turn) filter (where shared), '') as prompt,
  coalesce(string_agg(c, '' order by turn) filter (where not shared), '') as chosen,
  coalesce(string_agg(r, '' order by turn) filter (where not shared), '') as rejected,
  coalesce(string_agg((c_at + length(head)) || '-' || (c_at + length(c)), ',' order by turn) filter (where not shared and role = 'assistant'), '') as chosen_spans,
  coalesce(string_agg((r_at + length(head)) || '-' || (r_at + length(r)), ',' order by turn) filter (where not shared and role = 'assistant'), '') as rejected_spans,
  count(*) filter (where not shared and role = 'assistant') > 0 as usable
from o group by conv_id
"""
