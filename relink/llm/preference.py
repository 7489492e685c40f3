"""Preference formatting: paired completions after a shared prompt.

Each pair has a chosen and a rejected conversation. Their longest common prefix of turns (role and text, by position) is
rendered once as the prompt; what follows in each is rendered as its completion. A completion's mask is the list of
character ranges on which a model is trained: the texts of the assistant's turns with their end marks.

`turns` has pair_id, side (chosen or rejected), turn, role, text. A conversation is one record and becomes one string, so
its turns meet in one task; pairs are not multiplied by any grouping.

A mark that a text holds is not one of the template's: `<|` in a text is rendered as `< |`, and `|` in a role is left out.

Defined results: turns are ordered by turn (null first), role and text, repeated turns stay; a null role is rendered as
`unknown` and a null text as empty, and null equals null; turns without pair_id belong to no conversation and are left out;
a pair with one side only has the other's completion null and status `unpaired`, one whose sides are equal has empty
completions and status `equal`; other sides are left out; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: Fixed text of the template: mark of a turn's role, and of its end.
ROLE, END = "<|{}|>\\n", "<|end|>\\n"
TRAINED = "assistant"


def _side(side: str) -> str:
    return f"sort_array(collect_list(case when side = '{side}' then struct(turn, role, text) end))"


def _head(t: str) -> str:
    return f"concat('<|', replace(coalesce({t}.role, 'unknown'), '|', ''), '|>\\n')"


def _body(t: str) -> str:
    return f"concat(replace(coalesce({t}.text, ''), '<|', '< |'), '{END}')"


def _rendered(turns: str) -> str:
    return f"array_join(transform({turns}, t -> concat({_head('t')}, {_body('t')})), '')"


def _mask(turns: str) -> str:
    """Ranges [from, to) of what is trained: a running position over the turns."""
    step = (f"named_struct('at', a.at + length({_head('t')}) + length({_body('t')}), 'spans', "
            f"if(t.role = '{TRAINED}', array_append(a.spans, named_struct('from', a.at + length({_head('t')}), "
            f"'to', a.at + length({_head('t')}) + length({_body('t')}))), a.spans))")
    none = "named_struct('at', 0, 'spans', cast(array() as array<struct<from: int, to: int>>))"
    return f"aggregate({turns}, {none}, (a, t) -> {step}, a -> a.spans)"


def format_pairs(turns: DataFrame) -> DataFrame:
    """One row per pair: n_common, prompt, chosen, rejected, chosen_mask, rejected_mask, status."""
    both = turns.where("pair_id is not null and side in ('chosen', 'rejected')").groupBy("pair_id").agg(
        F.expr(_side("chosen")).alias("c"), F.expr(_side("rejected")).alias("r"))
    differ = "filter(sequence(1, least(size(c), size(r))), i -> not (element_at(c, i).role <=> element_at(r, i).role and element_at(c, i).text <=> element_at(r, i).text))"
    common = F.expr(f"if(size(c) = 0 or size(r) = 0, 0, coalesce(array_min({differ}) - 1, least(size(c), size(r))))")
    cut = both.withColumn("n_common", common.cast("int")).select(
        "pair_id", "n_common", F.expr("slice(c, 1, n_common)").alias("p"),
        F.expr("if(size(c) > 0, slice(c, n_common + 1, size(c)), null)").alias("c"),
        F.expr("if(size(r) > 0, slice(r, n_common + 1, size(r)), null)").alias("r"))
    return cut.selectExpr(
        "pair_id", "n_common", f"{_rendered('p')} as prompt", f"{_rendered('c')} as chosen", f"{_rendered('r')} as rejected",
        f"{_mask('c')} as chosen_mask", f"{_mask('r')} as rejected_mask",
        "case when c is null or r is null then 'unpaired' when size(c) = 0 and size(r) = 0 then 'equal' else 'pair' end as status")


def swapped_answers(conversations: DataFrame) -> DataFrame:
    """Turns of pairs made from the table `conversations`, which knows no preference: each conversation is the chosen side of a pair
    of its number, and the same conversation up to its last answer, followed by the last answer of the next conversation, the
    rejected one. They share all turns before that answer. Every fifth conversation stands beside itself, every seventh alone, and one
    without an answer, or whose successor has none, beside itself."""
    turns = conversations.where("conv_id is not null").selectExpr("cast(conv_id as bigint) as pair_id", "turn", "role", "text")
    answers = turns.where(F.col("role") == TRAINED).groupBy("pair_id").agg(
        F.max(F.struct("turn", "text")).alias("last"))
    other = answers.selectExpr("pair_id - 1 as pair_id", "last.text as answer", "true as has_other")
    both = turns.join(answers.selectExpr("pair_id", "last.turn as at"), "pair_id", "left").join(other, "pair_id", "left")
    swaps = F.expr("has_other and at is not null and pair_id % 5 <> 0")
    rejected = both.where("pair_id % 7 <> 0").where(~F.coalesce(swaps, F.lit(False)) | (F.col("turn") <= F.col("at"))).select(
        "pair_id", F.lit("rejected").alias("side"), "turn", "role",
        F.when(F.coalesce(swaps & (F.col("turn") == F.col("at")) & (F.col("role") == TRAINED), F.lit(False)), F.col("answer")).otherwise(F.col("text")).alias("text"))
    return turns.select("pair_id", F.lit("chosen").alias("side"), "turn", "role", "text").unionByName(rejected)


def neighbours(conversations: DataFrame) -> DataFrame:
    """Turns of the table `conversations`, which knows no preference: conversations 2k and 2k + 1 stand in as chosen and
    rejected of pair k."""
    return conversations.selectExpr(
        "cast(floor(conv_id / 2) as bigint) as pair_id", "if(pmod(conv_id, 2) = 0, 'chosen', 'rejected') as side", "turn", "role", "text")
