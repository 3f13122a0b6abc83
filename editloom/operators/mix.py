"""Mixes of sources by exact quota, and training rows from them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import templates
from ..functions.text import joined_commit
from .sampling import draw, largest_remainder, sample_exact, shuffle

KINDS = {"descriptive": "instruct_descriptive_purify", "lazy": "instruct_lazy_purify"}
SYSTEM = "You are a programming assistant who edits code as instructed."


@dataclass(frozen=True)
class Source:
    rows: DataFrame
    ratio: float
    kind: str
    model: str | None = None


def mix_rows(rows: DataFrame, kind: str, model: str | None = None) -> DataFrame:
    """Triplets as mix rows with the label <model>_<kind>; rows without an instruction of that kind are dropped."""
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {', '.join(KINDS)}")
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    return rows.filter(F.coalesce(F.length(KINDS[kind]), F.lit(0)) > 0).select(
        "row_id", joined_commit(F.col("commit")).alias("commit"), "code_snippet", text("code_before_purify"), text("code_after_purify"), F.col(KINDS[kind]).alias("instruct_purify"), F.lit(f"{model or 'unknown'}_{kind}").alias("instr_type")
    )


def mix(sources: list[Source], total: int, seed: int = 42, in_order: bool = True) -> DataFrame:
    """Each source gives exactly its quota, drawn before empty instructions drop out; sources are drawn independently."""
    quotas = largest_remainder([s.ratio for s in sources], total)
    parts = [mix_rows(sample_exact(s.rows, n, "row_id", f"{seed}/{i}", strict=True), s.kind, s.model) for i, (s, n) in enumerate(zip(sources, quotas, strict=True))]
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return shuffle(out.withColumn("k_", F.concat_ws("#", "row_id", "instr_type")), "k_", seed).drop("k_") if in_order else out


def fenced(seed, key: Column) -> Column:
    """A coin per row: whether the code before gets a fence."""
    return F.pmod(draw(f"{seed}f", key), F.lit(2)) == 0


def finetune_rows(rows: DataFrame, shape: str = "alpaca", seed: int = 42, key: str = "row_id", no_think: bool = False, before="code_before_purify", instruction="instruct_purify", after="code_after_purify", system: str = SYSTEM) -> DataFrame:
    """Training rows: alpaca (instruction, system, output) or share_gpt (messages), with commit, instr_type and both codes."""
    old, words, new = (F.coalesce(F.col(c), F.lit("")) for c in (before, instruction, after))
    prompt = F.when(fenced(seed, F.col(key)), templates.edit_prompt(old, words, tag_before="python")).otherwise(templates.edit_prompt(old, words))
    if no_think:
        prompt = F.concat(prompt, F.lit(" /no_think"))
    answer = templates.fence(new, "python")
    rest = (F.col("commit"), F.coalesce(F.col("instr_type"), F.lit("unknown")).alias("instr_type"), old.alias("old_code"), new.alias("new_code"))
    if shape == "alpaca":
        return rows.select(key, prompt.alias("instruction"), F.lit(system).alias("system"), answer.alias("output"), *rest)
    if shape == "share_gpt":
        return rows.select(key, templates.messages(("system", system), ("user", prompt), ("assistant", answer)).alias("messages"), *rest)
    raise ValueError("shape must be alpaca or share_gpt")


def finetune_set(inputs: list[DataFrame], shape: str = "share_gpt", seed: int = 42, **options) -> DataFrame:
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), inputs)
    return shuffle(finetune_rows(rows, shape, seed, **options), options.get("key", "row_id"), seed)


def user_text(messages: Column) -> Column:
    """What the user says in a chat, one turn a line; null if nothing."""
    turns = F.filter(messages, lambda m: m["role"] == "user")
    return F.when(F.size(turns) > 0, F.array_join(F.transform(turns, lambda m: m["content"]), "\n"))


def loader_text(rows: DataFrame, fields: list[str], shape: str = "general") -> Column:
    """One text a row from a chat column, from one field, or from code and instruction in the edit form."""
    missing = [f for f in [*fields[:2], "commit"] if f not in rows.columns]
    if missing:
        raise KeyError(f"no such field: {', '.join(missing)}")
    if shape == "sharegpt":
        return F.coalesce(user_text(F.col(fields[0])), F.raise_error(F.lit("a chat without a user turn")).cast("string"))
    if len(fields) == 2:
        return F.concat(templates.edit_prompt(F.col(fields[0]), F.col(fields[1])))
    return F.col(fields[0])
