"""From model responses to cleaned triplets of code before, instruction and code after."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

CODE, WORDS = ("code_before", "code_after"), ("instruct_descriptive", "instruct_lazy")


def has_sections(first: Column, second: Column) -> Column:
    """Every section has one of its marks."""
    before, desc, lazy, after = T.SECTIONS.values()
    return T.has_mark(first, before) & T.has_mark(first, desc) & T.has_mark(first, lazy) & T.has_mark(second, after)


def sections(rows: DataFrame) -> DataFrame:
    """response_1, response_2 -> code_before, code_after and the instructions, where all marks are there and all but the
    code before have content. Other columns stay."""
    before, desc, lazy, after = T.SECTIONS.values()
    one, two = F.coalesce("response_1", F.lit("")), F.coalesce("response_2", F.lit(""))
    parts = {
        "code_before": T.slice_between(one, before, desc),
        "code_after": T.slice_between(two, after),
        "instruct_descriptive": T.slice_between(one, desc, lazy),
        "instruct_lazy": T.slice_open(one, lazy, T.LAZY_ENDS),
    }
    # predicates do not move below a generator: the slices are computed once, not again in the filter
    cut = rows.filter(has_sections(one, two)).withColumn("cut_", F.explode(F.array(F.struct(*(c.alias(n) for n, c in parts.items())))))
    kept = cut.filter("cut_.code_after <> '' and cut_.instruct_descriptive <> '' and cut_.instruct_lazy <> ''")
    return kept.withColumns({n: F.col(f"cut_.{n}") for n in parts}).drop("response_1", "response_2", "cut_")


def drop_single_line(rows: DataFrame, fields=CODE) -> DataFrame:
    keep = F.lit(True)
    for f in fields:
        keep = keep & ~T.is_single_line(F.col(f))
    return rows.filter(keep)


def purify_code(rows: DataFrame, fields=CODE, keep_mark: bool = False) -> DataFrame:
    """Adds <field>_purify. Each step is a projection of its own: what later steps use more than once is computed once, and
    generated code stays small."""
    rows = rows.withColumns({f"{f}_block_": T.fenced_blocks(F.col(f)) for f in fields})
    rows = rows.withColumns({f"{f}_code_": T.stripped_code(F.col(f"{f}_block_")) for f in fields})
    rows = rows.withColumns({f"{f}_purify": T.unmarked_code(F.col(f"{f}_code_"), F.col(f"{f}_block_")["tag"] if keep_mark else None) for f in fields})
    return rows.drop(*(f"{f}{x}" for f in fields for x in ("_block_", "_code_")))


def purify_instructions(rows: DataFrame, fields=WORDS) -> DataFrame:
    return rows.withColumns({f"{f}_purify": T.purify(F.col(f)) for f in fields})


def triplets(responses: DataFrame) -> DataFrame:
    """All four steps, as one plan."""
    return purify_instructions(purify_code(drop_single_line(sections(responses))))
