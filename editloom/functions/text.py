"""Text functions, Column to Column, with the semantics of Python's string methods where those differ from SQL's."""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

#: every character that str.isspace() accepts
SPACES = "".join(chr(i) for i in range(sys.maxunicode + 1) if chr(i).isspace())
LINE_END = "\r\n|[\n\r\x0b\f\x1c-\x1e\x85  ]"
#: every character that ends a line
LINE_ENDS = "".join(c for c in SPACES if len(f"{c}x".splitlines()) > 1)
DECORATION = "-`*#\n "
FENCE = r"(?U)```([^\s`]*)\s*\n([\s\S]*?)```"
#: section -> spellings of its mark
SECTIONS = {name: (f"### [{name}]", f"[{name}]", f"### {name}") for name in ("Program Before Edit", "Descriptive", "Lazy", "Program After Edit")}
LAZY_ENDS = ("```", "#" * 3, "-" * 3, SECTIONS["Program Before Edit"][1])


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


def split_lines(c: Column) -> Column:
    """str.splitlines: the empty string has no lines, and an end of line at the end starts no further one."""
    parts = F.split(c, LINE_END)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def count_lines(c: Column) -> Column:
    """Number of split_lines(c); the text is split once."""
    last = F.substring(c, -1, 1)  # empty for the empty text, which is found in any string
    return F.size(F.split(c, LINE_END)) - (F.instr(F.lit(LINE_ENDS), last) > 0).cast("int")


def purify(c: Column) -> Column:
    """Strip decoration from both ends of an instruction."""
    return F.btrim(c, F.lit(DECORATION))


def has_mark(c: Column, marks) -> Column:
    out = F.lit(False)
    for m in marks:
        out = out | c.contains(m)
    return out


def slice_between(c: Column, starts, ends=()) -> Column:
    """Stripped text behind the last-ending first find of `starts` up to the earliest first find of `ends`; null if one of
    them has no find, empty if they cross."""
    behind = F.greatest(*(F.when(F.instr(c, m) > 0, F.instr(c, m) + len(m)) for m in starts), F.lit(None).cast("int"))
    if not ends:
        return strip(F.substring(c, behind, F.length(c)))
    until = F.least(*(F.when(F.instr(c, m) > 0, F.instr(c, m)) for m in ends), F.lit(None).cast("int"))
    return F.when(until.isNotNull(), strip(F.substring(c, behind, F.greatest(until - behind, F.lit(0)))))


def slice_open(c: Column, starts, ends) -> Column:
    """Like slice_between, but `ends` count only behind the start, and without one the text goes to its end."""
    behind = F.greatest(*(F.when(F.instr(c, m) > 0, F.instr(c, m) + len(m)) for m in starts), F.lit(None).cast("int"))
    rest = F.substring(c, behind, F.length(c))
    until = F.least(*(F.when(F.instr(rest, m) > 0, F.instr(rest, m)) for m in ends), F.lit(None).cast("int"))
    return strip(F.coalesce(F.substring(rest, F.lit(1), until - 1), rest))


def fenced_blocks(c: Column) -> Column:
    """The first fenced block (tag, code) that is not tagged markdown, else the first block; null if there is none."""
    blocks = F.arrays_zip(F.regexp_extract_all(c, F.lit(FENCE), F.lit(1)).alias("tag"), F.regexp_extract_all(c, F.lit(FENCE), F.lit(2)).alias("code"))
    # the fallback stands behind the blocks that come before it
    return F.get(F.concat(F.filter(blocks, lambda b: F.lower(b["tag"]) != "markdown"), F.slice(blocks, 1, 1)), F.lit(0))


def stripped_code(block: Column) -> Column:
    return F.nullif(strip(block["code"]), F.lit(""))


def unmarked_code(code: Column, tag: Column | None = None) -> Column:
    """Code that begins with ``python`` loses its first line. With a tag a comment line names the language."""
    led = code.startswith("python")
    body = F.when(led, F.regexp_replace(code, r"(?s)\A[^\n]*(?:\n|\z)", "")).otherwise(code)
    if tag is None:
        return body
    tag = F.when(led, "python").otherwise(tag)
    return F.when(tag != "", F.concat(F.lit("## "), tag, F.lit("\n"), body)).otherwise(body)


def fenced_code(c: Column, keep_mark: bool = False) -> Column:
    """Code of the chosen fenced block; null if there is none or it is empty. Over tables, operators.extract.purify_code
    computes each step once."""
    block = fenced_blocks(c)
    return unmarked_code(stripped_code(block), block["tag"] if keep_mark else None)


def is_single_line(c: Column) -> Column:
    """A field that is no code: one line, a box-drawing bar, or a shell prompt. A missing field is not judged."""
    return F.coalesce(~c.contains("\n") | c.contains("─") | strip(c).startswith("$"), F.lit(False))


def first_block(c: Column) -> Column:
    """Lines within the first fence that starts a line, each with an end of line; the fence may be open. No fence: empty."""
    lines = F.split(F.coalesce(c, F.lit("")), "\n")
    mark = lambda x: F.array_position(F.transform(x, lambda s: s.startswith("```")), True).cast("int")
    rest = F.slice(lines, mark(lines) + 1, F.greatest(F.size(lines) - mark(lines), F.lit(0)))
    kept = F.when(mark(rest) > 0, F.slice(rest, 1, F.greatest(mark(rest) - 1, F.lit(0)))).otherwise(rest)
    return F.when((mark(lines) > 0) & (F.size(kept) > 0), F.concat(F.array_join(kept, "\n"), F.lit("\n"))).otherwise("")


def cut_at(c: Column, stops) -> Column:
    """Cut at the first occurrence of each stop string, one after the other."""
    for s in stops:
        c = F.when(F.instr(c, s) > 0, F.substring(c, F.lit(1), F.instr(c, s) - 1)).otherwise(c)
    return c


def split_identifier(c: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(c, "([a-z])([A-Z])", "$1 $2"), r"[\s_]+"), lambda x: x != "")


def instruction_words(c: Column) -> Column:
    """Lower-cased words without punctuation."""
    # one pass over the whole text instead of one a word; what strip() takes and \s does not hold is no \w either
    return F.filter(F.split(F.lower(F.regexp_replace(c, r"(?U)[^\w\s]+", "")), r"(?U)\s+"), lambda w: w != "")


def joined_commit(c: Column) -> Column:
    """A commit given as a JSON array of strings becomes comma-joined text; other text stays, null is empty."""
    return F.coalesce(F.when(c.startswith("["), F.concat_ws(",", F.from_json(c, "array<string>"))).otherwise(c), F.lit(""))


def edit_parts(c: Column) -> tuple[Column, Column]:
    """Code and instruction of an edit prompt, without the code's fence; empty where a part is missing."""
    code = strip(F.regexp_extract(c, r"(?s)## Code Before:(.*?)## Instruction:", 1))
    words = strip(F.regexp_extract(c, r"(?s)## Instruction:(.*?)## Code After:", 1))
    bare = F.regexp_replace(code, r"\A`{3}[A-Za-z]*\n?|\n?`{3}\z", "")
    return F.when(code.startswith("```") & code.endswith("```"), bare).otherwise(code), words
