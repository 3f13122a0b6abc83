"""Prompts, chats and training rows as string expressions. The wording is data: pass your own templates where it matters."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

CODE_EDITOR = "You edit programs. Given code and an instruction, answer with the changed code and nothing else."

#: version -> (system text, user turns); {names} are slots
PROMPTS = {
    "v5.1": (
        "You are an expert programmer who designs precise tasks for editing programs.",
        (
            "Use these two snippets as inspiration.\n\nSnippet 1:\n{code_snippet_1}\n\nSnippet 2:\n{code_snippet_2}\n\n"
            "Write a program, then an editing task for it in a descriptive and a lazy form, under the headings "
            "[Program Before Edit], [Descriptive] and [Lazy]. An example:\n[Program Before Edit]\n```\n{code_before_shot}\n```\n\n"
            "[Descriptive]\n{desc_instr_shot}\n\n[Lazy]\n{lazy_instr_shot}",
            "If the program is sound, give the edited code under [Program After Edit] without comment; otherwise answer <UNREASONABLE>.",
        ),
    ),
    "v5.9": (
        "You are an expert programmer.",
        (
            "Turn the commit message into a descriptive and a lazy instruction, under [Descriptive] and [Lazy].\n\n"
            "Code:\n```\n{code_before}\n```\n\nDiff:\n```diff\n{code_diff}\n```\n\nMessage:\n{commit_message}\n\n"
            "An example:\n[Descriptive]\n{desc_instr_shot}\n\n[Lazy]\n{lazy_instr_shot}",
        ),
    ),
}


def prompts(version: str) -> tuple[str, tuple[str, ...]]:
    if version not in PROMPTS:
        raise ValueError(f"no prompts of version {version!r}; there are {', '.join(PROMPTS)}")
    return PROMPTS[version]


def fill(template: str, **slots: Column) -> Column:
    """The template with its {slots} filled, in one pass: braces in what is filled in stay as they are."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*(F.coalesce(slots[x].cast("string"), F.lit("")) if k % 2 else F.lit(x) for k, x in enumerate(parts)))


def fence(code: Column, tag: str | None) -> Column:
    return code if tag is None else F.concat(F.lit(f"```{tag}\n"), code, F.lit("\n```"))


def edit_prompt(old: Column, instruction: Column, new: Column | str = "", tag_before: str | None = None, tag_after: str | None = None, lead: str = "") -> Column:
    new = F.lit(new) if isinstance(new, str) else new
    return F.concat(F.lit(lead + "## Code Before:\n"), fence(old, tag_before), F.lit("\n## Instruction:\n"), instruction, F.lit("\n## Code After:\n"), fence(new, tag_after))


def system_edit_prompt(old: Column, instruction: Column, new: Column | str = "", tag_before: str | None = None, tag_after: str | None = None) -> Column:
    return edit_prompt(old, instruction, new, tag_before, tag_after, CODE_EDITOR + "\n")


def commit_prompt(old: Column, instruction: Column, new: Column | str = "") -> Column:
    """Commit tokens of the StarCoder family."""
    return F.concat(F.lit("<commit_before>"), old, F.lit("<commit_msg>"), instruction, F.lit("<commit_after>"), F.lit(new) if isinstance(new, str) else new)


SHOT_OLD = "def area(w, h):\n    return w * h"
SHOT_INSTRUCTION = "Add a perimeter function and name the sides width and height."
SHOT_NEW = "def area(width, height):\n    return width * height\n\n\ndef perimeter(width, height):\n    return 2 * (width + height)"


def one_shot_prompt(old: Column, instruction: Column, new: Column | str = "") -> Column:
    shot = f"## Code Before:\n{SHOT_OLD}\n## Instruction:\n{SHOT_INSTRUCTION}\n## Code After:\n{SHOT_NEW}\n"
    return edit_prompt(old, instruction, new, lead=shot)


def issue_prompt(old: Column, instruction: Column) -> Column:
    """The thread form: a solved request, then ours, open at the code."""
    ask = "Here is my program:\n```py\n{old}\n```\n\nPlease change it: {instruction}"
    text = (
        "<issue_start>username_0: " + ask.format(old=SHOT_OLD, instruction=SHOT_INSTRUCTION) + "<issue_comment>username_1: The full changed code:\n```py\n" + SHOT_NEW
        + "\n```\nUpvotes: 200<issue_comment>username_0: Thanks! Another one. " + ask + "\nUpvotes: 100<issue_comment>username_1: The full changed code:\n```py"
    )
    return fill(text, old=old, instruction=instruction)


def messages(*turns: tuple[str, Column | str]) -> Column:
    return F.array(*(F.struct(F.lit(role).alias("role"), (F.lit(c) if isinstance(c, str) else c).alias("content")) for role, c in turns))


def chat_prompt(old: Column, instruction: Column) -> Column:
    return messages(("system", CODE_EDITOR), ("user", edit_prompt(old, instruction, tag_before="python")))


def chat_prompt_one_shot(old: Column, instruction: Column) -> Column:
    shown = f"## Code Before:\n```python\n{SHOT_OLD}\n```\n## Instruction:\n{SHOT_INSTRUCTION}\n## Code After:\n"
    return messages(("system", CODE_EDITOR), ("user", shown), ("assistant", f"```python\n{SHOT_NEW}\n```"), ("user", edit_prompt(old, instruction, tag_before="python")))


def chat_prompt_diff(old: Column, instruction: Column) -> Column:
    shown = "Answer with a unified diff under ## Code Diff.\n\n## Code Before:\n"
    return messages(
        ("system", "You edit Python programs. Answer with a unified diff and nothing else."),
        ("user", F.concat(F.lit(shown), fence(old, "py"), F.lit("\n## Instruction:\n"), instruction, F.lit("\n## Code Diff"))),
    )


# chats as one string. A leading system turn is repeated by each formatter where its model wants it.


def _parts(m: Column) -> tuple[Column, Column]:
    """(system text or empty, turns behind it)"""
    led = F.get(m, F.lit(0))["role"] == "system"
    return F.when(led, F.get(m, F.lit(0))["content"]).otherwise(""), F.when(led, F.slice(m, 2, F.greatest(F.size(m) - 1, F.lit(0)))).otherwise(m)


def question_answer(m: Column) -> Column:
    system, rest = _parts(m)
    lines = F.transform(rest, lambda t: F.when(t["role"] == "user", F.concat(F.lit("Question: "), system, F.lit("\n"), t["content"])).otherwise(F.concat(F.lit("Answer: "), t["content"])))
    text = F.array_join(lines, "\n\n")
    return F.when(F.get(rest, F.size(rest) - 1)["role"] == "user", F.concat(text, F.lit("\n\nAnswer:"))).otherwise(text)


BEGIN, CLOSE = "<|im_start|>", "<|im_end|>"


def im_blocks(m: Column, think: str = "") -> Column:
    """think: `/think` or `/no_think` behind user turns, or nothing."""
    system, rest = _parts(m)
    end = F.lit(CLOSE)
    lead = F.concat(F.lit(BEGIN + "system\n"), system, end, F.lit(f"\n\n{BEGIN}user\n"))
    tail = F.lit((f" {think}" if think else "") + CLOSE + "\n" * 2 + BEGIN + "assistant")
    return F.array_join(F.transform(rest, lambda t: F.when(t["role"] == "user", F.concat(lead, t["content"], tail)).otherwise(F.concat(t["content"], end))), "")


def user_assistant(m: Column) -> Column:
    system, rest = _parts(m)
    return F.array_join(
        F.transform(rest, lambda t: F.when(t["role"] == "user", F.concat(system, F.lit("\n\nUser: "), t["content"], F.lit("\n\nAssistant:"))).otherwise(F.concat(t["content"], F.lit("\n\n")))), ""
    )


def fold_system(m: Column) -> Column:
    """For models without a system turn: its text goes before every user turn."""
    system, rest = _parts(m)
    led = F.get(m, F.lit(0))["role"] == "system"
    folded = F.transform(rest, lambda t: F.struct(t["role"].alias("role"), F.when(t["role"] == "user", F.concat(system, F.lit("\n"), t["content"])).otherwise(t["content"]).alias("content")))
    return F.when(led, folded).otherwise(F.transform(m, lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"))))
