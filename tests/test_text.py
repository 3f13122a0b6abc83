import random
import re

from pyspark.sql import functions as F

from editloom.functions import templates as P
from editloom.functions import text as T


def column(spark, values, make):
    df = spark.createDataFrame(list(enumerate(values)), "i int, x string")
    return [r["y"] for r in df.select("i", make(F.col("x")).alias("y")).orderBy("i").collect()]


def randoms(n, alphabet, k, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choices(alphabet, k=rng.randrange(k))) for _ in range(n)]


def test_lines_and_strip_are_pythons(spark):
    xs = randoms(1500, ["a", "b", " ", "\n", "\r", "\r\n", "\x0b", "\f", "\x1c", "\x1e", "\x85", " ", " ", "　", "\t"], 12)
    assert column(spark, xs, T.split_lines) == [x.splitlines() for x in xs]
    assert column(spark, xs, T.strip) == [x.strip() for x in xs]
    assert column(spark, xs, T.purify) == [x.strip("-`*#\n ") for x in xs]


def plain_code(x, keep=False):
    found = [(m.group(1) or "", m.group(2)) for m in re.finditer(r"```([^\s`]*)\s*\n([\s\S]*?)```", x)]
    if not found:
        return None
    tag, code = next((f for f in found if f[0].lower() != "markdown"), found[0])
    code = code.strip()
    if not code:
        return None
    if code.startswith("python"):
        code, tag = code.partition("\n")[2], "python"
    return f"## {tag}\n{code}" if keep and tag else code


def test_lines_are_counted_and_words_found_in_one_pass(spark):
    xs = [*randoms(1500, ["a", "B", "Σ", "é", "_", ".", "-", " ", "\n", "\r", "\r\n", "\x1c", "\x1f", "\x85", "\u2028", "\u3000", "\u200d"], 12), ""]
    assert column(spark, xs, T.count_lines) == [len(x.splitlines()) for x in xs]
    one = lambda c: F.filter(F.transform(F.split(T.strip(c), r"(?U)\s+"), lambda w: F.lower(F.regexp_replace(w, r"(?U)[^\w]", ""))), lambda w: w != "")
    assert column(spark, xs, T.instruction_words) == column(spark, xs, one)


def test_fenced_code(spark):
    xs = randoms(2000, ["```", "```", "py", "markdown", "\n", "\n", "x", "python", " ", "`"], 14) + ["```\npython_x = 1\ny\n```", "```py\n\n```", "```Markdown\na\n``` ```js\nb```"]
    assert column(spark, xs, T.fenced_code) == [plain_code(x) for x in xs]
    assert column(spark, xs, lambda c: T.fenced_code(c, True)) == [plain_code(x, True) for x in xs]


def plain_block(x):
    out, inside = "", False
    for line in x.split("\n"):
        if line.startswith("```"):
            if inside:
                break
            inside = True
        elif inside:
            out += line + "\n"
    return out


def test_first_block_and_stops(spark):
    xs = randoms(1500, ["```", "\n", "\n", "a", " ", "py"], 12, 2)
    assert column(spark, xs, T.first_block) == [plain_block(x) for x in xs]

    def cut(x):
        for s in ("a", "\n", "py"):
            x = x.split(s)[0]
        return x

    assert column(spark, xs, lambda c: T.cut_at(c, ("a", "\n", "py"))) == [cut(x) for x in xs]


def test_slices(spark):
    starts, ends = ("### [A]", "[A]"), ("### [B]", "[B]")
    xs = randoms(1500, ["### ", "[A]", "[B]", " ", "x", "\n", "---"], 10, 3)

    def between(x):
        if not any(m in x for m in starts) or not any(m in x for m in ends):
            return None
        a = max(x.find(m) + len(m) for m in starts if m in x)
        return x[a : min(x.find(m) for m in ends if m in x)].strip()

    def open_end(x):
        if not any(m in x for m in starts):
            return None
        a = max(x.find(m) + len(m) for m in starts if m in x)
        found = [x.find(m, a) for m in ("---", "###") if x.find(m, a) >= 0]
        return x[a : min(found) if found else len(x)].strip()

    assert column(spark, xs, lambda c: T.slice_between(c, starts, ends)) == [between(x) for x in xs]
    assert column(spark, xs, lambda c: T.slice_open(c, starts, ("---", "###"))) == [open_end(x) for x in xs]


def test_words_identifiers_commits(spark):
    assert column(spark, ["getHTTPName_of the", "_a__b ", ""], T.split_identifier) == [["get", "HTTPName", "of", "the"], ["a", "b"], []]
    assert column(spark, ["  Don't stop—now! été 3x"], T.instruction_words) == [["dont", "stopnow", "été", "3x"]]
    assert column(spark, ['["a","b"]', "c", None], T.joined_commit) == ["a,b", "c", ""]
    assert column(spark, ["a", "a\n─", "a\n", " $ x\ny", None], T.is_single_line) == [True, True, False, True, False]


def test_edit_parts_undo_the_prompt(spark):
    df = spark.createDataFrame([("x = 1\ny", "Do it")], "o string, w string")
    for tag in (None, "python"):
        code, words = T.edit_parts(P.edit_prompt(F.col("o"), F.col("w"), tag_before=tag))
        assert tuple(df.select(code, words).first()) == ("x = 1\ny", "Do it")


def test_templates(spark):
    df = spark.createDataFrame([("a{b}", "i")], "o string, w string")
    assert df.select(P.fill("<{x}|{y}>", x=F.col("o"), y=F.col("w"))).first()[0] == "<a{b}|i>"
    chat = P.messages(("system", "S"), ("user", F.col("o")), ("assistant", "A"))
    one = lambda c: df.select(c).first()[0]
    assert one(P.question_answer(chat)) == "Question: S\na{b}\n\nAnswer: A"
    assert one(P.question_answer(P.messages(("user", "u")))) == "Question: \nu\n\nAnswer:"
    assert one(P.im_blocks(chat, "/think")) == "<|im_start|>system\nS<|im_end|>\n\n<|im_start|>user\na{b} /think<|im_end|>\n\n<|im_start|>assistantA<|im_end|>"
    assert one(P.user_assistant(chat)) == "S\n\nUser: a{b}\n\nAssistant:A\n\n"
    assert [tuple(m) for m in one(P.fold_system(chat))] == [("user", "S\na{b}"), ("assistant", "A")]
