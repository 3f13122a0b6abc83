import math
import random
import re
from collections import Counter, defaultdict

from editloom.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    w = WORD.findall(text)
    seen, same = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            same += line in seen
            seen.add(line)
    c = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {i + k for i in range(len(w) - 2) if c[tuple(w[i : i + 3])] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), same, len(covered)


def test_counts_equal_plain_ones(docs):
    rng = random.Random(6)
    some = ["".join(rng.choices("ab \n\t#é|\x85\x1c", k=rng.randrange(60))) for _ in range(2000)] + [r["text"] for r in docs.collect()] + ["a b c a b c", "a a a", "a a a a", ""]
    for t in some:
        assert rules.counts(t)[:5] == plain(t)


def test_verdicts_equal_plain_ones(spark, docs, edge_docs):
    both = docs.unionByName(edge_docs, allowMissingColumns=True)
    rows = [(r["lang"] or "", r["source"] or "", r["doc_id"], dict(zip(rules.COUNTS, rules.counts(r["text"] or ""), strict=True))) for r in both.collect()]

    def measures(c):
        share = lambda a, b: c[a] / max(c[b], 1)
        return {"symbols": share("n_symbols", "word_chars"), "duplicate_lines": share("n_dup_lines", "n_lines"), "repeats": share("n_repeat_words", "n_words"), "capitals": share("n_capitals", "word_chars"), "exclamations": share("n_exclamations", "word_chars"), "word_length": share("word_chars", "n_words")}

    groups = defaultdict(list)
    for lang, source, _, c in rows:
        for m, x in measures(c).items():
            for g in ((lang, source, m), (lang, m), (m,)):
                groups[g].append(x)

    def quantile(values, p):
        x = sorted(values)[max(0, math.ceil(len(values) * p) - 1)]
        return 0.0 if x <= rules.TINY else 2 * rules.GAMMA ** math.ceil(math.log(x) / math.log(rules.GAMMA)) / (rules.GAMMA + 1)

    def drawn(m, lang, source, p):
        """A group's quantile, drawn towards its language's, which is drawn towards that of all."""
        x = quantile(groups[m,], p)
        for g in ((lang, m), (lang, source, m)):
            n = len(groups[g])
            x = (n * quantile(groups[g], p) + rules.PRIOR * x) / (n + rules.PRIOR)
        return x

    want = Counter()
    for lang, source, doc, c in rows:
        bad = c["n_words"] < 50 or 100 * c["n_repeat_words"] > 50 * c["n_words"]
        ok = not bad
        for m, x in measures(c).items():
            low, mid, high = (drawn(m, lang, source, p) for p in (1 - rules.OUTER, 0.5, rules.OUTER))
            up, down = mid + rules.REACH * (high - mid), mid - rules.REACH * (mid - low)
            count, size = (c[k] for k in rules.MEASURES[m])
            if m == "word_length":
                noise = rules.NOISE * mid / math.sqrt(max(size, 1))
                ok &= down - noise <= x <= up + noise
            else:
                ok &= count <= up * size + rules.NOISE * math.sqrt(up * size + 1)
        want[doc, bad, ok] += 1
    got = Counter((r["doc_id"], r["base_failed"], r["kept"]) for r in rules.judge(both).collect())
    assert got == want and 0 < sum(v for (_, b, k), v in got.items() if not b and not k)


def test_thresholds_of_a_group_move_verdicts(spark):
    """The same text fails where its share of signs is rare and passes where it is usual."""
    rng = random.Random(3)
    words = lambda n: " ".join("".join(rng.choices("abcdefgh", k=rng.randrange(2, 9))) for _ in range(n))
    with_signs = lambda k: " ".join(w + ("#" if i % k == 0 else "") for i, w in enumerate(words(100).split()))
    rows = [(i, words(100), "en", "plain") for i in range(1500)] + [(2000 + i, with_signs(rng.randrange(2, 9)), "en", "forum") for i in range(200)]
    odd = with_signs(3)
    rows += [(5000, odd, "en", "plain"), (5001, odd, "en", "forum")]
    got = {r["doc_id"]: (r["kept"], r["reason"]) for r in rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert got[5000] == (False, "symbols") and got[5001] == (True, None)
    assert all(k for d, (k, _) in got.items() if d != 5000)


def test_clean_documents_stay_and_junk_goes(spark):
    d = "/root/testdata/sf0.1"
    got = rules.judge(spark.read.parquet(f"{d}/documents.parquet")).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").filter("not base_failed")
    n = {(r["quality"], r["kept"]): r["count"] for r in got.groupBy("quality", "kept").count().collect()}
    assert n.get((0, True), 0) < 0.05 * n[0, False] and n.get((1, False), 0) < 0.005 * n[1, True]


def test_sketches_merge_and_are_close(spark):
    rng = random.Random(1)
    xs = [rng.lognormvariate(0, 2) for _ in range(5000)]
    df = spark.createDataFrame([("l", f"s{i % 7}", *([x] * len(rules.MEASURES))) for i, x in enumerate(xs)], "lang string, source string, " + ", ".join(f"{m} double" for m in rules.MEASURES))
    r = rules.quantiles(rules.sketches(df), "lang").first()
    for name, p in (("low", 1 - rules.OUTER), ("mid", 0.5), ("high", rules.OUTER)):
        assert abs(r[name] / sorted(xs)[math.ceil(5000 * p) - 1] - 1) <= 1.01 * rules.ALPHA


def test_no_rows(no_docs):
    assert rules.judge(no_docs).count() == 0
