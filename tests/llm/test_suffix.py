import hashlib
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from editloom.llm import suffix


def plain(rows, size):
    count = Counter()
    for t in rows:
        count.update(t[i : i + size] for i in range(len(t) - size + 1))
    out = []
    for t in rows:
        gone = [False] * len(t)
        last = -1
        for i in range(len(t) - size + 1):
            if count[t[i : i + size]] > 1:
                for j in range(max(i, last + 1), i + size):
                    gone[j] = True
                last = i + size - 1
        rest = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        spans = sum(g and not h for g, h in zip(gone, [False, *gone], strict=False))
        out.append((len(t), len(t) - len(rest), spans, hashlib.sha256(rest).hexdigest()))
    return out


def corpus(rng, n, size):
    words = [bytes(rng.choices(b"abcdefgh\xc3\xa9 ", k=rng.randrange(1, 9))).decode("utf-8", "ignore") for _ in range(60)]
    text = lambda k: " ".join(rng.choices(words, k=k))
    shared, rows = [text(size // 2) for _ in range(6)], []
    for _ in range(n):
        t = text(rng.randrange(0, size * 2))
        for _ in range(rng.randrange(3)):
            p, a = rng.choice(shared), rng.randrange(20)
            t += p[a : a + rng.randrange(len(p))] + text(rng.randrange(5))
        rows.append(t)
    return rows + [rows[3], "x" * (size * 3), "ab" * size, ("z" * (size - 1)), "", rows[5] + "q", "y" * size]


def test_intervals_find_what_counting_finds():
    rng = random.Random(8)
    for _ in range(60):
        pieces = ["".join(rng.choices("abc", k=rng.randrange(1, 40))).encode() for _ in range(rng.randrange(1, 12))]
        for depth in (1, 3, 7):
            data, count = b"\0".join([*pieces, b""]), Counter()
            ok = [i for i in range(len(data) - depth + 1) if b"\0" not in data[i : i + depth]]
            count.update(data[i : i + depth] for i in ok)
            got = suffix.repeated_starts(pieces, depth)
            assert sorted(got.tolist()) == [i for i in ok if count[data[i : i + depth]] > 1]


def test_runs_cover_every_window_and_follow_content():
    rng = random.Random(2)
    t = "".join(rng.choices("abcd", k=5000)).encode()
    start, many, anchor = suffix.runs(t)
    assert start[0] == 0 and (start[1:] == start[:-1] + many[:-1]).all() and start[-1] + many[-1] == len(t) - 199
    by = {t[s + i : s + i + 200]: a for s, m, a in zip(start, many, anchor, strict=True) for i in range(m)}
    moved = b"zz" + t[1000:2000] + b"y"
    for s, m, a in zip(*suffix.runs(moved), strict=True):
        for i in range(m):
            w = moved[s + i : s + i + 200]
            assert w not in by or by[w] == a


def test_long_texts_are_cut_into_blocks_alike(monkeypatch):
    rng = random.Random(3)
    t = "".join(rng.choices("ab", k=9000)).encode() + b"c" * 900
    whole = suffix.runs(t)
    monkeypatch.setattr(suffix, "WINDOW_BLOCK", 700)
    assert all((a == b).all() for a, b in zip(whole, suffix.runs(t), strict=True))


def test_query_equals_brute_force(spark, docs, monkeypatch):
    small = corpus(random.Random(1), 120, 60)
    df = spark.createDataFrame(list(enumerate(small)), "doc_id long, text string")
    for big in (200_000, 300):
        monkeypatch.setattr(suffix, "BIG_ANCHOR", big)
        got = {r["doc_id"]: tuple(r)[1:] for r in suffix.remove_repeats(df, 60).collect()}
        assert [got[i] for i in range(len(small))] == plain([t.encode() for t in small], 60)
    rows = docs.collect()
    got = {r["doc_id"]: tuple(r)[1:] for r in suffix.remove_repeats(docs).collect()}
    want = plain([r["text"].encode() for r in rows], 200)
    assert [got[r["doc_id"]] for r in rows] == want and sum(w[1] for w in want) > 1000


def test_texts_of_one_hash_and_no_ids_are_told_apart(spark):
    rng = random.Random(9)
    head = "".join(rng.choices("abcdefgh ", k=230))
    two = spark.range(400_000).selectExpr(f"concat('{head}', id) AS text", f"hash(concat('{head}', id)) AS h").groupBy("h").agg(F.collect_list("text").alias("t")).filter("size(t) > 1").limit(2).collect()
    assert two
    texts = [t for r in two for t in r["t"]] + ["".join(rng.choices("xyz", k=500))]
    got = sorted(tuple(r)[1:] for r in suffix.remove_repeats(spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")).collect())
    assert got == sorted(plain([t.encode() for t in texts], 200))


def test_edge_rows(spark, edge_docs, no_docs):
    rows = edge_docs.collect()
    got = sorted((tuple(r) for r in suffix.remove_repeats(edge_docs).collect()), key=repr)
    want = plain([(r["text"] or "").encode() for r in rows], 200)
    assert got == sorted(((r["doc_id"], *w) for r, w in zip(rows, want, strict=True)), key=repr)
    assert suffix.remove_repeats(no_docs).count() == 0
    kept = suffix.remove_repeats(edge_docs, with_text=True).filter("doc_id = 8").first()["kept"]
    assert kept == b"" and np.frombuffer(kept, np.uint8).size == 0
