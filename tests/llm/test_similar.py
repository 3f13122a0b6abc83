from itertools import combinations

import numpy as np

from editloom.llm import simhash


def jaccard(a, b):
    x, y = (set(simhash.shingles(t.encode(), 5)) for t in (a, b))
    return len(x & y) / len(x | y) if x | y else 1.0


def near_pairs(low, high, many, seed):
    """Pairs of texts with a similarity from low to below high: the second has some words of the first replaced."""
    rng, out = np.random.default_rng(seed), []
    while len(out) < many:
        words = [f"w{i}" for i in rng.integers(0, 100_000, rng.integers(150, 400))]
        copy = list(words)
        for at in rng.choice(len(copy), rng.integers(1, len(copy) // 20), replace=False):
            copy[at] = "changed"
        pair = " ".join(words), " ".join(copy)
        if low <= jaccard(*pair) < high:
            out.append(pair)
    return out


def linked(spark, pairs, **more):
    rows = [(2 * i + k, t) for i, pair in enumerate(pairs) for k, t in enumerate(pair)]
    got = {r["doc_id"]: r["component_id"] for r in simhash.similar(spark.createDataFrame(rows, "doc_id long, text string"), **more).collect()}
    assert len(got) == len(rows)
    return [got[2 * i + 1] == got[2 * i] for i in range(len(pairs))]


def test_pairs_at_the_threshold_are_found(spark):
    assert np.mean(linked(spark, near_pairs(0.8, 0.81, 400, 1))) >= 0.95


def test_pairs_below_the_threshold_are_not_linked(spark):
    assert not any(linked(spark, near_pairs(0.65, 0.8, 400, 2)))


def test_groups_equal_exact_similarity_of_all_pairs(spark, docs):
    rows = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    top = {d: d for d in rows}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in combinations(sorted(rows), 2):
        if jaccard(rows[a], rows[b]) >= 0.8:
            x, y = sorted((find(a), find(b)))
            top[y] = x
    got = {r["doc_id"]: r["component_id"] for r in simhash.similar(docs).collect()}
    assert got == {d: find(d) for d in rows}


def test_repeats_do_not_count_and_hot_shards_change_nothing(spark):
    words = " ".join(f"w{i}" for i in range(200))
    again = words + " w0 w1 w2 w3 w4 w5 w6 w7" * 40
    pairs = [(words, again), ("a b c d e f", "a b c d e g"), ("", "x"), (" ONE  two", "one two")]
    assert jaccard(*pairs[0]) >= 0.8
    for hot in (20_000, 1):
        assert linked(spark, pairs, hot=hot) == [True, False, False, True]


def test_documents_without_or_of_one_id(spark):
    words = [f"w{i}" for i in range(300)]
    near = " ".join([*words[:-2], "x", "y"])
    rows = [(None, " ".join(words)), (7, near), (7, "another text"), (9, "ANOTHER text"), (None, None), (11, "")]
    got = sorted((r["doc_id"] or 0, r["component_id"]) for r in simhash.similar(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(0, 7), (0, 11), (7, 7), (7, 7), (9, 7), (11, 11)]


def test_one_plan_for_tables_of_every_size():
    bits, radius, keys = simhash.plan_for(0.8)
    assert (bits, radius, len(keys)) == (320, 68, 26)


def test_many_near_copies_are_joined_without_all_pairs(spark, monkeypatch):
    """A ring of texts, each like its neighbours only, and a large group of copies that are all alike."""
    rng = np.random.default_rng(6)
    ring, words = [], [f"r{i}" for i in rng.integers(0, 10**6, 300)]
    for i in range(40):
        words = list(words)
        words[i * 7 : i * 7 + 4] = [f"n{i}{k}" for k in range(4)]
        ring.append(" ".join(words))
    base = [f"b{i}" for i in rng.integers(0, 10**6, 300)]
    copies = []
    for i in range(300):
        own = list(base)
        own[int(rng.integers(300))] = f"c{i}"
        copies.append(" ".join(own))
    texts = ring + copies
    tried = []
    real = simhash.verified

    def counted(docs, nodes, pairs, *more):
        tried.append(pairs.count())
        return real(docs, nodes, pairs, *more)

    monkeypatch.setattr(simhash, "verified", counted)
    for most in (1, 8, 10_000):
        tried.clear()
        got = {r["doc_id"]: r["component_id"] for r in simhash.similar(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), most=most).collect()}
        assert [got[i] for i in range(len(texts))] == [0] * 40 + [40] * 300, most
        if most < 10_000:
            assert sum(tried) < 300 * 299 / 6
