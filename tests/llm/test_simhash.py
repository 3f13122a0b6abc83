from collections import defaultdict

import numpy as np
import xxhash

from editloom.llm import simhash
from editloom.llm.components import components


def plain_print(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    s = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints):
    ids = sorted(prints, key=lambda x: (x is None, x))
    top = {i: i for i in ids}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                top[y] = x
    return {i: find(i) for i in ids}


def test_query_equals_brute_force(spark, docs):
    prints = {r["doc_id"]: plain_print(r["text"]) for r in docs.collect()}
    want = plain_components(prints)
    for hot in (20_000, 2):
        rows = simhash.near_duplicates(docs, hot=hot).collect()
        assert {r["doc_id"]: (int(r["fingerprint"], 16), r["component_id"]) for r in rows} == {i: (prints[i], want[i]) for i in prints}


def test_chains_of_close_fingerprints(spark):
    rng = np.random.default_rng(3)
    fps = []
    for _ in range(60):
        x = int(rng.integers(0, 2**63))
        for _ in range(6):
            fps.append(x)
            for b in rng.choice(64, rng.integers(0, 5), replace=False):
                x ^= 1 << int(b)
    prints = dict(enumerate(fps))
    df = spark.createDataFrame([(i, bytearray(x.to_bytes(8, "big"))) for i, x in prints.items()], "doc_id long, fp binary")
    want = plain_components(prints)
    for hot in (20_000, 3):
        got = {r["doc_id"]: r["component_id"] for r in simhash.cluster(df, 3, 64, simhash.exact_keys(3), hot).collect()}
        assert got == want


def test_edge_rows(spark, edge_docs, no_docs):
    rows = simhash.near_duplicates(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    zero = [r for r in rows if r["fingerprint"] == "0" * 16]
    assert len(zero) == 4 and {r["component_id"] for r in zero} == {0}
    same = {r["component_id"] for r in rows if r["doc_id"] in (5, 6)}
    assert same == {5}
    assert simhash.near_duplicates(no_docs).count() == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(50)}}


def test_similar_texts_meet_and_others_do_not(spark):
    rng = np.random.default_rng(1)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows, group = [], defaultdict(list)
    for g in range(150):
        words = [vocabulary[i] for i in rng.integers(0, 3000, rng.integers(120, 400))]
        for c in range(3):
            copy = list(words)
            for _ in range(c * len(words) // 100):
                copy[rng.integers(0, len(copy))] = "changed"
            group[g].append(len(rows))
            rows.append((len(rows), " ".join(copy)))
    got = {r["doc_id"]: r["component_id"] for r in simhash.similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(got[m] == ids[0] for ids in group.values() for m in ids) >= 0.97 * len(rows)
    assert all(got[m] in ids for ids in group.values() for m in ids)
