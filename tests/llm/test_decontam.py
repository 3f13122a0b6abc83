import random
from collections import Counter

from editloom.llm import decontam


def plain(docs, items, t=0.8, size=5):
    out = set()

    def sh(text, k):
        w = (text or "").encode().lower().split()
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}

    for item, text in items:
        n = len((text or "").split())
        if not n:
            continue
        own = sh(text, min(size, n))
        for doc, body in docs:
            shared = len(own & sh(body, min(size, n)))
            if shared >= t * len(own) - 1e-9:
                out.add((doc, item, len(own), shared))
    return out


def test_equals_brute_force(spark, docs):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    rng = random.Random(2)
    more, words = [], [w for (t,) in items.select("text").collect() for w in t.split()]
    for i, (item, text) in enumerate(items.select("item_id", "text").collect()):
        w = text.split()
        for k in range(i % 4 // 2):
            w[rng.randrange(len(w))] = rng.choice(words).upper()
        more.append((5000 + i, " ".join([*rng.choices(words, k=rng.randrange(300)), *w, *rng.choices(words, k=20)])))
    both = docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    items = items.select("item_id", "text").union(spark.createDataFrame([(900, "two words"), (901, ""), (902, None), (903, "Solo"), (903, "Solo")], "item_id long, text string"))
    want = plain([tuple(r) for r in both.collect()], [tuple(r) for r in items.collect()])
    got = decontam.contaminated(both, items).collect()
    assert {tuple(r)[:4] for r in got} == want and len(want) > 30


def test_blocks_of_items_give_the_same(spark, docs):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = items.union(items.limit(3)).select("item_id", "text")
    one = Counter(tuple(r) for r in decontam.contaminated(docs, items).collect())
    size = sum(len(t.encode()) for t in {r["text"] for r in items.collect()})
    blocks = list(decontam.indexes(items, block=size // 5))
    assert len(blocks) >= 5 and sum(len(b.item_ids) for b in blocks) == items.select("text").distinct().count()
    assert Counter(tuple(r) for r in decontam.contaminated(docs, items, block=size // 5).collect()) == one
    assert max(one.values()) == 1 or len(one) < sum(one.values())


def test_edges(spark, edge_docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contaminated(edge_docs, none).count() == 0
    one = spark.createDataFrame([(1, "THE same text here again")], "item_id long, text string")
    assert sorted(r["doc_id"] for r in decontam.contaminated(edge_docs, one).collect()) == [5, 6]
    assert decontam.contaminated(no_docs, one).count() == 0
