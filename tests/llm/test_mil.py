import math
import zlib
from collections import Counter

import numpy as np

from editloom.llm import mil
from editloom.llm.wordhash import BASE

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = mil.classify(docs, mil.fit(docs, labels)).join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    mine = [r for r in rows if r["held_out"]]
    assert np.mean([r["predicted"] == r["quality"] for r in mine]) > 0.97
    assert np.mean([r["predicted"] for r in mine if r["quality"] == 1]) > 0.98
    assert all((r["score"] >= 0.7) == (r["predicted"] == 1) and 0 <= r["score"] <= 1 for r in rows)


def test_held_out_labels_do_not_matter(spark, docs):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 4 = 2 THEN 1 - quality ELSE quality END AS quality")
    a, b = mil.fit(docs, labels), mil.fit(docs, turned)
    assert all((a.weights[k] == b.weights[k]).all() for k in a.weights)


def test_gradient_step_lowers_the_loss():
    rng = np.random.default_rng(0)
    first = np.array([0, 3, 4, 9, 12] * 1)
    x = rng.standard_normal((12, mil.DIM)).astype(np.float32)
    y = np.array([0.0, 1, 1, 0])
    m = mil.train(np.concatenate([x] * 20), np.concatenate([[0], np.cumsum(np.tile(np.diff(first), 20))]), np.tile(y, 20))
    s = 1 / (1 + np.exp(-m.forward((x - m.mean) / m.scale, first)["y"]))
    assert ((s > 0.5) == y).all()


def test_passages_are_the_same_alone_and_together(docs):
    rows = [r["text"].encode() for r in docs.collect()[:60]] + [b"", b"   ", b"one"]
    x, first = mil.passages(rows)
    for i, t in enumerate(rows):
        assert np.allclose(mil.passages([t])[0], x[first[i] : first[i + 1]], atol=1e-5)


def test_edge_rows(spark, edge_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (None, 1, None), (4, None, 1), (8, 0, 0), (99, 1, 0), (5, 1, 0)], "doc_id long, quality int, toxic int")
    for labels in (none, odd):
        rows = mil.classify(edge_docs, mil.fit(edge_docs, labels)).collect()
        assert len(rows) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert mil.classify(no_docs, mil.fit(no_docs, odd)).count() == 0


def plain_features(text):
    """Features of each passage of a text, word by word."""
    data = text + b" "
    spans, at = [], 0
    for w in text.split():
        at = text.index(w, at)
        spans.append((at, at + len(w)))
        at += len(w)
    if not spans:
        x = np.zeros((1, mil.DIM))
        x[0, -1] = 1
        return x

    def digest(w):
        h = sum((b + 1) * pow(BASE, i, 2**64) for i, b in enumerate(w)) % 2**64
        h ^= h >> 29
        h = h * 0xBF58476D1CE4E5B9 % 2**64
        return h ^ (h >> 32)

    words = [text[a:b] for a, b in spans]
    k, out, seen, again = len(mil.CLASS_NAMES), [], set(), set()
    for i in range(len(words) - 2):
        if tuple(words[i : i + 3]) in seen:
            again.add(i)
        seen.add(tuple(words[i : i + 3]))
    for p in range(0, len(words), mil.PASSAGE):
        own = range(p, min(p + mil.PASSAGE, len(words)))
        stop = spans[own[-1] + 1][0] if own[-1] + 1 < len(words) else len(data)
        classes = Counter(int(mil.CLASSES[b]) for b in data[spans[p][0] : stop])
        n, total = len(own), max(1, sum(classes.values()))
        x = np.zeros(mil.DIM)
        for c, m in classes.items():
            x[c] = math.sqrt(m / total)
        size = [len(words[i]) for i in own]
        mean = sum(size) / n
        x[k] = mean / 8
        x[k + 1] = math.sqrt(max(0, sum(s * s for s in size) / n - mean**2)) / 8
        x[k + 2] = sum(i > 0 and words[i] == words[i - 1] for i in own) / n
        x[k + 3] = len({words[i] for i in own}) / n
        x[k + 4] = sum(i in again for i in own) / n
        x[k + 5] = sum(mil.CLASSES[words[i][0]] == 1 for i in own) / n
        x[k + 6] = sum(mil.CLASSES[words[i][-1]] > 4 for i in own) / n
        x[k + 7] = min(n / mil.PASSAGE, 1)
        for i in own:
            h = digest(words[i])
            x[k + 8 + (h >> 58) % mil.HASHED] += (1 if h >> 40 & 1 else -1) / math.sqrt(n) / 4
        out.append(x)
    return np.array(out)


def plain_score(model, text):
    """Gated attention over the passages, one at a time."""
    p, weights, vectors = model.weights, [], []
    for x in plain_features(text):
        z = np.tanh((x - model.mean) / model.scale @ p["e"] + p["eb"])
        weights.append(math.exp(max(-30, min(30, float((np.tanh(z @ p["v"]) / (1 + np.exp(-(z @ p["u"])))) @ p["w"])))))
        vectors.append(z)
    bag = sum(w * z for w, z in zip(weights, vectors, strict=True)) / sum(weights)
    return 1 / (1 + math.exp(-(float(bag @ p["c"]) + float(p["d"][0]))))


def test_query_equals_a_plain_version(spark, docs, edge_docs):
    """Features, attention and scores of every document, word by word."""
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    both = docs.unionByName(edge_docs.withColumn("doc_id", edge_docs.doc_id + 10_000), allowMissingColumns=True)
    model = mil.fit(docs, labels)
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, round(r["score"], 3), r["held_out"]) for r in mil.classify(both, model).collect())
    want = []
    for r in both.collect():
        d = r["doc_id"]
        want.append((d is None, d or 0, plain_score(model, (r["text"] or "").encode()), d is not None and zlib.crc32(str(d).encode()) % 4 == 2))
    want.sort(key=lambda r: (r[0], r[1], round(r[2], 3)))
    assert [g[:2] + g[3:] for g in got] == [w[:2] + w[3:] for w in want]
    assert np.allclose([g[2] for g in got], [w[2] for w in want], atol=2e-3)


def test_all_passages_of_labelled_documents_are_learned_from(spark):
    """A document whose junk lies behind its 64th passage."""
    clean, junk = "the quiet river runs along ", "$$$ ### BUY!!! "
    rows = [(i, clean * 40) for i in range(60)] + [(100 + i, clean * 900 + junk * 60) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(d, int(d < 100)) for d, _ in rows] + [(10**6 + i, 1) for i in range(500)], "doc_id long, quality int")
    model = mil.fit(docs, labels, train_docs=90)
    s = model.score([r[1].encode() for r in rows])
    assert s[:60].min() > s[60:].max()
