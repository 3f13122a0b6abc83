import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from editloom.llm import lm
from editloom.llm.common import materialise, texts, tokenizer_file

PATH = tokenizer_file("byte_bpe_50k.tiktoken")
LONG = " ".join(f"word{i} thing" for i in range(500))


def words(text):
    return (text or "").encode().lower().split()


def held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 10 == 0


def plain(rows):
    """What the contract says, but for the model's score."""
    c = Counter()
    for doc, text in rows:
        if not held(doc):
            c.update([*words(text), None])
    n, v = sum(c.values()), len(c)
    p = lambda w: math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1)))
    return [(doc, held(doc), len(w) + 1, sum(c[x] > 0 for x in [*w, None]), n, sum(map(p, [*w, None]))) for doc, w in ((d, words(t)) for d, t in rows)]


class Trained:
    """A model of some documents in one process, with every word's number and count."""

    def __init__(self, training, most=10**6):
        self.counts = materialise(lm.word_counts(training), "w")
        hot = lm.hot_words(self.counts, most)
        self.words, self.n = hot.column("word").to_pylist(), hot.column("n").to_numpy()
        spark = training.sparkSession.sparkContext
        shipped = spark.broadcast((self.words, self.n, 1.0))
        parts = lm.counts_in_words(self.counts, PATH).unionByName(lm.pairs_in_texts(training, shipped, PATH, "test"))
        self.made = lm.summed(parts)
        self.made[lm.FIRST][lm.END] = training.count()
        m = self.made
        self.tables = lm.build(m[lm.FIRST], m[lm.KINDS], m[lm.PAIRS], m[lm.ACROSS], m[lm.FAR])
        rng = np.random.default_rng(5)
        start = lm.Learned.start()
        self.learned = start.like(start.flat() + 0.3 * rng.standard_normal(len(start.flat())))
        self.model = lm.Attention(self.tables, self.learned)
        self.table = lm.WordTable(PATH, self.words)
        self.count = dict(zip(self.words, self.n.tolist(), strict=True))

    def completion(self, word):
        """log10 of the share of a word (None: the end) among those that begin as it does."""
        if word is None:
            return 0.0
        size, ids = lm.word_ids(PATH, [word])
        n = self.count.get(word, 0)
        return float(lm.completions(self.tables, ids[:1], np.array([n]), self.tables.spelling(size, ids))[0])

    def token(self, before, word):
        """log10 probability of `word` after the words before it (None: the start), by the formula of the model."""
        ids = lambda w: [lm.END] if w is None else lm.word_ids(PATH, [w])[1].tolist()
        p, t = self.learned, self.tables
        last, begin = ids(before[-1])[-1], ids(word)[0]
        e, begins, pointed = [math.exp(p.own[last])], [float(t.begins[last, begin])], [0.0]
        for lag, w in enumerate(reversed(before)):
            key = ids(w)[0]
            gate = 0.0 if w is None else 1 / (1 + math.exp(-p.gate[key]))
            e.append(math.exp(float(p.q[last] @ p.k[key]) + p.b[key] + p.pos[lag]))
            begins.append((1 - gate) * float(t.mixtures[key] @ t.factors[begin]))
            pointed.append(gate * (w == word and w is not None))
        share = lambda v: sum(a * b for a, b in zip(e, v, strict=True)) / sum(e)
        return math.log10(share(begins) * 10 ** self.completion(word) + share(pointed))

    def text(self, doc):
        """log10 probability, token by token, each with the words its window shows it."""
        x, out = [None, *doc], 0.0
        for i, w in enumerate([*doc, None]):
            out += self.token(x[max(0, i // lm.STRIDE * lm.STRIDE - lm.CONTEXT) : i + 1], w)
        return out

    def score(self, docs):
        block = lm.Block(self.table, [b" ".join(d) for d in docs])
        first = block.first[block.hot : -1]
        done = np.append(lm.completions(self.tables, self.table.first, self.n, self.tables.spelling(*self.table.ids)), 0.0)
        with np.errstate(divide="ignore"):
            return self.model.score(block, done, np.log10(self.tables.unit)[first], self.tables.spelled[first] + self.tables.spelling(*block.ids))


@pytest.fixture(scope="module")
def trained(spark, docs):
    return Trained(texts(docs).filter(~lm.held_out()))


@pytest.mark.parametrize("hot", [300_000, 50])
def test_base_equals_counting_by_hand(spark, docs, hot):
    got = sorted(tuple(r) for r in lm.score(docs, hot_words_=hot).collect())
    want = sorted(plain([(r["doc_id"], r["text"]) for r in docs.collect()]))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-12)
    assert all(g[6] < 0 for g in got)


def test_joined_words_score_as_shipped_ones(docs):
    """How many words go to the tasks changes where a count comes from, not the score. (Untrained: training takes a mean
    count for words it has not.)"""
    few, many = ({r["doc_id"]: r["score"] for r in lm.score(docs, hot_words_=k, rounds=0).collect()} for k in (50, 10**6))
    assert few.keys() == many.keys()
    assert np.allclose([few[k] for k in few], [many[k] for k in few], rtol=1e-5)


def test_windows_score_each_token_once_and_alone(trained):
    some = trained.words[:40]
    rng = np.random.default_rng(2)
    docs = [[some[i] for i in rng.integers(0, len(some), n)] for n in (0, 1, 5, 15, 16, 17, 70)] + [[b"neverseen", some[0], b"neverseen", b"qz" * 2000]]
    scores, tail, unit, rest = trained.score(docs)
    assert np.allclose(scores[:-1], [trained.score([d])[0][0] for d in docs[:-1]], rtol=1e-5)
    assert np.allclose(scores[:-1], [trained.text(d) for d in docs[:-1]], rtol=1e-4)
    # words without a count leave the block: what they have without one
    assert len(tail) == 3
    first = scores[-1] + rest[:2].sum()
    assert np.isclose(first, trained.text(docs[-1][:3]) - trained.token([None, *docs[-1][:3]], None) + trained.token([None, *docs[-1]], None), atol=1e-3)
    assert np.isfinite(rest).all() and rest[2] < -1000


def test_probabilities_of_all_words_add_up(trained):
    """All words with a count, and all others by how they are spelled: up to two subwords here, beyond by what is left."""
    before = [None, trained.words[0], trained.words[3]]
    known = sum(10 ** trained.token(before, w) for w in [*trained.words, None])
    spelled_of_known, free = {}, 0.0
    t = trained.tables
    size, ids = lm.word_ids(PATH, trained.words)
    for w, s, b in zip(trained.words, 10 ** t.spelling(size, ids), ids[np.cumsum(size) - size].tolist(), strict=True):
        spelled_of_known[b] = spelled_of_known.get(b, 0) + s
    p, last = trained.learned, lm.word_ids(PATH, [before[-1]])[1][-1]
    begin = t.begins[last].astype(float) * math.exp(p.own[last])
    total = math.exp(p.own[last])
    for lag, w in enumerate(reversed(before)):
        key = lm.END if w is None else lm.word_ids(PATH, [w])[1][0]
        gate = 0.0 if w is None else 1 / (1 + math.exp(-p.gate[key]))
        e = math.exp(float(p.q[last] @ p.k[key]) + p.b[key] + p.pos[lag])
        begin += e * (1 - gate) * (t.factors @ t.mixtures[key])
        total += e
    for b in range(lm.RANKS):  # what spellings of other words take
        free += begin[b] / total * 10 ** t.spelled[b] * (1 - spelled_of_known.get(b, 0))
    assert abs(known + free - 1) < 1e-3
    assert np.allclose((10.0**t.spell.astype(float)).sum(1), 1, atol=1e-4) and np.allclose(t.begins.sum(1), 1, atol=1e-4)


def test_gradients_equal_differences(trained):
    docs = [[trained.words[i] for i in (0, 5, 0, 9, 9, 2, 5, 7) * 5], [trained.words[3]]]
    block = lm.Block(trained.table, [b" ".join(d) for d in docs])
    x = block.windows()
    parts = (x.key, x.query, x.seen, x.begin, x.outcome)
    done = np.append(10 ** lm.completions(trained.tables, trained.table.first, trained.n, trained.tables.spelling(*trained.table.ids)), 1.0)[x.outcome].astype(np.float32)
    loss = lambda p: lm.gradients(lm.Attention(trained.tables, p), parts, done, x.real)[0]
    _, grad = lm.gradients(trained.model, parts, done, x.real)
    flat = trained.learned.flat()
    want = np.concatenate([grad[n].ravel() for n in vars(trained.learned)])
    picks = np.argsort(-np.abs(want))[:40].tolist() + [len(flat) - lm.SPAN + 1, len(flat) - 1]
    for i in picks:
        up, down = flat.copy(), flat.copy()
        up[i] += 1e-2
        down[i] -= 1e-2
        found = (loss(trained.learned.like(up)) - loss(trained.learned.like(down))) / 2e-2
        assert abs(found - want[i]) < 2e-4 + 0.03 * abs(want[i]), i
    assert np.abs(want).max() > 1e-2


def held_out_means(spark, scale, rounds):
    """Digits a token by the model and by the base."""
    docs = spark.read.parquet(f"/root/testdata/{scale}/documents.parquet")
    return lm.score(docs, rounds=rounds).filter("held_out").agg(F.sum("score") / F.sum("n_tokens"), F.sum("base_score") / F.sum("n_tokens")).first()


def test_training_beats_no_training_and_the_base(spark):
    (trained, base), (untrained, _) = (held_out_means(spark, "sf0.01", r) for r in (1, 0))
    assert trained > untrained + 0.03
    assert trained > base


def test_more_text_gives_more_over_the_base(spark):
    trained, base = held_out_means(spark, "sf0.1", 1)
    assert trained > base + 0.15


def test_whole_texts_are_counted_and_learned_from(spark):
    train = spark.createDataFrame([(1, LONG), (2, ""), (3, "a b")], "doc_id long, text string")
    assert Trained(train, most=10).made[lm.ACROSS].sum() == 1000 + 1 + 1 + 2 + 1
    t = Trained(train)
    assert t.made[lm.ACROSS].sum() == 1005
    far = sum(max(0, n - d) for n in (1001, 1, 3) for d in range(1, lm.LAGS + 1))
    assert t.made[lm.FAR].sum() == far
    assert t.made[lm.FIRST].sum() == 1002 + 3 and t.made[lm.KINDS].sum() == 503
    block = lm.Block(t.table, [LONG.encode(), b"", b"a b"])
    x = block.windows()
    assert x.real.sum() == 1005 and sorted(x.outcome[x.real].tolist()) == sorted(block.number.tolist())
    numbers = block.number[:1001].tolist()
    for k in range(63):  # every window of the first text by hand
        a = k * lm.STRIDE
        before = [-2, *numbers[:-1]]
        want = [-2] * max(0, lm.CONTEXT - a) + before[max(0, a - lm.CONTEXT) : a + lm.STRIDE]
        assert x.seen[k].tolist() == (want + [-2] * lm.SPAN)[: lm.SPAN]


def test_numbers_of_words_equal_a_plain_lookup(monkeypatch):
    rng = random.Random(4)
    hot = [bytes(rng.choices(b"ab\xc3\xa9z", k=rng.randrange(1, 30))) for _ in range(3000)]
    hot = [w for w in dict.fromkeys(hot) if _utf8(w)]
    table = lm.WordTable(PATH, hot)
    some = hot + [w + b"q" for w in hot[:500]] + [w[:20] + b"#" + w[21:] for w in hot if len(w) > 22]
    texts_ = [b"".join(rng.choice(some).upper() + rng.choice([b" ", b"\n\t", b"\x0b"]) for _ in range(rng.randrange(300))) for _ in range(40)] + [b"", b"  ", b"x" * 5000]
    for most in (1 << 20, 50):
        monkeypatch.setattr(lm.pieces, "__defaults__", (most,))
        block = lm.Block(table, texts_)
        place = dict(zip(hot, range(len(hot)), strict=True))
        at = 0
        for t, size in zip(texts_, block.size.tolist(), strict=True):
            own = t.lower().split()
            assert size == len(own) + 1 and block.number[at + size - 1] == -1
            got = [block.fresh[n - block.hot] if n >= block.hot else hot[n] for n in block.number[at : at + size - 1].tolist()]
            assert got == own and all((n < block.hot) == (w in place) for n, w in zip(block.number[at : at + size - 1].tolist(), own, strict=True))
            at += size


def _utf8(word):
    try:
        word.decode()
    except UnicodeDecodeError:
        return False
    return word == word.lower()


def test_hot_words_are_those_of_great_counts(spark):
    counts = spark.createDataFrame([(bytearray(b"w%d" % i), n) for i, n in enumerate([10**6, 10**6, 200_000, 7, 7, 7, 3, 3, 1])] + [(bytearray(lm.END_WORD), 5)], "word binary, n long")
    for most, want in ((9, 9), (8, 8), (7, 6), (6, 6), (5, 3), (3, 3), (2, 0)):
        got = lm.hot_words(counts, most)
        assert got.num_rows == want and lm.END_WORD not in got.column("word").to_pylist()


def test_edge_rows(spark, edge_docs, no_docs):
    rows = edge_docs.collect()
    key = lambda r: repr(r[:5])
    made = lm.score(edge_docs).collect()
    got = sorted((tuple(r) for r in made), key=key)
    want = sorted(plain([(r["doc_id"], r["text"]) for r in rows]), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want])
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in made)
    assert lm.score(no_docs).count() == 0
    only_held = spark.createDataFrame([(i, "a b") for i in range(40) if held(i)], "doc_id long, text string")
    assert all(r["base_score"] == 0 and r["train_tokens"] == 0 and r["n_known"] == 0 and math.isfinite(r["score"]) for r in lm.score(only_held).collect())
