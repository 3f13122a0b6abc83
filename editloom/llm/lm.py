"""Scores of texts by a small causal self-attention model on subword ids, beside a word unigram base.

A text is its lower-cased words and one end. A word is the subwords of its bytes behind a space, by the first RANKS ranks of a
public byte-level vocabulary, which by themselves are a valid smaller one. The model attends from the last subword of a word
to the first subwords of this word and of those before it, and to a slot of its own, with weights
softmax(q[last] . k[first_j] + b[first_j] + pos[t - j]; own[last]), and gives the next word. What a position gives is a
distribution over words:

- the word before j itself, with the share gate[first_j] (a pointer);
- else a mixture of FACTORS distributions of first subwords, and with it the word's completion;
- the slot: first subwords that follow the last subword, and the completion.

The completion of a first subword is the words that begin so, by their counts, and with Witten and Bell's share of kinds a
spelling by pairs of subwords up to the word's end. Weighted by attention that is a probability over all words.

What the values count is counted over the whole training corpus. q, k, b, pos, own and gate are learned by Adam, with gradients
in numpy, on all windows of all training documents: each task trains on its own from the same start, and weights are
averaged by windows.

A text is scored in windows of STRIDE words with CONTEXT words before them, so every token is scored once; windows are batched,
keys before the text or after the query are masked. Tables that go to tasks are bounded by SIZE squared, DIM and HOT_WORDS;
counts of all other words are joined, so that no word's count is left out.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import read_ranks
from .common import materialise, raw, slices, texts, tokenizer_file
from .hashtable import HashTable
from .wordhash import Words

RANKS = 2047
END, PAD, SIZE = RANKS, RANKS + 1, RANKS + 1  # END also stands for the start of a text; PAD is no id
EOW = SIZE  # as a successor: the word ends here
STRIDE, CONTEXT = 16, 16
SPAN = STRIDE + CONTEXT
DIM, FACTORS = 8, 8
LAGS = 8  # words apart whose first subwords are counted together
BEGIN_WEIGHT = 100.0  # of first subwords as such against what follows a certain last subword
SPELL_WEIGHT = 5.0  # of second subwords as such against what follows a certain subword
RATE, BATCH, ROUNDS, MOST = 0.04, 256, 1, 2.5
HOT_WORDS = 500_000  # words whose counts go to every task at most; all others are joined
END_WORD = b" "  # no word holds a space
FLUSH = 400_000
CHUNKS = 64  # parts of a table of pairs on its way


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(False))


# words and subwords


@lru_cache(maxsize=1)
def subwords(path: str):
    import tiktoken

    ranks = {k: v for k, v in read_ranks(path).items() if v < RANKS}
    return tiktoken.Encoding("subwords", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})


def some(words: list[bytes], many: int = 20_000) -> Iterator[list[bytes]]:
    """Parts of a long list, so that what is made on the way to arrays stays small."""
    for k in range(0, len(words), many):
        yield words[k : k + many]


def word_ids(path: str, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(how many ids each word has, the ids of all)."""
    enc = subwords(path).encode_ordinary
    size, flat = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
    for part in some(words):
        ids = [enc(" " + w.decode()) for w in part]
        size.append(np.fromiter(map(len, ids), np.int64, len(ids)))
        flat.append(np.fromiter(chain.from_iterable(ids), np.int32))
    return np.concatenate(size), np.concatenate(flat)


GAP = re.compile(rb"[ \t-\r]")
MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def pieces(texts: list[bytes], most: int = 1 << 20) -> Iterator[tuple[list[bytes], list[int]]]:
    """(parts of about `most` bytes together, the text each is of). A longer text is cut, never within a word."""
    held: list[bytes] = []
    of: list[int] = []
    size = 0
    for i, text in enumerate(texts):
        at = 0
        while True:
            stop = len(text)
            if stop - at > most and (m := GAP.search(text, at + most)):
                stop = m.start()
            held.append(text[at:stop] if at or stop < len(text) else text)
            of.append(i)
            size += stop - at
            at = stop
            if size >= most:
                yield held, of
                held, of, size = [], [], 0
            if at >= len(text):
                break
    if held:
        yield held, of


def edges(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes, first and last eight bytes of the words of some data: all there is of words of up to 16 bytes."""
    size = w.ends - w.starts
    eight = np.ndarray((len(w.data) + 1,), "<u8", w.data + b"\0" * 8, strides=(1,))
    return size, eight[w.starts] & MASK[np.minimum(size, 8)], eight[np.maximum(w.ends - 8, 0)] * (size > 8)


class WordTable:
    """Numbers, first and last ids of the hot words."""

    def __init__(self, path: str, hot: list[bytes]):
        self.path, self.words = path, hot
        self.ids = word_ids(path, hot)
        stop = np.cumsum(self.ids[0])
        self.first, self.last = self.ids[1][stop - self.ids[0]], self.ids[1][stop - 1]
        parts = [(w.hashes(), *edges(w)) for w in map(Words, some(hot))]
        hashes, *self.edges = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else [np.zeros(0, np.uint64)] * 4
        self.places = HashTable(hashes, np.arange(1, len(hot) + 1))

    def numbers(self, w: Words) -> np.ndarray:
        """Of each word, -1 for one that is not there. Hashes propose, bytes decide."""
        n = self.places.find(w.hashes()).astype(np.int64) - 1
        if not self.words:
            return n
        own = edges(w)
        for x, y in zip(own, self.edges, strict=True):
            n[(n >= 0) & (x != y[n])] = -1
        for i in np.flatnonzero((n >= 0) & (own[0] > 16)).tolist():
            if w.data[w.starts[i] : w.ends[i]] != self.words[n[i]]:
                n[i] = -1
        return n


class Block:
    """Words of some texts. number: of each text's words, END behind each; from `hot` on words beyond the table. first, last:
    ids by number, END at the end, for number -1; size: tokens of each text."""

    def __init__(self, table: WordTable, texts: list[bytes]):
        self.hot = len(table.words)
        fresh: dict[bytes, int] = {}
        numbers, size = [], np.zeros(len(texts), np.int64)
        for parts, of in pieces(texts):
            w = Words(parts)
            n = table.numbers(w)
            miss = np.flatnonzero(n < 0)
            n[miss] = [self.hot + fresh.setdefault(w.data[a:b], len(fresh)) for a, b in zip(w.starts[miss].tolist(), w.ends[miss].tolist(), strict=True)]
            numbers.append(n)
            np.add.at(size, of, np.diff(w.first))
        self.fresh = list(fresh)
        ids = word_ids(table.path, self.fresh)
        stop = np.cumsum(ids[0])
        self.first = np.concatenate([table.first, ids[1][stop - ids[0]], [END]])
        self.last = np.concatenate([table.last, ids[1][stop - 1], [END]])
        self.ids, self.size = ids, size + 1
        self.number = np.insert(np.concatenate(numbers), np.cumsum(size), -1)

    def windows(self) -> Windows:
        return Windows(self)


class Windows:
    """A block's tokens in rows of STRIDE; every document starts a row. key, query, seen: windows of first ids, last ids and
    numbers of what is before each token; outcome: number of each token (-1: the end), place: where each token is."""

    def __init__(self, block: Block):
        size, n = block.size, len(block.number)
        rows = -(-size // STRIDE)
        first = np.cumsum(rows) - rows
        start = np.cumsum(size) - size
        self.place = np.arange(n) + np.repeat(first * STRIDE - start, size)
        many = int(rows.sum())
        before = np.empty(n, np.int64)
        before[1:] = block.number[:-1]
        before[start] = -1
        blank = lambda fill, kind: np.full((many, SPAN), fill, kind)
        self.key, self.seen = blank(PAD, np.int32), blank(-2, np.int32)
        self.query = np.full((many, STRIDE), PAD, np.int32)
        own = np.empty(many * STRIDE, np.int32)
        for out, values, fill in ((self.key, block.first[before], PAD), (self.seen, before, -2)):
            own[:] = fill
            own[self.place] = values
            out[:, CONTEXT:] = own.reshape(many, STRIDE)
            out[1:, :CONTEXT] = out[:-1, SPAN - CONTEXT :]
            out[first, :CONTEXT] = fill
        self.query.reshape(-1)[self.place] = block.last[before]
        self.seen[self.seen == -1] = -2  # the start is no word to point at
        self.outcome = np.full((many, STRIDE), -1, np.int32)
        self.outcome.reshape(-1)[self.place] = block.number
        self.begin = np.full((many, STRIDE), END, np.int32)
        self.begin.reshape(-1)[self.place] = block.first[block.number]
        self.real = np.zeros((many, STRIDE), bool)
        self.real.reshape(-1)[self.place] = True


# the model


@dataclass
class Tables:
    """What is counted. begins: SIZE x SIZE, first subwords (or the end) after the last of a word; spell: log10 of SIZE x
    (SIZE + 1) successors within a word; mixtures (SIZE + 1) x FACTORS, factors SIZE x FACTORS; total, kinds: by first
    subword the words that begin so, and how many different ones."""

    begins: np.ndarray
    spell: np.ndarray
    mixtures: np.ndarray
    factors: np.ndarray
    total: np.ndarray
    kinds: np.ndarray

    def __post_init__(self) -> None:
        both = self.total + self.kinds
        # words of known count share the one, spellings the other; where nothing begins so all is spelled
        with np.errstate(divide="ignore", invalid="ignore"):
            self.unit = np.where(both > 0, 1 / both, 0.0)
            self.spelled = np.log10(np.where(both > 0, self.kinds / both, 1.0))

    def spelling(self, size: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """log10 probability of the subwords behind the first, and of the word's end."""
        if not len(size):
            return np.zeros(0)
        to = np.append(ids[1:], 0)
        stop = np.cumsum(size)
        to[stop - 1] = EOW
        return np.add.reduceat(self.spell[ids, to].astype(np.float64), stop - size)


@dataclass
class Learned:
    """q, k: (SIZE + 1) x DIM; b, own, gate: SIZE + 1; pos: SPAN."""

    q: np.ndarray
    k: np.ndarray
    b: np.ndarray
    own: np.ndarray
    gate: np.ndarray
    pos: np.ndarray

    @staticmethod
    def start(seed: int = 11) -> Learned:
        rng = np.random.default_rng(seed)
        small = lambda: (0.1 * rng.standard_normal((SIZE + 1, DIM))).astype(np.float32)
        flat = lambda x: np.full(SIZE + 1, x, np.float32)
        return Learned(small(), small(), flat(0), flat(np.log(SPAN / 2)), flat(-2), np.zeros(SPAN, np.float32))

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in vars(self).values()])

    def like(self, flat: np.ndarray) -> Learned:
        out, at = {}, 0
        for n, x in vars(self).items():
            out[n] = flat[at : at + x.size].reshape(x.shape).astype(np.float32, copy=False)
            at += x.size
        return Learned(**out)


LAG = np.arange(STRIDE)[:, None] + CONTEXT - np.arange(SPAN)[None, :]


class Attention:
    def __init__(self, tables: Tables, learned: Learned):
        self.t, self.p = tables, learned
        self.rows = np.concatenate([learned.q, np.ones((SIZE + 1, 1), np.float32)], 1)
        b = learned.b.copy()
        b[PAD] = -np.inf
        self.columns = np.concatenate([learned.k, b[:, None]], 1)
        self.bias = np.where(LAG >= 0, learned.pos[np.clip(LAG, 0, SPAN - 1)], -np.inf).astype(np.float32)
        gate = 1 / (1 + np.exp(-learned.gate))
        gate[END] = 0  # nothing to point at
        self.gate = gate.astype(np.float32)
        mixed = tables.mixtures * (1 - self.gate)[:, None]
        self.mixed = np.concatenate([mixed, np.ones((SIZE + 1, 1))], 1).astype(np.float32)  # the last sums the weights
        self.own = np.exp(learned.own)

    def weights(self, key: np.ndarray, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Unnormalised attention to positions (windows, STRIDE, SPAN) and to the slot (windows, STRIDE)."""
        s = np.matmul(self.rows[query], self.columns[key].transpose(0, 2, 1))
        s += self.bias
        return np.exp(s, out=s), self.own[query]

    def forward(self, key: np.ndarray, query: np.ndarray, seen: np.ndarray, begin: np.ndarray, outcome: np.ndarray) -> dict[str, np.ndarray]:
        """e, slot and their total; begins, pointed: probability that a word begins as the outcome does and is completed, and
        that it is pointed at; slots: the slot's part of begins; at, row, own: where an outcome was seen in the window, among
        all weights, among all tokens and among all keys."""
        e, slot = self.weights(key, query)
        mixed = np.matmul(e, self.mixed[key])
        total = mixed[:, :, -1] + slot
        slots = self.t.begins[np.minimum(query, END), begin]
        begins = np.einsum("nrf,nrf->nr", mixed[:, :, :-1], self.t.factors[begin]) + slot * slots
        at = np.flatnonzero(seen[:, None, :] == outcome[:, :, None])
        row, own = at // SPAN, at // (STRIDE * SPAN) * SPAN + at % SPAN
        pointed = np.bincount(row, e.ravel()[at] * self.gate[key.ravel()[own]], total.size).reshape(total.shape)
        return {"e": e, "slot": slot, "total": total, "slots": slots, "begins": begins / total, "pointed": pointed / total, "at": at, "row": row, "own": own}

    def score(self, block: Block, log_completion: np.ndarray, log_unit: np.ndarray, log_spelled: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(log10 probability of each document without its words beyond the table, and of those words, in order, the token's
        place in the block, log10 of what a count of one gives, log10 of what it has without a count)."""
        x = block.windows()
        begins, pointed = np.empty(x.query.shape), np.empty(x.query.shape)
        for a in range(0, len(x.query), 256):
            s = slice(a, a + 256)
            o = self.forward(x.key[s], x.query[s], x.seen[s], x.begin[s], x.outcome[s])
            begins[s], pointed[s] = o["begins"], o["pointed"]
        begins, pointed = np.log10(begins.reshape(-1)[x.place]), pointed.reshape(-1)[x.place]
        tail = np.flatnonzero(block.number >= block.hot)
        lp = begins + log_completion[np.where(block.number < block.hot, block.number, -1)]
        at = np.flatnonzero(pointed > 0)
        with np.errstate(divide="ignore"):
            lp[at] = np.logaddexp(lp[at] * LN10, np.log(pointed[at])) / LN10
            fresh = block.number[tail] - block.hot
            base = np.logaddexp((begins[tail] + log_spelled[fresh]) * LN10, np.log(pointed[tail])) / LN10
        lp[tail] = 0
        return np.add.reduceat(lp, np.cumsum(block.size) - block.size), tail, begins[tail] + log_unit[fresh], base


LN10 = np.log(10.0)


def completions(t: Tables, first: np.ndarray, count: np.ndarray, spelling: np.ndarray) -> np.ndarray:
    """log10 of the share a word of this count and spelling has among those that begin as it does."""
    return np.log10(count * t.unit[first] + 10.0 ** np.maximum(t.spelled[first] + spelling, -300))


def gradients(model: Attention, x: tuple[np.ndarray, ...], completion: np.ndarray, real: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """(mean loss in nats over the real tokens, its gradient by what is learned)."""
    key, query, _, begin, _ = x
    p, t, many = model.p, model.t, max(1, int(real.sum()))
    o = model.forward(*x)
    prob = np.maximum(o["begins"] * completion + o["pointed"], 1e-30)
    scale = (real / (many * prob * o["total"])).astype(np.float32)
    a = o["e"]
    a *= scale[:, :, None]  # what a unit of value gives to the loss, negative
    keys, gate = model.mixed[key], model.gate[key]
    value = np.matmul(t.factors[begin] * completion[:, :, None], keys[:, :, :-1].transpose(0, 2, 1))
    at, own = o["at"], o["own"]
    pointing = np.bincount(own, a.ravel()[at], key.size).reshape(key.shape)
    value.reshape(-1)[at] += gate.ravel()[own]
    prob = prob.astype(np.float32)
    value -= prob[:, :, None]
    value *= a
    down = value.sum(1)  # of each key
    # values summed over queries, less what was pointed at: (1 - gate) times the topics
    topics = down + np.matmul(prob[:, None, :], a)[:, 0] - gate * pointing
    g_gate = -gate * ((1 - gate) * pointing - topics)
    flat_q, flat_k = query.ravel(), key.ravel()
    by = lambda ids, v: np.bincount(ids, v, SIZE + 1).astype(np.float32)
    gq = np.ascontiguousarray(np.matmul(value, p.k[key]).reshape(-1, DIM).T)
    gk = np.ascontiguousarray(np.matmul(value.transpose(0, 2, 1), p.q[query]).reshape(-1, DIM).T)
    grad = {
        "q": -np.stack([by(flat_q, v) for v in gq], 1),
        "k": -np.stack([by(flat_k, v) for v in gk], 1),
        "b": -by(flat_k, down.ravel()),
        "own": by(flat_q, (-o["slot"] * scale * (o["slots"] * completion - prob)).ravel()),
        "gate": by(flat_k, g_gate.ravel()),
        "pos": -np.bincount(np.clip(LAG, 0, SPAN - 1).ravel(), np.where(LAG >= 0, value.sum(0), 0).ravel(), SPAN).astype(np.float32),
    }
    grad["gate"][END] = 0
    return float(-(np.log(prob) * real).sum() / many), grad


class Adam:
    def __init__(self, tables: Tables, learned: Learned, rate: float):
        self.tables, self.learned, self.rate, self.step = tables, learned, rate, 0
        self.flat = learned.flat()
        self.m, self.v = np.zeros_like(self.flat), np.zeros_like(self.flat)
        # sums of products stay below what exp of a 32-bit float holds
        self.most = np.concatenate([np.full(x.size, MOST if n in ("q", "k") else 6.0, np.float32) for n, x in vars(learned).items()])

    def windows(self, x: Windows, completion: np.ndarray) -> None:
        """One pass over the windows, in an order of their own."""
        order = np.random.default_rng(self.step).permutation(len(x.query))
        for a in range(0, len(order), BATCH):
            s = order[a : a + BATCH]
            _, grad = gradients(Attention(self.tables, self.learned), (x.key[s], x.query[s], x.seen[s], x.begin[s], x.outcome[s]), completion[s], x.real[s])
            g = np.concatenate([grad[n].ravel() for n in vars(self.learned)])
            self.step += 1
            self.m += np.float32(0.1) * (g - self.m)
            g *= g
            self.v += np.float32(0.01) * (g - self.v)
            down = np.sqrt(self.v * np.float32(1 / (1 - 0.99**self.step)))
            down += np.float32(1e-8)
            self.flat -= np.float32(self.rate / (1 - 0.9**self.step)) * self.m / down
            np.maximum(np.minimum(self.flat, self.most, out=self.flat), -self.most, out=self.flat)
            self.learned = self.learned.like(self.flat)


def build(first: np.ndarray, kinds: np.ndarray, pairs: np.ndarray, across: np.ndarray, far: np.ndarray) -> Tables:
    """first, kinds: SIZE; pairs: SIZE x (SIZE + 1) of subwords within different words; across, far: SIZE x SIZE."""
    starts = (first > 0) | (np.arange(SIZE) == END)  # ids that begin a word, and the end
    begin = (first + 0.1) / (first + 0.1).sum()
    begins = across + BEGIN_WEIGHT * begin
    begins = (begins / begins.sum(1, keepdims=True)).astype(np.float32)
    back = pairs.sum(0) + 0.1
    back[END] = 0
    spell = pairs + SPELL_WEIGHT * back / back.sum()
    spell[:, END] = 0
    with np.errstate(divide="ignore"):
        spell = np.log10(spell / spell.sum(1, keepdims=True)).astype(np.float32)
    rng = np.random.default_rng(11)
    far = far + 1e-3 * begin
    # expectation maximisation of far[x, y] = sum over f of weight[x, f] factor[f, y], on what begins words
    at = np.flatnonzero(starts)
    part = far[np.ix_(at, at)].astype(np.float32)
    w, f = (rng.random((len(at), FACTORS)) + 0.5).astype(np.float32), (rng.random((FACTORS, len(at))) + 0.5).astype(np.float32)
    w, f = w / w.sum(1, keepdims=True), f / f.sum(1, keepdims=True)
    for _ in range(40):
        ratio = part / np.maximum(w @ f, 1e-12)
        w, f = w * (ratio @ f.T), f * (w.T @ ratio)
        w, f = w / np.maximum(w.sum(1, keepdims=True), 1e-12), f / np.maximum(f.sum(1, keepdims=True), 1e-12)
    factors = np.zeros((FACTORS, SIZE))
    factors[:, at] = f
    factors = 0.98 * factors + 0.02 * begin
    mixtures = np.full((SIZE + 1, FACTORS), 1 / FACTORS)
    mixtures[at] = 0.98 * w / np.maximum(w.sum(1, keepdims=True), 1e-12) + 0.02 / FACTORS
    mixtures /= mixtures.sum(1, keepdims=True)
    factors /= factors.sum(1, keepdims=True)
    return Tables(begins, spell, mixtures.astype(np.float32), np.ascontiguousarray(factors.T).astype(np.float32), first.astype(np.float64), kinds.astype(np.float64))


# what is gathered from the corpus


def word_counts(train_docs: DataFrame) -> DataFrame:
    """word (binary), n over the given documents; END_WORD counts documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(count.keys()), pa.binary()), pa.array(list(count.values()), pa.int64())], ["word", "n"])
            count.clear()
            return made

        for batch in batches:
            for part in slices(batch):
                for text in raw(part.column("text")):
                    count.update(text.lower().split())
                    count[END_WORD] += 1
                    if len(count) > FLUSH:
                        yield out()
        if count:
            yield out()

    return train_docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


FIRST, KINDS, PAIRS, ACROSS, FAR = range(5)
SHAPES = {FIRST: (SIZE,), KINDS: (SIZE,), PAIRS: (SIZE, SIZE + 1), ACROSS: (SIZE, SIZE), FAR: (SIZE, SIZE)}
PART = "part int, counts binary"


class Tally:
    """Tables of counts in memory, and on their way as packed parts that are summed before they reach the driver."""

    def __init__(self, *kinds: int, most: int = 1 << 20):
        self.count = {k: np.zeros(int(np.prod(SHAPES[k])), np.int64) for k in kinds}
        self.held: dict[int, list[np.ndarray]] = {k: [] for k in kinds}
        self.size, self.most = dict.fromkeys(kinds, 0), most

    def add(self, kind: int, keys: np.ndarray) -> None:
        self.held[kind].append(keys)
        self.size[kind] += len(keys)
        if self.size[kind] > self.most:
            self.settle(kind)

    def settle(self, kind: int) -> None:
        if self.held[kind]:
            self.count[kind] += np.bincount(np.concatenate(self.held[kind]), minlength=len(self.count[kind]))
            self.held[kind], self.size[kind] = [], 0

    def parts(self) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=1)
        for kind, count in self.count.items():
            self.settle(kind)
            rows = [(kind * CHUNKS + i, z.compress(x.astype("<i8").tobytes())) for i, x in enumerate(np.array_split(count, CHUNKS)) if x.any()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["part", "counts"])


def summed(parts: DataFrame) -> dict[int, np.ndarray]:
    """The tables of all tasks together; parts of one place are added on the cluster."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        unzip = zstandard.ZstdDecompressor()
        for batch in batches:
            for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                x = np.frombuffer(unzip.decompress(counts), "<i8")
                total[part] = total[part] + x if part in total else x
        z = zstandard.ZstdCompressor(level=1)
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([z.compress(x.tobytes()) for x in total.values()], pa.binary())], ["part", "counts"])

    made = parts.repartition("part").mapInArrow(add, PART).toArrow()
    out = {k: np.zeros(int(np.prod(s)), np.int64) for k, s in SHAPES.items()}
    unzip = zstandard.ZstdDecompressor()
    for part, counts in zip(made.column("part").to_pylist(), made.column("counts").to_pylist(), strict=True):
        np.array_split(out[part // CHUNKS], CHUNKS)[part % CHUNKS][:] += np.frombuffer(unzip.decompress(counts), "<i8")
    return {k: out[k].reshape(s) for k, s in SHAPES.items()}


def counts_in_words(counts: DataFrame, path: str) -> DataFrame:
    """Parts of FIRST (weighted by the words' counts), KINDS and PAIRS (every different word once)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(FIRST, KINDS, PAIRS)
        for batch in batches:
            words = batch.column("word").to_pylist()
            size, ids = word_ids(path, words)
            if not len(size):
                continue
            stop = np.cumsum(size)
            first = ids[stop - size]
            # whole numbers beyond 2^53 would not survive floats: words are counted, not weighed
            np.add.at(tally.count[FIRST], first, batch.column("n").to_numpy())
            tally.add(KINDS, first)
            to = np.append(ids[1:], 0).astype(np.int64)
            to[stop - 1] = EOW
            tally.add(PAIRS, ids.astype(np.int64) * (SIZE + 1) + to)
        yield from tally.parts()

    return counts.filter(F.col("word") != F.lit(END_WORD)).select("word", "n").mapInArrow(run, PART)


_tables: dict[str, WordTable] = {}


def kept(key: str, path: str, words: list[bytes]) -> WordTable:
    """One table of hot words for all tasks of a Python worker."""
    if key not in _tables:
        _tables.clear()
        _tables[key] = WordTable(path, words)
    return _tables[key]


def blocks(batches: Iterator[pa.RecordBatch], table: WordTable) -> Iterator[tuple[pa.RecordBatch, Block]]:
    for batch in batches:
        for part in slices(batch):
            if part.num_rows:
                yield part, Block(table, raw(part.column("text")))


def pairs_in_texts(training: DataFrame, shipped, path: str, key: str) -> DataFrame:
    """Parts of ACROSS, what begins the next word after the last subword of a word, and of FAR, first subwords LAGS words apart or less."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(ACROSS, FAR)
        for _, block in blocks(batches, kept(key, path, shipped.value[0])):
            first, last = block.first[block.number].astype(np.int64), block.last[block.number].astype(np.int64)
            start = np.cumsum(block.size) - block.size
            before = np.empty_like(last)
            before[1:] = last[:-1]
            before[start] = END
            tally.add(ACROSS, before * SIZE + first)
            left = np.repeat(np.cumsum(block.size), block.size) - np.arange(len(first))  # tokens from here to the document's end
            for d in range(1, LAGS + 1):
                at = np.flatnonzero(left[:-d] > d) if d < len(first) else np.zeros(0, np.int64)
                tally.add(FAR, first[at] * SIZE + first[at + d])
        yield from tally.parts()

    return training.select("text").mapInArrow(run, PART)


def hot_words(counts: DataFrame, most: int) -> pa.Table:
    """The words above the least count that at most `most` words exceed; counts from 100,000 on are one class."""
    class_ = F.least("n", F.lit(100_000))
    words = counts.filter(F.col("word") != F.lit(END_WORD))
    seen, cut = 0, 0
    for r in sorted(words.groupBy(class_.alias("c")).count().collect(), key=lambda r: -r["c"]):
        seen += r["count"]
        if seen > most:
            cut = r["c"]
            break
    return words.filter(class_ > cut).select("word", "n").toArrow()


def learn(training: DataFrame, shipped, tables, path: str, key: str, rounds: int = ROUNDS, rate: float = RATE) -> Learned:
    """q, k, b, own, gate and pos after training on all windows of all training documents."""
    learned = Learned.start()
    for r in range(rounds):
        now, speed = learned, rate / (1 + 3 * r)

        def run(batches: Iterator[pa.RecordBatch], now=now, speed=speed) -> Iterator[pa.RecordBatch]:
            words, n, tail = shipped.value
            t, table = tables.value, kept(key, path, words)
            adam, windows = Adam(t, now, speed), 0
            hot = 10 ** completions(t, table.first, n, t.spelling(*table.ids))
            for _, block in blocks(batches, table):
                fresh = 10 ** completions(t, block.first[block.hot : -1], tail, t.spelling(*block.ids))
                x = block.windows()
                share = np.concatenate([hot, fresh, [1.0]])[x.outcome].astype(np.float32)
                adam.windows(x, share)
                windows += len(x.query)
            if windows:
                flat = adam.learned.flat().astype(np.float64)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat * windows), pa.array(np.full(len(flat), float(windows)))], ["at", "w", "n"])

        mean = training.select("text").mapInArrow(run, "at int, w double, n double").groupBy("at").agg((F.sum("w") / F.sum("n")).alias("w")).toArrow()
        if not mean.num_rows:
            break
        flat = np.zeros(mean.num_rows)
        flat[mean.column("at").to_numpy()] = mean.column("w").to_numpy()
        learned = learned.like(flat)
    return learned


# scoring


def score(docs: DataFrame, path: str | None = None, hot_words_: int = HOT_WORDS, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row.

    Null and empty texts are one token, the end. Rows without a doc_id are training rows. Repeated rows train and score
    as often as they come. Of a text of any length all tokens are counted, learned from and scored; memory follows the
    longest single text. Without training rows the base gives every token probability 1 and the model is untrained; an
    empty table gives no rows. Columns beside doc_id and text are not read, so none can clash.
    Counts of at most `hot_words_` words go to every task; the other words of a document leave it as rows that are
    joined with the counts, so the base and the model's completions are exact for all.
    """
    path = path or tokenizer_file("byte_bpe_50k.tiktoken")
    spark = docs.sparkSession.sparkContext
    rows = texts(docs, held_out().alias("held_out"))
    training = rows.filter(~F.col("held_out"))
    counts = materialise(word_counts(training), "words")
    n_all, n_distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    ends = (counts.filter(F.col("word") == F.lit(END_WORD)).select("n").first() or (0,))[0]
    hot = hot_words(counts, hot_words_)
    n_hot = hot.column("n").to_numpy()
    tail_words = n_distinct - (ends > 0) - len(n_hot)
    tail_mean = max(0.0, (n_all - ends - float(n_hot.sum())) / tail_words) if tail_words else 0.0
    key = xxhash.xxh64_hexdigest(os.urandom(16))
    shipped = spark.broadcast((hot.column("word").to_pylist(), n_hot, tail_mean))
    made = summed(counts_in_words(counts, path).unionByName(pairs_in_texts(training, shipped, path, key)))
    made[FIRST][END] = ends
    tables = spark.broadcast(build(made[FIRST], made[KINDS], made[PAIRS], made[ACROSS], made[FAR]))
    learned = spark.broadcast(learn(training, shipped, tables, path, key, rounds))
    total = n_all + 0.1 * (n_distinct + 1)
    names = ("doc_id", "held_out", "n_tokens", "n_known", "base", "score")
    kinds = {"row": pa.int64(), "doc_id": pa.int64(), "held_out": pa.bool_(), "n_tokens": pa.int64(), "n_known": pa.int64(), "base": pa.float64(), "score": pa.float64(), "word": pa.binary(), "unit": pa.float64(), "rest": pa.float64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, n, _ = shipped.value
        t, table = tables.value, kept(key, path, words)
        model = Attention(t, learned.value)
        # by number, the end last
        logs = np.append(np.log10((n + 0.1) / total), np.log10((ends + 0.1) / total))
        log_completion = np.append(completions(t, table.first, n, t.spelling(*table.ids)), 0.0)
        with np.errstate(divide="ignore"):
            log_unit = np.log10(t.unit)
        row = TaskContext.get().partitionId() << 33
        for part, block in blocks(batches, table):
            first = block.first[block.hot : -1]
            scores, tail, unit, rest = model.score(block, log_completion, log_unit[first], t.spelled[first] + t.spelling(*block.ids))
            start = np.cumsum(block.size) - block.size
            known = block.number < block.hot
            base = np.add.reduceat(np.where(known, logs[np.where(known, block.number, -1)], 0.0), start)
            n_known = np.add.reduceat(known & (block.number >= 0), start) + (ends > 0)
            of = row + np.arange(part.num_rows)
            own = np.repeat(of, block.size)[tail]
            nothing = pa.nulls(len(tail))
            columns = {
                "row": pa.array(np.concatenate([of, own])), "n_tokens": block.size, "n_known": n_known, "base": base, "score": scores,
                "word": pa.array([b" %d" % r for r in of.tolist()] + [block.fresh[i] for i in (block.number[tail] - block.hot).tolist()], pa.binary()),  # no word holds a space: a document's own row meets no count
                "unit": pa.array(np.concatenate([np.zeros(len(of)), unit])), "rest": pa.array(np.concatenate([np.zeros(len(of)), rest])),
            }
            for c in names:
                head = part.column(c) if c in ("doc_id", "held_out") else pa.array(columns[c], kinds[c])
                columns[c] = pa.concat_arrays([head, nothing.cast(kinds[c])])
            row += part.num_rows
            yield pa.RecordBatch.from_arrays([columns[k].cast(x) for k, x in kinds.items()], list(kinds))

    flat = rows.mapInArrow(run, "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, word binary, unit double, rest double")
    joined = flat.join(counts, "word", "left").withColumn("c", F.coalesce("n", F.lit(0)))
    tail = F.col("n_tokens").isNull()
    # log10(unit * c + rest), both kept as logarithms: spellings of long words are beyond doubles
    low, high = F.least(F.col("unit") + F.log10("c"), F.col("rest")), F.greatest(F.col("unit") + F.log10("c"), F.col("rest"))
    own = F.when(F.col("c") > 0, high + F.log10(1 + F.pow(F.lit(10.0), low - high))).otherwise(F.col("rest"))
    return joined.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.coalesce(F.max("held_out"), F.lit(False)).alias("held_out"),
        F.max("n_tokens").alias("n_tokens"),
        (F.max("n_known") + F.sum((tail & (F.col("c") > 0)).cast("long"))).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.max("base") + F.sum(F.when(tail, F.log10((F.col("c") + 0.1) / F.lit(float(total)))).otherwise(0.0))).alias("base_score"),
        (F.max("score") + F.sum(F.when(tail, own).otherwise(0.0))).alias("score"),
    ).drop("row")
