"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of PASSAGE words. Every passage is encoded as shares of byte classes, word shapes and
repetition, and hashed words. A layer embeds it, a gated attention network weighs it, and the weighted sum of embeddings is
scored; all weights are learned from document labels alone, by Adam in numpy.

The fit takes at most TRAIN_DOCS labelled documents, those of least hash, with all their passages; scoring takes every
passage of every document. Language, source, doc_id and labels are not inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, raw, texts
from .wordhash import Words

PASSAGE = 64
TRAIN_DOCS = 4000
HASHED, HIDDEN, GATE = 32, 24, 16
EPOCHS, BATCH, RATE, DECAY = 30, 64, 5e-3, 1e-4

CLASSES = np.zeros(256, np.int64)
CLASS_NAMES = ("lower", "upper", "digit", "space", "newline", "!", "?", ".", ",", "symbol", "|", "punctuation", "lead", "continuation", "control")
for _b in range(256):
    _c = chr(_b)
    _n = (
        "lower" if "a" <= _c <= "z" else "upper" if "A" <= _c <= "Z" else "digit" if "0" <= _c <= "9" else "space" if _c in " \t" else "newline" if _c in "\n\r"
        else _c if _c in "!?.,|" else "symbol" if _c in "#*$%&<>" else "control" if _b < 32 or _b == 127 else "continuation" if 128 <= _b < 192 else "lead" if _b >= 192 else "punctuation"
    )
    CLASSES[_b] = CLASS_NAMES.index(_n)
DIM = len(CLASS_NAMES) + 9 + HASHED


def passages(documents: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(features of every passage, first passage of each document and the end). A document without words has one passage."""
    w = Words(documents, lower=False)
    n_docs, n_words = len(documents), len(w.starts)
    count = np.diff(w.first)
    many = np.maximum(1, -(-count // PASSAGE))
    first = np.concatenate([[0], np.cumsum(many)])
    total = int(first[-1])
    x = np.zeros((total, DIM), np.float32)
    if not n_words:
        x[:, -1] = 1
        return x, first
    place = np.arange(n_words) - w.first[w.text_of]  # of the word in its document
    own = first[w.text_of] + place // PASSAGE
    words = np.bincount(own, minlength=total).astype(np.float32)
    # bytes from one word's start to the next word's start, or to the end of the text
    ends = np.concatenate([w.starts[1:], [len(w.data)]])
    ends = np.minimum(ends, w.text_starts[w.text_of + 1])
    data = np.frombuffer(w.data, np.uint8)
    span = ends - w.starts
    pos = np.arange(int(span.sum())) - np.repeat(np.cumsum(span) - span, span) + np.repeat(w.starts, span)
    k = len(CLASS_NAMES)
    table = np.bincount(np.repeat(own, span) * k + CLASSES[data[pos]], minlength=total * k).reshape(total, k)
    sizes = np.maximum(1, table.sum(1, keepdims=True))
    x[:, :k] = np.sqrt(table / sizes)
    length = (w.ends - w.starts).astype(np.float64)
    per = np.maximum(words, 1)
    mean = np.bincount(own, length, total) / per
    x[:, k] = mean / 8
    x[:, k + 1] = np.sqrt(np.maximum(0, np.bincount(own, length**2, total) / per - mean**2)) / 8
    h = w.hashes()
    same = np.zeros(n_words, bool)
    same[1:] = (h[1:] == h[:-1]) & (w.text_of[1:] == w.text_of[:-1])
    x[:, k + 2] = np.bincount(own, same, total) / per
    order = np.lexsort((h, own))
    fresh = np.ones(n_words, bool)
    fresh[1:] = (h[order][1:] != h[order][:-1]) | (own[order][1:] != own[order][:-1])
    x[:, k + 3] = np.bincount(own[order], fresh, total) / per
    at, g = w.windows(h, 3)
    if len(at):
        order = np.lexsort((at, g, w.text_of[at]))
        again = np.zeros(len(at), bool)
        again[order[1:]] = (g[order][1:] == g[order][:-1]) & (w.text_of[at[order][1:]] == w.text_of[at[order][:-1]])
        x[:, k + 4] = np.bincount(own[at], again, total) / per
    head, tail = CLASSES[data[w.starts]], CLASSES[data[w.ends - 1]]
    x[:, k + 5] = np.bincount(own, head == 1, total) / per
    x[:, k + 6] = np.bincount(own, tail > 4, total) / per
    x[:, k + 7] = np.minimum(words / PASSAGE, 1)
    slot = (h >> np.uint64(58)).astype(np.int64) % HASHED
    sign = np.where((h >> np.uint64(40)) & np.uint64(1), 1.0, -1.0)
    x[:, k + 8 : k + 8 + HASHED] = np.bincount(own * HASHED + slot, sign, total * HASHED).reshape(total, HASHED) / np.sqrt(per)[:, None] / 4
    x[:, -1] = words == 0
    return x, first


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Of each document's rows; no document is without rows."""
    return np.add.reduceat(values, first[:-1], axis=0)


@dataclass
class Model:
    """Weights by name; `mean` and `scale` standardise features; `constant` is the score where nothing could be learned."""

    weights: dict[str, np.ndarray]
    mean: np.ndarray
    scale: np.ndarray
    constant: float | None = None

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        p = self.weights
        z = np.tanh(x @ p["e"] + p["eb"])
        t, s = np.tanh(z @ p["v"]), 1 / (1 + np.exp(-(z @ p["u"])))
        a = (t * s) @ p["w"]
        a = np.exp(np.clip(a, -30, 30))
        size = np.diff(first)
        share = a / np.repeat(sums(a, first), size)
        bag = sums(share[:, None] * z, first)
        return {"z": z, "t": t, "s": s, "share": share, "bag": bag, "y": bag @ p["c"] + p["d"][0]}

    def score(self, documents: list[bytes]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(documents), self.constant)
        x, first = passages(documents)
        y = self.forward((x - self.mean) / self.scale, first)["y"]
        return 1 / (1 + np.exp(-np.clip(y, -40, 40).astype(np.float64)))


def train(x: np.ndarray, first: np.ndarray, labels: np.ndarray, seed: int = 7) -> Model:
    """Adam on the documents' cross-entropy."""
    if not len(labels) or labels.min() == labels.max():
        return Model({}, np.zeros(0), np.ones(0), float(labels.mean()) if len(labels) else 0.5)
    rng = np.random.default_rng(seed)
    mean, scale = x.mean(0), x.std(0) + 1e-2
    x = ((x - mean) / scale).astype(np.float32)
    init = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
    p = {"e": init(DIM, HIDDEN), "eb": np.zeros(HIDDEN, np.float32), "v": init(HIDDEN, GATE), "u": init(HIDDEN, GATE), "w": init(GATE), "c": init(HIDDEN), "d": np.array([np.log(labels.mean() / (1 - labels.mean()))], np.float32)}
    m, v = {k: np.zeros_like(q) for k, q in p.items()}, {k: np.zeros_like(q) for k, q in p.items()}
    model, size, step = Model(p, mean, scale), np.diff(first), 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(labels))
        rate = RATE * 0.5 * (1 + np.cos(np.pi * epoch / EPOCHS))
        for k in range(0, len(order), BATCH):
            docs = np.sort(order[k : k + BATCH])
            own = np.concatenate([np.arange(first[d], first[d + 1]) for d in docs])
            f = np.concatenate([[0], np.cumsum(size[docs])])
            xb, yb = x[own], labels[docs]
            o = model.forward(xb, f)
            err = ((1 / (1 + np.exp(-o["y"])) - yb) / len(docs)).astype(np.float32)
            g = {"c": o["bag"].T @ err, "d": np.array([err.sum()], np.float32)}
            up = np.repeat(np.outer(err, p["c"]), size[docs], axis=0)  # gradient of the document's representation
            dz = o["share"][:, None] * up
            da = o["share"] * ((up * o["z"]).sum(1) - np.repeat((up[f[:-1]] * o["bag"]).sum(1), size[docs]))
            g["w"] = (o["t"] * o["s"]).T @ da
            dt, ds = np.outer(da, p["w"]) * o["s"] * (1 - o["t"] ** 2), np.outer(da, p["w"]) * o["t"] * o["s"] * (1 - o["s"])
            g["v"], g["u"] = o["z"].T @ dt, o["z"].T @ ds
            dz = (dz + dt @ p["v"].T + ds @ p["u"].T) * (1 - o["z"] ** 2)
            g["e"], g["eb"] = xb.T @ dz, dz.sum(0)
            step += 1
            for q in p:
                grad = g[q] + (DECAY * p[q] if p[q].ndim == 2 else 0)
                m[q] = 0.9 * m[q] + 0.1 * grad
                v[q] = 0.999 * v[q] + 0.001 * grad**2
                p[q] -= (rate * (m[q] / (1 - 0.9**step)) / (np.sqrt(v[q] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return model


def held_out() -> Column:
    """Rows whose labels are not learned from; a null doc_id is none of them, but has no label either."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> Model:
    """Learn from the labelled documents that are not held out, at most `train_docs`, each whole. Several labels of a
    document: the largest. Labels without a document, and null labels and ids, count for nothing."""
    labelled = labels.filter("quality is not null and doc_id is not null").filter(~held_out()).groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    there = labelled.join(docs.select("doc_id"), "doc_id", "left_semi")
    some = there.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_docs)
    rows = texts(docs).join(F.broadcast(some), "doc_id")

    def block(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        x, first = passages(raw(batch.column("text")))
        out = [x[a:b].tobytes() for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.array(out, pa.binary())], ["doc_id", "quality", "x"])

    made = map_arrow(rows, block, "doc_id long, quality int, x binary").orderBy(F.xxhash64("doc_id"), "doc_id", "x").limit(train_docs).toArrow()
    xs = [np.frombuffer(b, np.float32).reshape(-1, DIM) for b in made.column("x").to_pylist()]
    if not xs:
        return train(np.zeros((0, DIM), np.float32), np.zeros(1, np.int64), np.zeros(0))
    first = np.concatenate([[0], np.cumsum([len(x) for x in xs])])
    return train(np.concatenate(xs), first, made.column("quality").to_numpy().astype(np.float64))


def classify(docs: DataFrame, model: Model, cut: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted for every row.

    Null texts count as empty, and texts without words are scored as one empty passage; texts of any length are scored
    whole. Repeated rows and null doc_ids each give a row; rows of equal text have equal scores. An empty table gives no
    rows. Columns beside doc_id and text are not read, so none can clash.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def block(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        s = shipped.value.score(raw(batch.column("text")))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(s), pa.array((s >= cut).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return map_arrow(texts(docs, held_out().alias("held_out")), block, "doc_id long, held_out boolean, score double, predicted int")
