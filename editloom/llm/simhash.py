"""SimHash near-duplicates by forests of BK-trees.

Fingerprints are made per document, equal ones collapse to one node, and nodes meet in shards. For an exact search
within `radius` bits a fingerprint is cut into radius + 1 blocks: two fingerprints that near agree on a block, so each
node goes to one shard per block, keyed by the block's bits. A shard of more than HOT nodes is cut again by radius + 1
blocks of its other bits, which loses no pair either. In a task all its shards form a forest of BK-trees whose children
are keyed by Hamming distance to the parent; all queries walk the forest at once and follow only edges within the radius.
A shard's links leave as a star per connected part, and components of the stars are found on the cluster.

Shard trees are moved to the tasks by a shuffle on the shard key, not broadcast: what is broadcast would grow with the
data.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, materialise, raw, texts
from .components import components

HOT = 20_000
WIDTH = 12  # bits of a block of the longer fingerprints
LANES = np.array([sum(((b >> j) & 1) << (8 * j) for j in range(8)) for b in range(256)], np.uint64)
MIXES = [0] + [(0x9E3779B97F4A7C15 * (i + 1)) & (2**64 - 1) for i in range(63)]


def mix(h: np.ndarray, k: int) -> np.ndarray:
    """A further 64 bits from a hash; k = 0 is the hash itself."""
    if not k:
        return h
    h = h ^ np.uint64(MIXES[k])
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: bytes, size: int) -> list[bytes]:
    """Space-joined runs of `size` lower-cased words, repeats included; a shorter text is one run, an empty one none."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return []
    joined = b" ".join(words)
    if n <= size:
        return [joined]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    return [joined[a:b] for a, b in zip(starts[: n - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)]


def majority(h: np.ndarray, bits: int) -> bytes:
    """The bits set in over half the hashes, highest first; further words of the fingerprint come from mixed hashes."""
    out = b""
    for k in range(bits // 64):
        count = np.zeros(64, np.int64)
        for a in range(0, len(h), 65_280):
            lanes = LANES[mix(h[a : a + 65_280], k).view(np.uint8).reshape(-1, 8)]
            count += np.add.reduceat(lanes, np.arange(0, len(lanes), 255), axis=0).view(np.uint8).reshape(-1, 64).sum(0, dtype=np.int64)
        out += np.packbits((count * 2 > len(h))[::-1]).tobytes()
    return out


def fingerprints(docs: DataFrame, shingle: int = 3, bits: int = 64, seed: int = 42) -> DataFrame:
    """doc_id, fp (binary, `bits` / 8 bytes). Null and empty texts, without words, have fingerprint zero."""

    def block(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out = []
        for text in raw(batch.column("text")):
            s = shingles(text, shingle)
            h = np.fromiter(map(xxhash.xxh64_intdigest, s, repeat(seed)), np.uint64, len(s))
            out.append(majority(h, bits))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary())], ["doc_id", "fp"])

    return map_arrow(texts(docs), block, "doc_id long, fp binary")


def bit_matrix(fps: list[bytes]) -> np.ndarray:
    return np.unpackbits(np.frombuffer(b"".join(fps), np.uint8).reshape(len(fps), -1), axis=1) if fps else np.zeros((0, 0), np.uint8)


class Forest:
    """BK-trees of many shards at once. words: uint64 matrix of fingerprints; shard: sorted shard number of each row."""

    def __init__(self, words: np.ndarray, shard: np.ndarray):
        self.words, n = words, len(words)
        self.root_of = np.zeros(n, np.int64)
        self.step = words.shape[1] * 64 + 1
        first = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]])) if n else np.zeros(0, np.int64)
        self.root_of = first[np.cumsum(np.concatenate([[True], shard[1:] != shard[:-1]])) - 1] if n else first
        placed = np.zeros(n, bool)
        placed[first] = True
        todo = np.flatnonzero(~placed)
        parent = self.root_of[todo]
        edges, kids = [], []
        while len(todo):
            key = parent * self.step + self.distance(todo, parent)
            key_u, one, inv = np.unique(key, return_index=True, return_inverse=True)
            child = todo[one]
            edges.append(key_u)
            kids.append(child)
            rest = np.ones(len(todo), bool)
            rest[one] = False
            todo, parent = todo[rest], child[inv[rest]]
        self.edges = np.concatenate(edges) if edges else np.zeros(0, np.int64)
        self.kids = np.concatenate(kids) if kids else np.zeros(0, np.int64)
        order = np.argsort(self.edges)
        self.edges, self.kids = self.edges[order], self.kids[order]

    def distance(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.bitwise_count(self.words[a] ^ self.words[b]).sum(1, dtype=np.int64)

    def links(self, radius: int, step: int = 4096) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, node) within the radius, each once, by blocks of queries."""
        for k in range(0, len(self.words), step):
            q = np.arange(k, min(k + step, len(self.words)))
            node = self.root_of[q]
            while len(q):
                d = self.distance(q, node)
                hit = (d <= radius) & (node < q)
                if hit.any():
                    yield q[hit], node[hit]
                lo = np.searchsorted(self.edges, node * self.step + np.maximum(d - radius, 0))
                hi = np.searchsorted(self.edges, node * self.step + np.minimum(d + radius, self.step - 1), "right")
                many = hi - lo
                q = np.repeat(q, many)
                node = self.kids[np.arange(len(q)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(lo, many)]


    def neighbours(self, radius: int, step: int = 512) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The same pairs, all of a query at once."""
        held: list[tuple[np.ndarray, np.ndarray]] = []
        block = -1
        for q, node in self.links(radius, step):
            if int(q[0]) // step != block and held:
                yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
                held = []
            block = int(q[0]) // step
            held.append((q, node))
        if held:
            yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def roots(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The least row each row is connected to."""
    top = np.arange(n)
    for a, b in pairs:
        while True:
            x, y = top[a], top[b]
            if (x == y).all():
                break
            low = np.minimum(x, y)
            np.minimum.at(top, x, low)
            np.minimum.at(top, y, low)
            while not (top == (jump := top[top])).all():
                top = jump
    return top


def _shards(nodes: DataFrame, keys: list[np.ndarray]) -> DataFrame:
    """(shard binary, node, fp): one row for each block of bit places in `keys`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_pylist()
            m = bit_matrix(fps)
            for k, places in enumerate(keys):
                packed = np.packbits(m[:, places], axis=1)
                head = k.to_bytes(2, "big")
                yield pa.RecordBatch.from_arrays([pa.array([head + x.tobytes() for x in packed], pa.binary()), batch.column("node"), batch.column("fp")], ["shard", "node", "fp"])

    return nodes.select("node", "fp").mapInArrow(run, "shard binary, node long, fp binary")


def _finer(rows: DataFrame, keys: list[np.ndarray], radius: int, bits: int) -> DataFrame:
    """Rows of hot shards, each shard cut by radius + 1 blocks of the bits that its key leaves."""
    cuts = []
    for places in keys:
        rest = np.setdiff1d(np.arange(bits), places)
        cuts.append(np.array_split(rest, min(radius + 1, len(rest))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard, m = batch.column("shard").to_pylist(), bit_matrix(batch.column("fp").to_pylist())
            node, fp = batch.column("node"), batch.column("fp")
            block = np.array([int.from_bytes(s[:2], "big") for s in shard])
            for k in np.unique(block).tolist():
                at = np.flatnonzero(block == k)
                for j, places in enumerate(cuts[k]):
                    packed = np.packbits(m[np.ix_(at, places)], axis=1)
                    yield pa.RecordBatch.from_arrays([pa.array([shard[i] + b"/" + j.to_bytes(2, "big") + x.tobytes() for i, x in zip(at.tolist(), packed, strict=True)], pa.binary()), node.take(pa.array(at)), fp.take(pa.array(at))], ["shard", "node", "fp"])

    return rows.mapInArrow(run, "shard binary, node long, fp binary")


def shard_rows(nodes: DataFrame, radius: int, bits: int, keys: list[np.ndarray], hot: int) -> DataFrame:
    """nodes (node long, fp binary) in their shards; shards of more than `hot` rows are cut, which changes the cost, not the result."""
    rows = _shards(nodes, keys)
    big = rows.groupBy("shard").count().filter(F.col("count") > hot).select("shard")
    big = materialise(big, "hot")
    if not big.limit(1).count():
        return rows
    return rows.join(big, "shard", "left_anti").unionByName(_finer(rows.join(big, "shard", "left_semi").select("shard", "node", "fp"), keys, radius, bits))


def by_shard(rows: DataFrame, solve: Callable[[pa.Table, Forest, np.ndarray], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """`solve` over tables of whole shards, with their forest and the number of each row's shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def ready(t: pa.Table) -> Iterator[pa.RecordBatch]:
            shard = t.column("shard").combine_chunks().dictionary_encode()
            shard = (shard.combine_chunks() if isinstance(shard, pa.ChunkedArray) else shard).indices.to_numpy(zero_copy_only=False)
            fps = t.column("fp").to_pylist()
            words = np.frombuffer(b"".join(fps), ">u8").astype(np.uint64).reshape(len(fps), -1)
            yield from solve(t, Forest(words, shard), shard)

        def whole(final: bool) -> Iterator[pa.RecordBatch]:
            """Solve what is held but for the last shard, which may go on."""
            t = pa.concat_tables(held)
            held.clear()
            if not t.num_rows:
                return
            keep = t.num_rows
            if not final:
                last = t.column("shard")[-1].as_py()
                import pyarrow.compute as pc

                keep = pc.index(t.column("shard"), pa.scalar(last, t.schema.field("shard").type)).as_py()
                held.append(t.slice(keep))
            if keep:
                yield from ready(t.slice(0, keep))

        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            if sum(t.num_rows for t in held) >= 50_000:
                yield from whole(False)
        if held:
            yield from whole(True)

    return rows.repartition("shard").sortWithinPartitions("shard").mapInArrow(run, schema)


def links(nodes: DataFrame, radius: int, bits: int, keys: list[np.ndarray], hot: int = HOT) -> DataFrame:
    """nodes (node long, fp binary, distinct) -> edges (a, b) that connect exactly the nodes linked in some shard."""

    def solve(t: pa.Table, forest: Forest, shard: np.ndarray) -> Iterator[pa.RecordBatch]:
        node = t.column("node").to_numpy()
        top = roots(len(node), forest.links(radius))
        own = np.flatnonzero(top != np.arange(len(top)))
        if len(own):
            yield pa.RecordBatch.from_arrays([pa.array(node[top[own]]), pa.array(node[own])], ["a", "b"])

    return by_shard(shard_rows(nodes, radius, bits, keys, hot), solve, "a long, b long")


def candidates(rows: DataFrame, radius: int, most: int) -> DataFrame:
    """rows (shard, node, fp, part) -> (a, b): pairs of nodes of different parts within the radius in a shard, of each node the
    `most` nearest among those before it; and (shard): shards in which a node has more."""

    def solve(t: pa.Table, forest: Forest, shard: np.ndarray) -> Iterator[pa.RecordBatch]:
        node, part = t.column("node").to_numpy(), t.column("part").to_numpy()
        pairs: list[np.ndarray] = []
        cut: list[np.ndarray] = []
        for q, n in forest.neighbours(radius):
            apart = part[q] != part[n]
            q, n = q[apart], n[apart]
            order = np.lexsort((n, forest.distance(q, n), q))
            q, n = q[order], n[order]
            head = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])) if len(q) else np.zeros(0, np.int64)
            place = np.arange(len(q)) - np.repeat(head, np.diff(np.append(head, len(q))))
            keep = place < most
            pairs.append(np.sort(np.stack([node[q[keep]], node[n[keep]]], 1), 1))
            cut.append(np.unique(shard[q[~keep]]))
        pair = np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.int64)
        more = np.unique(np.concatenate(cut)) if cut else np.zeros(0, np.int64)
        first = np.searchsorted(shard, more)
        names = t.column("shard").take(pa.array(first)).to_pylist()
        blank = [None] * len(pair)
        yield pa.RecordBatch.from_arrays([pa.array(pair[:, 0].tolist() + [None] * len(more), pa.int64()), pa.array(pair[:, 1].tolist() + [None] * len(more), pa.int64()), pa.array(blank + names, pa.binary())], ["a", "b", "shard"])

    return by_shard(rows, solve, "a long, b long, shard binary")


def exact_keys(radius: int, bits: int = 64) -> list[np.ndarray]:
    return np.array_split(np.arange(bits), radius + 1)


def cluster(prints: DataFrame, radius: int, bits: int, keys: list[np.ndarray], hot: int = HOT) -> DataFrame:
    """(doc_id, fp) -> doc_id, fp, component_id: the least doc_id among all documents that links within the radius reach.

    Documents without a doc_id link like others; if a component has no doc_id at all its id is null.
    """
    nodes = numbered(prints, "fp")
    return grouped(prints, nodes, links(nodes, radius, bits, keys, hot), "fp").select("doc_id", "fp", "component_id")


def numbered(prints: DataFrame, key: str, *more: str) -> DataFrame:
    """key, what follows from it, least doc_id and a node number for each key."""
    nodes = prints.groupBy(key, *more).agg(F.min("doc_id").alias("least"))
    # a key of documents without ids gets a node number below all ids
    return materialise(nodes.select(key, *more, "least", F.coalesce("least", -2 - F.pmod(F.xxhash64(key), F.lit(2**61))).alias("node")), "nodes")


def grouped(prints: DataFrame, nodes: DataFrame, edges: DataFrame, key: str) -> DataFrame:
    """prints with component_id: the least doc_id among all documents that the edges between their nodes reach."""
    label = components(edges)
    joined = nodes.join(label, "node", "left").select(key, "least", F.coalesce("label", "node").alias("label"))
    least = joined.groupBy("label").agg(F.min("least").alias("component_id"))
    of = materialise(joined.join(least, "label").select(key, "component_id"), "parts")
    return prints.join(of, key)


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, seed: int = 42, hot: int = HOT) -> DataFrame:
    """doc_id, fingerprint (hex), component_id by 64-bit fingerprints that link at `radius` or fewer differing bits; exact.

    Null, empty and wordless texts have fingerprint zero, linked like any other; texts of any length are hashed whole, one
    shorter than a shingle as one run. A shingle repeated counts as often; a bit set in just half the hashes is 0. Every row
    gives a row; rows without a doc_id link like others, and where no row of a component has one its id is null. An empty
    table gives no rows. Columns beside doc_id and text are not read, so none can clash.
    """
    prints = materialise(fingerprints(docs, shingle, 64, seed), "prints")
    found = cluster(prints, radius, 64, exact_keys(radius), hot)
    return found.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


def plan_for(similarity: float, recall: float = 0.97) -> tuple[int, int, list[np.ndarray]]:
    """(bits, radius, keys) of the candidates for texts whose shingle sets have at least this Jaccard similarity.

    Bits of two fingerprints of sets differ with the probability angle / pi or less. As many blocks of WIDTH bits are taken
    as find a pair at the threshold with the wanted recall, pairs above it more surely. The radius is three standard
    deviations beyond the mean distance at the threshold. The plan is the same for every number of rows: shards that grow
    hot are cut, which changes no result.
    """
    p = math.acos(2 * similarity / (1 + similarity)) / math.pi
    blocks = math.ceil(math.log(1 - recall) / math.log(1 - (1 - p) ** WIDTH))
    bits = -(-WIDTH * blocks // 64) * 64
    keys = [np.arange(k * WIDTH, (k + 1) * WIDTH) for k in range(bits // WIDTH)]
    return bits, round(bits * p + 3 * math.sqrt(bits * p * (1 - p))), keys


def shingle_set(text: bytes, size: int, seed: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles."""
    s = shingles(text, size)
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, s, repeat(seed)), np.uint64, len(s)))


def words_key(text: bytes) -> bytes:
    """The same for texts of the same lower-cased words."""
    return xxhash.xxh3_128_digest(b" ".join(text.lower().split()))


def set_prints(docs: DataFrame, shingle: int, bits: int, seed: int) -> DataFrame:
    """doc_id, key of the words, fp of the distinct shingles."""

    def block(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = raw(batch.column("text"))
        keys = pa.array(list(map(words_key, found)), pa.binary())
        fps = pa.array([majority(shingle_set(t, shingle, seed), bits) for t in found], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), keys, fps], ["doc_id", "key", "fp"])

    return map_arrow(texts(docs), block, "doc_id long, key binary, fp binary")


def verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, shingle: int, similarity: float, seed: int) -> DataFrame:
    """Those of the pairs (a, b) whose shingle sets, as 64-bit hashes, have at least the Jaccard similarity."""

    def sets(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = raw(batch.column("text"))
        keys = pa.array(list(map(words_key, found)), pa.binary())
        yield pa.RecordBatch.from_arrays([keys, pa.array([shingle_set(t, shingle, seed).tobytes() for t in found], pa.binary())], ["key", "hashes"])

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = (np.frombuffer(h.as_buffer(), np.uint64) for h in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both > 0 and both / (len(x) + len(y) - both) >= similarity)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = materialise(nodes.join(ends, "node", "left_semi").select("node", "key", "least"), "wanted")
    ids = wanted.select(F.col("least").alias("id")).distinct()
    # ids grow with the documents and are not broadcast; of a key the documents of its least id hold its words
    some = texts(docs).join(ids.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    held = map_arrow(some, sets, "key binary, hashes binary").join(wanted.select("node", "key"), "key")
    held = materialise(held.groupBy("node", "key").agg(F.first("hashes").alias("hashes")), "sets")
    x = held.select(F.col("node").alias("a"), F.col("hashes").alias("x"))
    y = held.select(F.col("node").alias("b"), F.col("hashes").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(alike, "a long, b long")


def similar(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, seed: int = 42, hot: int = HOT, most: int = 8) -> DataFrame:
    """doc_id, component_id of texts joined by links between texts whose sets of word shingles are `similarity` alike or more.

    Longer fingerprints only find candidates; a link is kept if the sets themselves are alike, so no text below the
    threshold is linked, whatever the size of the table. Texts of the same words are one node and need no link. In a group of
    many near copies not all pairs are tried: a node is tried with its `most` nearest, and only pairs that this leaves in
    different parts are tried in further rounds, with eight times as many each, until none is left untried.

    Null, empty and wordless texts are alike; texts of any length are compared whole. Every row gives a row; rows without a
    doc_id link like others. An empty table gives no rows. Columns beside doc_id and text are not read, so none can clash.
    """
    bits, radius, keys = plan_for(similarity)
    prints = materialise(set_prints(docs, shingle, bits, seed), "prints")
    nodes = numbered(prints, "key", "fp")
    rows, active, parts, tested, edges = shard_rows(nodes, radius, bits, keys, hot), None, None, None, None
    while True:
        if active is None:
            open_ = rows.withColumn("part", F.col("node"))
        else:
            open_ = rows.join(active, "shard", "left_semi").join(parts.withColumnRenamed("label", "part"), "node", "left").withColumn("part", F.coalesce("part", "node"))
        found = materialise(candidates(open_.select("shard", "node", "fp", "part"), radius, most), "found")
        pairs = found.filter("a is not null").select("a", "b").distinct()
        pairs = materialise(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        good = materialise(verified(docs, nodes, pairs, shingle, similarity, seed), "links")
        tested, edges = (pairs, good) if tested is None else (tested.union(pairs), edges.union(good))
        active = found.filter("shard is not null").select("shard").distinct()
        if not active.limit(1).count():
            return grouped(prints, nodes, edges, "key").select("doc_id", "component_id")
        # what is linked needs no further link within; what is not is looked at again with more neighbours
        parts, most = materialise(components(edges), "parts"), most * 8
