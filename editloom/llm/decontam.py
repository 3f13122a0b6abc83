"""Benchmark decontamination by size-partitioned MinHash containment.

A test item with n distinct word shingles lies in a document if at least a share t of them does. Items are partitioned by
size into classes [2^k, 2^(k+1)); the sketch of an item is its (1 - t) u + 1 least shingle hashes, u the largest size in
its class. A document that holds a share t of an item lacks fewer shingles than the sketch has, so it holds one of the
sketch: the search loses nothing, however short the item and long the document. Documents that hold a sketch hash are
verified by the exact shingles of the item.

The index of the items goes to the tasks. Its size is bounded: different item texts come in blocks of about BLOCK_BYTES bytes
of text, one pass over the documents a block; documents never leave their task.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, raw, texts
from .wordhash import Words

THRESHOLD, SHINGLE = 0.8, 5
BLOCK_BYTES, BUCKETS = 3_000_000, 4096
FILTER_BITS = 20


class Screen:
    """Membership of hashes in a fixed set: a bit table first, then a search in the sorted set."""

    def __init__(self, hashes: np.ndarray):
        self.sorted = np.unique(hashes.astype(np.uint64))
        self.table = np.zeros(1 << FILTER_BITS, bool)
        self.table[(self.sorted >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True

    def hits(self, h: np.ndarray) -> np.ndarray:
        maybe = np.flatnonzero(self.table[(h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        if not len(maybe) or not len(self.sorted):
            return maybe[:0]
        k = np.minimum(np.searchsorted(self.sorted, h[maybe]), len(self.sorted) - 1)
        return maybe[self.sorted[k] == h[maybe]]


class ContainmentIndex:
    """Items by shingle size (`shingle` words, or all words of a shorter item) and by size class."""

    def __init__(self, items: list[tuple[str, bytes]], threshold: float = THRESHOLD, shingle: int = SHINGLE):
        self.threshold, self.item_ids = threshold, [i for i, _ in items]
        words = Words([t for _, t in items])
        h = words.hashes()
        counts = np.diff(words.first)
        self.sizes: list[int] = sorted({int(min(shingle, n)) for n in counts if n})
        self.n = np.zeros(len(items), np.int64)  # distinct shingles of each item
        self.of: dict[int, dict[int, list[tuple[int, bytes]]]] = {}  # size -> hash -> (item, shingle)
        self.sketch: dict[int, Screen] = {}
        self.all: dict[int, Screen] = {}
        self.sketched: dict[int, dict[int, list[int]]] = {}  # size -> sketch hash -> items
        for size in self.sizes:
            of, sketched = defaultdict(list), defaultdict(list)
            at, g = words.windows(h, size)
            item = words.text_of[at]
            right = np.minimum(counts[item], shingle) == size
            for i in np.unique(item[right]).tolist():
                own = {words.run(p, size): int(x) for p, x in zip(at[item == i].tolist(), g[item == i].tolist(), strict=True)}
                n = len(own)
                self.n[i] = n
                for s, x in own.items():
                    of[x].append((i, s))
                largest = (1 << n.bit_length()) - 1  # of the class that holds n
                lacking = largest - int(np.ceil(threshold * largest - 1e-9))
                for x in sorted(set(own.values()))[: lacking + 1]:
                    sketched[x].append(i)
            self.of[size], self.sketched[size] = dict(of), dict(sketched)
            self.sketch[size] = Screen(np.fromiter(sketched, np.uint64, len(sketched)))
            self.all[size] = Screen(np.fromiter(of, np.uint64, len(of)))

    def search(self, docs: list[bytes]) -> list[list[tuple[int, int]]]:
        """For each document the (item, shared shingles) that reach the threshold, by item."""
        words, out = Words(docs), [[] for _ in docs]
        if not self.sizes:
            return out
        h = words.hashes()
        for size in self.sizes:
            at, g = words.windows(h, size)
            wanted: dict[int, set[int]] = defaultdict(set)  # document -> candidate items
            found = self.sketch[size].hits(g)
            for d, x in zip(words.text_of[at[found]].tolist(), g[found].tolist(), strict=True):
                wanted[d].update(self.sketched[size][x])
            if not wanted:
                continue
            shared: dict[tuple[int, int], set[bytes]] = defaultdict(set)
            found = self.all[size].hits(g)
            for p, x in zip(at[found].tolist(), g[found].tolist(), strict=True):
                d = int(words.text_of[p])
                if d in wanted:
                    s = words.run(p, size)
                    for i, own in self.of[size][x]:
                        if own == s and i in wanted[d]:
                            shared[d, i].add(s)
            for (d, i), s in shared.items():
                if len(s) >= self.threshold * self.n[i] - 1e-9:
                    out[d].append((i, len(s)))
        return [sorted(x) for x in out]


def keyed(items: DataFrame) -> DataFrame:
    """key (of the text), text; rows without text are left out."""
    return items.filter("text is not null").select(F.md5("text").alias("key"), "text")


def indexes(items: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE, block: int = BLOCK_BYTES) -> Iterator[ContainmentIndex]:
    """Indexes of about `block` bytes of different texts each, by key; one at least. Repeated texts are one item of an index.

    Texts are dealt to BUCKETS by hash, and the driver, which sees a size for each, joins neighbours up to the bound; a
    bucket beyond it, which needs a text or many of that size, is a block by itself.
    """
    rows = keyed(items).distinct().withColumn("bucket", F.pmod(F.xxhash64("text"), F.lit(BUCKETS)))
    sizes = sorted(rows.groupBy("bucket").agg(F.sum(F.octet_length("text"))).collect())
    bounds, held = [0], 0
    for bucket, size in sizes:
        if held and held + size > block:
            bounds.append(bucket)
            held = 0
        held += size
    for a, b in zip(bounds, [*bounds[1:], BUCKETS], strict=True):
        part = rows.filter(F.col("bucket").between(a, b - 1)).select("key", "text").toArrow()
        own = sorted(zip(part.column("key").to_pylist(), (t.encode() for t in part.column("text").to_pylist()), strict=True))
        yield ContainmentIndex(own, threshold, shingle)


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE, block: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, n_shingles, n_shared, containment: every document and test item it holds to the threshold or more.

    Words are lower-cased; items of fewer words than a shingle are one shingle. Null, empty and wordless texts hold
    nothing and lie in nothing; texts of any length are searched whole. Repeated documents and items each give their rows,
    and null ids stay. An empty table on either side gives no rows. Columns beside ids and texts are not read, so none can
    clash.
    """
    schema = "doc_id long, key string, n_shingles long, n_shared long"
    out = None
    for index in indexes(items, threshold, shingle, block):
        shipped = docs.sparkSession.sparkContext.broadcast(index)

        def block_(batch: pa.RecordBatch, shipped=shipped) -> Iterator[pa.RecordBatch]:
            index, ids, rows = shipped.value, batch.column("doc_id").to_pylist(), []
            for doc, found in zip(ids, index.search(raw(batch.column("text"))), strict=True):
                rows += [(doc, index.item_ids[i], int(index.n[i]), n) for i, n in found]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True)], ["doc_id", "key", "n_shingles", "n_shared"])

        part = map_arrow(texts(docs), block_, schema)
        out = part if out is None else out.unionByName(part)
    named = items.filter("text is not null").select("item_id", F.md5("text").alias("key"))
    return out.join(named, "key").select("doc_id", "item_id", "n_shingles", "n_shared", (F.col("n_shared") / F.col("n_shingles")).alias("containment"))
