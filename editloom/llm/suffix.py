"""Exact removal of byte strings of MIN_BYTES or more that occur elsewhere, on Burrows-Wheeler transforms of shards.

Which strings meet. Every window of MIN_BYTES bytes has an anchor, its least-hashed run of GRAM bytes (leftmost among
equals). Equal windows have equal anchors at equal places, so a window can only repeat where its anchor does. Consecutive
windows with one anchor form a run; its bytes are a segment. Runs whose anchor occurs once leave at once. The others
collapse to classes of equal segments with their multiplicity. One segment a class goes to the shard of its anchor, unless
no class of the anchor is single: a row of a transform that stands for several equal suffixes repeats as it is. That only
brings together what can be equal; what else is equal is decided in the shard:

Segments are concatenated with separators that differ from each other and from all bytes, suffixes are sorted to MIN_BYTES
symbols by prefix doubling, and common prefixes come from the transform alone: intervals of suffixes that start with the
same string are extended backwards, breadth first, one symbol a round; the right bound of an interval that is reached for
the first time in round l has common prefix l. After MIN_BYTES - 1 rounds the bounds not reached are exactly those with a
common prefix of MIN_BYTES or more, and the windows beside them repeat.

Bytes that repeated windows cover are removed from each document. Anchors, classes and bits travel, documents' texts only
to join them with their segments and their bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, materialise, raw, slices, texts
from .wordhash import powers

MIN_BYTES, GRAM = 200, 24
SHARD_BYTES = 1_000_000
BIG_ANCHOR = 200_000  # bytes of segments of one anchor beyond which they are cut by further anchors
LOW = np.uint64((1 << 20) - 1)
WINDOW_BLOCK = 1 << 19
SALTS = (0, 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def gram_hashes(data: bytes, gram: int = GRAM) -> np.ndarray:
    """A 64-bit hash of each run of `gram` bytes."""
    up, down = powers(len(data) + 1)
    a = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
    run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(a * up[: len(a)], dtype=np.uint64)])
    h = (run[gram:] - run[:-gram]) * down[: len(run) - gram]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def anchors(h: np.ndarray, width: int, salt: int = 0) -> np.ndarray:
    """Place of the least hash among each `width` consecutive ones, the leftmost of equals. At most 2^20 hashes."""
    if salt:
        h = (h ^ np.uint64(salt)) * np.uint64(0x94D049BB133111EB)
    key = (h & ~LOW) | np.arange(len(h), dtype=np.uint64)
    n, size = len(h), 1
    least = key
    while size * 2 <= width:
        least = np.minimum(least[: len(least) - size], least[size:])
        size *= 2
    if size < width:
        least = np.minimum(least[: n - width + 1], least[width - size : n - size + 1])
    return (least & LOW).astype(np.int64)


def runs(text: bytes, min_bytes: int = MIN_BYTES, gram: int = GRAM, salt: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, windows, anchor hash) of the runs of windows of a text. Block bounds cut runs only where an anchor changes
    or, in texts longer than a block, at fixed content: a run is given by its windows' anchor, so a cut run is completed."""
    n = len(text) - min_bytes + 1
    if n <= 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty.astype(np.uint64)
    width, places, values = min_bytes - gram + 1, [], []
    for a in range(0, n, WINDOW_BLOCK):
        m = min(WINDOW_BLOCK, n - a)
        h = gram_hashes(text[a : a + m + min_bytes - 1], gram)
        at = anchors(h, width, salt)
        places.append(at + a)
        values.append(h[at])
    at, value = np.concatenate(places), np.concatenate(values)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return first, np.diff(np.append(first, n)), value[first]


# the transform


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes by their first `depth` symbols, by prefix doubling; ties in any order."""
    n = len(symbols)
    rank, size = symbols.astype(np.int64), 1
    # the first symbols at once: as many as fit 62 bits
    bits = max(1, int(symbols.max()).bit_length())
    while (size + 1) * bits <= 62 and size < depth:
        size += 1
    key = np.zeros(n, np.int64)
    for d in range(size):
        key <<= bits
        key[: n - d] |= rank[d:] + 0
    order = np.argsort(key)
    while True:
        sorted_key = key[order]
        step = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        if size >= depth or step[-1] == n - 1:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = step
        shift = min(size, depth - size)
        key = rank * (n + 1)
        key[: n - shift] += rank[shift:] + 1
        # only suffixes that are still tied move
        tied = np.concatenate([[False], step[1:] == step[:-1]])
        tied[:-1] |= tied[1:]
        where = np.flatnonzero(tied)
        some = order[where]
        order[where] = some[np.argsort(key[some])]
        size += shift


def bounds_below(bwt: np.ndarray, first: np.ndarray, depth: int) -> np.ndarray:
    """For each bound between neighbouring rows whether their common prefix is below `depth`.

    bwt: the symbol before each sorted suffix, numbered densely; first: first row of each symbol, and the number of rows.
    """
    n = len(bwt)
    reached = np.zeros(n + 1, bool)
    order = np.argsort(bwt.astype(np.uint16) if len(first) < 65_536 else bwt, kind="stable")
    to = np.empty(n, np.int64)  # the row of the suffix that is one symbol longer
    to[order] = np.arange(n)
    same = bwt[order][1:] == bwt[order][:-1]
    after, before = np.full(n, n, np.int64), np.full(n, -1, np.int64)
    after[order[:-1][same]] = order[1:][same]
    before[order[1:][same]] = order[:-1][same]
    # round 0: the empty string's interval is extended by every symbol
    reached[0] = reached[first] = True
    low, high = first[:-1], first[1:]
    keep = high > low
    low, high = low[keep], high[keep]
    for _ in range(1, depth):
        if not len(low):
            break
        size = high - low
        single = size == 1
        ones = low[single]
        f, l = [to[ones]], [to[ones]]
        many = ~single
        a, b, m = low[many], high[many], size[many]
        for k in _chunks(m):
            a_, b_, m_ = a[k], b[k], m[k]
            place = np.arange(int(m_.sum())) + np.repeat(a_ - (np.cumsum(m_) - m_), m_)
            last = after[place] >= np.repeat(b_, m_)
            head = before[place] < np.repeat(a_, m_)
            # the intervals of one symbol longer strings are disjoint: sorted, firsts and lasts pair up
            f.append(np.sort(to[place[head]]))
            l.append(np.sort(to[place[last]]))
        low, high = np.concatenate(f), np.concatenate(l) + 1
        new = ~reached[high]
        low, high = low[new], high[new]
        reached[high] = True
    return reached


def _chunks(sizes: np.ndarray, most: int = 4_000_000) -> Iterator[slice]:
    """Slices of intervals with about `most` rows together."""
    if not len(sizes):
        return
    total = np.cumsum(sizes)
    cuts = [0, *np.unique(np.searchsorted(total, np.arange(most, int(total[-1]), most), "right")).tolist(), len(sizes)]
    for x, y in zip(cuts[:-1], cuts[1:], strict=True):
        if y > x:
            yield slice(x, y)


def repeated_starts(segments: list[bytes], depth: int = MIN_BYTES) -> np.ndarray:
    """Places, in the concatenation with one separator behind each segment, where a string of `depth` bytes starts that
    starts at another place too."""
    sizes = np.fromiter(map(len, segments), np.int64, len(segments))
    data = np.frombuffer(b"\0".join([*segments, b""]), np.uint8)
    ends = np.cumsum(sizes + 1) - 1
    used = np.unique(np.delete(data, ends))
    number = np.zeros(256, np.int64)
    number[used] = np.arange(len(used)) + len(segments)  # separators come first, each a symbol of its own
    symbols = number[data]
    symbols[ends] = np.arange(len(segments))
    order = suffix_order(symbols, depth)
    bwt = symbols[order - 1]
    count = np.bincount(symbols, minlength=len(segments) + len(used))
    first = np.concatenate([[0], np.cumsum(count)])
    reached = bounds_below(bwt, first, depth)
    return order[np.flatnonzero(~reached[:-1] | ~reached[1:])]


# on the cluster

OCCURRENCE = "anchor long, digest long, row long, start int, windows int, more binary"


def pack(docs: DataFrame) -> DataFrame:
    """row, doc_id, z: texts packed, each under a number of its own. To be written before it is read: the numbers of a plan
    that runs again may differ."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays([part.column("row"), part.column("doc_id"), pa.array([z.compress(t) for t in raw(part.column("text"))], pa.binary())], ["row", "doc_id", "z"])

    return texts(docs, F.monotonically_increasing_id().alias("row")).mapInArrow(run, "row long, doc_id long, z binary")


def occurrences(packed: DataFrame, min_bytes: int) -> DataFrame:
    """Runs of all documents; equal runs of one document are one row, whose `more` has the further starts."""
    names = ["anchor", "digest", "row", "start", "windows", "more"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        cols: list[list[np.ndarray]] = [[] for _ in range(5)]
        more: list[bytes | None] = []

        def made() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([*(pa.array(np.concatenate(c)) for c in cols), pa.array(more, pa.binary())], names)
            for c in cols:
                c.clear()
            more.clear()
            return out

        for batch in batches:
            for row, z in zip(batch.column("row").to_pylist(), batch.column("z"), strict=True):
                text = unzip.decompress(z.as_buffer())
                start, many, anchor = runs(text, min_bytes)
                if not len(start):
                    continue
                digest = np.fromiter((xxhash.xxh64_intdigest(text[a:b]) for a, b in zip(start.tolist(), (start + many + min_bytes - 1).tolist(), strict=True)), np.uint64, len(start))
                order = np.lexsort((start, digest, anchor))
                d, a = digest[order], anchor[order]
                head = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (a[1:] != a[:-1])]))
                one = order[head]
                for c, x in zip(cols, (anchor[one].view(np.int64), digest[one].view(np.int64), np.full(len(one), row, np.int64), start[one].astype(np.int32), many[one].astype(np.int32)), strict=True):
                    c.append(x)
                if len(one) == len(order):
                    more += [None] * len(one)
                else:
                    for x, y in zip(head.tolist(), [*head[1:].tolist(), len(order)], strict=True):
                        more.append(start[order[x + 1 : y]].astype("<i4").tobytes() if y - x > 1 else None)
                if len(more) > 20_000:
                    yield made()
        if more:
            yield made()

    return packed.select("row", "z").mapInArrow(run, OCCURRENCE)


def split_segment(segment: bytes, min_bytes: int) -> Iterator[tuple[int, int, int]]:
    """(key, first window, windows): runs of a segment's windows that agree in three further anchors."""
    n = len(segment) - min_bytes + 1
    keys, places = [], []
    h = gram_hashes(segment)
    for salt in SALTS[1:]:
        at = anchors(h, min_bytes - GRAM + 1, salt)
        places.append(at)
        keys.append(h[at])
    cut = np.zeros(n, bool)
    cut[0] = True
    for at in places:
        cut[1:] |= at[1:] != at[:-1]
    first = np.flatnonzero(cut)
    # the windows' places relative to their anchors agree in equal windows, so they may be part of the key
    for a, b in zip(first.tolist(), [*first[1:].tolist(), n], strict=True):
        key = xxhash.xxh64_intdigest(b"".join(k[a].tobytes() for k in keys))
        yield key - (1 << 64) if key >= 1 << 63 else key, a, b - a


def segments(packed: DataFrame, wanted: DataFrame, min_bytes: int) -> DataFrame:
    """The bytes of the wanted classes' segments: shard key, anchor, digest, offset (first window), twice, bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        for batch in batches:
            out: list[tuple] = []
            for z, picks in zip(batch.column("z").to_pylist(), batch.column("picks").to_pylist(), strict=True):
                text = unzip.decompress(z)
                for p in picks:
                    piece = text[p["start"] : p["start"] + p["windows"] + min_bytes - 1]
                    if p["big"]:
                        for key, a, m in split_segment(piece, min_bytes):
                            out.append((key, p["anchor"], p["digest"], a, p["twice"], piece[a : a + m + min_bytes - 1]))
                    else:
                        out.append((p["anchor"], p["anchor"], p["digest"], 0, p["twice"], piece))
                if len(out) > 4000:
                    yield made(out)
                    out = []
            if out:
                yield made(out)

    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary()]

    def made(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["key", "anchor", "digest", "at", "twice", "bytes"])

    picks = wanted.groupBy("row").agg(F.collect_list(F.struct("anchor", "digest", "start", "windows", "twice", "big")).alias("picks"))
    return packed.select("row", "z").join(picks, "row").select("z", "picks").mapInArrow(run, "key long, anchor long, digest long, at int, twice boolean, bytes binary")


def solve(pieces: DataFrame, shards: int, min_bytes: int) -> DataFrame:
    """anchor, digest, at, many, bits: for each piece of a single class which of its `many` windows repeat, packed, null for
    all; none: no row."""

    def shard(rows: list[tuple]) -> list[tuple]:
        """rows: (anchor, digest, at, twice, bytes)."""
        by: dict[bytes, list[tuple]] = {}
        for anchor, digest, at, twice, piece in rows:
            by.setdefault(piece, []).append((anchor, digest, at, twice))
        own = list(by)
        hit = np.zeros(sum(map(len, own)) + len(own) + 1, bool)
        hit[repeated_starts(own, min_bytes)] = True
        out, at = [], 0
        for piece in own:
            windows = len(piece) - min_bytes + 1
            members = {m[:3] for m in by[piece] if not m[3]}
            # a piece of several members stands in the text once and repeats whole
            flags = hit[at : at + windows] if len({m[:3] for m in by[piece]}) == 1 else np.ones(windows, bool)
            if members and flags.any():
                bits = None if flags.all() else np.packbits(flags).tobytes()
                out += [(a, d, x, windows, bits) for a, d, x in members]
            at += len(piece) + 1
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size, last = 0, None

        def done() -> pa.RecordBatch:
            found = shard(rows)
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in found], pa.int64()), pa.array([r[1] for r in found], pa.int64()), pa.array([r[2] for r in found], pa.int32()), pa.array([r[3] for r in found], pa.int32()), pa.array([r[4] for r in found], pa.binary())], ["anchor", "digest", "at", "many", "bits"])

        for batch in batches:
            for key, *row in zip(*(batch.column(c).to_pylist() for c in ("key", "anchor", "digest", "at", "twice", "bytes")), strict=True):
                # sorted by key: a shard is a run of keys of about SHARD_BYTES, and no key is divided
                if key != last and size > SHARD_BYTES:
                    yield done()
                    size = 0
                last = key
                rows.append(tuple(row))
                size += len(row[-1])
        if rows:
            yield done()

    return pieces.repartition(shards, "key").sortWithinPartitions("key").mapInArrow(run, "anchor long, digest long, at int, many int, bits binary")


def spans_of(hit: np.ndarray, min_bytes: int, size: int) -> np.ndarray:
    """(start, end) rows of what windows at the given starts cover."""
    step = np.bincount(hit, minlength=size + 1) - np.bincount(hit + min_bytes, minlength=size + 1)
    cover = np.concatenate([[False], np.cumsum(step[:-1]) > 0, [False]])
    turn = np.flatnonzero(cover[1:] != cover[:-1])
    return turn.reshape(-1, 2)


def remove_repeats(docs: DataFrame, min_bytes: int = MIN_BYTES, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, and with `with_text` kept (binary), for every row.

    Each byte covered by a string of `min_bytes` bytes that starts anywhere else too, in the same document or another, is
    removed; strings are judged on the input and never cross documents. Null texts count as empty; texts of any length are
    taken whole. Rows are told apart by a number of their own, so null and repeated doc_ids stay as they are, and rows that
    agree in everything are different places: each holds the other's strings. An empty table gives no rows. Columns beside
    doc_id and text are not read, so none can clash.
    """
    packed = materialise(pack(docs), "packed")
    found = materialise(occurrences(packed, min_bytes), "runs")
    places = F.sum(1 + F.coalesce(F.length("more") / 4, F.lit(0)).cast("long"))
    repeated = found.groupBy("anchor").agg(places.alias("n")).filter("n > 1").select("anchor")
    occ = materialise(found.join(repeated, "anchor", "left_semi"), "occurrences")
    forget(found)
    classes = occ.groupBy("anchor", "digest").agg((places > 1).alias("twice"), F.min(F.struct("row", "start", "windows")).alias("one"))
    classes = materialise(classes.select("anchor", "digest", "twice", F.col("one.row").alias("row"), F.col("one.start").alias("start"), F.col("one.windows").alias("windows")), "classes")
    open_ = classes.join(classes.filter(~F.col("twice")).select("anchor").distinct(), "anchor", "left_semi")
    weight = F.sum((F.col("windows") + min_bytes).cast("long"))
    big = open_.groupBy("anchor").agg(weight.alias("bytes")).filter(F.col("bytes") > BIG_ANCHOR).select("anchor", F.lit(True).alias("big"))
    total = open_.agg(weight).first()[0] or 0
    wanted = open_.join(big, "anchor", "left").withColumn("big", F.coalesce("big", F.lit(False)))
    whole = classes.filter("twice").select("anchor", "digest", F.lit(0).alias("at"), F.col("windows").alias("many"), F.lit(None).cast("binary").alias("bits"))
    bits = materialise(solve(segments(packed, wanted, min_bytes), max(1, -(-int(total) // (4 * SHARD_BYTES))), min_bytes).unionByName(whole), "bits")
    forget(classes)
    marks = occ.join(bits, ["anchor", "digest"]).select("row", F.struct("start", "more", "at", "many", "bits").alias("mark"))
    marks = marks.groupBy("row").agg(F.collect_list("mark").alias("marks"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        for batch in batches:
            out: list[tuple] = []
            for doc, z, marks_ in zip(batch.column("doc_id").to_pylist(), batch.column("z").to_pylist(), batch.column("marks").to_pylist(), strict=True):
                text = unzip.decompress(z)
                hits = []
                for m in marks_ or []:
                    own = np.arange(m["many"]) if m["bits"] is None else np.flatnonzero(np.unpackbits(np.frombuffer(m["bits"], np.uint8)))
                    places = [m["start"]] if m["more"] is None else [m["start"], *np.frombuffer(m["more"], "<i4").tolist()]
                    hits += [own + (m["at"] + p) for p in places]
                spans = spans_of(np.concatenate(hits), min_bytes, len(text)) if hits else np.zeros((0, 2), np.int64)
                kept, at = [], 0
                for a, b in spans.tolist():
                    kept.append(text[at:a])
                    at = b
                kept.append(text[at:])
                rest = b"".join(kept)
                out.append((doc, len(text), len(text) - len(rest), len(spans), hashlib.sha256(rest).hexdigest(), rest if with_text else None))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()), strict=True)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    joined = packed.join(marks, "row", "left").select("doc_id", "z", "marks")
    made = joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return made if with_text else made.drop("kept")
