"""Byte-level BPE on padded numpy matrices.

Distinct pre-tokens are put in matrices by length class. In every round each row merges its leftmost pair of least rank;
a pair's merged id comes from a hashed table, a row without a pair leaves the matrix, and the rest are compacted.
Pre-tokens of more than LONG bytes, for which rounds would take quadratic work, go through a heap that pops the same
pairs in the same order.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .chunks import ChunkEncoder
from .common import map_arrow, texts, tokenizer_file

LONG = 256
NONE = np.uint32(0xFFFFFFFF)
MIX = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """(left id, right id) -> merged id by open addressing in arrays. An id is also its rank."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = {}
        for whole, rank in ranks.items():
            for k in range(1, len(whole)):
                left, right = ranks.get(whole[:k]), ranks.get(whole[k:])
                if left is not None and right is not None:
                    pairs[(left << 32) | right] = rank
        self.pairs = pairs
        self.bits = max(4, int(4 * len(pairs)).bit_length())
        self.mask = (1 << self.bits) - 1
        self.keys = np.full(1 << self.bits, 0xFFFFFFFFFFFFFFFF, np.uint64)
        self.values = np.full(1 << self.bits, NONE, np.uint32)
        keys = np.fromiter(pairs, np.uint64, len(pairs))
        values = np.fromiter(pairs.values(), np.uint32, len(pairs))
        slots, self.probes = self._slot(keys), 0
        while len(keys):
            free = np.flatnonzero(self.values[slots] == NONE)
            _, one = np.unique(slots[free], return_index=True)
            put = free[one]
            self.keys[slots[put]], self.values[slots[put]] = keys[put], values[put]
            left = np.ones(len(keys), bool)
            left[put] = False
            keys, values, slots = keys[left], values[left], (slots[left] + 1) & self.mask
            self.probes += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged id of each pair, NONE where there is none; an id of NONE never pairs."""
        key = (left.astype(np.uint64) << np.uint64(32)) | right
        slot = self._slot(key)
        seen, out = self.keys[slot], self.values[slot]
        out = np.where(seen == key, out, NONE)
        miss = np.flatnonzero((seen != key) & (seen != np.uint64(0xFFFFFFFFFFFFFFFF)))
        for _ in range(self.probes):
            if not len(miss):
                break
            slot_m = (slot.flat[miss] + 1) & self.mask
            slot.flat[miss] = slot_m
            seen_m, want = self.keys[slot_m], key.flat[miss]
            hit = seen_m == want
            out.flat[miss[hit]] = self.values[slot_m[hit]]
            miss = miss[~hit & (seen_m != np.uint64(0xFFFFFFFFFFFFFFFF))]
        return out


class BytePairEncoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str, cached: int = 400_000):
        self.ranks, self.table = ranks, PairTable(ranks)
        self.single = np.array([ranks[bytes([i])] for i in range(256)], np.uint32)
        self.split = regex.compile(pattern)
        self.bytes_of = np.empty(max(ranks.values()) + 1, object)
        for whole, rank in ranks.items():
            self.bytes_of[rank] = whole
        self.pieces: dict[bytes, bytes] = {}
        self.cached = cached
        self.chunks = ChunkEncoder(self._encode_chunks, cached)

    # encoding

    def _merge_rows(self, rows: np.ndarray) -> list[bytes]:
        """rows: ids padded with NONE. Each round looks up only the pairs next to the last merge."""
        n = len(rows)
        out: list[bytes] = [b""] * n
        at = np.arange(n)
        width = (rows != NONE).sum(1)
        best = self.table.find(rows[:, :-1], rows[:, 1:]) if rows.shape[1] > 1 else np.empty((n, 0), np.uint32)
        while len(rows):
            if rows.shape[1] > 1:
                where = best.argmin(1)
                low = best[np.arange(len(rows)), where]
            else:
                where, low = np.zeros(len(rows), np.int64), np.full(len(rows), NONE)
            done = low == NONE
            if done.any():
                for i in np.flatnonzero(done).tolist():
                    out[at[i]] = rows[i, : width[i]].tobytes()
                keep = ~done
                rows, best, at, width, where, low = rows[keep], best[keep], at[keep], width[keep], where[keep], low[keep]
                if not len(rows):
                    break
            # compaction: everything right of the merged pair moves one place to the left
            m, w = rows.shape
            flat = np.arange(w - 1)[None, :]
            source = flat + (flat > where[:, None])
            rows = np.take_along_axis(rows, source, 1)
            r = np.arange(m)
            rows[r, where] = low
            width = width - 1
            top = int(width.max())
            if w - 1 > 1:
                flat = np.arange(w - 2)[None, :]
                best = np.take_along_axis(best, flat + (flat > where[:, None]), 1)
                right = np.flatnonzero(where < w - 2)
                best[right, where[right]] = self.table.find(rows[right, where[right]], rows[right, where[right] + 1])
                left = np.flatnonzero(where > 0)
                best[left, where[left] - 1] = self.table.find(rows[left, where[left] - 1], rows[left, where[left]])
            else:
                best = np.empty((m, 0), np.uint32)
            if top < rows.shape[1]:
                rows, best = rows[:, :top], best[:, : max(0, top - 1)]
        return out

    def _merge_long(self, piece: bytes) -> bytes:
        """One merge at a time, least rank first and leftmost among equals, by a heap over a linked list."""
        ids = self.single[np.frombuffer(piece, np.uint8)].tolist()
        n, find = len(ids), self.table.pairs.get
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            rank = find((ids[i] << 32) | ids[i + 1])
            if rank is not None:
                heap.append((rank, i, ids[i], ids[i + 1]))
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            if ids[i] != a or (j := nxt[i]) >= n or ids[j] != b:
                continue
            ids[i], ids[j] = rank, -1
            nxt[i] = k = nxt[j]
            if k < n:
                prv[k] = i
                if (rank := find((ids[i] << 32) | ids[k])) is not None:
                    heapq.heappush(heap, (rank, i, ids[i], ids[k]))
            if (h := prv[i]) >= 0 and (rank := find((ids[h] << 32) | ids[i])) is not None:
                heapq.heappush(heap, (rank, h, ids[h], ids[i]))
        return np.array([x for x in ids if x >= 0], np.uint32).tobytes()

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """ids (32-bit, little-endian) of each pre-token, each by itself."""
        out: list[bytes] = [b""] * len(pieces)
        classes: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            n = len(piece)
            if n > LONG:
                out[i] = self._merge_long(piece)
            elif n:
                classes.setdefault(n if n <= 24 else -(-n // 16) * 16, []).append(i)
        for width, members in classes.items():
            step = max(1, 400_000 // width)
            for k in range(0, len(members), step):
                some = members[k : k + step]
                data = [pieces[i] for i in some]
                if width <= 24:
                    rows = self.single[np.frombuffer(b"".join(data), np.uint8)].reshape(len(some), width)
                else:
                    rows = self.single[np.frombuffer(b"".join(x.ljust(width, b"\0") for x in data), np.uint8)].reshape(len(some), width)
                    sizes = np.fromiter(map(len, data), np.int64, len(data))
                    rows[np.arange(width)[None, :] >= sizes[:, None]] = NONE
                for i, ids in zip(some, self._merge_rows(rows), strict=True):
                    out[i] = ids
        return out

    def _encode_chunks(self, chunks: list[str]) -> list[bytes]:
        parts = [[p.encode() for p in self.split.findall(x)] for x in chunks]
        fresh = list({p for x in parts for p in x if p not in self.pieces})
        new = dict(zip(fresh, self.encode_pieces(fresh), strict=True))
        get, kept = new.get, self.pieces.get
        out = [b"".join([get(p) or kept(p) for p in x]) for x in parts]
        if len(self.pieces) < self.cached // 8:
            self.pieces.update((p, ids) for p, ids in new.items() if len(p) <= 32)
        return out

    def encode(self, texts_: list[str]) -> list[bytes]:
        return self.chunks.block(texts_)

    # decoding

    def decode(self, ids: bytes) -> bytes:
        return b"".join(self.bytes_of[np.frombuffer(ids, "<u4")].tolist())


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> BytePairEncoder:
    """One encoder, and one memory of chunks, for all tasks of a Python worker."""
    return BytePairEncoder(read_ranks(path), pattern)


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def encode_documents(docs: DataFrame, path: str | None = None, pattern: str | None = None, decode: bool = True) -> DataFrame:
    """doc_id, ids (binary, 32-bit little-endian), decoded (binary). Null texts count as empty: no ids, no bytes.

    Every row gives a row; repeated and null doc_ids stay as they are. Texts are encoded whole.
    """
    path, pattern = path or tokenizer_file("byte_bpe_50k.tiktoken"), pattern or default_pattern()

    def block(batch: pa.RecordBatch):
        enc = encoder(path, pattern)
        ids = enc.encode(batch.column("text").to_pylist())
        decoded = [enc.decode(x) for x in ids] if decode else [None] * len(ids)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())], ["doc_id", "ids", "decoded"])

    return map_arrow(texts(docs), block, "doc_id long, ids binary, decoded binary")


def digests(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """What round trips are compared by: doc_id, n_tokens, ids_sha256, decoded_sha256, made in the pass that encodes.

    Null and empty texts have no ids and the sha256 of nothing; texts of any length are encoded whole. Every row gives a
    row, repeated ones and those without a doc_id too. An empty table gives no rows. Columns beside doc_id and text are
    not read, so none can clash.
    """
    path, pattern = path or tokenizer_file("byte_bpe_50k.tiktoken"), pattern or default_pattern()

    def block(batch: pa.RecordBatch):
        enc = encoder(path, pattern)
        ids = enc.encode(batch.column("text").to_pylist())
        sha = lambda x: hashlib.sha256(x).hexdigest()
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([sha(x) for x in ids]), pa.array([sha(enc.decode(x)) for x in ids])],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return map_arrow(texts(docs), block, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
