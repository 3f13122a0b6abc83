"""Token ids in seekable zstandard files.

A file is a run of independent zstandard frames, each of whole documents, then a skippable frame with the document index
(compressed), then the seek table of the public "seekable format": one entry a frame with compressed size, plain size
and the low half of the plain bytes' XXH64. A reader takes the footer, the table and the index, and decompresses only
the frames that hold the documents it is asked for.
"""

from __future__ import annotations

import io
import os
import struct
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import regex
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .chunks import ChunkEncoder
from .common import new_folder, slices, texts, tokenizer_file

SKIPPABLE, INDEX_MAGIC, SEEK_MAGIC, FOOT_MAGIC = 0x184D2A5E, 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
FRAME_BYTES = 256 * 1024
KEPT = 800_000  # chunks a worker keeps, about 200 MB
SPACE_MARK = "\u0120"  # a space in the vocabulary's spelling of bytes
NO_ID = -(2**63)  # stands for a null doc_id in the index
PLAIN = "ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=True)"
WORD_AND_SIGNS = regex.compile(r"( \p{L}+)([^\s\p{L}\p{N}']*)(?:(\n)(\p{L}+)([^\s\p{L}\p{N}']*))?")


def spelling() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: itself if it can be seen, else one from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + k) for k, b in enumerate(rest)}


def letter_and_space(token: str, spelled: dict[int, str]) -> bool:
    """Whether a token, in the vocabulary's spelling of bytes, may have a space behind a letter."""
    if SPACE_MARK not in token.lstrip(SPACE_MARK):
        return False
    back = {c: b for b, c in spelled.items()}
    try:
        return regex.search(r"\p{L} ", bytes(back[c] for c in token).decode()) is not None
    except (KeyError, UnicodeDecodeError):
        return True


class TokenFileWriter:
    """add() documents in order, then close(). Frames hold whole documents of about FRAME_BYTES; a longer one has its own."""

    def __init__(self, out: io.RawIOBase, dtype: str, level: int = 3, frame_bytes: int = FRAME_BYTES):
        self.out, self.dtype, self.frame_bytes = out, np.dtype(dtype), frame_bytes
        self.zip = zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.held: list[bytes] = []
        self.size = self.tokens = self.docs = 0
        self.entries: list[tuple[int, int, int]] = []
        self.ids: list[int] = []
        self.lengths: list[int] = []
        self.frames: list[int] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        if self.held and self.size + len(ids) > self.frame_bytes:
            self._flush()
        n = len(ids) // self.dtype.itemsize
        self.held.append(ids)
        self.ids.append(NO_ID if doc_id is None else doc_id)
        self.lengths.append(n)
        self.frames.append(len(self.entries))
        self.size += len(ids)
        self.tokens += n
        self.docs += 1

    def _flush(self) -> None:
        plain = b"".join(self.held)
        packed = self.zip.compress(plain)
        self.out.write(packed)
        self.entries.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        self.held, self.size = [], 0

    def close(self) -> None:
        if self.held:
            self._flush()
        n = len(self.ids)
        index = b"".join(np.array(x, "<i8").tobytes() for x in (self.ids, self.lengths, self.frames))
        index = struct.pack("<Q4s", n, self.dtype.str[1:].encode().ljust(4)) + self.zip.compress(index)
        self.out.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        self.entries.append((8 + len(index), 0, 0))
        body = b"".join(struct.pack("<III", *e) for e in self.entries) + struct.pack("<IBI", len(self.entries), 0x80, FOOT_MAGIC)
        self.out.write(struct.pack("<II", SEEK_MAGIC, len(body)) + body)


class TokenFileReader:
    def __init__(self, f):
        self.f = f
        size = f.seek(0, 2)
        f.seek(max(0, size - 9))
        foot = f.read(9)
        if len(foot) < 9 or struct.unpack("<IBI", foot)[2] != FOOT_MAGIC:
            raise ValueError("no seek table at the end of the file")
        count = struct.unpack("<IBI", foot)[0]
        f.seek(size - 9 - 12 * count)
        table = np.frombuffer(f.read(12 * count), "<u4").reshape(count, 3)
        self.packed, self.plain, self.sums = (table[:, k].astype(np.int64) for k in range(3))
        self.starts = np.concatenate([[0], np.cumsum(self.packed)])
        f.seek(int(self.starts[-2]) + 8)
        data = f.read(int(self.packed[-1]) - 8)
        n, kind = struct.unpack("<Q4s", data[:12])
        self.dtype = np.dtype("<" + kind.decode().strip())
        index = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[12:]), "<i8").reshape(3, n) if n else np.zeros((3, 0), np.int64)
        self.doc_ids, self.lengths, self.frame_of = index
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)])
        self.unzip = zstandard.ZstdDecompressor()
        self.decompressed = 0

    def frame(self, k: int) -> np.ndarray:
        self.f.seek(int(self.starts[k]))
        plain = self.unzip.decompress(self.f.read(int(self.packed[k]))) if self.plain[k] else b""
        if xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != self.sums[k] or len(plain) != self.plain[k]:
            raise ValueError(f"frame {k} is damaged")
        self.decompressed += 1
        return np.frombuffer(plain, self.dtype)

    def rows(self, wanted: Iterable[int] | None = None) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, tokens before it in the file, ids) of all documents, or of the wanted ones, in the file's order."""
        pick = np.arange(len(self.doc_ids)) if wanted is None else np.flatnonzero(np.isin(self.doc_ids, np.array(list(wanted), np.int64)))
        last, ids, base = -1, None, 0
        for i in pick.tolist():
            k = int(self.frame_of[i])
            if k != last:
                ids, last = self.frame(k), k
                base = int(self.offsets[np.searchsorted(self.frame_of, k)])
            a = int(self.offsets[i]) - base
            doc = int(self.doc_ids[i])
            yield (None if doc == NO_ID else doc), int(self.offsets[i]), ids[a : a + int(self.lengths[i])]


class TextEncoder:
    """ids of texts as the library gives them: by chunks, and whole where a text holds the name of an added token, which the
    library cuts out before anything else."""

    def __init__(self, tok, chunks: ChunkEncoder, dtype: str):
        self.tok, self.chunks, self.dtype = tok, chunks, dtype
        self.names = [t.content for t in tok.get_added_tokens_decoder().values()]

    def block(self, texts: list[str]) -> list[bytes]:
        whole = [i for i, t in enumerate(texts) if any(n in t for n in self.names)]
        if not whole:
            return self.chunks.block(texts)
        own = set(whole)
        out = dict(zip(whole, (np.array(self.tok.encode(texts[i], add_special_tokens=False).ids, self.dtype).tobytes() for i in whole), strict=True))
        rest = [i for i in range(len(texts)) if i not in own]
        out.update(zip(rest, self.chunks.block([texts[i] for i in rest]), strict=True))
        return [out[i] for i in range(len(texts))]


@lru_cache(maxsize=2)
def text_encoder(path: str, dtype: str) -> TextEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    vocab = tok.get_vocab(with_added_tokens=False)
    marks = np.zeros(tok.get_vocab_size(with_added_tokens=True), bool)  # tokens that start with a space
    for token, k in vocab.items():
        marks[k] = token.startswith(SPACE_MARK)
    spelled = spelling()
    # words behind a space can go to the model many at a time where its input is made as here and no token holds a space
    # behind a letter, so that none reaches into the next word
    plain = tok.normalizer is None and str(tok.pre_tokenizer) == PLAIN and not any(letter_and_space(t, spelled) for t in vocab)
    size = np.dtype(dtype).itemsize

    def by_library(chunks: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype).tobytes() for e in tok.encode_batch_fast(chunks, add_special_tokens=False)]

    def words(fresh: list[str]) -> list[bytes]:
        """Each a space and letters."""
        out: list[bytes] = []
        for k in range(0, len(fresh), 500):
            some = fresh[k : k + 500]
            made = tok.model.tokenize("".join(some).encode().decode("latin-1").translate(spelled))
            ids = np.fromiter([t.id for t in made], dtype, len(made))
            starts = np.flatnonzero(marks[ids])
            if len(starts) != len(some):  # not met, but nothing may depend on it
                out += by_library(some)
                continue
            data, at = ids.tobytes(), [*(starts * size).tolist(), len(ids) * size]
            out += [data[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
        return out

    def encode(chunks: list[str]) -> list[bytes]:
        """Words of letters behind a space go to the model. The signs that end them, and a line that begins behind, are cut off
        as every pre-tokenizer of this kind cuts them, and go to the library, as all other chunks do."""
        found = [WORD_AND_SIGNS.fullmatch(x) for x in chunks] if plain else [None] * len(chunks)
        parts = [[x] if m is None else [p for p in m.groups() if p] for x, m in zip(chunks, found, strict=True)]
        known: dict[str, bytes] = {}
        fresh, others = {}, {}
        for own, m in zip(parts, found, strict=True):
            for k, p in enumerate(own):
                if k or m is None:
                    others[p] = None
                elif (ids := enc.inner.get(p[1:])) is not None:
                    known[p] = ids
                else:
                    fresh[p] = None
        known.update(zip(fresh, words(list(fresh)), strict=True))
        known.update(zip(others, by_library(list(others)), strict=True))
        return [known[own[0]] if len(own) == 1 else b"".join([known[p] for p in own]) for own in parts]

    enc = ChunkEncoder(encode, KEPT)
    return TextEncoder(tok, enc, dtype)


def write_tokens(docs: DataFrame, folder: str | None = None, path: str | None = None, end_id: int = 2, files: int | None = None) -> tuple[str, DataFrame]:
    """Write the ids of every whole text, `end_id` behind each, in ascending doc_id order (null first, ties in any order).

    One file a range of doc_ids, named by its place. Returns the folder and the manifest: file, part, docs, tokens,
    start (tokens in the files before). A task that runs again writes the same file again under a name of its own and
    then renames it. Only the manifest, one row a file, comes to the driver. Null texts count as empty.
    """
    spark = docs.sparkSession
    folder, path = folder or new_folder(spark, "tokens"), path or tokenizer_file("byte_bpe_50k.json")
    # the ids of the vocabularies here fit 16 bits; a larger vocabulary takes 32
    from tokenizers import Tokenizer

    dtype = "<u2" if max(Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True), end_id) < 65536 else "<u4"
    rows = texts(docs)
    rows = rows.repartitionByRange(files, "doc_id") if files else rows.repartitionByRange("doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part, attempt = task.partitionId(), task.taskAttemptId()
        fs, base = pafs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        end = np.array([end_id], dtype).tobytes()
        name, temp = f"{base}/part-{part:06d}.tok", f"{base}/.part-{part:06d}.{attempt}"
        enc, writer, out = text_encoder(path, dtype), None, None
        for batch in batches:
            for some in slices(batch):
                if writer is None:
                    out = fs.open_output_stream(temp, compression=None)
                    writer = TokenFileWriter(out, dtype)
                for doc, ids in zip(some.column("doc_id").to_pylist(), enc.block(some.column("text").to_pylist()), strict=True):
                    writer.add(doc, ids + end)
        if writer is not None:
            writer.close()
            out.close()
            fs.move(temp, name)
            yield pa.RecordBatch.from_pydict({"file": [name], "part": [part], "docs": [writer.docs], "tokens": [writer.tokens]}, pa.schema([("file", pa.string()), ("part", pa.int64()), ("docs", pa.int64()), ("tokens", pa.int64())]))

    made = sorted(rows.sortWithinPartitions("doc_id").mapInArrow(run, "file string, part long, docs long, tokens long").collect(), key=lambda r: r["part"])
    starts = np.concatenate([[0], np.cumsum([r["tokens"] for r in made], dtype=np.int64)]).tolist()
    manifest = [(r["file"], r["part"], r["docs"], r["tokens"], s) for r, s in zip(made, starts, strict=False)]
    return folder, spark.createDataFrame(manifest, "file string, part long, docs long, tokens long, start long")


def read_tokens(folder: str, manifest: DataFrame, schema: str = "doc_id long, start long, ids array<int>", row=None) -> DataFrame:
    """One row a document from the files: doc_id, start (tokens before it in all files) and its ids, or what `row` makes of those."""
    row = row or (lambda doc, start, ids: (doc, start, ids.astype(np.int32).tolist()))
    kinds = to_arrow_schema(StructType.fromDDL(schema))

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), kinds, strict=True)], schema=kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for file, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True):
                with fs.open_input_file(file) as f:
                    out = []
                    for doc, before, ids in TokenFileReader(f).rows():
                        out.append(row(doc, start + before, ids))
                        if len(out) >= 500:
                            yield made(out)
                            out = []
                    if out:
                        yield made(out)

    many = max(1, min(manifest.count(), 4 * manifest.sparkSession.sparkContext.defaultParallelism))
    return manifest.select("file", "start").repartition(many, F.xxhash64("file")).mapInArrow(run, schema)


def digests(docs: DataFrame, **options) -> DataFrame:
    """Write all documents, read the files back, and give doc_id, start, n_tokens and the crc32 of the ids in 32 bits.

    Null and empty texts have the end id alone; texts of any length are encoded whole. Every row gives a row: null doc_ids
    come first, rows of one doc_id in any order. An empty table writes no file and gives no rows. Columns beside doc_id
    and text are not read, so none can clash.
    """
    folder, manifest = write_tokens(docs, **options)
    return read_tokens(folder, manifest, "doc_id long, start long, n_tokens long, ids_crc32 long", lambda doc, start, ids: (doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
