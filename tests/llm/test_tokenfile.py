import io
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from tokenizers import Tokenizer

from editloom.llm import tokenfile


def library_ids(texts):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [[*e.ids, 2] for e in tok.encode_batch(texts, add_special_tokens=False)]


def made(frame_bytes=64, n=50):
    out = io.BytesIO()
    w = tokenfile.TokenFileWriter(out, "<u2", frame_bytes=frame_bytes)
    data = {i * 3: np.arange(i % 40, dtype="<u2") for i in range(n)}
    for k, v in data.items():
        w.add(k, v.tobytes())
    w.close()
    return out.getvalue(), data


def test_reader_decompresses_only_the_frames_it_needs():
    raw, data = made()
    r = tokenfile.TokenFileReader(io.BytesIO(raw))
    got = list(r.rows([30, 33, 999]))
    assert [(d, x.tolist()) for d, _, x in got] == [(30, data[30].tolist()), (33, data[33].tolist())]
    assert r.decompressed <= 2 < len(r.packed) - 1
    assert [(d, x.tolist()) for d, _, x in tokenfile.TokenFileReader(io.BytesIO(raw)).rows()] == [(k, v.tolist()) for k, v in data.items()]


def test_plain_zstandard_reads_the_stream_and_skips_index_and_table():
    raw, data = made()
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
    assert plain == b"".join(v.tobytes() for v in data.values())


def test_damage_is_found():
    raw, _ = made()
    r = tokenfile.TokenFileReader(io.BytesIO(raw))
    r.sums = r.sums.copy()
    r.sums[3] ^= 1
    with pytest.raises(ValueError, match="frame 3"):
        r.frame(3)


def test_empty_file():
    raw, _ = made(n=0)
    assert list(tokenfile.TokenFileReader(io.BytesIO(raw)).rows()) == []


def test_digests(spark, docs, edge_docs, no_docs):
    both = docs.unionByName(edge_docs.withColumn("doc_id", edge_docs.doc_id + 10_000), allowMissingColumns=True)
    rows = sorted((tuple(r) for r in tokenfile.digests(both, files=5).collect()), key=lambda r: r[1])
    source = sorted(((r["doc_id"], r["text"] or "") for r in both.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r[0] for r in rows] == [d for d, _ in source]
    at, expect = 0, set()
    for (doc, _), ids in zip(source, library_ids([t for _, t in source]), strict=True):
        expect.add((doc, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert {(d, n, c) for d, _, n, c in rows} == expect
    for _, start, n, _ in rows:
        assert start == at
        at += n
    assert tokenfile.digests(no_docs).count() == 0


def test_names_of_added_tokens_are_read_as_the_library_does(spark):
    texts = ["x<|endoftext|>y", "<|endoftext|>", " a <|endoftext|> b", "<|endoftext|", "a b <|endoftext|><|endoftext|> c  d\n", "plain text"]
    folder, manifest = tokenfile.write_tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    got = {r["doc_id"]: r["ids"] for r in tokenfile.read_tokens(folder, manifest).collect()}
    assert got == dict(enumerate(library_ids(texts))) and 50256 in got[0]


def test_random_texts_equal_the_library(spark):
    rng = random.Random(7)
    pieces = ["a", "The", "été", "ß", "日本", "1", "42", "'", "'s", "n't", ",", ".", "!!", "$", "\n", "\n\n", " ", "  ", "\t", "\u00a0", "word", "Übung", "²", "\u0301", "<|endoftext|>", "x" * 30]
    texts = ["".join(rng.choices(pieces, [4 if p in (" ", "word", "a", "The") else 1 for p in pieces], k=rng.randrange(60))) for _ in range(3000)]
    folder, manifest = tokenfile.write_tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), files=3)
    got = {r["doc_id"]: r["ids"] for r in tokenfile.read_tokens(folder, manifest).collect()}
    assert got == dict(enumerate(library_ids(texts)))


def test_ids_come_back(spark, docs):
    folder, manifest = tokenfile.write_tokens(docs, files=3)
    got = {r["doc_id"]: r["ids"] for r in tokenfile.read_tokens(folder, manifest).collect()}
    rows = docs.collect()
    assert got == dict(zip([r["doc_id"] for r in rows], library_ids([r["text"] for r in rows]), strict=True))
