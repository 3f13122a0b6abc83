import hashlib
import random

import numpy as np
import pytest
import public_tokenizers
import tiktoken

from editloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def test_random_texts_encode_as_the_library_does(library):
    rng = random.Random(5)
    alphabet = "aabbcc  \n\t é日本1239'ts.! \x1c\x85\u00a0<|endoftext|>the ing"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(80))) for _ in range(3000)]
    texts += ["a" * 1000, "ab" * 700, "the" * 300 + " " * 400, "x" + " " * 300 + "y", "", " ", "".join(rng.choice("abcdeths") for _ in range(4000))]
    mine = bpe.BytePairEncoder(bpe.read_ranks(PATH), public_tokenizers.PATTERN, cached=500)
    out = [x for k in range(0, len(texts), 400) for x in mine.encode(texts[k : k + 400])]
    for text, ids in zip(texts, out, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
        assert mine.decode(ids) == text.encode()


def test_leftmost_least_pair_first_even_if_ranks_are_not_monotone():
    ranks = {bytes([i]): i + 1000 for i in range(256)} | {b"ab": 50, b"aba": 10, b"abab": 60, b"bc": 5}
    mine = bpe.BytePairEncoder(ranks, r"[\s\S]+")
    library = tiktoken.Encoding("t", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    for text in ["abab", "aabab", "abc", "ababab", *("".join(rng.choice("abc") for _ in range(rng.randrange(1, 400))) for _ in range(200))]:
        assert np.frombuffer(mine.encode([text])[0], "<u4").tolist() == library.encode_ordinary(text)


def test_digests(spark, edge_docs, no_docs, docs, library):
    rows = bpe.digests(edge_docs.unionByName(docs, allowMissingColumns=True)).collect()
    want = [(r["doc_id"], r["text"] or "") for r in edge_docs.collect() + docs.collect()]

    def key(x):
        return (x[0] is None, x[0] or 0, x[1], x[2])

    expect = []
    for doc, text in want:
        ids = np.array(library.encode_ordinary(text), "<u4").tobytes()
        expect.append((doc, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(tuple, rows), key=key) == sorted(expect, key=key)
    assert bpe.digests(no_docs).count() == 0
    assert {r["decoded"].decode() for r in bpe.encode_documents(edge_docs).collect()} == {r["text"] or "" for r in edge_docs.collect()}
