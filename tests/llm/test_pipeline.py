import os

import pytest

import corpus_pipeline
from editloom.llm import decontam, mil, pii, simhash, stages
from editloom.llm.common import shared_dir
from tests.llm.test_bpe import library  # noqa: F401

SF = "/root/testdata/sf0.001"


def plain_groups(rows, similarity):
    """Least doc_id of the group of each row, by the shingle sets of every pair; texts of the same words are one."""
    sets = {d: (t.lower().split(), set(simhash.shingles((t or "").encode(), 5))) for d, t in rows.items()}
    top = {d: d for d in rows}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(rows)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            (wa, x), (wb, y) = sets[a], sets[b]
            if wa == wb or (x & y and len(x & y) / len(x | y) >= similarity):
                low, high = sorted((find(a), find(b)))
                top[high] = low
    return {d: find(d) for d in ids}


def folders(spark):
    return set(os.listdir(shared_dir(spark).removeprefix("file://")))


def test_rows_equal_a_plain_version(spark, library):  # noqa: F811
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = mil.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = {d: t for d, t in rows.items() if model.score([t.encode()])[0] >= 0.7}
    group = plain_groups(rows, 0.8)
    rows = {d: t for d, t in rows.items() if group[d] == d}
    items = [(r["item_id"], r["text"].encode()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    index = decontam.ContainmentIndex(items)
    rows = {d: t for d, t in rows.items() if not index.search([t.encode()])[0]}
    want = {d: library.encode_ordinary(pii.redact(t, pii.find(t))) for d, t in rows.items()}
    before = folders(spark)
    got = {r["doc_id"]: r["token_ids"] for r in corpus_pipeline.run(spark, SF).collect()}
    assert len(folders(spark) - before) == 1  # the last stage's rows alone are left
    assert got == want and 0 < len(got) < docs.count()


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_take_edge_rows(spark, edge_docs, no_docs, name, stage):
    out = stage(spark, edge_docs, SF)
    rows = out.collect()
    if stage is not stages.encoded:
        assert out.columns == edge_docs.columns
    if stage is stages.without_near_copies:
        ids = [r["doc_id"] for r in rows if r["doc_id"] is not None]
        assert len(ids) == len(set(ids)) and 6 not in ids and 5 in ids and 1 not in ids
    if stage is stages.without_benchmark:
        assert len(rows) == edge_docs.count()
    assert stage(spark, no_docs, SF).count() == 0
