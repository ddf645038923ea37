"""The registered queries and the pipeline on the smallest tables."""

import math
import os
import re
from collections import Counter, defaultdict

import duckdb
import pytest

import corpus_pipeline
from checks.compare import connect, rows_of
from patronage.llm import mixing, registry
from patronage.llm.oracles import oracle_sql

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_duckdb(spark, name):
    df = registry.queries()[name](spark, FOLDER)
    found = connect(FOLDER).execute(oracle_sql()[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, found.fetchall())


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - {"op13_turn_trie"}))
def test_one_row_per_row_of_the_table(spark, name):
    df = registry.queries()[name](spark, FOLDER)
    tables = {"op1_warc": ("pages", "page_id"), "op11_centroids": ("embeddings", "vec_id")}
    table, key = tables.get(name, ("documents", "doc_id"))
    want = duckdb.sql(f"SELECT {key} FROM read_parquet('{FOLDER}/{table}.parquet') ORDER BY 1").fetchall()
    assert sorted(r[0] for r in df.select(key).collect()) == [r[0] for r in want]


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        after = stage(spark, docs, FOLDER)
        rows = after.collect()
        assert set(docs.columns) <= set(after.columns) and {r.doc_id for r in rows} <= set(before)
        if name == "exact_dedup":
            bare = [re.sub("[\x20\x09-\x0d]", "", r.text or "") for r in rows]
            assert len(set(bare)) == len(bare)
            assert set(bare) == {re.sub("[\x20\x09-\x0d]", "", t or "") for t in before.values()}
        if name in ("mixing", "sentencepiece"):
            assert len(rows) == len(before)
        counts.append(len(rows))
        docs = spark.createDataFrame(rows, after.schema).select(*docs.columns) if rows else after
    assert counts[0] > counts[1] > counts[2] >= counts[3] == counts[4] == counts[5] > 0


def test_stages_may_follow_without_a_write_between(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[1:]:
        docs = stage(spark, docs, FOLDER)
    assert docs.count() > 0
    written_between = corpus_pipeline.run(spark, FOLDER)
    assert written_between.columns[-2:] == ["piece_ids", "n_pieces"] and written_between.count() > 0


def test_pipeline_returns_the_mixture(spark):
    result = corpus_pipeline.run(spark, FOLDER)
    rows = sorted(result.select("slot", "in_block", "source", "doc_id").collect())
    assert len({(r.slot, r.in_block) for r in rows}) == len(rows) > 0
    by_source, slots = defaultdict(list), {}
    for r in rows:
        by_source[r.source].append(r.doc_id)
        assert slots.setdefault(r.slot, r.source) == r.source
    assert sorted(slots) == list(range(len(slots)))
    assert all(ids == sorted(ids) for ids in by_source.values())
    blocks = {s: math.ceil(len(ids) / mixing.BLOCK_ROWS) for s, ids in by_source.items()}
    assert len(slots) == sum(blocks.values())
    # Less than one block from the fluid schedule after every slot.
    weight = {s: registry.TARGET_WEIGHTS.get(s, 1.0) for s in blocks}
    fluid = lambda v: sum(min(weight[s] * v, n) for s, n in blocks.items())
    run = Counter()
    for slot in range(len(slots)):
        run[slots[slot]] += 1
        low, high = 0.0, max(n / weight[s] for s, n in blocks.items())
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (middle, high) if fluid(middle) < slot + 1 else (low, middle)
        assert all(abs(run[s] - min(weight[s] * high, n)) < 1 + 1e-5 for s, n in blocks.items())
