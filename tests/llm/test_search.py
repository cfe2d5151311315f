"""Bit-sliced top-k against numpy, and the pipeline."""

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from eventloom.llm import bitsliced_topk, toxicity_cnn
from test_groups import brute_near

SF = "/root/testdata/sf0.001"


def brute(rows, k, scale=256):
    good = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    queries = {}
    for i, v in good:
        if i % 50 == 0:
            queries[i] = min(queries.get(i, v), v)
    out = []
    for q, v in queries.items():
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q))
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("spread,rows,dims,block", [(1.0, 700, 9, 64), (0.0, 130, 3, 8192), (50.0, 300, 5, 100), (0.004, 300, 4, 50)])
def test_top_k(spark, spread, rows, dims, block):
    """Small spreads make many ties; the large one needs more bits."""
    rng = np.random.default_rng(rows)
    data = [(i, [float(np.float32(x)) for x in rng.normal(0, 1, dims) * spread]) for i in range(rows)]
    data += [(3, data[7][1]), (50, data[9][1]), (None, data[1][1]), (9001, None), (9002, []), (9003, [None, 1.0]), (9050, [float("nan")] * dims), (9004, [float("inf")] * dims), (9100, data[2][1][:2])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumns({c: F.lit("clash") for c in ("parts", "rank", "score", "group")})
    got = sorted(tuple(r) for r in bitsliced_topk.top_k(df, F.col("vec_id") % 50 == 0, block_rows=block).collect())
    assert got == brute(data, 5)


def test_top_k_of_few_and_none(spark):
    df = spark.createDataFrame([(0, [0.5, -0.5]), (1, [0.25, 0.25])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in bitsliced_topk.top_k(df, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 0)]
    assert bitsliced_topk.top_k(df.filter("false"), F.col("vec_id") == 0).count() == 0
    with pytest.raises(ValueError):
        bitsliced_topk.top_k(spark.createDataFrame([(0, [1e30]), (1, [1.0])], "vec_id long, embedding array<float>"), F.col("vec_id") == 0)


def test_pipeline_stages(spark):
    """Each stage against its own plain version, on what the stage before kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, labels = docs.columns, spark.read.parquet(f"{SF}/labels.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF)
        kept[name] = docs.collect()
        if name == "toxicity":
            scored = toxicity_cnn.classify(before, toxicity_cnn.fit(before, labels)).collect()
            assert {r.doc_id for r in kept[name]} == {r.doc_id for r in scored if not r.toxic}
        elif name == "exact_dedup":
            best = defaultdict(int)
            for r in before.collect():
                best[r.text] = max(best[r.text], r.doc_id)
            assert {r.doc_id for r in kept[name]} == set(best.values())
        elif name == "simhash_near_dedup":
            rows = [(r.doc_id, r.text) for r in before.collect()]
            assert {r.doc_id for r in kept[name]} == {i for (i, _), first in zip(rows, brute_near(rows)[0]) if i == first}
        else:
            assert {r.doc_id for r in kept[name]} == {r.doc_id for r in before.collect()}
        if name != "packing":
            assert docs.columns == columns and len({r.doc_id for r in kept[name]}) == len(kept[name])
    assert corpus_pipeline.run(spark, SF).count() == len(kept["packing"])


def test_pipeline_of_awkward_rows(spark, awkward, nothing):
    for docs in (awkward, nothing):
        for name, stage in corpus_pipeline.STAGES:
            before, docs = docs, stage(spark, docs, SF)
            ids, were = [r.doc_id for r in docs.select("doc_id").collect()], {r.doc_id for r in before.select("doc_id").collect()}
            assert set(ids) <= were and (name == "packing" or docs.columns == before.columns)
        assert set(ids) == were  # each document that got so far is packed
        assert bool(ids) == (were != set())
    assert not ids
