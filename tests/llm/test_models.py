"""Ranked search, whitening and language-model scores against plain versions."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import k2_treap, maxent_lm, whitening

SF = "/root/testdata/sf0.001"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute_search(docs, items, k):
    """(item_id, rank, doc_id, score), straight from the definition."""
    held = [(i, Counter(TERM.findall(lower(t or "")))) for i, t in docs]
    n = [sum(c.values()) for _, c in held]
    documents, total = sum(x > 0 for x in n), sum(n)
    df = Counter(t for _, c in held for t in c)
    texts = {}
    for i, t in items:
        texts[i] = min(texts.get(i, t or ""), t or "")
    out = []
    for item, text in texts.items():
        scored = []
        for (doc_id, c), size in zip(held, n):
            if doc_id is None:
                continue
            score = 0
            for t in set(TERM.findall(lower(text))) & c.keys():
                m = 50 + 50 * size * documents // total
                score += math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, doc_id))
        out += [(item, rank, doc_id, -s) for rank, (s, doc_id) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("range_docs,k", [(7, 5), (1 << 14, 50)])
def test_search_of_the_documents(spark, range_docs, k):
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    got = sorted((tuple(r) for r in k2_treap.top_documents(docs, items, k=k, range_docs=range_docs).collect()), key=str)
    assert got == brute_search([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], k)


def test_search_with_ties_copies_and_awkward_rows(spark, awkward, nothing):
    rng = np.random.default_rng(3)
    words = ["alpha", "beta", "Gamma", "δέλτα", "x1", "café", "the", "of"]
    docs = [(i, " ".join(rng.choice(words, rng.integers(0, 9))) + "." * int(i % 3)) for i in range(150)]
    docs += [(200 + i, "alpha beta beta, the copy") for i in range(40)] + [(7, "alpha"), (7, "alpha"), (None, "alpha beta"), (300, None), (301, ""), (302, "\x00--\t")]
    items = [(0, "Alpha BETA"), (1, "the of the"), (2, None), (3, "???"), (4, "δέλτα GAMMA café x1"), (4, "unmet"), (5, "unmet word"), (None, "alpha")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5).withColumns({c: F.lit("clash") for c in ("terms", "tf", "n", "score", "rank")})
    q = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("clash"))
    for range_docs in (4, 1000):
        got = sorted((tuple(r) for r in k2_treap.top_documents(d, q, k=10, range_docs=range_docs).collect()), key=str)
        assert got == brute_search(docs, items, 10)
    got = sorted((tuple(r) for r in k2_treap.top_documents(awkward, awkward, k=3, item_id="doc_id").collect()), key=str)
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert got == brute_search(rows, rows, 3)
    assert k2_treap.top_documents(nothing, q).count() == 0 and k2_treap.top_documents(d, q.filter("false")).count() == 0


def test_search_in_parts(spark, monkeypatch):
    monkeypatch.setattr(k2_treap, "MOST_TERMS", 3)
    docs = [(i, f"a{i % 5} b{i % 3} c") for i in range(60)]
    items = [(i, f"a{i} b{i} c") for i in range(6)]
    got = k2_treap.top_documents(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), k=4)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_search(docs, items, 4)


def test_treap_keeps_its_cells_and_its_order():
    rng = np.random.default_rng(8)
    for height, cells in ((0, 1), (1, 3), (4, 90), (7, 3000)):
        side = 1 << height
        at = rng.choice(side * side, cells, replace=False)
        rows, cols, values = at // side, at % side, rng.integers(1, 50, cells)
        treap = k2_treap.unpacked(k2_treap.build(rows, cols, values, height))
        assert sorted(zip(treap.row, treap.col, treap.value)) == sorted(zip(rows, cols, values))
        for node in range(len(treap.value)):  # a parent's impact is at least its children's, and links stay in the quadrant
            for child in range(bin(treap.mask[node]).count("1")):
                assert treap.value[treap.first[node] + child] <= treap.value[node]
            link, span = treap.link[node], height - treap.depth[node]
            if link >= 0:
                assert treap.row[link] >> span == treap.row[node] >> span and treap.col[link] >> span == treap.col[node] >> span


def plain_whitening(x, components):
    n = len(x)
    c = x - x.sum(axis=0) / n
    values, vectors = np.linalg.eigh(c.T @ c / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    count = min(components, int((values > 1e-9 * values[0]).sum()))
    return values, c @ vectors[:, :count] / np.sqrt(values[:count])


@pytest.mark.parametrize("rows,dims,rank,parts", [(300, 6, 6, 4), (500, 40, 40, 7), (60, 5, 3, 3), (3, 8, 2, 2), (50, 1, 1, 3)])
def test_whitening_against_eigh(spark, rows, dims, rank, parts):
    rng = np.random.default_rng(dims)
    basis = rng.integers(-2, 3, (rank, dims)) if rank < dims else np.eye(dims)
    data = (rng.integers(-200, 200, (rows, rank)) * (1 + np.arange(rank))) @ basis / 64
    df = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(data)], "vec_id long, embedding array<double>").repartition(parts)
    got = whitening.whiten(df).toPandas()
    x = np.floor(64 * data) + 1_000_000
    values, want = plain_whitening(x, 32)
    assert set(got["component"]) == set(range(1, want.shape[1] + 1)) and len(got) == rows * want.shape[1] and set(got["n"]) == {rows}
    found = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert np.abs(found * np.sign((found * want).sum(axis=0)) - want).max() < 1e-7
    assert np.allclose(got.groupby("component")["explained"].first(), values[: want.shape[1]] / values.sum(), rtol=1e-9)
    exact = (rows * x.astype(np.int64) - x.astype(np.int64).sum(axis=0)) ** 2
    assert (got.groupby("vec_id")["deviation"].first().to_numpy() == exact.sum(axis=1)).all()
    error = np.abs(found.T @ found / rows - np.eye(found.shape[1])).max()
    assert got["identity_error"].nunique() == 1 and got["identity_error"][0] < 1e-9 and error < 1e-9


@pytest.mark.parametrize("name", ["random", "graded", "repeated", "split", "rank"])
def test_singular_values_and_vectors(name):
    rng = np.random.default_rng(4)
    a = rng.normal(size=(300, 30))
    if name == "graded":
        a = a * np.logspace(0, -7, 30)
    elif name == "repeated":
        a = np.linalg.qr(a)[0] @ np.diag([3.0] * 10 + [1.0] * 20) @ np.linalg.qr(rng.normal(size=(30, 30)))[0]
    elif name == "split":
        a = np.vstack([np.diag(np.arange(1.0, 31)), np.zeros((5, 30))])
    elif name == "rank":
        a[:, 10:] = a[:, :10] @ rng.normal(size=(10, 20))
    values, vectors = whitening.principal(np.linalg.qr(a, mode="r"), len(a), 30)
    want = np.linalg.svd(a, compute_uv=False)[: len(values)] ** 2 / len(a)
    assert len(values) == (10 if name == "rank" else 30) and np.allclose(values, want, rtol=1e-11)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-7
    assert np.abs(a.T @ (a @ vectors) / len(a) - vectors * values).max() < 1e-7 * values[0]


def test_whitening_of_awkward_rows(spark):
    good = [(i, [float(i % 7), float(i % 5), float(i % 3)]) for i in range(40)]
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [float("nan"), 1.0, 1.0]), (104, [float("inf"), 1.0, 1.0]), (105, [1.0, 2.0]), (None, [1.0, 2.0, 3.0]), (3, [9.0, 9.0, 9.0])]
    schema = "vec_id long, embedding array<double>"
    df = spark.createDataFrame(good + bad, schema).withColumns({c: F.lit("clash") for c in ("parts", "n", "component", "d", "i")})
    got = whitening.whiten(df).collect()
    assert len(got) == 3 * 42 and {r.n for r in got} == {42} and sum(r.vec_id == 3 for r in got) == 6 and sum(r.vec_id is None for r in got) == 3
    assert whitening.whiten(df.filter("false")).count() == 0
    assert whitening.whiten(spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], schema)).count() == 0
    with pytest.raises(OverflowError):
        whitening.whiten(spark.createDataFrame([(0, [1e30]), (1, [1.0])], schema))


def held(doc_id):
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))


def plain_counts(rows):
    """Tokens, training counts and base scores of (doc_id, text)."""
    tokens = [re.findall(r"[^\x20\x09-\x0d]+", lower(t or "")) + [None] for _, t in rows]
    out = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    c = Counter(w for ts, h in zip(tokens, out) if not h for w in ts)
    total, words = sum(c.values()), len(c)
    return [(h, len(ts), sum(w in c for w in ts), total, sum(math.log10((c[w] + 1) / (total + words + 1)) for w in ts)) for h, ts in zip(out, tokens)]


def check_scores(got, rows):
    want = Counter((i, h, n, k, total, round(base, 6)) for (i, _), (h, n, k, total, base) in zip(rows, plain_counts(rows)))
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)


def test_language_model_on_the_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = maxent_lm.score_texts(docs, held(F.col("doc_id")), block_tokens=1 << 16).collect()
    check_scores(got, [(r.doc_id, r.text) for r in docs.collect()])
    never = [r for r in got if r.held_out]
    tokens = sum(r.n_tokens for r in never)
    # Context must tell something: better by a third of a digit a token than the base, on texts never seen.
    assert sum(r.score for r in never) / tokens > sum(r.base_score for r in never) / tokens + 0.33


def test_language_model_of_awkward_rows(spark, awkward, nothing):
    got = maxent_lm.score_texts(awkward, held(F.col("doc_id")), block_tokens=500).collect()
    check_scores(got, [(r.doc_id, r.text) for r in awkward.collect()])
    assert maxent_lm.score_texts(nothing, held(F.col("doc_id"))).count() == 0
    untrained = maxent_lm.score_texts(awkward, F.lit(True)).collect()
    assert len(untrained) == len(got) and all(r.train_tokens == 0 and r.n_known == 0 and abs(r.score) < 1e-6 for r in untrained)


def test_chances_add_up_to_one():
    """Over all leaves, whatever the context; and the gradient of a step follows finite differences."""
    rng = np.random.default_rng(1)
    path, part, base = maxent_lm.classes(rng.integers(1, 1000, 333).astype(float))
    model = maxent_lm.Model(path, part, base, rng.normal(0, 0.5, (1 << 8, maxent_lm.PARTS)).astype(np.float32))
    total = 0.0
    for leaf in range(333):
        total += 10 ** maxent_lm.score_tokens(model, np.array([5, 17, leaf]), np.array([0]), 8)[2]
    assert abs(total - 1) < 1e-4
    leaves, starts = rng.integers(0, 333, 4000), np.array([0, 1500])
    before = maxent_lm.score_tokens(model, leaves, starts, 8).sum()
    trainer = maxent_lm.Trainer(model, 8, 0.05)
    trainer.learn(leaves, starts)
    assert maxent_lm.score_tokens(trainer.model, leaves, starts, 8).sum() > before
    change = trainer.change().reshape(-1, maxent_lm.PARTS + 1)
    assert ((change[:, -1] > 0) == (np.abs(change[:, :-1]).sum(axis=1) > 0)).mean() > 0.99


def test_class_paths_are_a_prefix_code():
    for counts in ([1.0], [3.0, 0.0], list(range(1, 40)), [1e9, *[1.0] * 600]):
        path, part, base = maxent_lm.classes(np.array(counts))
        ways = [tuple((p, q) for p, q in zip(path[i], part[i]) if p >= 0) for i in range(len(counts))]
        assert len(set(ways)) == len(counts) and not any(a != b and a == b[: len(a)] for a in ways[:50] for b in ways[:50])
        assert base.shape[1] == maxent_lm.PARTS and part.max() < maxent_lm.PARTS
