"""Shards, exact and near duplicates against brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from eventloom.llm import common, exact_dedup, kd_shards, near_copies, packing, simhash_trie, toxicity_cnn
from eventloom.session import materialize

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.mark.parametrize("shards", [1, 5, 24])
def test_shards_are_near_equal_and_gapless(spark, shards):
    docs = documents(spark)
    placed = rows_of(kd_shards.kd_shards(docs, shards=shards))
    want = {r.doc_id: (len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in docs.collect()}
    assert {r[0]: r[1:3] for r in placed} == want and len(placed) == len(want)
    slots = defaultdict(list)
    for _, size, _, shard, slot in placed:
        slots[shard].append(slot)
        assert 0 <= shard < shards
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    weights = Counter()
    for _, size, _, shard, _ in placed:
        weights[shard] += size
    total, largest = sum(weights.values()), max(r[1] for r in placed)
    assert max(weights.values()) <= total / shards * 1.13 + largest


def test_shards_keep_small_groups_and_split_large_ones(spark):
    rows = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot text").when(F.col("id") % 100 == 1, "small group").otherwise(F.concat(F.lit("own "), F.col("id"))).alias("text"), F.lit("en").alias("lang"))
    placed = kd_shards.kd_shards(rows, shards=8).join(rows, "doc_id").groupBy("text").agg(F.countDistinct("shard").alias("k")).filter("k > 1")
    assert [r.text for r in placed.collect()] == ["hot text"]
    sizes = [r[1] for r in kd_shards.kd_shards(rows, shards=8).groupBy("shard").agg(F.sum("size")).collect()]
    assert len(sizes) == 8 and max(sizes) < 1.1 * sum(sizes) / 8


def test_shards_by_target_bytes_and_awkward_rows(spark, awkward, nothing):
    total = kd_shards.kd_shards(awkward, shards=1).agg(F.sum("size")).first()[0]
    placed = kd_shards.kd_shards(awkward, target_bytes=total // 3)
    assert placed.count() == awkward.count() and placed.agg(F.max("shard")).first()[0] <= 4
    assert kd_shards.kd_shards(nothing, shards=24).count() == 0
    same = spark.range(500).select(F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("text"), F.lit(None).cast("string").alias("lang"))
    counts = [r["count"] for r in kd_shards.kd_shards(same, shards=4).groupBy("shard").count().collect()]
    assert len(counts) == 4 and max(counts) < 180


@pytest.mark.parametrize("keep", ["min", "max"])
def test_exact_dedup(awkward, keep):
    rows = [(r.doc_id, r.text or "") for r in awkward.collect()]
    groups = defaultdict(list)
    for i, t in rows:
        groups[t].append(i)
    best = min if keep == "min" else max
    kept = {t: best([i for i in ids if i is not None], default=None) for t, ids in groups.items()}
    want = sorted(((i, kept[t], len(groups[t]), i == kept[t], hashlib.sha256(t.encode()).hexdigest()) for i, t in rows), key=str)
    assert sorted(rows_of(exact_dedup.exact_dedup(awkward, keep)), key=str) == want


def test_exact_kept_rows(awkward, nothing):
    kept = exact_dedup.kept_rows(awkward, "max")
    assert kept.columns == awkward.columns
    got = sorted(((r.doc_id, r.text or "") for r in kept.collect()), key=str)
    best = {}
    for r in awkward.collect():
        t = r.text or ""
        best[t] = r.doc_id if best.get(t) is None else max(best[t], r.doc_id if r.doc_id is not None else best[t])
    assert got == sorted(((i, t) for t, i in best.items()), key=str)
    assert exact_dedup.kept_rows(nothing).count() == 0 and exact_dedup.exact_dedup(nothing).count() == 0


def test_merged_runs_over_many_rounds(spark):
    """A fan of two makes more rounds, and a hot text is in every run."""
    docs = spark.range(0, 3000, 1, 16).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 700).cast("string")).alias("text"))
    found = exact_dedup.merged_runs(exact_dedup._digests(docs, "doc_id", "text"), "max", fan=2)
    want = docs.groupBy("text").agg(F.max("doc_id"), F.count("*"))
    assert sorted(rows_of(found.select("keep_id", "group_size"))) == sorted((r[1], r[2]) for r in want.collect())


def test_runs_are_merged_in_sorted_order(spark, capsys):
    """Every merge is a window over rows sorted by (run, digest): one exchange by run, then the sort, per round."""
    digests = materialize(exact_dedup._digests(documents(spark), "doc_id", "text"))
    exact_dedup.merged_runs(digests, "max", fan=2).explain("simple")
    plan = capsys.readouterr().out.splitlines()
    steps = [re.search(r"(Window \[|Sort \[run|Exchange hashpartitioning\(run)", line) for line in plan]
    steps = [s.group(1).split()[0] for s in steps if s]
    assert steps == ["Window", "Sort", "Exchange"] * 3  # the first runs and two rounds over four partitions
    assert not any("Aggregate" in line for line in plan)


def test_a_text_with_very_many_copies(spark):
    docs = spark.range(0, 60_000, 1, 8).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 25_000)).alias("text"))
    want = docs.groupBy("text").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    got = exact_dedup.merged_runs(exact_dedup._digests(docs, "doc_id", "text"), "max", fan=2).select(F.lower(F.hex("sha")).alias("sha"), "keep_id", "group_size")
    want = want.select(F.sha2("text", 256).alias("sha"), "keep_id", "group_size")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def brute_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), seed=42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def brute_components(ids, prints, budget=3):
    parent = list(range(len(ids)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= budget:
                parent[root(i)] = root(j)
    least = {}
    for i, x in enumerate(ids):
        least[root(i)] = min(least.get(root(i), x), x)
    return [least[root(i)] for i in range(len(ids))]


def test_near_dedup_against_brute_force(spark, awkward):
    for docs in (documents(spark), awkward.filter("doc_id IS NOT NULL")):
        rows = [(r.doc_id, brute_fingerprint(r.text)) for r in docs.collect()]
        component = brute_components([r[0] for r in rows], [r[1] for r in rows])
        want = sorted((i, p, c) for (i, p), c in zip(rows, component))
        got = sorted((r[0], r[1] & (1 << 64) - 1, r[2]) for r in rows_of(simhash_trie.near_dedup(docs)))
        assert got == want


def test_trie_join_finds_every_link():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    near = [base]
    for k in (1, 2, 3, 4, 5):
        x = base.copy()
        for _ in range(k):
            x ^= np.uint64(1) << rng.integers(0, 64, len(x), dtype=np.uint64)
        near.append(x)
    # a dense group: all within a few bits of one another
    near.append(np.uint64(77) ^ (np.uint64(1) << rng.integers(0, 40, 60, dtype=np.uint64)))
    keys = np.unique(np.concatenate(near))
    for other in (None, np.unique(keys[::2] ^ np.uint64(9))):
        got = {p for i, j in simhash_trie.trie_links(keys, other, 3) for p in zip(i.tolist(), j.tolist())}
        b = keys if other is None else other
        i, j = np.nonzero(np.bitwise_count(keys[:, None] ^ b[None]) <= 3)
        assert got == {(x, y) for x, y in zip(i.tolist(), j.tolist()) if other is not None or x < y}


def test_forest_connects_chains_over_subtries(spark):
    """A chain whose ends differ in many bits, through all prefixes."""
    chain, x = [0], 0
    for b in list(range(63, 40, -1)):
        x ^= 1 << b
        chain.append(x)
    signed = [x - (1 << 64) if x >> 63 else x for x in chain]
    classes = spark.createDataFrame([(x,) for x in signed], "fp long")
    found = simhash_trie.components(simhash_trie.link_forest(classes, 3)).collect()
    assert {r.node for r in found} == set(signed) and len({r.root for r in found}) == 1


def test_near_kept_rows(spark, awkward, nothing):
    kept = simhash_trie.kept_rows(awkward)
    assert kept.columns == awkward.columns
    found = {r.doc_id: r.component_id for r in simhash_trie.near_dedup(awkward.filter("doc_id IS NOT NULL")).groupBy("doc_id").agg(F.min("component_id").alias("component_id")).collect()}
    got = [r.doc_id for r in kept.collect()]
    assert sorted(x for x in got if x is not None) == sorted(i for i, c in found.items() if i == c) and got.count(None) == 1
    assert simhash_trie.near_dedup(nothing).count() == 0 and simhash_trie.kept_rows(nothing).count() == 0


def brute_shingles(text):
    words = re.findall("[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_near(rows):
    """component of each row, by the Jaccard similarity of all pairs; and the pairs of different sets."""
    sets, parent = [brute_shingles(t) for _, t in rows], list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    pairs = []
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)) and (a == b or 10 * len(a & b) >= 8 * len(a | b)):
                parent[root(i)] = root(j)
                if a != b:
                    pairs.append((rows[i][0], rows[j][0]))
    least = {}
    for i, (x, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), x), x)
    return [least[root(i)] for i in range(len(rows))], pairs


def test_equal_texts_of_several_languages_share_a_shard(spark):
    texts = spark.range(400).crossJoin(spark.range(10).withColumnRenamed("id", "copy")).select(
        (F.col("id") * 10 + F.col("copy")).alias("doc_id"), F.concat(F.lit("text number "), F.col("id")).alias("text"), F.when(F.col("copy") % 2 == 0, "en").otherwise("fr").alias("lang"))
    rows = kd_shards.kd_shards(texts, 8).join(texts, "doc_id").groupBy("text").agg(F.count_distinct("shard").alias("n"))
    assert rows.filter("n > 1").count() == 0


def near_texts():
    """Copies with a word changed, cut or added, of similarity around 0.8; a chain; a group that shares one passage."""
    rng = np.random.default_rng(5)
    new = lambda n: [f"w{x}" for x in rng.integers(0, 10**6, n)]
    out = []
    for n in [4, 5, 9, 30, 45, 46, 47, 60, 120, 400]:
        base = new(n)
        out.append(base)
        for changes in (1, 2, 3, n // 45, n // 45 + 1):
            copy = list(base)
            for at in rng.integers(0, n, changes):
                copy[at] = f"x{rng.integers(10**6)}"
            out += [copy, base[changes:], base + new(changes)]
    chain = new(200)
    for k in range(12):
        chain = chain[15:] + new(15)
        out.append(chain)
    common = new(40)
    out += [common + new(int(rng.integers(5, 60))) for _ in range(60)]
    group = new(90)
    for _ in range(80):
        copy = list(group)
        copy[rng.integers(90)] = f"y{rng.integers(10**6)}"
        out.append(copy)
    return [" ".join(x).title() if i % 3 else " ".join(x) for i, x in enumerate(out)]


def test_near_copies_against_brute_force(spark, awkward, monkeypatch):
    made = spark.createDataFrame(list(enumerate(near_texts())), "doc_id long, text string").repartition(3)
    for docs, chunk in ((documents(spark), 256), (awkward.filter("doc_id IS NOT NULL"), 256), (made, 7)):
        monkeypatch.setattr(near_copies, "CHUNK", chunk)
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        want, _ = brute_near(rows)
        assert sorted(rows_of(near_copies.near_copies(docs))) == sorted((i, c) for (i, _), c in zip(rows, want))


def test_pipeline_drops_near_copies_beyond_three_bits(spark):
    """Copies of a five-word similarity of 0.8 or more, whose three-word prints differ in more than three bits."""
    made = spark.createDataFrame(list(enumerate(near_texts())), "doc_id long, text string")
    rows = [(r.doc_id, r.text) for r in made.collect()]
    component, pairs = brute_near(rows)
    prints = {i: brute_fingerprint(t) for i, t in rows}
    assert any((prints[i] ^ prints[j]).bit_count() > 3 for i, j in pairs)
    kept = {r.doc_id for r in corpus_pipeline.near(spark, made, SF).collect()}
    assert kept == {i for (i, _), c in zip(rows, component) if i == c}


def test_near_copies_rows(awkward, nothing):
    kept = near_copies.kept_rows(awkward)
    assert kept.columns == awkward.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(None) == 1 and len(set(ids)) == len(ids) and {0, 3, 11, 12, 13} & set(ids) == {0, 3, 12, 13}
    assert near_copies.near_copies(nothing).count() == 0 and near_copies.kept_rows(nothing).count() == 0


def test_bitmaps_rule_out_no_similar_pair():
    rng = np.random.default_rng(8)
    for n in (1, 5, 40, 300, 5000):
        base = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        for k in range(0, n // 6 + 2, max(1, n // 50)):
            other = np.unique(np.concatenate([base[k:], rng.integers(0, 1 << 63, k // 2, dtype=np.uint64)]))
            a, b = (np.frombuffer(near_copies.bitmap(x), np.uint64)[None] for x in (base, other))
            assert near_copies.possible(a, b)[0] or not near_copies.similar(base, other)


def test_forest_holds_links_only(spark):
    """Every pair that the forest returns is a link itself, also where a component is wider than the budget."""
    rng = np.random.default_rng(4)
    keys = {0}
    while len(keys) < 600:
        keys.add(rng.choice(list(keys)) ^ (1 << int(rng.integers(0, 62))) if rng.random() < 0.9 else int(rng.integers(1 << 62)))
    found = simhash_trie.link_forest(spark.createDataFrame([(int(x),) for x in keys], "fp long"), 3).collect()
    assert found and all((r.a ^ r.b).bit_count() <= 3 for r in found)
    assert max((r.node ^ r.root).bit_count() for r in simhash_trie.components(spark.createDataFrame(found)).collect()) > 3


def test_near_stage_joins_fingerprints_in_the_trie(spark, monkeypatch):
    """The stage's first links are those of the trie self-join over the fingerprints of all its rows."""
    made = spark.createDataFrame(list(enumerate(near_texts())), "doc_id long, text string")
    joins, tested = [], []
    join, verify = near_copies.link_forest, near_copies._verified

    def seen(classes, budget):
        joins.append(({r.fp & (1 << 64) - 1 for r in classes.collect()}, budget))
        return join(classes, budget)

    def counted(pairs, *more):
        tested.append((pairs.count(), verify(pairs, *more)))
        return tested[-1][1]

    monkeypatch.setattr(near_copies, "link_forest", seen)
    monkeypatch.setattr(near_copies, "_verified", counted)
    corpus_pipeline.near(spark, made, SF).collect()
    assert joins == [({brute_fingerprint(r.text) for r in made.collect()}, 3)]
    assert tested[0][1].count() > 0


def test_a_large_group_of_near_copies_meets_in_few_pairs(spark, monkeypatch):
    """One word of a text changes: nearly all rows are similar, and the pairs that are tested stay near their number."""
    rng = np.random.default_rng(6)
    base = [f"w{x}" for x in rng.integers(0, 10**6, 150)]
    texts = [" ".join([*base[:at], f"x{k}", *base[at + 1 :]]) for k, at in enumerate(rng.integers(0, 150, 600).tolist())]
    made, tested, verify = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), [], near_copies._verified
    monkeypatch.setattr(near_copies, "_verified", lambda pairs, *more: (tested.append(pairs.count()), verify(pairs, *more))[1])
    assert {r.component_id for r in near_copies.near_copies(made).collect()} == {0}
    assert sum(tested) < 20 * len(texts)


def test_near_stage_sends_few_tables_through_the_driver(spark, monkeypatch, capsys):
    """Its many small joins are by shuffle, and known components are extended, not found anew; both cost the driver memory."""
    made, write, plans = spark.createDataFrame(list(enumerate(near_texts())), "doc_id long, text string"), near_copies.materialize, []

    def seen(df):
        df.explain("simple")
        plans.append(capsys.readouterr().out)
        return write(df)

    monkeypatch.setattr(near_copies, "materialize", seen)
    monkeypatch.setattr(simhash_trie, "materialize", seen)
    near_copies.near_copies(made).count()
    assert sum(p.count("BroadcastExchange") for p in plans) <= 20


@pytest.mark.parametrize("stage, module, work", [("near", near_copies, "kept_rows"), ("packed", packing, "pack")])
def test_stages_send_texts_to_python_in_small_batches(spark, monkeypatch, stage, module, work):
    """A batch of texts is held by the executor and the Python worker, so it has a bound; the session's setting comes back."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    def sent():
        return [r.n for r in spark.range(2000).coalesce(1).mapInArrow(sizes, "n long").collect()]

    monkeypatch.setattr(module, work, lambda *_: sent())
    before = sent()
    found = getattr(corpus_pipeline, stage)(spark, None, SF)
    assert sum(found) == 2000 and max(found) <= corpus_pipeline.ARROW_ROWS < max(before)
    assert sent() == before


def test_toxicity_stage_sends_texts_to_python_in_small_batches(spark, monkeypatch):
    """Its plan is run within the stage: one that runs later would take the session's batches."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    def sent():
        return spark.range(2000).coalesce(1).mapInArrow(sizes, "n long")

    monkeypatch.setattr(toxicity_cnn, "fit", lambda *_: None)
    monkeypatch.setattr(toxicity_cnn, "clean_rows", lambda *_: sent())
    before = [r.n for r in sent().collect()]
    found = [r.n for r in corpus_pipeline.toxicity(spark, None, SF).withColumns({}).collect()]
    assert sum(found) == 2000 and max(found) <= corpus_pipeline.ARROW_ROWS < max(before)
    assert [r.n for r in sent().collect()] == before


def test_workers_give_back_what_arrow_has_freed(monkeypatch):
    """Reused workers would keep a stage's freed batches through the stages that follow."""
    calls, pool = [], pa.default_memory_pool()

    class Pool:
        def release_unused(self):
            calls.append(1)
            pool.release_unused()

    monkeypatch.setattr(pa, "default_memory_pool", Pool)
    made = [pa.RecordBatch.from_pydict({"n": [k]}) for k in range(3)]
    assert list(common.lean(lambda batches: (b for b in batches))(iter(made))) == made and len(calls) == 4
