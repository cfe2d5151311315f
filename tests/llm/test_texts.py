"""License scans, toxicity, packing and sampled segmentations."""

import math
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import gumbel_pieces, license_scan, packing, toxicity_cnn

SF = "/root/testdata/sf0.001"
#: Some 3,000 labelled rows, of which one in nine is toxic, in four languages with words of their own.
LABELLED = "/root/testdata/sf0.1"


def test_license_spans_and_coverage(spark, awkward, nothing):
    apache = license_scan.TEMPLATES[1][1]
    changed = apache.replace("you may not", "you shall never").replace("compliance with the License", "compliance with License")
    texts = ["intro " * 40 + apache + " outro", changed, "Released under the mit license!\nLicensed under CC BY-NC 4.0.", "Licensed under CC BY 4.0", None, "", "mit", "a b c " * 5000 + "Released under the MIT License." + " x" * 5000, "Released under the MIT License. Released under the MIT License."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("license", F.lit("clash"))
    found = defaultdict(list)
    for r in license_scan.license_scan(docs).collect():
        found[r.doc_id].append((r.license, round(r.coverage, 2), texts[r.doc_id][r.start_char : r.end_char]))
    assert found[0] == [("Apache-2.0", 1.0, apache)]
    assert found[1][0][0] == "Apache-2.0" and 0.8 <= found[1][0][1] < 1 and len(found[1]) == 1
    assert found[2] == [("MIT", 1.0, "Released under the mit license"), ("CC-BY-NC-4.0", 1.0, "Licensed under CC BY-NC 4.0")]
    assert found[7] == [("MIT", 1.0, "Released under the MIT License")] and [x[0] for x in found[8]] == ["MIT", "MIT"]
    assert not any(found[i] for i in (4, 5, 6))
    assert license_scan.license_scan(nothing).count() == 0
    assert [(r.doc_id, r.license, r.coverage) for r in license_scan.license_scan(awkward).collect()] == [(15, "MIT", 0.8)]


@pytest.mark.parametrize("seed", range(4))
def test_licenses_that_nest_interleave_and_repeat(seed):
    """No overlaps, and the best notice of a plain version, which aligns every template in a band around each diagonal."""
    rng = np.random.default_rng(seed)
    index = license_scan.Index(license_scan.TEMPLATES)
    lines = [t for _, t in license_scan.TEMPLATES]
    for _ in range(8):
        words = []
        for i in rng.choice(len(lines), 3):
            line = license_scan.WORD.findall(lines[i])
            at = int(rng.integers(0, len(words) + 1)) if rng.random() < 0.5 else len(words)
            if rng.random() < 0.3 and len(line) > 6:
                line[len(line) // 2] = "changed"
            words[at:at] = [*line, *(["between"] if rng.random() < 0.5 else [])]
        text = " ".join(words)
        found = license_scan.scan_text(text, index)
        ends = [(r["begin"], r["end"]) for r in found]
        assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:])) and all(r["coverage"] >= 0.8 for r in found)
        ids = np.array([index.vocabulary.get(w.lower(), 0) for w in words])
        tried = [(license_scan.align(t, ids, d, d), len(t)) for t in index.words for d in range(-len(t), len(ids), 5)]
        first = max(score for (score, matched, _, _), n in tried if matched >= 0.8 * n)
        best = max((license_scan.align(index.words[r["template"]], ids[r["begin"] : r["end"]], -9, 99)[0] for r in found), default=0)
        assert best >= first - 1e-9  # the best notice of the whole text is found


def test_licenses_end_on_interleaved_notices():
    index = license_scan.Index(license_scan.TEMPLATES)
    scan = lambda t: [r["license"] for r in license_scan.scan_text(t, index)]
    assert scan("Licensed under the Apache Licensed under CC BY-NC 4.0 License, Version 2.0.") == ["CC-BY-NC-4.0"]
    assert scan("Released under an MIT License") == ["MIT"]  # four of five words
    assert scan("Licensed under CC BY-XX 4.0.") == ["CC-BY-NC-4.0"]  # six of seven


def test_license_alignment_against_full_dynamic_programming():
    rng = np.random.default_rng(5)
    for _ in range(60):
        template = rng.integers(1, 9, 14)
        text = np.concatenate([rng.integers(9, 12, 5), template[:6], rng.integers(9, 12, rng.integers(0, 3)), template[6 + rng.integers(0, 2) :], rng.integers(9, 12, 4)])
        full = np.zeros((15, len(text) + 1))
        for i in range(1, 15):
            for j in range(1, len(text) + 1):
                same = template[i - 1] == text[j - 1]
                full[i, j] = max(0, full[i - 1, j - 1] + (1 if same else -0.5), full[i - 1, j] - 0.5, full[i, j - 1] - 0.5)
        score, matched, begin, end = license_scan.align(template, text, 5, 8)
        assert math.isclose(score, full.max()) and matched >= 12 and begin == 5 and end <= len(text) - 4


def test_licenses_of_the_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lines = {"Released under the MIT License.": "MIT", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0"}
    want = Counter((r.doc_id, lines[x]) for r in docs.collect() for x in r.text.split("\n") if x in lines)
    assert Counter((r.doc_id, r.license) for r in license_scan.license_scan(docs).collect()) == want


@pytest.fixture(scope="module")
def model(spark):
    d = LABELLED
    return toxicity_cnn.fit(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet"))


def area(labels, scores):
    order = np.argsort(np.argsort(scores))
    pos = labels == 1
    return (order[pos].sum() - pos.sum() * (pos.sum() - 1) / 2) / (pos.sum() * (~pos).sum())


def test_toxicity_on_rows_never_trained_on(spark, model):
    d = LABELLED
    docs = spark.read.parquet(f"{d}/documents.parquet")
    scored = toxicity_cnn.classify(docs, model).join(spark.read.parquet(f"{d}/labels.parquet").withColumnRenamed("toxic", "label"), "doc_id")
    rows = scored.filter(toxicity_cnn.held_out(F.col("doc_id"))).toPandas()
    assert area(rows["label"].to_numpy(), rows["score"].to_numpy()) > 0.8


def test_toxicity_awkward(spark, model, awkward, nothing):
    rows = toxicity_cnn.classify(awkward, model).collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)
    same = {r.score for r in rows if r.doc_id in (0, 1, 2)}
    assert len(same) == 1
    kept = toxicity_cnn.clean_rows(awkward, model)
    assert kept.columns == awkward.columns and kept.count() == sum(not r.toxic for r in rows)
    assert toxicity_cnn.classify(nothing, model).count() == 0 and toxicity_cnn.clean_rows(nothing, model).count() == 0


def test_toxicity_without_labels(spark, awkward):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    untrained = toxicity_cnn.fit(awkward, labels)
    assert all(not r.toxic for r in toxicity_cnn.classify(awkward, untrained).collect())


def test_toxicity_gradients():
    """Against finite differences, on a model small enough to try."""
    rng = np.random.default_rng(2)
    m = toxicity_cnn._new_model(rng, 0.3, rng.normal(0, 1, toxicity_cnn.BUCKETS))
    m.table[:] = rng.normal(0, 0.5, m.table.shape)
    m.table[0], m.bias[:] = 0, 0.1
    rows, starts = toxicity_cnn.word_ids(["a b c d e", "f g", "h a b i j k"], toxicity_cnn._Ids())
    labels = np.array([1, 0, 1], np.float32)
    grads, _ = toxicity_cnn._gradients(m, rows, starts, labels)
    for p, g in ((m.filters[1][1], grads[1 + 2]), (m.out, grads[-1]), (m.bias, grads[-2])):
        at = np.unravel_index(int(np.abs(g).argmax()), g.shape)
        before, step = p[at], 1e-2
        p[at] = before + step
        up = toxicity_cnn._log_loss(m, rows, starts, labels)
        p[at] = before - step
        down = toxicity_cnn._log_loss(m, rows, starts, labels)
        p[at] = before
        assert math.isclose((up - down) / (2 * step), g[at], rel_tol=0.1, abs_tol=1e-4)


def test_toxicity_scores_need_no_table_of_responses():
    """Scores are those of responses of all words, in the memory of the words that occur."""
    rng = np.random.default_rng(3)
    m = toxicity_cnn._new_model(rng, 0.3, rng.normal(0, 1, toxicity_cnn.BUCKETS))
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 2000, n)) for n in (1, 2, 3, 40, 300)] + ["", "w1"]
    rows, starts = toxicity_cnn.word_ids(texts, toxicity_cnn._Ids())
    tracemalloc.start()
    found = m.logits(rows, starts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < m.table.nbytes / 4
    n, ends = len(rows) - toxicity_cnn.PAD, [*starts[1:], len(rows) - toxicity_cnn.PAD]
    windows = [sum((m.table @ w)[rows[k : k + n]] for k, w in enumerate(ws)) for ws in m.filters]
    best = np.array([[y for w in windows for y in w[a:b].max(axis=0)] for a, b in zip(starts, ends)])
    assert np.allclose(found, np.maximum(best + m.bias, 0) @ m.out + m.shift, atol=1e-5)


def token_ids(texts):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(packing.tokenizer_path())
    return [np.array(model.encode(t or "", add_special_tokens=False).ids + [2], "<u4") for t in texts]


def check_packing(docs, pieces, window):
    rows = docs.collect()
    want = Counter((r.doc_id, x.tobytes()) for r, x in zip(rows, token_ids([r.text for r in rows])))
    by_doc, by_window = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p.length > 0 and len(p.ids) == 4 * p.length
        by_doc[p.doc_id].append(p)
        by_window[p.sequence_id].append(p)
    for doc_id, own in by_doc.items():  # each id in one piece; rows that repeat an id share it
        total = Counter(p.start for p in own)
        if max(total.values()) == 1 and sum(k[0] == doc_id for k in want) == 1:
            own.sort(key=lambda p: p.start)
            assert [p.start for p in own] == list(np.cumsum([0, *[p.length for p in own]])[:-1])
            assert want[(doc_id, b"".join(p.ids for p in own))] == 1 and all(p.doc_tokens == sum(x.length for x in own) for p in own)
    assert sum(p.length for p in pieces) == sum(len(k[1]) // 4 * n for k, n in want.items())
    assert sorted(by_window) == list(range(len(by_window)))
    for number, own in by_window.items():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == list(np.cumsum([0, *[p.length for p in own]])[:-1])
        assert number == max(by_window) or sum(p.length for p in own) == window


@pytest.mark.parametrize("segment,weights", [(1 << 18, None), (9000, None), (9000, {"src0": 5, "src1": 1}), (500, None)])
def test_packing_of_the_documents(spark, segment, weights):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 80")
    pieces = packing.pack(docs, packing.tokenizer_path(), weights=weights, segment=segment).collect()
    check_packing(docs, pieces, 4096)


def test_packing_keeps_proportions(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("some words number "), "id").alias("text"), F.when(F.col("id") % 3 == 0, "big").when(F.col("id") % 3 == 1, "mid").otherwise("small" + "").alias("source"))
    pieces = packing.pack(rows, packing.tokenizer_path(), window=256, segment=2000, min_piece=16).toPandas()
    shares = pieces.groupby(["sequence_id", "source"])["length"].sum().unstack(fill_value=0)
    whole = shares.sum() / shares.sum().sum()
    assert (abs(shares.iloc[:-2] / 256 - whole) < 0.2).all().all()
    running = shares.iloc[:-2].cumsum().div(256 * np.arange(1, len(shares) - 1), axis=0)
    assert (abs(running.iloc[20:] - whole) < 0.02).all().all()  # deficits are carried, so windows even out


def test_packing_awkward(spark, awkward, nothing):
    check_packing(awkward, packing.pack(awkward, packing.tokenizer_path(), segment=700).collect(), 4096)
    assert packing.pack(nothing, packing.tokenizer_path()).count() == 0


def test_encoder_equals_the_tokenizer():
    texts = ["It's 12½ naïve—no! ÆØÅ İstanbul ΣΑΣ", "a\x1cb\x85c\u00a0d", "<|endoftext|> ok <|startoftext|>", "", " \n", "''s 't''ll'", "e\u0301 combining", "日本語 mixed with latin", "x_y__z ²³ ª"]
    encode = packing.encoder(packing.tokenizer_path(), 2)
    ids = lambda found: [np.frombuffer(x, packing.id_type(packing.tokenizer_path(), 2)).tolist() for x in found]
    texts += ["a <|endoftext|> b", "A <|ENDOFTEXT|> b", "x<|startoftext|>y z"]
    assert ids(encode(texts)) == [x.tolist() for x in token_ids(texts)]
    assert 49407 in token_ids(texts)[-3] and ids(encode(["a b <|endoftext|>"]))[0][-2:] == [49407, 2]
    assert ids(encode(texts[:3] + ["It's it's IT'S"])) == [x.tolist() for x in token_ids(texts[:3] + ["It's it's IT'S"])]


@pytest.fixture(scope="module")
def vocabulary():
    return gumbel_pieces.Vocabulary(gumbel_pieces.model_path())


def all_segmentations(vocabulary, word):
    known = {vocabulary.model.id_to_piece(i): i for i in range(vocabulary.model.get_piece_size()) if not vocabulary.model.is_byte(i) and not vocabulary.model.is_control(i) and not vocabulary.model.is_unknown(i)}

    def parts(rest):
        if not rest:
            yield ()
        for n in range(1, len(rest) + 1):
            if rest[:n] in known:
                for more in parts(rest[n:]):
                    yield (known[rest[:n]], *more)

    found = {p: math.exp(sum(vocabulary.scores[i] for i in p)) for p in parts(word)}
    total = sum(found.values())
    return {p: x / total for p, x in found.items()}


def test_samples_follow_the_lattice(vocabulary):
    """First samples by probability; later ones without replacement, compared with sequential drawing."""
    text, tries = "there in", 6000
    want = all_segmentations(vocabulary, "▁there▁in")
    rows = gumbel_pieces.sample(vocabulary, [vocabulary.chunks(text)] * tries, np.arange(tries).astype(np.uint64) * np.uint64(7919), 2)
    first, second = Counter(tuple(r[0][0].tolist()) for r in rows), Counter(tuple(r[1][0].tolist()) for r in rows)
    expected_second = Counter()
    for a, p in want.items():
        for b, q in want.items():
            if a != b:
                expected_second[b] += p * q / (1 - p)
    for p in want:
        for got, chance in ((first, want[p]), (second, expected_second[p])):
            assert abs(got[p] - chance * tries) < 5 * math.sqrt(tries * chance * (1 - chance)) + 3
    for r in rows[:200]:
        for ids, log, _, _ in r:
            assert math.isclose(math.exp(log), want[tuple(ids.tolist())], rel_tol=1e-6)
        assert r[0][2] > r[1][2]


def test_samples_are_all_there_are(vocabulary):
    word = "the"
    want = all_segmentations(vocabulary, "▁the")
    rows = gumbel_pieces.sample(vocabulary, [vocabulary.chunks(word)], np.array([5], np.uint64), 50)[0]
    assert {tuple(r[0].tolist()) for r in rows} == set(want) and len(rows) == len(want) and all(r[3] == 0.0 for r in rows)


def test_inclusion_is_unbiased(vocabulary):
    """Probability over inclusion sums to one on average, for each segmentation."""
    text, tries = "on it", 3000
    want = all_segmentations(vocabulary, "▁on▁it")
    totals = Counter()
    for r in gumbel_pieces.sample(vocabulary, [vocabulary.chunks(text)] * tries, np.arange(tries).astype(np.uint64), 3):
        for ids, log, _, inclusion in r:
            totals[tuple(ids.tolist())] += math.exp(log - inclusion)
    assert abs(sum(totals.values()) / tries - 1) < 0.05 and all(abs(totals[p] / tries - q) < 0.05 for p, q in want.items())


def test_random_numbers_are_drawn_for_all_texts_at_once(vocabulary, monkeypatch):
    calls, mixed = [], gumbel_pieces._mixed
    monkeypatch.setattr(gumbel_pieces, "_mixed", lambda x: calls.append(len(x)) or mixed(x))

    def needed(count):
        calls.clear()
        assert all(len(r) == 3 for r in gumbel_pieces.sample(vocabulary, [vocabulary.chunks("some words of a text")] * count, np.arange(count).astype(np.uint64), 3))
        return len(calls)

    assert needed(200) < needed(20) + 50


def test_sums_near_a_cut_and_far_from_it_agree(vocabulary, monkeypatch):
    words = ["▁unbelievable", "▁" + "intermediate" * 40, "▁日本語é", "▁"]
    near = gumbel_pieces.Lattices(vocabulary, words)
    assert len(words[1]) > vocabulary.depth > 20
    for depth in (0, 3):
        monkeypatch.setattr(vocabulary, "depth", depth)
        far = gumbel_pieces.Lattices(vocabulary, words)
        assert np.array_equal(near.piece, far.piece) and np.allclose(near.log, far.log, rtol=1e-9, atol=1e-12)
    monkeypatch.undo()
    want = Counter()
    for p, x in all_segmentations(vocabulary, "▁there").items():
        want[p[0]] += x
    own = gumbel_pieces.Lattices(vocabulary, ["▁there"])
    assert {i: round(math.exp(x), 9) for i, x in zip(own.piece[: own.begin[1]].tolist(), own.log)} == {i: round(x, 9) for i, x in want.items()}


def test_text_that_normalisation_keeps_is_not_normalised(vocabulary):
    for text in (" a  b c\u3000ﬁ①é e\u0301 \t\n x ", "<s> </s> <unk>", "▁a ▁", "  \0 b", " ", "🙂 é", "\r\n", "\ufeff a", "<0x41>"):
        assert vocabulary.unchanged and vocabulary.model.normalize(text) == "▁" + text.replace(" ", "▁")


def test_spelling_is_judged_by_text(vocabulary):
    texts = ["there in", "", "日本 x", " a"]
    ids = [np.array(vocabulary.model.encode(t), "<u4") for t in texts]
    assert vocabulary.spell(ids, [t.encode() for t in texts]) == [True] * 4
    assert vocabulary.spell(ids, [b"there i", b"x", "日本".encode(), b"a"]) == [False] * 4
    assert vocabulary.spell([], []) == []


def test_segmentations_round_trip(spark, awkward, nothing):
    path = gumbel_pieces.model_path()
    found = gumbel_pieces.encode_samples(awkward, path).join(awkward.select("doc_id", "text").distinct(), "doc_id")
    rows = gumbel_pieces.decode(found, path).collect()
    own = defaultdict(set)
    for r in rows:
        if r.doc_id != 4:
            assert r.decoded == (r.text or "")
            own[r.doc_id].add(r.sample)
    sampled = gumbel_pieces.encode_samples(awkward, path).collect()
    assert all(r.round_trip for r in sampled)
    assert own[3] == {0, 1, 2} and own[0] == own[1] == {0}
    repeated = [bytes(r.ids) for r in sampled if r.doc_id == 3 and r.sample == 1]
    assert len(repeated) == 2 and len(set(repeated)) == 1
    assert gumbel_pieces.encode_samples(nothing, path).count() == 0


def test_encoder_looks_up_a_batch_and_never_goes_through_all_known_words(monkeypatch):
    class Known(packing._Known):
        def keys(self):
            raise AssertionError("all known words")

        __iter__ = items = values = keys

    monkeypatch.setattr(packing, "_Known", Known)
    path = packing.tokenizer_path()
    encode, (model, _), kind = packing.encoder(path, 2), packing._tokenizer(path), packing.id_type(path, 2)
    for batch in ([" two\xa0words, twice two\n", "", "日本 x", "İx it's ½"], [], [""], ["twice x²y", "don't  _do_ two "]):
        want = [np.array([*x.ids, 2], kind).tobytes() for x in model.encode_batch(batch, add_special_tokens=False)]
        assert encode(batch) == want
