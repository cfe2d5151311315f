"""Toxicity: a convolutional text classifier, trained in numpy on a bounded sample and applied to every whole text.

Words are hashed to embedding rows. Filters of one, two and three words slide over the text; each filter's largest
response, floored at zero, is one feature, and a logistic layer turns the features into a score. The embedding's
first column starts from each word's log odds in the training rows. Training runs
Adam on the driver over at most ``sample`` labelled rows, keeps the epoch that does best on rows left out of
training, scales the scores on those rows, and picks the threshold of each language there. Scores never see the
language. Scoring is a map over the table: per-word filter responses of some texts' words are added and pooled by document.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import lean, table, whole

#: Labelled rows that training takes at most: those with the smallest hash of their id.
SAMPLE = 8_000
BUCKETS, DIM, FILTERS, WIDTHS = 1 << 18, 8, 8, (1, 2, 3)
EPOCHS, LEAST_STEPS, BATCH, RATE, SEED = 4, 160, 64, 5e-3, 7
#: Texts a word must occur in before its embedding starts from its log odds; others start near zero, as unseen words stay.
LEAST_TEXTS, LARGEST_ODDS, SMALL = 4, 4.0, 0.02
#: Positive rows of a language in the calibration rows from which it gets a threshold of its own.
OWN_THRESHOLD = 30
WORD = re.compile(r"\w+")
PAD = max(WIDTHS) - 1
CACHE = 50_000  # words whose rows a task remembers


class _Ids(dict):
    """Word to embedding row; row 0 is padding."""

    def __missing__(self, word: str) -> int:
        if len(self) > CACHE:
            self.clear()
        self[word] = found = 1 + zlib.crc32(word.encode("utf-8", "surrogatepass")) % (BUCKETS - 1)
        return found


def word_ids(texts: list[str], ids: _Ids) -> tuple[np.ndarray, np.ndarray]:
    """All texts' rows in one array, padded between texts, and where each text starts."""
    rows, starts, at = [], np.zeros(len(texts), np.int64), 0
    for i, text in enumerate(texts):
        found = np.fromiter(map(ids.__getitem__, WORD.findall((text or "").lower())), np.int32)
        rows += [found, np.zeros(PAD + (not len(found)), np.int32)]
        starts[i] = at
        at += len(found) + len(rows[-1])
    return (np.concatenate(rows) if rows else np.zeros(0, np.int32)), starts


@dataclass
class Model:
    table: np.ndarray  # BUCKETS x DIM
    filters: list[list[np.ndarray]]  # by width and place in the window: DIM x FILTERS
    bias: np.ndarray
    out: np.ndarray
    shift: float = 0.0
    scale: tuple[float, float] = (1.0, 0.0)
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.5

    def parameters(self) -> list[np.ndarray]:
        return [self.table, *[w for ws in self.filters for w in ws], self.bias, self.out]

    def pooled(self, rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Responses are those of the words that occur: of all words, they would take six times the memory of the table."""
        features = []
        n = len(rows) - PAD  # the last window starts before the padding that ends the array
        used, inverse = np.unique(rows, return_inverse=True)
        emb = self.table[used]
        for ws in self.filters:
            sums = (emb @ ws[0])[inverse[:n]]
            for place, w in enumerate(ws[1:], 1):
                sums += (emb @ w)[inverse[place : place + n]]
            features.append(np.maximum.reduceat(sums, starts, axis=0))
        return np.maximum(np.concatenate(features, axis=1) + self.bias, 0)

    def logits(self, rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return self.pooled(rows, starts) @ self.out + self.shift

    def score(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale[0] * logits + self.scale[1], -30, 30)))


def _log_odds(texts: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """How much likelier each word is in texts of label 1, by number of texts."""
    seen = [np.bincount(np.concatenate([np.unique(t) for t, y in zip(texts, labels) if y == k] or [[0]]).astype(np.int64), minlength=BUCKETS) for k in (0, 1)]
    sizes = [max(1, int((labels == k).sum())) for k in (0, 1)]
    odds = np.log((seen[1] + 0.5) / (sizes[1] + 1)) - np.log((seen[0] + 0.5) / (sizes[0] + 1))
    return np.where(seen[0] + seen[1] >= LEAST_TEXTS, np.clip(odds, -LARGEST_ODDS, LARGEST_ODDS), 0).astype(np.float32)


def _new_model(rng: np.random.Generator, rate: float, odds: np.ndarray) -> Model:
    emb = rng.normal(0, SMALL, (BUCKETS, DIM)).astype(np.float32)
    emb[:, 0] = odds
    emb[0] = 0
    filters = [[rng.normal(0, 0.3 / w**0.5, (DIM, FILTERS)).astype(np.float32) for _ in range(w)] for w in WIDTHS]
    out = rng.normal(0, 0.1, FILTERS * len(WIDTHS)).astype(np.float32)
    return Model(emb, filters, np.full(FILTERS * len(WIDTHS), -0.5, np.float32), out, float(np.log(rate / (1 - rate))))


class _Adam:
    def __init__(self, parameters: list[np.ndarray]):
        self.first, self.second, self.step = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters], 0

    def update(self, parameters: list[np.ndarray], gradients: list, rate: float) -> None:
        """A gradient is an array, or (rows, array) for the rows that it concerns."""
        self.step += 1
        fix = rate * (1 - 0.999**self.step) ** 0.5 / (1 - 0.9**self.step)
        for p, g, m, v in zip(parameters, gradients, self.first, self.second):
            at, g = g if isinstance(g, tuple) else (slice(None), g)
            m[at] = 0.9 * m[at] + 0.1 * g
            v[at] = 0.999 * v[at] + 0.001 * g * g
            p[at] -= fix * m[at] / (np.sqrt(v[at]) + 1e-8)


def _gradients(model: Model, rows: np.ndarray, starts: np.ndarray, labels: np.ndarray) -> tuple[list, float]:
    """Max pooling passes a gradient to one window of each filter and text only."""
    used, inverse = np.unique(rows, return_inverse=True)
    emb, n, docs = model.table[used], len(rows) - PAD, len(starts)
    ends = np.append(starts[1:], n)
    peaks, where = [], []
    for ws in model.filters:
        sums = (emb @ ws[0])[inverse[:n]]
        for place, w in enumerate(ws[1:], 1):
            sums += (emb @ w)[inverse[place : place + n]]
        top = np.array([sums[s:e].argmax(axis=0) + s for s, e in zip(starts, ends)])
        where.append(top)
        peaks.append(np.take_along_axis(sums, top, axis=0))
    raw = np.concatenate(peaks, axis=1) + model.bias
    features = np.maximum(raw, 0)
    p = 1 / (1 + np.exp(-np.clip(features @ model.out + model.shift, -30, 30)))
    error = ((p - labels) / docs).astype(np.float32)
    back = error[:, None] * model.out * (raw > 0)
    grad_emb, grad_filters = np.zeros_like(emb), []
    for k, (ws, top) in enumerate(zip(model.filters, where)):
        part = back[:, k * FILTERS : (k + 1) * FILTERS]
        for place, w in enumerate(ws):
            at = inverse[top + place]  # docs x FILTERS
            grad_filters.append(np.einsum("bfd,bf->df", emb[at], part))
            np.add.at(grad_emb, at.ravel(), (part[:, :, None] * w.T[None]).reshape(-1, DIM))
    grad_emb[used == 0] = 0
    return [(used, grad_emb), *grad_filters, back.sum(axis=0), features.T @ error], float(error.sum())


def _log_loss(model: Model, rows, starts, labels) -> float:
    p = np.clip(1 / (1 + np.exp(-np.clip(model.logits(rows, starts), -30, 30))), 1e-6, 1 - 1e-6)
    return float(-(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean())


def _best_threshold(scores: np.ndarray, labels: np.ndarray) -> float:
    """The middle of the range of thresholds whose F1 is nearly the best."""
    grid = np.linspace(0.05, 0.95, 91)
    hit = np.array([((scores >= t) & (labels == 1)).sum() for t in grid])
    called = np.array([(scores >= t).sum() for t in grid])
    f1 = 2 * hit / np.maximum(1, called + (labels == 1).sum())
    return float(np.mean(grid[f1 >= f1.max() - 0.002]))


def train(texts: list[np.ndarray], labels: np.ndarray, langs: list[str], seed: int = SEED, epochs: int = EPOCHS) -> Model:
    """``texts``: word rows of each text, unpadded. A fifth of the rows is kept for choosing epoch, scale and thresholds.

    Without both classes there is nothing to learn: the model then gives the share of the class that is there."""
    rng = np.random.default_rng(seed)
    labels = np.asarray(labels, np.float32)
    rate = float(np.clip(labels.mean() if len(labels) else 0.0, 1e-3, 1 - 1e-3))
    if len(labels) < 20 or labels.min() == labels.max():
        model = _new_model(rng, rate, np.zeros(BUCKETS, np.float32))
        model.out[:] = 0
        return model

    def batch(indices):
        rows, starts, at = [], [], 0
        for i in indices:
            rows += [texts[i], np.zeros(PAD + (not len(texts[i])), np.int32)]
            starts.append(at)
            at += len(texts[i]) + len(rows[-1])
        return np.concatenate(rows), np.array(starts), labels[indices]

    order = rng.permutation(len(labels))
    held, fit = np.sort(order[: len(order) // 5]), np.sort(order[len(order) // 5 :])
    model = _new_model(rng, rate, _log_odds([texts[i] for i in fit], labels[fit]))
    check = [batch(held[at : at + 512]) for at in range(0, len(held), 512)]
    adam, best = _Adam(model.parameters()), (np.inf, None)
    epochs = max(epochs, ceil(LEAST_STEPS * BATCH / len(fit)))
    for epoch in range(epochs):
        for chosen in np.array_split(rng.permutation(fit), max(1, len(fit) // BATCH)):
            gradients, slope = _gradients(model, *batch(chosen))
            adam.update(model.parameters(), gradients, RATE * (1 - epoch / epochs))
            model.shift -= RATE * slope
        loss = float(np.average([_log_loss(model, *c) for c in check], weights=[len(c[2]) for c in check]))
        if loss < best[0]:
            best = loss, ([p.copy() for p in model.parameters()], model.shift)
    for p, kept in zip(model.parameters(), best[1][0]):
        p[:] = kept
    model.shift = best[1][1]
    logits, truth = np.concatenate([model.logits(*c[:2]) for c in check]), labels[held]
    a, b = 1.0, 0.0
    for _ in range(200):  # scale: logistic regression on one number
        p = 1 / (1 + np.exp(-np.clip(a * logits + b, -30, 30)))
        w = p * (1 - p) + 1e-6
        hess = np.array([[(w * logits**2).mean() + 1e-3, (w * logits).mean()], [(w * logits).mean(), w.mean() + 1e-3]])
        da, db = np.linalg.solve(hess, [((p - truth) * logits).mean(), (p - truth).mean()])
        a, b = max(0.05, a - 0.5 * da), b - 0.5 * db
    model.scale = (float(a), float(b))
    scores, own = model.score(logits), np.array([langs[i] for i in held])
    model.threshold = _best_threshold(scores, truth)
    for lang in np.unique(own):
        at = own == lang
        if truth[at].sum() >= OWN_THRESHOLD:
            model.thresholds[str(lang)] = _best_threshold(scores[at], truth[at])
    return model


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learns from at most ``sample`` labelled rows that are not held out: the only rows that come to the driver."""
    known = labels.filter("toxic IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").alias("_toxic"))
    known = known.filter(~held_out(F.col("_id")))
    chosen = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"), F.coalesce(F.col(lang_col), F.lit("")).alias("_lang"))
    picked = known.join(chosen.select("_id").distinct(), "_id", "left_semi").orderBy(F.xxhash64("_id"), "_id").limit(sample)
    rows = chosen.join(picked, "_id").groupBy("_id").agg(F.min(F.struct("_text", "_lang", "_toxic")).alias("r")).select("_id", "r.*")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _Ids()
        for batch in batches:
            found = [word_ids([t.as_py()], ids)[0][:-PAD].tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary()), batch.column(2), batch.column(3).cast(pa.int32())], ["_id", "rows", "_lang", "_toxic"])

    got = rows.mapInArrow(lean(run), "_id long, rows binary, _lang string, _toxic int").toArrow().sort_by("_id")
    texts = [np.frombuffer(x.as_py(), np.int32) for x in got.column("rows")]
    return train(texts, got.column("_toxic").to_numpy(), got.column("_lang").to_pylist())


def _scored(model: Model, texts: pa.Array, langs: pa.Array, ids: _Ids) -> tuple[np.ndarray, np.ndarray]:
    rows, starts = word_ids(texts.to_pylist(), ids)
    scores = model.score(model.logits(rows, starts)).astype(float)
    return scores, scores >= np.array([model.thresholds.get(x, model.threshold) for x in langs.to_pylist()])


PART = 256  # texts scored at once


def classify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, score, toxic of every row; ``toxic`` compares the score with the threshold of the row's language.

    Null and empty texts are scored like any other (no word, so no filter responds). Texts are scored whole.
    Repeated rows get equal scores. The model has a fixed size and travels with the tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _Ids()
        for batch in batches:
            for at in range(0, batch.num_rows, PART):
                part = batch.slice(at, PART)
                scores, toxic = _scored(model, part.column(1), part.column(2), ids)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores), pa.array(toxic)], ["doc_id", "score", "toxic"])

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(F.col(text_col)).alias("text"), F.coalesce(F.col(lang_col), F.lit("")).alias("lang"))
    return chosen.mapInArrow(lean(run), "doc_id long, score double, toxic boolean")


def clean_rows(docs: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that are not toxic, with all their columns; rows are judged where they are, without a join."""
    text, lang = docs.columns.index(text_col), docs.columns.index(lang_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _Ids()
        for batch in batches:
            for at in range(0, batch.num_rows, PART):
                part = batch.slice(at, PART)
                yield part.filter(pa.array(~_scored(model, part.column(text), part.column(lang), ids)[1]))

    return docs.mapInArrow(lean(run), docs.schema)


def op8_toxicity_cnn(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = classify(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "toxic")
