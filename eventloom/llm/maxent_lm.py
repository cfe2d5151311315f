"""Language-model scores from a hashed maximum-entropy model.

A token's probability is a product of softmax choices: words are the leaves of a tree of classes, each class has at
most 16 parts, and frequent words lie near the root. A choice sums the weights of its features: the class itself, and
the class together with the word before (bigram), the word two before (skip) and both (trigram). Context features
share a table of fixed size by hashing; a row of it holds the 16 weights of one feature.

Corpus counts come from all training texts: texts are cut into blocks of token numbers, each with the list of its
words, and a shuffle by word gives every word its count. The classes' own weights start from those counts. The others
are trained in rounds: every task walks over its blocks with adaptive gradient steps, and the tasks' changes are
averaged, row by row, by how often a row was met, in a tree of shuffles. Words that are too rare to be leaves share one;
among them a word has the share of its count, and unknown words together the share that words seen once suggest.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import table, tree_merged, utf8, whole
from eventloom.session import materialize

PARTS = 16  # of a class
ROW_BITS = 16  # rows of the hashed table, as a power of two
LEAVES = 1 << 15  # words that get a leaf of their own, at most
BLOCK_TOKENS = 1 << 21
ROUNDS, BATCH, RATE = 4, 1 << 13, 0.1
FEW = 4
LARGEST = 80.0  # of a logit, so that its exponential fits in 32 bits
SHARDS = 16  # in which the table is averaged
END = b"\n"  # no word holds it
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))  # fixed values: odd multipliers


@dataclass
class Model:
    path: np.ndarray  # leaf by depth: class, -1 where the path has ended
    part: np.ndarray  # leaf by depth: part of the class
    base: np.ndarray  # class by part: log share of the counts
    weights: np.ndarray  # hashed row by part


def classes(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Paths, parts and base weights of a Huffman tree with PARTS-way choices over leaves with these counts."""
    leaves = len(counts)
    heap = [(float(c), i, i) for i, c in enumerate(np.maximum(counts, 0.5))]
    while len(heap) > 1 and (len(heap) - 1) % (PARTS - 1):
        heap.append((0.0, len(heap), -1))  # parts that are not there
    heapq.heapify(heap)
    children: list[list[tuple[float, int]]] = []
    order = len(heap)
    while len(heap) > 1 or not children:
        taken = [heapq.heappop(heap) for _ in range(min(PARTS, len(heap)))]
        children.append([(c, what) for c, _, what in taken])
        heapq.heappush(heap, (sum(c for c, _, _ in taken), order, leaves + len(children) - 1))
        order += 1
        if len(heap) == 1:
            break
    base = np.full((len(children), PARTS), -30.0, np.float32)
    steps: list[list[tuple[int, int]]] = [[] for _ in range(leaves)]
    open_ = [(len(children) - 1, [])]
    while open_:
        number, before = open_.pop()
        total = sum(c for c, _ in children[number])
        for part, (c, what) in enumerate(children[number]):
            if what < 0:
                continue
            base[number, part] = np.log(c / total)
            way = [*before, (number, part)]
            if what < leaves:
                steps[what] = way
            else:
                open_.append((what - leaves, way))
    depth = max(map(len, steps))
    path, part = np.full((leaves, depth), -1, np.int32), np.zeros((leaves, depth), np.int32)
    for leaf, way in enumerate(steps):
        path[leaf, : len(way)], part[leaf, : len(way)] = zip(*way)
    return path, part, base


def contexts(leaves: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hashes of the three context features of each token; texts begin at ``starts``, before which is nothing."""
    one, two = np.full(len(leaves), -1, np.int64), np.full(len(leaves), -1, np.int64)
    one[1:], two[2:] = leaves[:-1], leaves[:-2]
    one[starts] = -1
    two[starts] = -1
    second = starts + 1
    two[second[second < len(leaves)]] = -1
    a, b = (one + 2).astype(np.uint64), (two + 2).astype(np.uint64)
    out = np.stack([a * _MIX[0], b * _MIX[1] + np.uint64(1), (a * _MIX[0] + b) * _MIX[2] + np.uint64(2)], axis=1)
    return out ^ (out >> np.uint64(29))


def asked(hashes: np.ndarray, on: np.ndarray, depth: int) -> np.ndarray:
    """The features of a choice: the trigram, which comes last, belongs to the first one only."""
    return hashes.take(on, axis=0)[:, : 2 if depth else 3]


def rows_of(hashes: np.ndarray, node: np.ndarray, bits: int) -> np.ndarray:
    """Table rows of the features (token by feature) at the tokens' classes."""
    return (((hashes + (node.astype(np.uint64) * _MIX[1])[:, None]) * _MIX[0]) >> np.uint64(64 - bits)).astype(np.int64)


def _exponentials(model: Model, rows: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token by part, and their sum by token. Logits are kept where neither overflows."""
    x = model.base.take(node, axis=0)
    for feature in range(rows.shape[1]):
        x += model.weights.take(rows[:, feature], axis=0)
    np.clip(x, -LARGEST, LARGEST, out=x)
    np.exp(x, out=x)
    return x, x @ np.ones(PARTS, np.float32)


def chances(model: Model, rows: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Probabilities of the 16 parts, token by part."""
    x, total = _exponentials(model, rows, node)
    x /= total[:, None]
    return x


def score_tokens(model: Model, leaves: np.ndarray, starts: np.ndarray, bits: int) -> np.ndarray:
    """log10 probability of each token's leaf after its context."""
    hashes, out = contexts(leaves, starts), np.zeros(len(leaves))
    for at in range(0, len(leaves), BATCH):
        own, some = leaves[at : at + BATCH], hashes[at : at + BATCH]
        for depth in range(model.path.shape[1]):
            node = model.path[own, depth]
            on = np.flatnonzero(node >= 0)
            if not len(on):
                break
            node = node[on]
            x, total = _exponentials(model, rows_of(asked(some, on, depth), node, bits), node)
            out[at + on] += np.log10(x[np.arange(len(on)), model.part[own[on], depth]] / total)
    return out


def _totals(x: np.ndarray, first: np.ndarray, often: np.ndarray) -> np.ndarray:
    """Sums of the runs of rows of ``x`` that begin at ``first``; most runs are short and are added place by place."""
    out = x.take(first, axis=0)
    for place in range(1, FEW):
        at = np.flatnonzero((often > place) & (often <= FEW))
        if len(at):
            out[at] += x.take(first[at] + place, axis=0)
    many = np.flatnonzero(often > FEW)
    if len(many):
        ends = np.stack([first[many], first[many] + often[many]], axis=1).ravel()
        out[many] = np.add.reduceat(x, ends[:-1] if ends[-1] == len(x) else ends, axis=0)[::2]
    return out


class Trainer:
    """Walks over blocks and changes its own copy of the weights."""

    def __init__(self, model: Model, bits: int, rate: float = RATE):
        self.start, self.bits, self.rate = model.weights, bits, rate
        self.small = np.uint16 if bits <= 16 else np.int64
        self.model = Model(model.path, model.part, model.base, model.weights.copy())
        self.squares = np.full(len(model.weights), 1e-2, np.float32)
        self.met = np.zeros(len(model.weights), np.float32)

    def learn(self, leaves: np.ndarray, starts: np.ndarray) -> None:
        hashes, model = contexts(leaves, starts), self.model
        for at in range(0, len(leaves), BATCH):
            own, some = leaves[at : at + BATCH], hashes[at : at + BATCH]
            for depth in range(model.path.shape[1]):
                node = model.path[own, depth]
                on = np.flatnonzero(node >= 0)
                if not len(on):
                    break
                node = node[on]
                rows = rows_of(asked(some, on, depth), node, self.bits)
                slope = chances(model, rows, node)
                slope[np.arange(len(on)), model.part[own[on], depth]] -= 1
                for feature in range(rows.shape[1]):
                    order = np.argsort(rows[:, feature].astype(self.small), kind="stable")  # of 16 bits: by radix
                    sorted_ = rows[:, feature].take(order)
                    first = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
                    row, often = sorted_[first], np.diff(np.append(first, len(sorted_)))
                    total = _totals(slope.take(order, axis=0), first, often)
                    squares = self.squares.take(row) + np.einsum("ij,ij->i", total, total) / PARTS
                    total *= (self.rate / np.sqrt(squares))[:, None]
                    self.squares[row] = squares
                    self.met[row] += often
                    model.weights[row] = model.weights.take(row, axis=0) - total

    def change(self) -> np.ndarray:
        """Row by (16 changes times the times met, times met)."""
        return np.concatenate([(self.model.weights - self.start) * self.met[:, None], self.met[:, None]], axis=1).astype("<f4")


def _squeezed(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32, the lower halves first: the upper ones are mostly zero."""
    return zstandard.compress(numbers.astype("<u2").tobytes() + (numbers >> 16).astype("<u2").tobytes(), 1)


def _numbers(data: bytes) -> np.ndarray:
    halves = np.frombuffer(zstandard.decompress(data), "<u2").astype(np.int64)
    return halves[: len(halves) // 2] | halves[len(halves) // 2 :] << 16


BLOCK = "block long, docs array<long>, held array<boolean>, lengths array<int>, tokens binary, words array<binary>, train array<int>"
_BLOCK = pa.schema([("block", pa.int64()), ("docs", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("lengths", pa.list_(pa.int32())), ("tokens", pa.binary()), ("words", pa.list_(pa.binary())), ("train", pa.list_(pa.int32()))])


class _Numbers(dict):
    """Word to number, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def blocks(docs: DataFrame, held: Column, id_col: str, text_col: str, block_tokens: int) -> DataFrame:
    """Texts in blocks of some ``block_tokens`` tokens: the texts' tokens as numbers of the block's own word list, and
    how often each word occurs in its training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, ids, flags, texts, size, nth = _Numbers(), [], [], [], 0, TaskContext.get().partitionId() << 32

        def close():
            lengths = [len(t) for t in texts]
            tokens = np.concatenate(texts)
            train = np.bincount(tokens[np.repeat(~np.array(flags), lengths)], minlength=len(numbers))
            row = {"block": nth, "docs": ids, "held": flags, "lengths": lengths, "tokens": _squeezed(tokens), "words": list(numbers), "train": train}
            return pa.RecordBatch.from_pylist([row], _BLOCK)

        for batch in batches:
            for doc_id, out, text in zip(*(c.to_pylist() for c in batch.columns)):
                words = (text or b"").lower().split()  # of bytes: A-Z alone are lower-cased, and ASCII white space alone parts words
                words.append(END)
                ids.append(doc_id)
                flags.append(out)
                texts.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
                size += len(words)
                if size >= block_tokens:
                    yield close()
                    numbers, ids, flags, texts, size, nth = _Numbers(), [], [], [], 0, nth + 1
        if ids:
            yield close()

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), held.alias("held"), utf8(whole(F.col(text_col))).alias("text"))
    return chosen.mapInArrow(run, BLOCK)


def counted(blocked: DataFrame) -> DataFrame:
    """block, pos (a word's number there), c (its count in all training texts), first (true in one block for each
    word), word (where it is first and counts more than once). A word has one row per block that holds it."""
    rows = blocked.select("block", F.posexplode(F.arrays_zip("words", "train")).alias("pos", "w")).select("block", "pos", F.col("w.words").alias("word"), F.col("w.train").alias("train"))
    by_word = Window.partitionBy("word").orderBy("block")
    rows = rows.withColumn("first", F.row_number().over(by_word) == 1).withColumn("c", F.sum("train").over(by_word.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return rows.select("block", "pos", "c", "first", F.when(F.col("first") & (F.col("c") > 1), F.col("word")).alias("word"))


@dataclass
class Counts:
    tokens: int  # of training
    words: int  # distinct
    once: int  # words seen once
    leaves: dict[bytes, int]  # word to leaf; the leaf after them is that of all other words
    rare: int  # training tokens of the words without a leaf


def coded(blocked: DataFrame, seen: DataFrame, counts: Counts) -> DataFrame:
    """Each block with its tokens as leaves, and for each text: known tokens, base score, and the log share of rare and
    unknown words in their leaf."""
    rare, share = len(counts.leaves), counts.rare + max(1, counts.once)

    def run(block: pa.Table, words: pa.Table) -> pa.Table:
        if not block.num_rows:
            return _CODED.empty_table()
        row = block.to_pylist()[0]
        c = np.zeros(len(row["words"]), np.int64)
        c[words.column("pos").to_numpy()] = words.column("c").to_numpy()
        leaf = np.fromiter((counts.leaves.get(w, rare) for w in row["words"]), np.int64, len(c))
        rest = np.where(leaf == rare, np.log10(np.where(c > 0, c, max(1, counts.once)) / share), 0.0)
        base = np.log10((c + 1) / (counts.tokens + counts.words + 1))
        tokens, starts = _numbers(row["tokens"]), np.cumsum([0, *row["lengths"][:-1]])
        added = {name: np.add.reduceat(x[tokens], starts) for name, x in (("known", (c > 0).astype(np.int32)), ("base", base), ("rest", rest))}
        return pa.Table.from_pylist([{k: row[k] for k in ("block", "docs", "held", "lengths")} | added | {"leaves": zstandard.compress(leaf[tokens].astype("<u2").tobytes(), 1)}], _CODED)

    left = blocked.select("block", "docs", "held", "lengths", "tokens", "words").groupBy("block")
    return left.cogroup(seen.select("block", "pos", "c").groupBy("block")).applyInArrow(run, CODED)


CODED = "block long, docs array<long>, held array<boolean>, lengths array<int>, known array<int>, base array<double>, rest array<double>, leaves binary"
_CODED = pa.schema([("block", pa.int64()), ("docs", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("lengths", pa.list_(pa.int32())), ("known", pa.list_(pa.int32())), ("base", pa.list_(pa.float64())), ("rest", pa.list_(pa.float64())), ("leaves", pa.binary())])


def _leaves(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), "<u2").astype(np.int64)


def trained(rows: DataFrame, model: Model, tasks: int, bits: int, rate: float) -> np.ndarray | None:
    """The model's weights after the training texts of ``rows``; None where there is none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, met = Trainer(model, bits, rate), False
        for batch in batches:
            for held, lengths, data in zip(*(c.to_pylist() for c in batch.columns)):
                lengths, train = np.array(lengths), ~np.array(held)
                if train.any():
                    met = True
                    trainer.learn(_leaves(data)[np.repeat(train, lengths)], np.cumsum([0, *lengths[train][:-1]]))
        if met:
            change, node = np.array_split(trainer.change(), SHARDS), TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pydict({"shard": pa.array(range(SHARDS), pa.int32()), "node": pa.array([node] * SHARDS, pa.int64()), "payload": [x.tobytes() for x in change]})

    def add(payloads: list[bytes]) -> bytes:
        total = np.frombuffer(payloads[0], "<f4").copy()
        for payload in payloads[1:]:
            total += np.frombuffer(payload, "<f4")
        return total.tobytes()

    changes = rows.select("held", "lengths", "leaves").coalesce(tasks).mapInArrow(run, "shard int, node long, payload binary")
    merged = tree_merged(materialize(changes), add).orderBy("shard").collect()  # the table's fixed size
    if not merged:
        return None
    total = np.concatenate([np.frombuffer(r.payload, "<f4") for r in merged]).reshape(-1, PARTS + 1)
    return model.weights + total[:, :PARTS] / np.maximum(total[:, PARTS:], 1)


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_texts(
    docs: DataFrame, held: Column, id_col: str = "doc_id", text_col: str = "text", leaves: int = LEAVES, bits: int = ROW_BITS,
    rounds: int = ROUNDS, rate: float = RATE, block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """One row per document (see :data:`SCORED`). The model learns from the rows where ``held`` is false.

    Words are parted by ASCII white space, A-Z are lower-cased, and each text ends with one more token. Texts are read
    whole, however long; null and empty ones are the closing token alone. Repeated rows count, and are returned, one by
    one; a null id is a row like others. Without any training text all words are unknown and share probability 1. An
    empty table gives an empty result. Other columns are not read. Counts are exact and of all training texts; a block
    and its word list are what a task holds, and the tree of ``leaves`` words and the table of 2^bits rows have a fixed
    size.
    """
    if leaves >= 1 << 16:
        raise ValueError("leaves are stored in 16 bits")
    blocked = materialize(blocks(docs, held, id_col, text_col, block_tokens))
    seen = materialize(counted(blocked))
    first = F.col("first")
    told = seen.agg(
        F.coalesce(F.sum(F.when(first, F.col("c"))), F.lit(0)).alias("tokens"), F.count_if(first & (F.col("c") > 0)).alias("words"), F.count_if(first & (F.col("c") == 1)).alias("once")
    ).first()
    frequent = seen.filter("word IS NOT NULL").orderBy(F.desc("c"), "word").limit(leaves).select("word", "c").collect()
    often = np.array([r.c for r in frequent], float)
    rare = int(told.tokens - often.sum())
    counts = Counts(told.tokens, told.words, told.once, {bytes(r.word): i for i, r in enumerate(frequent)}, rare)
    rows = materialize(coded(blocked, seen, counts))
    path, part, base = classes(np.append(often, rare + max(1, told.once)))
    model = Model(path, part, base, np.zeros((1 << bits, PARTS), np.float32))
    of_round = F.pmod(F.xxhash64("block"), F.lit(rounds))
    sizes = dict(rows.groupBy(of_round.alias("r")).count().collect())  # one row per round
    for number in range(rounds):
        if sizes.get(number):
            weights = trained(rows.filter(of_round == number), model, -(-sizes[number] // 2), bits, rate)
            model.weights = model.weights if weights is None else weights.astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for docs_, held_, lengths, known, base_, rest, data in zip(*(c.to_pylist() for c in batch.columns)):
                starts = np.cumsum([0, *lengths[:-1]])
                found = np.add.reduceat(score_tokens(model, _leaves(data), starts, bits), starts) + rest
                tokens = np.full(len(docs_), counts.tokens)
                columns = [pa.array(docs_, pa.int64()), pa.array(held_, pa.bool_()), pa.array(lengths, pa.int64()), pa.array(known, pa.int64()), pa.array(tokens, pa.int64()), pa.array(base_), pa.array(found)]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in SCORED.split(", ")])

    return rows.select("docs", "held", "lengths", "known", "base", "rest", "leaves").mapInArrow(run, SCORED)


def op13_maxent_lm(spark, sf_dir: str) -> DataFrame:
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))
    return score_texts(table(spark, sf_dir, "documents"), held)
