"""Near-duplicates: SimHash fingerprints, linked by a self-join of their binary trie.

Equal fingerprints are one class, so copies never meet each other. The distinct fingerprints are the leaves of a
binary trie, cut at its first few bits into subtries; two subtries whose prefixes already differ in more bits than
the budget never meet. Each remaining pair of subtries is one group of rows: a task walks both from the root,
taking the children two by two, adds a bit for children that differ, and leaves a pair of nodes as soon as it
exceeds the budget. Sorted arrays stand for the tries: a node is a range, its middle is found by binary search.
A task returns a spanning forest of the links it found, never all pairs, so groups of many near copies stay small.
Components are then joined with large-star and small-star rounds over tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations
from math import ceil, log2

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import fresh, table, without
from eventloom.session import materialize

SEED, BITS = 42, 64
SUBTRIE = 1 << 20  # fingerprints in one subtrie, on average
MIN_PREFIX = 4
LEAF_PAIRS = 64  # node pairs with fewer combinations are compared outright
STEP = 1 << 18  # node pairs, or combinations, handled at a time
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def simhash(text: str | None, words: int = 3) -> int:
    """The fingerprint as a signed 64-bit integer; zero where there is no word."""
    parts = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not parts:
        return 0
    shingles = map(b" ".join, zip(*[parts[i:] for i in range(words)])) if len(parts) >= words else [b" ".join(parts)]
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), shingles), np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), STEP):
        octets = hashes[at : at + STEP].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """doc_id, fp of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [simhash(t.as_py(), words) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks, pa.int64())], ["doc_id", "fp"])

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, "doc_id long, fp long")


def _middle(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int) -> np.ndarray:
    """Where the second child of each node begins."""
    shift = np.uint64(BITS - 1 - depth)
    first_one = ((keys[lo] >> shift) | np.uint64(1)) << shift
    return np.clip(np.searchsorted(keys, first_one), lo, hi)


def _compared(a, b, nodes, budget: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links among the leaves of each node pair."""
    alo, ahi, blo, bhi, _ = nodes
    width = bhi - blo
    count = (ahi - alo) * width
    for at in np.split(np.arange(len(count)), np.flatnonzero(np.diff(np.cumsum(count) // STEP)) + 1):
        total, ends = int(count[at].sum()), np.cumsum(count[at])
        node = np.repeat(at, count[at])
        nth = np.arange(total) - np.repeat(ends - count[at], count[at])
        i, j = alo[node] + nth // width[node], blo[node] + nth % width[node]
        near = np.bitwise_count(a[i] ^ b[j]) <= budget
        if same:
            near &= i < j
        yield i[near], j[near]


def trie_links(a: np.ndarray, b: np.ndarray | None, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of sorted distinct fingerprints that differ in ``budget`` bits or fewer; ``b`` None joins ``a`` with itself."""
    same, b = b is None, a if b is None else b
    if not len(a) or not len(b):
        return
    root = [np.array([x]) for x in (0, len(a), 0, len(b), 0)]
    stack = [(0, root)]
    while stack:
        depth, nodes = stack.pop()
        if len(nodes[0]) > STEP:  # keeps the frontier bounded
            stack += [(depth, [x[at : at + STEP] for x in nodes]) for at in range(0, len(nodes[0]), STEP)]
            continue
        alo, ahi, blo, bhi, diff = nodes
        small = ((ahi - alo) * (bhi - blo) <= LEAF_PAIRS) | (depth == BITS)
        if small.any():
            yield from _compared(a, b, [x[small] for x in nodes], budget, same)
            alo, ahi, blo, bhi, diff = (x[~small] for x in nodes)
        if not len(alo):
            continue
        amid, bmid = _middle(a, alo, ahi, depth), _middle(b, blo, bhi, depth)
        itself = same & (alo == blo) & (ahi == bhi)
        children = [
            (alo, amid, blo, bmid, diff), (amid, ahi, bmid, bhi, diff), (alo, amid, bmid, bhi, diff + 1),
            tuple(x[~itself] for x in (amid, ahi, blo, bmid, diff + 1)),
        ]
        joined = [np.concatenate(x) for x in zip(*children)]
        alive = (joined[0] < joined[1]) & (joined[2] < joined[3]) & (joined[4] <= budget)
        if alive.any():
            stack.append((depth + 1, [x[alive] for x in joined]))


def _unite(parent: np.ndarray, i: np.ndarray, j: np.ndarray, used: list) -> np.ndarray:
    """Joins the sets of i and j; every parent is a root afterwards. The links that joined two sets are added to ``used``."""
    while True:
        p, q = parent[i], parent[j]
        apart = p != q
        if not apart.any():
            return parent
        i, j = i[apart], j[apart]
        high, low = np.maximum(p[apart], q[apart]), np.minimum(p[apart], q[apart])
        np.minimum.at(parent, high, low)
        joins = np.flatnonzero(parent[high] == low)
        joins = joins[np.unique(high[joins], return_index=True)[1]]
        used.append((i[joins], j[joins]))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up


def _forest(budget: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        keys = group["fp"].to_numpy(np.int64).view(np.uint64)
        left = group["left"].to_numpy(bool)
        a, b = np.sort(keys[left]), np.sort(keys[~left])
        both, shift = np.concatenate([a, b]), len(a)
        parent, used = np.arange(len(both)), [(np.zeros(0, np.int64),) * 2]
        own = bool(group["own"].iloc[0])
        for i, j in trie_links(a, None if own else b, budget):
            parent = _unite(parent, i, j if own else j + shift, used)
        i, j = (np.concatenate(x) for x in zip(*used))
        return pd.DataFrame({"a": both[i].view(np.int64), "b": both[j].view(np.int64)})

    return run


def link_forest(classes: DataFrame, budget: int) -> DataFrame:
    """Links (a, b) of ``budget`` bits or fewer that connect exactly what all such links connect, of distinct ``fp``."""
    count = classes.count()
    bits = max(MIN_PREFIX, ceil(log2(max(1, count) / SUBTRIE))) if count else MIN_PREFIX
    prefix = F.shiftrightunsigned("fp", BITS - bits)
    flips = [sum(1 << i for i in chosen) for size in range(min(bits, budget) + 1) for chosen in combinations(range(bits), size)]
    other = F.explode(F.array(*[F.lit(m).cast("long") for m in flips]))
    rows = classes.select("fp", prefix.alias("mine"), other.alias("flip")).select(
        "fp", F.least("mine", F.col("mine").bitwiseXOR(F.col("flip"))).alias("low"), "flip",
        (F.col("mine") < F.col("mine").bitwiseXOR(F.col("flip"))).alias("smaller"),
    )
    rows = rows.select("fp", "low", "flip", (F.col("smaller") | (F.col("flip") == 0)).alias("left"), (F.col("flip") == 0).alias("own"))
    return rows.groupBy("low", "flip").applyInPandas(_forest(budget), "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node of each component, for all nodes of ``edges`` (a, b).

    Rounds of large star and small star; each is a table of its own, so a lost executor costs a re-read. They join by
    shuffle: there are many, and each table sent to all tasks costs the driver a thread and memory.
    """
    ends = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    ends = materialize(ends)

    def state(df: DataFrame):
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = state(ends)
    while now[0]:
        both = ends.unionByName(ends.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least.hint("merge"), "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        ends = materialize(small)
        before, now = now, state(ends)
        if before == now:
            break
    return ends.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(ends.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_dedup(docs: DataFrame, budget: int = 3, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (signed), component_id (smallest doc_id reachable) of every row.

    Fingerprints link where ``budget`` bits or fewer differ. Null and empty texts, and those without a word, have
    fingerprint zero and link like any other. Repeated rows and ids are each returned. Very long texts are hashed
    whole. An empty table gives an empty result. Other columns are not read.
    """
    marked = materialize(fingerprints(docs, id_col, text_col, words))
    classes = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    forest = materialize(link_forest(classes, budget))
    rooted = classes.join(components(forest), F.col("fp") == F.col("node"), "left")
    rooted = materialize(rooted.select("fp", "first", F.coalesce("root", "fp").alias("root")))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = materialize(rooted.join(smallest, "root").select("fp", "component_id"))
    return marked.join(labels, "fp").select("doc_id", "fp", "component_id")


def kept_rows(docs: DataFrame, budget: int = 3, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one of each group, with all columns: the one with the smallest id. Rows that
    repeat an id are one document; the least of them stands for it. Rows without an id stay, as nothing names them."""
    found = near_dedup(docs, budget, words, id_col, text_col)
    (id_,) = fresh(docs, "_id")
    ids = found.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias(id_)).agg(F.min("component_id").alias("component_id"), F.count(F.lit(1)).alias("listed"))
    ids = materialize(ids.filter((F.col(id_) != F.col("component_id")) | (F.col("listed") > 1)))
    dropped, listed = ids.filter(F.col(id_) != F.col("component_id")).select(id_), ids.filter(F.col(id_) == F.col("component_id")).select(id_)
    return without(docs, dropped, listed, F.col(id_col), F.col(id_col) == F.col(id_))


def op9_simhash_trie(spark, sf_dir: str) -> DataFrame:
    found = near_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
