"""Ranked lexical search over K2-treaps of the term-document grid.

Documents are taken in ranges. A range's grid has a row for each term that the queries name and a column for each
document (documents with the same terms and length share one); a cell holds the term's impact, its damped and length
scaled frequency. The grid is cut into quadrants, again and again: each node keeps the largest impact of its quadrant
with its place, taken out of the quadrants below, a bit for each quadrant that is left, and its impact as the
difference to its parent's. Levels are stored one after the other and compressed.

A query descends all its rows together. A state is a run of columns with, for each term, the node that the term's row
path has reached; its bound adds up the largest impact that each term can still have there. States are taken
best-first, a batch at a time, until none can beat what has been found. Every range returns its best documents, of
which a ranked window keeps the best of all.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import shuffle_partitions, table, utf8, whole
from eventloom.session import materialize

TOP, RANGE_DOCS, QUERY_ITEMS, BATCH = 50, 1 << 14, 256, 192
RANGE_CELLS = 1 << 22  # cells after which a range ends, however few its documents
MOST_TERMS = 1 << 16  # rows of one grid; queries with more terms are answered in parts
MOST_N = 2**31  # terms in one document, which bounds the integers below
# Letters and digits of ASCII and all other characters make terms; A-Z are lower-cased.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def _spread(x: np.ndarray) -> np.ndarray:
    """The bits of x, each followed by a zero bit."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


_BITS = np.array([bin(i).count("1") for i in range(16)], np.int64)
#: Children before quadrant q of a node with these quadrants; -1 where it lacks q.
_BEFORE = np.array([[bin(i & ((1 << q) - 1)).count("1") if i >> q & 1 else -1 for q in range(4)] for i in range(16)], np.int64)


@dataclass
class Treap:
    """Nodes level by level, the root first; quadrant 2 * (lower half of the rows) + (right half of the columns)."""

    height: int
    value: np.ndarray  # largest impact of the node's quadrant
    row: np.ndarray  # its place
    col: np.ndarray
    mask: np.ndarray  # bit for each quadrant that has cells left
    first: np.ndarray  # number of the first child
    depth: np.ndarray
    link: np.ndarray  # nearest node above whose place lies in this node's quadrant, or -1


def build(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, height: int) -> bytes:
    """The treap over a square grid of 2^height rows and columns (no cell twice), compressed: for each level the
    quadrant bits, the impacts as differences to the parents', and the places as offsets in their quadrants."""
    codes = (_spread(rows) << np.uint64(1)) | _spread(cols)
    order = np.argsort(codes, kind="stable")
    codes, rows, cols, values = codes[order], rows[order], cols[order], values[order]
    levels: list[tuple] = []
    while len(codes):
        side = height - len(levels)
        cells = codes >> np.uint64(2 * side)
        new = np.concatenate([[True], cells[1:] != cells[:-1]])
        starts, node = np.flatnonzero(new), np.cumsum(new) - 1
        best = np.maximum.reduceat(values, starts)
        hits = np.flatnonzero(values == best[node])
        top = hits[np.concatenate([[True], node[hits][1:] != node[hits][:-1]])]
        own, gap = cells[starts], best
        if levels:
            parent = np.searchsorted(levels[-1][0], own >> np.uint64(2))
            np.bitwise_or.at(levels[-1][1], parent, (1 << (own & np.uint64(3)).astype(np.int64)).astype(np.uint8))
            gap = levels[-1][5][parent] - best
        levels.append((own, np.zeros(len(own), np.uint8), gap, rows[top] & ((1 << side) - 1), cols[top] & ((1 << side) - 1), best))
        left = np.ones(len(codes), bool)
        left[top] = False
        codes, rows, cols, values = codes[left], rows[left], cols[left], values[left]
    parts = [np.array([height, len(levels)], "<i8").tobytes()]
    for own, mask, *numbers, _ in levels:
        parts += [np.array([len(own)], "<i8").tobytes(), mask.tobytes(), *[x.astype("<u4").tobytes() for x in numbers]]
    return zstandard.compress(b"".join(parts), 1)


def unpacked(data: bytes) -> Treap:
    data = zstandard.decompress(data)
    height, depths = (int(x) for x in np.frombuffer(data, "<i8", 2))
    at, before, levels = 16, 0, []
    for depth in range(depths):
        n, side = int(np.frombuffer(data, "<i8", 1, at)[0]), height - depth
        mask = np.frombuffer(data, np.uint8, n, at + 8)
        value, row, col = (np.frombuffer(data, "<u4", n, at + 8 + n + 4 * n * i).astype(np.int64) for i in range(3))
        at += 8 + 13 * n
        if not depth:
            corner, link = (np.zeros(n, np.int64), np.zeros(n, np.int64)), np.full(n, -1)
        else:
            up, up_corner = levels[-1], corner
            bits = _BITS[up["mask"]]
            parent = np.repeat(np.arange(len(bits)), bits)
            quadrant = np.flatnonzero(np.unpackbits(up["mask"][:, None], axis=1, count=4, bitorder="little").ravel()) & 3
            corner = (up_corner[0][parent] * 2 + (quadrant >> 1), up_corner[1][parent] * 2 + (quadrant & 1))
            value = up["value"][parent] - value
            link = parent + before - len(bits)
            all_row, all_col, all_link = (np.concatenate([x[name] for x in levels]) for name in ("row", "col", "link"))
            ask = np.arange(n)
            while len(ask):
                to = link[ask]
                outside = (to >= 0) & ((all_row[to] >> side != corner[0][ask]) | (all_col[to] >> side != corner[1][ask]))
                ask = ask[outside]
                link[ask] = all_link[link[ask]]
        first = before + n + np.cumsum(_BITS[mask]) - _BITS[mask]
        levels.append({"value": value, "row": (corner[0] << side) | row, "col": (corner[1] << side) | col, "mask": mask, "first": first, "depth": np.full(n, depth), "link": link})
        before += n
    names = ("value", "row", "col", "mask", "first", "depth", "link")
    return Treap(height, *(np.concatenate([x[name] for x in levels]) if levels else np.zeros(0, np.int64) for name in names))


def search(treap: Treap, columns: int, rows: np.ndarray, weights: np.ndarray, k: int, members: np.ndarray, floor: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Columns and scores, best first, of the best columns that stand for ``k`` documents or more together
    (``members``: documents of each column), with all that tie with the last; scores under ``floor`` are left out."""
    none = np.zeros(0, np.int64)
    if not len(treap.value) or not len(rows):
        return none, none
    least, cols, scores = floor, none, none
    bound, depth, run = np.array([int(weights.sum()) * int(treap.value[0])]), np.zeros(1, np.int64), np.zeros(1, np.int64)
    node = np.zeros((1, len(rows)), np.int64)
    while len(bound):
        take = np.arange(len(bound))
        if len(bound) > BATCH:
            take = np.argpartition(bound, len(bound) - BATCH)[-BATCH:]
        rest = np.ones(len(bound), bool)
        rest[take] = False
        bounds, depths, runs, nodes = _opened(treap, depth[take], run[take], node[take], rows, weights)
        real = (bounds >= least) & (runs << (treap.height - depths) < columns)
        done = real & (depths == treap.height)
        if done.any():
            cols, scores = np.concatenate([cols, runs[done]]), np.concatenate([scores, bounds[done]])
            order = np.argsort(-scores, kind="stable")
            cols, scores = cols[order], scores[order]
            reach = np.cumsum(members[cols])
            if reach[-1] >= k:
                least = max(least, int(scores[np.searchsorted(reach, k)]))
                cols, scores = cols[scores >= least], scores[scores >= least]
        real &= (depths < treap.height) & (bounds >= least)
        rest &= bound >= least
        bound, depth, run = (np.concatenate([a[rest], b[real]]) for a, b in ((bound, bounds), (depth, depths), (run, runs)))
        node = np.concatenate([node[rest], nodes[real]])
    return cols, scores


def _opened(treap: Treap, depth, run, node, rows, weights):
    """The two halves of each run, with the nodes that the row paths reach there and the bounds. A term's bound is the
    larger of its node's impact and of the impacts that nodes passed on the way have kept for its row in the half. A
    path that has ended stays at its last node."""
    half = (treap.height - depth - 1)[:, None]
    open_ = treap.depth[node] == depth[:, None]
    mask, quadrant = np.where(open_, treap.mask[node], 0), ((rows >> half) & 1) * 2
    nodes, best = np.empty((len(run), 2, len(rows)), np.int64), np.zeros((len(run), 2, len(rows)), np.int64)
    for right in (0, 1):
        before = _BEFORE[mask, quadrant + right]
        child = np.where(before >= 0, treap.first[node] + before, node)
        nodes[:, right], best[:, right] = child, np.where(before >= 0, treap.value[child], 0)
    state, term = np.divmod(np.arange(node.size), len(rows))
    passed = node.ravel()
    while len(passed):
        col = treap.col[passed]
        mine = (treap.row[passed] == rows[term]) & (col >> (half[state, 0] + 1) == run[state])
        np.maximum.at(best, (state[mine], (col[mine] >> half[state[mine], 0]) & 1, term[mine]), treap.value[passed[mine]])
        passed = treap.link[passed]
        more = passed >= 0
        passed, state, term = passed[more], state[more], term[more]
    return (best * weights).sum(axis=2).ravel(), np.repeat(depth + 1, 2), np.stack([2 * run, 2 * run + 1], axis=1).ravel(), nodes.reshape(-1, len(rows))


def _items(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """item_id, terms: the distinct terms of each item; an id that repeats counts once, with its least text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms_of(x or b""))) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.binary()))], ["item_id", "terms"])

    once = items.groupBy(F.col(id_col).cast("long").alias("item_id")).agg(F.min(whole(F.col(text_col))).alias("text"))
    return once.select("item_id", utf8(F.col("text"))).mapInArrow(run, "item_id long, terms array<binary>")


def counted(docs: DataFrame, terms: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n (all terms of the whole text, with repeats), terms and tf: the numbers of those in ``terms`` that the
    document holds, in order, and how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, numbers, often = [], [], []
            for text in batch.column(1):
                found = terms_of(text.as_py() or b"")
                held = sorted((terms[t], c) for t, c in Counter(filter(terms.__contains__, found)).items())
                n.append(len(found))
                numbers.append([t for t, _ in held])
                often.append([c for _, c in held])
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(numbers, pa.list_(pa.int32())), pa.array(often, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "tf"])

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(whole(F.col(text_col))).alias("text"))
    return chosen.mapInArrow(run, "doc_id long, n long, terms array<int>, tf array<int>")


def _range(docs: dict[tuple, list[int]], lines: np.ndarray, documents: int, total: int, weights: np.ndarray) -> dict:
    """The index of one range: columns, ids and how many of each column, the treap. Columns whose heaviest term is the
    same lie together, so that runs of columns differ in what they can reach."""
    numbers = [np.frombuffer(key[1], "<i4") for key in docs]
    often = [np.frombuffer(key[2], "<i4").astype(np.int64) for key in docs]
    n = np.array([key[0] for key in docs], np.int64)
    lead = np.array([lines[t[np.argmax(c * weights[t])]] if len(t) else len(lines) for t, c in zip(numbers, often)])
    order = np.lexsort((-n, lead))
    ids = [sorted(x) for x in docs.values()]
    sizes = np.array([len(numbers[i]) for i in order])
    row = lines[np.concatenate([numbers[i] for i in order]).astype(np.int64)] if sizes.sum() else np.zeros(0, np.int64)
    tf = np.concatenate([often[i] for i in order]) if sizes.sum() else np.zeros(0, np.int64)
    col = np.repeat(np.arange(len(order)), sizes)
    m = np.repeat((50 + 50 * documents * n // total)[order], sizes)
    value = impacts(tf, m)
    some = value > 0
    depth = max((max(len(lines), 1) - 1).bit_length(), (len(order) - 1).bit_length())
    spread = depth - (max(len(lines), 1) - 1).bit_length()  # rows part as early as columns do
    return {
        "columns": len(order), "spread": spread,
        "ids": np.array([x for i in order for x in ids[i]], "<i8").tobytes(),
        "members": np.array([len(ids[i]) for i in order], "<i4").tobytes(),
        "treap": build(row[some] << spread, col[some], value[some], depth),
    }


RANGE = "columns long, spread int, ids binary, members binary, treap binary"


def build_index(posts: DataFrame, lines: np.ndarray, weights: np.ndarray, documents: int, total: int, range_docs: int = RANGE_DOCS) -> DataFrame:
    """One row per range of documents (see :data:`RANGE`); documents without any of the terms have no column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[tuple, list[int]] = {}
        cells = 0

        def close():
            row = _range(open_, lines, documents, total, weights)
            return pa.RecordBatch.from_pylist([row], pa.schema([("columns", pa.int64()), ("spread", pa.int32()), ("ids", pa.binary()), ("members", pa.binary()), ("treap", pa.binary())]))

        for batch in batches:
            for doc_id, n, terms, tf in zip(*(c.to_pylist() for c in batch.columns)):
                own = open_.setdefault((n, np.array(terms, "<i4").tobytes(), np.array(tf, "<i4").tobytes()), [])
                cells += len(terms) if not own else 0
                own.append(doc_id)
                if len(open_) >= range_docs or cells >= RANGE_CELLS:
                    yield close()
                    open_, cells = {}, 0
        if open_:
            yield close()

    held = posts.filter("doc_id IS NOT NULL AND size(terms) > 0").select("doc_id", "n", "terms", "tf")
    return held.mapInArrow(run, RANGE)


def top_documents(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", range_docs: int = RANGE_DOCS) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``k`` documents of highest score for each item, equal scores by
    ascending doc_id; fewer where fewer score above 0.

    The score of a document is the sum, over an item's distinct terms, of the term's weight times its impact. Texts
    are read whole, however long; null and empty ones hold no term. Every row of ``docs`` is a document: repeated rows
    count and are ranked one by one, rows without an id count in the statistics but are not ranked. An item id that
    repeats is one item, with its least text. An item without terms, an empty table and a corpus without terms give no
    rows. Other columns are not read. Queries with more than MOST_TERMS distinct terms are answered in parts, each with
    an index of its own; within a part, query blocks of bounded size meet every range.
    """
    spark = docs.sparkSession
    asked = materialize(_items(items, item_id, item_text).filter("size(terms) > 0"))
    distinct, count = asked.select(F.explode("terms").alias("t")).agg(F.count_distinct("t")).first()[0], asked.count()
    parts = -(-max(distinct, count) // MOST_TERMS) if max(distinct, count) > MOST_TERMS else 1
    out = None
    for part in range(parts):
        own = asked if parts == 1 else asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part)
        rows = _answered(spark, docs, own, k, id_col, text_col, range_docs)
        out = rows if out is None else out.unionByName(rows)
    return out


FOUND = "item_id long, doc_id long, score long"


def _answered(spark, docs, asked, k, id_col, text_col, range_docs):
    # The terms of one part are at most some MOST_TERMS, so they travel with the tasks.
    names = [r.t for r in asked.select(F.explode("terms").alias("t")).distinct().orderBy("t").collect()]
    terms = {bytes(t): i for i, t in enumerate(names)}
    posts = materialize(counted(docs, terms, id_col, text_col))
    documents, total, most = posts.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    if not total or not terms:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    if 50 * documents * most >= 2**63 or most >= MOST_N:
        raise OverflowError("scores of such long documents do not fit in 64 bits")
    df = np.zeros(len(terms), np.int64)
    for number, n in posts.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # one row per term
        df[number] = n
    weights = np.array([weight(documents, int(x)) for x in df], np.int64)
    lines = np.empty(len(terms), np.int64)
    lines[np.argsort(-df, kind="stable")] = np.arange(len(terms))  # rows by falling document frequency
    index = materialize(build_index(posts, lines, weights, documents, total, range_docs))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = [[terms[t] for t in x] for x in batch.column(1).to_pylist()]
            for at in range(0, len(numbers), QUERY_ITEMS):
                yield pa.RecordBatch.from_pydict({"items": [batch.column(0).to_pylist()[at : at + QUERY_ITEMS]], "asked": [numbers[at : at + QUERY_ITEMS]]}, pa.schema([("items", pa.list_(pa.int64())), ("asked", pa.list_(pa.list_(pa.int32())))]))

    queries = asked.coalesce(1).mapInArrow(blocks, "items array<long>, asked array<array<int>>")
    # The stated query set, of bounded size in a part, meets all ranges: query blocks are sent to every task.
    ranges = index.repartition(shuffle_partitions(spark), F.xxhash64("treap"))
    pairs = ranges.crossJoin(F.broadcast(materialize(queries)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, treap = None, None
        for batch in batches:
            for at in range(batch.num_rows):
                columns, spread, ids, members, data, items_, asked_ = (batch.column(i)[at].as_py() for i in range(7))
                if data != kept:
                    kept, treap = data, unpacked(data)
                ids, members = np.frombuffer(ids, "<i8"), np.frombuffer(members, "<i4").astype(np.int64)
                starts, found = np.cumsum(members) - members, []
                for item, numbers in zip(items_, asked_):
                    numbers = np.array(numbers, np.int64)
                    numbers = numbers[weights[numbers] > 0]
                    cols, scores = search(treap, columns, lines[numbers] << spread, weights[numbers], k, members)
                    own = np.concatenate([ids[starts[c] : starts[c] + min(k, members[c])] for c in cols] or [np.zeros(0, np.int64)])
                    all_scores = np.repeat(scores, np.minimum(k, members[cols]))
                    best = np.lexsort((own, -all_scores))[:k]
                    found += [(item, int(own[b]), int(all_scores[b])) for b in best]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*found) if found else ([], [], []))], ["item_id", "doc_id", "score"])

    partial = pairs.mapInArrow(run, FOUND)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return partial.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def op11_k2_treap(spark, sf_dir: str) -> DataFrame:
    return top_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
SQL = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS ts FROM documents),
c AS (SELECT count(*) FILTER (len(ts) > 0) AS docs, CAST(sum(len(ts)) AS BIGINT) AS total FROM d),
p AS (SELECT doc_id, CAST(len(ts) AS BIGINT) AS n, unnest(ts) AS t FROM d),
f AS (SELECT doc_id, n, t, count(*) AS tf FROM p GROUP BY doc_id, n, t),
w AS (SELECT t, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, c GROUP BY t),
i AS (SELECT DISTINCT item_id, t FROM (SELECT item_id, unnest({_TERMS}) AS t FROM benchmark)),
s AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total)))) AS BIGINT) AS score
  FROM i JOIN f USING (t) JOIN w USING (t), c GROUP BY item_id, doc_id),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT * FROM r WHERE rank <= 50
"""
