"""Near copies: SimHash fingerprints joined by their trie, then exactly checked; the Jaccard similarity of shingle sets decides.

Rows with equal sets are one class. The classes' fingerprints (three words, as in :mod:`simhash_trie`) meet in the trie
self-join; the links of its forest are verified on the whole sets, and those of 0.8 or more are joined to components.

What the fingerprints leave apart is completed by an exact join, so no link is missed. Of a set's n shingles, in any order
that all sets share, two sets that are similar enough have one in common among the first n - ceil(0.8 n) + 1, so those are
what is joined. The order puts common shingles last. How common they are is a sketch, which decides about work only.
Classes that share such a shingle first meet their neighbours in the order of the fingerprints, turned several ways; only
what is still in different components meets in pairs, so a large group of near copies costs about its size. A pair is left
out where the places of the shared shingle or the parity of the sets' parts show that it cannot be similar enough.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import MOST_BROADCAST_ROWS, fresh, lean, without
from eventloom.llm.simhash_trie import BITS, SEED, _LOWER, components, link_forest, simhash
from eventloom.session import materialize

SKETCH = 20  # bits of a shingle's hash that are counted together
BUDGET, PRINT_WORDS = 3, 3  # bits that linked fingerprints differ in at most, and the words of what they are made of
TURNS = (0, 16, 32, 48)  # bits by which fingerprints are turned before their order tells who meets first
SHORT = 128  # bits of the parity that travels with each shingle
BITMAP = 1024  # bits that tell for parts of a set whether their size is odd
WIDE = 1 << 14  # the same for the sets that pass, as long sets fill the short bitmap
CHUNK = 256  # pairs of one class that travel with one copy of its set
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def shingles(text: str | None, words: int = 5) -> np.ndarray:
    """The sorted distinct hashes of all runs of ``words`` words; of all words where there are fewer, none without a word."""
    parts = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not parts:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), parts), np.uint64, len(parts))
    width = min(words, len(parts))
    runs = np.full(len(parts) - width + 1, width, np.uint64)
    for i in range(width):
        runs = runs * _STEP + hashes[i : len(parts) - width + 1 + i]
    for _ in range(2):
        runs = (runs ^ (runs >> np.uint64(32))) * _MIX
    return np.unique(runs ^ (runs >> np.uint64(32)))


def _digest(marks: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(marks.tobytes(), seed=SEED)).astype(np.int64))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the Jaccard similarity of two sorted distinct arrays is 0.8 or more, in whole numbers."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 9 * both >= 4 * (len(a) + len(b))


def bitmap(marks: np.ndarray, bits: int = BITMAP) -> bytes:
    """The set's size (8 bytes), then its parity bitmap."""
    odd = np.bincount((marks & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.array([len(marks)], "<i8").tobytes() + np.packbits(odd.astype(np.uint8)).tobytes()


def possible(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether sets with these bitmaps (one a row, as 8-byte words) can be similar: a bit that differs is an element apart."""
    apart = np.bitwise_count(a[:, 1:] ^ b[:, 1:]).sum(axis=1, dtype=np.int64)
    return 9 * apart <= (a[:, 0] + b[:, 0]).astype(np.int64)


def _mapped(docs: DataFrame, words: int, rows, schema: str) -> DataFrame:
    """``rows`` turns the ids, sets and texts of a batch into columns; called with None at the end of a task."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {}
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                texts = batch.column(1).to_pylist()
                yield pa.RecordBatch.from_arrays(rows(state, batch.column(0), [shingles(t, words) for t in texts], texts), names)
        last = rows(state, None, [], [])
        if last:
            yield pa.RecordBatch.from_arrays(last, names)

    return docs.mapInArrow(lean(run), schema)


CLASSES = "doc_id long, class long, fp long, odd0 long, odd1 long, bits binary, bucket long, seen long"


def _classes(state: dict, ids, sets, texts):
    """The class, fingerprint and parities of each row; at the end, the parts of the sketch that stand out."""
    counts = state.setdefault("counts", np.zeros(1 << SKETCH, np.int64))
    if ids is not None:
        for marks in sets:
            np.add.at(counts, (marks >> np.uint64(64 - SKETCH)).astype(np.int64), 1)
        none = pa.nulls(len(sets), pa.int64())
        odd = np.frombuffer(b"".join(bitmap(x, SHORT) for x in sets), np.int64).reshape(-1, 1 + SHORT // 64)
        prints = pa.array([simhash(t, PRINT_WORDS) for t in texts], pa.int64())
        return [ids, pa.array([_digest(x) for x in sets], pa.int64()), prints, pa.array(odd[:, 1]), pa.array(odd[:, 2]), pa.array([bitmap(x) for x in sets], pa.binary()), none, none]
    mean = counts.mean()
    high = np.flatnonzero(counts > mean + 6 * np.sqrt(mean) + 8)
    none = pa.nulls(len(high), pa.int64())
    return [none, none, none, none, none, pa.nulls(len(high), pa.binary()), pa.array(high, pa.int64()), pa.array(counts[high], pa.int64())]


def _first_ones(order: np.ndarray):
    """The shingles of each row's set that are joined, and the place of each in the order of the whole set."""

    def rows(_, ids, sets, texts):
        if ids is None:
            return None
        out = []
        for marks in sets:
            n = len(marks)
            at = np.argsort(order[(marks >> np.uint64(64 - SKETCH)).astype(np.int64)], kind="stable")
            out.append(marks[at[: n - (4 * n + 4) // 5 + 1]] if n else marks)
        sizes = np.array([len(x) for x in out], np.int64)
        own = np.repeat(np.array([_digest(x) for x in sets], np.int64), sizes)
        whole = np.repeat(np.array([len(x) for x in sets], np.int32), sizes)
        at = np.concatenate([*map(np.arange, sizes), np.empty(0, np.int64)]).astype(np.int32)
        return [pa.array(np.concatenate([*out, np.empty(0, np.uint64)]).view(np.int64)), pa.array(own), pa.array(whole), pa.array(at)]

    return rows


def _sets(_, ids, sets, texts):
    if ids is None:
        return None
    return [pa.array([_digest(x) for x in sets], pa.int64()), pa.array([bitmap(x, WIDE) for x in sets], pa.binary()), pa.array([x.tobytes() for x in sets], pa.binary())]


def _sifted(pairs: DataFrame, bitmaps: DataFrame, bits: int) -> DataFrame:
    """Those of ``pairs`` that the bitmaps do not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint64).reshape(-1, 1 + bits // 64) for i in (2, 3))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(possible(a, b)))

    return materialize(_attached(pairs, bitmaps).mapInArrow(lean(run), "a long, b long"))


def _attached(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` with the sets of both; a class in many pairs is dealt out in chunks. The joins are by shuffle, as each table
    sent to all tasks costs the driver memory, and these are many."""
    copies = F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("copies")
    often = pairs.select(F.explode(F.array(*[F.struct(F.lit(k).alias("side"), F.col(k).alias("own")) for k in ("a", "b")])).alias("end"))
    often = materialize(often.groupBy("end.side", "end.own").agg(copies).filter("copies > 1"))
    if often.isEmpty():
        for key in ("a", "b"):
            pairs = pairs.join(sets.select(F.col("class").alias(key), F.col("marks").alias(f"marks_{key}")).hint("merge"), key)
        return pairs.select("a", "b", "marks_a", "marks_b")
    few = often.count() <= MOST_BROADCAST_ROWS
    for key in ("a", "b"):
        many = often.filter(F.col("side") == key).select(F.col("own").alias(key), "copies")
        pairs = pairs.join(F.broadcast(many) if few else many, key, "left")
        pairs = pairs.withColumn("nth", F.pmod(F.xxhash64("a", "b"), F.coalesce("copies", F.lit(1))).cast("int")).drop("copies")
        spread = sets.withColumnRenamed("class", key).join(F.broadcast(many) if few else many, key, "left")
        spread = spread.select(key, F.col("marks").alias(f"marks_{key}"), F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1)).alias("nth"))
        pairs = pairs.join(spread.hint("merge"), [key, "nth"]).drop("nth")
    return pairs.select("a", "b", "marks_a", "marks_b")


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, words: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets are similar."""
    if pairs.isEmpty():
        return pairs
    pairs = _sifted(pairs, classes.select("class", F.col("bits").alias("marks")), BITMAP)
    needed = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class"))).distinct()
    ids = materialize(classes.join(needed, "class").select(F.col("first").alias("doc_id")).distinct())
    if ids.count() <= MOST_BROADCAST_ROWS:
        ids = F.broadcast(ids)
    sets = _mapped(docs.join(ids, "doc_id", "left_semi"), words, _sets, "class long, wide binary, marks binary")
    sets = materialize(sets.groupBy("class").agg(F.first("wide").alias("wide"), F.first("marks").alias("marks")))
    pairs = _sifted(pairs, sets.select("class", F.col("wide").alias("marks")), WIDE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = zip(batch.column(2), batch.column(3))
            keep = pa.array([similar(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)) for x, y in marks], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(keep)

    return materialize(_attached(pairs, sets.select("class", "marks")).mapInArrow(lean(run), "a long, b long"))


def _print_links(classes: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes whose fingerprints are equal or linked by the trie join, as many as connect them."""
    prints = materialize(classes.groupBy("fp").agg(F.min("class").alias("one")))
    same = classes.join(prints.hint("merge"), "fp").filter("class <> one").select(F.col("class").alias("a"), F.col("one").alias("b"))
    forest = link_forest(prints.select("fp"), BUDGET)
    ends = forest.join(prints.toDF("a", "one_a").hint("merge"), "a").join(prints.toDF("b", "one_b").hint("merge"), "b").select(F.col("one_a").alias("a"), F.col("one_b").alias("b"))
    return materialize(same.unionByName(ends).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))


def _extended(stars: DataFrame | None, links: DataFrame) -> DataFrame:
    """node, root as of :func:`components`, for the links that ``stars`` came from and ``links``; a known component enters as its star."""
    if stars is None:
        return materialize(components(links))
    return stars if links.isEmpty() else materialize(components(links.unionByName(stars.toDF("a", "b"))))


def _may_link(n: Column, at: Column, m: Column, other_at: Column) -> Column:
    """Whether sets of n and m shingles can be similar if the first that they share has these places: what they share lies from there on."""
    least = (n + m) * 4
    return ((n - at) * 9 >= least) & ((m - other_at) * 9 >= least)


def _turned(bits: int) -> Column:
    return F.shiftleft("fp", bits).bitwiseOR(F.shiftrightunsigned("fp", BITS - bits)) if bits else F.col("fp")


def _neighbours(placed: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes in different components that share a shingle and follow one another in the order of their fingerprints."""
    alike = Window.partitionBy("shingle")
    row = placed.withColumn("mixed", F.min("root").over(alike) < F.max("root").over(alike)).filter("mixed")
    before = [F.lag(F.struct("class", "n", "at", "root")).over(alike.orderBy(_turned(t), "class")) for t in TURNS]
    met = row.select("class", "n", "at", "root", F.array(*before).alias("others")).withColumn("other", F.explode("others"))
    met = met.filter("other IS NOT NULL AND other.root <> root")
    met = met.filter(_may_link(F.col("n"), F.col("at"), F.col("other.n"), F.col("other.at")))
    return materialize(met.select(F.least("class", "other.class").alias("a"), F.greatest("class", "other.class").alias("b")).distinct())


def _apart(placed: DataFrame) -> DataFrame:
    """All pairs (a, b) of classes in different components that share a shingle and may be similar."""
    groups = placed.groupBy("shingle", "root").agg(F.count(F.lit(1)).alias("size")).groupBy("shingle")
    groups = materialize(groups.agg(F.max(F.struct("size", "root")).getField("root").alias("main"), F.count(F.lit(1)).alias("roots")).filter("roots > 1").select("shingle", "main"))
    apart = materialize(placed.join(groups, "shingle"))
    rest = apart.filter("root <> main").select("shingle", *[F.col(c).alias(f"other_{c}") for c in ("class", "n", "at", "root", "odd0", "odd1")])
    odd = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"other_{c}"))) for c in ("odd0", "odd1")), F.lit(0))
    once = (F.col("root") == F.col("main")) | (F.col("class") < F.col("other_class"))  # two of the rest would meet twice
    fits = _may_link(F.col("n"), F.col("at"), F.col("other_n"), F.col("other_at")) & (odd * 9 <= F.col("n") + F.col("other_n"))
    pairs = apart.join(rest, "shingle").filter((F.col("root") != F.col("other_root")) & once & fits)
    return pairs.select(F.least("class", "other_class").alias("a"), F.greatest("class", "other_class").alias("b")).distinct()


def near_copies(docs: DataFrame, words: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, component_id (smallest doc_id reachable) of every row that has an id.

    Null and empty texts, and those without a word, are copies of one another. Repeated rows and ids are each
    returned. An empty table gives an empty result. Other columns are not read.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).filter("doc_id IS NOT NULL")
    marked = materialize(_mapped(docs, words, _classes, CLASSES))
    order = np.zeros(1 << SKETCH, np.uint8)
    for r in marked.filter("bucket IS NOT NULL").groupBy("bucket").agg(F.sum("seen").alias("seen")).toLocalIterator():
        order[r.bucket] = r.seen.bit_length()
    one = [F.min("fp").alias("fp"), *[F.first(c).alias(c) for c in ("odd0", "odd1", "bits")]]
    classes = materialize(marked.filter("doc_id IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("first"), *one))
    marked = marked.filter("doc_id IS NOT NULL").select("doc_id", "class")

    printed = _print_links(classes)
    links = _verified(printed, docs, classes, words)

    joined = _mapped(docs, words, _first_ones(order), "shingle long, class long, n int, at int")
    along = Window.partitionBy("shingle")
    shared = joined.select(
        "shingle", "class", "n", "at", F.lag("class").over(along.orderBy("class")).alias("before"), F.min("class").over(along).alias("low"), F.max("class").over(along).alias("high")
    )
    # the first row of a class stands for it; a shingle of one class alone is left out
    shared = materialize(shared.filter("low < high AND (before IS NULL OR before <> class)").select("shingle", "class", "n", "at"))

    def placed(stars: DataFrame, *names: str) -> DataFrame:
        """The shared shingles with the component and more columns of their classes."""
        known = classes.select("class", *names).join(stars.hint("merge"), F.col("class") == F.col("node"), "left")
        return materialize(shared.join(materialize(known.select("class", *names, F.coalesce("root", "class").alias("root"))), "class"))

    stars = _extended(None, links)
    met = _neighbours(placed(stars, "fp"))
    stars = _extended(stars, _verified(met, docs, classes, words))
    rest = _apart(placed(stars, "odd0", "odd1"))
    rest = materialize(rest.join(printed.unionByName(met), ["a", "b"], "left_anti"))
    stars = _extended(stars, _verified(rest, docs, classes, words))

    rooted = classes.join(stars.hint("merge"), F.col("class") == F.col("node"), "left")
    rooted = materialize(rooted.select("class", "first", F.coalesce("root", "class").alias("root")))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return marked.join(materialize(rooted.join(smallest, "root").select("class", "component_id")), "class").select("doc_id", "component_id")


def kept_rows(docs: DataFrame, words: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one of each group, with all columns: the one with the smallest id. Rows that
    repeat an id are one document; the least of them stands for it. Rows without an id stay, as nothing names them."""
    (id_,) = fresh(docs, "_id")
    ids = near_copies(docs, words, id_col, text_col).groupBy(F.col("doc_id").alias(id_)).agg(F.min("component_id").alias("component_id"), F.count(F.lit(1)).alias("listed"))
    ids = materialize(ids.filter((F.col(id_) != F.col("component_id")) | (F.col("listed") > 1)))
    dropped, listed = ids.filter(F.col(id_) != F.col("component_id")).select(id_), ids.filter(F.col(id_) == F.col("component_id")).select(id_)
    return without(docs, dropped, listed, F.col(id_col), F.col(id_col) == F.col(id_))
