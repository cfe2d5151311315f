"""Mixture-controlled packing: deficit round-robin over one queue of tokens per source.

Each source has a queue of its documents' token ids and a weight. In every round a queue earns its share of one
window and hands over tokens as long as it has earned them; what it has not spent stays as its deficit for the
next window. Windows are filled without gaps, so only the last one of all is padded.

The rounds are cut into segments that run side by side. Segment k of K begins where every source has handed over
its share of k / K, which a formula gives (:func:`_served`); the part of a token that a source is owed there is
the deficit with which the segment starts. A segment's first place among all tokens is the sum of those shares,
so windows run on across segments. Documents are cut where a segment or a window ends.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import lean, table
from eventloom.session import materialize

WINDOW, SEGMENT, MIN_PIECE, END_ID = 4096, 1 << 18, 128, 2
CACHE_BYTES = 80 << 20  # of words that a task remembers
ENTRY = 130  # bytes that a dictionary entry takes beside its ids
GROUP = 4000  # new words encoded at once
# How the tokenizer splits text into words after lower-casing (fixed value, its published pattern, for the characters
# of PLAIN: letters, endings, single digits, marks).
SPLIT = re.compile(r"[^\W\d_²³¹¼½¾]+|'(?:s|t|re|ve|m|ll|d)|[\d²³¹¼½¾]|(?:[^\s\w]|_)+")
#: Characters outside which a text goes to the tokenizer as it is: here lower-casing and normalisation are simple.
PLAIN = re.compile("[^\t\n\r\x20-\x7e\xa0-\u024f]")
WORD_END = "</w>"


@lru_cache(maxsize=1)
def _tokenizer(path: str):
    """The tokenizer, with its defaults; a worker keeps it from task to task, but no words."""
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    vocabulary = model.get_vocab()
    ends = np.zeros(max(vocabulary.values()) + 1, bool)
    ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
    return model, ends


class _Known(dict):
    """What a task has encoded, up to a number of bytes."""

    size = 0

    def learn(self, found: dict[str, bytes]) -> None:
        self.update(found)
        self.size += sum(map(len, found.values())) + ENTRY * len(found)

    def make_room(self) -> None:
        """Forgets everything where it is full."""
        if self.size > CACHE_BYTES:
            self.clear()
            self.size = 0


def encoder(path: str, end_id: int):
    """A function from texts to token ids (little-endian bytes, as wide as :func:`id_type` says), ``end_id`` last.

    The tokenizer encodes word by word and white space parts words, so each distinct run without white space is
    put together once, from words that are encoded once; texts are split and their ids laid out as Arrow columns. New words are encoded side by side in one text, and its ids
    are told apart by the tokens that end a word. Texts with characters beyond Latin letters, texts that hold one of the
    tokenizer's added tokens, and tokenizers that do not end each word so, take the tokenizer's own way."""
    (model, ends), known = _tokenizer(path), _Known()
    kind = id_type(path, end_id)
    last = np.array([end_id], kind).tobytes()
    by_word = bool(ends.any())
    width = np.dtype(kind).itemsize
    added = [t.content for t in model.get_added_tokens_decoder().values()]

    def plain(text: str) -> bool:
        return by_word and not PLAIN.search(text) and not any(t in text for t in added)

    def learn(new: list[str]) -> None:
        for at in range(0, len(new), GROUP):
            group = new[at : at + GROUP]
            ids = np.array(model.encode_batch_fast([" ".join(group)], add_special_tokens=False)[0].ids, np.int64)
            stops = ((np.flatnonzero(ends[ids]) + 1) * width).tolist()
            if len(stops) == len(group):
                data = ids.astype(kind).tobytes()
                parts = [data[a:b] for a, b in zip([0, *stops], stops)]
            else:
                parts = [np.array(x.ids, kind).tobytes() for x in model.encode_batch(group, add_special_tokens=False)]
            known.learn(dict(zip(group, parts)))

    def encode(texts: list[str]) -> list[bytes]:
        own = [i for i, t in enumerate(texts) if plain(t)]
        split = pc.utf8_split_whitespace(pa.array([texts[i].lower() for i in own], pa.string()))
        words = split.values.dictionary_encode()  # each distinct word of the batch becomes a Python string once
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        known.make_room()
        found = list(map(known.get, distinct))
        places = [i for i, x in enumerate(found) if x is None]
        new = {distinct[i] for i in places}
        mixed = {c: SPLIT.findall(c) for c in new if not c.isalpha()}
        learn([c for c in new.difference(mixed).union(*mixed.values()) if c not in known])
        get = known.__getitem__
        known.learn({c: b"".join(map(get, p)) for c, p in mixed.items()})
        for i in places:
            found[i] = get(distinct[i])
        ids = pa.array(found, pa.large_binary()).take(words.indices)
        data = ids.buffers()[2].to_pybytes() if len(ids) else b""
        stops = np.frombuffer(ids.buffers()[1], np.int64)[split.offsets.to_numpy()].tolist() if len(ids) else [0] * (len(own) + 1)
        out = dict(zip(own, (data[a:b] + last for a, b in zip(stops, stops[1:]))))
        others = [i for i in range(len(texts)) if i not in out]
        whole = model.encode_batch([texts[i] for i in others], add_special_tokens=False) if others else []
        out.update((i, np.array(x.ids, kind).tobytes() + last) for i, x in zip(others, whole))
        return [out[i] for i in range(len(texts))]

    return encode


@lru_cache(maxsize=8)
def id_type(path: str, end_id: int) -> str:
    """Two bytes for an id while they hold the whole vocabulary."""
    model, ends = _tokenizer(path)
    most = max([end_id, len(ends), *model.get_added_tokens_decoder()])
    return "<u2" if most < 1 << 16 else "<u4"


def tokenized(docs: DataFrame, path: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", source_col: str | None = "source") -> DataFrame:
    """doc_id, source, tokens, part (the task), place (tokens of the source before it in the task), ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, before, part = encoder(path, end_id), {}, TaskContext.get().partitionId()
        width = np.dtype(id_type(path, end_id)).itemsize
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                ids = encode([t or "" for t in batch.column(1).to_pylist()])
                sources, places = batch.column(2).to_pylist(), []
                for source, x in zip(sources, ids):
                    places.append(before.get(source, 0))
                    before[source] = places[-1] + len(x) // width
                sizes = pa.array([len(x) // width for x in ids], pa.int64())
                columns = [batch.column(0), batch.column(2), sizes, pa.array([part] * len(ids), pa.int32()), pa.array(places, pa.int64()), pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "source", "tokens", "part", "place", "ids"])

    source = F.coalesce(F.col(source_col).cast("string"), F.lit("")) if source_col else F.lit("")
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), source.alias("source"))
    return chosen.mapInArrow(lean(run), "doc_id long, source string, tokens long, part int, place long, ids binary")


def _exact(text: str) -> Column:
    return F.expr(text).cast("long")


def _served(k: str) -> Column:
    """Tokens that a source has handed over before segment ``k`` of ``segments``."""
    return F.least(F.col("queue"), _exact(f"CAST(reach AS DECIMAL(19, 0)) * CAST({k} AS DECIMAL(18, 0)) div segments"))


def _deal(window: int, min_piece: int, kind: str):
    """Runs the rounds of one segment."""
    width = np.dtype(kind).itemsize

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["source", "first"], kind="stable")
        position, k, segments = int(rows["base"].iloc[0]), int(rows["segment"].iloc[0]), int(rows["segments"].iloc[0])
        queues = []
        for _, own in rows.groupby("source", sort=True):
            reach = int(own["reach"].iloc[0])
            queues.append({
                "weight": float(own["weight"].iloc[0]), "deficit": reach * k % segments / segments, "left": int(own["size"].sum()), "at": 0, "taken": 0,
                "docs": list(zip(own["doc_id"], own["start"], own["size"], own["tokens"], own["ids"], own["source"])),
            })
        out: list[tuple] = []
        while queues:
            total = sum(q["weight"] for q in queues)
            for q in queues:
                q["deficit"] += window * q["weight"] / total
                earned = min(int(q["deficit"]), q["left"])
                if earned < min(min_piece, q["left"]):
                    continue  # too little yet: it is carried to the next round
                q["deficit"] -= earned
                q["left"] -= earned
                while earned:
                    doc_id, start, size, tokens, ids, source = q["docs"][q["at"]]
                    take = min(earned, size - q["taken"], window - position % window)
                    out.append((doc_id, start + q["taken"], take, tokens, position // window, position % window, np.frombuffer(ids, kind, take, width * q["taken"]).astype("<u4").tobytes(), source))
                    position, earned, q["taken"] = position + take, earned - take, q["taken"] + take
                    if q["taken"] == size:
                        q["at"], q["taken"] = q["at"] + 1, 0
            queues = [q for q in queues if q["left"]]
        return pd.DataFrame(out, columns=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids", "source"])

    return run


PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary, source string"


def pack(
    docs: DataFrame, path: str, weights: dict[str, int] | None = None, window: int = WINDOW, segment: int = SEGMENT, min_piece: int = MIN_PIECE,
    end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", source_col: str | None = "source",
) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids (uint32 bytes), source.

    ``weights``: the target proportion of each source, as whole numbers; a source without one weighs 1. By default a
    source weighs its own tokens, so all queues end together; with others, the sources left over share the last
    windows. A source hands over at least ``min_piece`` tokens at a time, except where a document or a window ends.
    Sources are mixture components; each task holds one segment, ``segment`` tokens on average, however long its
    documents. A null source is the source "". Null and empty texts have the closing id only. Repeated rows and ids
    are packed one by one. An empty table gives an empty result. Other columns are not read.
    """
    kind = id_type(path, end_id)
    width = np.dtype(kind).itemsize
    tokens = materialize(tokenized(docs, path, end_id, id_col, text_col, source_col))
    counts = materialize(tokens.groupBy("source", "part").agg(F.sum("tokens").alias("tokens")))
    weight = F.sum("tokens") if weights is None else F.coalesce(F.element_at(F.create_map(*[F.lit(x) for p in weights.items() for x in p]), F.col("source")), F.lit(1)).cast("long")
    queues = counts.groupBy("source").agg(F.sum("tokens").alias("queue")) if weights is not None else counts.groupBy("source").agg(F.sum("tokens").alias("queue"), weight.alias("weight"))
    if weights is not None:
        queues = queues.withColumn("weight", weight)
    most = queues.agg(F.max(F.ceil(F.col("queue") / F.col("weight"))).alias("turns"), F.sum("queue"), F.sum("weight")).first()
    turns = int(most[0] or 1)
    segments = max(1, ceil(turns * int(most[2] or 0) / segment))
    queues = materialize(queues.select("source", "queue", "weight", (F.col("weight") * turns).alias("reach"), F.lit(segments).cast("long").alias("segments")))
    order = Window.partitionBy("source").orderBy("part")  # one row per task and source
    begins = materialize(counts.select("source", "part", (F.sum("tokens").over(order) - F.col("tokens")).alias("begin")))
    placed = (
        tokens.join(begins, ["source", "part"]).join(queues, "source")
        .withColumn("from", F.col("begin") + F.col("place")).withColumn("to", F.col("from") + F.col("tokens"))
    )

    def segment_of(token: str) -> Column:
        return _exact(f"(CAST({token} + 1 AS DECIMAL(18, 0)) * CAST(segments AS DECIMAL(18, 0)) + reach - 1) div reach - 1")

    parts = placed.withColumn("segment", F.explode(F.sequence(segment_of("`from`"), segment_of("(`to` - 1)"))))
    parts = parts.withColumn("first", F.greatest("from", _served("segment"))).withColumn("size", F.least("to", _served("segment + 1")) - F.col("first"))
    parts = parts.filter("size > 0").withColumn("start", F.col("first") - F.col("from"))
    bases = queues.withColumn("segment", F.explode(F.sequence(F.lit(0).cast("long"), F.col("segments") - 1)))
    bases = materialize(bases.groupBy("segment").agg(F.sum(_served("segment")).alias("base")))
    parts = parts.select(
        "doc_id", "source", "tokens", "weight", "reach", "segments", "segment", "first", "size", "start",
        F.expr(f"substring(ids, CAST({width} * start + 1 AS INT), CAST({width} * size AS INT))").alias("ids"),
    )
    return parts.join(bases, "segment").groupBy("segment").applyInPandas(_deal(window, min_piece, kind), PIECES)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op7_mixture_packing(spark, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
