"""Ordered fold over keyed state, exact and parallel.

Admission rules are sequential: whether an event is applied depends on the state its predecessors left,
and an event that touches several keys is applied to all of them or to none. The fold runs as repeated
Spark jobs over *touches* (one row per event and key):

1. Every key is folded in arrival order by its own task. It applies an event when its own checks pass now
   and the event's other keys passed in the previous round; in the first round it goes by its own key alone.
2. The keys' findings are combined into one verdict per event.
3. If every key did with each event what the verdict says, the result is final; else the next round starts,
   with the keys of the events still open only. What the others found stands.

Each finding depends only on earlier events, so the only self-consistent assignment is the sequential
result, and each round settles at least the earliest unsettled event: the loop ends, exactly.

A key with more than ``max_group_rows`` touches is cut into segments by arrival quantiles. A segment is
folded by its own task from an assumed state and returns what its verdicts need of that state (``spans.py``):
how far a number may move without changing one, which texts must be the same. One scan over a key's segments
then carries the state from the first to the last; segments whose needs are met keep their verdicts, only the
others are folded again, from the state that the scan has brought. A task streams its rows and holds one key's
state, never a group of rows; the scan holds one summary per segment of a key.

What a round finds is appended. A key folded again leaves its earlier findings behind, which are passed over
when findings are read; only its events get a new verdict. A table that a later one has replaced is deleted.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from math import ceil

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.operators.spans import Tracked, applied, met
from eventloom.session import discard, materialize, recorded

MAX_GROUP_ROWS = 1_000_000
MOST_TABLES = 6  # of findings before they are put together
DENSE = 5  # more than one key in so many is many
OK = ""

TOUCH = "key STRING, seq BIGINT, idx BIGINT, shared BOOLEAN, op STRING, ts BIGINT, qty BIGINT, text STRING"
_RECORD = (
    "rec STRING, key STRING, segment INT, seq BIGINT, applied INT, used_info STRING, "
    "rank BIGINT, code STRING, info STRING, state STRING, summary STRING"
)
_ARROW = pa.schema(
    [
        ("rec", pa.string()),
        ("key", pa.string()),
        ("segment", pa.int32()),
        ("seq", pa.int64()),
        ("applied", pa.int32()),
        ("used_info", pa.string()),
        ("rank", pa.int64()),
        ("code", pa.string()),
        ("info", pa.string()),
        ("state", pa.string()),
        ("summary", pa.string()),
    ]
)
_SEED, _TOLD, _AWAKE = "_seed", "_told", "_awake"
_FIRST = -(2**62)


class Rules:
    """What a fold does. Instances travel to the tasks, so they hold plain values only."""

    def touch(self, base: dict, work: dict, key: str, op: str, ts: int, qty: int, text: str | None):
        """Judge one touch: ``(rank, code, info)``.

        ``base`` is the key's state before the event and must not change; ``work`` collects the entries
        the event would write. ``code`` is :data:`OK` or names the failure; of several failures the one
        with the lowest rank is the event's. ``info`` is passed on with the verdict.
        """
        raise NotImplementedError

    def load(self, state: dict) -> dict:
        """A seeded state in working form."""
        return state

    def expand(self, verdicts: DataFrame) -> DataFrame | None:
        """Touches that follow from the last round's verdicts (an order's lines, a booking's flight)."""
        return None


@dataclass
class Folded:
    verdicts: DataFrame  # seq, code, info: one row per event
    states: DataFrame  # key, state (JSON): every key seen or seeded
    rounds: int
    tables: list[str] = field(default_factory=list)  # folders that verdicts and states are read from; whoever has used both may discard them


def fold(
    touches: DataFrame,
    rules: Rules,
    seeds: DataFrame | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
    doomed: DataFrame | None = None,
) -> Folded:
    """Fold ``touches`` (columns of :data:`TOUCH`) over ``seeds`` (key, state JSON) in ``seq`` order.

    ``seq`` identifies an event and is its arrival position. ``shared`` says that the event may touch more
    than one key. Within an event, touches of one key are judged in ``idx`` order. ``doomed`` (seq) names
    events known to fail whatever the state is, which spares the rounds that would find out.
    """
    with recorded() as made:
        result = _folded(touches, rules, seeds, max_group_rows, doomed)
    result.tables = made
    return result


def _folded(touches, rules, seeds, max_group_rows, doomed):
    spark = touches.sparkSession
    touches = materialize(touches.select(*[f.split()[0] for f in TOUCH.split(", ")]))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    sizes = touches.groupBy("key").count()
    told_of = F.coalesce(F.bool_or("shared"), F.lit(False))
    total, any_shared, keys = touches.agg(F.count(F.lit(1)), told_of, F.approx_count_distinct("key")).first()
    tasks = max(tasks, ceil(total / max_group_rows))
    cuts = _cuts(touches, sizes, total, max_group_rows)
    located = cuts if cuts is None else _small(cuts, total, max_group_rows)
    seed_rows = None if seeds is None else _as_seed(seeds.withColumn("segment", F.lit(0)))

    carry = None
    if cuts is not None and seeds is not None:
        slots = located.select("key", F.explode(F.sequence(F.lit(1), F.size("cuts"))).alias("segment"))
        carry = materialize(_as_seed(seeds.join(slots, "key")))

    found: list[tuple[DataFrame, DataFrame | None]] = []  # what each round found, and the keys it looked at
    verdicts = extra = active = ends = scanned = None
    rounds = 0
    while True:
        old: list[DataFrame | None] = []  # what this round replaces
        rounds += 1
        rows = touches if extra is None else touches.unionByName(extra)
        rows = _segmented(rows, located)
        # Many keys to look at are marked among the rows, which are then dealt out once; few are joined with them before.
        marked = active is not None and active.count() * DENSE > keys
        few = None if marked else active
        told = None  # of a key's shared events: what the others found, where that is anything but that they passed
        if verdicts is not None:
            bad = (F.col("fails") > 1) | ((F.col("fails") == 1) & (F.col("fail_key") != F.col("key")))
            known = verdicts.filter("fails > 0 OR info IS NOT NULL").select("seq", "fails", "fail_key", "info")
            told = _told(rows, few).join(known, "seq").filter(bad | F.col("info").isNotNull())
            told = told.withColumns({"others": F.when(bad, 0).otherwise(1), "used_info": F.col("info")}).drop("fails", "fail_key", "info")
        elif doomed is not None:
            told = _told(rows, None).join(doomed.select("seq").distinct(), "seq")
            told = told.withColumns({"others": F.lit(0), "used_info": F.lit(None).cast("string")})
        rows = rows.withColumns({"others": F.lit(1), "used_info": F.lit(None).cast("string")})
        for more in (told, seed_rows, carry, _awake(active) if marked else None):
            if more is not None:
                rows = rows.unionByName(more.withColumn("tracked", F.lit(False)))  # its rows say so too, and set nothing else
        if few is not None:
            rows = rows.join(few, ["key", "segment"], "left_semi")
        ordered = rows.repartition(tasks, "key", "segment").sortWithinPartitions("key", "segment", "seq", "idx")
        ordered = ordered.select("key", "segment", "seq", "shared", "op", "ts", "qty", "text", "others", "used_info", "tracked")
        fresh = materialize(ordered.mapInArrow(_folder(rules, marked), _RECORD))
        found.append((fresh, active))
        if len(found) > MOST_TABLES:
            old += [table for pair in found for table in pair]
            found = [(materialize(_newest(found)), None)]
        out = _newest(found)

        changed = []
        if any_shared:
            if active is None:
                verdicts = materialize(_verdicts(out))
            else:  # only events of the keys that were folded again
                again = materialize(fresh.filter("rec = 'touch'").select("seq").distinct())
                renewed = _verdicts(out.join(again, "seq", "left_semi"))
                old += [again, verdicts]
                verdicts = materialize(verdicts.join(again, "seq", "left_anti").unionByName(renewed))
            good = (F.col("code") == OK).cast("int")
            differs = (F.col("least") != good) | (F.col("most") != good) | ~F.col("used_info").eqNullSafe(F.col("info"))
            open_ = verdicts.filter(differs).select("seq")
            if not open_.isEmpty():
                before, extra = extra, rules.expand(verdicts)
                extra = None if extra is None else materialize(extra)
                old.append(before)
                reach = [t.select("key", "seq") for t in (touches, before, extra) if t is not None]
                reach = reduce(DataFrame.unionByName, reach).join(open_, "seq", "left_semi")
                changed.append(_segmented(reach, located).select("key", "segment"))
        if cuts is not None:
            old += [scanned, carry]
            scanned = materialize(_scanned(out, located, seeds, rules))
            carry = _as_seed(scanned.filter("segment >= 0")).withColumn("tracked", F.lit(False))
            if seed_rows is not None:  # the scan has brought the seeds of the keys it covers
                seed_rows = _as_seed(seeds.join(located, "key", "left_anti").withColumn("segment", F.lit(0)))
            ends = scanned.filter("segment < 0").select("key", "state")
            unmet = scanned.filter("NOT met").select("key", "segment")
            if not unmet.isEmpty():
                changed.append(unmet)
        if changed:
            active = materialize(reduce(DataFrame.unionByName, changed).distinct())
        discard(spark, *old)
        if not changed:
            break
    discard(spark, touches, extra)
    alone = out.filter("rec = 'event'").select("seq", "code", "info")
    together = alone if verdicts is None else alone.unionByName(verdicts.select("seq", "code", "info"))
    last = out.filter("rec = 'state'").select("key", "state")
    if ends is not None:
        last = last.join(located, "key", "left_anti").unionByName(ends)
    return Folded(together, last, rounds)


def _newest(found):
    """The findings of all rounds but for those of keys that a later round has looked at."""
    rows = later = None
    for table, active in reversed(found):
        part = table if later is None else table.join(later, ["key", "segment"], "left_anti")
        rows = part if rows is None else rows.unionByName(part)
        if active is None:
            break
        later = active if later is None else later.unionByName(active)
    return rows


def _verdicts(out):
    """One verdict per event on several keys, with what its keys did and which of them failed."""
    failed = F.col("code") != OK
    return (
        out.filter("rec = 'touch'")
        .groupBy("seq")
        .agg(
            F.coalesce(F.min(F.when(failed, F.struct("rank", "code")))["code"], F.lit(OK)).alias("code"),
            F.max("info").alias("info"),
            F.count_if(failed).alias("fails"),
            F.min(F.when(failed, F.col("key"))).alias("fail_key"),
            F.min("applied").alias("least"),
            F.max("applied").alias("most"),
            F.max("used_info").alias("used_info"),
        )
    )


def _cuts(touches, sizes, total, max_group_rows):
    """Arrival positions that cut each oversized key, or None.

    Keys are taken by size class (a power of two times the limit), so a key gets about as many positions
    as it needs: all lists together hold at most 4 * total / max_group_rows positions.
    """
    scale = F.floor(F.log2(F.col("count") / max_group_rows)).cast("int")
    large = sizes.filter(F.col("count") > max_group_rows).withColumn("scale", scale)
    classes = [r[0] for r in large.select("scale").distinct().collect()]
    if not classes:
        return None
    found = None
    for k in classes:
        parts = 2 ** (k + 2)
        points = [i / parts for i in range(1, parts)]
        keys = _small(large.filter(F.col("scale") == k).select("key"), total, max_group_rows)
        at = touches.join(keys, "key").groupBy("key").agg(F.percentile_approx("seq", points, 10 * parts).alias("cuts"))
        found = at if found is None else found.unionByName(at)
    return materialize(found.withColumn("cuts", F.array_sort(F.array_distinct("cuts"))))


def _small(df, total, max_group_rows):
    """Broadcast a table of oversized keys while its bound allows; beyond that the join shuffles."""
    return F.broadcast(df) if 4 * total / max_group_rows <= 1_000_000 else df


def _segmented(rows, cuts):
    if cuts is None:
        return rows.withColumns({"segment": F.lit(0), "tracked": F.lit(False)})
    passed = F.size(F.filter(F.coalesce("cuts", F.array().cast("array<bigint>")), lambda c: c < F.col("seq")))
    return rows.join(cuts, "key", "left").withColumns({"segment": passed, "tracked": F.col("cuts").isNotNull()}).drop("cuts")


def _told(rows, active):
    """A row for each of the keys' shared events that sorts before its touches. Only these short rows are joined with the
    verdicts; touches, which are wide, are dealt out once."""
    rows = rows.filter("shared").select("key", "segment", "seq")
    if active is not None:
        rows = rows.join(active, ["key", "segment"], "left_semi")
    return _sign(rows, _TOLD, F.col("seq"))


def _awake(active):
    """A row for each key to look at, before all others of the key."""
    rows = _sign(active.filter("key IS NOT NULL"), _AWAKE, F.lit(_FIRST - 1))
    return rows.withColumns({"others": F.lit(1), "used_info": F.lit(None).cast("string")})


def _sign(rows, op, seq):
    return rows.select(
        "key",
        "segment",
        seq.cast("bigint").alias("seq"),
        F.lit(_FIRST).cast("bigint").alias("idx"),
        F.lit(True).alias("shared"),
        F.lit(op).alias("op"),
        F.lit(0).cast("bigint").alias("ts"),
        F.lit(0).cast("bigint").alias("qty"),
        F.lit(None).cast("string").alias("text"),
    )


def _as_seed(states):
    """Rows that set a segment's starting state; they sort before every event."""
    return states.select(
        "key",
        F.lit(_FIRST).cast("bigint").alias("seq"),
        F.lit(0).cast("bigint").alias("idx"),
        F.lit(False).alias("shared"),
        F.lit(_SEED).alias("op"),
        F.lit(0).cast("bigint").alias("ts"),
        F.lit(0).cast("bigint").alias("qty"),
        F.col("state").alias("text"),
        F.lit(1).alias("others"),
        F.lit(None).cast("string").alias("used_info"),
        F.col("segment"),
    )


_SCAN = "key STRING, segment INT, state STRING, met BOOLEAN"


def _scanned(out, cuts, seeds, rules):
    """For each segment of each cut key the state it starts from, as far as is known, and whether its verdicts stand
    on it; and, as segment -1, the state the key ends with. One task takes the summaries of a key, one per segment."""

    def scan(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("segment", kind="stable")
        given = next((x for x in rows["seed"] if x is not None), None)
        state, result = rules.load(json.loads(given)) if given is not None else {}, []
        for segment, summary in zip(rows["segment"], rows["summary"]):
            told = None if summary is None else json.loads(summary)
            result.append((rows["key"].iloc[0], segment, json.dumps(state, sort_keys=True), told is None or met(told["need"], state)))
            state = state if told is None else applied(told["end"], state)
        result.append((rows["key"].iloc[0], -1, json.dumps(state, sort_keys=True), True))
        return pd.DataFrame(result, columns=["key", "segment", "state", "met"])

    slots = cuts.select("key", F.explode(F.sequence(F.lit(0), F.size("cuts"))).alias("segment"))
    rows = slots.join(out.filter("rec = 'state'").select("key", "segment", "summary"), ["key", "segment"], "left")
    if seeds is None:
        rows = rows.withColumn("seed", F.lit(None).cast("string"))
    else:
        rows = rows.join(seeds.select("key", F.lit(0).alias("segment"), F.col("state").alias("seed")), ["key", "segment"], "left")
    return rows.groupBy("key").applyInPandas(scan, _SCAN)


def _folder(rules: Rules, marked: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = None  # (key, segment)
        awake = True  # whether it is one to look at
        base: dict | Tracked = {}
        follow = False
        work: dict = {}
        event = None  # (seq, shared, others, used_info)
        told = None  # (seq, others, used_info) of the event that follows
        found: list = []
        out: list = []

        def close_event():
            nonlocal found, work
            seq, shared, others, used_info = event
            rank, code, info = min((f for f in found if f[1] != OK), default=found[0], key=lambda f: f[0])
            info = next((f[2] for f in found if f[2] is not None), None) if code == OK else None
            done = code == OK and (others == 1 or not shared)
            if done:
                base.update(work)
            if follow:
                if info is not None:
                    base.need.fix_read()
                base.need.read.clear()
            out.append(("touch" if shared else "event", *current, seq, int(done), used_info, rank, code, info, None, None))
            found, work = [], {}

        def close_key():
            state = json.dumps(base.state() if follow else base, sort_keys=True)
            summary = json.dumps(base.summary()) if follow else None
            out.append(("state", *current, None, None, None, None, None, None, state, summary))

        def flush():
            nonlocal out
            columns = list(zip(*out)) if out else [()] * len(_ARROW)
            out = []
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW
            )

        for batch in batches:
            lists = [c.to_pylist() for c in batch.columns]
            for key, segment, seq, shared, op, ts, qty, text, others, used_info, tracked in zip(*lists):
                if event is not None and (current != (key, segment) or event[0] != seq):
                    close_event()
                    event = None
                if current != (key, segment):
                    if current is not None and awake:
                        close_key()
                    current, base, follow, told, awake = (key, segment), {}, False, None, not marked
                if op == _AWAKE:
                    awake = True
                if op == _AWAKE or not awake:
                    continue
                if op == _SEED:
                    # The carried state of a segment already contains the seed.
                    base = rules.load(json.loads(text))
                    continue
                if op == _TOLD:
                    told = (seq, others, used_info)
                    continue
                if tracked and not follow:
                    base, follow = Tracked(base), True
                if event is None:
                    event = (seq, shared, *(told[1:] if told is not None and told[0] == seq else (1, None)))
                found.append(rules.touch(base, work, key, op, ts, qty, text))
            if len(out) >= 10_000:
                yield flush()
        if event is not None:
            close_event()
        if current is not None and awake:
            close_key()
        if out:
            yield flush()

    return run
