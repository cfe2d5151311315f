"""Flight search, seat admission and release, booking states and their reconciliation."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.operators.fold import MAX_GROUP_ROWS, OK, Rules, fold
from eventloom.session import discard, materialize, recorded

SCHEDULED = "SCHEDULED"


def search(flights: DataFrame, origin: str, destination: str, date) -> DataFrame:
    """Scheduled flights of a UTC day between two airports, earliest first. Codes are compared without padding."""
    return flights.filter(
        (F.trim("origin_airport") == origin)
        & (F.trim("destination_airport") == destination)
        & (F.to_date("departure_time") == F.lit(date).cast("date"))
        & (F.col("status") == SCHEDULED)
    ).orderBy("departure_time", "flight_id")


def bookings_of(bookings: DataFrame, user: str | None = None) -> DataFrame:
    rows = bookings if user is None else bookings.filter(F.col("user_id") == user)
    return rows.orderBy(F.desc("created_at"), "booking_id")


def booking_price(reservations: DataFrame, flights: DataFrame) -> DataFrame:
    total = (F.col("seat_count") * F.col("price_per_seat")).cast("decimal(12,2)")
    return reservations.join(flights.select("flight_id", "price_per_seat"), "flight_id").withColumn("total_price", total)


def reconcile(bookings: DataFrame, reservations: DataFrame) -> DataFrame:
    """One class per booking id, from the states on both sides."""
    b = bookings.select("booking_id", F.col("status").alias("booking"))
    r = reservations.select("booking_id", F.col("status").alias("reservation"))
    kind = (
        F.when(F.col("booking").isNull() & (F.col("reservation") == "ACTIVE"), "active_reservation_without_booking")
        .when((F.col("reservation") == "RELEASED") & (F.col("booking") == "CONFIRMED"), "released_but_confirmed")
        .when(F.col("reservation").isNull() & (F.col("booking") == "CONFIRMED"), "confirmed_without_reservation")
        .when((F.col("reservation") == "ACTIVE") & (F.col("booking") == "CANCELLED"), "cancelled_with_active_reservation")
        .otherwise("ok")
    )
    return b.join(r, "booking_id", "full_outer").select("booking_id", kind.alias("class"))


def seat_conservation(flights: DataFrame, reservations: DataFrame) -> DataFrame:
    """Flights whose taken seats differ from the seats of their active reservations."""
    held = reservations.filter("status = 'ACTIVE'").groupBy("flight_id").agg(F.sum("seat_count").alias("held"))
    joined = flights.join(held, "flight_id", "left").select(
        "flight_id",
        (F.col("total_seats") - F.col("available_seats")).cast("bigint").alias("taken"),
        F.coalesce("held", F.lit(0).cast("bigint")).alias("held"),
    )
    return joined.filter("taken <> held")


class SeatRules(Rules):
    """State per key: free seats of a flight with the bookings that live there, or status, flight and seats of the
    reservation of a booking that was asked for on several flights."""

    def __init__(self, releases: DataFrame):
        self._releases = releases

    def __getstate__(self):
        return {}

    def load(self, state):
        for booking, entry in (state.pop("held", None) or {}).items():
            state[f"b:{booking}"] = entry
        return state

    def touch(self, base, work, key, op, ts, qty, text):
        if op == "BOOK":
            free = base.get("free", 0)
            if free < qty:
                return 10, "RESOURCE_EXHAUSTED", None
            if f"b:{text}" in base:
                return 20, "ALREADY_EXISTS", None
            work.update({"free": free - qty, f"b:{text}": {"status": "ACTIVE", "seats": qty}})
            return 20, OK, None
        if op == "UNBOOK":
            entry = base.get(f"b:{text}")
            if entry is None:
                return 0, "NOT_FOUND", None
            if entry["status"] != "ACTIVE":
                return 0, "FAILED_PRECONDITION", None
            work.update({"free": base.get("free", 0) + entry["seats"], f"b:{text}": {**entry, "status": "RELEASED"}})
            return 0, OK, None
        if op == "TAKE":
            free = base.get("free", 0)
            if free < qty:
                return 10, "RESOURCE_EXHAUSTED", None
            work["free"] = free - qty
            return 10, OK, None
        if op == "GIVE":
            work["free"] = base.get("free", 0) + qty
            return 10, OK, None
        if op == "OPEN":
            if "status" in base:
                return 20, "ALREADY_EXISTS", None
            work.update(status="ACTIVE", flight=text, seats=qty)
            return 20, OK, None
        if "status" not in base:
            return 0, "NOT_FOUND", None
        if base["status"] != "ACTIVE":
            return 0, "FAILED_PRECONDITION", None
        work["status"] = "RELEASED"
        return 0, OK, json.dumps({"flight": base["flight"], "seats": base["seats"]}, sort_keys=True)

    def expand(self, verdicts):
        parsed = F.from_json("info", "flight STRING, seats BIGINT").alias("i")
        found = verdicts.filter("info IS NOT NULL").select("seq", parsed)
        back = self._releases.join(found, "seq")
        return _touch(back, "F:", F.col("i.flight"), "GIVE", F.col("i.seats"))


def _touch(df, prefix, key, op, qty=None, text=None, shared=None):
    return df.select(
        F.concat(F.lit(prefix), key).alias("key"),
        "seq",
        F.lit(0).cast("bigint").alias("idx"),
        (F.lit(True) if shared is None else shared).alias("shared"),
        F.lit(op).alias("op"),
        F.lit(0).cast("bigint").alias("ts"),
        (F.lit(0) if qty is None else qty).cast("bigint").alias("qty"),
        (F.lit(None).cast("string") if text is None else text).alias("text"),
    )


@dataclass
class SeatResult:
    decisions: DataFrame  # requests with code ("OK" or an error name) and total price of reservations made
    flights: DataFrame  # flight_id, available_seats, of the flights that were seeded
    reservations: DataFrame  # booking_id, flight_id, seat_count, status, for booking ids used more than once
    rounds: int
    tables: list[str] = field(default_factory=list)  # folders that these three are read from; whoever has used them may discard them


def decide_seats(
    requests: DataFrame,
    flights: DataFrame,
    reservations: DataFrame | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
    spent: Iterable[str] = (),
) -> SeatResult:
    """Decide RESERVE and RELEASE requests (seq, kind, booking_id, flight_id, seat_count) in ``seq`` order.

    A rejected request takes no seats, so seats are admitted by an ordered fold per flight. Only booking ids
    that can meet themselves again (repeated, stored, or released) get a state of their own. ``spent`` names folders of
    tables that ``requests`` alone is read from: they go when the requests have been read.
    """
    with recorded() as made:
        result = _decide_seats(requests, flights, reservations, max_group_rows, spent)
    result.tables = made
    return result


def _decide_seats(requests, flights, reservations, max_group_rows, spent):
    requests = materialize(requests)
    discard(requests.sparkSession, *spent)
    known = flights.select(F.col("flight_id").alias("_f"), F.col("status").alias("_status"), "price_per_seat", "available_seats")
    blank = lambda c: F.coalesce(c, F.lit("")) == ""
    reserve = F.col("kind") == "RESERVE"
    static = (
        F.when(blank("booking_id"), "INVALID_ARGUMENT")
        .when(reserve & (blank("flight_id") | (F.coalesce("seat_count", F.lit(0)) <= 0)), "INVALID_ARGUMENT")
        .when(reserve & F.col("_f").isNull(), "NOT_FOUND")
        .when(reserve & (F.col("_status") != SCHEDULED), "FAILED_PRECONDITION")
    )
    judged = requests.join(known.drop("available_seats"), F.col("flight_id") == F.col("_f"), "left").withColumn("static", static)
    judged = checked = materialize(judged)
    valid = judged.filter("static IS NULL")
    places = _places(valid, requests, flights, reservations, max_group_rows)
    judged = judged.join(places, "booking_id", "left")
    unknown = (F.col("kind") == "RELEASE") & F.col("nowhere")
    judged = materialize(judged.withColumns({
        "static": F.coalesce("static", F.when(unknown, "NOT_FOUND")), "again": F.col("again").isNotNull() & F.col("again"),
    }))
    if reservations is None:  # else the seeds' places are looked up once more
        discard(requests.sparkSession, checked)

    valid = judged.filter("static IS NULL")
    takes, gives = valid.filter("kind = 'RESERVE'"), valid.filter("kind = 'RELEASE'")
    here, apart = F.col("host").isNotNull(), F.col("again") & F.col("host").isNull()
    touches = reduce(
        DataFrame.unionByName,
        [
            _touch(takes.filter(~here), "F:", F.col("flight_id"), "TAKE", F.col("seat_count"), shared=F.col("again")),
            _touch(takes.filter(here), "F:", F.col("host"), "BOOK", F.col("seat_count"), F.col("booking_id"), F.lit(False)),
            _touch(gives.filter(here), "F:", F.col("host"), "UNBOOK", text=F.col("booking_id"), shared=F.lit(False)),
            _touch(takes.filter(apart), "B:", F.col("booking_id"), "OPEN", F.col("seat_count"), F.col("flight_id")),
            _touch(gives.filter(~here), "B:", F.col("booking_id"), "CLOSE"),
        ],
    )
    seats = flights.join(requests.select("flight_id").distinct(), "flight_id", "left_semi")
    if reservations is not None:
        stored = reservations.join(requests.select("booking_id").distinct(), "booking_id", "left_semi")
        seats = seats.union(flights.join(stored.select("flight_id").distinct(), "flight_id", "left_semi")).distinct()
    # A flight's seed lists those of its stored reservations that are asked about; only flights of bounded size host any.
    seeds = seats.select(F.concat(F.lit("F:"), "flight_id").alias("key"), F.col("available_seats").alias("free"))
    if reservations is None:
        seeds = seeds.select("key", F.to_json(F.struct("free")).alias("state"))
    else:
        placed = stored.join(places.select("booking_id", "host"), "booking_id")
        entry = F.struct("booking_id", F.struct("status", F.col("seat_count").alias("seats")))
        held = placed.filter("host IS NOT NULL").groupBy(F.concat(F.lit("F:"), "host").alias("key")).agg(F.map_from_entries(F.collect_list(entry)).alias("held"))
        seeds = seeds.join(held, "key", "left").select("key", F.to_json(F.struct("free", "held")).alias("state"))
        state = F.to_json(F.struct("status", F.col("flight_id").alias("flight"), F.col("seat_count").alias("seats")))
        seeds = seeds.unionByName(placed.filter("host IS NULL").select(F.concat(F.lit("B:"), "booking_id").alias("key"), state.alias("state")))
    result = fold(touches, SeatRules(gives.filter(~here).select("seq")), seeds, max_group_rows)

    decided = judged.join(result.verdicts.select("seq", F.col("code").alias("found")), "seq", "left")
    code = F.coalesce("static", F.when(F.col("found") == OK, "OK").otherwise(F.col("found")))
    decisions = decided.withColumn("code", code).select(
        *requests.columns,
        "code",
        F.when((F.col("code") == "OK") & reserve, (F.col("seat_count") * F.col("price_per_seat")).cast("decimal(12,2)")).alias("total_price"),
    )
    free = result.states.filter("key LIKE 'F:%'").select(
        F.expr("substring(key, 3)").alias("flight_id"), F.get_json_object("state", "$.free").cast("int").alias("available_seats")
    )
    parsed = F.from_json("state", "status STRING, flight STRING, seats INT").alias("s")
    held = result.states.filter("key LIKE 'B:%'").select(F.expr("substring(key, 3)").alias("booking_id"), parsed)
    held = held.filter("s.status IS NOT NULL").select("booking_id", F.col("s.flight").alias("flight_id"), F.col("s.seats").alias("seat_count"), "s.status")
    entries = F.explode(F.from_json("state", "MAP<STRING, STRING>")).alias("name", "text")
    inside = result.states.filter("key LIKE 'F:%'").select(F.expr("substring(key, 3)").alias("flight_id"), entries).filter("name LIKE 'b:%'")
    inside = inside.select(F.expr("substring(name, 3)").alias("booking_id"), "flight_id", F.from_json("text", "status STRING, seats INT").alias("s"))
    held = held.unionByName(inside.select("booking_id", "flight_id", F.col("s.seats").alias("seat_count"), "s.status"))
    return SeatResult(decisions, free, held, result.rounds)


def _places(valid, requests, flights, reservations, max_group_rows):
    """booking_id, again, host, nowhere: for ids that can meet themselves again (repeated, stored or released).

    An id that is asked for on one flight only lives in that flight's state (``host``), so its requests look at nothing
    else; flights that are cut into segments host none. An id that is neither asked for nor stored is ``nowhere``."""
    named = valid.filter("kind = 'RESERVE'").select("booking_id", "flight_id")
    if reservations is not None:
        stored = reservations.join(requests.select("booking_id").distinct(), "booking_id", "left_semi")
        named = named.unionByName(stored.select("booking_id", "flight_id"))
    ids = named.groupBy("booking_id").agg(F.min("flight_id").alias("host"), F.max("flight_id").alias("other"))
    asked = requests.groupBy("booking_id").count()
    if reservations is not None:
        asked = asked.join(stored.select("booking_id", F.lit(True).alias("kept")).distinct(), "booking_id", "left")
    else:
        asked = asked.withColumn("kept", F.lit(None).cast("boolean"))
    rows = asked.join(ids, "booking_id", "left").withColumn("again", (F.col("count") > 1) | F.coalesce("kept", F.lit(False)))
    rows = rows.withColumn("host", F.when(F.col("again") & (F.col("host") == F.col("other")), F.col("host")))
    # A request is one touch of its flight, or of its booking's host.
    sizes = named.groupBy("flight_id").count().unionByName(
        valid.filter("kind = 'RELEASE'").select("booking_id").join(rows.select("booking_id", F.col("host").alias("flight_id")), "booking_id").groupBy("flight_id").count()
    )
    large = sizes.groupBy("flight_id").agg(F.sum("count").alias("n")).filter(F.col("n") > max_group_rows)
    fit = flights.select(F.col("flight_id").alias("host")).join(large.select(F.col("flight_id").alias("host")), "host", "left_anti").withColumn("fits", F.lit(True))
    rows = rows.join(fit, "host", "left")
    return rows.select("booking_id", "again", F.when(F.col("fits"), F.col("host")).alias("host"), F.col("other").isNull().alias("nowhere"))


def create_and_cancel(decisions: DataFrame) -> DataFrame:
    """Booking rows after the decided requests: confirmed by a reservation, cancelled by its release."""
    done = decisions.filter("code = 'OK'")
    made = F.struct("flight_id", "seat_count", "total_price")
    first = F.when(F.col("kind") == "RESERVE", F.col("seq"))
    return (
        done.groupBy("booking_id")
        .agg(
            F.min_by(made, first).alias("b"),
            F.count_if(F.col("kind") == "RELEASE").alias("released"),
        )
        .select("booking_id", "b.*", F.when(F.col("released") > 0, "CANCELLED").otherwise("CONFIRMED").alias("status"))
    )


def cancel_outcomes(decisions: DataFrame) -> DataFrame:
    """Release results in booking terms."""
    words = (("OK", "cancelled"), ("NOT_FOUND", "not_found"), ("INVALID_ARGUMENT", "invalid"))
    named = F.create_map(*[F.lit(x) for pair in words for x in pair])
    word = F.coalesce(named[F.col("code")], F.lit("already_cancelled"))
    return decisions.filter("kind = 'RELEASE'").select("seq", "booking_id", word.alias("outcome"))
