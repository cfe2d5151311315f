"""Flight and booking queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.operators import flights as L
from eventloom.plans.registry import query
from eventloom.session import discard, materialize, recorded
from eventloom.sources import market as M
from eventloom.sources.tables import table
from eventloom.functions.ordering import numbered
from eventloom.sources.warehouse import _line_days


@query("flt5_flight_search", f"""WITH {M.FLIGHTS_SQL} SELECT flight_id, departure_time, price_per_seat FROM flights
  WHERE trim(origin_airport) = 'ABX' AND trim(destination_airport) = 'AAX' AND CAST(departure_time AS DATE) = DATE '2026-01-27'
    AND status = 'SCHEDULED'""")
def _(spark, sf):
    found = L.search(M.flights(spark, sf), "ABX", "AAX", "2026-01-27")
    return found.select("flight_id", "departure_time", "price_per_seat")


@query("flt7_bookings_of_user", f"""WITH {M.BOOKINGS_SQL} SELECT booking_id, flight_id, total_price, created_at FROM bookings WHERE user_id = 'u3'""")
def _(spark, sf):
    return L.bookings_of(M.bookings(spark, sf), "u3").select("booking_id", "flight_id", "total_price", "created_at")


@query("jn4_booking_price", f"""WITH {M.FLIGHTS_SQL}, {M.RESERVATIONS_SQL} SELECT booking_id, flight_id, seat_count,
  CAST(seat_count * price_per_seat AS DECIMAL(12,2)) AS total_price FROM reservations JOIN flights USING (flight_id)""")
def _(spark, sf):
    priced = L.booking_price(M.reservations(spark, sf), M.flights(spark, sf))
    return priced.select("booking_id", "flight_id", "seat_count", "total_price")


@query("jn5_booking_reservation_recon", f"""WITH {M.BOOKINGS_SQL}, {M.RESERVATIONS_SQL},
  j AS (SELECT booking_id, b.status AS b, r.status AS r FROM bookings b FULL JOIN reservations r USING (booking_id))
  SELECT booking_id, CASE WHEN b IS NULL AND r = 'ACTIVE' THEN 'active_reservation_without_booking'
    WHEN r = 'RELEASED' AND b = 'CONFIRMED' THEN 'released_but_confirmed'
    WHEN r IS NULL AND b = 'CONFIRMED' THEN 'confirmed_without_reservation'
    WHEN r = 'ACTIVE' AND b = 'CANCELLED' THEN 'cancelled_with_active_reservation' ELSE 'ok' END AS class FROM j""")
def _(spark, sf):
    return L.reconcile(M.bookings(spark, sf), M.reservations(spark, sf))


@query("bkg4_seat_conservation", f"""WITH {M.FLIGHTS_SQL}, {M.RESERVATIONS_SQL},
  held AS (SELECT flight_id, CAST(sum(seat_count) AS BIGINT) AS held FROM reservations WHERE status = 'ACTIVE' GROUP BY flight_id),
  j AS (SELECT flight_id, CAST(total_seats - available_seats AS BIGINT) AS taken, coalesce(held, 0) AS held FROM flights LEFT JOIN held USING (flight_id))
  SELECT * FROM j WHERE taken <> held""")
def _(spark, sf):
    return L.seat_conservation(M.flights(spark, sf), M.reservations(spark, sf))


ARRIVAL = ("day", "order", "line", "part", "supplier", "amount", "kind", "booking_id")


def seat_requests(spark, sf):
    """The requests in order of arrival."""
    return numbered(seat_rows(spark, sf), [F.col(c) for c in ARRIVAL], "seq").select("seq", "kind", "booking_id", "flight_id", "seat_count")


def seat_rows(spark, sf):
    """Reservations from line items; some repeated, some released, some released twice, some unknown."""
    li, key = _line_days(table(spark, sf, "lineitem")), F.col("l_orderkey")
    booking = F.concat_ws("-", key, "l_linenumber", "l_partkey")

    def rows(df, shift, kind, name=booking):
        return df.select(
            (F.col("day") + shift).alias("day"),
            key.alias("order"),
            F.col("l_linenumber").alias("line"),
            F.col("l_partkey").alias("part"),
            F.col("l_suppkey").alias("supplier"),
            F.col("l_quantity").alias("amount"),
            F.lit(kind).alias("kind"),
            name.alias("booking_id"),
            F.when(key % 77 == 1, "F-none").otherwise(F.concat(F.lit("F"), "l_partkey")).alias("flight_id"),
            (F.col("l_quantity").cast("int") % 5).alias("seat_count"),
        )

    out = rows(li, 0, "RESERVE").unionByName(rows(li.filter(key % 10 == 4), 30, "RESERVE"))
    out = out.unionByName(rows(li.filter(key % 5 == 3), 200, "RELEASE")).unionByName(rows(li.filter(key % 20 == 3), 230, "RELEASE"))
    return out.unionByName(rows(li.filter(key % 50 == 8), 15, "RELEASE", F.concat(F.lit("none-"), booking)))


_SEAT_SQL = f"""WITH RECURSIVE {M.FLIGHTS_SQL},
li AS (SELECT *, date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS day,
  l_orderkey || '-' || l_linenumber || '-' || l_partkey AS b FROM lineitem),
r AS (SELECT *, 'RESERVE' AS kind, day AS d, b AS booking_id FROM li
  UNION ALL SELECT *, 'RESERVE', day + 30, b FROM li WHERE l_orderkey % 10 = 4
  UNION ALL SELECT *, 'RELEASE', day + 200, b FROM li WHERE l_orderkey % 5 = 3
  UNION ALL SELECT *, 'RELEASE', day + 230, b FROM li WHERE l_orderkey % 20 = 3
  UNION ALL SELECT *, 'RELEASE', day + 15, 'none-' || b FROM li WHERE l_orderkey % 50 = 8),
q AS (SELECT row_number() OVER (ORDER BY d, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, kind, booking_id) AS seq, kind, booking_id,
  CASE WHEN l_orderkey % 77 = 1 THEN 'F-none' ELSE 'F' || l_partkey END AS flight_id, CAST(l_quantity AS INTEGER) % 5 AS seat_count,
  l_partkey FROM r),
s AS (SELECT q.*, f.price_per_seat, f.available_seats, CASE WHEN kind = 'RELEASE' THEN NULL WHEN seat_count <= 0 THEN 'INVALID_ARGUMENT'
    WHEN f.flight_id IS NULL THEN 'NOT_FOUND' WHEN f.status <> 'SCHEDULED' THEN 'FAILED_PRECONDITION' END AS bad
  FROM q LEFT JOIN flights f ON f.flight_id = q.flight_id),
v AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY seq) AS rn FROM s WHERE bad IS NULL),
w AS (
  SELECT l_partkey, CAST(0 AS BIGINT) AS rn, CAST(max(available_seats) AS BIGINT) AS free, CAST([] AS VARCHAR[]) AS act, CAST([] AS VARCHAR[]) AS rel,
    CAST(NULL AS BIGINT) AS seq, CAST(NULL AS VARCHAR) AS code FROM v GROUP BY l_partkey
  UNION ALL
  SELECT l_partkey, rn, CASE WHEN code <> 'OK' THEN free WHEN kind = 'RESERVE' THEN free - seat_count ELSE free + seat_count END,
    CASE WHEN code = 'OK' AND kind = 'RESERVE' THEN list_append(act, booking_id) ELSE act END,
    CASE WHEN code = 'OK' AND kind = 'RELEASE' THEN list_append(rel, booking_id) ELSE rel END, seq, code
  FROM (SELECT w.l_partkey, v.rn, w.free, w.act, w.rel, v.seq, v.kind, v.seat_count, v.booking_id,
      CASE WHEN kind = 'RESERVE' THEN CASE WHEN free < seat_count THEN 'RESOURCE_EXHAUSTED'
          WHEN list_contains(act, v.booking_id) THEN 'ALREADY_EXISTS' ELSE 'OK' END
        WHEN NOT list_contains(act, v.booking_id) THEN 'NOT_FOUND' WHEN list_contains(rel, v.booking_id) THEN 'FAILED_PRECONDITION'
        ELSE 'OK' END AS code
    FROM w JOIN v ON v.l_partkey = w.l_partkey AND v.rn = w.rn + 1)),
d AS (SELECT s.seq, s.kind, s.booking_id, s.flight_id, s.seat_count, coalesce(s.bad, w.code) AS code,
  CASE WHEN s.kind = 'RESERVE' AND coalesce(s.bad, w.code) = 'OK' THEN CAST(s.seat_count * s.price_per_seat AS DECIMAL(12,2)) END AS total_price
  FROM s LEFT JOIN w ON w.l_partkey = s.l_partkey AND w.seq = s.seq)
"""

_DECIDED: dict[tuple, L.SeatResult] = {}


def _decided(spark, sf) -> L.SeatResult:
    key = (spark.sparkContext.applicationId, sf)
    if key not in _DECIDED:
        with recorded() as made:
            asked = seat_requests(spark, sf)
        result = L.decide_seats(asked, M.flights(spark, sf), spent=made)
        result.decisions, result.flights = materialize(result.decisions), materialize(result.flights)
        result.reservations = materialize(result.reservations)
        discard(spark, *result.tables)
        _DECIDED[key] = result
    return _DECIDED[key]


@query("bkg1_reserve_seats", f"""{_SEAT_SQL} SELECT seq, booking_id, flight_id, seat_count, code, total_price FROM d WHERE kind = 'RESERVE'""")
def _(spark, sf):
    return _decided(spark, sf).decisions.filter("kind = 'RESERVE'").drop("kind")


@query("bkg1_seats_left", f"""{_SEAT_SQL} SELECT 'F' || l_partkey AS flight_id, arg_max(free, rn) AS available_seats FROM w
  WHERE l_partkey IN (SELECT l_partkey FROM s WHERE flight_id <> 'F-none' AND available_seats IS NOT NULL)
    AND free IS NOT NULL GROUP BY l_partkey""")
def _(spark, sf):
    """Free seats of the flights that had at least one request the rules had to decide."""
    asked = seat_rows(spark, sf).join(M.flights(spark, sf), "flight_id")
    decidable = asked.filter((F.col("kind") == "RELEASE") | ((F.col("status") == "SCHEDULED") & (asked["seat_count"] > 0)))
    return _decided(spark, sf).flights.join(decidable.select("flight_id").distinct(), "flight_id", "left_semi")


@query("bkg2_release_seats", f"""{_SEAT_SQL} SELECT seq, booking_id, code FROM d WHERE kind = 'RELEASE'""")
def _(spark, sf):
    return _decided(spark, sf).decisions.filter("kind = 'RELEASE'").select("seq", "booking_id", "code")


@query("bkg3_create_booking", f"""{_SEAT_SQL} SELECT booking_id, arg_min(flight_id, seq) FILTER (kind = 'RESERVE') AS flight_id,
  arg_min(seat_count, seq) FILTER (kind = 'RESERVE') AS seat_count, arg_min(total_price, seq) FILTER (kind = 'RESERVE') AS total_price,
  CASE WHEN count(*) FILTER (kind = 'RELEASE') > 0 THEN 'CANCELLED' ELSE 'CONFIRMED' END AS status FROM d WHERE code = 'OK' GROUP BY booking_id""")
def _(spark, sf):
    return L.create_and_cancel(_decided(spark, sf).decisions)


@query("bkg3_cancel_booking", f"""{_SEAT_SQL} SELECT seq, booking_id, CASE code WHEN 'OK' THEN 'cancelled' WHEN 'NOT_FOUND' THEN 'not_found' WHEN 'INVALID_ARGUMENT' THEN 'invalid'
  ELSE 'already_cancelled' END AS outcome FROM d WHERE kind = 'RELEASE'""")
def _(spark, sf):
    return L.cancel_outcomes(_decided(spark, sf).decisions)
