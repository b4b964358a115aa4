"""Rolling look-back means, the time-range join and time functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.temporal import epoch_millis, make_date, minus_hours
from strata.operators.joins import lookup_join
from strata.operators.windows import lookback_events, rolling_lookback
from strata.plans import views
from strata.plans.registry import query, rounded, sql_mean_half_up
from strata.plans.cat_spatial import _hits
from strata.plans.views import with_views
from strata.sources.tables import table

HOURS = 3


def _rolling_sql(keyed: bool) -> str:
    key_sel = "p.k, " if keyed else ""
    key_on = " AND f.k = p.k" if keyed else ""
    key_grp = ", p.k" if keyed else ""
    return with_views(f"""
SELECT p.id, {key_sel}
  {sql_mean_half_up("sum(CAST(f.dur AS DECIMAL(38, 2)))", "count(f.dur)")} AS mean_dur,
  count(f.dur) AS n_in_window
FROM trips p LEFT JOIN trips f
  ON f.dropoff >= p.pickup - INTERVAL {HOURS} HOUR AND f.dropoff <= p.pickup{key_on}
GROUP BY p.id{key_grp}""", "trips")


@query("rolling_mean_3h", _rolling_sql(False))
def rolling_mean_3h(spark, d):
    """Per trip at pickup t: mean duration of trips dropped off in [t-3h, t]."""
    t = views.trips(spark, d)
    return rounded(rolling_lookback(t, "id", "pickup", "dropoff", "dur", hours=HOURS,
                                    mean_col="mean_dur", decimal_scale=2))


@query("rolling_mean_3h_by_pair", _rolling_sql(True))
def rolling_mean_3h_by_pair(spark, d):
    """Same, within the trip's zone key (window partition = key x time bucket)."""
    t = views.trips(spark, d)
    return rounded(rolling_lookback(t, "id", "pickup", "dropoff", "dur", hours=HOURS, keys=["k"],
                                    mean_col="mean_dur", decimal_scale=2))


@query("time_range_join", with_views(f"""
SELECT p.id, p.k, count(f.id) AS n_facts, min(f.dropoff) AS first_fact, max(f.dropoff) AS last_fact
FROM trips p LEFT JOIN trips f
  ON f.k = p.k AND f.dropoff >= p.pickup - INTERVAL {HOURS} HOUR AND f.dropoff <= p.pickup
GROUP BY p.id, p.k""", "trips"))
def time_range_join_q(spark, d):
    """Per trip: the trips of its zone dropped off in the 3 hours up to its
    pickup, both ends inclusive, as their number and first and last time."""
    t = views.trips(spark, d)
    return lookback_events(t, "id", "pickup", "dropoff", HOURS, keys=["k"])


@query("epoch_millis", with_views(f"""
SELECT id, epoch_us(pickup) // 1000 AS pickup_ms, epoch_us(pickup - INTERVAL {HOURS} HOUR) // 1000 AS start_ms
FROM trips""", "trips"))
def epoch_millis_q(spark, d):
    """Pickup as epoch milliseconds (floored) and the window start 3 h earlier."""
    t = views.trips(spark, d)
    return t.select("id", epoch_millis("pickup").alias("pickup_ms"),
                    epoch_millis(minus_hours("pickup", HOURS)).alias("start_ms"))


@query("make_date", """
SELECT o_orderkey, make_date(year(o_orderdate), month(o_orderdate), day(o_orderdate)) AS date
FROM orders""")
def make_date_q(spark, d):
    """Date assembled from year, month and day columns."""
    o = table(spark, d, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"),
        F.dayofmonth("o_orderdate").alias("dd"))
    return o.select("o_orderkey", make_date("y", "m", "dd").alias("date"))


@query("rolling_mean_3h_by_area_pair", with_views(f"""
SELECT p.id, p.pickup_area, p.dropoff_area,
  {sql_mean_half_up("sum(CAST(f.dur AS DECIMAL(38, 2)))", "count(f.dur)")} AS mean_dur,
  count(f.dur) AS n_in_window
FROM lt p LEFT JOIN lt f
  ON f.dropoff >= p.pickup - INTERVAL {HOURS} HOUR AND f.dropoff <= p.pickup
 AND f.pickup_area = p.pickup_area AND f.dropoff_area = p.dropoff_area
GROUP BY p.id, p.pickup_area, p.dropoff_area""", "trips", "points", "area_edges", ctes=(
    _hits(), _hits("x2", "y2", "dhits"),
    """pn AS (SELECT p.id, coalesce(string_agg(h.name, ' | ' ORDER BY h.name), '') AS names
       FROM points p LEFT JOIN hits h ON p.id = h.id GROUP BY p.id)""",
    """dn AS (SELECT p.id, coalesce(string_agg(h.name, ' | ' ORDER BY h.name), '') AS names
       FROM points p LEFT JOIN dhits h ON p.id = h.id GROUP BY p.id)""",
    """lt AS (SELECT t.id, t.pickup, t.dropoff, t.dur, pn.names AS pickup_area, dn.names AS dropoff_area
       FROM trips t JOIN events e ON e.event_id = t.id
       LEFT JOIN pn ON pn.id = e.user_id LEFT JOIN dn ON dn.id = e.user_id)""")))
def rolling_mean_3h_by_area_pair(spark, d):
    """The stated goal of the rolling mean: per trip, mean duration of the
    trips between the same (pickup area, dropoff area) pair dropped off in
    the 3 hours up to its pickup.  Areas come from the point-in-polygon
    join of the (few) distinct end points, looked up per trip."""
    lt = views.located_trips(spark, d).select("id", "user_id", "pickup", "dropoff", "dur")
    names = views.area_names(spark, d).withColumnRenamed("id", "user_id")
    t = lookup_join(lt, names, "user_id", how="left") \
        .select("id", "pickup_area", "dropoff_area", "pickup", "dropoff", "dur")
    return rounded(rolling_lookback(t, "id", "pickup", "dropoff", "dur", hours=HOURS,
                                    keys=["pickup_area", "dropoff_area"], mean_col="mean_dur",
                                    decimal_scale=2))
