"""Queries of the operators that keep work in proportion as tables grow: hot keys, numbers over all rows,
states of months, layouts, deliveries. Imported by the registry, at its end."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import standins as trips
from checks.registry import CUBE_LABELS, ZONE_MART, query
from checks.sql import CUBE_MEASURES, REVENUE_MONTHLY, exact_avg, exact_sum, over_sources, whole_avg
from waybill.operators import marts
from waybill.operators.deliveries import new_records
from waybill.operators.layout import clustered
from waybill.operators.numbering import with_row_numbers
from waybill.operators.silver import PARTITION_COLUMNS
from waybill.operators.sinks import changed_groups
from waybill.operators.skew import split_join
from waybill.operators.staging import Shelf
from waybill.operators.states import STATE_KEYS, STATE_MEASURES, month_states
from waybill.sources.inline import inline_values

# Returned lines, a third or so of all, share one party.
PARTY = "CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_suppkey END"
PARTIES_SQL = "(SELECT s_suppkey AS party, s_nationkey AS nation FROM supplier UNION ALL SELECT 0, -1)"


def _parties(spark, sf_dir):
    known = trips.table(spark, sf_dir, "supplier").selectExpr("CAST(s_suppkey AS BIGINT) AS party", "CAST(s_nationkey AS INT) AS nation")
    return known.unionAll(spark.sql("SELECT 0L, -1"))


def _lines(spark, sf_dir):
    return trips.table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_returnflag", f"CAST({PARTY} AS BIGINT) AS party", "l_quantity"
    )


@query(
    "hot_key_join",
    f"""SELECT CAST(nation AS INTEGER) AS nation, count(*) AS lines, sum(l_quantity) AS quantity
        FROM (SELECT {PARTY} AS party, l_quantity FROM lineitem) JOIN {PARTIES_SQL} USING (party) GROUP BY 1""",
)
def hot_key_join(spark, sf_dir):
    joined = split_join(_lines(spark, sf_dir), _parties(spark, sf_dir), ["party"])
    return joined.groupBy("nation").agg(F.expr("count(1) AS lines"), F.expr("sum(l_quantity) AS quantity"))


@query(
    "hot_key_anti",
    f"""SELECT l_returnflag, count(*) AS lines FROM lineitem
        WHERE {PARTY} NOT IN (SELECT party FROM {PARTIES_SQL} WHERE nation BETWEEN 0 AND 9) GROUP BY 1""",
)
def hot_key_anti(spark, sf_dir):
    some = _parties(spark, sf_dir).filter("nation BETWEEN 0 AND 9").select("party")
    return split_join(_lines(spark, sf_dir), some, ["party"], "left_anti").groupBy("l_returnflag").agg(F.expr("count(1) AS lines"))


@query(
    "row_numbers",
    """SELECT o_orderkey, row_number() OVER (ORDER BY o_orderstatus, o_custkey DESC, o_orderkey) AS number FROM orders""",
)
def row_numbers(spark, sf_dir):
    shelf = Shelf(spark, "row-numbers")
    order = [F.col("o_orderstatus"), F.col("o_custkey").desc(), F.col("o_orderkey")]
    orders = trips.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    return with_row_numbers(orders, order, "number", lambda df: shelf.put(df, "sorted"), first=1).select("o_orderkey", "number")


def _states(spark, sf_dir):
    """Kept as a table, as in the flow, so that the marts read no trips."""
    columns = ("pickup_date_key", *STATE_KEYS, *dict.fromkeys(m.column for m in STATE_MEASURES))
    return Shelf(spark, "states").put(month_states(trips.fact(spark, sf_dir, *columns)), "states")


@query("revenue_from_states", over_sources(REVENUE_MONTHLY))
def revenue_from_states(spark, sf_dir):
    return marts.agg_revenue_monthly(_states(spark, sf_dir), trips.dimensions(spark, sf_dir), states=True)


@query(
    "hours_from_states",
    over_sources(
        f"""SELECT service_type, year, month, hour, period_of_day, count(*) AS trips,
                   {whole_avg('passenger_count')} AS avg_passenger_count,
                   {exact_avg('total_amount')} AS avg_total_amount
            FROM starred GROUP BY ALL"""
    ),
)
def hours_from_states(spark, sf_dir):
    return marts.agg_trips_by_hour(_states(spark, sf_dir), trips.dimensions(spark, sf_dir), states=True)


@query("zones_from_states", over_sources(ZONE_MART))
def zones_from_states(spark, sf_dir):
    return marts.agg_trips_by_zone(_states(spark, sf_dir), trips.dimensions(spark, sf_dir), states=True)


@query(
    "cube_from_states",
    over_sources(
        f"""SELECT {CUBE_LABELS}, CAST(grouping_id({CUBE_LABELS}) AS BIGINT) AS grouping_id, {CUBE_MEASURES}
            FROM starred GROUP BY CUBE ({CUBE_LABELS})"""
    ),
)
def cube_from_states(spark, sf_dir):
    return marts.cube_trips(_states(spark, sf_dir), trips.dimensions(spark, sf_dir), states=True)


@query(
    "star_join_filtered",
    over_sources(
        f"""SELECT service_type, year, month, count(*) AS trips, {exact_avg('total_amount')} AS avg_total_amount,
                   {exact_sum('total_amount')} AS sum_total_amount
            FROM starred WHERE description LIKE '%Vehicle%' GROUP BY ALL"""
    ),
)
def star_join_filtered(spark, sf_dir):
    hired = marts.Axis("service_type_key", "service_type", {"service_type": "service_type"}, where="description LIKE '%Vehicle%'")
    fact = trips.fact(spark, sf_dir, "service_type_key", "pickup_date_key", "total_amount")
    return marts.star_rollup(fact, trips.dimensions(spark, sf_dir), (hired, marts.MONTH), (marts.TOTAL,))


@query(
    "clustered_fact",
    over_sources(
        """SELECT pickup_zone_key, pickup_date_key, count(*) AS trips FROM fact
           WHERE pickup_zone_key IN (3, 7) GROUP BY ALL"""
    ),
)
def clustered_fact(spark, sf_dir):
    """Two zones of a fact laid out along date and zone."""
    keys = ("pickup_date_key", "pickup_zone_key")
    laid_out = Shelf(spark, "clustered").put(clustered(trips.fact(spark, sf_dir, *keys), keys, 16), "fact")
    return laid_out.filter("pickup_zone_key IN (3, 7)").groupBy(*keys[::-1]).agg(F.expr("count(1) AS trips"))


@query(
    "new_records",
    """SELECT l_partkey, l_suppkey, l_quantity FROM lineitem WHERE l_returnflag = 'R'
       EXCEPT SELECT l_partkey, l_suppkey, l_quantity FROM lineitem WHERE l_returnflag <> 'R'""",
)
def delivered(spark, sf_dir):
    """Returned lines as a delivery, the others as what is stored."""
    lines = trips.table(spark, sf_dir, "lineitem")
    columns = ("l_partkey", "l_suppkey", "l_quantity")
    return new_records(lines.filter("l_returnflag = 'R'").select(*columns), lines.filter("l_returnflag <> 'R'").select(*columns))


@query(
    "changed_months",
    over_sources(
        """SELECT DISTINCT CAST(year(pickup_datetime) AS INTEGER) AS pickup_year,
                  CAST(month(pickup_datetime) AS INTEGER) AS pickup_month
           FROM valid_line WHERE service_type = 'yellow' AND vendor_id = 7 AND fare_amount IS NOT NULL"""
    ),
)
def changed_months(spark, sf_dir):
    """The months that differ once one vendor's fares are raised."""
    before = trips.silver(spark, sf_dir, "yellow", with_zones=False)
    after = before.withColumn("fare_amount", F.expr("fare_amount + IF(vendor_id = 7, 1D, 0D)"))
    changed, gone = changed_groups(before, after, PARTITION_COLUMNS)
    found = [tuple(group[c] for c in PARTITION_COLUMNS) for group in changed + gone]
    return inline_values(spark, PARTITION_COLUMNS, found) if found else before.select(*PARTITION_COLUMNS).limit(0)
