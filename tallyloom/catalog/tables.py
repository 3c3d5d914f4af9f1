"""Recodes, validity, group statistics, frequency tables and histograms."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.catalog.registry import query, table
from tallyloom.functions.dates import short_date
from tallyloom.operators import ordered, recode, stats, validity
from tallyloom.operators.recode import drop_maximum
from tallyloom.sources.lines import spread


# -- recode ---------------------------------------------------------------------------

@query("""SELECT c_custkey AS customer, CASE WHEN c_mktsegment = 'BUILDING' THEN 'Building' ELSE
 coalesce(c_mktsegment, 'Unknown') END AS segment, c_acctbal AS balance FROM (SELECT c_custkey, c_acctbal,
 CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer)""")
def rename_recode(spark, folder):
    df = table(spark, folder, "customer").select(
        "c_custkey", "c_acctbal", F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")).alias("c_mktsegment"))
    df = recode.rename(df, {"c_custkey": "customer", "c_mktsegment": "segment", "c_acctbal": "balance"})
    df = df.withColumn("segment", recode.recode_value("segment", "BUILDING", "Building"))
    return recode.fill_null(df, {"segment": "Unknown"})


@query("SELECT c_mktsegment, c_acctbal, c_custkey, c_nationkey FROM customer")
def positional_select(spark, folder):
    return recode.pick_positions(table(spark, folder, "customer"), [5, 4, 1, 2, 3, -2])


@query("""SELECT c_custkey::VARCHAR AS c_custkey, CASE WHEN c_nationkey % 5 = 0 THEN NULL ELSE c_nationkey::VARCHAR END AS nation,
 CASE WHEN c_nationkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS segment FROM customer""")
def na_sentinel(spark, folder):
    text = table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("c_custkey"),
        F.when(F.col("c_nationkey") % 5 == 0, " -999").otherwise(F.col("c_nationkey").cast("string")).alias("nation"),
        F.when(F.col("c_nationkey") % 7 == 0, "NA").otherwise(F.col("c_mktsegment")).alias("segment"))
    return recode.null_sentinels(text)


# Order years run over a century: the year of the order is stretched so that all two-digit years occur.
_YEAR_SQL = "((year(o_orderdate) * 7 + o_orderkey) % 100)"


def _short_dates(spark, folder):
    orders = table(spark, folder, "orders")
    yy = F.pmod(F.year("o_orderdate") * 7 + F.col("o_orderkey"), F.lit(100))
    text = F.concat_ws("/", F.month("o_orderdate").cast("string"), F.lit("15"), F.lpad(yy.cast("string"), 2, "0"))
    return orders.select("o_orderkey", short_date(text).alias("day"))


_DAY_SQL = f"""make_date(CASE WHEN {_YEAR_SQL} >= 69 THEN 1900 + {_YEAR_SQL} ELSE 2000 + {_YEAR_SQL} END,
 month(o_orderdate), 15)"""


@query(f"SELECT o_orderkey, strftime({_DAY_SQL}, '%Y-%m-%d') AS day FROM orders")
def date_pivot(spark, folder):
    return _short_dates(spark, folder).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query(f"""SELECT o_orderkey, strftime({_DAY_SQL}, '%Y-%m-%d') AS day FROM orders WHERE {_DAY_SQL} < DATE '2020-12-31'""")
def date_cutoff(spark, folder):
    kept = recode.before(_short_dates(spark, folder), "day", "2020-12-31")
    return kept.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


# -- trip records ---------------------------------------------------------------------

def trip_lines(spark, folder):
    """17-field lines made of line items, some with dirty fields or a field too many."""
    li = spread(table(spark, folder, "lineitem"))
    whole = lambda c: F.floor(c).cast("bigint").cast("string")
    fare = whole(F.col("l_extendedprice") / 400)
    fields = [
        F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string"), F.col("l_returnflag"), F.lit("x"),
        F.when(F.col("l_suppkey") % 17 == 0, "nan").otherwise(whole(F.col("l_quantity") * 100)),
        F.when(F.col("l_suppkey") % 13 == 0, "abc").otherwise((F.col("l_linenumber") * 8).cast("string")),
        F.lit("a"), F.lit("b"), F.lit("c"), F.lit("d"), F.lit("e"),
        fare,
        F.when(F.col("l_suppkey") % 11 == 0, "").otherwise(whole(F.round(F.col("l_tax") * 100))),
        F.lit("f"), F.lit("g"),
        F.when(F.col("l_suppkey") % 7 == 0, "NaN").otherwise(whole(F.round(F.col("l_discount") * 100))),
        F.when(F.col("l_suppkey") % 19 == 0, F.concat(fare, F.lit(",more"))).otherwise(fare),
    ]
    return li.select("l_orderkey", "l_linenumber", F.concat_ws(",", *fields).alias("value"))


TRIPS_SQL = """WITH t AS (SELECT l_orderkey, l_linenumber,
 CASE WHEN l_suppkey % 17 = 0 THEN NULL ELSE floor(l_quantity * 100) END AS seconds,
 CASE WHEN l_suppkey % 13 = 0 THEN NULL ELSE (l_linenumber * 8)::DOUBLE END AS miles,
 floor(l_extendedprice / 400) AS fare,
 CASE WHEN l_suppkey % 11 = 0 THEN NULL ELSE floor(round(l_tax * 100)) END AS extra,
 CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE floor(round(l_discount * 100)) END AS paid, l_suppkey FROM lineitem),
 valid AS (SELECT * FROM t WHERE seconds BETWEEN 120 AND 3600 AND miles BETWEEN 1 AND 50 AND fare BETWEEN 3 AND 200
   AND extra IS NOT NULL AND paid >= 3 AND l_suppkey % 19 <> 0)"""


@query(TRIPS_SQL + " SELECT l_orderkey, l_linenumber, count(*) AS n FROM valid GROUP BY 1, 2")
def valid_rows(spark, folder):
    fields = validity.split_fields(trip_lines(spark, folder), carry=["l_orderkey", "l_linenumber"])
    kept = validity.valid_trips(fields)
    return kept.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n"))


@query(TRIPS_SQL + """ SELECT l_orderkey, l_linenumber, 1.0::DOUBLE AS x0, round(seconds / 60.0::DOUBLE, 9) AS x1,
 miles AS x2, fare AS x3, extra AS x4, fare AS y FROM valid""")
def regression_features(spark, folder):
    keys = ["l_orderkey", "l_linenumber"]
    fields = validity.split_fields(trip_lines(spark, folder), carry=keys)
    out = validity.trip_features(validity.valid_trips(fields), carry=keys)
    return out.withColumn("x1", F.round("x1", 9))


# -- group statistics ----------------------------------------------------------------------

def _gappy_customers(spark, folder):
    """Balances with a gap in one segment, so the null policies differ."""
    hole = (F.col("c_mktsegment") == "BUILDING") & (F.col("c_nationkey") == 3)
    return table(spark, folder, "customer").withColumn("c_acctbal", F.when(~hole, F.col("c_acctbal")))


_GAPPY_SQL = """(SELECT c_mktsegment, c_nationkey, CASE WHEN NOT (c_mktsegment = 'BUILDING' AND c_nationkey = 3)
 THEN c_acctbal END AS c_acctbal FROM customer)"""
_MEANS = {"balance": "c_acctbal", "nation": "c_nationkey"}


@query(f"""SELECT c_mktsegment, round(avg(c_acctbal), 6) AS balance, round(avg(c_nationkey), 6) AS nation
 FROM {_GAPPY_SQL} GROUP BY c_mktsegment""")
def group_means(spark, folder):
    out = stats.group_means(_gappy_customers(spark, folder), "c_mktsegment", _MEANS, na="skip")
    return out.withColumns({c: F.round(c, 6) for c in _MEANS})


@query(f"""SELECT c_mktsegment, round(CASE WHEN count(*) = count(c_acctbal) THEN avg(c_acctbal) END, 6) AS balance,
 round(avg(c_nationkey), 6) AS nation FROM {_GAPPY_SQL} GROUP BY c_mktsegment""")
def group_means_strict(spark, folder):
    out = stats.group_means(_gappy_customers(spark, folder), "c_mktsegment", _MEANS, na="propagate")
    return out.withColumns({c: F.round(c, 6) for c in _MEANS})


@query("SELECT round(corr(l_quantity, l_extendedprice), 6) AS r FROM lineitem")
def correlation(spark, folder):
    out = stats.correlation(table(spark, folder, "lineitem"), "l_quantity", "l_extendedprice")
    return out.withColumn("r", F.round("r", 6))


@query(f"""SELECT round(corr(c_nationkey, c_acctbal), 6) AS skipped,
 CASE WHEN count(*) = count(c_acctbal) THEN round(corr(c_nationkey, c_acctbal), 6) END AS strict FROM {_GAPPY_SQL}""")
def correlation_with_gaps(spark, folder):
    df = _gappy_customers(spark, folder)
    skipped = stats.correlation(df, "c_nationkey", "c_acctbal", na="skip", out="skipped")
    strict = stats.correlation(df, "c_nationkey", "c_acctbal", out="strict").scalar()
    return skipped.select(F.round("skipped", 6).alias("skipped"), F.round(strict, 6).alias("strict"))


@query("SELECT p_size, count(*) AS n FROM part WHERE p_size IS NOT NULL GROUP BY p_size")
def freq_table(spark, folder):
    return stats.frequencies(table(spark, folder, "part"), "p_size").orderBy("p_size")


@query("""SELECT l_quantity, count(*) AS n, round(count(*) / (SELECT count(*) FROM lineitem)::DOUBLE, 9) AS share
 FROM lineitem WHERE l_quantity IS NOT NULL GROUP BY l_quantity""")
def share_table(spark, folder):
    return stats.shares(table(spark, folder, "lineitem"), "l_quantity").withColumn("share", F.round("share", 9))


@query("""WITH k AS (SELECT l_quantity FROM lineitem WHERE l_quantity < (SELECT max(l_quantity) FROM lineitem))
 SELECT l_quantity, count(*) AS n, round(count(*) / (SELECT count(*) FROM k)::DOUBLE, 9) AS share FROM k GROUP BY l_quantity""")
def drop_max_share(spark, folder):
    kept = drop_maximum(table(spark, folder, "lineitem"), "l_quantity")
    return stats.shares(kept, "l_quantity").withColumn("share", F.round("share", 9))


@query("SELECT max(l_quantity) AS l_quantity, max(l_extendedprice) AS l_extendedprice FROM lineitem")
def column_maximum(spark, folder):
    return stats.column_max(table(spark, folder, "lineitem"), ["l_quantity", "l_extendedprice"])


@query("SELECT round(avg(l_extendedprice), 4) AS mean FROM lineitem")
def population_mean(spark, folder):
    return stats.mean_of(table(spark, folder, "lineitem"), "l_extendedprice").withColumn("mean", F.round("mean", 4))


# -- histograms ----------------------------------------------------------------------------

def _density_sql(bins: int, by: str | None, align: str) -> str:
    width = f"(hi - lo) / {bins - 1 if align == 'centred' else bins}.0::DOUBLE"
    origin = "lo - w / 2" if align == "centred" else "lo"
    keys = f"{by}, " if by else ""
    total = f"sum(count(*)) OVER (PARTITION BY {by})" if by else "sum(count(*)) OVER ()"
    return f"""WITH b AS (SELECT *, {width} AS w FROM (SELECT min(value) AS lo, max(value) AS hi FROM events)),
 o AS (SELECT *, {origin} AS org FROM b),
 p AS (SELECT {keys} least(greatest(ceil((value - org) / w) - 1, 0), {bins - 1})::INT AS bin FROM events, o WHERE value IS NOT NULL),
 c AS (SELECT {keys} bin, count(*) AS n, {total}::BIGINT AS total FROM p GROUP BY {keys} bin)
 SELECT {keys} bin, round(org + bin * w, 6) AS "left", round(org + bin * w + w, 6) AS "right", n,
  round(n / (total * w), 9) AS density FROM c, o"""


def _rounded(df):
    return df.withColumns({"left": F.round("left", 6), "right": F.round("right", 6), "density": F.round("density", 9)})


@query(_density_sql(20, None, "centred"))
def density_hist(spark, folder):
    return _rounded(stats.density(table(spark, folder, "events"), "value", 20))


@query(_density_sql(10, None, "edges"))
def density_hist_edges(spark, folder):
    return _rounded(stats.density(table(spark, folder, "events"), "value", 10, align="edges"))


@query(_density_sql(30, "event_type", "centred"))
def density_hist_by(spark, folder):
    return _rounded(stats.density(table(spark, folder, "events"), "value", 30, by="event_type"))


@query("""WITH s AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, ceil(log2(count(*)::DOUBLE) + 1) AS k FROM lineitem),
 c AS (SELECT lo, (hi - lo) / k AS cell FROM s), b AS (SELECT *, pow(10.0::DOUBLE, floor(log10(cell))) AS base FROM c),
 u AS (SELECT lo, CASE WHEN 2 * base - cell < 1.5 * (cell - base) THEN CASE WHEN 5 * base - cell < 2.75 * (cell - 2 * base)
   THEN CASE WHEN 10 * base - cell < 1.5 * (cell - 5 * base) THEN 10 * base ELSE 5 * base END ELSE 2 * base END ELSE base END AS step FROM b),
 p AS (SELECT greatest(ceil(l_extendedprice / step - 1e-7) - 1, floor(lo / step + 1e-7)) AS bin, step FROM lineitem, u)
 SELECT round(bin * step, 6) AS "left", round((bin + 1) * step, 6) AS "right", count(*) AS n FROM p GROUP BY bin, step""")
def round_histogram(spark, folder):
    out = stats.round_histogram(table(spark, folder, "lineitem"), "l_extendedprice")
    return out.withColumns({"left": F.round("left", 6), "right": F.round("right", 6)})


# -- order ---------------------------------------------------------------------------------

def _holes(spark, folder):
    events = table(spark, folder, "events")
    return events.select(
        "event_id",
        F.when(F.col("user_id") % 3 == 0, F.col("event_type")).alias("event_type"),
        F.when(F.col("user_id") % 4 == 1, F.col("user_id")).alias("user_id"))


@query("""WITH h AS (SELECT event_id, CASE WHEN user_id % 3 = 0 THEN event_type END AS event_type,
 CASE WHEN user_id % 4 = 1 THEN user_id END AS user_id FROM events)
 SELECT event_id, last_value(event_type IGNORE NULLS) OVER (ORDER BY event_id) AS event_type,
 last_value(user_id IGNORE NULLS) OVER (ORDER BY event_id) AS user_id FROM h""")
def ffill(spark, folder):
    return ordered.forward_fill(_holes(spark, folder), ["event_id"], ["event_type", "user_id"])


@query("""SELECT event_id, user_id, sum(event_id) OVER (PARTITION BY user_id ORDER BY event_id)::BIGINT AS running,
 sum(event_id) OVER (ORDER BY event_id)::BIGINT AS whole FROM events""")
def running_totals(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id")
    per_user = ordered.running_total(events, ["event_id"], "event_id", "running", group=["user_id"])
    return ordered.running_total(per_user, ["event_id"], "event_id", "whole")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_orders(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return ordered.top_rows(orders, [F.desc("o_totalprice"), "o_orderkey"], 10)
