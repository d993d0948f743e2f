"""The driver's TPC-H-style tables mapped onto an entity-season panel.

entity = customer, season = order year, team = order priority.  A row is
one (customer, year, priority) with per-order rates from ``lineitem``; a
year with more than one priority also gets an aggregate row ('2TM', ...)
summing the year, placed first.  The staffing table is (priority, year,
supplier) with games = number of lines.

Plan, designed for a skewed customer (one holding a third of all orders):
lineitem is pre-aggregated per order (partial aggregation before the
shuffle), joined to orders on the order key, and aggregated to the
(customer, year, priority) grain -- again partial first -- so a hot
customer reaches the id exchange as at most years x priorities rows.
Aggregate rows come from a window over the (id, season) on that small
grain plus ``explode``, not from a second scan or a union.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes of the orders' and lines' files for each partition of the panel, at most.
PARTITION_BYTES = 16 << 20
STATS = ["FTA", "PTS", "AST", "TRB", "BLK", "STL", "TOV"]
ID, SEASON, TEAM, ORD = "id", "season_start", "Team", "ord"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def panel_partitions(spark: SparkSession, sf_dir: str) -> int:
    """Number of the panel's partitions: by the size of its input, so that what a task sorts doesn't grow with it."""
    jvm, conf, size = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), 0
    for name in ("orders", "lineitem"):
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        size += path.getFileSystem(conf).getContentSummary(path).getLength()
    return max(spark.sparkContext.defaultParallelism, -(-size // PARTITION_BYTES))


def per_order_stats(lineitem: DataFrame) -> DataFrame:
    """One row per order: integer-valued counts and sums over its lines."""
    cnt = lambda cond: F.count_if(cond).cast("double")
    return lineitem.groupBy("l_orderkey").agg(
        cnt(F.col("l_returnflag") == "A").alias("v_FTA"),
        F.sum("l_quantity").alias("v_PTS"),
        F.count(F.lit(1)).cast("double").alias("v_AST"),
        cnt(F.col("l_returnflag") == "R").alias("v_TRB"),
        cnt(F.col("l_linestatus") == "F").alias("v_BLK"),
        cnt(F.col("l_discount") >= F.lit(0.05)).alias("v_STL"),
        F.max("l_linenumber").cast("double").alias("v_TOV"),
    )


def team_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, season, team) rows with order count, min order key and stat sums/counts."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    per_order = per_order_stats(table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_returnflag", "l_quantity", "l_linestatus", "l_discount", "l_linenumber"))
    facts = orders.join(per_order, orders["o_orderkey"] == per_order["l_orderkey"], "left")
    aggs = [F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("k")]
    for s in STATS:
        aggs += [F.sum(f"v_{s}").alias(f"s_{s}"), F.count(f"v_{s}").alias(f"c_{s}")]
    return facts.groupBy(
        F.col("o_custkey").alias(ID), F.year("o_orderdate").alias(SEASON), F.col("o_orderpriority").alias(TEAM)
    ).agg(*aggs)


def season_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel: id, season_start, Team, ord, Player, Pos, Age, G and 7 stats.

    Partitioned by id on return, so the per-id feature windows downstream
    add no exchange; into :func:`panel_partitions` parts, which AQE doesn't
    put together to larger ones.
    """
    t = team_rows(spark, sf_dir).repartition(panel_partitions(spark, sf_dir), ID)
    w = Window.partitionBy(ID, SEASON)
    season = {"__nt": F.count(F.lit(1)).over(w), "__kmin": F.min("k").over(w), "__n": F.sum("n").over(w)}
    for s in STATS:
        season[f"__s_{s}"] = F.sum(f"s_{s}").over(w)
        season[f"__c_{s}"] = F.sum(f"c_{s}").over(w)
    t = t.withColumns(season)

    def row(team, k, ordv, n, pre):
        fields = [team.alias(TEAM), k.alias("k"), ordv.alias(ORD), n.cast("double").alias("G")]
        fields += [F.try_divide(F.col(f"{pre}s_{s}"), F.col(f"{pre}c_{s}")).alias(s) for s in STATS]
        return F.struct(*fields)

    own = row(F.col(TEAM), F.col("k"), F.col("k") * 2 + 1, F.col("n"), "")
    agg = row(F.concat(F.col("__nt").cast("string"), F.lit("TM")), F.col("__kmin"), F.col("__kmin") * 2,
              F.col("__n"), "__")
    rows = F.when((F.col("__nt") > 1) & (F.col("k") == F.col("__kmin")), F.array(agg, own)).otherwise(F.array(own))
    stacked = t.select(ID, SEASON, F.explode(rows).alias("r")).select(ID, SEASON, "r.*")

    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    p = stacked.join(customer, stacked[ID] == customer["c_custkey"], "left")
    k = F.col("k")
    age = (F.lit(20) + F.col(ID) % 15 + F.col(SEASON) - 1995).cast("double")
    return p.select(
        ID, SEASON, TEAM, ORD,
        F.when(k % 5 != 2, F.col("c_name")).alias("Player"),
        F.when(k % 3 != 0, F.col("c_mktsegment")).alias("Pos"),
        F.when(k % 4 != 1, age).alias("Age"),
        "G", *STATS,
    )


def season_label(year) -> F.Column:
    """1995 -> '95_96'."""
    y = F.col(year) if isinstance(year, str) else year
    return F.concat(F.lpad((y % 100).cast("string"), 2, "0"), F.lit("_"),
                    F.lpad(((y + 1) % 100).cast("string"), 2, "0"))


def staffing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw staffing rows: Coach, Tm, G (games), Season label, ord.

    One row per (priority, year, supplier, line status), so a person can
    appear twice in a team-season; the first row (lowest ord) is the one
    that counts.  ord = (min order key, supplier name, line status).
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_linestatus")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    j = (lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
         .join(supplier, lines["l_suppkey"] == supplier["s_suppkey"]))
    g = j.groupBy(F.col("o_orderpriority").alias("Tm"), F.year("o_orderdate").alias("year"),
                  F.col("s_name").alias("Coach"), F.col("l_linestatus").alias("ls")).agg(
        F.count(F.lit(1)).cast("int").alias("G"), F.min("l_orderkey").alias("k"))
    return g.select("Coach", "Tm", "G", season_label("year").alias("Season"),
                    F.struct("k", "Coach", "ls").alias("ord"))
