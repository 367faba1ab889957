"""Flight history: the flight-shaped view over the order tables, JSON files, and the landed table.

Flight view (fixed mapping):
  one flight per line item; Origin = nation of the supplier, Dest = nation of the
  customer, Carrier = return flag, CRSDepTime / FlightDate = order date,
  CRSArrTime = ship date, ArrDelay = days from order to ship, DepDelay = quantity - 25,
  Distance = extended price / 40, FlightNum = order key.  Lines of the largest quantity
  (50) have no ArrDelay, as cancelled flights have none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.schemas import FLIGHT_SCHEMA
from tarmac.sources.tables import dim, table

# Fixed values of the flight-shaped view.
DEP_DELAY_OFFSET = 25.0
DISTANCE_DIVISOR = 40.0
CANCELLED_QUANTITY = 50.0
LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def supplier_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = dim(spark, sf_dir, "nation")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return s.join(n, s.s_nationkey == n.n_nationkey).select("s_suppkey", F.col("n_name").alias("Origin"))


def customer_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = dim(spark, sf_dir, "nation")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return c.join(n, c.c_nationkey == n.n_nationkey).select("c_custkey", F.col("n_name").alias("Dest"))


def flight_view(spark: SparkSession, sf_dir: str, with_keys: bool = False) -> DataFrame:
    """Flight records in FLIGHT_SCHEMA order.

    ``with_keys`` keeps the four line-item key columns, which together identify a
    row and give the load order used by last-wins loads.

    Plan: nation is broadcast into supplier and customer (map side).  Orders
    meet customers first, so the custkey shuffle moves order rows, not line
    rows; line items then join that on orderkey and suppliers on suppkey, which
    is two shuffles of line-item width when no side fits a broadcast.  The
    planner broadcasts any side under ``autoBroadcastJoinThreshold`` (AQE also
    does so at runtime from measured sizes) and AQE splits skewed keys.
    """
    li = table(spark, sf_dir, "lineitem").select(
        *LINE_KEYS, "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    od = o.join(customer_nations(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey")) \
        .select("o_orderkey", "o_orderdate", "Dest")
    rows = (li.join(od, F.col("l_orderkey") == F.col("o_orderkey"))
              .join(supplier_nations(spark, sf_dir), F.col("l_suppkey") == F.col("s_suppkey")))
    odate = F.to_date("o_orderdate")
    cols = [
        F.when(F.col("l_quantity") != CANCELLED_QUANTITY, F.datediff(F.to_date("l_shipdate"), odate).cast("double"))
         .alias("ArrDelay"),
        F.col("o_orderdate").cast("timestamp").alias("CRSDepTime"),
        F.col("l_shipdate").cast("timestamp").alias("CRSArrTime"),
        F.col("l_returnflag").alias("Carrier"),
        F.dayofmonth(odate).cast("int").alias("DayOfMonth"),
        F.weekday(odate).cast("int").alias("DayOfWeek"),
        F.dayofyear(odate).cast("int").alias("DayOfYear"),
        (F.col("l_quantity") - F.lit(DEP_DELAY_OFFSET)).alias("DepDelay"),
        "Dest",
        "Origin",
        (F.col("l_extendedprice") / F.lit(DISTANCE_DIVISOR)).alias("Distance"),
        F.col("l_orderkey").cast("string").alias("FlightNum"),
        odate.alias("FlightDate"),
    ]
    return rows.select(*cols, *(LINE_KEYS if with_keys else []))


def read_flights_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines (plain or compressed) with the declared flight schema; no inference pass."""
    return spark.read.schema(FLIGHT_SCHEMA).json(path)


def write_flights_json(df: DataFrame, path: str, compression: str | None = None) -> None:
    w = df.select(*FLIGHT_SCHEMA.fieldNames()).write.mode("overwrite")
    if compression:
        w = w.option("compression", compression)
    w.json(path)
