"""Request / response handling: build, parse, validate, pair with models, respond, store.

The same functions serve a batch DataFrame and a streaming micro-batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions.columns import date_features, default_text, parse_model_ids, route
from tarmac.operators.keyed import enrich_distance, last_wins
from tarmac.schemas import (REQUEST_SCHEMA, REQUIRED_REQUEST_FIELDS, RESPONSE_FIELDS, RESPONSE_SCHEMA,
                            STORED_RESPONSE_SCHEMA)


# ----- requests ------------------------------------------------------------

def build_requests(forms: DataFrame, distances: DataFrame | None, uuid_col: Column | None = None,
                   ts_col: Column | None = None) -> DataFrame:
    """Prediction forms to request records (REQUEST_SCHEMA order).

    Distance by route lookup (null without a dimension, for callers that don't use it), day features from FlightDate, a timestamp and a
    UUID (given columns, or ``current_timestamp()`` / ``uuid()``), DepDelay as
    double, FlightNum and Carrier defaulted to "".
    """
    df = forms.withColumn("Distance", F.lit(None).cast("double")) if distances is None else enrich_distance(forms, distances)
    days = date_features(F.col("FlightDate"))
    cols = {
        "Origin": F.col("Origin"),
        "FlightNum": default_text("FlightNum"),
        "DayOfWeek": days["DayOfWeek"],
        "DayOfYear": days["DayOfYear"],
        "DayOfMonth": days["DayOfMonth"],
        "Dest": F.col("Dest"),
        "DepDelay": F.col("DepDelay").cast("double"),
        "Timestamp": (ts_col if ts_col is not None else F.current_timestamp()).cast("timestamp"),
        "FlightDate": F.try_to_date(F.col("FlightDate").cast("string")),
        "Carrier": default_text("Carrier"),
        "UUID": (uuid_col if uuid_col is not None else F.expr("uuid()")).cast("string"),
        "Distance": F.col("Distance").cast("double"),
        "model_ids": F.col("model_ids"),
    }
    return df.select(*[cols[f].alias(f) for f in REQUEST_SCHEMA.fieldNames()])


def to_json_value(df: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """Rows as one JSON object text per row in column ``value`` (null fields omitted)."""
    fields = list(fields or df.columns)
    return df.select(F.to_json(F.struct(*[F.col(f) for f in fields])).alias("value"))


def parse_requests(raw: DataFrame, value: str = "value") -> DataFrame:
    """Message bytes / text to request columns.

    Bad JSON gives all-null fields and a bad field value nulls only that field;
    nothing raises.
    """
    parsed = raw.select(F.from_json(F.col(value).cast("string"), REQUEST_SCHEMA).alias("d"))
    return parsed.select("d.*")


def with_route(df: DataFrame) -> DataFrame:
    return df.withColumn("Route", route("Origin", "Dest"))


def valid_requests(df: DataFrame) -> DataFrame:
    """Keep requests carrying UUID, Origin, Dest, Carrier, Route and FlightNum."""
    return df.dropna(subset=REQUIRED_REQUEST_FIELDS)


def requested_ids(df: DataFrame) -> DataFrame:
    """Requests exploded to (request columns..., model_id), one row per requested id."""
    return df.filter(F.col("model_ids").isNotNull()) \
        .withColumn("model_id", F.explode(F.array_distinct(parse_model_ids("model_ids"))))


def requested_models(df: DataFrame) -> DataFrame:
    """Distinct model ids requested anywhere in ``df``."""
    return requested_ids(df.select("model_ids")).select("model_id").distinct()


# ----- pairing a batch of requests with models --------------------------------

MODEL_LISTS = 64            # lists that a batch's models are kept in

def pair_rows(requests: DataFrame, models: DataFrame) -> DataFrame:
    """Per-row scope: each request pairs with the available models it asked for.

    Explode, then equi-join to the model table (the planner picks the join by measured size).
    Output grows with the number of requested (request, model) pairs only.
    """
    m = models.select(F.col("model_id").alias("__mid")).distinct()
    return requested_ids(requests).join(m, F.col("model_id") == F.col("__mid")).drop("__mid")


def pair_batch(requests: DataFrame, models: DataFrame, batch: str) -> DataFrame:
    """Batch scope: every valid request in a micro-batch pairs with every available
    model requested by any row of that batch -- invalid rows included, since the
    ids are gathered from the whole batch before rows are filtered.

    The requested (batch, model) set is reduced first (a distinct over the
    exploded ids), so the pairing join is rows x models-requested-in-their-batch.
    That output is what costs, and its inputs are small: by the batch alone it would
    be left to as many tasks as there are batches, or to one.  So a batch's rows are
    dealt over parts, as many as its share of the shuffle partitions (``parts``), and each part meets its own copy of the batch's
    models: copies grow with the tasks that a batch needs, not with all tasks.  Number of partitions and kind of join are given,
    as those chosen by input size leave one task.
    The models come as MODEL_LISTS lists a batch, unfolded after the join.  The lists are the streamed side, so the pairs of one
    list follow each other: a file of pairs names few models at a time, and so stays small.
    """
    n = int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    m = models.select(F.col("model_id").alias("__mid")).distinct()
    valid = valid_requests(requests)
    dealt = parts(valid, batch, n)
    wanted = (requested_ids(requests.select(F.col(batch).alias("__b"), "model_ids"))
              .select("__b", "model_id").distinct()
              .join(m, F.col("model_id") == F.col("__mid")).drop("__mid")
              .groupBy("__b", F.pmod(F.xxhash64("model_id"), F.lit(MODEL_LISTS)).alias("__l"))
              .agg(F.collect_list("model_id").alias("__models"))
              .join(F.broadcast(dealt), "__b")
              .select("__models", F.explode("__places").alias("__q")))
    rows = valid.join(F.broadcast(dealt), F.col(batch) == F.col("__b")) \
        .withColumn("__p", F.element_at("__places", (F.pmod(F.xxhash64("UUID"), F.size("__places")) + 1).cast("int"))) \
        .drop("__b", "__places").repartition(n, "__p")
    met = wanted.hint("merge").join(rows, F.col("__p") == F.col("__q"))
    return met.select(*requests.columns, F.explode("__models").alias("model_id"))


def parts(rows: DataFrame, batch: str, n: int) -> DataFrame:
    """(__b, __places): the parts that a batch's ``rows`` are dealt over when there are ``n`` partitions, one at least and
    otherwise the batch's share of ``n`` rounded down.

    A part is told by a number that no other part has, chosen so that Spark's partitioning by it puts the first ``n`` parts in
    ``n`` different partitions.
    """
    spark = rows.sparkSession
    at = F.pmod(F.hash("id"), F.lit(n))
    tried = spark.range(n * (16 + n.bit_length()))                  # leaves a partition without a number once in 10 million
    numbers = tried.groupBy(at.alias("__t")).agg(F.min("id").alias("__number"))
    sizes = rows.where(F.col(batch).isNotNull()).groupBy(F.col(batch).alias("__b")).agg(F.count("*").alias("__n"))
    order = Window.orderBy("__b")                                   # over batches, not rows
    share = F.col("__n") / F.sum("__n").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    shares = sizes.withColumn("__parts", F.greatest(F.lit(1), F.floor(n * share)).cast("int")) \
        .withColumn("__first", F.coalesce(F.sum("__parts").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    places = shares.select("__b", F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)).alias("__i"), "__first") \
        .withColumn("__t", F.col("__first") + F.col("__i"))
    return places.join(F.broadcast(numbers), "__t", "left") \
        .groupBy("__b").agg(F.collect_list(F.coalesce("__number", -1 - F.col("__t"))).alias("__places"))


# ----- responses ----------------------------------------------------------------

def response_json(scored: DataFrame) -> DataFrame:
    """Scored rows to response messages (15 fields, null fields dropped by to_json)."""
    return to_json_value(valid_requests(scored), RESPONSE_FIELDS)


def parse_responses(raw: DataFrame, value: str = "value") -> DataFrame:
    """Response messages; texts that are not JSON objects or lack a UUID are dropped."""
    d = raw.select(F.from_json(F.col(value).cast("string"), RESPONSE_SCHEMA).alias("d")).select("d.*")
    return d.filter(F.col("UUID").isNotNull())


def response_rows(responses: DataFrame) -> DataFrame:
    """Parsed responses to stored rows with the consumer's casts and defaults."""
    c = F.col
    cols = {
        "uuid": c("UUID"),
        "prediction": F.coalesce(c("Prediction"), F.lit(0.0)).cast("int"),
        "model_id": F.coalesce(c("model_id"), F.lit("")),
        "origin": c("Origin"),
        "dest": c("Dest"),
        "dep_delay": F.coalesce(c("DepDelay"), F.lit(0.0)).cast("double"),
        "carrier": c("Carrier"),
        "flight_date": c("FlightDate"),
        "flight_num": c("FlightNum"),
        "distance": c("Distance"),
        "route": c("Route"),
        "day_of_year": F.coalesce(c("DayOfYear"), F.lit(0.0)).cast("int"),
        "day_of_month": F.coalesce(c("DayOfMonth"), F.lit(0.0)).cast("int"),
        "day_of_week": F.coalesce(c("DayOfWeek"), F.lit(0.0)).cast("int"),
        "timestamp": F.coalesce(c("Timestamp"), F.lit("")),
    }
    return responses.select(*[cols[f].alias(f) for f in STORED_RESPONSE_SCHEMA.fieldNames()])


def upsert(target: DataFrame | None, updates: DataFrame, keys: Sequence[str] = ("uuid",),
           order: Sequence[str] = ("__seq",)) -> DataFrame:
    """Keyed upsert, last write wins: union the target with the updates and keep the
    greatest row per key by ``order``.  With ``keys=('uuid',)`` two models answering
    one request overwrite each other, as in a uuid-keyed store."""
    allrows = updates if target is None else target.unionByName(updates, allowMissingColumns=True)
    return last_wins(allrows, keys, order)
