"""Feature steps: route, delay classes, label indexing / encoding, vector assembly."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.columns import DELAY_SPLITS, delay_class, route
from tarmac.schemas import CATEGORICAL_FEATURES, VECTOR_SLOTS
from tarmac.operators.keyed import ordinal

LABEL_COL = "ArrDelayBucket"
FEATURES_COL = "Features_vec"


def with_route(df: DataFrame) -> DataFrame:
    return df.withColumn("Route", route("Origin", "Dest"))


def with_delay_class(df: DataFrame, delay: str = "ArrDelay", out: str = LABEL_COL) -> DataFrame:
    """Delay class as a codegen expression (same edges as the bucketizer)."""
    return df.withColumn(out, delay_class(delay))


def delay_bucketizer(delay: str = "ArrDelay", out: str = LABEL_COL) -> Bucketizer:
    """The savable bucketizer artifact with the fixed splits."""
    return Bucketizer(splits=DELAY_SPLITS, inputCol=delay, outputCol=out)


def fit_indexers(df: DataFrame, cols=CATEGORICAL_FEATURES, handle_invalid: str = "keep") -> StringIndexerModel:
    """Fit all label dictionaries in one pass over ``df`` (order: count desc, then label).

    Unseen labels, nulls and labels absent in training map to index ``numLabels``
    under ``keep``.
    """
    idx = StringIndexer(inputCols=list(cols), outputCols=[c + "_index" for c in cols],
                        handleInvalid=handle_invalid, stringOrderType="frequencyDesc")
    return idx.fit(df.select(*cols))


def encode(df: DataFrame, model: StringIndexerModel, drop_source: bool = False) -> DataFrame:
    out = model.transform(df)
    return out.drop(*model.getInputCols()) if drop_source else out


def label_index(df: DataFrame, col: str) -> DataFrame:
    """Label dictionary of one column as a table: (label, count, index).

    Counting is a partial aggregation; positions in (count desc, label) order
    come from a range-partitioned sort with per-partition offsets, so no single
    task ever holds the whole dictionary.
    """
    counts = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("label")).agg(F.count("*").alias("count"))
    out = ordinal(counts, [F.col("count").desc(), F.col("label").asc()], "index")
    return out.withColumn("index", F.col("index").cast("double"))


def assembler(handle_invalid: str = "error") -> VectorAssembler:
    """Nine-slot feature vector; ``error`` for training, ``keep`` (NaN) for serving."""
    return VectorAssembler(inputCols=VECTOR_SLOTS, outputCol=FEATURES_COL, handleInvalid=handle_invalid)


def vector_slots(df: DataFrame, col: str = FEATURES_COL) -> DataFrame:
    """Vector column to one double column per slot (for comparison and export)."""
    arr = vector_to_array(F.col(col))
    return df.select(*[c for c in df.columns if c != col],
                     *[arr[i].alias(f"f_{name}") for i, name in enumerate(VECTOR_SLOTS)])


def training_frame(flights: DataFrame) -> DataFrame:
    """Route plus delay class, rows without a label removed (the forest refuses null labels)."""
    return with_delay_class(with_route(flights)).filter(F.col(LABEL_COL).isNotNull())
