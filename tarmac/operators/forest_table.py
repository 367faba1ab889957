"""Stored forests as tables: every node a row, label dictionaries as rows, scoring as one plan.

A saved forest is a Parquet file of nodes.  ``nodes`` reads those of any number of versions in one scan, and ``packed`` lays the
trees of each version out in flat arrays (children as positions in them), one row a version.  ``score`` joins
blocks of request rows to the model that they ask for and walks the trees with array expressions, so the plan is
the same for one model and for many, and neither models nor dictionaries pass through the driver.

Sums run over the trees in their order, as the fitted model's do, so raw predictions are equal to the last bit.
"""

from __future__ import annotations

import os
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.commits import committed
from tarmac.operators import models
from tarmac.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES, VECTOR_SLOTS
from tarmac.session import work_dir

# Columns of a saved forest and of saved dictionaries that are read.
NODE_FILE = ("treeID int, nodeData struct<id int, impurityStats array<double>, leftChild int, rightChild int, "
             "split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>")
TREE_FILE = "_1 int, _2 string"
LABEL_FILE = "labelsArray array<array<string>>"

NODES = ("model_id string, tree int, node int, slot int, threshold double, categories array<double>, n_categories int, "
         "`left` int, `right` int, votes array<double>, counts array<double>")
PACKED = ("model_id string, depth int, classes int, roots array<int>, slot array<int>, threshold array<double>, bits array<array<bigint>>, "
          "other array<boolean>, `left` array<int>, `right` array<int>, votes array<array<double>>")
DICTIONARIES = "model_id string, column string, label string, index double"
BLOCK_BITS = 12                  # request rows of a block that meets a model: 4,096


def _read(spark: SparkSession, paths: Sequence[str], schema: str, prefix: str) -> DataFrame:
    """The files under ``paths`` with the version that each belongs to as model_id."""
    if not paths:
        return spark.createDataFrame([], f"model_id string, {schema}")
    at = F.regexp_extract(F.col("_metadata.file_path"), ".*/" + re.escape(prefix) + r"([^/]+)\.bin/", 1)
    rows = spark.read.schema(schema).parquet(*paths)
    return rows.select(F.url_decode(F.replace(at, F.lit("+"), F.lit("%2B"))).alias("model_id"), *rows.columns)


def _paths(spark: SparkSession, root: str, versions: Sequence[str], artifact: str, part: str) -> list[str]:
    stored = committed(spark, root)
    return [os.path.join(models.artifact_paths(root, v, stored[v])[artifact], part) for v in versions if v in stored]


def nodes(spark: SparkSession, root: str, versions: Sequence[str]) -> DataFrame:
    """One row for each node of the stored ``versions``; slot is null in leaves, threshold in splits by category.

    votes: a node's class counts over their sum; counts: the class counts themselves.
    """
    raw = _read(spark, _paths(spark, root, versions, "forest", "data"), NODE_FILE, models.MODEL_DIR_PREFIX)
    n, split = F.col("nodeData"), F.col("nodeData.split")
    inner, number = n["leftChild"] >= 0, split["numCategories"] < 0
    counts = n["impurityStats"]
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return raw.select(
        "model_id", F.col("treeID").alias("tree"), n["id"].alias("node"), F.when(inner, split["featureIndex"]).alias("slot"),
        F.when(inner & number, split["leftCategoriesOrThreshold"][0]).alias("threshold"),
        F.when(inner & ~number, split["leftCategoriesOrThreshold"]).alias("categories"),
        F.when(inner & ~number, split["numCategories"]).alias("n_categories"),
        F.when(inner, n["leftChild"]).alias("left"), F.when(inner, n["rightChild"]).alias("right"),
        F.transform(counts, lambda x: F.when(total != 0, x / total).otherwise(0.0)).alias("votes"), counts.alias("counts"))


def depths(spark: SparkSession, root: str, versions: Sequence[str]) -> DataFrame:
    """(model_id, depth): the depth that the trees were allowed."""
    raw = _read(spark, _paths(spark, root, versions, "forest", "treesMetadata"), TREE_FILE, models.MODEL_DIR_PREFIX)
    allowed = F.get_json_object("_2", "$.paramMap.maxDepth").cast("int")
    return raw.groupBy("model_id").agg(F.max(allowed).alias("depth"))


def bitmap(categories: Column, size: Column) -> Column:
    """Categories as bits of longs: category c is bit c % 64 of long c div 64."""
    word = F.transform(F.sequence(F.lit(0), F.floor((size - 1) / 64).cast("int")), lambda w: F.aggregate(
        categories, F.lit(0).cast("long"),
        lambda a, c: F.when(F.floor(c / 64) == w, a.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), (c % 64).cast("int")))).otherwise(a)))
    return F.when(categories.isNotNull(), word)


def packed(tree_nodes: DataFrame, allowed: DataFrame) -> DataFrame:
    """One row a version (PACKED): its nodes in tree and preorder, children as positions among them.

    A group is the nodes of one version, at most trees x 2 ** (depth + 1).
    """
    one = F.struct("tree", "node", F.coalesce("slot", F.lit(-1)).alias("slot"), "threshold",
                   bitmap(F.col("categories"), F.col("n_categories")).alias("bits"),
                   (2 * F.size("categories") > F.col("n_categories")).alias("other"), "left", "right", "votes")
    rows = tree_nodes.groupBy("model_id").agg(F.array_sort(F.collect_list(one), lambda a, b: F.when(
        (a["tree"] < b["tree"]) | ((a["tree"] == b["tree"]) & (a["node"] < b["node"])), -1).otherwise(1)).alias("n"))
    child = lambda c: F.transform("n", lambda x, i: F.coalesce(i - x["node"] + x[c], F.lit(-1)).cast("int")).alias(c)
    field = lambda c: F.transform("n", lambda x: x[c]).alias(c)                                                        # noqa: E731
    roots = F.filter(F.transform("n", lambda x, i: F.when(x["node"] == 0, i)), lambda i: i.isNotNull())
    return rows.join(allowed, "model_id").select(
        "model_id", "depth", F.size(F.col("n")[0]["votes"]).alias("classes"), roots.cast("array<int>").alias("roots"), field("slot"),
        field("threshold"), field("bits"), field("other"), child("left"), child("right"), field("votes"))


def dictionaries(spark: SparkSession, root: str, versions: Sequence[str]) -> DataFrame:
    """Label dictionaries of the stored ``versions`` as rows (DICTIONARIES)."""
    raw = _read(spark, _paths(spark, root, versions, "indexers", "data"), LABEL_FILE, models.INDEXERS_PREFIX)
    names = F.array(*(F.lit(c) for c in CATEGORICAL_FEATURES))
    return raw.select("model_id", F.posexplode("labelsArray").alias("at", "labels")) \
        .select("model_id", names[F.col("at")].alias("column"), F.posexplode("labels").alias("index", "label")) \
        .select("model_id", "column", "label", F.col("index").cast("double").alias("index"))


def stage(spark: SparkSession, root: str, version: str) -> str:
    """Write a stored version's packed trees and dictionaries to a work folder and return it.

    A version that cannot be read fails here, by itself, before it is joined to anything.
    """
    stored = models.current_paths(root, version)                  # tells a version that is not stored
    path = work_dir(spark, "staged-model")
    packed(nodes(spark, root, [version]), depths(spark, root, [version])).write.parquet(os.path.join(path, "trees"))
    dictionaries(spark, root, [version]).write.parquet(os.path.join(path, "labels"))
    if spark.read.schema("model_id string").parquet(os.path.join(path, "trees")).isEmpty():
        raise FileNotFoundError(f"no trees in {stored['forest']}")
    return path


def staged(spark: SparkSession, paths: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(packed forests, dictionaries) of staged versions: two scans, however many there are."""
    read = lambda schema, part: spark.read.schema(schema).parquet(*(os.path.join(p, part) for p in paths))            # noqa: E731
    return read(PACKED, "trees"), read(DICTIONARIES, "labels")


# ---- scoring ----------------------------------------------------------------------------------


def features(asked: DataFrame, labels: DataFrame) -> DataFrame:
    """``asked`` (serving columns and model_id) with the vector ``x`` by each row's own model.

    Unseen and null labels get the number of labels, null numbers NaN, as the serving chain gives them.  Plain joins: a
    dictionary is broadcast where the planner measures it small.
    """
    out = asked
    for c in CATEGORICAL_FEATURES:
        mine = labels.where(F.col("column") == c)
        known = mine.select(F.col("model_id").alias("__m"), F.col("label").alias("__l"), F.col("index").alias(f"__i_{c}"))
        sizes = mine.groupBy(F.col("model_id").alias("__m")).agg(F.count("*").cast("double").alias(f"__n_{c}"))
        out = out.join(known, (F.col("model_id") == F.col("__m")) & (F.col(c) == F.col("__l")), "left").drop("__m", "__l") \
            .join(sizes, F.col("model_id") == F.col("__m"), "left").drop("__m")
    value = {c: F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in NUMERIC_FEATURES}
    value |= {f"{c}_index": F.coalesce(f"__i_{c}", f"__n_{c}", F.lit(0.0)) for c in CATEGORICAL_FEATURES}
    return out.withColumn("x", F.array(*(value[s] for s in VECTOR_SLOTS))).select(*asked.columns, "x")


def votes_of(x: Column) -> Column:
    """Summed votes of a packed model's trees for the vector ``x``."""
    def step(node: Column) -> Column:
        value = F.get(x, F.get("slot", node))
        bits = F.get("bits", node)
        bit = F.call_function("shiftright", F.get(bits, F.floor(value / 64).cast("int")), (value % 64).cast("int")).bitwiseAND(F.lit(1).cast("long"))
        goes_left = F.when(bits.isNull(), value <= F.get("threshold", node)).otherwise(F.coalesce(bit == 1, F.get("other", node)))
        return F.when(F.get("left", node) < 0, node).when(goes_left, F.get("left", node)).otherwise(F.get("right", node))

    leaf = lambda root: F.aggregate(F.sequence(F.lit(1), F.greatest("depth", F.lit(1))), root, lambda n, _: step(n))
    return F.aggregate("roots", F.array_repeat(F.lit(0.0), F.col("classes")),
                       lambda a, r: F.zip_with(a, F.get("votes", leaf(r)), lambda s, v: s + v))


def blocked(rows: DataFrame, number: str, block: str) -> DataFrame:
    """``rows`` dealt by ``block``, the number of the block that a row of that ``number`` is in, some 16 blocks a partition.

    What is joined to them by broadcast and unfolded from them stays where it is, so ``score`` by that block shuffles nothing:
    the rows move once and as they are, not with vectors and once for every model.  ``rows`` are counted, so they should be stored ones.
    """
    n = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() >> BLOCK_BITS + 4))
    return rows.withColumn(block, F.shiftright(number, BLOCK_BITS)).repartition(n, block)


def score(vectors: DataFrame, forests: DataFrame, block: str | None = None) -> DataFrame:
    """``vectors`` (any columns, model_id, x) with rawPrediction, probability and Prediction of the packed ``forests``.

    Rows meet their model in blocks, so a model's arrays are read once a block instead of once a row; a block is at most
    2 ** BLOCK_BITS rows, or the rows of one value of the column ``block``.  Rows whose model is not among ``forests`` are left out.
    """
    keep = [c for c in vectors.columns if c not in ("model_id", "x", block)]
    at = F.col(block) if block else F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS)
    blocks = vectors.withColumn("__block", at) \
        .groupBy("model_id", "__block").agg(F.collect_list(F.struct(F.struct(*keep).alias("row"), "x")).alias("__rows"))
    total = F.aggregate("raw", F.lit(0.0), lambda a, v: a + v)
    return blocks.join(forests, "model_id") \
        .select("model_id", F.explode(F.transform("__rows", lambda r: F.struct(r["row"].alias("row"), votes_of(r["x"]).alias("raw")))).alias("r")) \
        .select("r.row.*", "model_id", F.col("r.raw").alias("raw")) \
        .select(*keep, "model_id", F.col("raw").alias("rawPrediction"),
                F.transform("raw", lambda v: F.when(total != 0, v / total).otherwise(v)).alias("probability"),
                (F.array_position("raw", F.array_max("raw")) - 1).cast("double").alias(models.PREDICTION_COL))


def serve(asked: DataFrame, root: str, versions: Sequence[str], block: str | None = None, keep: Sequence[str] | None = None) -> DataFrame:
    """Requests with their model_id (rows of other versions are left out) scored by the stored ``versions``.

    ``block``: the column that tells a row's block (``blocked``); ``keep``: the columns of ``asked`` that are wanted beside the scores.
    """
    spark = asked.sparkSession
    vectors = features(asked, dictionaries(spark, root, versions))
    if keep is not None:
        vectors = vectors.select(*keep, *([block] if block else []), "model_id", "x")
    return score(vectors, packed(nodes(spark, root, versions), depths(spark, root, versions)), block)
