"""Forests as tables: the nodes of their trees as rows, and rows of data scored by walking them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from shoalmark.operators.joins import sized_join
from shoalmark.session import ship_package, stage

# A node's children are nodes of the same tree; a leaf has feature -1 and its share of each class.
NODE = ("tree int, node int, feature int, threshold double, below int, above int, "
        "absent double, present double")
NODE_COLUMNS = ("tree", "node", "feature", "threshold", "below", "above", "absent", "present")
# Stands for a missing measurement: sorts after every real value, so that trees can part
# missing from present and no training row is lost.
MISSING = 1e30
ROWS_PER_PART = 200_000
WALKED_AT_ONCE = 65_536
PART_BYTES = 256  # a model's name and its number of parts in a broadcast relation


def saved_nodes(spark: SparkSession, path: str) -> DataFrame:
    """The nodes (NODE) of a forest saved by ``sources.models.save_model``."""
    node = F.col("nodeData")
    absent, present = (F.coalesce(F.get(node["impurityStats"], k), F.lit(0.0)) for k in (0, 1))
    return spark.read.parquet(f"{path}/stages/*_RandomForestClassifier_*/data").select(
        F.col("treeID").alias("tree"), node["id"].alias("node"), node["split"]["featureIndex"].alias("feature"),
        F.get(node["split"]["leftCategoriesOrThreshold"], 0).alias("threshold"),
        node["leftChild"].alias("below"), node["rightChild"].alias("above"),
        F.try_divide(absent, absent + present).alias("absent"), F.try_divide(present, absent + present).alias("present"))


class NodeTable:
    """The nodes of one forest in arrays, sorted by tree and node."""

    def __init__(self, nodes: pa.Table | pa.RecordBatch) -> None:
        table = pa.Table.from_batches([nodes]) if isinstance(nodes, pa.RecordBatch) else nodes
        table = table.sort_by([("tree", "ascending"), ("node", "ascending")])
        column = {name: table[name].to_numpy() for name in NODE_COLUMNS}
        self.roots = np.flatnonzero(column["node"] == 0)
        start = np.repeat(self.roots, np.diff(np.append(self.roots, len(table))))
        self.feature, self.threshold = column["feature"], column["threshold"]
        self.below, self.above = start + column["below"], start + column["above"]
        self.absent, self.present = np.nan_to_num(column["absent"]), np.nan_to_num(column["present"])

    def score(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class and probability of presence of each row of feature values, missing ones NaN."""
        values = np.where(np.isnan(values), MISSING, values)
        found = [self._score(values[i:i + WALKED_AT_ONCE]) for i in range(0, len(values), WALKED_AT_ONCE)]
        if not found:
            return np.empty(0, np.int32), np.empty(0)
        return tuple(map(np.concatenate, zip(*found)))

    def _score(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        absent, present = np.zeros(len(values)), np.zeros(len(values))
        for root in self.roots:
            at = np.full(len(values), root)
            walking = np.flatnonzero(self.feature[at] >= 0)
            while len(walking):
                here = at[walking]
                below = values[walking, self.feature[here]] <= self.threshold[here]
                at[walking] = np.where(below, self.below[here], self.above[here])
                walking = walking[self.feature[at[walking]] >= 0]
            absent += self.absent[at]
            present += self.present[at]
        return (present > absent).astype(np.int32), present / (absent + present)


def score_by_nodes(rows: DataFrame, nodes: DataFrame, features: Sequence[str], model: str = "species") -> DataFrame:
    """Add ``prediction`` and ``p`` to rows of many models at once, each by the nodes of its own.

    ``model`` names the column of both tables that tells the models apart; rows of a model that
    has no nodes are left out. ``features`` has the columns in the order of the feature numbers; a
    forest that knows only the first few is given all. A model with many rows is walked in several
    parts, for each of which its nodes are repeated; a forest has under 2**16 nodes a tree.
    """
    ship_package(rows.sparkSession)
    rows = stage(rows, "rows-to-score")
    counts = rows.groupBy(model).agg(F.count(F.lit(1)).alias("n"))
    parts = stage(counts.select(model, "n", F.ceil(F.col("n") / ROWS_PER_PART).cast("int").alias("__pieces")), "score-parts")
    size = parts.count() * PART_BYTES
    place = F.pmod(F.xxhash64(*rows.columns), F.col("__pieces")).cast("int")
    left = sized_join(rows, parts.drop("n"), [model], size, counted=parts.select(model, "n"))
    left = left.withColumn("__part", place).drop("__pieces")
    right = nodes.join(parts.drop("n"), model).withColumn(
        "__part", F.explode(F.sequence(F.lit(0), F.col("__pieces") - 1))).drop("__pieces")
    schema = T.StructType([*rows.schema.fields, T.StructField("prediction", T.IntegerType()),
                           T.StructField("p", T.DoubleType())])
    target, names, own = to_arrow_schema(schema), list(features), rows.columns

    def walk(some: pa.Table, forest: pa.Table) -> pa.Table:
        if not len(some) or not len(forest):
            return target.empty_table()
        values = np.column_stack([some[name].cast(pa.float64()).to_numpy() for name in names])
        prediction, p = NodeTable(forest).score(values)
        return pa.Table.from_arrays([*[some[name] for name in own], pa.array(prediction), pa.array(p)],
                                    schema=target)

    return left.groupBy(model, "__part").cogroup(right.groupBy(model, "__part")).applyInArrow(walk, schema)


def score_points(points: DataFrame, nodes: DataFrame, features: Sequence[str], key: str, model: str = "species") -> DataFrame:
    """(model, key, p) for every forest and every point: surfaces of all models in one job.

    The points are the same for all forests, and their number is set by the lattice and not by the
    data; they are sent to the tasks once. Forests are spread over tasks, one held at a time.
    """
    spark = points.sparkSession
    ship_package(spark)
    table = points.select(key, *[F.col(name).cast("double") for name in features]).toArrow()
    keys = table[key].to_numpy()
    values = np.column_stack([table[name].to_numpy() for name in features])
    sent = spark.sparkContext.broadcast((keys, values))
    target = to_arrow_schema(T.StructType([
        nodes.schema[model], T.StructField(key, T.LongType()), T.StructField("p", T.DoubleType())]))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = sent.value
        for name, forest in by_model(batches, model):
            _, p = NodeTable(forest).score(values)
            for i in range(0, len(keys), WALKED_AT_ONCE):
                some = keys[i:i + WALKED_AT_ONCE]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(some)), pa.array(some), pa.array(p[i:i + WALKED_AT_ONCE])], schema=target)

    ordered = nodes.repartition(model).sortWithinPartitions(model)
    return ordered.mapInArrow(walk, f"{model} string, {key} long, p double")


def by_model(batches: Iterator[pa.RecordBatch], model: str) -> Iterator[tuple[str, pa.Table]]:
    """The nodes of one model after the other, from rows sorted by model."""
    name, held = None, []
    for batch in batches:
        names = batch[model].to_pylist()
        start = 0
        while start < len(names):
            end = start + 1
            while end < len(names) and names[end] == names[start]:
                end += 1
            if held and names[start] != name:
                yield name, pa.Table.from_batches(held)
                held = []
            name = names[start]
            held.append(batch.slice(start, end - start))
            start = end
    if held:
        yield name, pa.Table.from_batches(held)
