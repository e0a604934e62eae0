"""Random-forest distribution models on Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoalmark.functions.numbers import DEFAULT_SEED
from shoalmark.operators.forest import MISSING
from shoalmark.operators.grid import GRID_STEPS, lattice
from shoalmark.operators.nearest import OceanIndex, attach_nearest
from shoalmark.operators.split import LEAST_ROWS, assign_split
from shoalmark.operators.training import COORDINATES, ENVIRONMENT
from shoalmark.session import stage

TREES = 100  # fixed value
ROW_KEY = ("occ_id", "draw")
# One depth at every size. A tree then has under 2**16 nodes, so the forest on the driver
# does not grow with the rows.
MAX_DEPTH = 15
LEAST_TASKS = 8
# Each task sends its own counts of all open nodes, so tasks of few rows cost more than their rows.
LEAST_ROWS_PER_TASK, MOST_ROWS_PER_TASK, MANY_TASKS = 100_000, 2_000_000, 1_000
BYTES_PER_ROW, BYTES_PER_TREE = 128, 8  # a row's bins; its draws and its node in each tree


def _features_ready(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.withColumns({f: F.coalesce(F.col(f), F.lit(MISSING)) for f in features})


def feature_columns(model: PipelineModel) -> list[str]:
    return list(model.stages[0].getInputCols())


def fitting_bytes(rows: int, trees: int = TREES) -> int:
    """Memory in which the executors hold the rows of a fit between levels; beyond it they use disk."""
    return rows * (BYTES_PER_ROW + BYTES_PER_TREE * trees)


def fit_forest(training: DataFrame, features: Sequence[str], trees: int = TREES,
               seed: int = DEFAULT_SEED, max_depth: int = MAX_DEPTH) -> PipelineModel:
    """Fit on rows (features, ``presence``, row key).

    All settings of the forest are the same at every size of the data.

    The forest depends on how rows lie in partitions, so they are put by key hash into a
    number of partitions that only the row count sets, sorted within each, and kept until
    the forest has read them: for its classes, its splits, and its rows.
    Each row's node is kept between levels, as walking deep trees anew costs most; the
    lineage of that is cut by checkpoints in the shared folder.
    """
    rows = _features_ready(training, features).select(*ROW_KEY, *features, "presence")
    rows = stage(rows, "forest-input")
    n = rows.count()
    tasks = max(LEAST_TASKS, min(n // LEAST_ROWS_PER_TASK, MANY_TASKS), n // MOST_ROWS_PER_TASK)
    laid_out = rows.repartition(tasks, *ROW_KEY).sortWithinPartitions(*ROW_KEY).persist()
    forest = RandomForestClassifier(
        labelCol="presence", featuresCol="features", numTrees=trees, seed=seed,
        impurity="gini", featureSubsetStrategy="sqrt", minInstancesPerNode=1,
        maxDepth=max_depth, maxBins=256, maxMemoryInMB=1024,
        cacheNodeIds=True, checkpointInterval=10,
    )
    assemble = VectorAssembler(inputCols=list(features), outputCol="features")
    try:
        return Pipeline(stages=[assemble, forest]).fit(laid_out)
    finally:
        laid_out.unpersist()


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Add ``prediction`` (0 or 1) and ``p``, the probability of presence."""
    features = feature_columns(model)
    kept = rows.withColumns({f"__{f}": F.col(f) for f in features})
    scored = model.transform(_features_ready(kept, features))
    return scored.select(
        *[F.col(f"__{c}").alias(c) if c in features else F.col(c) for c in rows.columns],
        F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability")[1].alias("p"),
    )


def features_for(n_rows: int, with_environment: bool) -> list[str]:
    """The features of a model; with fewer than four rows only the coordinates."""
    return [*COORDINATES, *(ENVIRONMENT if with_environment and n_rows >= LEAST_ROWS else ())]


def train_and_test(training: DataFrame, with_environment: bool = True, trees: int = TREES,
                   seed: int = DEFAULT_SEED) -> tuple[PipelineModel, DataFrame]:
    """Split, fit, and score the test rows (``label``, ``prediction``, ``p``).

    With fewer than four rows everything is used for both, and only the coordinates are
    features.
    """
    rows = stage(training, "training-rows")
    split = stage(assign_split(rows, "presence", ROW_KEY, seed=seed), "split")
    features = features_for(split.count(), with_environment)
    model = fit_forest(split.where("role in ('train', 'both')"), features, trees, seed)
    tested = score(model, split.where("role in ('test', 'both')"))
    return model, tested.withColumnRenamed("presence", "label")


def surface_points(occurrences: DataFrame, index: OceanIndex, steps: int = GRID_STEPS) -> DataFrame:
    """The lattice over the occurrences with the conditions of the nearest ocean row."""
    points = lattice(occurrences, steps)
    return attach_nearest(points, index).select(
        *points.columns, F.col("hit.temperature_C").alias("temperature"),
        F.col("hit.salinity_PSU").alias("salinity"))


def prediction_surface(model: PipelineModel, occurrences: DataFrame,
                       index: OceanIndex | None = None, steps: int = GRID_STEPS) -> DataFrame:
    """Probability of presence at each point of a lattice over the occurrences.

    A model that needs temperature and salinity gets those of the nearest ocean row.
    """
    if not set(ENVIRONMENT) & set(feature_columns(model)):
        points = lattice(occurrences, steps)
    elif index is None:
        raise ValueError("the model needs temperature and salinity: give an ocean index")
    else:
        points = surface_points(occurrences, index, steps)
    return score(model, points).select(
        "cell_id", "i_lat", "i_lon", "decimalLatitude", "decimalLongitude", "p")
