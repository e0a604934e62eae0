"""Distribution models of all species: fitted side by side, tested and mapped in one job each."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from shoalmark.functions.numbers import DEFAULT_SEED
from shoalmark.operators.evaluation import report_by
from shoalmark.operators.forest import score_by_nodes, score_points
from shoalmark.operators.grid import GRID_STEPS
from shoalmark.operators.model import ROW_KEY, TREES, features_for, fit_forest, fitting_bytes, surface_points
from shoalmark.operators.nearest import build_index
from shoalmark.operators.split import assign_split
from shoalmark.operators.training import COORDINATES, ENVIRONMENT, training_sets
from shoalmark.session import configure, fitting_budget, scratch_path, stage
from shoalmark.sources.models import all_nodes, register_model, registry
from shoalmark.sources.tables import write_by_species

PARALLEL_FITS = 4
FEATURES = (*COORDINATES, *ENVIRONMENT)


def split_all(fused: DataFrame, with_environment: bool = True, seed: int = DEFAULT_SEED) -> DataFrame:
    """Training rows of every species with their role, written by species, so that each fit
    reads its own folder only. Stops if two species share a folder's name."""
    rows = stage(training_sets(fused, with_environment, seed=seed), "training")
    path = scratch_path(fused.sparkSession, "split")
    split = assign_split(rows, "presence", ROW_KEY, by=["species"], seed=seed)
    write_by_species(split, path, names=rows)
    return fused.sparkSession.read.parquet(path)


def model_all(fused: DataFrame, base: str, with_environment: bool = True, trees: int = TREES,
              parallel: int = PARALLEL_FITS, seed: int = DEFAULT_SEED) -> DataFrame:
    """Fit a model of every species that ``base`` has none of yet, and report on all of them.

    The report has one row for each species: n_train, n_test, accuracy, precision, recall and f1
    of presence, and the path of its model. Test rows of all species are scored by one job, from
    the table of nodes. A run that broke off goes on where it stopped, as a model counts once the
    registry has it; a repeated run fits nothing.
    """
    spark = configure(fused.sparkSession)
    split = split_all(fused, with_environment, seed)
    sizes = split.groupBy("species", "species_key").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("role") != "test").alias("n_train"))
    todo = stage(sizes.join(registry(spark, base).select("species_key"), "species_key", "left_anti"), "models-to-fit")

    def fit(one: Row) -> None:
        rows = split.where((F.col("species_key") == one.species_key) & (F.col("role") != "test"))
        model = fit_forest(rows, features_for(one.n, with_environment), trees, seed)
        register_model(model, spark, base, one.species, one.species_key, one.n_train)

    side_by_side(spark, todo.orderBy(F.desc("n"), "species").toLocalIterator(), fit, parallel,
                 lambda one: fitting_bytes(one.n_train, trees), fitting_budget(spark))
    features = FEATURES if with_environment else COORDINATES
    tested = score_by_nodes(split.where("role <> 'train'").drop("species_key"), all_nodes(spark, base), features)
    report = report_by(tested.withColumnRenamed("presence", "label"), ["species"])
    return registry(spark, base).drop("species_key", "n_features").join(report, "species")


def side_by_side(spark: SparkSession, todo: Iterator[Row], run: Callable[[Row], None], parallel: int,
                 size: Callable[[Row], int] = lambda one: 0, budget: int = 0) -> None:
    """``run`` on each of ``todo``, up to ``parallel`` at a time, each in a scheduler pool of its
    own: with fair scheduling the fits share the cluster, otherwise one fills what another leaves
    idle. Together they take at most ``budget`` by their ``size``, so that they do not push each
    other's rows to disk; one beyond it runs alone, as it fills the cluster by itself. Holds as many
    names as run at once. The first failure stops what has not begun.
    """
    free = [f"fit-{number}" for number in range(parallel)]

    def in_pool(one: Row, pool: str) -> None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", pool)
        run(one)

    with ThreadPoolExecutor(parallel) as threads:
        running: dict[Future, tuple[str, int]] = {}
        for one in todo:
            own = size(one)
            while not free or (running and own + sum(taken for _, taken in running.values()) > budget):
                done, _ = wait(running, return_when=FIRST_COMPLETED)
                for finished in done:
                    free.append(running.pop(finished)[0])
                    finished.result()
            pool = free.pop()
            running[threads.submit(inheritable_thread_target(spark)(in_pool), one, pool)] = pool, own
        for finished in running:
            finished.result()


def map_all(spark: SparkSession, base: str, occurrences: DataFrame, ocean: DataFrame,
            steps: int = GRID_STEPS) -> DataFrame:
    """Surfaces of all species: the lattice with its conditions, looked up once, scored against
    the nodes of all models in one job. ``steps`` squared rows for each species."""
    points = surface_points(occurrences, build_index(ocean, by_year=False), steps)
    points = stage(points, "surface-points")
    surfaces = score_points(points, all_nodes(spark, base), FEATURES, "cell_id")
    return surfaces.join(F.broadcast(points), "cell_id").select(
        "species", *points.columns, "p")
