"""Forests as tables of nodes, and models of all species."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from conftest import DATA, rows
from shoalmark.operators import forest, model
from shoalmark.plans import all_species
from shoalmark.plans.fixtures import view
from shoalmark.plans.queries import node_scores
from shoalmark.session import scratch_path, stage
from shoalmark.sources import tables
from shoalmark.sources.models import all_nodes, load_model, registry, save_model


def grown(spark, n, seed, trees=7):
    df = spark.range(n).select(
        F.col("id").alias("occ_id"), F.lit(0).alias("draw"), (F.rand(seed) * 9).alias("decimalLatitude"),
        F.when(F.rand(seed + 1) > 0.1, F.rand(seed + 2)).alias("decimalLongitude"))
    df = stage(df.withColumn("presence", F.expr("cast(decimalLatitude + 5 * coalesce(decimalLongitude, 1) > 6 as int)")), "rows")
    return df, model.fit_forest(df, ["decimalLatitude", "decimalLongitude"], trees=trees)


def walked(nodes, values):
    """p of one row, by walking the rows of the node table one by one."""
    votes = [0.0, 0.0]
    for tree in sorted({tree for tree, _ in nodes}):
        node = nodes[tree, 0]
        while node.feature >= 0:
            node = nodes[tree, node.below if values[node.feature] <= node.threshold else node.above]
        votes[0] += node.absent
        votes[1] += node.present
    return votes[1] / sum(votes)


def test_walking_the_nodes_gives_the_model_s_probabilities(spark):
    df, fitted = grown(spark, 800, 1)
    path = save_model(fitted, spark, scratch_path(spark, "models"), "a")
    table = forest.saved_nodes(spark, path)
    nodes = {(r.tree, r.node): r for r in table.collect()}
    scored = model.score(fitted, df).withColumnsRenamed({"p": "model_p", "prediction": "model_class"})
    for r in scored.collect():
        values = [forest.MISSING if v is None else v for v in (r.decimalLatitude, r.decimalLongitude)]
        assert abs(walked(nodes, values) - r.model_p) <= 1e-12
    again = forest.score_by_nodes(scored.withColumn("species", F.lit("a")), table.withColumn("species", F.lit("a")),
                                  ["decimalLatitude", "decimalLongitude"])
    found = again.collect()
    assert len(found) == 800
    assert all(abs(r.p - r.model_p) <= 1e-12 and r.prediction == r.model_class for r in found)
    assert 0.9 < sum(r.prediction == r.presence for r in found) / 800


def test_every_test_row_of_a_registered_forest(spark):
    found = node_scores(spark, DATA).collect()
    assert found and all(abs(r.p - r.model_p) <= 1e-12 and r.prediction == r.model_prediction for r in found)


def test_many_models_and_parts(spark, monkeypatch, no_broadcast):
    monkeypatch.setattr(forest, "ROWS_PER_PART", 50)
    monkeypatch.setattr(forest, "WALKED_AT_ONCE", 16)
    nodes, data, expected = None, None, []
    for name, n in (("a", 300), ("b", 40), ("c", 5)):
        df, fitted = grown(spark, n, ord(name), trees=3)
        named = forest.saved_nodes(spark, save_model(fitted, spark, scratch_path(spark, "m"), name)).withColumn("species", F.lit(name))
        df = df.withColumn("species", F.lit(name))
        nodes = named if nodes is None else nodes.unionByName(named)
        data = df if data is None else data.unionByName(df)
        expected += [(name, r.occ_id, r.p) for r in model.score(fitted, df).collect()]
    extra = data.where("species = 'c'").withColumn("species", F.lit("no model"))
    features = ["decimalLatitude", "decimalLongitude"]
    scored = forest.score_by_nodes(data.unionByName(extra), nodes, features)
    assert rows(scored.select("species", "occ_id", "p")) == sorted(expected, key=repr)
    points = data.where("species = 'a'").select(F.col("occ_id").alias("cell_id"), *features)
    surfaces = forest.score_points(points, nodes, features, "cell_id")
    assert rows(surfaces.groupBy("species").count()) == [("a", 300), ("b", 300), ("c", 300)]
    mine = rows(surfaces.where("species = 'a'").select("species", "cell_id", "p"))
    assert mine == sorted([e for e in expected if e[0] == "a"], key=repr)


def test_no_model_and_no_rows(spark):
    df, fitted = grown(spark, 20, 3, trees=2)
    nodes = forest.saved_nodes(spark, save_model(fitted, spark, scratch_path(spark, "m"), "a")).withColumn("species", F.lit("a"))
    df = df.withColumn("species", F.lit("a"))
    features = ["decimalLatitude", "decimalLongitude"]
    assert forest.score_by_nodes(df.limit(0), nodes, features).collect() == []
    assert forest.score_by_nodes(df, nodes.limit(0), features).collect() == []
    assert forest.score_points(df.withColumnRenamed("occ_id", "cell_id"), nodes.limit(0), features, "cell_id").collect() == []


def test_all_species_are_fitted_once_and_reported(spark, monkeypatch):
    fused = view(spark, DATA, "fused").withColumn("species", F.lower(F.trim("species"))).where("occ_id % 2 = 0")
    few = fused.limit(1).withColumn("species", F.lit("rare one"))
    fused = stage(fused.unionByName(few), "fused")
    base, fits, real = scratch_path(spark, "models"), [], all_species.fit_forest

    def broken(rows, *args, **kwargs):
        fits.append(threading.current_thread().name)
        if len(fits) == 3:
            raise RuntimeError("lost")
        return real(rows, *args, **kwargs)

    monkeypatch.setattr(all_species, "fit_forest", broken)
    with pytest.raises(RuntimeError, match="lost"):
        all_species.model_all(fused, base, trees=5, parallel=2)
    before = {r.species for r in registry(spark, base).collect()}
    assert 0 < len(before) < fused.select("species").distinct().count()
    fits[:] = ["a", "b", "c"]
    report = {r.species: r for r in all_species.model_all(fused, base, trees=5, parallel=2).collect()}
    names = {r.species for r in fused.select("species").distinct().collect()}
    assert set(report) == names and len(fits) - 3 == len(names) - len(before)
    assert all(0.9 <= r.accuracy <= 1 for name, r in report.items() if name != "rare one")
    assert report["rare one"].n_train == 2 and report["rare one"].n_test == 2
    assert {r.species: r.n_features for r in registry(spark, base).collect()} == {n: 2 if n == "rare one" else 4 for n in names}
    count = len(fits)
    again = {r.species: r for r in all_species.model_all(fused, base, trees=5, parallel=2).collect()}
    assert again == report and len(fits) == count

    maps = all_species.map_all(spark, base, fused, view(spark, DATA, "ocean").drop("ocean_id"), steps=20)
    assert rows(maps.groupBy("species").count()) == sorted((n, 400) for n in names)
    one = next(n for n in names if n != "rare one")
    loaded = load_model(report[one].path)
    cells = maps.where(F.col("species") == one)
    direct = model.score(loaded, cells.drop("p"))
    pairs = direct.select("cell_id", F.col("p").alias("q")).join(cells, "cell_id").select("p", "q").collect()
    assert len(pairs) == 400 and all(abs(r.p - r.q) <= 1e-12 for r in pairs)
    assert all_nodes(spark, base).select("species").distinct().count() == len(names)


def test_fits_side_by_side_stay_within_the_budget(spark):
    lock, now, seen = threading.Lock(), [], []

    def run(n):
        with lock:
            now.append(n)
            seen.append(list(now))
        time.sleep(0.2)
        with lock:
            now.remove(n)

    all_species.side_by_side(spark, iter([9, 4, 3, 2, 1, 1]), run, 3, lambda n: n, 6)
    assert [running[-1] for running in seen] == [9, 4, 3, 2, 1, 1]
    assert all(len(running) == 1 or (sum(running) <= 6 and len(running) <= 3) for running in seen)
    assert max(map(len, seen)) > 1
    assert model.fitting_bytes(2000, 100) == 2 * model.fitting_bytes(1000, 100) > model.fitting_bytes(2000, 10)


def test_species_keys_are_checked_without_making_the_split_again(spark, monkeypatch):
    checked, real = [], tables.key_collisions
    monkeypatch.setattr(tables, "key_collisions", lambda df: checked.append(df) or real(df))
    fused = view(spark, DATA, "fused").withColumn("species", F.lower(F.trim("species")))
    split = all_species.split_all(fused)
    assert [("role" in df.columns, "species" in df.columns) for df in checked] == [(False, True)]
    assert set(rows(checked[0].select("species").distinct())) == set(rows(split.select("species").distinct()))
    other = fused.where("species = 'click'").withColumn("species", F.lit("click!")).withColumn("occ_id", F.col("occ_id") + 10**6)
    with pytest.raises(ValueError, match="same key"):
        all_species.split_all(fused.unionByName(other.withColumn("species", F.lit("cli ck"))).unionByName(
            other.withColumn("species", F.lit("cli_ck"))))


def test_rows_are_laid_out_once_for_a_fit_and_released(spark, monkeypatch):
    laid_out, real = [], model.Pipeline.fit

    def watched(pipeline, df, *args):
        laid_out.append((df.rdd.getNumPartitions(), df.storageLevel.useMemory, df))
        return real(pipeline, df, *args)

    monkeypatch.setattr(model.Pipeline, "fit", watched)
    monkeypatch.setattr(model, "LEAST_ROWS_PER_TASK", 50)
    grown(spark, 800, 5, trees=2)
    assert [(tasks, kept) for tasks, kept, _ in laid_out] == [(16, True)]
    assert not laid_out[0][2].storageLevel.useMemory and not laid_out[0][2].storageLevel.useDisk
