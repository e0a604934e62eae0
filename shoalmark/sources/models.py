"""Fitted models in folders, one per species, with a table of their nodes and a registry."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoalmark.functions.text import species_key
from shoalmark.operators.forest import NODE, saved_nodes

# Folders beside those of the species, whose keys hold no hyphen.
NODES, REGISTRY = "all-nodes", "all-models"
REGISTERED = "species string, path string, n_features int, n_train long, species_key string"


def model_path(spark: SparkSession, base: str, species: str) -> str:
    key = spark.range(1).select(species_key(F.lit(species))).first()[0]
    return f"{base}/{key}/random_forest_model"


def save_model(model: PipelineModel, spark: SparkSession, base: str, species: str) -> str:
    """Save below the species' key, replacing its earlier model.

    The folder also keeps the name; another name with the same key raises.
    """
    path = model_path(spark, base, species)
    named = f"{path}_name"
    folder = spark._jvm.org.apache.hadoop.fs.Path(named)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        owner = spark.read.text(named, wholetext=True).first()
        if owner is not None and owner[0].rstrip("\n") != species:
            raise ValueError(f"{path} holds the model of {owner[0].rstrip()!r}, not of {species!r}")
    model.write().overwrite().save(path)
    spark.createDataFrame([(species,)], "value string").coalesce(1).write.mode("overwrite").text(named)
    return path


def register_model(model: PipelineModel, spark: SparkSession, base: str, species: str, key: str, n_train: int) -> str:
    """Save the model, its nodes, and last its row of the registry: a model that has one is
    whole. Each replaces what the species had before."""
    path = save_model(model, spark, base, species)
    name = F.lit(species).alias("species")
    _replace(saved_nodes(spark, path).select(name, "*"), f"{base}/{NODES}", key)
    row = spark.range(1).select(
        name, F.lit(path).alias("path"), F.lit(len(model.stages[0].getInputCols())).alias("n_features"),
        F.lit(n_train).cast("long").alias("n_train"))
    _replace(row, f"{base}/{REGISTRY}", key)
    return path


def _replace(df: DataFrame, path: str, key: str) -> None:
    df.coalesce(1).withColumn("species_key", F.lit(key)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("species_key").parquet(path)


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def registry(spark: SparkSession, base: str) -> DataFrame:
    """One row for each model below ``base`` that is whole (REGISTERED)."""
    return _table(spark, f"{base}/{REGISTRY}", REGISTERED)


def all_nodes(spark: SparkSession, base: str) -> DataFrame:
    """The nodes of all registered models, told apart by ``species``."""
    nodes = _table(spark, f"{base}/{NODES}", f"species string, {NODE}, species_key string")
    return nodes.join(registry(spark, base).select("species_key"), "species_key", "left_semi").drop("species_key")


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
