"""What the operators share: code on workers, intermediate tables, connected components."""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import namepulse.llm
from namepulse.session import settle

__all__ = ["components", "documents", "settle", "workers"]


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def workers() -> None:
    """Send the code of these modules with each task, so that workers need no installed package."""
    cloudpickle.register_pickle_by_value(namepulse.llm)


def components(edges: DataFrame, label: str, steps: int | None = None) -> DataFrame:
    """Connected components of links ``(a, b)``: rows ``(id, component)``, the component's smallest id.

    Alternates large-star and small-star steps: each joins the links with one
    aggregate per id, so an id with many links is no single task's work. Every
    step is a written table. Links with a null end are left out.

    With a number of ``steps``, stops after so many: ids of one component then
    belong together, but a chain of links may still be in several.
    """
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    pairs = settle(pairs.where("a > b").distinct(), f"{label}-links")
    digest = _digest(pairs)
    while digest[0] and steps != 0:
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = both.where("b > a").join(least.select("a", F.least("a", "m").alias("m")), "a")
        large = settle(large.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), f"{label}-large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        rest = small.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        star = settle(least.select("a", F.col("m").alias("b")).union(rest).distinct(), f"{label}-small")
        before, digest, pairs = digest, _digest(star), star
        if before == digest:
            break
        steps = steps and steps - 1
    ends = pairs.select(F.col("a").alias("id"), F.col("b").alias("component"))
    ends = ends.union(pairs.select(F.col("b").alias("id"), F.col("b").alias("component")))
    return ends.groupBy("id").agg(F.min("component").alias("component"))


def _digest(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())
