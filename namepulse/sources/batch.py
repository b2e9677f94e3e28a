"""Batch scans of record files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namepulse import schema as S
from namepulse.functions.codec import clean_utf8


def scan_records(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Records with their 27 typed columns.

    Takes globs of any granularity, mixed. Missing trailing fields and values
    that do not parse are NULL. Quotes are ordinary characters.
    """
    return (
        spark.read.schema(S.RECORD_DDL)
        .option("sep", S.FIELD_SEPARATOR)
        .option("quote", "")
        .option("timestampFormat", S.RECORD_TIME_FORMAT)
        .option("recursiveFileLookup", "true")
        .csv([paths] if isinstance(paths, str) else list(paths))
    )


def scan_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines as one column, ``value``, from files, folders or globs. Malformed
    bytes are dropped."""
    return raw_lines(spark, paths).select(clean_utf8(F.col("value")).alias("value"))


def raw_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """The same as read, malformed bytes and all."""
    return (
        spark.read.option("recursiveFileLookup", "true")
        .text([paths] if isinstance(paths, str) else list(paths))
    )


def paths_from_index(spark: SparkSession, index: str, charset: str = "UTF-16") -> list[str]:
    """Scan paths listed in an index file, one a line.

    The driver lists every scan path anyway, so the index comes to the driver.
    """
    text = F.decode("content", charset)
    lines = (
        spark.read.format("binaryFile")
        .load(index)
        .select(F.explode(F.split(text, r"\r?\n")).alias("line"))
        .select(F.trim("line").alias("path"))
    )
    return [row.path for row in lines.where("path <> ''").collect()]


def scan_index(spark: SparkSession, index: str, charset: str = "UTF-16") -> DataFrame:
    return scan_records(spark, paths_from_index(spark, index, charset))
