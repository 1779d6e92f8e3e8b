"""The run document: one row, written as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def json_text(df: DataFrame, indent: bool = True) -> DataFrame:
    """Each row as one JSON text in column ``document``; NULL fields are kept."""
    options = {"ignoreNullFields": "false", "pretty": "true" if indent else "false"}
    return df.select(F.to_json(F.struct(*df.columns), options).alias("document"))


def write_document(df: DataFrame, path: str) -> None:
    """The one-row document ``df`` as indented JSON text."""
    json_text(df).coalesce(1).write.mode("overwrite").text(path)


def read_document(spark: SparkSession, path: str, schema=None) -> DataFrame:
    reader = spark.read.option("multiLine", "true")
    return (reader.schema(schema) if schema else reader).json(path)
