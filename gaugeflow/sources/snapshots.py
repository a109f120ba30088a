"""Snapshot documents: JSON arrays with one element per row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.operators import rejects
from gaugeflow.operators.decode import decode_json, unnest_array
from gaugeflow.plans.schemas import SCHEDULE_ELEMENT
from gaugeflow.sources import chunks


def read_snapshot_files(
    spark: SparkSession, path: str, element_schema: str = SCHEDULE_ELEMENT
) -> DataFrame:
    """Elements of files that each hold one JSON array, which may span lines.

    One task reads such a file whole, which is best for many small files; for large ones
    there is :func:`read_snapshot_blocks`.
    """
    return unnest_array(spark.read.text(path, wholetext=True), element_schema)


def read_snapshot_blocks(
    spark: SparkSession, path: str, element_schema: str = SCHEDULE_ELEMENT
) -> DataFrame:
    """The same elements, with each file read by as many tasks as it has blocks.

    A file that is no whole array leaves its parts, cut at commas, as rows tagged ``corrupt``.
    """
    rows = chunks.json_elements(spark, path)
    # As the only element of an array, text is written as the whole-file form writes it.
    alone = F.from_json(F.concat(F.lit("["), "text", F.lit("]")), "array<string>")
    value = F.when(F.col("is_array") & (F.size(alone) == 1), F.get(alone, 0)).otherwise(F.col("text"))
    # A generator, so that the text of an element is made once.
    rows = rows.select(F.inline(F.array(F.struct(
        F.col("number").cast("int").alias("position"), value.alias("value"), "is_array"
    ))))
    decoded = decode_json(rows, element_schema)
    return rejects.tag(decoded, [(rejects.CORRUPT, ~F.col("is_array"))]).drop("is_array")


def read_snapshot_lines(
    spark: SparkSession, path: str, element_schema: str = SCHEDULE_ELEMENT
) -> DataFrame:
    """Elements of text files with one JSON array per line; the files can be split."""
    return unnest_array(spark.read.text(path), element_schema)
