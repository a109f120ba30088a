"""Comma-separated text: export and scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.operators import rejects
from gaugeflow.sources import chunks

_CORRUPT = "_corrupt_record"

# Written and read alike, so that values come back as they were.
_FIDELITY = {
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    "nullValue": "\\N", "escape": '"',
}


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """Export; the call returns when every file is committed.

    Spaces at the ends of a value, quotes and line ends stay, and NULL is written apart
    from an empty value; a value that is the text of NULL itself reads back as NULL.
    """
    writer = df.write.options(**_FIDELITY).option("emptyValue", '""')
    writer.option("header", header).csv(path)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    header: bool = True,
    fail_fast: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """Typed scan. Lines that do not fit are tagged ``bad_field``, with their text in ``raw``.

    ``multi_line`` is for values with line ends in them; each file is then read by one task.
    Large files of that kind are for :func:`read_csv_blocks`.
    """
    reader = spark.read.options(**_FIDELITY).option("emptyValue", "")
    reader = reader.option("multiLine", multi_line)
    if fail_fast:
        reader = reader.schema(schema).option("mode", "FAILFAST")
        return reader.option("header", header).csv(path)
    wide = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    rows = (
        reader.schema(wide)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .option("header", header)
        .csv(path)
    )
    return rejects.scan_tagged(rows, _CORRUPT, rejects.BAD_FIELD, "raw")


def read_csv_blocks(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    header: bool = True,
    fail_fast: bool = False,
) -> DataFrame:
    """``read_csv`` with ``multi_line``, with each file read by as many tasks as it has blocks.

    Quotes must stand in pairs, as :func:`write_csv` leaves them: a lone quote in a value
    that is not quoted would hide the line ends after it.
    """
    lines = chunks.csv_records(spark, path)
    if header:
        lines = lines.filter(F.col("number") > 0)
    wide = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {
        **_FIDELITY, "emptyValue": "", "multiLine": "true",
        "mode": "FAILFAST" if fail_fast else "PERMISSIVE",
    }
    if fail_fast:
        parsed = F.from_csv("text", schema.toDDL(), options)
        return lines.select(F.inline(F.array(parsed)))
    options["columnNameOfCorruptRecord"] = _CORRUPT
    parsed = F.from_csv("text", wide.toDDL(), options)
    # A generator, so that text is parsed once and whole, whichever columns are used.
    rows = lines.select(F.inline(F.array(parsed)))
    rows = rejects.tag(rows, [(rejects.BAD_FIELD, F.col(_CORRUPT).isNotNull())])
    return rows.withColumnRenamed(_CORRUPT, "raw")
