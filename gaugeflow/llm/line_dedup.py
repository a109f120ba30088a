"""Line deduplication that passes line hashes around, never text.

A line's key is the line without white space at its ends, A-Z in lower case. Keys go as
128-bit hashes. They are range-partitioned, sorted by document and position, and each run of
equal hashes is streamed once: its first entry names the document that keeps the line.
What comes back is a compressed keep bitmap for each document (the runs of dropped lines).

Hashes that have a thousandth of all lines or more are decided apart, since a run of them
would fill one task: there are at most a thousand, so what was counted for them (a partial
aggregate by hash and document) is broadcast. Everything is DataFrame functions.

Defined results: null or empty text is one empty line, which is kept. A document is a
``doc_id``; the largest one keeps a line, in each row it has, and null counts as smallest.
Equal rows get equal results. An empty table gives an empty result; no other column is read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm import common

_WHITE = " \t\n\x0b\f\r"
#: A hash is decided apart from this share of all lines on.
HOT_SHARE = 1000


def line_key(line: Column) -> Column:
    bare = F.btrim(line, F.lit(_WHITE))
    # lower() also folds other letters, so it is right for ASCII only, where it is much cheaper.
    ascii_only = F.octet_length(bare) == F.length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(
        F.translate(bare, string.ascii_uppercase, string.ascii_lowercase)
    )


def _lines(text: str = "text") -> Column:
    return F.split(F.col(text), "\n", -1)


def _identified(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, text: the first two tell documents apart, up to equal rows."""
    return common.texts(docs).withColumn("text_key", F.xxhash64("text"))


def _entries(docs: DataFrame, min_chars: int) -> DataFrame:
    lines = _identified(docs).select(
        "doc_id", "text_key", F.posexplode(_lines()).alias("position", "line")
    )
    keys = lines.select("doc_id", "text_key", "position", line_key(F.col("line")).alias("key"))
    return keys.filter(F.length("key") >= min_chars).select(
        F.unhex(F.md5(F.col("key").cast("binary"))).alias("hash"),
        "doc_id", "text_key", "position",
    )


def _dropped(entries: DataFrame, min_docs: int) -> DataFrame:
    """The entries that lose their line."""
    total = entries.count()
    hot = (
        entries.groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") * HOT_SHARE >= F.lit(total)).select("hash")
    )
    hot = common.written(hot, "hot-lines")  # at most HOT_SHARE rows
    hot_keepers = (
        entries.join(F.broadcast(hot), "hash", "left_semi").groupBy("hash", "doc_id").count()
        .groupBy("hash").agg(
            F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keeper")
        )
    )
    from_hot = entries.join(F.broadcast(hot_keepers), "hash")

    run = Window.partitionBy("hash")
    ordered = run.orderBy(F.desc_nulls_last("doc_id"), "text_key", "position")
    from_rest = (
        entries.join(F.broadcast(hot), "hash", "left_anti")
        .repartitionByRange("hash")
        .sortWithinPartitions("hash", F.desc_nulls_last("doc_id"), "text_key", "position")
        .withColumn("keeper", F.first("doc_id").over(ordered))
        .withColumn("nth_doc", F.dense_rank().over(run.orderBy(F.desc_nulls_last("doc_id"))))
        .withColumn("n_docs", F.max("nth_doc").over(run))
        .drop("nth_doc")
    )
    losing = (F.col("n_docs") >= min_docs) & ~F.col("doc_id").eqNullSafe(F.col("keeper"))
    columns = ["doc_id", "text_key", "position"]
    return from_rest.filter(losing).select(*columns).unionByName(
        from_hot.filter(losing).select(*columns)
    )


def _runs(positions: Column) -> Column:
    """Sorted positions as runs (start, length)."""
    starts = F.filter(
        positions, lambda p, i: (i == 0) | (F.element_at(positions, F.greatest(i, F.lit(1))) != p - 1)
    )
    ends = F.filter(
        positions,
        lambda p, i: (i == F.size(positions) - 1)
        | (F.element_at(positions, F.least(i + 2, F.size(positions))) != p + 1),
    )
    return F.transform(
        F.arrays_zip(starts.alias("start"), ends.alias("end")),
        lambda run: F.struct(
            run["start"].alias("start"), (run["end"] - run["start"] + 1).alias("length")
        ),
    )


def keep_bitmaps(docs: DataFrame, min_docs: int = 3, min_chars: int = 20) -> DataFrame:
    """doc_id, text_key and the runs of dropped lines, for documents that lose some."""
    entries = common.written(_entries(docs, min_chars), "lines")
    return (
        _dropped(entries, min_docs).groupBy("doc_id", "text_key")
        .agg(F.sort_array(F.collect_set("position")).alias("positions"))
        .select("doc_id", "text_key", _runs(F.col("positions")).alias("dropped"))
    )


def kept_text(lines: Column, dropped: Column) -> Column:
    """The lines outside the dropped runs, joined."""
    starts = F.concat(F.array(F.lit(0)), F.transform(dropped, lambda r: r["start"] + r["length"]))
    ends = F.concat(F.transform(dropped, lambda r: r["start"]), F.array(F.size(lines)))
    pieces = F.transform(
        F.arrays_zip(starts.alias("start"), ends.alias("end")),
        lambda p: F.slice(lines, p["start"] + 1, p["end"] - p["start"]),
    )
    return F.array_join(F.flatten(pieces), "\n")


def drop_lines(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """doc_id, kept_text, n_lines, n_dropped of each document."""
    right = bitmaps.select(
        F.col("doc_id").alias("id"), F.col("text_key").alias("key"), "dropped"
    )
    joined = _identified(docs).join(
        right, (F.col("text_key") == F.col("key")) & F.col("doc_id").eqNullSafe(F.col("id")), "left"
    )
    lost = F.aggregate("dropped", F.lit(0), lambda n, run: n + run["length"])
    return joined.select(
        "doc_id",
        F.when(F.col("dropped").isNull(), F.col("text"))
        .otherwise(kept_text(_lines(), F.col("dropped"))).alias("kept_text"),
        F.size(_lines()).cast("long").alias("n_lines"),
        F.coalesce(lost, F.lit(0)).cast("long").alias("n_dropped"),
    )
