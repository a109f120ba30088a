"""Keyed operators: last row, first row and previous row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.session import scratch_root

# Rows of one key that one task may sort; a key above it is cut into slices.
MAX_KEY_ROWS = 5_000_000
# Slices per MAX_KEY_ROWS of a hot key, as slack for rows bunched in time.
_OVERSPLIT = 8
# Slices up to which their last rows are broadcast.
_MAX_BROADCAST_SLICES = 1_000_000


def latest(
    df: DataFrame, key: Sequence[str], order_by: Sequence[str], narrow_first: bool = False
) -> DataFrame:
    """The whole last row per key: a NULL in it replaces an older value.

    A partial maximum runs before the shuffle, so a key with any share of the rows
    arrives as one row per task. Rows that tie on ``order_by`` are decided by their
    other columns, which makes the result the same on every run.

    The maximum is of whole rows, which Spark can only aggregate sorted: every task sorts
    its rows. With ``narrow_first`` the largest first order column of each key is found by
    hash aggregation, and only rows that have it are compared whole. That reads ``df``
    twice and pays off for stored rows with many of them for each key; not for rows that
    a decoder makes, or for keys that mostly occur once.
    """
    if narrow_first:
        df = _with_extreme(df, key, order_by[0], F.max)
    return _extreme(df, key, order_by, [F.col(c) for c in order_by], F.max)


def first(
    df: DataFrame,
    key: Sequence[str],
    order_by: Sequence[str],
    count: str | None = None,
    narrow_first: bool = False,
) -> DataFrame:
    """The whole first row per key; NULL order values come last.

    ``count`` names a column for the number of the key's rows; ``narrow_first`` is as in
    :func:`latest` and leaves no rows to count.
    """
    order = [
        c for name in order_by for c in (F.col(name).isNull().alias(f"{name}_null"), F.col(name))
    ]
    if narrow_first and count is not None:
        raise ValueError("narrow_first leaves no rows to count")
    if narrow_first:
        df = _with_extreme(df, key, order_by[0], F.min)
    return _extreme(df, key, order_by, order, F.min, count)


def _with_extreme(df: DataFrame, key: Sequence[str], lead: str, pick) -> DataFrame:
    """The rows that have their key's largest (smallest) ``lead``; NULL where it has no other."""
    names = [*key, lead]
    best = df.groupBy(*key).agg(pick(lead).alias(lead))
    best = best.select(*[F.col(c).alias(f"_best_{i}") for i, c in enumerate(names)])
    same = F.lit(True)
    for i, c in enumerate(names):
        same = same & F.col(c).eqNullSafe(F.col(f"_best_{i}"))
    return df.join(best, same, "left_semi")


def _extreme(
    df: DataFrame,
    key: Sequence[str],
    order_by: Sequence[str],
    order: list[Column],
    pick,
    count: str | None = None,
) -> DataFrame:
    # One struct, compared field by field; order columns travel only once.
    rest = [c for c in df.columns if c not in key and c not in order_by]
    best = df.groupBy(*key).agg(
        pick(F.struct(*order, F.struct(*rest).alias("_rest"))).alias("_best")
        if rest
        else pick(F.struct(*order)).alias("_best"),
        *([] if count is None else [F.count(F.lit(1)).alias(count)]),
    )
    best_row = F.col("_best")

    def output(name: str) -> Column:
        if name in key:
            return F.col(name)
        source = best_row if name in order_by else best_row.getField("_rest")
        return source.getField(name).alias(name)

    return best.select(*[output(c) for c in df.columns], *([] if count is None else [count]))


def superseded(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with the number of rows a keyed load drops."""
    counts = df.groupBy(*key).agg((F.count(F.lit(1)) - 1).alias("superseded"))
    return counts.filter("superseded > 0")


def previous(
    df: DataFrame,
    key: Sequence[str],
    order_by: Sequence[str],
    fields: Sequence[str],
    max_key_rows: int | None = MAX_KEY_ROWS,
    out: str = "previous",
) -> DataFrame:
    """Add the struct ``out`` with ``fields`` of the key's previous row in ``order_by``.

    Rows of a key must be in order, which a plain window does in one task per key.
    Keys of more than ``max_key_rows`` rows are therefore cut into slices that are
    sorted apart; the first row of each slice takes its value from the last row of the
    slice before. To find such keys, their rows are counted first, in a job of its own
    over the key columns; None leaves that out where no key can have so many rows.
    """
    value = F.struct(*[F.col(c) for c in fields])
    order = [F.col(c) for c in order_by]
    hot = [] if max_key_rows is None else _hot_keys(df, key, max_key_rows)
    if not hot:
        window = W.partitionBy(*key).orderBy(*order)
        return df.withColumn(out, F.lag(value).over(window))

    sliced = _slices_of_time(df, key, order_by[0], hot, max_key_rows)
    if sliced is None:
        sliced = _slices_by_range(df, key, order_by, hot, max_key_rows)
    # Last row of each slice of a hot key, handed to the slice after it.
    entry = F.struct(F.struct(*order).alias("order"), value.alias("value"))
    tails = (
        sliced.filter("_slice IS NOT NULL").groupBy(*key, "_slice").agg(F.max(entry).alias("_tail"))
    )
    by_slice = W.partitionBy(*key).orderBy("_slice")
    handed = tails.select(*key, "_slice", F.lag("_tail.value").over(by_slice).alias("_handed"))
    if _slice_count(hot, max_key_rows) <= _MAX_BROADCAST_SLICES:
        handed = F.broadcast(handed)
    window = W.partitionBy(*key, "_slice").orderBy(*order)
    # Said outright: where rows already lie together by key, Spark would see no need for an
    # exchange and leave all slices of a hot key in one task.
    sliced = sliced.repartition(*key, "_slice")
    rows = sliced.withColumn(out, F.lag(value).over(window))
    joined = _join_keys(rows, handed, [*key, "_slice"])
    return joined.select(*df.columns, F.coalesce(F.col(out), F.col("_handed")).alias(out))


def join_one_of_each(
    df: DataFrame, prior: DataFrame, key: Sequence[str], max_key_rows: int
) -> DataFrame:
    """Left join with ``prior``, which has a row for each key, without gathering a hot key.

    Rows of keys above ``max_key_rows`` are dealt into parts, and the prior row of such a
    key is repeated for each part.
    """
    hot = _hot_keys(df, key, max_key_rows)
    if not hot:
        return df.join(prior, list(key), "left")
    parts = T.StructType([T.StructField("_parts", T.LongType())])
    sizes = [(*[row[c] for c in key], -(-row["_n"] // max_key_rows)) for row in hot]
    known = _small(df, key, sizes, parts)
    dealt = _join_keys(df, known, key).withColumn(
        "_part", F.coalesce(F.pmod(F.xxhash64(*df.columns), "_parts"), F.lit(0))
    ).drop("_parts")
    last = F.coalesce(F.col("_parts") - 1, F.lit(0))
    repeated = _join_keys(prior, known, key).withColumn(
        "_part", F.explode(F.sequence(F.lit(0).cast("long"), last))
    ).drop("_parts")
    return dealt.join(repeated, [*key, "_part"], "left").drop("_part")


def _join_keys(df: DataFrame, other: DataFrame, key: Sequence[str]) -> DataFrame:
    """Left join that also matches NULL keys; the key columns of ``other`` go."""
    renamed = {c: f"_other_{c}" for c in key}
    other = other.withColumnsRenamed(renamed)
    condition = F.lit(True)
    for name, new in renamed.items():
        condition = condition & F.col(name).eqNullSafe(F.col(new))
    return df.join(other, condition, "left").drop(*renamed.values())


def _hot_keys(df: DataFrame, key: Sequence[str], max_key_rows: int) -> list:
    """Keys above ``max_key_rows`` with their row counts: at most total / max_key_rows."""
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter(F.col("_n") > max_key_rows).collect()


def _slice_count(hot: list, max_key_rows: int) -> int:
    """Upper bound of the number of slices of all hot keys."""
    return sum(1 + _OVERSPLIT * -(-row["_n"] // max_key_rows) for row in hot)


def _small(df: DataFrame, key: Sequence[str], rows: list, extra: T.StructType) -> DataFrame:
    """Rows about hot keys as a table to broadcast; their number is bounded as above."""
    schema = T.StructType([*[T.StructField(c, df.schema[c].dataType) for c in key], *extra])
    return F.broadcast(df.sparkSession.createDataFrame(rows, schema))


def _slices_of_time(
    df: DataFrame, key: Sequence[str], lead: str, hot: list, max_key_rows: int
) -> DataFrame | None:
    """Add ``_slice``, equal widths of the first order column; NULL for other keys.

    None if the column cannot be measured or its values bunch up in some slice.
    """
    position = _as_number(F.col(lead), df.schema[lead].dataType)
    if position is None:
        return None
    counted = T.StructType([T.StructField("_n", T.LongType())])
    candidates = _small(df, key, [tuple(row) for row in hot], counted)
    spans = (
        _join_keys(df.select(*key, lead), candidates, key)
        .filter("_n IS NOT NULL")
        .groupBy(*key, "_n")
        .agg(F.min(position).alias("_low"), F.max(position).alias("_high"))
    )
    cut = []
    for row in spans.collect():
        slices = _OVERSPLIT * -(-row["_n"] // max_key_rows)
        if row["_low"] is None or row["_low"] == row["_high"]:
            return None
        width = (row["_high"] - row["_low"]) / slices
        cut.append((*[row[c] for c in key], row["_low"], width))
    bounds = T.StructType(
        [T.StructField("_low", T.DoubleType()), T.StructField("_width", T.DoubleType())]
    )
    # NULL order values come first.
    number = F.coalesce(F.floor((position - F.col("_low")) / F.col("_width")), F.lit(-1))
    sliced = (
        _join_keys(df, _small(df, key, cut, bounds), key)
        .withColumn("_slice", F.when(F.col("_low").isNotNull(), number))
        .drop("_low", "_width")
    )
    sizes = sliced.filter("_slice IS NOT NULL").groupBy(*key, "_slice").count()
    if sizes.filter(F.col("count") > max_key_rows).head(1):
        return None
    return sliced


def _slices_by_range(
    df: DataFrame, key: Sequence[str], order_by: Sequence[str], hot: list, max_key_rows: int
) -> DataFrame:
    """Add ``_slice``, even parts of a hot key's rows in order; NULL for other keys.

    Works for any order, at the price of one more shuffle of the hot keys' rows. They are
    checkpointed, since the parts come from a sample and must not change when recomputed.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_root(spark))
    counted = T.StructType([T.StructField("_n", T.LongType())])
    flagged = _join_keys(df, _small(df, key, [tuple(row) for row in hot], counted), key)
    cold = flagged.filter("_n IS NULL").drop("_n").withColumn("_slice", F.lit(None).cast("long"))
    parts = 2 * -(-sum(row["_n"] for row in hot) // max_key_rows)
    ranged = (
        flagged.filter("_n IS NOT NULL")
        .drop("_n")
        .repartitionByRange(parts, *key, *order_by)
        .withColumn("_slice", F.spark_partition_id().cast("long"))
        .checkpoint()
    )
    return cold.unionByName(ranged)


def _as_number(column: Column, data_type: T.DataType) -> Column | None:
    if isinstance(data_type, T.NumericType):
        return column.cast("double")
    if isinstance(data_type, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(data_type, T.TimestampNTZType):
        # Read field by field: a detour over an instant would depend on the session zone.
        days = F.unix_date(column.cast("date")).cast("double")
        seconds = F.hour(column) * 3600 + F.minute(column) * 60 + F.extract(F.lit("SECOND"), column)
        return days * 86_400 + seconds.cast("double")
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(column).cast("double")
    return None
