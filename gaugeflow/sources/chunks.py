"""Long documents in one file, read by as many tasks as the file has blocks.

Spark's text source splits a file at every occurrence of a separator, also where it stands in
quotes or deep in a document. Each such piece changes what the reader knows (inside quotes or
not, how deep) by an amount that depends only on whether it starts inside quotes. So a block is
summed up under both assumptions, a prefix sum over the blocks of a file tells which of them
holds, and a second scan joins the pieces between two true ends. Both scans take a block's
pieces as they are read, a record batch at a time: pieces are not shuffled, records are, once,
in runs. A block is never larger than ``spark.sql.files.maxPartitionBytes``; the only thing that
must fit into a task besides is one record.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_BLOCK = ["file", "block"]
_BLANKS = " \t\r\n"
# What is known of a whole file.
_FILE = ["opening", "last", "balanced"]
_STATE = ["odd", "depth_outside", "depth_inside"]
# Bytes from which a run of records is cut in two.
_RUN_BYTES = 1 << 20

_WALKED = (
    "file string, block long, odd long, depth_outside long, depth_inside long, n long, "
    "latest long, opening int"
)
_RUNS = (
    "file string, number long, block long, at long, texts array<string>, opening int, last long, "
    "balanced boolean"
)


def pieces(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """file, block, value: the text between separators, each block's in the order of its file."""
    text = spark.read.option("lineSep", separator).text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        "value",
    )


def records(pieces: DataFrame, separator: str, nested: bool, level: int) -> DataFrame:
    """file, number, text, opening, last, balanced: what stands between true separators.

    A record ends with a piece that ends outside quotes at depth ``level``. With ``nested``,
    brackets and braces outside quotes change the depth, and a backslash hides the sign after
    it. Records are numbered from 0 in each file. Of the file, ``opening`` is the first sign's
    code (its first byte), ``last`` the number of records that ended, and ``balanced`` tells whether it ends
    outside quotes at depth 0.
    """
    walked = pieces.mapInArrow(_by_block(_states, separator, nested), _WALKED)
    # A row a block. The broadcast leaves the pieces where they are read, and in order.
    started = pieces.join(F.broadcast(_starts(walked, level)), _BLOCK)
    found = started.mapInArrow(_by_block(_runs, separator, nested, level), _RUNS)
    parts = F.array_sort(F.collect_list(F.struct("block", "at", "texts")))
    rows = found.groupBy("file", "number").agg(
        parts.alias("parts"), *(F.first(name).alias(name) for name in _FILE),
    )
    # A run stands alone under its first record's number, as does a record of one part.
    joined = F.array_join(F.transform("parts", lambda p: F.get(p["texts"], 0)), separator)
    texts = F.when(F.size("parts") == 1, F.get("parts", 0)["texts"]).otherwise(F.array(joined))
    rows = rows.select(
        "file", F.col("number").alias("first"), *_FILE, F.posexplode(texts).alias("nth", "text")
    )
    return rows.select("file", (F.col("first") + F.col("nth")).alias("number"), "text", *_FILE)


class _Walk:
    """The state after each piece, counted from its block's start.

    ``odd`` is the parity of quotes; ``depths`` are the changes of depth if the block starts
    outside or inside quotes.
    """

    def __init__(self, separator: str, nested: bool):
        self.separator, self.nested = separator, nested
        self.at, self.odd, self.depths, self.ended = 0, 0, (0, 0), 0

    def take(self, values: pa.Array) -> None:
        """Go on by a batch; what it has is in the attributes until the next."""
        wide = pa.large_string()
        ending, nothing = pa.scalar(self.separator, wide), pa.scalar("", wide)
        text = pc.binary_join_element_wise(values.cast(wide), ending, nothing)
        _, offsets, data = text.buffers()
        offsets = np.frombuffer(offsets, np.int64)[text.offset:text.offset + len(text) + 1]
        self.data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]]
        # The position after each piece and its separator.
        self.stops = offsets[1:] - offsets[0]
        signs = self._signs()
        found = self.data[signs]
        quotes = (found == ord('"')).astype(np.int64)
        counted = np.cumsum(quotes)
        upto = np.searchsorted(signs, self.stops)
        self.first, self.at = self.at, self.at + len(text)
        self.odds = (self.odd + _before(counted, upto)) % 2
        if self.nested:
            step = np.where((found == ord("[")) | (found == ord("{")), 1, -1) * (1 - quotes)
            in_quotes = (self.odd + counted) % 2
            self.walked = tuple(
                depth + _before(np.cumsum(step * (in_quotes == inside)), upto)
                for inside, depth in enumerate(self.depths)
            )
        else:
            self.walked = (np.zeros(len(text), np.int64),) * 2
        self.odd = int(self.odds[-1])
        self.depths = tuple(int(depth[-1]) for depth in self.walked)

    def _signs(self) -> np.ndarray:
        """Positions of quotes and, where they count, of brackets that no backslash hides."""
        data = self.data
        if not self.nested:
            return np.flatnonzero(data == ord('"'))
        is_sign = _SIGNS[data]
        slashes = np.flatnonzero(data == ord("\\"))
        if len(slashes):
            # The sign after an odd run of backslashes is hidden. A separator ends each run.
            breaks = np.flatnonzero(np.diff(slashes) != 1)
            starts = slashes[np.concatenate(([0], breaks + 1))]
            ends = slashes[np.concatenate((breaks, [len(slashes) - 1]))]
            is_sign[ends[(ends - starts) % 2 == 0] + 1] = False
        return np.flatnonzero(is_sign)


_SIGNS = np.zeros(256, bool)
_SIGNS[list(b'"[]{}')] = True


def _before(sums: np.ndarray, upto: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], sums))[upto]


def _by_block(
    found: Callable[..., pa.RecordBatch], separator: str, nested: bool, *more
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow`` that calls ``found`` with the rows of one block at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, walk = None, None
        for batch in batches:
            for rows in _blocks_of(batch):
                values = rows.column("value")
                row = rows.drop_columns("value").slice(0, 1).to_pylist()[0]
                block = [row[name] for name in _BLOCK]
                if block != current:
                    current, walk = block, _Walk(separator, nested)
                walk.take(values)
                yield found(walk, row, *more)

    return run


def _blocks_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of each block: a task reads one after the other."""
    if not batch.num_rows:
        return
    columns = [batch.column(name) for name in _BLOCK]
    changes = np.zeros(batch.num_rows - 1, bool)
    if any(values[0] != values[-1] for values in columns):
        for values in columns:
            changes |= pc.not_equal(values[1:], values[:-1]).to_numpy(zero_copy_only=False)
    cuts = [0, *(np.flatnonzero(changes) + 1).tolist(), batch.num_rows]
    for start, stop in zip(cuts, cuts[1:]):
        yield batch.slice(start, stop - start)


def _states(walk: _Walk, row: dict) -> pa.RecordBatch:
    """The states that pieces of a batch end in, with their number and the latest such piece."""
    states = np.stack([walk.odds, *walk.walked])
    lowest = states.min(axis=1, keepdims=True)
    packed = np.ravel_multi_index(states - lowest, tuple(np.ptp(states, axis=1) + 1))
    # From the end, so that the first of a state is its latest.
    _, at, n = np.unique(packed[::-1], return_index=True, return_counts=True)
    at = len(packed) - 1 - at
    opening = None
    if walk.first == 0:
        opening = (walk.data[:walk.stops[0] - 1].tobytes().lstrip(_BLANKS.encode()) or b"\0")[0]
    columns = [
        pa.repeat(row["file"], len(n)), pa.repeat(row["block"], len(n)),
        *(pa.array(s[at]) for s in states), pa.array(n.astype(np.int64)),
        pa.array(walk.first + at),
        pa.repeat(pa.scalar(opening, pa.int32()), len(n)),
    ]
    names = [*_BLOCK, *_STATE, "n", "latest", "opening"]
    return pa.RecordBatch.from_arrays(columns, names)


def _runs(walk: _Walk, row: dict, level: int) -> pa.RecordBatch:
    """The texts of a batch between true ends: whole records in runs, its two ends as parts."""
    depth = row["depth_before"] + walk.walked[row["odd_before"]]
    is_end = ((row["odd_before"] + walk.odds) % 2 == 0) & (depth == level)
    ends = np.flatnonzero(is_end)
    number = row["number_before"] + walk.ended
    walk.ended += len(ends)
    pieces = ends if is_end[-1] else np.append(ends, len(is_end) - 1)
    stops = walk.stops[pieces]
    # Texts go without the separator after them.
    data = np.delete(walk.data, stops - 1)
    offsets = np.concatenate(([0], stops - np.arange(1, len(stops) + 1))).astype(np.int32)
    texts = pa.StringArray.from_buffers(
        len(stops), pa.py_buffer(offsets), pa.py_buffer(data)
    )
    # What ends first, what does not end, and between them what also begins in the batch.
    whole = np.arange(1, len(ends))
    runs = whole[np.diff(stops[whole] // _RUN_BYTES, prepend=-1) != 0]
    firsts = np.unique(np.concatenate(([0], runs, np.arange(len(ends), len(stops)))))
    n = len(firsts)
    columns = {
        "file": pa.repeat(row["file"], n), "number": pa.array(number + firsts),
        "block": pa.repeat(row["block"], n), "at": pa.repeat(walk.first, n),
        "texts": pa.ListArray.from_arrays(
            pa.array(np.append(firsts, len(stops)).astype(np.int32)), texts
        ),
        "opening": pa.repeat(pa.scalar(row["opening"], pa.int32()), n),
        **{name: pa.repeat(row[name], n) for name in _FILE[1:]},
    }
    return pa.RecordBatch.from_pydict(columns)


def _ends(odd_before: Column, depth_before: Column, state: Column, level: int) -> Column:
    depth = F.when(odd_before == 0, state["depth_outside"]).otherwise(state["depth_inside"])
    return ((odd_before + state["odd"]) % 2 == 0) & (depth_before + depth == level)


def _starts(walked: DataFrame, level: int) -> DataFrame:
    """One row a block: how it starts, and what is known of its file.

    Pieces are counted by the state they end in, so a block's records can be counted once it
    is known how the block starts.
    """
    counted = walked.groupBy(*_BLOCK, *_STATE).agg(
        F.sum("n").alias("n"), F.max("latest").alias("latest"), F.max("opening").alias("opening"),
    )
    blocks = counted.groupBy(*_BLOCK).agg(
        F.max_by(F.struct(*_STATE), "latest").alias("end"),
        F.max("opening").alias("opening"),
        F.collect_list(F.struct(*_STATE, "n")).alias("states"),
    )
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    before_or_here = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("file")

    def sum_before(column: Column) -> Column:
        return F.coalesce(F.sum(column).over(before), F.lit(0))

    blocks = blocks.withColumn("odd_before", sum_before(F.col("end.odd")) % 2)
    change = F.when(F.col("odd_before") == 0, F.col("end.depth_outside")).otherwise(
        F.col("end.depth_inside")
    )
    blocks = blocks.withColumn("change", change)
    blocks = blocks.withColumn("depth_before", sum_before(F.col("change")))
    here = F.filter("states", lambda s: _ends(
        F.col("odd_before"), F.col("depth_before"), s, level
    ))
    blocks = blocks.withColumn("ends", F.aggregate(
        here, F.lit(0).cast("long"), lambda total, s: total + s["n"]
    ))
    balanced = (F.sum("end.odd").over(whole) % 2 == 0) & (F.sum("change").over(whole) == 0)
    return blocks.select(
        *_BLOCK, "odd_before", "depth_before",
        sum_before(F.col("ends")).alias("number_before"),
        F.first("opening").over(before_or_here).alias("opening"),
        F.sum("ends").over(whole).alias("last"),
        balanced.alias("balanced"),
    )


def json_elements(spark: SparkSession, path: str) -> DataFrame:
    """file, number, text, is_array: the elements of files that each hold one JSON array.

    The brackets of the array are not in ``text``. A file that is no array, or not a whole
    one, has ``is_array`` false; its parts stay as they are.
    """
    rows = records(pieces(spark, path, ","), ",", nested=True, level=1)
    blanks = F.lit(_BLANKS)
    is_array = F.col("balanced") & (F.col("opening") == ord("["))
    text = F.btrim(F.col("text"), blanks)
    opened = F.when(is_array & (F.col("number") == 0), F.substr(text, F.lit(2))).otherwise(text)
    closed = F.when(
        is_array & (F.col("number") == F.col("last")),
        F.substr(opened, F.lit(1), F.length(opened) - 1),
    ).otherwise(opened)
    # A generator, so that the text is made once.
    rows = rows.select(F.inline(F.array(F.struct(
        "file", "number", F.btrim(closed, blanks).alias("text"), is_array.alias("is_array"), "last"
    ))))
    # An empty array is one empty text.
    nothing = F.col("is_array") & (F.col("last") == 0) & (F.col("text") == "")
    return rows.filter(~nothing).drop("last")


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """file, number, text: records of files whose quoted values may hold line ends.

    Quotes must stand in pairs, as they do where values that hold quotes are quoted and their
    quotes doubled. Empty lines between records are left out, their numbers are not.
    """
    rows = records(pieces(spark, path, "\n"), "\n", nested=False, level=0)
    text = F.regexp_replace("text", r"\r$", "")
    return rows.select("file", "number", text.alias("text")).filter(F.col("text") != "")
