"""Removal of long byte strings that repeat anywhere in the corpus, by suffix sorting.

A string of ``size`` bytes contains windows of fewer bytes; the first with the smallest hash is
its anchor, the same wherever the string stands. The starts of a text are cut where the anchor
changes, and each stretch of starts is a segment: its anchor, and the bytes its strings cover.
Equal strings meet under their anchor, so only segments that share an anchor need sorting.

Equal segments become one with a count, first in the task that finds them, so a passage in a
third of all documents leaves each task once; more than one means all its strings repeat.
Where an anchor has different segments their bytes are fetched and, in units of bounded
size, two-stage sorted; adjacent common prefixes of ``size`` bytes or more are repeats. An
anchor with too many different segments for a unit is cut anew by anchors of longer windows;
the longest window is the string itself, where nothing is left to sort.

Segments are told apart by 64-bit hashes of anchor and bytes; texts by MD5.

Defined results: null text is empty; texts shorter than ``size`` lose nothing. Bytes of
characters may be cut apart, so what is kept is bytes. Equal rows get equal results. An empty
table gives an empty result. No other column is read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm import common
from gaugeflow.llm.hashing import RollingHash
from gaugeflow.llm.suffix_array import common_prefixes, suffix_array

#: Segments of a bucket, bytes sorted by one task, and different segments an anchor may have.
BUCKET_SEGMENTS, UNIT_BYTES, ANCHOR_SEGMENTS = 1_000_000, 1_500_000, 20_000
#: Starts of a text that are hashed at once.
STARTS_AT_ONCE = 1 << 19

#: A text is hot from this share of all rows on.
HOT_SHARE = 1000

_END = 0xFF  # a byte that UTF-8 text never has
_SPANS = "text binary, start long, end long"


def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[:len(values) - rest], values[rest:]) if rest else values


def segments_of(data: np.ndarray, first: int, last: int, window: int, size: int):
    """Segments of the starts ``first`` to ``last``: anchor, digest, start, end (of starts)."""
    found = []
    for at in range(first, last, STARTS_AT_ONCE):
        until = min(last, at + STARTS_AT_ONCE)
        rolling = RollingHash(data[at:until + size - 1])
        hashes = rolling.windows(window)
        anchors = _sliding_minimum(hashes, size - window + 1)
        # The leftmost smallest window changes where the smallest hash does, or is left behind.
        # So a segment has one anchor place, and no string of it can stand in it twice.
        changes = (anchors[1:] != anchors[:-1]) | (hashes[:len(anchors) - 1] == anchors[:-1])
        cuts = np.flatnonzero(changes) + 1
        starts = np.concatenate([[0], cuts])
        ends = np.append(cuts, len(anchors))
        digests = rolling.of(starts, ends + size - 1)
        found.append((anchors[starts], digests, starts + at, ends + at))
    return tuple(map(np.concatenate, zip(*found)))


def _merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals, as sorted intervals that do not touch."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > reach[:-1]])
    return starts[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)]


def _spans(names: list[bytes], owners, starts, ends) -> tuple[list, list, list]:
    """Merged spans by owner, as columns."""
    order = np.argsort(owners, kind="stable")
    owners, starts, ends = owners[order], starts[order], ends[order]
    out: tuple[list, list, list] = ([], [], [])
    heads = np.flatnonzero(np.diff(owners, prepend=-1))
    for head, until in zip(heads, np.append(heads[1:], len(owners))):
        a, b = _merged(starts[head:until], ends[head:until])
        out[0].extend([names[owners[head]]] * len(a))
        out[1].extend(a.tolist())
        out[2].extend(b.tolist())
    return out


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, text, key (a digest of the text)."""
    return common.texts(docs).withColumn("key", F.unhex(F.md5(F.col("text").cast("binary"))))


def _meetings(texts: DataFrame, window: int, size: int, buckets: int) -> DataFrame:
    """What the segments of ``texts`` (key, text, ranges of starts) meet.

    Rows (text, start, end, anchor, seen, kind): ``covered`` spans of bytes that repeat;
    ``mixed`` and ``hot`` segments (ranges of starts) under an anchor with others.
    """
    each = np.uint64(buckets)
    most_segments = ANCHOR_SEGMENTS

    def emit(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = common.text_bytes(batch.column(1))
        names: dict[bytes, int] = {}
        parts = []
        for row, (key, ranges) in enumerate(
            zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())
        ):
            text = data[offsets[row]:offsets[row + 1]]
            if len(text) < size or (key in names and ranges is None):
                continue
            owner = names.setdefault(key, len(names))
            whole = [{"start": 0, "end": len(text) - size + 1}]
            for r in whole if ranges is None else ranges:
                found = segments_of(text, r["start"], r["end"], window, size)
                parts.append((*found, np.full(len(found[0]), owner)))
        rows = []
        if parts:
            anchors, digests, starts, ends, owners = map(np.concatenate, zip(*parts))
            order = np.lexsort((starts, owners, digests, anchors))
            anchors, digests = anchors[order], digests[order]
            starts, ends, owners = starts[order], ends[order], owners[order]
            new = _changes(anchors, digests)
            again = ~_changes(anchors, digests, owners, starts)  # the same range given twice
            count = np.add.reduceat((~again).astype(np.int64), np.flatnonzero(new))
            several = np.repeat(count > 1, np.diff(np.append(np.flatnonzero(new), len(new))))
            keys = list(names)
            covered = several & ~again
            # One of each set of equal segments goes on; the others are covered already.
            a, b, c = _spans(keys, owners[covered], starts[covered], ends[covered] + size - 1)
            if a:
                rows.append((
                    int(np.uint64(anchors[0]) % each), b"", b"", b"", b"", b"", b"",
                    b"".join(a), np.array([b, c], np.int64).T.tobytes(),
                ))
            bucket = anchors[new] % each
            by = np.argsort(bucket, kind="stable")
            at = np.flatnonzero(new)[by]
            bucket = bucket[by]
            heads = np.flatnonzero(np.diff(bucket, prepend=each))
            packed = np.array(keys, "V16")
            for head, until in zip(heads, np.append(heads[1:], len(bucket))):
                own = at[head:until]
                used, place = np.unique(owners[own], return_inverse=True)
                rows.append((
                    int(bucket[head]), anchors[own].tobytes(), digests[own].tobytes(),
                    starts[own].astype("<u4").tobytes(),
                    ((ends[own] - starts[own]) * 2 + several[own]).astype("<u2").tobytes(),
                    place.astype("<u4").tobytes(), packed[used].tobytes(), b"", b"",
                ))
        columns = list(zip(*rows)) or [[]] * 9
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), *(pa.array(c, pa.binary()) for c in columns[1:])],
            ["bucket", *(f"c{i}" for i in range(8))],
        )

    def meet(table: pa.Table) -> pa.Table:
        columns = [table.column(f"c{i}").to_pylist() for i in range(8)]
        out: list[tuple] = []
        done = b"".join(columns[6])
        bounds = np.frombuffer(b"".join(columns[7]), np.int64).reshape(-1, 2).tolist()
        out += [
            (done[16 * i:16 * i + 16], s, e, 0, True, "covered") for i, (s, e) in enumerate(bounds)
        ]
        anchors = np.frombuffer(b"".join(columns[0]), np.uint64)
        if len(anchors):
            digests = np.frombuffer(b"".join(columns[1]), np.uint64)
            starts = np.frombuffer(b"".join(columns[2]), "<u4").astype(np.int64)
            packed = np.frombuffer(b"".join(columns[3]), "<u2").astype(np.int64)
            names = b"".join(columns[5])
            shift = np.repeat(
                np.cumsum([0, *(len(x) // 16 for x in columns[5])])[:-1],
                [len(x) // 4 for x in columns[4]],
            )
            owners = np.frombuffer(b"".join(columns[4]), "<u4").astype(np.int64) + shift
            keys = [names[i:i + 16] for i in range(0, len(names), 16)]
            first: dict[bytes, int] = {}
            same = np.array([first.setdefault(k, i) for i, k in enumerate(keys)])
            owners = same[owners]
            order = np.lexsort((starts, owners, digests, anchors))
            anchors, digests, starts = anchors[order], digests[order], starts[order]
            owners, packed = owners[order], packed[order]
            ends, seen = starts + (packed >> 1), (packed & 1).astype(bool)
            again = ~_changes(anchors, digests, owners, starts)
            new = _changes(anchors, digests)
            heads = np.flatnonzero(new)
            count = np.add.reduceat((~again).astype(np.int64), heads)
            count += np.logical_or.reduceat(seen, heads)  # seen more than once in one task
            size_of = np.diff(np.append(heads, len(new)))
            several = np.repeat(count > 1, size_of)
            late = several & ~again
            for row in zip(*_spans(keys, owners[late], starts[late], ends[late] + size - 1)):
                out.append((*row, 0, True, "covered"))
            kinds_of = np.add.reduceat(new.astype(np.int64), np.flatnonzero(_changes(anchors)))
            kinds = np.repeat(
                kinds_of, np.diff(np.append(np.flatnonzero(_changes(anchors)), len(anchors)))
            )
            for i in np.flatnonzero(new & (kinds > 1)).tolist():
                kind = "hot" if kinds[i] > most_segments else "mixed"
                anchor = int(anchors[i].astype(np.int64))
                out.append((
                    keys[owners[i]], int(starts[i]), int(ends[i]), anchor, bool(several[i]), kind,
                ))
        columns = list(zip(*out)) or [[]] * 6
        types = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string())
        return pa.table(
            [pa.array(c, t) for c, t in zip(columns, types)],
            ["text", "start", "end", "anchor", "seen", "kind"],
        )

    rows = common.map_batches(
        texts, emit, "bucket long, " + ", ".join(f"c{i} binary" for i in range(8))
    )
    met = rows.groupBy("bucket").applyInArrow(
        meet, f"{_SPANS}, anchor long, seen boolean, kind string"
    )
    return common.written(met, "segments")


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where any of some sorted columns differs from the row before."""
    new = np.zeros(len(columns[0]), bool)
    new[0] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return new


def repeated_starts(pieces: list[np.ndarray], size: int) -> list[np.ndarray]:
    """For each piece, whether each of its starts begins a string that starts elsewhere too."""
    data = np.concatenate([x for p in pieces for x in (p, np.array([_END], np.uint8))])
    lengths = np.array([len(p) for p in pieces])
    firsts = np.cumsum(lengths + 1) - lengths - 1
    whole = np.zeros(len(data), bool)  # starts of strings that end within their piece
    for first, length in zip(firsts, lengths):
        whole[first:first + length - size + 1] = True
    order = suffix_array(data, size)
    order = order[whole[order]]
    long_ = common_prefixes(data, order, size) >= size
    repeats = np.zeros(len(data), bool)
    repeats[order[long_]] = True
    repeats[order[np.flatnonzero(long_) - 1]] = True
    return [repeats[f:f + n - size + 1] for f, n in zip(firsts, lengths)]


def _sorted_spans(texts: DataFrame, mixed: DataFrame, size: int) -> DataFrame:
    """Spans of the ``mixed`` segments whose strings other segments have too."""
    total = mixed.agg(F.sum(F.col("end") - F.col("start") + size)).first()[0] or 0
    units = total // UNIT_BYTES + 1
    wanted = mixed.groupBy(F.col("text").alias("wanted")).agg(
        F.collect_list(F.struct("anchor", "start", "end", "seen")).alias("ranges")
    )
    chosen = common.packed_once(texts, ["key"]).join(
        wanted, F.col("key") == F.col("wanted")
    ).select("key", "packed", "size", "ranges")

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = common.text_bytes(common.unpacked(batch.column(1), batch.column(2)))
        rows = []
        for row, (key, ranges) in enumerate(
            zip(batch.column(0).to_pylist(), batch.column(3).to_pylist())
        ):
            text = data[offsets[row]:offsets[row + 1]]
            for r in ranges:
                piece = text[r["start"]:r["end"] + size - 1].tobytes()
                rows.append((key, r["start"], r["anchor"], r["seen"], piece))
        columns = list(zip(*rows)) or [[]] * 5
        types = (pa.binary(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)],
            ["text", "start", "anchor", "seen", "piece"],
        )

    def sort(unit: pa.Table) -> pa.Table:
        found: dict[tuple, int] = {}
        for i, k in enumerate(zip(unit.column("text").to_pylist(), unit.column("start").to_pylist())):
            found.setdefault(k, i)  # copies of a text bring their segments again
        unit = unit.take(pa.array(found.values()))
        pieces = [np.frombuffer(p, np.uint8) for p in unit.column("piece").to_pylist()]
        rows = []
        for text, start, seen, repeats in zip(
            unit.column("text").to_pylist(), unit.column("start").to_pylist(),
            unit.column("seen").to_pylist(), repeated_starts(pieces, size),
        ):
            if not seen and repeats.any():
                edges = np.flatnonzero(np.diff(repeats, prepend=False, append=False)) + start
                rows += [(text, a, b + size - 1) for a, b in edges.reshape(-1, 2).tolist()]
        columns = list(zip(*rows)) or [[]] * 3
        types = (pa.binary(), pa.int64(), pa.int64())
        return pa.table(
            [pa.array(c, t) for c, t in zip(columns, types)], ["text", "start", "end"]
        )

    pieces = common.map_batches(
        chosen, cut, "text binary, start long, anchor long, seen boolean, piece binary"
    )
    unit = F.pmod(F.xxhash64("anchor"), F.lit(units)).alias("unit")
    return pieces.select("*", unit).groupBy("unit").applyInArrow(sort, _SPANS)


def _distinct_texts(docs: DataFrame, size: int) -> DataFrame:
    """key, rows, bytes of each text of at least ``size`` bytes."""
    rows = identified(docs).select("key", F.octet_length("text").alias("bytes"))
    grouped = rows.filter(F.col("bytes") >= size).groupBy("key").agg(
        F.count(F.lit(1)).alias("rows"), F.max("bytes").alias("bytes")
    )
    return common.written(grouped, "texts")


def repeated_spans(docs: DataFrame, size: int = 200, keys: DataFrame | None = None) -> DataFrame:
    """(text, start, end): bytes, by text, that a string of ``size`` bytes standing twice covers."""
    texts = identified(docs)
    keys = _distinct_texts(docs, size) if keys is None else keys
    found = [
        keys.filter("rows > 1").select(
            F.col("key").alias("text"), F.lit(0).cast("long").alias("start"),
            F.col("bytes").cast("long").alias("end"),
        )
    ]
    total = keys.agg(F.sum("bytes")).first()[0] or 0
    ranges = F.lit(None).cast("array<struct<start:long,end:long>>")
    level = texts.select("key", "text", ranges.alias("ranges"))
    for window in (2 * size // 5, 7 * size // 10, 9 * size // 10, size):
        per_segment = (size - window + 2) // 2
        met = _meetings(level, window, size, total // per_segment // BUCKET_SEGMENTS + 1)
        found.append(met.filter("kind = 'covered'").select("text", "start", "end"))
        mixed = met.filter("kind = 'mixed'")
        if not mixed.isEmpty():
            found.append(_sorted_spans(texts, mixed, size))
        hot = met.filter("kind = 'hot'")
        if hot.isEmpty():
            break
        total = hot.agg(F.sum(F.col("end") - F.col("start"))).first()[0]
        wanted = hot.groupBy(F.col("text").alias("wanted")).agg(
            F.collect_list(F.struct("start", "end")).alias("ranges")
        )
        level = texts.join(wanted, F.col("key") == F.col("wanted")).select("key", "text", "ranges")
    spans = found[0]
    for more in found[1:]:
        spans = spans.unionByName(more)
    return spans


def remove_repeats(docs: DataFrame, size: int = 200) -> DataFrame:
    """doc_id, n_bytes, removed (maximal runs of start, end) and the kept bytes."""
    keys = _distinct_texts(docs, size)
    spans = repeated_spans(docs, size, keys).groupBy(F.col("text").alias("wanted")).agg(
        F.collect_list(F.struct("start", "end")).alias("ranges")
    )
    # At most HOT_SHARE texts have that share of the rows, which bounds the broadcast. They
    # repeat as a whole, so their rows need no join; a key that matches nothing spreads them.
    total = keys.agg(F.sum("rows")).first()[0] or 0
    hot = keys.filter((F.col("rows") > 1) & (F.col("rows") * HOT_SHARE >= total)).select(
        F.col("key").alias("hot")
    )
    spread = F.unhex(F.md5(F.monotonically_increasing_id().cast("string")))
    texts = identified(docs).join(F.broadcast(hot), F.col("key") == F.col("hot"), "left")
    texts = texts.withColumn("key", F.when(F.col("hot").isNull(), F.col("key")).otherwise(spread))
    whole = F.array(F.struct(
        F.lit(0).cast("long").alias("start"), F.octet_length("text").cast("long").alias("end")
    ))
    joined = texts.join(spans, F.col("key") == F.col("wanted"), "left").withColumn(
        "ranges", F.when(F.col("hot").isNull(), F.col("ranges")).otherwise(whole)
    )

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = common.text_bytes(batch.column(1))
        removed, kept = [], []
        for row, ranges in enumerate(batch.column(2).to_pylist()):
            text = data[offsets[row]:offsets[row + 1]]
            a, b = _merged(
                np.array([r["start"] for r in ranges or ()], np.int64),
                np.array([r["end"] for r in ranges or ()], np.int64),
            )
            keep = np.ones(len(text), bool)
            for start, end in zip(a, b):
                keep[start:end] = False
            removed.append([{"start": s, "end": e} for s, e in zip(a.tolist(), b.tolist())])
            kept.append(text[keep].tobytes())
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0), pa.array(np.diff(offsets)), pa.array(removed, pa.list_(span)),
                pa.array(kept, pa.binary()),
            ],
            ["doc_id", "n_bytes", "removed", "kept"],
        )

    return common.map_batches(
        joined.select("doc_id", "text", "ranges"), cut,
        "doc_id long, n_bytes long, removed array<struct<start:long,end:long>>, kept binary",
    )
