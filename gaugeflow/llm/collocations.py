"""Phrase collocations from an FM-index for each shard of a corpus.

A shard holds some documents as word ids, with breaks where punctuation or a document ends.
Its index is the Burrows-Wheeler transform of that sequence and of its reverse, ordered by as
many words as a phrase may have. An interval of the transform is a phrase with its count;
extending all intervals of a length at once to the left (or, in step with them, those of the
reverse to the right) enumerates the phrases that are one word longer. Counts are summed
across shards.

No phrase is more frequent than a part of it, so shards learn twice what is frequent in the
whole corpus: words (all others become breaks) and pairs. Longer phrases are extended from
frequent pairs by frequent pairs only. Nothing else is left out, and nothing is capped.

Shards are cut between pieces, at ``SHARD_WORDS`` words. They send what they count packed, by
buckets of hashed words or phrases, ``BUCKET_ENTRIES`` to a bucket, and get back ids of words
and a bit for each pair. What a task holds is one shard or one bucket.

Defined results: null text is empty, a null ``lang`` is ``und``. Repeated rows count each. An
empty table, or one without a frequent phrase, gives an empty result. Other columns are not
read.
"""

from __future__ import annotations

import functools
import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm import common
from gaugeflow.llm.hashing import RollingHash, mixed

UNKNOWN = "und"
#: Words of a shard, and bytes of a text that are split at once.
SHARD_WORDS, CHUNK_BYTES = 1 << 21, 1 << 20
#: Counts (one for each shard and word or phrase) that are summed by one task at once.
BUCKET_ENTRIES = 1 << 20
LONGEST = 4

_PARTS = 16
_BREAK = b"."
#: Bytes that end a piece become breaks; A-Z become lower case.
_PIECES = bytes(ord(_BREAK) if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256))


def sealed(*columns: np.ndarray | bytes) -> bytes:
    """Arrays on end, compressed, after their size."""
    data = b"".join(c if isinstance(c, bytes) else np.ascontiguousarray(c).tobytes() for c in columns)
    return len(data).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(data, asbytes=True)


def opened(data: bytes) -> bytes:
    return pa.Codec("zstd").decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)


def _columns(data: bytes, *kinds: str) -> list[np.ndarray]:
    """Columns of equal length that :func:`sealed` has put on end."""
    plain = opened(data)
    n, at, found = len(plain) // sum(np.dtype(k).itemsize for k in kinds), 0, []
    for kind in kinds:
        found.append(np.frombuffer(plain, kind, n, at))
        at += found[-1].nbytes
    return found


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct sorted values, and where each starts."""
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, int)
    return keys[starts], starts


class _WordIds(dict):
    """Numbers words as they come; breaks are 0."""

    def __init__(self, following):
        super().__init__({_BREAK: 0})
        self.following = following

    def __missing__(self, word: bytes) -> int:
        number = self[word] = self.following()
        return number


class ShardBuilder:
    """Word ids of the documents of a shard, and its words by language."""

    def __init__(self):
        self.words: dict[str, _WordIds] = {}
        self.following = itertools.count(1).__next__
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, lang: str, data: bytes) -> None:
        """A stretch of whole pieces, in lower case and with breaks for what ends a piece."""
        ids = self.words.get(lang)
        if ids is None:
            ids = self.words[lang] = _WordIds(self.following)
        found = data.replace(_BREAK, b" . ").split()
        self.parts.append(np.fromiter(map(ids.__getitem__, found), np.int32, len(found)))
        self.parts.append(np.zeros(1, np.int32))
        self.size += len(found) + 1

    def rows(self, number: int) -> pa.RecordBatch:
        """The shard, and for each language its words with their ids and counts."""
        ids = np.concatenate(self.parts)
        counts = np.bincount(ids)
        rows = [{"shard": number, "ids": sealed(ids), "size": len(ids)}]
        for lang, words in self.words.items():
            del words[_BREAK]
            if not words:
                continue
            local = np.fromiter(words.values(), np.int32, len(words))
            sizes = np.fromiter(map(len, words), np.int32, len(words))
            rows.append({
                "shard": number, "lang": lang, "n_words": len(words),
                "words": sealed(local, counts[local].astype(np.int32), sizes, b"".join(words)),
            })
        return pa.RecordBatch.from_pylist(rows, pa.schema([
            ("shard", pa.int64()), ("ids", pa.binary()), ("size", pa.int64()),
            ("lang", pa.string()), ("words", pa.binary()), ("n_words", pa.int64()),
        ]))


def stretches(text: str) -> Iterator[bytes]:
    """The bytes of a text in stretches of whole pieces."""
    data = text.encode().lower().translate(_PIECES)
    while len(data) > CHUNK_BYTES:
        end = data.find(_BREAK, CHUNK_BYTES)
        if end < 0:
            break
        yield data[:end]
        data = data[end + 1:]
    yield data


def shards(docs: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Rows of shards (ids, size) and of their words by language (lang, words, n_words)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        shard = ShardBuilder()
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for stretch in stretches(text):
                    shard.add(lang, stretch)
                    if shard.size >= shard_words:
                        yield shard.rows(number)
                        shard, number = ShardBuilder(), number + 1
        if shard.size:
            yield shard.rows(number)

    rows = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"),
        common.text_or_empty().alias("text"),
    )
    return rows.mapInArrow(
        run, "shard long, ids binary, size long, lang string, words binary, n_words long"
    )


class FmIndex:
    """Counts of word sequences by intervals of the Burrows-Wheeler transform.

    ``words`` are numbers from 0 (a break) to ``largest`` and end with a break; suffixes are
    ordered by their first ``depth`` words, which orders intervals of up to that many.
    """

    def __init__(self, words: np.ndarray, largest: int, depth: int = LONGEST):
        size = len(words)
        rank = words.astype(np.int64)
        order, span = np.argsort(rank, kind="stable"), 1
        while span < depth:
            following = np.zeros(size, np.int64)
            following[:-span] = rank[span:]
            keys = rank * (int(rank.max()) + 1) + following
            order = np.argsort(keys, kind="stable")
            ordered = keys[order]
            rank[order] = np.cumsum(np.append(0, ordered[1:] != ordered[:-1]))
            span *= 2
        self.largest = largest
        self.before = words[order - 1].astype(np.int64)  # the transform
        self.first = np.searchsorted(words[order], np.arange(largest + 2))
        by_word = np.argsort(self.before, kind="stable")
        self.places = self.before[by_word] * size + by_word
        self.size = size

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of all single words from 1 on."""
        return self.first[1:-1], self.first[2:]

    def extended(
        self, low: np.ndarray, high: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All extensions of disjoint intervals by the word before them.

        For each: the interval's number, the word, the new interval's start, the count, and
        how many smaller words (breaks included) stand before the interval, which is where
        the extension starts within the interval of the reverse.
        """
        lengths = high - low
        owner = np.repeat(np.arange(len(low)), lengths)
        starts = np.cumsum(lengths) - lengths
        rows = np.arange(int(lengths.sum())) - np.repeat(starts - low, lengths)
        width = self.largest + 1
        pairs, counts = np.unique(owner * width + self.before[rows], return_counts=True)
        owner, word = pairs // width, pairs % width
        smaller = np.cumsum(counts) - counts - starts[owner]
        real = word > 0
        owner, word, counts, smaller = owner[real], word[real], counts[real], smaller[real]
        start = np.searchsorted(self.places, word * self.size + low[owner])
        return owner, word, start, counts, smaller


def translated(ids: np.ndarray, known: np.ndarray) -> np.ndarray:
    """``ids`` as 1 + their place in ``known`` (sorted), all others as one break between words."""
    number = np.zeros(int(max(ids.max(initial=0), known.max(initial=0))) + 1, np.int32)
    number[known] = np.arange(1, len(known) + 1)
    words = np.concatenate([np.zeros(1, np.int32), number[ids], np.zeros(1, np.int32)])
    again = np.append(False, (words[1:] == 0) & (words[:-1] == 0))
    return words[~again]


def _unpacked_words(data: bytes, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
    """Local ids, counts, offsets and bytes of ``n`` words."""
    plain = opened(data)
    local, counts, sizes = np.frombuffer(plain, np.int32, 3 * n).reshape(3, n)
    return local, counts, np.append(0, np.cumsum(sizes, dtype=np.int64)), plain[12 * n:]


def _dealt_words(pieces: DataFrame, buckets: int) -> DataFrame:
    """bucket, shard, lang, words, n_words: the words of each shard by their hash."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for row in batch.to_pylist():
            local, counts, offsets, data = _unpacked_words(row["words"], row["n_words"])
            hashes = RollingHash(np.frombuffer(data, np.uint8)).of(offsets[:-1], offsets[1:])
            seed = np.uint64(zlib.crc32(row["lang"].encode()))
            bucket = (mixed(hashes + seed) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            for number, own in zip(*_split(bucket, order)):
                found = [data[offsets[i]:offsets[i + 1]] for i in own.tolist()]
                sizes = np.array([len(w) for w in found], np.int32)
                rows.append({
                    "bucket": number, "shard": row["shard"], "lang": row["lang"], "n_words": len(own),
                    "words": sealed(local[own], counts[own], sizes, b"".join(found)),
                })
        return pa.RecordBatch.from_pylist(rows, pa.schema([
            ("bucket", pa.int64()), ("shard", pa.int64()), ("lang", pa.string()),
            ("words", pa.binary()), ("n_words", pa.int64()),
        ]))

    return common.map_batches(
        pieces.filter(F.col("words").isNotNull()).select("shard", "lang", "words", "n_words"), run,
        "bucket long, shard long, lang string, words binary, n_words long",
    )


def _split(bucket: np.ndarray, order: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """The buckets, and of ``order`` (sorted by bucket) the part that belongs to each."""
    values, starts = _runs(bucket[order])
    return values.tolist(), np.split(order, starts[1:]) if len(starts) else []


def _frequent_words(least: int):
    """Of a bucket: frequent words (id, lang, word, f), what shards need to know of them
    (shard, known: local ids and ids), and how many words a language has there (lang, n)."""
    schema = pa.schema([
        ("shard", pa.int64()), ("known", pa.binary()), ("id", pa.int64()), ("lang", pa.string()),
        ("word", pa.string()), ("f", pa.int64()), ("n", pa.int64()),
    ])

    def run(bucket: pa.Table) -> pa.Table:
        number = bucket.column("bucket")[0].as_py()
        locals_, counts, words, sizes = [], [], [], bucket.column("n_words").to_numpy()
        for data, n in zip(bucket.column("words").to_pylist(), sizes.tolist()):
            local, count, offsets, plain = _unpacked_words(data, n)
            locals_.append(local)
            counts.append(count)
            words.append(pa.Array.from_buffers(
                pa.large_binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(plain)]
            ))
        counts = np.concatenate(counts).astype(np.int64)
        words = pa.concat_arrays(words).dictionary_encode()
        langs = bucket.column("lang").combine_chunks().dictionary_encode()
        lang_of = np.repeat(langs.indices.to_numpy(), sizes)
        keys = lang_of.astype(np.int64) * len(words.dictionary) + words.indices.to_numpy()
        order = np.argsort(keys, kind="stable")
        distinct, starts = _runs(keys[order])
        f = np.add.reduceat(counts[order], starts)
        frequent = f >= least
        ids = np.where(frequent, (number << 40) + np.cumsum(frequent), 0)
        of_entry = np.empty(len(keys), np.int64)
        of_entry[order] = np.repeat(ids, np.diff(starts, append=len(keys)))
        known, at = [], 0
        for shard, local in zip(bucket.column("shard").to_pylist(), locals_):
            own = of_entry[at:at + len(local)]
            at += len(local)
            if own.any():
                known.append({"shard": shard, "known": sealed(local[own > 0], own[own > 0])})
        totals = np.zeros(len(langs.dictionary), np.int64)
        np.add.at(totals, distinct // len(words.dictionary), f)
        spelt = words.dictionary.take(pa.array(distinct[frequent] % len(words.dictionary)))
        found = pa.table({
            "id": pa.array(ids[frequent]), "f": pa.array(f[frequent]),
            "word": spelt.cast(pa.large_string()).cast(pa.string()),
            "lang": langs.dictionary.take(pa.array(distinct[frequent] // len(words.dictionary))),
        })
        parts = [
            found, pa.Table.from_pylist(known, pa.schema([schema.field("shard"), schema.field("known")])),
            pa.table({"lang": langs.dictionary, "n": pa.array(totals)}),
        ]
        return pa.concat_tables(parts, promote_options="default").select(schema.names).cast(schema)

    return run, "shard long, known binary, id long, lang string, word string, f long, n long"


def _dealt(keys: list[np.ndarray], counts: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray, bytes]]:
    """Bucket after bucket of hashed keys: its number, its entries' places, and these packed."""
    hashes = np.zeros(len(counts), np.uint64)
    for key in keys:
        hashes = mixed(hashes * np.uint64(31) + key.astype(np.uint64))
    bucket = (hashes % np.uint64(buckets)).astype(np.int64)
    for number, own in zip(*_split(bucket, np.argsort(bucket, kind="stable"))):
        yield number, own, sealed(*(key[own] for key in keys), counts[own].astype(np.int32))


class _Shard:
    """A shard in terms of frequent words: its sequence, and their ids."""

    def __init__(self, ids: bytes, known: list[bytes]):
        columns = [_columns(data, "<i4", "<i8") for data in known]
        local, self.ids = (np.concatenate(c) for c in zip(*columns))
        order = np.argsort(local)
        self.ids = self.ids[order]
        self.text = translated(np.frombuffer(opened(ids), np.int32), local[order])

    def pairs(self, index: FmIndex) -> tuple[np.ndarray, ...]:
        """First and second word (from 0), start and count, and smaller words before."""
        second, first, start, counts, smaller = index.extended(*index.words())
        return first - 1, second, start, counts, smaller


_PACKED = pa.schema([("bucket", pa.int64()), ("shard", pa.int64()), ("entries", pa.binary())])


def _pairs(buckets: int):
    """Pairs of frequent words in a shard, packed by buckets."""
    def run(shard: pa.Table, known: pa.Table) -> pa.Table:
        if not shard.num_rows or not known.num_rows:
            return _PACKED.empty_table()
        number = shard.column("shard")[0].as_py()
        own = _Shard(shard.column("ids")[0].as_py(), known.column("known").to_pylist())
        first, second, _, counts, _ = own.pairs(FmIndex(own.text, len(own.ids), depth=2))
        return pa.Table.from_pylist([
            {"bucket": bucket, "shard": number, "entries": entries}
            for bucket, _, entries in _dealt([own.ids[first], own.ids[second]], counts, buckets)
        ], _PACKED)

    return run, "bucket long, shard long, entries binary"


def _frequent(size: int, least: int):
    """Of a bucket of packed phrases: the frequent ones (w1 ..., a), and for each shard which
    of its entries are frequent (shard, bucket, bits)."""
    words = [f"w{i}" for i in range(1, size + 1)]
    schema = pa.schema([
        *((w, pa.int64()) for w in words), ("a", pa.int64()), ("shard", pa.int64()),
        ("bucket", pa.int64()), ("bits", pa.binary()),
    ])

    def run(table: pa.Table) -> pa.Table:
        parts = [_columns(e, *["<i8"] * size, "<i4") for e in table.column("entries").to_pylist()]
        *keys, counts = (np.concatenate(column) for column in zip(*parts))
        order = np.lexsort(keys[::-1])
        new = np.zeros(len(order), bool)
        new[:1] = True
        for key in keys:
            new[1:] |= np.diff(key[order]) != 0
        starts = np.flatnonzero(new)
        sums = np.add.reduceat(counts[order].astype(np.int64), starts)
        frequent = sums >= least
        found = pa.table({
            **{w: pa.array(key[order][starts][frequent]) for w, key in zip(words, keys)},
            "a": pa.array(sums[frequent]),
        })
        bits = np.empty(len(order), bool)
        bits[order] = np.repeat(frequent, np.diff(starts, append=len(order)))
        marks, at = [], 0
        for shard, part in zip(table.column("shard").to_pylist(), parts):
            own = bits[at:at + len(part[0])]
            at += len(own)
            if own.any() and shard is not None:
                marks.append({"shard": shard, "bucket": table.column("bucket")[0].as_py(),
                              "bits": sealed(np.packbits(own))})
        kept = pa.schema([schema.field(n) for n in ("shard", "bucket", "bits")])
        return pa.concat_tables(
            [found, pa.Table.from_pylist(marks, kept)], promote_options="default"
        ).select(schema.names).cast(schema)

    return run, ", ".join([*(f"{w} long" for w in words), "a long, shard long, bucket long, bits binary"])


def _longer(buckets: int):
    """Phrases of three and four words whose pairs are all frequent, packed by buckets; the
    fourth word is 0 for three."""
    def run(shard: pa.Table, about: pa.Table) -> pa.Table:
        marks = {r["bucket"]: r["bits"] for r in about.to_pylist() if r["bits"] is not None}
        known = [k for k in about.column("known").to_pylist() if k is not None]
        if not shard.num_rows or not marks:
            return _PACKED.empty_table()
        own = _Shard(shard.column("ids")[0].as_py(), known)
        width = len(own.ids)
        forward = FmIndex(own.text, width)
        a, b, start, counts, smaller = own.pairs(forward)
        keep = np.zeros(len(a), bool)
        for bucket, places, _ in _dealt([own.ids[a], own.ids[b]], counts, buckets):
            if bucket in marks:
                bits = np.frombuffer(opened(marks[bucket]), np.uint8)
                keep[places] = np.unpackbits(bits, count=len(places))
        # The reverse of a word's interval starts where the word's own does.
        reverse_start = forward.words()[0][b] + smaller
        a, b, start, counts, reverse_start = (x[keep] for x in (a, b, start, counts, reverse_start))
        frequent = np.sort(a * width + b)

        def is_frequent(first: np.ndarray, second: np.ndarray) -> np.ndarray:
            pairs = first * width + second
            found = np.minimum(np.searchsorted(frequent, pairs), len(frequent) - 1)
            return frequent[found] == pairs

        # One word to the left: (c, a, b).
        owner, c, _, counts, smaller = forward.extended(start, start + counts)
        c = c - 1
        keep = is_frequent(c, a[owner])
        owner, c, counts = owner[keep], c[keep], counts[keep]
        reverse_start = reverse_start[owner] + smaller[keep]
        three = c, a[owner], b[owner]
        # One word to the right, in the reverse: (c, a, b, d).
        reverse = FmIndex(own.text[::-1], width)
        number, d, _, longer, _ = reverse.extended(reverse_start, reverse_start + counts)
        d = d - 1
        keep = is_frequent(three[2][number], d)
        number, d, longer = number[keep], d[keep], longer[keep]
        phrases = [
            np.concatenate([own.ids[w], own.ids[w[number]]]) for w in three
        ] + [np.concatenate([np.zeros(len(c), np.int64), own.ids[d]])]
        return pa.Table.from_pylist([
            {"bucket": bucket, "shard": None, "entries": entries}
            for bucket, _, entries in _dealt(phrases, np.concatenate([counts, longer]), buckets)
        ], _PACKED)

    return run, "bucket long, shard long, entries binary"


def phrases(docs: DataFrame, least: int = 30, shard_words: int = SHARD_WORDS) -> tuple[DataFrame, ...]:
    """Phrases of two to four words with at least ``least`` occurrences, and their words.

    The phrases have w1 to w4 (ids of words, 0 beyond the end), size, a (occurrences). With
    them come the words (id, lang, word, f) and each language's n.
    """
    pieces = common.written(shards(docs, shard_words), "shards")
    n_words, size = pieces.agg(F.sum("n_words"), F.sum("size")).first()
    buckets = (size or 0) // BUCKET_ENTRIES + 1
    run, fields = _frequent_words(least)
    about = common.written(
        _dealt_words(pieces, (n_words or 0) // BUCKET_ENTRIES + 1).groupBy("bucket").applyInArrow(run, fields),
        "words",
    )
    words = about.filter(F.col("id").isNotNull()).select("id", "lang", "word", "f")
    totals = about.filter(F.col("n").isNotNull()).groupBy("lang").agg(F.sum("n").alias("n"))
    known = about.filter(F.col("known").isNotNull()).select(F.col("shard").alias("home"), "known")
    texts = pieces.filter(F.col("ids").isNotNull()).select("shard", "ids")
    run, fields = _pairs(buckets)
    packed = texts.groupBy("shard").cogroup(known.groupBy("home")).applyInArrow(run, fields)
    run, fields = _frequent(2, least)
    pairs = common.written(packed.groupBy("bucket").applyInArrow(run, fields), "pairs")
    marks = pairs.filter(F.col("bits").isNotNull()).select(
        F.col("shard").alias("home"), F.lit(None).cast("binary").alias("known"), "bucket", "bits"
    )
    both = known.select(
        "home", "known", F.lit(None).cast("long").alias("bucket"), F.lit(None).cast("binary").alias("bits")
    ).unionByName(marks)
    run, fields = _longer(buckets)
    packed = texts.groupBy("shard").cogroup(both.groupBy("home")).applyInArrow(run, fields)
    run, fields = _frequent(4, least)
    longer = packed.groupBy("bucket").applyInArrow(run, fields).select("w1", "w2", "w3", "w4", "a")
    nothing = F.lit(0).cast("long")
    two = pairs.filter(F.col("a").isNotNull()).select(
        "w1", "w2", nothing.alias("w3"), nothing.alias("w4"), "a"
    )
    count = F.when(F.col("w3") == 0, 2).when(F.col("w4") == 0, 3).otherwise(4)
    return common.written(longer.unionByName(two).withColumn("size", count), "phrases"), words, totals


def _score(a: Column, l: Column, r: Column) -> Column:  # noqa: E741
    """floor(2000000 a / (l + r)), in whole numbers of up to 38 digits."""
    wide = "decimal(38,0)"
    return F.call_function(
        "div", a.cast("decimal(20,0)").cast(wide) * F.lit(2_000_000).cast("decimal(7,0)"),
        (l + r).cast(wide),
    )


def scored(found: DataFrame, words: DataFrame) -> DataFrame:
    """Phrases with lang, l, r and score of their worst cut, without those that a longer one holds."""
    def counts(size: int, places: list[int], name: str) -> DataFrame:
        """The counts of all phrases of a size (words for 1), for those at ``places`` of others."""
        if size == 1:
            return words.select(F.col("id").alias(f"w{places[0]}"), F.col("f").alias(name))
        return found.filter(F.col("size") == size).select(
            *(F.col(f"w{i}").alias(f"w{place}") for i, place in enumerate(places, 1)), F.col("a").alias(name)
        )

    def with_parts(size: int) -> DataFrame:
        whole = found.filter(F.col("size") == size)
        for k in range(1, size):
            for name, places in ((f"left{k}", range(1, k + 1)), (f"right{k}", range(k + 1, size + 1))):
                places = list(places)
                whole = whole.join(counts(len(places), places, name), [f"w{i}" for i in places])
        for k in range(size, LONGEST):
            whole = whole.withColumns({f"left{k}": F.lit(None).cast("long"), f"right{k}": F.lit(None).cast("long")})
        return whole

    langs = words.select(F.col("id").alias("w1"), "lang")
    both = functools.reduce(
        DataFrame.unionByName, [with_parts(size) for size in range(2, LONGEST + 1)]
    ).join(langs, "w1")

    def cut(k: int, left: str, right: str) -> Column:
        l, r = F.col(left), F.col(right)  # noqa: E741
        return F.struct(_score(F.col("a"), l, r).alias("score"), F.lit(k).alias("k"), l.alias("l"), r.alias("r"))

    worst = F.least(*(
        F.when(F.col("size") > k, cut(k, f"left{k}", f"right{k}")) for k in range(1, LONGEST)
    ))

    # What holds a phrase holds it with one more word before or after it, at least as often.
    def part(*names: str) -> Column:
        third = F.col(names[2]) if len(names) > 2 else F.lit(0).cast("long")
        return F.struct(F.col(names[0]).alias("w1"), F.col(names[1]).alias("w2"), third.alias("w3"))

    held = F.when(F.col("size") == 3, F.array(part("w1", "w2"), part("w2", "w3"))).otherwise(
        F.array(part("w1", "w2", "w3"), part("w2", "w3", "w4"))
    )
    extensions = (
        found.filter("size > 2").select(F.explode(held).alias("part"), "a")
        .groupBy("part").agg(F.max("a").alias("longer")).select("part.*", "longer")
    )
    shorter = both.filter("size < 4").join(extensions, ["w1", "w2", "w3"], "left").filter(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * 80)
    ).drop("longer")
    return shorter.unionByName(both.filter("size = 4")).select(
        "lang", *(f"w{i}" for i in range(1, LONGEST + 1)), "a", worst.alias("cut")
    ).select("*", "cut.l", "cut.r", "cut.score").drop("cut")


def collocations(
    docs: DataFrame, least: int = 30, most: int = 2000, shard_words: int = SHARD_WORDS
) -> DataFrame:
    """Each language's ``most`` best phrases: lang, rank, phrase, a, l, r, n, score."""
    found, words, totals = phrases(docs, least, shard_words)
    best = scored(found, words).withColumn(
        "part", F.pmod(F.xxhash64("w1", "w2", "w3", "w4"), F.lit(_PARTS))
    )
    # First within parts of a language; what ties with the last stays until words decide.
    for group in (["lang", "part"], ["lang"]):
        order = Window.partitionBy(*group).orderBy(F.desc("score"), F.desc("a"))
        best = best.withColumn("place", F.rank().over(order)).filter(F.col("place") <= most).drop("place")
    best = common.written(best.drop("part"), "best-phrases")
    ids = [f"w{i}" for i in range(1, LONGEST + 1)]
    spelt = (
        best.select(*ids, F.posexplode(F.array(*ids)).alias("at", "id")).filter("id > 0")
        .join(words.select("id", "word"), "id").groupBy(*ids)
        .agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("words"))
        .select(*ids, F.array_join(F.col("words.word"), " ").alias("phrase"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        best.join(spelt, ids).withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= most).join(totals, "lang")
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )
