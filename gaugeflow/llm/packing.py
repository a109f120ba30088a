"""Best-fit packing of documents into sequences by bin completion.

Documents longer than a sequence are cut; full pieces are sequences of their own and never
shuffled. The others are dealt at random into groups of bounded size, each packed by one
task. A group starts from a best-fit solution (the incumbent). While that needs more
sequences than its tokens force, a depth-first search tries to need one less: it takes the
largest document left, enumerates the undominated fillings around it, best first, and gives
up a branch as soon as its waste exceeds what one sequence less allows. A filling is dominated
when one larger document left could take the place of one or two of its documents.

A group loses less than one sequence against packing all together, about one in
``GROUP_ITEMS`` documents. The search stops after a number of steps (a parameter, since the
problem is NP-hard); then the incumbent stands. All documents are packed either way.

Defined results: null or empty text is a document of its end token alone; repeated rows are
packed each; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gaugeflow.llm import bpe, common

#: Documents packed by one task.
GROUP_ITEMS = 16_384
#: Steps of the search for one sequence less, in each group.
SEARCH_STEPS = 200_000


def best_fit(counts: list[int], size: int) -> list[list[int]]:
    """Best-fit decreasing: each length goes to the fullest sequence that has room."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0
    for length in range(len(counts) - 1, 0, -1):
        for _ in range(counts[length]):
            fits = rooms >> length
            if fits:
                room = length + (fits & -fits).bit_length() - 1
                target = by_room[room].pop()
                if not by_room[room]:
                    rooms &= ~(1 << room)
            else:
                room, target = size, len(bins)
                bins.append([])
            bins[target].append(length)
            left = room - length
            if left:
                by_room.setdefault(left, []).append(target)
                rooms |= 1 << left
    return bins


class _Steps:
    def __init__(self, most: int):
        self.left = most

    def take(self) -> None:
        self.left -= 1
        if self.left < 0:
            raise TimeoutError


def fillings(
    counts: list[int], room: int, most_waste: int, steps: _Steps
) -> Iterator[tuple[int, list[int]]]:
    """Undominated fillings of ``room`` with the lengths left: (waste, lengths), best first."""
    lengths = [n for n in range(min(room, len(counts) - 1), 0, -1) if counts[n]]
    below = [0] * (len(lengths) + 1)
    for i in range(len(lengths) - 1, -1, -1):
        below[i] = below[i + 1] + lengths[i] * counts[lengths[i]]

    def exact(i: int, target: int) -> Iterator[list[int]]:
        steps.take()
        if target == 0:
            yield []
            return
        while i < len(lengths) and lengths[i] > target:
            i += 1
        for k in range(i, len(lengths)):
            if below[k] < target:
                return
            n = lengths[k]
            for times in range(min(counts[n], target // n), 0, -1):
                for rest in exact(k + 1, target - n * times):
                    yield [n] * times + rest

    def dominated(filling: list[int], waste: int) -> bool:
        used: dict[int, int] = {}
        for n in filling:
            used[n] = used.get(n, 0) + 1
        several = [(n,) for n in used] + [
            (a, b) for a in used for b in used if a < b or (a == b and used[a] > 1)
        ]
        for part in several:
            least = sum(part) + (len(part) == 1)
            for n in range(least, min(sum(part) + waste, len(counts) - 1) + 1):
                if counts[n] > used.get(n, 0):
                    return True
        return False

    for waste in range(min(most_waste, room) + 1):
        for filling in exact(0, room - waste):
            if not dominated(filling, waste):
                yield waste, filling


def complete(counts: list[int], size: int, bins: int, steps: _Steps) -> list[list[int]] | None:
    """A packing into at most ``bins`` sequences, or None if there is none."""
    counts = list(counts)
    left = sum(counts)
    budget = bins * size - sum(n * c for n, c in enumerate(counts))
    if budget < 0:
        return None

    def open_bin() -> tuple[int, Iterator]:
        largest = max(n for n, c in enumerate(counts) if c)
        counts[largest] -= 1
        return largest, fillings(counts, size - largest, budget, steps)

    if not left:
        return []
    stack = [(*open_bin(), 0, None)]
    while stack:
        largest, options, waste, filling = stack.pop()
        if filling is not None:
            budget += waste
            left += 1 + len(filling)
            for n in filling:
                counts[n] += 1
        option = next(options, None)
        if option is None:
            counts[largest] += 1
            continue
        waste, filling = option
        budget -= waste
        left -= 1 + len(filling)
        for n in filling:
            counts[n] -= 1
        stack.append((largest, options, waste, filling))
        if not left:
            return [[largest, *filling] for largest, _, _, filling in stack]
        stack.append((*open_bin(), 0, None))
    return None


def pack_lengths(
    lengths: np.ndarray, size: int, search_steps: int = SEARCH_STEPS
) -> tuple[np.ndarray, np.ndarray]:
    """The sequence (from 0) and the offset of each item of 1 to ``size`` tokens."""
    counts = np.bincount(lengths, minlength=size + 1).tolist()
    bins = best_fit(counts, size)
    steps = _Steps(search_steps)
    try:
        while len(bins) > -(-int(lengths.sum()) // size):
            better = complete(counts, size, len(bins) - 1, steps)
            if better is None:
                break
            bins = better
    except TimeoutError:
        pass
    items = iter(np.argsort(-lengths, kind="stable").tolist())
    slots: dict[int, list[tuple[int, int]]] = {}
    for number, filling in enumerate(bins):
        offset = 0
        for n in filling:
            slots.setdefault(n, []).append((number, offset))
            offset += n
    sequence, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for item in items:
        sequence[item], offsets[item] = slots[int(lengths[item])].pop()
    return sequence, offsets


class LibraryEncoder(bpe.TrieEncoder):
    """Words as the vocabulary cuts them, encoded by the tokenizers library one by one.

    The ids are the same; where they are all that is wanted, this is cheaper than the trie,
    whose tables it does without.
    """

    def __init__(self, path: str):
        library = Tokenizer.from_file(path)
        self._open(library, decodes=False)
        self.model = library.model
        for word, ids in self.fixed.items():
            self.know(word, ids)

    def learn(self, words: set[str]) -> None:
        self.make_room(words)
        for word in words - self.ids.keys():
            self.know(word, [t.id for t in self.model.tokenize(self.mapped(word))])


@functools.cache
def _library(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


def cut(docs: DataFrame, vocabulary: str, size: int) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids_crc32."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoded = _library(vocabulary).encode(batch.column(1).to_pylist())
        row, piece, start, length, crc = [], [], [], [], []
        for n, (ids, _) in enumerate(encoded):
            ids += b"\0\0\0\0"  # the end token
            for number, at in enumerate(range(0, len(ids), 4 * size)):
                part = ids[at:at + 4 * size]
                row.append(n)
                piece.append(number)
                start.append(at // 4)
                length.append(len(part) // 4)
                crc.append(zlib.crc32(part))
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                *(pa.array(x, pa.int64()) for x in (start, length, crc)),
            ],
            ["doc_id", "piece", "start", "length", "ids_crc32"],
        )

    return common.map_batches(
        common.texts(docs), run,
        "doc_id long, piece int, start long, length long, ids_crc32 long",
    )


def pack(
    items: DataFrame, size: int, group_items: int = GROUP_ITEMS, search_steps: int = SEARCH_STEPS
) -> DataFrame:
    """``items`` (a written table with a column length) with sequence_id and offset."""
    numbered = items.withColumn("number", F.monotonically_increasing_id())
    short = numbered.filter(F.col("length") < size)
    groups = -(-short.count() // group_items) or 1
    columns = items.columns

    def run(group: pa.Table) -> pa.Table:
        number = group.column("group")[0].as_py()
        lengths = group.column("length").to_numpy()
        sequence, offset = pack_lengths(lengths, size, search_steps)
        out = group.select(columns)
        out = out.append_column("sequence_id", pa.array((number << 32) + sequence))
        return out.append_column("offset", pa.array(offset))

    kinds = ", ".join(f"`{n}` {t}" for n, t in items.dtypes)
    packed = (
        short.withColumn("group", F.pmod(F.xxhash64("number"), F.lit(groups)))
        .groupBy("group").applyInArrow(run, f"{kinds}, sequence_id long, offset long")
    )
    full = numbered.filter(F.col("length") >= size).select(
        *columns, (-F.col("number") - 1).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return packed.unionByName(full)


def pack_documents(
    docs: DataFrame, vocabulary: str, size: int = 2048, group_items: int = GROUP_ITEMS
) -> DataFrame:
    """The pieces of all documents and their places."""
    return pack(common.written(cut(docs, vocabulary, size), "pieces"), size, group_items)
