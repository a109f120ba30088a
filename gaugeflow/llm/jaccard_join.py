"""Near-duplicates by n-gram Jaccard similarity: a universe-partition pigeonhole join.

Documents are sets of hashed word shingles; equal sets are one node from the start. Sets of a
size band hash their shingles into the band's segments. Two similar sets differ in few
shingles, so some segments are equal, or differ by one shingle: signatures are a segment's
shingles, and where the band's allocation says so also its one-deletion neighbourhood. How
many segments a band has, and whether they use neighbourhoods, is chosen by cost from the
sizes of all documents.

Bands have more segments than similar sets can differ in, so similar sets share several
signatures. Some say nothing: those of empty segments, which are left out, and hot ones that
more than ``HOT_SIGNATURE`` sets have, whose pairs are not looked at. Pairs of sets under the
other signatures are counted, and what shares as many as the band has to spare, less what
says nothing in either set, is a candidate. A set in which more says nothing than the band
can spare keeps those signatures, and meets the others like it as a star. So nothing is lost,
and no group of more than a few sets is ever paired.

Connected candidates make clusters. They are verified exactly in blocks of bounded size:
small ones together, large ones as pairs of blocks of similar set sizes. What links is joined
to components.

Shingles are 64-bit hashes, nodes 128-bit digests of sets.

Defined results: null text, or text without words, is an empty set and links with nothing. A
text with fewer words than a shingle is one shingle. Equal rows are copies of each other.
Null ``doc_id``s link like others but name no component, unless there is no other. Other
columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm import common
from gaugeflow.llm.components import components
from gaugeflow.llm.hashing import RollingHash, mixed

#: Signatures of a bucket, and shingles of a block that one task verifies.
BUCKET_SIGNATURES, BLOCK_SHINGLES = 2_000_000, 500_000
#: A signature of more sets than this is hot: it says nothing, and its pairs are not counted.
HOT_SIGNATURE = 32
#: Size bands grow by this factor.
BAND_GROWTH = 1.4
#: What verifying a pair costs, in signatures.
PAIR_COST = 20.0

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A"):ord("Z") + 1] += 32
_WORDS_AT_ONCE = 100_000  # bounds the memory that a very long text takes
_STEP = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64((1 << 48) - 1)  # what a bucket keeps of a signature


def shingle_sets(column: pa.Array, words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, offsets = common.text_bytes(column)
    folded = _FOLD[data]
    white = _WHITE[folded]
    sets = []
    for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        edges = np.flatnonzero(np.diff(white[start:end], prepend=True, append=True))
        if not len(edges):
            sets.append(np.zeros(0, np.uint64))
            continue
        firsts, lasts, hashes = edges[0::2], edges[1::2], []
        for at in range(0, len(firsts), _WORDS_AT_ONCE):
            a, b = firsts[at:at + _WORDS_AT_ONCE], lasts[at:at + _WORDS_AT_ONCE]
            part = folded[start + a[0]:start + b[-1]]
            hashes.append(RollingHash(part).of(a - a[0], b - a[0]))
        hashes = np.concatenate(hashes)
        n = min(words, len(hashes))
        shingles = np.full(len(hashes) - n + 1, np.uint64(n))
        for i in range(n):
            shingles = shingles * _STEP + hashes[i:i + len(shingles)]
        sets.append(np.unique(mixed(shingles)))
    return sets


def node_of(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def short_of(node: bytes) -> int:
    """What candidates are told apart by: if two nodes share it, both are verified."""
    return int.from_bytes(node[:8], "little", signed=True)


@dataclass(frozen=True)
class Similarity:
    """Jaccard similarity of at least ``percent`` over shingles of ``words`` words."""

    words: int
    percent: int

    def linked(self, common_: np.ndarray, sizes: np.ndarray, size: int) -> np.ndarray:
        return 100 * common_ >= self.percent * (sizes + size - common_)

    def difference(self, smaller: int) -> int:
        """The most shingles by which a set of this size differs from a similar larger one."""
        larger = 100 * smaller // self.percent
        return (smaller + larger) * (100 - self.percent) // (100 + self.percent)

    @functools.cached_property
    def smallest(self) -> int:
        """Sets below this size link with equal ones only."""
        size = 1
        while not self.difference(size):
            size += 1
        return size

    def bands(self, largest: int) -> list[int]:
        """The smallest size of each band, and the end of the last."""
        bounds = [self.smallest]
        while bounds[-1] <= max(largest, self.smallest):
            bounds.append(math.ceil(bounds[-1] * BAND_GROWTH))
        return bounds


@dataclass(frozen=True)
class Allocation:
    """How a band is indexed: by how many segments, and if with one-deletion neighbourhoods."""

    segments: int
    deletions: bool
    #: Segments that a similar pair shares at least.
    shared: int


def _tail(n: int, p: float, more_than: int) -> float:
    """The chance that more than so many of ``n`` are hit, each with chance ``p`` (normal or exact)."""
    if n * p > 30:
        z = (more_than + 0.5 - n * p) / math.sqrt(max(n * p * (1 - p), 1e-12))
        return 0.5 * math.erfc(z / math.sqrt(2))
    term = below = (1 - p) ** n
    for k in range(1, more_than + 1):
        term *= (n - k + 1) / k * p / (1 - p)
        below += term
    return max(0.0, 1 - below)


def allocate(similarity: Similarity, low: int, high: int, sets: int) -> Allocation:
    """The cheapest allocation of a band of ``sets`` sets of ``low`` to ``high`` - 1 shingles.

    Counts signatures, and pairs of sets that share only segments which say nothing.
    """
    most = similarity.difference(high - 1)
    best, least = None, math.inf
    for deletions in (False, True):
        fewest = (most // 2 if deletions else most) + 1
        segments = fewest
        while segments <= 2 * fewest + 4:
            shared = segments - fewest + 1
            load = low / segments
            empty = math.exp(-load) * (1 + load if deletions else 1)
            spare = _tail(segments, min(empty, 1 - 1e-9), shared - 1)
            signatures = segments + (math.sqrt(low * high) if deletions else 0)
            pairs = (spare * sets) ** 2 * segments * empty
            cost = sets * signatures + PAIR_COST * pairs
            if cost < least:
                best, least = Allocation(segments, deletions, shared), cost
            segments += max(1, segments // 40)
    return best


def signatures(
    shingles: np.ndarray, band: int, plan: Allocation
) -> tuple[np.ndarray, int, bool]:
    """The signatures of one set in one band, how many of its segments have none, and if
    the segments that say nothing have markers."""
    spread = mixed(shingles ^ _STEP)
    segment = (spread >> np.uint64(32)) * np.uint64(plan.segments) >> np.uint64(32)
    order = np.argsort(segment, kind="stable")
    spread, segment = spread[order], segment[order]
    starts = np.flatnonzero(np.diff(segment, prepend=np.uint64(plan.segments)))
    counts = np.diff(starts, append=len(segment))
    sums = np.add.reduceat(spread, starts)
    tag = mixed(np.arange(plan.segments, dtype=np.uint64) + np.uint64(band << 40))
    found = [sums + tag[segment[starts]]]
    weak = plan.segments - len(starts)
    if plan.deletions:
        weak += int((counts == 1).sum())
        less = np.repeat(sums, counts) - spread + tag[segment]
        found.append(less[np.repeat(counts, counts) > 1])
    marked = weak >= plan.shared
    if marked:  # so many segments say nothing that they may be all a pair shares
        filled = segment[starts]
        if plan.deletions:
            filled = filled[counts > 1]
        found.append(np.delete(tag, filled.astype(np.int64)))
        weak = 0
    return mixed(np.concatenate(found)), weak, marked


def described(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, text_key, n_shingles, node and short (null without words) of each row."""
    texts = common.texts(docs).withColumn("text_key", F.xxhash64("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(batch.column(1), words)
        nodes = [node_of(s) if len(s) else None for s in sets]
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(2), pa.array(map(len, sets), pa.int64()),
                pa.array(nodes, pa.binary()),
                pa.array([None if n is None else short_of(n) for n in nodes], pa.int64()),
            ],
            ["doc_id", "text_key", "n_shingles", "node", "short"],
        )

    return common.map_batches(
        texts, run, "doc_id long, text_key long, n_shingles long, node binary, short long"
    )


def _sorted_slots(shorts: np.ndarray, bands: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first of each distinct (short, band), and for each given one its number among them."""
    order = np.lexsort((bands, shorts))
    new = np.ones(len(order), bool)
    new[1:] = np.diff(shorts[order]) != 0
    new[1:] |= np.diff(bands[order]) != 0
    place = np.zeros(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    return order[new], place


def _grouped(groups: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (group, member), sorted, and how many members the group of each has."""
    order = np.lexsort((members, groups))
    groups, members = groups[order], members[order]
    new = np.ones(len(groups), bool)
    new[1:] = (np.diff(groups) != 0) | (np.diff(members) != 0)
    groups, members = groups[new], members[new]
    first = np.ones(len(groups), bool)
    first[1:] = np.diff(groups) != 0
    sizes = np.diff(np.flatnonzero(first), append=len(groups))
    return groups, members, np.repeat(sizes, sizes)


def _counted_pairs(
    groups: np.ndarray, members: np.ndarray, sizes: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of members of one group of up to ``HOT_SIGNATURE``, and in how many they meet."""
    found = [np.zeros(0, np.int64)]
    for size in range(2, HOT_SIGNATURE + 1):
        rows = members[sizes == size].reshape(-1, size)
        if len(rows):
            i, j = np.triu_indices(size, 1)
            found.append((rows[:, i] << 32 | rows[:, j]).ravel())
    pairs, counts = np.unique(np.concatenate(found), return_counts=True)
    return pairs >> 32, pairs & 0xFFFFFFFF, counts


#: Added to what a set with markers needs. Such markers match those of other such sets only.
_MARKED = 1 << 15
#: Entries of hot signatures, and pairs with the number of signatures they share.
_HOT = np.dtype([("sig", "<i8"), ("node", "<i8"), ("band", "u1"), ("spare", "<u2")])
_PAIR = np.dtype([
    ("a", "<i8"), ("b", "<i8"), ("band", "u1"), ("need_a", "<u2"), ("need_b", "<u2"),
    ("n", "<u4"),
])


def _met_signatures(
    docs: DataFrame, similarity: Similarity, sizes: dict[int, int]
) -> DataFrame:
    """What meets under one signature: packed pairs by bucket, and entries of hot signatures."""
    bounds = similarity.bands(10 ** 12)
    plans = {
        band: allocate(similarity, bounds[band], bounds[band + 1], n) for band, n in sizes.items()
    }
    total = sum(2 * n * plans[b].segments for b, n in sizes.items())
    buckets = np.uint64(total // BUCKET_SIGNATURES + 1)
    percent, words, smallest = similarity.percent, similarity.words, similarity.smallest
    starts = np.array(bounds)

    def emit(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = {}
        for s in shingle_sets(batch.column(1), words):
            if len(s) >= smallest:
                sets.setdefault(short_of(node_of(s)), s)
        found, shorts, bands, spares = [], [], [], []
        for short, s in sets.items():
            low = max(smallest, -(-percent * len(s) // 100))
            first, last = np.searchsorted(starts, [low, len(s)], side="right") - 1
            for band in range(first, last + 1):
                if band in plans:  # else there is no smaller set to link with
                    signs, weak, marked = signatures(s, band, plans[band])
                    found.append(signs)
                    shorts.append(short)
                    bands.append(band)
                    spare = min(max(plans[band].shared - weak, 0), _MARKED - 1)
                    spares.append(spare + _MARKED * marked)
        rows = []
        if found:
            shorts, bands = np.array(shorts, np.int64), np.array(bands, np.uint8)
            spares = np.array(spares, np.uint16)
            signs = np.concatenate(found)
            slots = np.repeat(np.arange(len(found)), [len(f) for f in found])
            signs, slots, sizes_ = _grouped(signs, slots)
            # A signature that is hot within the batch sends on no more than shows it is.
            rank = np.arange(len(signs)) - np.maximum.accumulate(
                np.where(np.diff(signs, prepend=signs[0] + np.uint64(1)) != 0, np.arange(len(signs)), 0)
            )
            over = rank > HOT_SIGNATURE
            if over.any():
                hot = _records(_HOT, signs[over] & _LOW, shorts[slots[over]], bands[slots[over]],
                               spares[slots[over]])
                rows.append((int(shorts[0] % int(buckets)), b"", b"", b"", b"", b"", hot))
                signs, slots = signs[~over], slots[~over]
            bucket = (signs >> np.uint64(32)) % buckets
            order = np.lexsort((slots, bucket))
            signs, slots, bucket = signs[order], slots[order], bucket[order]
            heads = np.flatnonzero(np.diff(bucket, prepend=buckets))
            low_bytes = signs.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
            for head, until in zip(heads, np.append(heads[1:], len(bucket))):
                used, counts = np.unique(slots[head:until], return_counts=True)
                rows.append((
                    int(bucket[head]), low_bytes[head:until].tobytes(),
                    counts.astype("<u4").tobytes(), shorts[used].tobytes(),
                    bands[used].tobytes(), spares[used].tobytes(), b"",
                ))
        columns = list(zip(*rows)) or [[]] * 7
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), *(pa.array(c, pa.binary()) for c in columns[1:])],
            ["bucket", *(f"c{i}" for i in range(6))],
        )

    def meet(table: pa.Table) -> pa.Table:
        parts = [b"".join(table.column(f"c{i}").to_pylist()) for i in range(6)]
        hot = [parts[5]]
        rows = []
        if parts[0]:
            signs = np.zeros((len(parts[0]) // 6, 8), np.uint8)
            signs[:, :6] = np.frombuffer(parts[0], np.uint8).reshape(-1, 6)
            signs = signs.view("<u8").ravel()
            shorts = np.frombuffer(parts[2], np.int64)
            bands, spares = np.frombuffer(parts[3], np.uint8), np.frombuffer(parts[4], np.uint16)
            first, place = _sorted_slots(shorts, bands)
            slots = np.repeat(place, np.frombuffer(parts[1], "<u4"))
            shorts, bands, spares = shorts[first], bands[first], spares[first]
            signs, slots, sizes_ = _grouped(signs, slots)
            over = sizes_ > HOT_SIGNATURE
            own = slots[over]
            hot.append(_records(_HOT, signs[over], shorts[own], bands[own], spares[own]))
            a, b, n = _counted_pairs(signs[~over], slots[~over], sizes_[~over])
            if len(a):
                at = (shorts[a] ^ shorts[b]).view(np.uint64) % buckets
                order = np.argsort(at, kind="stable")
                a, b, n, at = a[order], b[order], n[order], at[order]
                heads = np.flatnonzero(np.diff(at, prepend=buckets))
                for head, until in zip(heads, np.append(heads[1:], len(at))):
                    x, y = a[head:until], b[head:until]
                    packed = _records(
                        _PAIR, shorts[x], shorts[y], bands[x], spares[x], spares[y], n[head:until]
                    )
                    rows.append((int(at[head]), packed, None, None, None, None))
        for record in np.frombuffer(b"".join(hot), _HOT).tolist():
            rows.append((None, None, *record))
        columns = list(zip(*rows)) or [[]] * 6
        types = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
        return pa.table(
            [pa.array(c, t) for c, t in zip(columns, types)],
            ["pairs_bucket", "pairs", "sig", "node", "band", "spare"],
        )

    packed_rows = common.map_batches(
        common.texts(docs), emit, "bucket long, " + ", ".join(f"c{i} binary" for i in range(6))
    )
    met = packed_rows.groupBy("bucket").applyInArrow(
        meet, "pairs_bucket long, pairs binary, sig long, node long, band int, spare int"
    )
    return common.written(met, "met-signatures")


def _records(kind: np.dtype, *columns: np.ndarray) -> bytes:
    records = np.zeros(len(columns[0]), kind)
    for name, column in zip(kind.names, columns):
        records[name] = column
    return records.tobytes()


def candidate_edges(docs: DataFrame, similarity: Similarity, sizes: dict[int, int]) -> DataFrame:
    """Edges (a, b) of shorts that connect all nodes which may be similar.

    ``sizes`` counts the sets of each band. A pair that shares enough signatures is an edge:
    as many as the band's allocation says, less the segments that say nothing in both. Those
    are the empty ones and the hot ones, whose groups are not looked into; the few sets with
    no other segments to spare meet as stars. Empty segments count for a pair of sets with
    markers; if one of the two has markers, the other's need alone holds.
    """
    met = _met_signatures(docs, similarity, sizes)

    def marked(need: str) -> Column:
        return F.col(need) >= _MARKED

    hot = met.filter(F.col("sig").isNotNull()).select(
        "sig", "node", "band", F.pmod("spare", F.lit(_MARKED)).alias("spare"),
        marked("spare").alias("marked"),
    ).distinct()
    hot = common.written(hot, "hot-signatures")
    n_hot = hot.groupBy("node", "band").agg(F.count(F.lit(1)).cast("int").alias("hot"))

    def add(bucket: pa.Table) -> pa.Table:
        records = np.frombuffer(b"".join(bucket.column("pairs").to_pylist()), _PAIR)
        records = records[np.lexsort((records["band"], records["b"], records["a"]))]
        new = np.ones(len(records), bool)
        for name in ("a", "b", "band"):
            new[1:] &= records[name][1:] == records[name][:-1]
        new[1:] = ~new[1:]
        heads = np.flatnonzero(new)
        sums = np.add.reduceat(records["n"].astype(np.int64), heads)
        first = records[heads]
        return pa.table({
            name: pa.array((sums if name == "n" else first[name]).astype(np.int64))
            for name in _PAIR.names
        })

    pairs = met.filter(F.col("pairs").isNotNull()).select("pairs_bucket", "pairs").groupBy(
        "pairs_bucket"
    ).applyInArrow(add, "a long, b long, band long, need_a long, need_b long, n long")

    def less_hot(df: DataFrame, side: str) -> DataFrame:
        of = n_hot.select(
            F.col("node").alias(side), F.col("band").cast("long").alias("band"),
            F.col("hot").alias(f"hot_{side}"),
        )
        need = f"need_{side}"
        return df.join(of, [side, "band"], "left").withColumn(
            f"marked_{side}", marked(need)
        ).withColumn(
            need, F.pmod(need, F.lit(_MARKED)) - F.coalesce(f"hot_{side}", F.lit(0))
        )

    need = F.when(F.col("marked_a") == F.col("marked_b"), F.greatest("need_a", "need_b"))
    need = need.when(F.col("marked_a"), F.col("need_b")).otherwise(F.col("need_a"))
    enough = less_hot(less_hot(pairs, "a"), "b").filter(F.col("n") >= need).select("a", "b")
    spent = hot.join(n_hot, ["node", "band"])
    left = spent.filter(F.col("hot") >= F.col("spare"))
    # A set without markers that is left may have nothing but this in common with one that
    # has markers, whatever that one has to spare.
    alone = left.filter(~F.col("marked")).select("sig").distinct()
    others = spent.filter(F.col("marked") & (F.col("hot") < F.col("spare")))
    left = left.unionByName(others.join(alone, "sig", "left_semi").select(left.columns))
    centre = left.groupBy("sig").agg(F.min("node").alias("b"))
    stars = left.select("sig", F.col("node").alias("a")).join(centre, "sig").select("a", "b")
    return enough.unionByName(stars).filter("a <> b").distinct()


def links_within(sets: list[np.ndarray], similarity: Similarity) -> list[tuple[int, int]]:
    """Links that connect all sets of a block which links connect (a spanning forest).

    Prefix filter: of two similar sets ordered by rarity, the first shingles have one in
    common. Sets that are connected already are not compared again.
    """
    sizes = np.array([len(s) for s in sets])
    values, ranked, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    ends = np.cumsum(sizes)
    rare_first = np.empty(len(values), np.int64)
    rare_first[np.argsort(df, kind="stable")] = np.arange(len(values))
    ranked = rare_first[ranked]
    by_set = [np.sort(ranked[e - n:e]) for e, n in zip(ends, sizes)]
    shared_from = int((df == 1).sum())  # rarer shingles stand in one set only
    parent = np.arange(len(sets))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    index: dict[int, list[int]] = {}
    flags = np.zeros(len(values), bool)
    links = []
    for i in np.argsort(sizes, kind="stable").tolist():
        tokens, n = by_set[i], int(sizes[i])
        prefix = tokens[:n - -(-similarity.percent * n // 100) + 1]
        prefix = prefix[prefix >= shared_from].tolist()
        near = set()
        for token in prefix:
            near.update(index.get(token, ()))
            index.setdefault(token, []).append(i)
        roots = {}
        for j in near:
            if 100 * sizes[j] >= similarity.percent * n:
                roots.setdefault(root(j), []).append(j)
        flags[tokens] = True
        for others in roots.values():
            for j in others:  # one link to each component is enough
                shared = int(np.count_nonzero(flags[by_set[j]]))
                if 100 * shared >= similarity.percent * (n + int(sizes[j]) - shared):
                    parent[root(j)] = root(i)
                    links.append((j, i))
                    break
        flags[tokens] = False
    return links


def _units(members: DataFrame, similarity: Similarity, block: int) -> DataFrame:
    """``members`` (node, component, n_shingles, ...) with the blocks each is verified in."""
    of_cluster = members.groupBy("component").agg(F.sum("n_shingles").alias("cluster_shingles"))
    joined = members.join(of_cluster, "component")
    small = joined.filter(F.col("cluster_shingles") <= block)
    total = small.agg(F.sum("n_shingles")).first()[0] or 0
    together = F.concat_ws("-", F.lit("s"), F.pmod(F.xxhash64("component"), F.lit(total // block + 1)))
    # A set links with sets of its own size level and the next ones only.
    level = F.floor(F.log("n_shingles") / -math.log((similarity.percent - 1) / 100))
    large = joined.filter(F.col("cluster_shingles") > block).withColumn("level", level)
    parts = large.groupBy("component", "level").agg(
        F.ceil(F.sum("n_shingles") / block).alias("parts")
    )

    def shifted(by: int, name: str) -> DataFrame:
        return parts.select(
            "component", (F.col("level") + by).alias("level"), F.col("parts").alias(name)
        )

    key = ["component", "level"]
    large = large.join(parts, key).join(shifted(1, "below"), key, "left").join(
        shifted(-1, "above"), key, "left"
    )
    own = F.pmod(F.xxhash64("node"), F.col("parts"))
    named = F.col("component").cast("string")

    def pairs(count, make):
        upto = F.when(count > 0, F.sequence(F.lit(0).cast("long"), count - 1))
        return F.coalesce(F.transform(upto, make), F.array().cast("array<string>"))

    def unit(low_level, a, b, kind):
        return F.concat_ws("-", F.lit(kind), named, low_level, a, b)

    here = pairs(F.col("parts"), lambda j: unit(
        F.col("level"), F.least(F.col("own"), j), F.greatest(F.col("own"), j), "e"))
    up = pairs(F.col("above"), lambda j: unit(F.col("level"), F.col("own"), j, "n"))
    down = pairs(F.col("below"), lambda j: unit(F.col("level") - 1, j, F.col("own"), "n"))
    large = large.withColumn("own", own).withColumn("units", F.concat(here, up, down))
    columns = [*members.columns, "units"]
    return small.withColumn("units", F.array(together)).select(columns).unionByName(
        large.select(columns)
    )


def links(
    docs: DataFrame, about: DataFrame, similarity: Similarity, block: int = BLOCK_SHINGLES
) -> DataFrame:
    """Edges (a, b) between nodes that are similar, enough to connect all that links connect.

    ``about`` is the written result of :func:`described`.
    """
    bounds = similarity.bands(about.agg(F.max("n_shingles")).first()[0] or 0)
    nodes = about.filter(F.col("n_shingles") >= similarity.smallest).groupBy("node").agg(
        F.first("n_shingles").alias("n_shingles"), F.first("short").alias("short"),
        F.min(F.struct("text_key", "doc_id")).alias("sample"),
    )
    nodes = common.written(nodes, "nodes")
    edges_of_bands = F.array(*map(F.lit, bounds))
    band = F.size(F.filter(edges_of_bands, lambda b: b <= F.col("n_shingles"))) - 1
    sizes = {r["band"]: r["count"] for r in nodes.groupBy(band.alias("band")).count().collect()}
    clusters = components(candidate_edges(docs, similarity, sizes))
    members = nodes.join(clusters.withColumnRenamed("node", "short"), "short")
    units = _units(
        common.written(members, "candidates"), similarity, block
    ).select("node", "units", "sample.*")
    texts = common.packed_once(
        common.texts(docs).withColumn("text_key", F.xxhash64("text")), ["doc_id", "text_key"]
    )
    wanted = units.select(
        "node", "units", F.col("text_key").alias("key"), F.col("doc_id").alias("id")
    )
    chosen = texts.join(
        wanted, (F.col("text_key") == F.col("key")) & F.col("doc_id").eqNullSafe(F.col("id"))
    ).select("node", "units", "packed", "size")
    words = similarity.words

    def hashed(batch: pa.RecordBatch) -> pa.RecordBatch:
        plain = common.unpacked(batch.column(2), batch.column(3))
        sets = [s.tobytes() for s in shingle_sets(plain, words)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(sets, pa.binary())],
            ["node", "units", "shingles"],
        )

    sets = common.map_batches(chosen, hashed, "node binary, units array<string>, shingles binary")

    def verify(unit: pa.Table) -> pa.Table:
        sets = dict(zip(unit.column("node").to_pylist(), unit.column("shingles").to_pylist()))
        names = sorted(sets)
        found = links_within([np.frombuffer(sets[n], np.uint64) for n in names], similarity)
        return pa.table({
            side: pa.array([names[link[k]] for link in found], pa.binary())
            for k, side in enumerate("ab")
        })

    return (
        sets.select("node", "shingles", F.explode("units").alias("unit"))
        .groupBy("unit").applyInArrow(verify, "a binary, b binary")
    )


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, block: int = BLOCK_SHINGLES
) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id (the smallest doc_id reached by links), and
    component: alike for what is linked, null without words."""
    similarity = Similarity(words, percent)
    about = common.written(described(docs, words), "shingle-sets")
    grouped = components(links(docs, about, similarity, block))
    smallest = about.filter(F.col("node").isNotNull()).groupBy("node").agg(
        F.min("doc_id").alias("node_min")
    )
    named = smallest.join(grouped, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    ids = named.groupBy("component").agg(F.min("node_min").alias("component_id"))
    answer = named.join(ids, "component").select(
        F.col("node").alias("key"), "component_id", "component"
    )
    # Rows without words have no node; a key of their own spreads them over the tasks.
    key = F.coalesce("node", F.unhex(F.md5(F.col("text_key").cast("string"))))
    return about.join(answer, key == F.col("key"), "left").select(
        "doc_id", "text_key", "n_shingles",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        .alias("component_id"),
        F.when(F.col("node").isNotNull(), F.col("component")).alias("component"),
    )


def keep_one_of_each_group(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row of ``docs`` of each group, with all its columns.

    It is the one with the smallest ``doc_id``, nulls last; of several texts with that id one,
    always the same. Texts without words link with nothing and stay, but of rows alike in
    ``doc_id`` and text one stays in any case.
    """
    found = near_duplicates(docs, words, percent)
    best = found.filter(F.col("component").isNotNull()).groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("best")
    ).select(F.col("best.doc_id").alias("kept_id"), F.col("best.text_key").alias("kept_key"))
    kept = best.unionByName(found.filter(F.col("component").isNull()).select(
        F.col("doc_id").alias("kept_id"), F.col("text_key").alias("kept_key")
    ).distinct())
    rows = docs.select(
        F.struct("*").alias("row"), common.doc_id().alias("id"),
        F.xxhash64(common.text_or_empty()).alias("key"),
    )
    alike = Window.partitionBy("key", "id").orderBy(F.lit(1))
    return (
        rows.withColumn("place", F.row_number().over(alike)).filter("place = 1")
        .join(
            kept, (F.col("key") == F.col("kept_key")) & F.col("id").eqNullSafe(F.col("kept_id")),
            "left_semi",
        ).select("row.*")
    )
