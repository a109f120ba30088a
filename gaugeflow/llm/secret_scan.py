"""Secret scans: fixed patterns, and sliding-window entropy of the strings they miss.

A candidate is a run of token characters long enough for a window. For each character class
the Shannon entropy of a window of it is kept up to date by counts as the window slides: one
character leaves, one enters, and two terms of the sum change. Windows above the class's
threshold mark their characters; what no pattern covers of the marked stretches, and no
allow-list entry matches, is a span of the kind ``entropy``. Ordered runs of the alphabet or
the digits are taken out before the windows slide, and what stands around them stays.

Defined results: null text is empty; a text without secrets has no spans. Long texts are
scanned whole, repeated rows each. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import bisect
import functools
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from gaugeflow.llm import common

# The patterns, in the order of their kinds.
KINDS = ("assign", "access", "hex", "entropy")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")  # runs are maximal, so the length can stand in the pattern
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")

#: Characters in a window, and bits a character above which a window of the class is a secret.
WINDOW = 20
CLASSES: tuple[tuple[str, re.Pattern, float], ...] = (
    ("hexadecimal", re.compile(r"[0-9A-Fa-f]{20,}"), 3.2),
    ("base64", re.compile(r"[A-Za-z0-9+/_=-]{20,}"), 3.9),
)
#: Stretches that are never secrets: words of one case, numbers, paths and names made of
#: words (with a vowel, where the case changes), UUIDs.
ALLOWED: tuple[re.Pattern, ...] = tuple(map(re.compile, (
    r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+",
    r"[a-z/_=+-]*|[A-Z/_=+-]*",
    r"(?:(?=[A-Z]?[a-z]*[aeiouy])[A-Z]?[a-z]{2,}+|[A-Z]{2,}+|[/_=+-]++"
    r"|(?<![A-Za-z])(?:[A-Z]?[a-z]++|[A-Z])(?![A-Za-z]))++",
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
)))
#: Characters in order that are a stretch of the alphabet or the digits.
ORDERED = 10
_ORDERED_SEEDS = re.compile("abcdefghij|ABCDEFGHIJ|0123456789")


@functools.cache
def _term(count: int) -> float:
    return count * math.log2(count) if count else 0.0


def window_entropies(text: str, window: int = WINDOW) -> list[float]:
    """Entropy in bits of each window of ``text``, kept up by counts as it slides."""
    counts: dict[str, int] = {}
    total, entropies = 0.0, []  # total: sum of n log2 n over the counts n
    for i, char in enumerate(text):
        n = counts.get(char, 0)
        total += _term(n + 1) - _term(n)
        counts[char] = n + 1
        if i >= window:
            gone = text[i - window]
            n = counts[gone]
            total += _term(n - 1) - _term(n)
            counts[gone] = n - 1
        if i >= window - 1:
            entropies.append(math.log2(window) - total / window)
    return entropies


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's place, end) of the fixed patterns."""
    spans = []
    folded = text.lower()
    if any(word in folded for word in _ASSIGN_WORDS):
        spans += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(spans)


def _free_of_order(candidate: str) -> list[int]:
    """Places of the characters outside runs in order, like ``abcdefghij``."""
    if not _ORDERED_SEEDS.search(candidate):
        return list(range(len(candidate)))
    free, at = [], 0
    while at < len(candidate):
        end = at + 1
        while (
            end < len(candidate) and candidate[end - 1].isalnum()
            and ord(candidate[end]) == ord(candidate[end - 1]) + 1
        ):
            end += 1
        if end - at < ORDERED or not _ORDERED_SEEDS.match(candidate, at):
            free += range(at, end)
        at = end
    return free


def _merged(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for start, end in sorted(stretches):
        if merged and start <= merged[-1][1]:
            merged[-1] = merged[-1][0], max(end, merged[-1][1])
        else:
            merged.append((start, end))
    return merged


def _allowed(text: str) -> bool:
    return any(allowed.fullmatch(text) for allowed in ALLOWED)


def entropy_spans(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """What the spans of ``taken`` leave of stretches of high entropy."""
    spans = []
    covered = _merged([(start, end) for start, _, end in taken])
    ends = [end for _, end in covered]
    for candidate in _CANDIDATE.finditer(text):
        if _allowed(candidate[0]):
            continue
        free = _free_of_order(candidate[0])
        rest = "".join(candidate[0][i] for i in free) if len(free) < len(candidate[0]) else candidate[0]
        marked: list[tuple[int, int]] = []  # places in rest
        for _, characters, threshold in CLASSES:
            for run in characters.finditer(rest):
                for i, bits in enumerate(window_entropies(run[0])):
                    if bits >= threshold:
                        marked.append((run.start() + i, run.start() + i + WINDOW))
        for first, last in _merged(marked):
            places = free[first:last]
            cuts = [k for k in range(1, len(places)) if places[k] != places[k - 1] + 1]
            for a, b in zip([0, *cuts], [*cuts, len(places)]):
                at, until = candidate.start() + places[a], candidate.start() + places[b - 1] + 1
                i = bisect.bisect_right(ends, at)
                left = []
                while i < len(covered) and covered[i][0] < until:
                    left.append((at, covered[i][0]))
                    at = covered[i][1]
                    i += 1
                left.append((at, until))
                spans += [
                    (start, 3, end) for start, end in left
                    if start < end and not _allowed(text[start:end])
                ]
    return spans


def all_spans(text: str) -> list[tuple[int, int, int]]:
    spans = base_spans(text)
    return sorted(spans + entropy_spans(text, spans))


def mask_text(text: str, mask: str) -> str:
    parts, at = [], 0
    for start, _, end in all_spans(text):
        if start >= at:
            parts += [text[at:start], mask]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, spans (array of kind, start, end, by start, then kind)."""
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [
            [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in all_spans(text)]
            for text in batch.column(1).to_pylist()
        ]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(found, pa.list_(kind))], ["doc_id", "spans"]
        )

    schema = "doc_id long, spans array<struct<kind string, start long, end long>>"
    return common.map_batches(common.texts(docs), run, schema)


def masked(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with each stretch of secrets in ``text`` replaced; other columns stay.

    ``n_chars`` is brought up to date in the rows whose text changes.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        place = batch.schema.get_field_index("text")
        before = batch.column(place).to_pylist()
        after = [None if t is None else mask_text(t, mask) for t in before]
        out = batch.set_column(place, "text", pa.array(after, batch.schema.field(place).type))
        if "n_chars" in batch.schema.names:
            place = batch.schema.get_field_index("n_chars")
            counts = [
                n if new == old else len(new)
                for n, new, old in zip(batch.column(place).to_pylist(), after, before)
            ]
            column = pa.array(counts, batch.schema.field(place).type)
            out = out.set_column(place, "n_chars", column)
        return out

    return common.map_batches(docs, run, docs.schema)
