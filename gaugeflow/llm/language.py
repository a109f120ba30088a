"""Language identification in two steps: the family, then one against one within it.

Texts become hashed counts of their byte trigrams (lower case, everything that is no letter
a space), scaled by logarithm and length. Families are groups of languages whose mean
profiles are more alike than languages are on average. A linear support vector machine for
each family tells it from the others; within a family one for each pair of languages votes,
and votes that tie are settled by the summed margins.

The classifier is fitted on the driver from a bounded sample: at most ``MOST_LANGUAGES``
labels, the most frequent ones, at most ``per_language`` rows of each, those with the smallest
hashed ``doc_id``, and at most ``SAMPLE_ROWS`` in all, dealt evenly. Predictions read the whole
text and nothing else, row by row, without a shuffle.

Defined results: a text that is null or has no letter is ``und`` with score 0, as is every
text when nothing was learned. With one learned language every text with a letter is of it.
A null ``lang`` or ``doc_id`` is not learned from; of several texts of one ``doc_id`` and
language the greatest is. Repeated rows each get their own row. An empty table gives an empty
result. Columns called ``lang_pred`` or ``score`` are replaced, all others
stay.
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm import common

UNKNOWN = "und"
#: Bits of a hashed trigram, and rows of each language that the fit reads.
BITS, PER_LANGUAGE = 12, 800
#: Bounds of the fit's sample as a whole: languages, and rows.
MOST_LANGUAGES, SAMPLE_ROWS = 100, 12_800
_PARTS = 16
_MULTIPLIER = np.uint32(2654435761)  # Knuth's multiplicative hash
_ASCII_LETTER = re.compile("[A-Za-z]")


def _folded() -> np.ndarray:
    """Each byte in lower case; bytes that are no letter become spaces."""
    fold = np.full(256, ord(" "), np.uint8)
    for byte in range(ord("a"), ord("z") + 1):
        fold[byte] = fold[byte - 32] = byte
    fold[128:] = np.arange(128, 256)  # parts of longer characters
    return fold


_FOLD = _folded()


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that are never learned from; a null id counts as learned-from material without use."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def profiles(column: pa.Array) -> np.ndarray:
    """A row for each text: scaled counts of its hashed trigrams."""
    data, offsets = common.text_bytes(column)
    folded = _FOLD[data].astype(np.uint32)
    rows = np.zeros((len(offsets) - 1, 1 << BITS), np.float32)
    if len(folded) > 2:
        grams = folded[:-2] << np.uint32(16) | folded[1:-1] << np.uint32(8) | folded[2:]
        # A run of spaces says nothing, so it counts nowhere.
        spaces = grams == np.uint32(0x202020)
        hashed = (grams * _MULTIPLIER) >> np.uint32(32 - BITS)
        weights = (~spaces).astype(np.float32)
        for i, (start, end) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            if end - start > 2:
                rows[i] = np.bincount(
                    hashed[start:end - 2], weights[start:end - 2], minlength=1 << BITS
                )
    rows = np.log1p(rows)
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


def has_letter(text: str | None) -> bool:
    return bool(text) and (
        _ASCII_LETTER.search(text) is not None or any(map(str.isalpha, text))
    )


def fit_svm(rows: np.ndarray, signs: np.ndarray, steps: int = 120, decay: float = 1e-4) -> np.ndarray:
    """Weights (the last is the offset) of a linear SVM with squared hinge loss.

    Accelerated gradient descent; the classes weigh the same however many rows they have.
    """
    x = np.hstack([rows, np.ones((len(rows), 1), np.float32)])
    weight = np.where(signs > 0, 0.5 / max((signs > 0).sum(), 1), 0.5 / max((signs < 0).sum(), 1))
    w = np.zeros(x.shape[1], np.float32)
    ahead, step = w.copy(), 0.25  # rows have length sqrt(2) at most, which bounds the curvature by 4
    for t in range(1, steps + 1):
        slack = np.maximum(0, 1 - signs * (x @ ahead))
        gradient = decay * ahead - 2 * ((weight * signs * slack).astype(np.float32) @ x)
        new = ahead - step * gradient
        ahead = new + (t - 1) / (t + 2) * (new - w)
        w = new
    return w


def families_of(means: dict[str, np.ndarray]) -> list[list[str]]:
    """Languages grouped by the pairs that are more alike than pairs are on average."""
    names = sorted(means)
    alike = {
        (a, b): float(means[a] @ means[b] / np.linalg.norm(means[a]) / np.linalg.norm(means[b]))
        for a, b in itertools.combinations(names, 2)
    }
    group = {n: n for n in names}
    if alike:
        usual = sum(alike.values()) / len(alike)
        # A language joins its most similar one, if they are unusually alike.
        for name in names:
            others = {(a if b == name else b): s for (a, b), s in alike.items() if name in (a, b)}
            nearest = max(others, key=others.get)
            if others[nearest] > usual or len(names) == 2:
                old, new = group[name], group[nearest]
                group = {n: new if g == old else g for n, g in group.items()}
    return [[n for n in names if group[n] == g] for g in sorted(set(group.values()))]


@dataclass
class LanguageModel:
    families: list[list[str]] = field(default_factory=list)
    family_weights: np.ndarray | None = None  # a row for each family
    pair_weights: dict[tuple[str, str], np.ndarray] = field(default_factory=dict)

    @classmethod
    def fit(cls, rows: np.ndarray, langs: list[str]) -> LanguageModel:
        names = np.array(langs)
        means = {n: rows[names == n].mean(axis=0) for n in sorted(set(langs))}
        model = cls(families_of(means))
        if len(model.families) > 1:
            model.family_weights = np.array([
                fit_svm(rows, np.where(np.isin(names, family), 1.0, -1.0))
                for family in model.families
            ])
        for family in model.families:
            for a, b in itertools.combinations(family, 2):
                own = (names == a) | (names == b)
                model.pair_weights[a, b] = fit_svm(
                    rows[own], np.where(names[own] == a, 1.0, -1.0)
                )
        return model

    def predict(self, rows: np.ndarray) -> tuple[list[str], np.ndarray]:
        """The language of each row, and a score between 0 and 1."""
        langs = np.full(len(rows), UNKNOWN, object)
        scores = np.zeros(len(rows))
        if not self.families:
            return langs.tolist(), scores
        chosen, sure = np.zeros(len(rows), int), np.ones(len(rows))
        if self.family_weights is not None:
            margins = rows @ self.family_weights[:, :-1].T + self.family_weights[:, -1]
            chosen = margins.argmax(axis=1)
            sure = 1 / (1 + np.exp(-2 * margins.max(axis=1)))
        for number, family in enumerate(self.families):
            own = np.flatnonzero(chosen == number)
            votes, sums = np.zeros((2, len(own), len(family)))
            for a, b in itertools.combinations(range(len(family)), 2):
                w = self.pair_weights[family[a], family[b]]
                margin = rows[own] @ w[:-1] + w[-1]
                votes[:, a] += margin > 0
                votes[:, b] += margin <= 0
                sums[:, a] += margin
                sums[:, b] -= margin
            best = np.lexsort((sums.T, votes.T), axis=0)[-1] if len(own) else own
            langs[own] = np.array(family, object)[best]
            pairs = max(len(family) - 1, 1)
            within = sums[np.arange(len(own)), best] / pairs
            scores[own] = sure[own] * (
                1 / (1 + np.exp(-2 * within)) if len(family) > 1 else 1.0
            )
        return langs.tolist(), scores


def training_rows(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """(text, lang) of at most ``per_language`` labelled rows of each language, within the
    bounds of the sample."""
    labelled = docs.select(common.doc_id(), F.col("lang").cast("string").alias("lang"), "text").filter(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull()
        & ~held_out()
    )
    counts = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES)
    langs = [r["lang"] for r in counts.collect()]
    if not langs:
        return labelled.select("text", "lang")
    labelled = labelled.filter(F.col("lang").isin(langs))
    per_language = min(per_language, SAMPLE_ROWS // len(langs))
    # First within parts of a language, so no task meets what all tasks found of a frequent one.
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(_PARTS))
    chosen = labelled.select("doc_id", "lang", part.alias("part"))
    for group in (["lang", "part"], ["lang"]):
        order = Window.partitionBy(*group).orderBy(F.xxhash64("doc_id"), "doc_id")
        chosen = chosen.withColumn("place", F.row_number().over(order)).filter(
            F.col("place") <= per_language
        ).drop("place")
    chosen = chosen.select("doc_id").distinct()
    # At most per_language ids of each language, which bounds the broadcast. Ids may be many
    # rows' own, so one text of each id and language is learned from.
    return labelled.join(F.broadcast(chosen), "doc_id", "left_semi").groupBy("doc_id", "lang").agg(
        F.max("text").alias("text")
    ).select("text", "lang")


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE) -> LanguageModel:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = profiles(batch.column(0)).astype(np.float16)
        packed = pa.array([row.tobytes() for row in rows], pa.binary())
        letters = pa.array(list(map(has_letter, batch.column(0).to_pylist())))
        return pa.RecordBatch.from_arrays([packed, batch.column(1), letters], ["row", "lang", "letters"])

    sample = common.map_batches(
        training_rows(docs, per_language), run, "row binary, lang string, letters boolean"
    ).filter("letters").toArrow()
    if not sample.num_rows:
        return LanguageModel()
    rows = np.frombuffer(b"".join(sample.column("row").to_pylist()), np.float16)
    rows = rows.reshape(sample.num_rows, -1).astype(np.float32)
    langs = sample.column("lang").to_pylist()
    order = sorted(range(len(langs)), key=lambda i: (langs[i], rows[i].tobytes()))
    return LanguageModel.fit(rows[order], [langs[i] for i in order])


#: Rows whose profiles are in memory together.
_ROWS = 512


def _predicted(model: LanguageModel, column: pa.Array) -> tuple[list[bool], list[str], list[float]]:
    """Of each text: if it has a letter, its language, and the score."""
    letters, langs, scores = [], [], []
    for at in range(0, len(column), _ROWS):
        part = column.slice(at, _ROWS)
        known = np.array(list(map(has_letter, part.to_pylist())))
        predicted, sure = model.predict(profiles(part.fill_null("")))
        letters += known.tolist()
        langs += [x if y else UNKNOWN for x, y in zip(predicted, known)]
        scores += np.where(known, sure, 0.0).tolist()
    return letters, langs, scores


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with lang_pred and score; all other columns stay."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("lang_pred", "score")
    place = docs.columns.index("text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        _, langs, scores = _predicted(shared.value, batch.column(place))
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
            [*batch.schema.names, "lang_pred", "score"],
        )

    fields = docs.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    return common.map_batches(docs, run, fields)


def known_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows of ``docs`` whose text has a letter, a null ``lang`` filled with the prediction.

    When nothing was learned there is no prediction, and a null ``lang`` stays null.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        letters, langs, _ = _predicted(shared.value, batch.column(1))
        found = pa.array([None if x == UNKNOWN else x for x in langs], pa.string())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(letters, pa.bool_()), found], ["row", "letters", "found"]
        )

    rows = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"))
    fields = rows.select("row", F.lit(True).alias("letters"), F.lit("").alias("found")).schema
    fields["found"].nullable = True
    kinds = dict(docs.dtypes)
    return common.map_batches(rows, run, fields).filter("letters").select(*(
        F.coalesce(F.col("row")["lang"], F.col("found").cast(kinds[name])).alias(name)
        if name == "lang" else F.col("row")[name].alias(name) for name in docs.columns
    ))
