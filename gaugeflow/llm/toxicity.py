"""Toxicity by multiple-instance learning: a document is a bag of sentences.

A sentence's probability is a logistic function of its distinct words; a document's is the
noisy-or of its sentences, 1 - prod(1 - p). Only documents are labelled, so the gradient of
the document's likelihood is handed down to its sentences, each by its share of the blame:
the model learns from document labels which sentences offend, and can point to them. Scores
count each sentence as (1 - p) / (1 - p0), at most 1, where p0 is that of a sentence that
says nothing, so a document does not become toxic by being long.

A word counts as itself and as its first three, four and five characters, hashed. Weights
are fitted on the driver from a bounded sample: at most ``per_label`` labelled documents of
each label, of at most ``sample_chars`` characters each, those with the smallest hashed
``doc_id``. Scores read whole texts of any length, row by row, without a shuffle.

Defined results: a text without words (null, empty) has score 0 and no sentences. Labels of a
``doc_id`` that occurs more than once count as toxic if any is; of its texts the greatest is
learned from. Null ids and null labels are not learned from. When nothing toxic was learned
every score is 0, when only toxic documents were, every text with a word has score 1.
Repeated rows each get their own row; an empty table gives an empty result; all columns
of the documents that are called neither ``score`` nor ``offending`` stay as they are.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm import common

#: Bits of a hashed word feature.
BITS = 18
#: Bounds of the sample that the fit reads: documents of a label, characters of a document.
PER_LABEL, SAMPLE_CHARS = 2000, 50_000
#: From this probability on a sentence is pointed to.
OFFENDING = 0.5
#: Words whose weight a worker remembers.
KNOWN_WORDS = 500_000

_PARTS = 16
_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")
_STEMS = (3, 4, 5)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def features(word: str) -> list[int]:
    """Hashed places of a lower-case word and of its first characters."""
    names = [f"={word}", *(f"{word[:n]}~" for n in _STEMS if len(word) > n)]
    return [zlib.crc32(name.encode()) >> (32 - BITS) for name in names]


def sentence_words(sentence: str) -> set[str]:
    return set(_WORD.findall(sentence.lower()))


def _log_rest(scores: np.ndarray) -> np.ndarray:
    """log(1 - p) for p the logistic function of the scores."""
    return -np.logaddexp(0, scores)


@dataclass
class ToxicityModel:
    """Word weights; ``constant`` is the score of all documents when one label is missing."""

    weights: np.ndarray | None = None
    offset: float = 0.0
    constant: float = 0.0

    @classmethod
    def fit(
        cls, places: np.ndarray, sentences: np.ndarray, documents: np.ndarray, toxic: np.ndarray,
        steps: int = 80, rate: float = 0.15, sparsity: float = 2e-4,
    ) -> ToxicityModel:
        """Fit to ``places`` (features of all sentences on end), the number of features of each
        sentence, the number of sentences of each document, and the documents' labels.

        Adam steps on the noisy-or likelihood, both labels weighing the same; weights that
        stay below the sparsity threshold are pulled to zero, so chance words say nothing.
        """
        sentence_of = np.repeat(np.arange(len(sentences)), sentences)
        document_of = np.repeat(np.arange(len(documents)), documents)
        share = np.where(toxic, 0.5 / max(toxic.sum(), 1), 0.5 / max((~toxic).sum(), 1))
        w, offset = np.zeros(1 << BITS), -3.0
        mean, square = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
        for step in range(1, steps + 1):
            scores = np.bincount(sentence_of, w[places], len(sentences)) + offset
            p = 1 / (1 + np.exp(-np.clip(scores, -30, 30)))
            none = np.exp(np.bincount(document_of, _log_rest(scores), len(documents)))
            # What a document's likelihood changes with its sentences' scores.
            blame = np.where(toxic, -none / np.maximum(1 - none, 1e-9), 1.0) * share
            slope = blame[document_of] * p
            gradient = np.append(np.bincount(places, slope[sentence_of], len(w)), slope.sum())
            mean += 0.1 * (gradient - mean)
            square += 0.02 * (gradient ** 2 - square)
            scale = rate / (np.sqrt(square / (1 - 0.98 ** step)) + 1e-5)
            move = scale * mean / (1 - 0.9 ** step)
            w -= move[:-1]
            offset -= float(move[-1])
            # Soft threshold in each weight's own scale.
            w = np.sign(w) * np.maximum(np.abs(w) - scale[:-1] * sparsity, 0)
        return cls(w, offset)


class Scorer:
    """A model with the word weights that this worker has met."""

    def __init__(self, model: ToxicityModel):
        self.model = model
        self.known: dict[str, float] = {}

    def weight(self, word: str) -> float:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= KNOWN_WORDS:
                self.known.clear()
            found = self.known[word] = float(self.model.weights[features(word)].sum())
        return found

    def document(self, text: str) -> tuple[float, list[dict]]:
        """The document's score, and the sentences that offend."""
        if self.model.weights is None:
            return (self.model.constant if _WORD.search(text) else 0.0), []
        spans, scores = [], []
        for match in _SENTENCE.finditer(text):
            words = sentence_words(match[0])
            if words:
                spans.append(match.span())
                scores.append(sum(map(self.weight, sorted(words))) + self.model.offset)
        if not scores:
            return 0.0, []
        scores = np.array(scores)
        p = 1 / (1 + np.exp(-np.clip(scores, -700, 700)))
        found = [
            {"start": spans[i][0], "end": spans[i][1], "score": float(p[i])}
            for i in np.flatnonzero(p >= OFFENDING).tolist()
        ]
        rest = _log_rest(scores) - _log_rest(self.model.offset)
        return abs(float(np.expm1(np.minimum(rest, 0).sum()))), found


def training_rows(
    docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, sample_chars: int = SAMPLE_CHARS
) -> DataFrame:
    """(text, toxic) of at most ``per_label`` documents of each label."""
    marks = labels.select(common.doc_id(), F.col("toxic").cast("int").alias("toxic")).filter(
        F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out()
    ).groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    rows = docs.select(common.doc_id(), F.col("text").cast("string").alias("text")).filter(
        F.col("doc_id").isNotNull() & F.col("text").isNotNull() & (F.length("text") <= sample_chars)
    )
    ids = rows.select("doc_id").join(marks, "doc_id", "left_semi").distinct()
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(_PARTS))
    chosen = marks.join(ids, "doc_id").withColumn("part", part)
    # First within parts of a label, so no task meets what all tasks found of a frequent one.
    for group in (["toxic", "part"], ["toxic"]):
        order = Window.partitionBy(*group).orderBy(F.xxhash64("doc_id"), "doc_id")
        chosen = chosen.withColumn("place", F.row_number().over(order)).filter(
            F.col("place") <= per_label
        ).drop("place")
    # At most per_label ids of each of two labels, which bounds the broadcast.
    return rows.join(F.broadcast(chosen.select("doc_id", "toxic")), "doc_id").groupBy(
        "doc_id", "toxic"
    ).agg(F.max("text").alias("text"))


def learn(
    docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, sample_chars: int = SAMPLE_CHARS
) -> ToxicityModel:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        places, sizes = [], []
        for text in batch.column(0).to_pylist():
            found, counts = [], []
            for sentence in _SENTENCE.findall(text):
                own = [place for word in sentence_words(sentence) for place in features(word)]
                if own:
                    found += own
                    counts.append(len(own))
            places.append(np.array(found, np.int32).tobytes())
            sizes.append(np.array(counts, np.int32).tobytes())
        return pa.RecordBatch.from_arrays(
            [batch.column(1), batch.column(2), pa.array(places, pa.binary()), pa.array(sizes, pa.binary())],
            ["doc_id", "toxic", "places", "sizes"],
        )

    rows = training_rows(docs, labels, per_label, sample_chars)
    sample = common.map_batches(
        rows.select("text", "doc_id", "toxic"), run,
        "doc_id long, toxic boolean, places binary, sizes binary",
    ).toArrow().sort_by("doc_id")
    toxic = np.array(sample.column("toxic").to_pylist(), bool)
    if not toxic.any():
        return ToxicityModel()
    if toxic.all():
        return ToxicityModel(constant=1.0)
    sizes = [np.frombuffer(x, np.int32) for x in sample.column("sizes").to_pylist()]
    places = np.frombuffer(b"".join(sample.column("places").to_pylist()), np.int32)
    return ToxicityModel.fit(
        places, np.concatenate(sizes), np.array([len(x) for x in sizes]), toxic
    )


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` with score and offending (start, end, score of sentences, in code points)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("score", "offending")
    place = docs.columns.index("text")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            texts = batch.column(place).to_pylist()
            scored = [scorer.document(text or "") for text in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns, pa.array([s for s, _ in scored], pa.float64()),
                    pa.array([found for _, found in scored], kind),
                ],
                [*batch.schema.names, "score", "offending"],
            )

    fields = docs.select(
        "*", F.lit(0.0).cast("double").alias("score"),
        F.lit(None).cast("array<struct<start:bigint,end:bigint,score:double>>").alias("offending"),
    ).schema
    return docs.mapInArrow(run, fields)
