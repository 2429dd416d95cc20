"""Quality classifier: ordinal cumulative-link regression over hashed text.

Graded ratings 0 < 1 < .. < K share one weight per hashed feature: a document's score s is one number, and
P(grade >= k) = sigmoid(s - threshold_k) with ascending thresholds. That gives the expected grade and the tail probability
of the top grade, by which documents are selected.

A feature belongs to a distinct unit between spaces: its word, the word's first letters, the marks behind it and its case.
Their values are summed over the document's distinct units and divided by the root of their number, so long and short
documents are comparable; a few features of the whole document (length, repetition) are added.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import whole_text

FEATURE_BITS = 18
SAMPLE_ROWS = 8192  # labelled documents the fit uses at most
EPOCHS = 40
BATCH = 256
RATE = 2.0
DECAY = 1e-6
UNITS_HELD = 400_000

MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _slot(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "replace")) & (1 << FEATURE_BITS) - 1


def unit_slots(unit: str) -> list[int]:
    """The hashed features of one unit."""
    rest = unit.lstrip(MARKS)
    word = rest.rstrip(MARKS)
    lower = word.lower()
    case = "none" if not word else "lower" if word == lower else "upper" if word.isupper() else "title"
    found = [_slot("w:" + lower), _slot(f"m:{unit[:len(unit) - len(rest)][:4]} {rest[len(word):][:4]} {case}")]
    if len(lower) > 4:
        found.append(_slot("p:" + lower[:4]))
    return found


def document_slots(units: list[str], distinct: int) -> list[int]:
    """The hashed features of the whole document."""
    n = len(units)
    doubled = sum(map(eq, units, units[1:]))
    repeated = 10 * (n - distinct) // n if n else 0
    return [_slot("bias"), _slot(f"length:{n.bit_length()}"), _slot(f"doubled:{10 * doubled // n if n else 0}"), _slot(f"repeated:{repeated}")]


@dataclass(frozen=True)
class OrdinalModel:
    weights: np.ndarray
    thresholds: tuple[float, ...]

    def tail(self, score: Column, grade: int) -> Column:
        """P(grade or better)."""
        return 1 / (1 + F.exp(F.lit(self.thresholds[grade - 1]) - score))

    def expected(self, score: Column) -> Column:
        total = F.lit(0.0)
        for grade in range(1, len(self.thresholds) + 1):
            total = total + self.tail(score, grade)
        return total

    def score(self, text: Column) -> Column:
        """The document's score, from its whole text."""
        weights = self.weights

        @F.pandas_udf("double")
        def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            held: dict[str, float] = {}
            listed = weights.tolist()
            for texts in batches:
                yield pd.Series([_score(t, listed, held) for t in texts], dtype="float64")

        return scored(text)


def _score(text: str, weights: list[float], held: dict[str, float]) -> float:
    units = text.split()
    distinct = dict.fromkeys(units)
    new = [u for u in distinct if u not in held]  # never runs over all that is held
    if new:
        if len(held) + len(new) > UNITS_HELD:
            held.clear()
            new = distinct
        for unit in new:
            held[unit] = sum([weights[s] for s in unit_slots(unit)])
    total = math.fsum(map(held.__getitem__, distinct)) / math.sqrt(max(1, len(distinct)))
    return total + sum([weights[s] for s in document_slots(units, len(distinct))])


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(slots, values) of a document."""
    units = text.split()
    distinct = dict.fromkeys(units)
    slots, counts = np.unique(np.array([s for u in distinct for s in unit_slots(u)], np.int64), return_counts=True)
    whole = document_slots(units, len(distinct))
    values = counts / math.sqrt(max(1, len(distinct)))
    return np.concatenate([slots, whole]), np.concatenate([values, np.ones(len(whole))])


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [features(t) for t in batch.column("_text").to_pylist()]
        yield pa.record_batch(
            [batch.column("grade").cast(pa.int32()), [s.astype("<i4").tobytes() for s, _ in made], [v.astype("<f4").tobytes() for _, v in made]],
            names=["grade", "slots", "numbers"],
        )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def _ratio(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """sigmoid(x) / sigmoid(y) for x <= y, without overflow."""
    return np.exp(np.minimum(-np.logaddexp(0, -x) + np.logaddexp(0, -y), 0.0))


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], grades: int, *, epochs: int = EPOCHS, seed: int = 0) -> OrdinalModel:
    """Weights and thresholds from (grade, slots, values), by adaptive gradient steps on the log likelihood;
    the epoch that lost least is returned."""
    dim = 1 << FEATURE_BITS
    weights, seen = np.zeros(dim), np.full(dim, 1e-6)
    share = np.array([(sum(g >= k for g, _, _ in rows) + 1) / (len(rows) + 2) for k in range(1, grades)])
    first = -np.log(share / (1 - share))
    steps = np.log(np.maximum(np.diff(first), 1e-2))  # thresholds: first, then steps of exp(..): always ascending
    cuts = np.concatenate([first[:1], steps])
    cuts_seen = np.full(len(cuts), 1e-6)
    order = np.random.default_rng(seed)
    best = (math.inf, weights.copy(), cuts.copy())
    for _ in range(epochs if rows else 0):
        shuffled, lost = order.permutation(len(rows)), 0.0
        for at in range(0, len(rows), BATCH):
            part = [rows[i] for i in shuffled[at : at + BATCH]]
            sizes = [len(s) for _, s, _ in part]
            slots, values = np.concatenate([s for _, s, _ in part]), np.concatenate([v for _, _, v in part])
            owner = np.repeat(np.arange(len(part)), sizes)
            score = np.bincount(owner, weights[slots] * values, len(part))
            grade = np.array([g for g, _, _ in part])
            limits = np.concatenate([[-np.inf], np.cumsum(np.concatenate([cuts[:1], np.exp(cuts[1:])])), [np.inf]])
            low, high = _sigmoid(score - limits[grade]), _sigmoid(score - limits[grade + 1])
            lost -= float(np.log(np.maximum(low - high, 1e-300)).sum())
            pull = low + high - 1  # the slope of the loss by score: exact and within one, however small the chance
            room = 1 - np.exp(limits[grade] - limits[grade + 1])
            at_low = _ratio(limits[grade] - score, limits[grade + 1] - score) / room
            at_high = _ratio(score - limits[grade + 1], score - limits[grade]) / room
            slope = np.bincount(slots, pull[owner] * values, dim) / len(part) + DECAY * weights
            seen += slope * slope
            weights -= RATE * slope / np.sqrt(seen)
            by_limit = np.zeros(grades + 1)
            np.add.at(by_limit, grade, at_low)
            np.add.at(by_limit, grade + 1, -at_high)
            inner = by_limit[1:grades] / len(part)
            later = np.cumsum(inner[::-1])[::-1]
            change = later * np.concatenate([[1.0], np.exp(cuts[1:])])
            cuts_seen += change * change
            cuts -= RATE * change / np.sqrt(cuts_seen)
        if lost < best[0]:
            best = (lost, weights.copy(), cuts.copy())
    _, weights, cuts = best
    limits = np.cumsum(np.concatenate([cuts[:1], np.exp(cuts[1:])]))
    return OrdinalModel(weights.astype(np.float32), tuple(float(x) for x in limits))


def labelled_sample(
    docs: DataFrame, ratings: DataFrame, *, doc_id: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """(grade, _text) of at most ``sample_rows`` rated documents, chosen by a hash of their id.

    ``ratings`` is (doc_id, grade). Rows with a null in either do not count; a document rated more than once takes its
    lowest grade, an id that stands at several texts its largest text.
    """
    rated = ratings.where("doc_id is not null and grade is not null").groupBy("doc_id").agg(F.min("grade").alias("grade"))
    chosen = rated.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    texts = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("_text"))
    found = texts.join(F.broadcast(chosen), "doc_id")  # sample_rows rows at most
    return found.groupBy("doc_id").agg(F.first("grade").alias("grade"), F.max("_text").alias("_text")).select("grade", "_text")


def fit_on(sample: DataFrame, grades: int) -> OrdinalModel:
    """Fit on the rows of ``labelled_sample``; without rows every document gets the same score."""
    made = sample.select("grade", "_text").mapInArrow(_feature_batches, "grade int, slots binary, numbers binary")
    rows = sorted((r.grade, bytes(r.slots), bytes(r.numbers)) for r in made.collect())  # bounded by the sample
    return fit([(g, np.frombuffer(s, "<i4"), np.frombuffer(v, "<f4")) for g, s, v in rows], grades)


def criteria_grades(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) of (doc_id, quality, toxic): the number of criteria passed, 0 to 2. A null label gives no grade."""
    return labels.select("doc_id", (F.col("quality") + 1 - F.col("toxic")).cast("int").alias("grade"))


def rate(docs: DataFrame, model: OrdinalModel, *, doc_id: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """One row per document: doc_id, expected_grade, tail_probability (of the top grade), kept (tail at least ``least``).

    Null text counts as empty; an empty text is rated by the whole document's features alone. Repeated rows are rated
    each, null ids too; an empty table gives an empty result; other columns are not read.
    """
    top = len(model.thresholds)
    rows = docs.select(F.col(doc_id).alias("doc_id"), model.score(whole_text(text)).alias("_score"))
    return rows.select(
        "doc_id", model.expected(F.col("_score")).alias("expected_grade"), model.tail(F.col("_score"), top).alias("tail_probability")
    ).withColumn("kept", F.col("tail_probability") >= least)


def keep_good(docs: DataFrame, model: OrdinalModel, *, text: str = "text", least: float = 0.5) -> DataFrame:
    """The documents whose tail probability is at least ``least``, with all their columns."""
    return docs.where(model.tail(model.score(whole_text(text)), len(model.thresholds)) >= least)
