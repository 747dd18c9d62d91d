"""Toxicity as ordered severity grades: cumulative-link regression on the words and word beginnings of a text."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import batch_slices

# Letters, digits and all non-ASCII bytes make words.
_BREAKS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
# Bytes of a word that make its beginnings; stems take many endings in some languages.
_BEGINNINGS = (5, 6, 7)
SAMPLE_ROWS = 8192
GRADES = 4
# Chosen on held-out labels: clean texts stay far below it.
REJECT_FROM = 0.3
_LEAST_SUPPORT = 5
_SCREEN = 2.0
_SEVERE = 4.0
_PENALTY = 1e-4
_ROUNDS = 400
_RATE = 0.5


@dataclass(frozen=True)
class SeverityModel:
    """Weights shared by all thresholds; ``P(grade >= k) = sigmoid(score - thresholds[k - 1])``."""

    weights: dict[bytes, float]
    thresholds: tuple[float, ...]

    def score(self, text: bytes) -> float:
        found = Counter()
        for word, n in Counter(text_words(text)).items():
            for name in names_of(word):
                if name in self.weights:
                    found[name] += n
        return float(sum(self.weights[f] * math.log1p(found[f]) for f in sorted(found)))


def text_words(text: bytes) -> list[bytes]:
    return text.translate(_BREAKS).lower().split()


def names_of(word: bytes) -> list[bytes]:
    """The features a word counts for: itself, and its beginnings if it is longer."""
    return [word, *[word[:n] + b"-" for n in _BEGINNINGS if len(word) > n]]


def features_of(text: bytes) -> dict[bytes, float]:
    found = Counter()
    for word, n in Counter(text_words(text)).items():
        for name in names_of(word):
            found[name] += n
    return {name: math.log1p(found[name]) for name in sorted(found)}


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``(toxic, names, amounts)`` of at most ``rows`` labelled documents, those with the lowest hashed ids.

    The bound is a parameter of the fit; equal texts count once. Only features leave the executors.
    """
    picked = (
        labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .select("doc_id", "toxic").orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(rows)
    )
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batch_slices(batches, "text"):
            found = [features_of(t.as_py()) for t in batch.column("text").cast(pa.binary())]
            names = pa.array([list(f) for f in found], pa.list_(pa.binary()))
            amounts = pa.array([list(f.values()) for f in found], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), names, amounts], ["toxic", "names", "amounts"])

    joined = texts.join(F.broadcast(picked), "doc_id").select(F.col("toxic").cast("int"), "text")
    once = joined.groupBy("text").agg(F.max("toxic").alias("toxic"))
    return once.select("toxic", "text").mapInArrow(featured, "toxic int, names array<binary>, amounts array<float>")


def _grades(toxic: np.ndarray, hits: np.ndarray, grades: int) -> np.ndarray:
    """Grade 0 for clean texts; toxic ones by how many telling features they hold, in equal shares."""
    out = np.zeros(len(toxic), np.int64)
    if toxic.any():
        cuts = np.quantile(hits[toxic], np.arange(1, grades - 1) / (grades - 1))
        out[toxic] = 1 + np.searchsorted(np.unique(cuts), hits[toxic], side="left")
    return out


def fit_severity(sample: pa.Table, grades: int = GRADES) -> SeverityModel:
    """Fit weights and thresholds by proximal gradient steps with an L1 penalty.

    The labels only say toxic or not. Features whose odds in toxic texts are higher by over four
    standard errors are telling, and the number of telling ones orders the toxic texts into grades. Features
    below two standard errors are left out, and the penalty sets most others to zero. Without labels, or
    with labels of one kind only, no feature has a weight and the thresholds say how often a text is toxic.
    """
    toxic = sample.column("toxic").to_numpy().astype(bool)
    lists = sample.column("names").combine_chunks()
    amount = sample.column("amounts").combine_chunks().flatten().to_numpy()
    coded = lists.flatten().dictionary_encode()
    codes = coded.indices.to_numpy()
    row = np.repeat(np.arange(len(toxic), dtype=np.int32), lists.value_lengths().to_numpy())
    size = max(len(coded.dictionary), 1)
    in_toxic = np.bincount(codes[toxic[row]], minlength=size)
    in_clean = np.bincount(codes, minlength=size) - in_toxic
    bad, good = toxic.sum(), (~toxic).sum()
    odds = np.log((in_toxic + 0.5) / (bad - in_toxic + 0.5)) - np.log((in_clean + 0.5) / (good - in_clean + 0.5))
    error = np.sqrt(sum(1 / (n + 0.5) for n in (in_toxic, bad - in_toxic, in_clean, good - in_clean)))
    z = np.where(in_toxic + in_clean >= _LEAST_SUPPORT, odds / error, 0.0)
    telling = np.bincount(row[(z >= _SEVERE)[codes]], minlength=len(toxic))
    grade = _grades(toxic, telling, grades)

    used = np.flatnonzero(np.abs(z) >= _SCREEN)
    place = np.full(size, -1)
    place[used] = np.arange(len(used))
    inside = (place >= 0)[codes]
    row, column, amount = row[inside], place[codes[inside]], amount[inside].astype(np.float64)
    weights, gathered = np.zeros(len(used)), np.full(len(used), 1e-6)
    shares = np.array([((grade >= k).sum() + 1) / (len(grade) + grades) for k in range(1, grades)])
    edges = np.log(1 - shares) - np.log(shares)
    edges = np.maximum.accumulate(edges + 1e-3 * np.arange(grades - 1))
    edge_gathered = np.full(grades - 1, 1e-6)
    rows = max(len(grade), 1)
    for _ in range(_ROUNDS if len(used) else 0):
        score = np.bincount(row, weights=weights[column] * amount, minlength=len(grade))
        above = 1 / (1 + np.exp(-(score[:, None] - edges[None])))  # P(grade >= k)
        bounded = np.hstack([np.ones((len(grade), 1)), above, np.zeros((len(grade), 1))])
        at, after = bounded[np.arange(len(grade)), grade], bounded[np.arange(len(grade)), grade + 1]
        slope = at + after - 1
        step = np.bincount(column, weights=slope[row] * amount, minlength=len(used)) / rows
        gathered += step**2
        rate = _RATE / np.sqrt(gathered)
        moved = weights - rate * step
        weights = np.sign(moved) * np.maximum(np.abs(moved) - rate * _PENALTY, 0)
        share = np.maximum(at - after, 1e-12)
        tilt = np.zeros(grades - 1)
        for k in range(1, grades):
            density = above[:, k - 1] * (1 - above[:, k - 1])
            tilt[k - 1] = (np.where(grade == k, density / share, 0) - np.where(grade == k - 1, density / share, 0)).mean()
        edge_gathered += tilt**2
        edges = np.maximum.accumulate(edges - 0.1 * tilt / np.sqrt(edge_gathered))
    kept = np.flatnonzero(weights)
    words = coded.dictionary.take(pa.array(used[kept])).to_pylist() if len(kept) else []
    return SeverityModel(dict(zip(words, weights[kept].tolist(), strict=True)), tuple(edges.tolist()))


def train_severity(
    docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, grades: int = GRADES
) -> SeverityModel:
    return fit_severity(labelled_sample(docs, labels, rows).toArrow(), grades)


def severity_columns(text: Column, model: SeverityModel) -> dict[str, Column]:
    """Columns ``severity_score``, ``p_toxic``, ``severity`` (expected grade) and ``grade`` (most likely) of a text.

    The model goes out with the task; its size is bounded by the features of the sample.
    """

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array([model.score(t.as_py() or b"") for t in texts.cast(pa.binary())], pa.float64())

    score = scored(F.coalesce(text, F.lit("")))
    chance = lambda k: 1 / (1 + F.exp(F.lit(model.thresholds[k]) - F.col("severity_score")))
    above = [chance(k) for k in range(len(model.thresholds))]
    exact = [a - b for a, b in zip([F.lit(1.0), *above], [*above, F.lit(0.0)], strict=True)]
    likely = F.array_position(F.array(*exact), F.array_max(F.array(*exact))) - 1
    return {"severity_score": score, "p_toxic": above[0], "severity": sum(above[1:], above[0]), "grade": likely}


def with_severity(docs: DataFrame, model: SeverityModel) -> DataFrame:
    """``docs`` with severity columns. A null or empty text has score 0; nothing depends on other rows."""
    columns = severity_columns(F.col("text"), model)
    scored = docs.withColumn("severity_score", columns.pop("severity_score"))
    return scored.withColumns(columns)


def _rejected(reject_from: float) -> Column:
    """Whether a text is rejected: only what speaks for toxicity does it, never the share of toxic labels alone."""
    return (F.col("p_toxic") >= reject_from) & (F.col("severity_score") > 0)


def toxicity(docs: DataFrame, model: SeverityModel, reject_from: float = REJECT_FROM) -> DataFrame:
    """``(doc_id, severity, p_toxic, grade, rejected)`` of every row.

    Rejected is what has ``p_toxic >= reject_from`` and a score above 0. Null and empty texts, and all texts
    under a model without weights, score 0 and pass, however many labels are toxic; null ids and repeated rows are kept; other columns are
    ignored; an empty table gives no rows.
    """
    graded = with_severity(docs.select("doc_id", "text"), model)
    return graded.select(
        "doc_id", "severity", "p_toxic", F.col("grade").cast("int").alias("grade"),
        _rejected(reject_from).alias("rejected"),
    )


def without_toxic(docs: DataFrame, model: SeverityModel, reject_from: float = REJECT_FROM) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns only, whatever those are called."""
    columns = docs.columns
    boxed = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), "text")
    kept = with_severity(boxed, model).filter(~_rejected(reject_from))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in columns])
