"""Quality scores by positive-unlabelled learning.

A logistic model is fitted to trusted positives and unlabelled web text by
minimising the non-negative unbiased risk: with class prior p, the risk of the
negatives is that of the unlabelled minus p times that of the positives taken
as negative; where it falls below zero, the model has overfitted and steps back.
Negative labels are never used. The prior is estimated from the same two
samples: a first model that tells positives from unlabelled orders all texts,
and the prior is the lowest ratio of both distributions above a threshold, with
an allowance for sampling error.

Features describe form only: shares of character classes and of their
neighbours, word and line lengths, repeats.

Fitting uses about ``MAX_POSITIVE`` positives and ``MAX_UNLABELLED`` unlabelled
rows and never more (all, if there are fewer), chosen by a hash of id and text.
Rows that are equal in both are counted first, and weigh in the sample as they
do in the table. The same rows give the same model, however they are split.
Scoring is one pass over all texts without a shuffle.

Edge cases: NULL and empty texts have all features 0 and a score like others.
Texts of any length are read whole. Repeated rows are scored each for itself. A
label without document, or whose document comes twice, is no problem: every
match counts. Without positives or unlabelled texts the score is the prior 0.5.
An empty table gives an empty result; new columns whose name is taken get
underscores in front.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.llm.arrow import mapped, raw_texts, slices
from cairn.llm.samples import sample
from cairn.llm.text import fresh, quoted

MAX_POSITIVE, MAX_UNLABELLED = 5_000, 15_000
STEPS, RATE, DECAY = 400, 0.05, 1e-3
PART_BYTES = 2 << 20

# Character classes: each ASCII mark is one, the rest are grouped.
MARKS = [b for b in range(33, 127) if not chr(b).isalnum()]
LOWER, UPPER, DIGIT, SPACE, NEWLINE, HIGH, CONTROL = range(7)
N_CLASSES = 7 + len(MARKS)


def _classes() -> tuple[np.ndarray, np.ndarray]:
    fine = np.full(256, CONTROL)
    fine[128:] = HIGH
    for start, end, kind in ((97, 123, LOWER), (65, 91, UPPER), (48, 58, DIGIT), (9, 14, SPACE), (32, 33, SPACE)):
        fine[start:end] = kind
    fine[10] = NEWLINE
    for i, b in enumerate(MARKS):
        fine[b] = 7 + i
    return fine, np.minimum(fine, 7)


FINE, COARSE = _classes()
N_FEATURES = 2 * N_CLASSES + 64 + 8


def features(texts: list[bytes]) -> np.ndarray:
    """One row of features per text."""
    n = len(texts)
    lengths = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    owner = np.repeat(np.arange(n), lengths)
    per = np.maximum(lengths, 1)[:, None]
    shares = np.bincount(owner * N_CLASSES + FINE[data], minlength=n * N_CLASSES).reshape(n, N_CLASSES) / per
    coarse = COARSE[data]
    same = owner[1:] == owner[:-1]
    pairs = owner[1:][same] * 64 + coarse[:-1][same] * 8 + coarse[1:][same]
    neighbours = np.bincount(pairs, minlength=n * 64).reshape(n, 64) / per
    form = np.array([_form(t) for t in texts]).reshape(n, 8)
    return np.hstack([shares, np.log1p(100 * shares), neighbours, form]).astype(np.float32)


def _form(text: bytes) -> list[float]:
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    if not words:
        return [0.0] * 8
    windows = max(1, len(words) - 2)
    repeats = 1 - len(set(zip(words, words[1:], words[2:], strict=False))) / windows if len(words) > 2 else 0.0
    dup_lines = 1 - len(set(lines)) / len(lines)
    capitals = sum(w.isupper() for w in words) / len(words)
    return [
        np.log1p(len(words)),
        sum(map(len, words)) / len(words),
        1 - len(set(words)) / len(words),
        repeats,
        np.log1p(20 * repeats),
        dup_lines,
        capitals,
        len(lines) / len(words),
    ]


@dataclass
class Model:
    """A logistic model on standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None) -> Model:
    """Minimise the risk; without prior, tell positives from unlabelled."""
    mean, scale = unlabelled.mean(0), unlabelled.std(0) + 1e-3
    p, u = (np.clip((x - mean) / scale, -8, 8).astype(np.float64) for x in (positive, unlabelled))
    w, moments = np.zeros(p.shape[1] + 1), np.zeros((2, p.shape[1] + 1))

    def chance(x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))

    def pull(x: np.ndarray, slope: np.ndarray) -> np.ndarray:
        return np.append(x.T @ slope, slope.sum()) / len(x)

    for step in range(1, STEPS + 1):
        sp, su = chance(p), chance(u)
        if prior is None:
            gradient = pull(p, sp - 1) + pull(u, su)
        else:
            # Logistic loss: -log s for positives, -log(1 - s) for negatives.
            negative = -np.log1p(-np.minimum(su, 1 - 1e-12)).mean() + prior * np.log1p(-np.minimum(sp, 1 - 1e-12)).mean()
            as_negative = pull(u, su) - prior * pull(p, sp)
            gradient = prior * pull(p, sp - 1) + as_negative if negative >= 0 else -as_negative
        gradient[:-1] += DECAY * w[:-1]
        moments[0] += 0.1 * (gradient - moments[0])
        moments[1] += 0.001 * (gradient**2 - moments[1])
        w -= RATE * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, w[:-1], float(w[-1]), prior or 0.5)


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled.

    Half of each sample fits the ordering model, the other half is ordered. Of
    all thresholds the one counts at which unlabelled texts above it, in
    relation to positives above it, are fewest, sampling error included.
    """
    model = fit(positive[::2], unlabelled[::2], None)
    p, u = np.sort(model(positive[1::2])), np.sort(model(unlabelled[1::2]))
    if not len(p) or not len(u):
        return 0.5
    above_p = 1 - np.arange(len(p)) / len(p)
    above_u = 1 - np.searchsorted(u, p) / len(u)
    error = np.sqrt(np.log(40) / (2 * len(u))) + np.sqrt(np.log(40) / (2 * len(p)))
    best = np.argmin((above_u + error) / above_p)
    return float(np.clip(above_u[best] / above_p[best], 0.05, 0.95))


def remainder(id_column: Column, divisor: int) -> Column:
    """The CRC-32 of an id as text, modulo a number."""
    return F.crc32(id_column.cast("string")) % divisor


def sampled(docs: DataFrame, limit: int, ids: DataFrame | None = None) -> np.ndarray:
    """Features of at most ``limit`` rows of ``id`` and ``t``, equal rows as often as their share asks for.

    ``ids`` bounds the rows to those whose ``id`` is listed.
    """
    def listed(rows: DataFrame) -> DataFrame:
        return rows if ids is None else rows.join(ids, F.col("also0") == F.col("trusted_id"), "left_semi")

    chosen = sample(docs, F.coalesce("t", F.lit("")), [F.col("id")], limit, copies=True, among=listed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "value", PART_BYTES):
                found = [r.tobytes() for r in features(raw_texts(part.column("value")))]
                columns = [part.column("place"), part.column("weight"), pa.array(found, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["place", "weight", "x"])

    found = chosen.mapInArrow(run, "place int, weight long, x binary").orderBy("place").collect()
    rows = np.array([np.frombuffer(r.x, np.float32) for r in found]).reshape(len(found), N_FEATURES)
    return np.repeat(rows, [r.weight for r in found], axis=0)


def learn(
    docs: DataFrame,
    positives: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    max_positive: int = MAX_POSITIVE,
    max_unlabelled: int = MAX_UNLABELLED,
) -> Model:
    """Fit to unlabelled documents and the ids of trusted ones.

    ``positives`` has one column of ids.
    """
    docs = docs.select(F.col(quoted(id_column)).alias("id"), F.col(quoted(text)).alias("t"))
    ids = positives.select(F.col(positives.columns[0]).alias("trusted_id")).where("trusted_id is not null").distinct()
    p, u = sampled(docs, max_positive, ids), sampled(docs, max_unlabelled)
    if not len(p) or not len(u):
        return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES), 0.0, 0.5)
    return fit(p, u, estimated_prior(p, u))


def score(docs: DataFrame, model: Model, text: str = "text") -> tuple[DataFrame, str]:
    """The input with a score from 0 to 1, and the name of its column."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    name = fresh("score", docs.columns)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, PART_BYTES):
                scores = shared.value(features(raw_texts(part.column(place))))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64())], names=schema.names)

    return mapped(docs, run, schema), name
