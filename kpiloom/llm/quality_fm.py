"""Quality classifier: a factorisation machine over words, structure and metadata.

A document is a sparse vector: hashed lower-cased words (length-normalised square roots of
counts), one-hot bins of structure statistics, and bins of the recorded length. The score is
``sigmoid(w0 + sum w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2))``, linear in
the non-zero entries. Labels, language, source and id never enter the vector.

Scoring is a Pandas UDF over two columns. Fitting uses at most ``sample_rows`` labelled rows,
taken in the order of a hash of their id; a few MB of vectors reach the driver.

Defined results: NULL and empty texts have no word and are scored by bias and length bins; texts of
any length are read whole; repeated rows score alike, each for itself; rows without id are scored but
never learnt from; a label that is given twice counts once for each row it meets; ties in the order of
the sample are settled by the vectors; an empty table gives an empty result; without labels every score
is one half. Extra columns stay; one called like a result column gives way to it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import utf8, window_hashes, without, word_hashes

_BINS = 12
_SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>!=~^_{}[]\\/@+"))
_ENDS = np.isin(np.arange(256), list(b".?!"))
_UPPER = np.isin(np.arange(256), list(range(65, 91)))
_LOWER = np.isin(np.arange(256), list(range(97, 123)))
_DIGIT = np.isin(np.arange(256), list(range(48, 58)))


@dataclass(frozen=True)
class Settings:
    """``sample_rows`` bounds the labelled rows used for fitting, whatever the corpus size."""

    buckets: int = 1 << 15
    rank: int = 8
    sample_rows: int = 8192
    epochs: int = 8
    batch: int = 128
    rate: float = 0.05
    decay: float = 1e-5
    seed: int = 11
    threshold: float = 0.3


@dataclass(frozen=True)
class Model:
    settings: Settings
    bias: float
    weights: np.ndarray
    factors: np.ndarray


def _shares(data: bytes) -> list[float]:
    """Structure statistics, each between 0 and 1; all zero for a text without words."""
    array = np.frombuffer(data, dtype=np.uint8)
    words, starts, ends = word_hashes(data)
    n = len(words)
    if n == 0:
        return [0.0] * 21
    lengths = ends - starts
    first, last = array[starts], array[ends - 1]
    lines = [x for x in (x.strip() for x in data.split(b"\n")) if x]
    windows = window_hashes(words, 5)
    upper_before = np.concatenate(([0], np.cumsum(_UPPER[array])))
    capitals = (upper_before[ends] - upper_before[starts]) * 2 > lengths
    size = len(array)
    by_line = np.array([len(x) for x in lines])
    return [
        min(1.0, np.log1p(n) / 12), min(1.0, lengths.mean() / 20), min(1.0, lengths.std() / 20),
        min(1.0, np.log1p(lengths.max()) / 8), _UPPER[array].sum() / size, _LOWER[array].sum() / size,
        _DIGIT[array].sum() / size, _SYMBOLS[array].sum() / size, (array >= 128).sum() / size,
        capitals.mean(), _SYMBOLS[last].mean(), _SYMBOLS[first].mean(), _ENDS[last].mean(),
        (_SYMBOLS[first] & (lengths == 1)).mean(), _UPPER[first].mean(),
        len(np.unique(words)) / n, 1 - len(np.unique(windows)) / len(windows),
        1 - len(set(lines)) / len(lines), min(1.0, np.log1p(len(lines)) / 8),
        min(1.0, np.log1p(by_line.mean()) / 10), min(1.0, np.log1p(n / len(lines)) / 8),
    ]


_N_SHARES = 21


def vector(text: str | None, n_chars: float | None, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted-free sparse vector: word buckets first, then one entry per statistic."""
    data = utf8(text)
    words, _, _ = word_hashes(data.lower())
    index, counts = np.unique((words % np.uint64(buckets)).astype(np.int32), return_counts=True)
    value = np.sqrt(counts.astype(np.float32))
    if len(value):
        value /= np.sqrt((value**2).sum())
    known = n_chars is not None and np.isfinite(n_chars) and n_chars >= 0
    shares = np.array(_shares(data) + [min(1.0, np.log1p(n_chars) / 16) if known else 0.0])
    # Small shares matter most: the bins widen with the square root.
    bins = np.minimum((np.sqrt(shares) * (_BINS - 2)).astype(np.int32) + 1, _BINS - 1)
    if not known:
        bins[-1] = 0
    if not len(words):
        bins[:-1] = 0
    stats = buckets + np.arange(len(bins), dtype=np.int32) * _BINS + bins
    return (
        np.concatenate((index, stats)).astype(np.int32),
        np.concatenate((value, np.full(len(stats), 0.5, dtype=np.float32))),
    )


def dimension(settings: Settings) -> int:
    return settings.buckets + (_N_SHARES + 1) * _BINS


def _rows_of(vectors: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(i) for i, _ in vectors])
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    return np.concatenate([i for i, _ in vectors]), np.concatenate([v for _, v in vectors]), starts


def _margin(model_w, model_v, bias, index, value, starts):
    weighted = model_v[index] * value[:, None]
    sums = np.add.reduceat(weighted, starts, axis=0)
    squares = np.add.reduceat(weighted**2, starts, axis=0)
    linear = np.add.reduceat(model_w[index] * value, starts)
    return bias + linear + 0.5 * (sums**2 - squares).sum(axis=1), sums


def train(vectors: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, settings: Settings) -> Model:
    """Logistic loss, mini-batches, per-coordinate adaptive steps."""
    rng = np.random.default_rng(settings.seed)
    size = dimension(settings)
    w = np.zeros(size)
    v = rng.normal(0, 0.05, (size, settings.rank))
    seen_w, seen_v = np.full(size, 1e-2), np.full((size, settings.rank), 1e-2)
    bias = 0.0
    if len(labels) and 0 < labels.mean() < 1:
        bias = float(np.log(labels.mean() / (1 - labels.mean())))
        for _ in range(settings.epochs):
            order = rng.permutation(len(labels))
            for at in range(0, len(order), settings.batch):
                chosen = order[at : at + settings.batch]
                index, value, starts = _rows_of([vectors[k] for k in chosen])
                margin, sums = _margin(w, v, bias, index, value, starts)
                error = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[chosen]
                row = np.repeat(np.arange(len(chosen)), np.diff(np.append(starts, len(index))))
                pull = (error[row] * value)[:, None]
                by = np.argsort(index, kind="stable")
                touched, first = np.unique(index[by], return_index=True)
                slope_w = np.add.reduceat(pull[by, 0], first) + settings.decay * w[touched]
                slope_v = np.add.reduceat(
                    (pull * (sums[row] - v[index] * value[:, None]))[by], first, axis=0
                ) + settings.decay * v[touched]
                seen_w[touched] += slope_w**2
                seen_v[touched] += slope_v**2
                w[touched] -= settings.rate * slope_w / np.sqrt(seen_w[touched])
                v[touched] -= settings.rate * slope_v / np.sqrt(seen_v[touched])
                bias -= settings.rate * float(error.mean())
    else:
        v[:] = 0.0
        if len(labels):
            bias = 5.0 if labels[0] else -5.0
    return Model(settings, bias, w.astype(np.float32), v.astype(np.float32))


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: crc32 of the id as text divisible by 5 (NULL id counts as '')."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def _n_chars(docs: DataFrame) -> Column:
    return (F.col("n_chars") if "n_chars" in docs.columns else F.lit(None)).cast("double")


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Fit on at most ``sample_rows`` labelled, not held-out rows.

    NULL labels and NULL ids are ignored; of contradicting labels for one id the larger
    counts. Without labels the score is 0.5, with labels of one class a constant near it.
    """
    chosen = (
        labels.where("quality IS NOT NULL AND doc_id IS NOT NULL")
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("quality").cast("double").alias("_label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.sample_rows)
    )
    buckets = settings.buckets

    def vectors(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            pairs = [vector(t, n, buckets) for t, n in zip(frame["text"], frame["n"])]
            yield pd.DataFrame({
                "h": frame["h"], "label": frame["label"],
                "i": [i.tobytes() for i, _ in pairs], "v": [v.tobytes() for _, v in pairs],
            })

    # The labels are at most sample_rows rows, so every task can hold them.
    joined = docs.join(F.broadcast(chosen), "doc_id").select(
        F.xxhash64("doc_id", "text").alias("h"), F.col("_label").alias("label"),
        "text", _n_chars(docs).alias("n"),
    )
    rows = (
        joined.mapInPandas(vectors, "h long, label double, i binary, v binary")
        .orderBy("h", "i").limit(settings.sample_rows).collect()
    )
    pairs = [(np.frombuffer(r.i, np.int32), np.frombuffer(r.v, np.float32)) for r in rows]
    return train(pairs, np.array([r.label for r in rows]), settings)


def score(docs: DataFrame, model: Model, out: str = "score", predicted: str = "predicted") -> DataFrame:
    """Add ``out`` (0 to 1) and ``predicted`` (0 or 1) to every row, all columns kept.

    NULL texts score as empty ones. Columns already named ``out`` or ``predicted`` are replaced.
    """

    @F.pandas_udf("double")
    def scored(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, lengths in batches:
            margins = [
                _margin(model.weights, model.factors, model.bias, i, x, np.array([0]))[0][0]
                for i, x in (vector(t, n, model.settings.buckets) for t, n in zip(texts, lengths))
            ]
            yield pd.Series(1 / (1 + np.exp(-np.clip(np.array(margins, dtype=float), -30, 30))))

    return (
        without(docs, out, predicted)
        .withColumn(out, scored(F.col("text"), _n_chars(docs)))
        .withColumn(predicted, (F.col(out) >= model.settings.threshold).cast("int"))
    )
