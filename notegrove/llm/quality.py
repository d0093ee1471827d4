"""Quality scores by a regularised quadratic discriminant.

Every text gives a row of transformed statistics. The classes are Gaussians whose
covariances are shrunk towards the pooled one and towards its diagonal; the score is the
posterior from the difference of the Mahalanobis log densities, with both Cholesky factors
computed once and sent along. Fitting needs counts, sums and products only, which Spark adds
up over all labelled rows; no sample is drawn and no text reaches the driver.

Defined results: null and empty texts have the statistics of no words and get a score;
labels that are null or of an unknown text are not learnt; a row of ``labels`` that repeats
counts as often; with no rows of a class every score is the prior of the other; an empty
table gives an empty result. Other columns of the input are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notegrove.workspace import materialize

STATISTICS = (
    "log_words", "log_chars", "word_length", "upper", "digit", "stop_comma", "symbol", "shout", "space", "not_ascii",
    "distinct_words", "repeated_word", "top_word", "repeated_line", "line_words", "ragged_words", "max_word", "log_lines",
)
SHRINK_POOLED = 0.1
SHRINK_DIAGONAL = 0.02
FLOOR = 1e-3
FOLDS = 5
THRESHOLD = 0.3

_LETTERS = np.array([65 <= b < 91 for b in range(256)])
_DIGITS = np.array([48 <= b < 58 for b in range(256)])
_SPACES = np.array([b in (9, 10, 13, 32) for b in range(256)])
_STOPS = np.array([b in b".,;:?" for b in range(256)])
_SYMBOLS = np.array([b in b"#$%&*+/<=>@[\\]^_`{|}~" for b in range(256)])
_ASCII = np.arange(256) < 128


def statistics(text: str | None) -> np.ndarray:
    """The transformed statistics of one text, in the order of ``STATISTICS``. Shares enter
    by the logarithm, so that a tenth and a hundredth are as far apart as a hundredth and a
    thousandth."""
    text = text or ""
    raw = np.bincount(np.frombuffer(text.encode(errors="replace"), np.uint8), minlength=256)
    size = max(int(raw.sum()), 1)
    words = text.split()
    n = max(len(words), 1)
    lines = [x for x in text.split("\n") if x.strip()]
    share = lambda mask: float(raw[mask].sum()) / size
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    same = sum(a == b for a, b in pairwise(words))
    shown = [share(_LETTERS), share(_DIGITS), share(_STOPS), share(_SYMBOLS), float(raw[33]) / size, share(_SPACES), share(~_ASCII)]
    ragged = sum(not w.isalpha() for w in counts) / max(len(counts), 1)
    rest = [len(counts) / n, same / n, max(counts.values(), default=0) / n, 1 - len(set(lines)) / max(len(lines), 1)]
    log = lambda x: np.log(np.asarray(x) + FLOOR)
    letters = sum(map(len, words))
    return np.concatenate(
        [
            [np.log1p(len(words)), np.log1p(len(text)), letters / n],
            log(shown),
            # The share of distinct words falls with length; its logarithm per log length doesn't.
            [np.log(max(len(counts), 1)) / np.log(n + 1.0) if n > 1 else 1.0],
            log(rest[1:]),
            [np.log1p(n / max(len(lines), 1))],
            log([ragged]),
            [np.log1p(max(map(len, words), default=0)), np.log1p(len(lines))],
        ]
    )


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One narrow row per input row: doc_id and the statistics of the whole text."""
    schema = pa.schema([("doc_id", pa.int64()), ("x", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [statistics(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], schema=schema)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col)).mapInArrow(run, "doc_id long, x array<double>")


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "utf-8")) % FOLDS == 0, F.lit(False))


def moments(rows: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Count, sum and sum of products of ``x`` by ``label`` (0 or 1): one row per label and
    pair of statistics reaches the driver, added up in the tasks first."""
    d = len(STATISTICS)
    upper = [(i, j) for i in range(-1, d) for j in range(i, d)]  # -1 stands for the constant 1
    at = lambda i: F.lit(1.0) if i < 0 else F.col("x")[i]
    sums = rows.groupBy("label").agg(*(F.sum(at(i) * at(j)).alias(f"s{k}") for k, (i, j) in enumerate(upper)))
    out = {}
    for r in sums.collect():
        full = np.zeros((d + 1, d + 1))
        for v, (i, j) in zip(r[1:], upper, strict=True):
            full[i + 1, j + 1] = full[j + 1, i + 1] = v
        out[r["label"]] = full[0, 0], full[0, 1:], full[1:, 1:]
    return out


@dataclass(frozen=True)
class Discriminant:
    """Priors, means and the inverse Cholesky factors of both classes."""

    prior: float
    means: np.ndarray
    whiten: np.ndarray
    log_det: np.ndarray

    @staticmethod
    def fit(sums: dict[int, tuple[float, np.ndarray, np.ndarray]], pooled: float = SHRINK_POOLED, diagonal: float = SHRINK_DIAGONAL) -> Discriminant:
        d = len(STATISTICS)
        n = np.array([sums[c][0] if c in sums else 0.0 for c in (0, 1)])
        if not n.all():
            return Discriminant(float(n[1] > 0) if n.any() else 0.5, np.zeros((2, d)), np.zeros((2, d, d)), np.zeros(2))
        means = np.array([sums[c][1] / n[c] for c in (0, 1)])
        spread = np.array([sums[c][2] / n[c] - np.outer(means[c], means[c]) for c in (0, 1)])
        common = np.tensordot(n / n.sum(), spread, 1)
        floor = np.diag(np.maximum(np.diag(common), 1e-6))
        whiten, log_det = [], []
        for own in spread:
            shrunk = (1 - pooled) * own + pooled * common
            shrunk = (1 - diagonal) * shrunk + diagonal * floor
            factor = np.linalg.cholesky(shrunk)
            whiten.append(np.linalg.inv(factor))
            log_det.append(2 * np.log(np.diag(factor)).sum())
        return Discriminant(float(n[1] / n.sum()), means, np.array(whiten), np.array(log_det))

    def scores(self, x: np.ndarray) -> np.ndarray:
        """The posterior of class 1."""
        if not 0 < self.prior < 1:
            return np.full(len(x), self.prior)
        logs = [-0.5 * (((x - m) @ w.T) ** 2).sum(1) - 0.5 * det for m, w, det in zip(self.means, self.whiten, self.log_det, strict=True)]
        z = logs[1] - logs[0] + np.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(rows: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id") -> Discriminant:
    """Learn from the labelled rows outside the held-out fold."""
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).filter("label IN (0, 1)")
    return Discriminant.fit(moments(rows.join(known.filter(~held_out(F.col("doc_id"))), "doc_id")))


def score(rows: DataFrame, model: Discriminant, threshold: float = THRESHOLD) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))
            s = model.scores(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    out = rows.select("doc_id", "x").mapInArrow(run, "doc_id long, score double, predicted int")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def classify(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Score every text. The statistics are stored, because learning and scoring read them."""
    rows = materialize(features(docs, id_col, text_col), "quality-features")
    return score(rows, fit(rows, labels, label_col, id_col), threshold)
