"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; the other side is unlabelled text, of which a share
(the class prior) is toxic as well. The risk of a linear model is estimated from those two
samples with the prior taken out of the unlabelled part, and that part is kept from falling
below zero, which a model that only memorises would make it do.

A text enters by the words that it holds and by their beginnings, so that words made from a
known stem count too. Which of them the model knows is counted in Spark over all texts of the
training fold. The weights are those that minimise the risk over all of these texts: numpy on
the driver finds a beginning on samples of rows (of about ``POSITIVES`` and ``UNLABELLED``),
then each of ``WHOLE_STEPS`` steps is a pass over the places of known features in all texts,
whose tasks add up their part of the gradient. Every whole text is scored, in one pass and
without a shuffle.

Defined results: null and empty texts hold no word and score by the bias; labels that are
null or of an unknown text are not learnt; an id with several labels counts once, as toxic if
one of them is; without positives every score is 0; an empty table gives an empty result.
Other columns are never read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notegrove.workspace import materialize

# Texts of the samples that the weights begin with; the steps over all texts, and their rate.
POSITIVES = 6_000
UNLABELLED = 12_000
WHOLE_STEPS, WHOLE_RATE = 12, 0.02
# Features that the model may know, and texts of the training fold that have to hold one.
FEATURES = 6_000
LEAST_TEXTS = 6
# A feature is known if its shares in both sides differ by so many standard errors.
LEAST_GAP = 4.0
STEMS = (4, 5, 6)
FOLDS = 5
THRESHOLD = 0.5
# Fitting: steps of Adam, rate, weight decay, and the slack below zero that is let pass.
STEPS, RATE, DECAY, SLACK = 300, 0.05, 2e-4, 0.0

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def features_of(text: str | None) -> set[str]:
    """Words, and the beginnings of words (marked by a dash) of ``STEMS`` letters."""
    words = words_of(text)
    out = set(words)
    for n in STEMS:
        out.update([f"{w[:n]}-" for w in words if len(w) > n])
    return out


@dataclass
class Linear:
    bias: float
    weights: dict[str, float] = field(default_factory=dict)

    def __post_init__(self):
        self.words = {k for k in self.weights if not k.endswith("-")}
        self.stems = {n: {k[:-1]: v for k, v in self.weights.items() if k.endswith("-") and len(k) == n + 1} for n in STEMS}

    def score(self, text: str | None) -> float:
        words = words_of(text)
        z = self.bias + sum(map(self.weights.__getitem__, sorted(words & self.words)))
        for n, known in self.stems.items():
            z += sum(map(known.__getitem__, sorted({w[:n] for w in words if len(w) > n} & known.keys())))
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def fit_nonnegative(rows: list[np.ndarray], positive: np.ndarray, unlabelled: np.ndarray, prior: float, n_features: int) -> tuple[np.ndarray, float]:
    """Minimise the non-negative risk with the logistic loss.

    ``rows`` has the places of each text's features, ``positive`` and ``unlabelled`` say to
    which sample it belongs (it may be in both). Where the corrected unlabelled risk falls
    below zero its gradient is turned round.
    """
    lengths = np.array([len(r) for r in rows])
    cols = np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64)
    doc = np.repeat(np.arange(len(rows)), lengths)
    p, u = positive / max(positive.sum(), 1), unlabelled / max(unlabelled.sum(), 1)
    theta = np.zeros(n_features + 1)
    theta[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        z = np.bincount(doc, theta[cols], len(rows)) + theta[-1]
        s = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        loss_negative = np.logaddexp(0, z)
        corrected = float(u @ loss_negative - prior * (p @ loss_negative))
        slope = (u - prior * p) * s
        grad = -prior * p * (1 - s) + slope if corrected >= -SLACK else -slope
        g = np.append(np.bincount(cols, grad[doc], n_features), grad.sum())
        g[:-1] += DECAY * theta[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return theta[:-1], float(theta[-1])


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "utf-8")) % FOLDS == 0, F.lit(False))


def _share(seed: int, wanted: int, total: int) -> Column:
    """A sample of about ``wanted`` of ``total`` stored rows, whatever they hold."""
    cut = min(1.0, wanted / max(total, 1))
    return F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(seed)), F.lit(1 << 30)) < int(cut * (1 << 30))


def training(docs: DataFrame, labels: DataFrame, label_col: str) -> tuple[DataFrame, float]:
    """The texts of the training fold (text, positive, unlabelled) and the class prior, which
    is the share of toxic ids among the labelled ones outside the held-out fold."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    known = known.filter("label IN (0, 1)").filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").alias("label"))
    n, toxic = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    # Stored first, so that its size is known: the texts move only if it is too large to send.
    chosen = materialize(known.filter("label = 1").select("doc_id"), "toxic-ids").withColumn("positive", F.lit(True))
    rows = docs.join(chosen, "doc_id", "left").withColumn("positive", F.coalesce("positive", F.lit(False)))
    rows = rows.withColumn("unlabelled", ~held_out(F.col("doc_id"))).filter("positive OR unlabelled")
    return rows.select("text", "positive", "unlabelled"), toxic / max(n, 1)


def counted(rows: DataFrame) -> DataFrame:
    """In how many positive and unlabelled texts each feature is found; each
    task adds up its own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list[int]] = {}

        def packed() -> pa.RecordBatch:
            both = list(found.values())
            return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array([x[0] for x in both], pa.int64()), pa.array([x[1] for x in both], pa.int64())], names=["feature", "p", "u"])

        for batch in batches:
            for text, p, u in zip(*(batch.column(i) for i in range(3)), strict=True):
                for f in features_of(text.as_py()):
                    at = found.setdefault(f, [0, 0])
                    at[0] += p.as_py()
                    at[1] += u.as_py()
                if len(found) > 500_000:
                    yield packed()
                    found.clear()
        yield packed()

    return rows.mapInArrow(run, "feature string, p long, u long").groupBy("feature").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))


def whole_gradient(places: DataFrame, theta: np.ndarray, prior: float, n_p: int, n_u: int) -> np.ndarray:
    """The gradient of the risk over all stored rows (positive, unlabelled, at); every task
    sends sums by feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # By feature: slope of the positive loss, then of the negative loss on either sample;
        # behind the bias the negative losses themselves.
        sums = np.zeros((3, len(theta) + 1))
        for batch in batches:
            at = batch.column("at")
            sizes = at.value_lengths().to_numpy(zero_copy_only=False)
            cols, doc = at.flatten().to_numpy(), np.repeat(np.arange(len(sizes)), sizes)
            z = np.bincount(doc, theta[cols], len(sizes)) + theta[-1]
            s, loss = 1 / (1 + np.exp(-np.clip(z, -40, 40))), np.logaddexp(0, z)
            p, u = (batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("positive", "unlabelled"))
            for row, w in zip(sums, (p * (s - 1), p * s, u * s), strict=True):
                row[: len(theta)] += np.append(np.bincount(cols, w[doc], len(theta) - 1), w.sum())
            sums[1:, -1] += p @ loss, u @ loss
        at = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at), *map(pa.array, sums[:, at])], names=["feature", "a", "b", "c"])

    parts = places.mapInArrow(run, "feature bigint, a double, b double, c double").groupBy("feature").agg(*(F.sum(c).alias(c) for c in "abc"))
    total = np.zeros((3, len(theta) + 1))
    for feature, *sums in parts.collect():  # a row for each known feature at most
        total[:, feature] = sums
    positive, negative = prior / max(n_p, 1) * total[0, :-1], total[2] / max(n_u, 1) - prior / max(n_p, 1) * total[1]
    return positive + negative[:-1] if negative[-1] >= -SLACK else -negative[:-1]


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic") -> Linear:
    """Learn from ``docs`` (doc_id, text) and ``labels`` (doc_id, label)."""
    rows, prior = training(docs, labels, label_col)
    if not 0 < prior < 1:
        return Linear(-40.0 if prior <= 0 else 40.0)
    n_p, n_u = rows.agg(*map(F.count_if, ("positive", "unlabelled"))).first()
    if not n_p or not n_u:
        return Linear(-40.0)
    # Features by the strength of the difference between both sides.
    both = (F.col("p") + F.col("u")) / (n_p + n_u)
    gap = F.abs(F.col("p") / n_p - F.col("u") / n_u) / F.sqrt(both * (1 - both) * (1 / n_p + 1 / n_u) + 1e-12)
    known = counted(rows).filter((F.col("p") + F.col("u") >= LEAST_TEXTS) & (gap >= LEAST_GAP)).orderBy(gap.desc(), "feature").limit(FEATURES)
    names = sorted(r[0] for r in known.select("feature").collect())  # at most FEATURES
    place = {f: i for i, f in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [sorted(place[f] for f in features_of(t.as_py()) & place.keys()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(at, pa.list_(pa.int32()))], names=["positive", "unlabelled", "at"])

    places = materialize(rows.mapInArrow(run, "positive boolean, unlabelled boolean, at array<int>"), "toxicity-places")
    drawn = places.select("at", (F.col("positive") & _share(1, POSITIVES, n_p)).alias("positive"), (F.col("unlabelled") & _share(2, UNLABELLED, n_u)).alias("unlabelled"))
    got = drawn.filter("positive OR unlabelled").toArrow()
    order = sorted(range(got.num_rows), key=lambda i: (got["positive"][i].as_py(), got["unlabelled"][i].as_py(), got["at"][i].as_py()))
    at = [np.array(got["at"][i].as_py(), np.int64) for i in order]
    flags = [got[c].to_numpy()[order].astype(float) for c in ("positive", "unlabelled")]
    theta = np.append(*fit_nonnegative(at, *flags, prior, len(names)))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, WHOLE_STEPS + 1):
        g = whole_gradient(places, theta, prior, n_p, n_u)
        g[:-1] += DECAY * theta[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta -= WHOLE_RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Linear(float(theta[-1]), {f: float(w) for f, w in zip(names, theta[:-1], strict=True) if abs(w) > 1e-3})


def score_column(docs: DataFrame, model: Linear):
    """A column function: the score of a text. The model holds ``FEATURES`` weights at most."""
    sent = docs.sparkSession.sparkContext.broadcast((model.bias, model.weights))
    own: list[Linear] = []

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        if not own:
            own.append(Linear(*sent.value))
        return pa.array([own[0].score(t.as_py()) for t in texts], pa.float64())

    return score


def classify(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score every text: doc_id, held_out, score, predicted."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = docs.select("doc_id", score_column(docs, fit(docs, labels, label_col))("text").alias("score"))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def reject(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that are not predicted toxic, with all their columns."""
    plain = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    score = score_column(docs, fit(plain, labels, label_col))
    return docs.filter(score(F.col(f"`{text_col}`")) < THRESHOLD)
