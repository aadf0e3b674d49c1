"""Quality classifier by positive-unlabelled learning.

Trusted positives are labelled training rows of quality 1; the unlabelled set is every text of the
corpus. The class prior is estimated from the scores of held-back positives and of the unlabelled
(the best-bin ratio of their upper tails). The model minimises the non-negative unbiased risk

    prior * E_pos[l(f)] + max(0, E_unl[l(-f)] - prior * E_pos[l(-f)])

with the logistic loss over standardised text statistics. Risk, gradient and curvature are sums over
all unlabelled rows, one pass over the feature table each; the driver takes damped Newton steps on the
sums, so the result doesn't depend on how rows are dealt to tasks or batches. Descent starts where the
second term is positive (at zero) and a step that would make it negative is shortened: past that point
only the clamp would be left, and the fit would be to noise. The feature table is written once; a text is
read by Python once.

Labels are read only from training rows, and of them only the positives; language, source and ids are
no inputs. What reaches the driver: sums and histograms of fixed size and at most ``MAX_POSITIVES`` rows
of features.

Edge cases: null and empty texts have the features of an empty text and get its score; repeated rows
get equal scores; null labels are left out; a null id is never held out and never labelled; without positives
every score is 0.5; an empty table gives an empty table; very long texts are measured whole; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.llm.common import summed, table, written

#: Rows of labelled positives that are used, at most; a fifth of them is held back to estimate the prior.
MAX_POSITIVES = 10_000
#: Newton steps before the first estimate of the prior, before the second, and after it, at most.
STEPS = (4, 4, 8)
#: Penalty on squared weights: a fixed part, and one that counts as much as so many positives.
L2, L2_ROWS = 1e-3, 10.0
THRESHOLD = 0.5

_CLASSES = np.zeros(256, np.int64)
for _k, _chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b".,;:'\"?-()", b"|", b"!", b"#%&*$@^~=+<>_/\\{}[]`"), 1):
    _CLASSES[list(_chars)] = _k
_CLASSES[128:] = 10
N_CLASSES = 11
N_FEATURES = N_CLASSES + 13


def statistics(text: str | None) -> np.ndarray:
    """Statistics of a text, each of order one."""
    raw = (text or "").encode()
    words = raw.split()
    n, m = max(len(raw), 1), max(len(words), 1)
    share = np.bincount(_CLASSES, np.bincount(np.frombuffer(raw, np.uint8), minlength=256), minlength=N_CLASSES) / n
    lines = [x for x in raw.split(b"\n") if x]
    repeats = sum(a == b for a, b in zip(words, words[1:], strict=False)) / m
    ends = sum(w[-1:] in b".,;:" for w in words) / m
    packed = len(zlib.compress(raw, 1)) / n if raw else 1.0
    return np.array(
        [
            *np.sqrt(share), np.log1p(len(raw)) / 8, np.log1p(len(words)) / 6, (len(raw) - len(words)) / m / 8, len(set(words)) / m,
            repeats, len(set(lines)) / max(len(lines), 1), np.log1p(n / max(len(lines), 1)) / 8, ends, min(packed, 1.2), float(len(words) < 10),
            float(len(words) < 50), sum(map(bytes.isupper, words)) / m, sum(map(bytes.isalpha, words)) / m,
        ],
        np.float32,
    )


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, x), a row for each row of ``docs``; x: the statistics as little-endian float32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [statistics(t.as_py()).tobytes() for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(x, pa.binary())], names=["id", "x"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, x binary")


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(-1, N_FEATURES)


def _design(x: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    z = np.clip((x - mean) / spread, -5, 5)
    return np.hstack([z, z * z / 5, np.ones((len(z), 1))])


def _sigmoid(v: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(v, -30, 30)))


class Risk:
    """The non-negative risk at weights ``w``, from sums over the unlabelled (of softplus, gradient, curvature, rows) and from the positives."""

    def __init__(self, w: np.ndarray, pos: np.ndarray, sums: np.ndarray, prior: float):
        l2 = L2 + L2_ROWS / len(pos)
        k, n = len(w), max(sums[-1], 1.0)
        fp = pos @ w
        self.negative = sums[0] / n - prior * np.logaddexp(0, fp).mean()
        self.value = prior * np.logaddexp(0, -fp).mean() + max(0.0, self.negative) + l2 / 2 * (w @ w)
        # of the positives' two losses, softplus(-f) - softplus(f), just -f is left
        self.gradient = sums[1 : k + 1] / n - prior * pos.mean(axis=0) + l2 * w
        self.curvature = sums[k + 1 : -1].reshape(k, k) / n + l2 * np.eye(k)


def unlabelled_sums(design: np.ndarray, w: np.ndarray) -> np.ndarray:
    f = design @ w
    s = _sigmoid(f)
    return np.concatenate([[np.logaddexp(0, f).sum()], design.T @ s, ((design * (s * (1 - s))[:, None]).T @ design).ravel(), [len(f)]])


def descend(risk_at, size: int, steps: int, tolerance: float = 1e-5) -> np.ndarray:
    """Damped Newton steps from zero; ``risk_at`` gives the :class:`Risk` at weights and costs one pass."""
    w = np.zeros(size)
    here = risk_at(w)
    for _ in range(steps):
        step = np.linalg.solve(here.curvature, here.gradient)
        if here.gradient @ step < tolerance:
            break
        for _ in range(4):
            there = risk_at(w - step)
            if there.negative >= 0 and there.value < here.value:
                break
            step = step / 3
        else:
            break
        w, here = w - step, there
    return w


BINS = 200


def estimate_prior(held: np.ndarray, histogram: np.ndarray, delta: float = 0.1) -> float:
    """Share of positives among the unlabelled: the ratio of the upper tails of unlabelled and held-back positive scores, at the threshold
    where that ratio's upper confidence bound (of probability 1 - ``delta``) is least, less two standard errors: the ratio is an upper bound, and
    a prior that is too high makes the second term of the risk negative before the fit is done.

    ``histogram`` counts the unlabelled by score in equal bins from 0 to 1.
    """
    total = histogram.sum()
    if not len(held) or not total:
        return 0.5
    pos = np.histogram(held, BINS, (0, 1))[0][::-1].cumsum()[::-1] / len(held)
    unl = histogram[::-1].cumsum()[::-1] / total
    pos, unl = pos[pos > 0], unl[pos > 0]
    doubt = np.sqrt(np.log(4 / delta) / 2) * (np.sqrt(1 / total) + np.sqrt(1 / len(held)))
    at = np.argmin((unl + doubt) / pos)
    caught = (pos[at] * len(held) + 1) / (len(held) + 2)
    error = np.sqrt((1 - caught) / (caught * len(held)))
    return float(np.clip(unl[at] / pos[at] * (1 - 2 * min(error, 0.25)), 0.02, 0.98))


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    folds: int = 3, held: int = 1, max_positives: int = MAX_POSITIVES,
) -> tuple[tuple, DataFrame]:
    """((weights, mean, spread, prior), feature table of all rows)."""
    spark = docs.sparkSession
    table_ = written(features(docs, id_col, text_col), "quality-features")
    in_training = F.crc32(F.col(id_col).cast("string").cast("binary")) % folds != held
    trusted = (
        labels.filter(F.col(id_col).isNotNull() & (F.col(label_col) == 1) & in_training)
        .select(F.col(id_col).alias("_id"))
        .distinct()
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(max_positives)
    )
    rows = table_.select("x")

    def moments(b: pa.RecordBatch) -> np.ndarray:
        x = _matrix(b.column("x")).astype(np.float64)
        return np.concatenate([x.sum(axis=0), (x * x).sum(axis=0), [len(x)]])

    total = summed(rows, moments, 2 * N_FEATURES + 1)
    n = total[-1]
    own = table_.join(F.broadcast(trusted), table_.id == trusted._id).select(F.xxhash64("_id").alias("_h"), "_id", "x")
    pos = _matrix(own.orderBy("_h", "_id", "x").limit(max_positives).toArrow()["x"])
    k = 2 * N_FEATURES + 1
    weights = np.zeros(k)
    if not n or not len(pos):
        return (weights, np.zeros(N_FEATURES), np.ones(N_FEATURES), 0.5), table_
    mean = total[:N_FEATURES] / n
    spread = np.sqrt(np.maximum(total[N_FEATURES:-1] / n - mean**2, 1e-6))
    design = _design(pos[np.random.default_rng(0).permutation(len(pos))], mean, spread)
    back, own = design[: len(pos) // 5], design[len(pos) // 5 :]
    prior = 0.5
    for round_, steps in enumerate(STEPS):

        def risk_at(w: np.ndarray, prior: float = prior) -> Risk:
            shared = spark.sparkContext.broadcast((w, mean, spread))

            def part(b: pa.RecordBatch) -> np.ndarray:
                w, mean, spread = shared.value
                return unlabelled_sums(_design(_matrix(b.column("x")), mean, spread), w)

            return Risk(w, own, summed(rows, part, 2 + k + k * k), prior)

        weights = descend(risk_at, k, steps)
        if round_ < len(STEPS) - 1 and len(back):
            shared = spark.sparkContext.broadcast((weights, mean, spread))

            def histogram(b: pa.RecordBatch, shared=shared) -> np.ndarray:
                weights, mean, spread = shared.value
                return np.histogram(_sigmoid(_design(_matrix(b.column("x")), mean, spread) @ weights), BINS, (0, 1))[0].astype(np.float64)

            prior = estimate_prior(_sigmoid(back @ weights), summed(rows, histogram, BINS))
    return (weights, mean, spread, prior), table_


def scores(table_: DataFrame, model: tuple) -> DataFrame:
    """(id, score), a row for each row of the feature table."""
    shared = table_.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, mean, spread, _ = shared.value
        for b in batches:
            found = _sigmoid(_design(_matrix(b.column("x")), mean, spread) @ weights).astype(np.float64)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(found, pa.float64())], names=["id", "score"])

    return table_.mapInArrow(run, f"id {table_.schema['id'].dataType.simpleString()}, score double")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, table_ = train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    held = F.coalesce(F.crc32(F.col("id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    return scores(table_, model).select(F.col("id").alias("doc_id"), held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
