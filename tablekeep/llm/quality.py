"""A quality classifier by positive-unlabelled learning.

Only trusted positives (labelled 1), unlabelled documents and the share of positives among all (the class prior) are
used to fit. The non-negative unbiased risk with logistic loss is minimised: prior x positive loss of positives, plus
max(0, negative loss of unlabelled less prior x negative loss of positives). Each Newton step is one pass over the
feature table; a task returns one small matrix, so what comes to the driver depends on the number of features alone.

Features are shares and counts of characters, words and lines of the whole text (never language, source, id or label),
each with a few hinges, so a linear score can bend.

Defined cases: a null or empty text has all-zero features and a score like any; ``doc_id`` null or repeated: rows are
scored one by one, and a document without a label, or with labels 0 and 1 both, is unlabelled; without positives, or
without unlabelled rows, the prior alone is the score; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekeep.llm.common import doc_texts, settled
from tablekeep.session import Workspace, col

FOLDS = 5
THRESHOLD = 0.3
EVALUATIONS = 24
# Regularisation and the tolerated negative part, for n positives: what sampling noise of n rows calls for.
RIDGE_TIMES_N = 30.0
SLACK_TIMES_ROOT_N = 1.0

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGITS = bytes(range(48, 58))

# Each base feature with the points from which a hinge begins.
HINGES: dict[str, tuple[float, ...]] = {
    "log_bytes": (4.0, 6.0, 8.0),
    "upper": (0.05, 0.2, 0.5),
    "digits": (0.02, 0.1),
    "outside_ascii": (0.02, 0.1),
    "bangs": (0.02, 0.1, 0.3),
    "symbols": (0.02, 0.1, 0.3, 0.6),
    "bars": (0.02, 0.1, 0.3),
    "stops": (0.02, 0.05, 0.1),
    "commas": (0.05, 0.15),
    "other_marks": (0.02, 0.1),
    "distinct": (0.3, 0.5, 0.7, 0.9),
    "same_as_last": (0.02, 0.1, 0.3),
    "top_word": (0.05, 0.1, 0.2, 0.4),
    "word_bytes": (3.0, 5.0, 8.0),
    "lines": (0.02, 0.05, 0.2),
    "dup_lines": (0.05, 0.2),
    "capital_words": (0.1, 0.3, 0.6),
}
WIDTH = 1 + sum(1 + len(h) for h in HINGES.values())


def base_features(text: str) -> list[float]:
    data = text.encode()
    words = data.split()
    if not words:
        return [0.0] * len(HINGES)
    n, size = len(words), len(data)
    of = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    upper, lower, digits = (int(of[list(s)].sum()) for s in (_UPPER, _LOWER, _DIGITS))
    outside = int(of[128:].sum())
    letters = max(1, upper + lower)
    count = lambda marks: int(of[list(marks)].sum()) / n
    kinds: dict[bytes, int] = {}
    for w in words:
        kinds[w] = kinds.get(w, 0) + 1
    lines = [line for line in data.split(b"\n") if line.strip()]
    return [
        float(np.log1p(size)),
        upper / letters,
        digits / size,
        outside / size,
        count(b"!"),
        count(b"#*$%&<>"),
        count(b"|"),
        count(b"."),
        count(b",;:"),
        count(b"()[]{}\"'/\\@_=+-?"),
        len(kinds) / n**0.9 if n > 1 else 1.0,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        max(kinds.values()) / n if n >= 20 else 0.0,
        sum(map(len, words)) / n,
        len(lines) / n,
        1 - len(set(lines)) / len(lines),
        sum(k for w, k in kinds.items() if len(w) > 2 and w.isupper()) / n,
    ]


def bent(base: np.ndarray) -> np.ndarray:
    """The constant, the base features and their hinges, a row per text."""
    columns = [np.ones(len(base))]
    for i, hinges in enumerate(HINGES.values()):
        columns.append(base[:, i])
        columns += [np.maximum(0.0, base[:, i] - h) for h in hinges]
    return np.column_stack(columns)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    mean: np.ndarray
    spread: np.ndarray
    prior: float

    def scores(self, features: np.ndarray) -> np.ndarray:
        z = ((features - self.mean) / self.spread) @ self.weights
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def _sums(xs: np.ndarray, positive: np.ndarray, w: np.ndarray, prior_weight: float, unlabelled_weight: float) -> np.ndarray:
    """Gradient, Hessian, and the two parts of the risk, of the given rows, as one flat array."""
    z = np.clip(xs @ w, -30, 30)
    p = 1.0 / (1.0 + np.exp(-z))
    up, u = xs[positive], xs[~positive]
    gradient = -prior_weight * up.sum(0) + unlabelled_weight * (u * p[~positive, None]).sum(0)
    hessian = unlabelled_weight * (u * (p * (1 - p))[~positive, None]).T @ u
    positive_loss = prior_weight * np.logaddexp(0, -z[positive]).sum()
    negative_part = unlabelled_weight * np.logaddexp(0, z[~positive]).sum() - prior_weight * np.logaddexp(0, z[positive]).sum()
    return np.concatenate([gradient, hessian.ravel(), [positive_loss, negative_part]])


def newton(total, width: int, ridge: float, slack: float, evaluations: int = EVALUATIONS) -> np.ndarray:
    """Minimise the non-negative risk; ``total(w)`` gives the sums of ``_sums`` over all rows.

    The unbiased risk is convex, so Newton steps serve. A step that raises the risk, or takes its negative part more than
    ``slack`` under zero (which only overfitting does), is halved.
    """

    def risk(sums, w):
        return sums[-2] + max(-slack, sums[-1]) + 0.5 * ridge * float(w[1:] @ w[1:])

    penalty = np.full(width, ridge)
    penalty[0] = 1e-9
    w = np.zeros(width)
    sums = total(w)
    while evaluations > 0:
        gradient = sums[:width] + penalty * w
        hessian = sums[width : width + width * width].reshape(width, width) + np.diag(penalty + 1e-9)
        move, size, better = np.linalg.solve(hessian, gradient), 1.0, False
        while evaluations > 0 and size > 0.02 and not better:
            evaluations -= 1
            candidate = w - size * move
            now = total(candidate)
            better = now[-1] >= -slack and risk(now, candidate) < risk(sums, w)
            size /= 2
        if not better:
            break
        gained = risk(sums, w) - risk(now, candidate)
        w, sums = candidate, now
        if gained < 1e-5:
            break
    return w


# ---- on Spark


def held_out() -> F.Column:
    """Whether a row's label may not be learned: CRC-32 of its id as text is divisible by five (null id: empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(FOLDS)) == 0


def features(docs: DataFrame) -> DataFrame:
    """``doc_id, base`` of every row; one scan."""

    def of(batches):
        for batch in batches:
            rows = pa.array([base_features(t.as_py()) for t in batch.column("text")], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), rows], ["doc_id", "base"])

    return doc_texts(docs).mapInArrow(of, "doc_id long, base array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return bent(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(HINGES)))


def _summed(rows: DataFrame, of, size: int) -> np.ndarray:
    """The sum over all rows of ``of(features, positive)``, an array of ``size``; only the sum comes to the driver."""

    def parts(batches):
        total = np.zeros(size)
        for batch in batches:
            if len(batch):
                total += of(_matrix(batch.column("base")), batch.column("positive").to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], ["i", "x"])

    found = rows.mapInArrow(parts, "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).collect()
    out = np.zeros(size)
    for r in found:
        out[r["i"]] = r["x"]
    return out


def fit(rows: DataFrame, prior: float) -> Model:
    """Fit on ``base`` and ``positive`` (else unlabelled) of all given rows."""

    def moments(x, positive):
        return np.concatenate([[positive.sum(), len(x)], x.sum(0), (x * x).sum(0)])

    found = _summed(rows, moments, 2 + 2 * WIDTH)
    n_positive, n = found[:2]
    mean = found[2 : 2 + WIDTH] / max(n, 1)
    spread = np.sqrt(np.maximum(found[2 + WIDTH :] / max(n, 1) - mean**2, 0))
    spread[spread < 1e-9] = 1.0
    mean[0], spread[0] = 0.0, 1.0
    if n_positive == 0 or n_positive == n:
        weights = np.zeros(WIDTH)
        weights[0] = np.log(prior / (1 - prior))
        return Model(weights, mean, spread, prior)

    def total(w):
        each = prior / n_positive, 1.0 / (n - n_positive)
        return _summed(rows, lambda x, positive: _sums((x - mean) / spread, positive, w, *each), WIDTH + WIDTH * WIDTH + 2)

    ridge, slack = RIDGE_TIMES_N / n_positive, SLACK_TIMES_ROOT_N / np.sqrt(n_positive)
    return Model(newton(total, WIDTH, ridge, slack), mean, spread, prior)


def trained(found: DataFrame, labels: DataFrame, ws: Workspace) -> Model:
    """Fit on the features of all documents (``doc_id, base``). The class prior is the share of ones among the labels that
    may be learned, kept off 0 and 1; labels of 0 serve for nothing else."""
    known = (
        labels.select(col("doc_id"), col("quality"))
        .where("doc_id is not null and quality is not null")
        .where(~held_out())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("least"), F.max("quality").alias("most"))
        .where("least = most")
    )
    joined = found.join(known, "doc_id", "left")
    rows = settled(joined.select("base", (F.coalesce("least", F.lit(0)) == 1).alias("positive"), "least"), ws, "training")
    n = rows.agg(F.count("least").alias("all"), F.sum("least").alias("ones")).first()
    prior = ((n["ones"] or 0) + 1) / (n["all"] + 2)
    usable = rows.where("least is null or least = 1").select("base", "positive")
    return fit(usable, prior)


def score_column(model: Model):
    """A function of a text column that gives its score."""

    @F.pandas_udf("double")
    def score(texts):
        texts = texts.fillna("")
        out = texts.map(lambda t: 0.0).astype(float)
        if len(texts):
            out[:] = model.scores(bent(np.array([base_features(t) for t in texts])))
        return out

    return score


def scored(docs: DataFrame, labels: DataFrame, ws: Workspace) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    found = settled(features(docs), ws, "features")
    model = trained(found, labels, ws)

    def of(batches):
        for batch in batches:
            scores = model.scores(_matrix(batch.column("base"))) if len(batch) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    return found.mapInArrow(of, "doc_id long, score double").select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame, ws: Workspace) -> DataFrame:
    """The documents, all columns, whose score reaches the threshold."""
    model = trained(settled(features(docs), ws, "features"), labels, ws)
    return docs.where(score_column(model)(col("text")) >= THRESHOLD)
