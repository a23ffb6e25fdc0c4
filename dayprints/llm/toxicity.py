"""Severity of toxic language by cumulative-link ordinal regression.

A text's features are its distinct words and their beginnings of 4 to 8 letters; the
``FEATURES`` that tell grades apart best on a bounded labelled sample are kept. The model is
P(grade <= k) = logistic(threshold_k - w . x): one weight per feature, shared by all ordered
thresholds. The expected severity is the sum of P(grade > k).

Where labels say only toxic or not, ``grades`` makes three grades of them: a model with the one
threshold is fitted first, and toxic texts with a predictor of at least the median of toxic ones
are severe.

Null and empty texts have no features: their grade follows from the thresholds alone. Repeated
rows are graded row by row. Without labels of two grades every severity is 0.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayprints.llm.texts import labelled_sample, lean, struct_array
from dayprints.session import cut_lineage

SAMPLE_PER_CLASS = 10_000
FEATURES = 4096
LEAST_TEXTS = 3
STEPS, RATE, RIDGE = 400, 0.1, 1e-4
BEGINNINGS = (4, 5, 6, 7, 8)
_WORD = re.compile(r"[^\W\d_]+")


def features(text: str | None) -> set[str]:
    """Distinct words, and their beginnings marked with a star."""
    found = set(_WORD.findall((text or "").lower()))
    out = set(found)
    for n in BEGINNINGS:
        out.update(w[:n] + "*" for w in found if len(w) >= n)
    return out


def _select(sample: DataFrame, limit: int) -> list[str]:
    """The features with the largest chi-squared statistic of toxic against clean texts.

    Counts are added up per task first; ``sample`` is bounded, and so are the counts.
    """
    def count(batches):
        held: dict[str, list[int]] = {}
        totals = [0, 0]

        def rows():
            names = list(held)
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([held[k][0] for k in names], pa.int64()),
                 pa.array([held[k][1] for k in names], pa.int64())], ["feature", "clean", "toxic"])

        for batch in lean(batches):
            for value, grade in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                side = int(grade > 0)
                totals[side] += 1
                for name in features(value.as_py()):
                    held.setdefault(name, [0, 0])[side] += 1
            if len(held) > 150_000:
                yield rows()
                held.clear()
        held[""] = totals  # no feature is empty
        yield rows()

    counted = sample.select("text", "grade").mapInArrow(
        count, "feature string, clean bigint, toxic bigint")
    counted = cut_lineage(counted.groupBy("feature").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where(F.col("clean") + F.col("toxic") >= LEAST_TEXTS))
    totals = counted.where("feature = ''").first()
    if totals is None or not totals["clean"] or not totals["toxic"]:
        return []
    a, b = F.col("toxic"), F.col("clean")
    c, d = totals["toxic"] - a, totals["clean"] - b
    n = totals["toxic"] + totals["clean"]
    chi = n * (a * d - b * c).cast("double") ** 2 / (
        (a + b).cast("double") * F.greatest(c + d, F.lit(1)) * totals["toxic"] * totals["clean"])
    best = (counted.where("feature <> ''").withColumn("chi", chi).where("chi > 6")
            .orderBy(F.desc("chi"), "feature").limit(limit))
    return [r["feature"] for r in best.select("feature").collect()]


class Matcher:
    """Numbers of the chosen features of a text; words are remembered in a bounded table."""

    def __init__(self, chosen: list[str]):
        self.number = {name: i for i, name in enumerate(chosen)}
        self.memo: dict[str, tuple[int, ...]] = {}

    def _of_word(self, word: str) -> tuple[int, ...]:
        names = [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) >= n)]
        return tuple(self.number[x] for x in names if x in self.number)

    def found(self, text: str | None) -> list[int]:
        memo, out = self.memo, set()
        for word in set(_WORD.findall((text or "").lower())):
            numbers = memo.get(word)
            if numbers is None:
                if len(memo) > 100_000:
                    memo.clear()
                numbers = memo[word] = self._of_word(word)
            if numbers:
                out.update(numbers)
        return sorted(out)


def _matches(text: Column, chosen: list[str]) -> Column:
    shared = SparkSession.active().sparkContext.broadcast({"chosen": chosen})

    @F.arrow_udf("array<int>")
    def match(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kept = shared.value
        if "matcher" not in kept:
            kept["matcher"] = Matcher(kept["chosen"])
        for part in lean(parts):
            yield pa.array([kept["matcher"].found(v.as_py()) for v in part],
                           pa.list_(pa.int32()))

    return match(text)


# ---------------------------------------------------------------- the regression

def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit(rows: list, grade: np.ndarray, weight: np.ndarray, size: int) -> tuple:
    """Weights of ``size`` features and the ordered thresholds, by gradient descent (Adam) on the
    weighted log-likelihood with a ridge penalty."""
    levels = int(grade.max())
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    column = np.fromiter((c for r in rows for c in r), np.int64, len(row))
    weight = weight / weight.sum()
    # thresholds are a first value and positive steps, so they stay ordered
    shares = np.array([weight[grade <= k].sum() for k in range(levels)])
    start = np.log((shares + 1e-3) / (1 - shares + 1e-3))
    params = np.concatenate((np.zeros(size), start[:1],
                             np.log(np.maximum(np.diff(start), 1e-2))))
    first, second = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, STEPS + 1):
        w, theta = params[:size], _thresholds(params[size:])
        eta = np.bincount(row, weights=w[column], minlength=len(rows))
        edges = np.concatenate(([-np.inf], theta, [np.inf]))
        upper, lower = edges[grade + 1] - eta, edges[grade] - eta
        p_upper = np.where(np.isinf(upper), 1.0, _logistic(upper))
        p_lower = np.where(np.isinf(lower), 0.0, _logistic(lower))
        chance = np.maximum(p_upper - p_lower, 1e-9)
        d_upper = weight * p_upper * (1 - p_upper) / chance
        d_lower = weight * p_lower * (1 - p_lower) / chance
        d_eta = d_upper - d_lower  # of the negative log-likelihood
        d_theta = np.zeros(levels)
        np.add.at(d_theta, np.minimum(grade, levels - 1), np.where(grade < levels, -d_upper, 0))
        np.add.at(d_theta, np.maximum(grade - 1, 0), np.where(grade > 0, d_lower, 0))
        d_w = np.bincount(column, weights=d_eta[row], minlength=size) + RIDGE * w
        d_steps = np.cumsum(d_theta[::-1])[::-1]
        d_params = np.concatenate((d_w, d_steps[:1], d_steps[1:] * np.exp(params[size + 1:])))
        first = 0.9 * first + 0.1 * d_params
        second = 0.999 * second + 0.001 * d_params ** 2
        params = params - RATE * (first / (1 - 0.9 ** step)) / (
            np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return params[:size], _thresholds(params[size:])


def _thresholds(free: np.ndarray) -> np.ndarray:
    return free[0] + np.concatenate(([0.0], np.cumsum(np.exp(free[1:]))))


def train(graded: DataFrame, limit: int = FEATURES, split_toxic: bool = False) -> dict:
    """Model from rows (doc_id, text, grade, weight) of a bounded sample.

    With ``split_toxic`` the grades 0 and 1 become 0, 1 and 2 as the module says.
    """
    sample = cut_lineage(graded.select("doc_id", "text", "grade", "weight"))
    chosen = _select(sample, limit)
    if not chosen:
        return {"features": [], "weights": np.zeros(0), "thresholds": np.zeros(0)}
    frame = sample.select("doc_id", "grade", "weight",
                          _matches(F.col("text"), chosen).alias("found")).toPandas()
    frame["order"] = frame["found"].map(lambda x: tuple(x))
    frame = frame.sort_values(["doc_id", "grade", "order"], ignore_index=True)
    rows = [np.asarray(x, np.int64) for x in frame["found"]]
    grade, weight = frame["grade"].to_numpy(np.int64), frame["weight"].to_numpy(np.float64)
    w, theta = fit(rows, grade, weight, len(chosen))
    if split_toxic:
        eta = np.array([w[r].sum() for r in rows])
        severe = (grade > 0) & (eta >= np.median(eta[grade > 0]))
        grade = grade + severe
        w, theta = fit(rows, grade, weight, len(chosen))
    return {"features": chosen, "weights": w, "thresholds": theta}


def from_labels(documents: DataFrame, labels: DataFrame, label: str = "toxic",
                keep: Column | None = None, per_class: int = SAMPLE_PER_CLASS) -> dict:
    """Three grades learnt from 0/1 labels of at most ``per_class`` texts of each kind."""
    sample = labelled_sample(documents, labels, label, per_class, keep)
    return train(sample.withColumn("grade", F.col("label").cast("int")), split_toxic=True)


def severity(text: Column, model: dict) -> Column:
    """struct(grade, severity, p_toxic): the likeliest grade, the expected grade, P(grade > 0)."""
    shared = SparkSession.active().sparkContext.broadcast(dict(model))

    @F.arrow_udf("struct<grade:int,severity:double,p_toxic:double>")
    def grade(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kept = shared.value
        if "matcher" not in kept:
            kept["matcher"] = Matcher(kept["features"])
        matcher, w, theta = kept["matcher"], kept["weights"], kept["thresholds"]
        for part in lean(parts):
            eta = np.array([w[matcher.found(v.as_py())].sum() if len(w) else 0.0 for v in part])
            above = 1 - _logistic(theta[None, :] - eta[:, None])  # P(grade > k)
            padded = np.hstack((np.ones((len(eta), 1)), above, np.zeros((len(eta), 1))))
            chance = padded[:, :-1] - padded[:, 1:]
            yield struct_array({
                "grade": pa.array(chance.argmax(axis=1).astype(np.int32)),
                "severity": pa.array(above.sum(axis=1)),
                "p_toxic": pa.array(padded[:, 1])})

    return grade(text)


def graded(documents: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """The documents with ``grade``, ``severity`` and ``p_toxic``."""
    return (documents.withColumn("_s", severity(F.col(text), model))
            .withColumns({c: F.col(f"_s.{c}") for c in ("grade", "severity", "p_toxic")})
            .drop("_s"))
