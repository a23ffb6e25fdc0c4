"""Quality by a sparse rule ensemble.

Statistics of each text are inputs. Shallow trees are grown on a bounded labelled sample; every
path from a root to a node is a rule, a conjunction of thresholds. A logistic regression with a
lasso penalty picks and weighs rules. The picked rules become one Spark column expression over
the statistics, so scoring needs no model object.

Null text counts as empty; its statistics are 0 and its score follows from the rules. Repeated
rows are scored row by row. Without labels of both kinds the score is the share of the kind seen,
or 0.5. Very long texts are read whole, in pieces of a megabyte for characters.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayprints.llm.texts import code_points, labelled_sample, struct_array

STATISTICS = ["log_words", "word_length", "distinct", "repeated", "top_word", "upper", "symbols",
              "digits", "short_words", "bare_words", "same_lines", "line_words"]
SAMPLE_PER_CLASS = 10_000
TREES, DEPTH, PENALTY, SEED = 24, 3, 0.002, 7
CUT = 0.3


# ---------------------------------------------------------------- statistics

def _classes() -> np.ndarray:
    """0 space, 1 capital, 2 other letter, 3 digit, 4 anything else, for every code point."""
    def kind(c: str) -> int:
        return (0 if c.isspace() else 1 if c.isupper() else 2 if c.isalpha()
                else 3 if c.isdigit() else 4)
    return np.fromiter((kind(chr(c)) for c in range(0x110000)), np.uint8, 0x110000)


def text_statistics(text: str, classes: np.ndarray) -> tuple[float, ...]:
    found = np.zeros(5, np.int64)
    for start in range(0, len(text), 1 << 20):
        codes = code_points(text[start:start + (1 << 20)])
        found += np.bincount(classes[codes], minlength=5)
    _, upper, lower, digits, symbols = found.tolist()
    shown = max(1, upper + lower + digits + symbols)
    words = text.split()
    n = max(1, len(words))
    counts = Counter(words)
    lines = text.split("\n")
    return (math.log1p(len(words)), (upper + lower + digits + symbols) / n, len(counts) / n,
            sum(map(eq, words, islice(words, 1, None))) / n,
            max(counts.values(), default=0) / n, upper / max(1, upper + lower), symbols / shown,
            digits / shown, sum(k for w, k in counts.items() if len(w) <= 3) / n,
            sum(k for w, k in counts.items() if len(w) <= 2 and not w.isalnum()) / n,
            1 - len(set(lines)) / len(lines), math.log1p(len(words) / len(lines)))


def statistics(text: Column) -> Column:
    """struct of the ``STATISTICS`` of each text."""
    held = SparkSession.active().sparkContext.broadcast({})  # a place for a worker's table

    @F.arrow_udf("struct<" + ",".join(f"{s}:double" for s in STATISTICS) + ">")
    def measure(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kept = held.value
        if "classes" not in kept:
            kept["classes"] = _classes()
        for part in parts:
            rows = np.array([text_statistics(v.as_py() or "", kept["classes"]) for v in part],
                            dtype=np.float64).reshape(-1, len(STATISTICS))
            yield struct_array({s: pa.array(rows[:, i]) for i, s in enumerate(STATISTICS)})

    return measure(text)


# ---------------------------------------------------------------- rules

_NODE = re.compile(r"^( *)(If|Else) \(feature (\d+) (<=|>) ([-0-9.eE]+)\)")


def paths(tree: str) -> list[tuple]:
    """All conjunctions of a printed tree: the conditions from the root to every node."""
    out, stack = [], []
    for line in tree.splitlines():
        match = _NODE.match(line)
        if match:
            depth = len(match[1])
            while stack and stack[-1][0] >= depth:
                stack.pop()
            stack.append((depth, (int(match[3]), match[4], float(match[5]))))
            out.append(_shortened([c for _, c in stack]))
    return out


def _shortened(conditions: list[tuple]) -> tuple:
    """One interval per statistic."""
    bounds: dict[tuple, float] = {}
    for feature, side, value in conditions:
        key = (feature, side)
        closer = min if side == "<=" else max
        bounds[key] = closer(bounds.get(key, value), value)
    return tuple(sorted((f, side, v) for (f, side), v in bounds.items()))


def holds(rule: tuple, stats: str = "stats") -> Column:
    out = F.lit(True)
    for feature, side, value in rule:
        column = F.col(f"{stats}.{STATISTICS[feature]}")
        out = out & ((column <= value) if side == "<=" else (column > value))
    return out


def train(documents: DataFrame, labels: DataFrame, label: str = "quality",
          keep: Column | None = None, per_class: int = SAMPLE_PER_CLASS) -> dict:
    """{"intercept", "rules": [(rule, weight)]}, learnt from ``per_class`` texts of each label."""
    spark = documents.sparkSession
    sample = labelled_sample(documents, labels, label, per_class, keep)
    # a bounded number of short rows; sorted, so that the trees repeat
    frame = (sample.select("doc_id", "label", "weight", statistics(F.col("text")).alias("s"))
             .select("doc_id", F.col("label").cast("double").alias("label"), "weight", "s.*")
             .toPandas().sort_values(["doc_id", *STATISTICS], ignore_index=True))
    kinds = frame["label"].unique()
    if len(kinds) < 2:
        share = float(kinds[0]) if len(kinds) else 0.5
        return {"intercept": math.log((share + 1e-6) / (1 - share + 1e-6)), "rules": []}
    rows = (spark.createDataFrame(frame).coalesce(4)
            .select("label", "weight", F.struct(*STATISTICS).alias("stats"))
            .withColumn("features", array_to_vector(F.array(*[f"stats.{s}" for s in STATISTICS])))
            .persist())
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, featureSubsetStrategy="0.5",
                                    subsamplingRate=0.7, maxBins=64, weightCol="weight",
                                    seed=SEED).fit(rows)
    rules = sorted({p for tree in forest.trees for p in paths(tree.toDebugString)})
    if not rules:  # nothing splits the labels
        rows.unpersist()
        share = float((frame["label"] * frame["weight"]).sum() / frame["weight"].sum())
        return {"intercept": math.log((share + 1e-6) / (1 - share + 1e-6)), "rules": []}
    flags = rows.select("label", "weight", array_to_vector(
        F.array(*[holds(r).cast("double") for r in rules])).alias("features"))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=PENALTY, standardization=False,
                               maxIter=60, weightCol="weight").fit(flags)
    rows.unpersist()
    picked = [(r, float(w)) for r, w in zip(rules, lasso.coefficients, strict=True) if w]
    return {"intercept": float(lasso.intercept), "rules": picked}


def score(stats: str, model: dict) -> Column:
    """The probability of label 1, as a column over the struct named ``stats``."""
    total = F.lit(model["intercept"])
    for rule, weight in model["rules"]:
        total = total + F.when(holds(rule, stats), weight).otherwise(0.0)
    return 1 / (1 + F.exp(-total))


def scored(documents: DataFrame, model: dict, text: str = "text", cut: float = CUT) -> DataFrame:
    """The documents with ``score`` and ``predicted``."""
    rows = documents.withColumn("_stats", statistics(F.col(text)))
    rows = rows.withColumn("score", score("_stats", model)).drop("_stats")
    return rows.withColumn("predicted", (F.col("score") >= cut).cast("int"))
