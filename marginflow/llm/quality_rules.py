"""Quality scores by a sparse rule ensemble.

Statistics of a text are counted over its bytes, many texts at once. A random
forest of shallow trees is grown on them; each path from a root is a conjunctive rule (an
``and`` of comparisons of statistics with constants). A lasso logistic
regression over the rules' truth values keeps few of them with a weight, and
these are compiled into one Spark column: the logistic of a sum of weighted
``when`` expressions. Scoring is a projection over the statistics, without a shuffle.

The fit uses at most ``FIT_ROWS`` labelled rows of each label (the first by a hash
of doc_id), weighted back to the labels' shares.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from ._sample import labelled_sample
from ._text import blocks, utf8, words

FIT_ROWS = {0: 10_000, 1: 10_000}
TREES, DEPTH = 12, 3
LASSO = 0.001
STEPS = 40          # of the lasso fit
SEED = 7


#: The statistics of a text that rules compare.
STATISTICS = ("chars", "words", "mean_word", "caps_share", "digit_share", "mark_share", "shout_share", "stop_share",
              "line_words", "closed_share", "repeat_share", "letter_runs")


def _flags(values: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(values.encode())] = True
    return out


_DIGIT, _MARK, _STOP, _CLOSE = _flags("0123456789"), _flags("#$%&*@^~_=+<>{}[]\\|"), _flags(".,;:?"), _flags(".!?")
_LOWER = _flags("abcdefghijklmnopqrstuvwxyz")
_LOWER[128:] = True  # bytes of other letters


def text_statistics(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """``STATISTICS`` of each row of UTF-8 text (see ``_text.utf8``); all 0 for an empty row."""
    base, to = int(offsets[0]), int(offsets[-1])
    x, bounds = data[base:to], offsets - base
    first = np.zeros(len(x) + 1, bool)
    first[bounds] = True
    first, last = first[:-1], first[1:]

    def per_row(flag: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(flag) + 1, np.int64)
        np.cumsum(flag, out=sums[1:])
        return (sums[bounds[1:]] - sums[bounds[:-1]]).astype(float)

    before = np.concatenate([x[:1], x[:-1]])  # a row's first byte has none: masked by ``first``
    after = np.concatenate([x[1:], x[-1:]])
    again = (x == before) & ~first & (x > 32)
    lower = _LOWER[x]
    caps = (x >= 65) & (x <= 90) | (before == 0xC3) & (x >= 0x80) & (x <= 0x9E) & ~first
    chars, words_, lines = per_row((x & 0xC0) != 0x80), np.zeros(len(offsets) - 1), per_row(x == 10)
    starts, _, rows = words(data, offsets)
    words_ += np.bincount(rows, minlength=len(words_))
    lines += chars > 0
    c, w, n = np.maximum(chars, 1), np.maximum(words_, 1), np.maximum(lines, 1)
    return dict(zip(STATISTICS, (
        chars, words_, chars / w, per_row(caps) / c, per_row(_DIGIT[x]) / c, per_row(_MARK[x]) / c,
        per_row((x == 33) & (before == 33) & ~first) / w, per_row(_STOP[x]) / w, words_ / n,
        per_row(_CLOSE[x] & (last | (after == 10))) / n, per_row(again) / c,
        per_row(lower & (first | ~_LOWER[before])) / w)))


def _measurer(keep: list[str]):
    names = [f"q_{n}" for n in STATISTICS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for lo, hi in blocks(offsets):
                found = text_statistics(data, offsets[lo:hi + 1])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(lo, hi - lo) for c in keep), *(pa.array(found[n]) for n in STATISTICS)],
                    [*keep, *names])
    return run


def with_statistics(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all) and a double column q_<name> per statistic (replacing equal names)."""
    new = [f"q_{n}" for n in STATISTICS]
    kept = [f for f in docs.schema.fields if f.name not in new and (keep is None or f.name in keep)]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), *(f"{n} double" for n in new)])
    return (docs.withColumn("text", F.col("text").cast("string"))
            .select(*{f.name: None for f in kept} | {"text": None})
            .mapInArrow(_measurer([f.name for f in kept]), schema))


#: A rule: comparisons (statistic, "<=" or ">", constant) that must all hold.
Rule = tuple[tuple[str, str, float], ...]


@dataclass
class Model:
    """An intercept and weighted rules."""

    intercept: float
    rules: list[tuple[Rule, float]]

    def column(self) -> Column:
        """The probability of label 1, over columns of ``with_statistics``."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(condition(rule), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def describe(self) -> list[str]:
        """The rules in words, the heaviest first."""
        return [f"{w:+.3f} if " + " and ".join(f"{n} {op} {c:.6g}" for n, op, c in r)
                for r, w in sorted(self.rules, key=lambda x: -abs(x[1]))]


def condition(rule: Rule) -> Column:
    """``rule`` as a Boolean column over columns of ``with_statistics``."""
    out = F.lit(True)
    for name, op, bound in rule:
        c = F.col(f"q_{name}")
        out = out & (c <= F.lit(bound) if op == "<=" else c > F.lit(bound))
    return out


def _simplify(path: list[tuple[str, str, float]]) -> Rule:
    """The tightest comparison of each statistic and direction."""
    tight: dict[tuple[str, str], float] = {}
    for name, op, c in path:
        old = tight.get((name, op))
        tight[name, op] = c if old is None else min(old, c) if op == "<=" else max(old, c)
    return tuple(sorted((n, op, c) for (n, op), c in tight.items()))


def _paths(node, names: list[str], path: list) -> list[Rule]:
    out = [_simplify(path)] if path else []
    if node.subtreeDepth() > 0:
        split = node.split()
        name, bound = names[split.featureIndex()], float(split.threshold())
        out += _paths(node.leftChild(), names, path + [(name, "<=", bound)])
        out += _paths(node.rightChild(), names, path + [(name, ">", bound)])
    return out


def _opposite(rule: Rule) -> Rule:
    (name, op, c), = rule
    return ((name, ">" if op == "<=" else "<=", c),)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """Fit on ``docs`` (doc_id, text) with ``labels`` (doc_id, ``label`` 0/1). One class alone: a constant; no rows: 0.5."""
    sample = (labelled_sample(docs, labels, label, FIT_ROWS)
              .select(F.col(label).cast("double").alias("label"), "text", "weight"))
    names = list(STATISTICS)
    rows = materialize(with_statistics(sample, ["label", "weight"]).coalesce(8))
    n, ones = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if n == 0 or ones in (0, n):
        return Model(0.0 if n == 0 else 8.0 if ones else -8.0, [])
    vectors = rows.select("label", "weight", array_to_vector(F.array(*(f"q_{x}" for x in names))).alias("features"))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, maxBins=64,
                                    featureSubsetStrategy="0.5", weightCol="weight").fit(vectors)
    rules: dict[Rule, None] = {}
    for tree in forest.trees:
        for rule in _paths(tree._call_java("rootNode"), names, []):
            if not (len(rule) == 1 and _opposite(rule) in rules):  # says the same as one that is there
                rules[rule] = None
    order = list(rules)
    if not order:
        return Model(0.0, [])
    truth = materialize(rows.select("label", "weight", F.array(*(condition(r).cast("double") for r in order)).alias("truth")))
    lasso = LogisticRegression(regParam=LASSO, elasticNetParam=1.0, standardization=False, maxIter=STEPS, tol=1e-5, weightCol="weight").fit(
        truth.select("label", "weight", array_to_vector("truth").alias("features")))
    weights = [float(w) for w in lasso.coefficients]
    return Model(float(lasso.intercept), [(r, w) for r, w in zip(order, weights) if w])


def score(docs: DataFrame, model: Model, column: str = "score", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all) with the probability of label 1; a column named ``column`` is replaced.

    Null text counts as empty, an empty text has all counts 0. Equal texts have equal scores.
    """
    keep = [c for c in keep or docs.columns if c != column]
    return with_statistics(docs, keep).withColumn(column, model.column()).select(*keep, column)
