"""Quality classifier: Bradley-Terry pairwise ranking.

Each document has a feature vector x; the chance that document a is preferred
to document b is sigmoid(beta . (x_a - x_b)). beta is fitted by Newton's method on
preference pairs (a: label 1, b: label 0) of a bounded labelled sample. The
cut lies at a quantile of the sample's scores.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from neoflow.llm.labelled import held_out, training_rows

#: Preference pairs the ranking is fitted on.
PAIRS = 40_000
#: Score of a document that lies exactly at the cut.
CUT = 0.3

N_FEATURES = 11


def _share(x: float) -> float:
    """Spreads small shares out: 0.1 % and 1 % differ as much as 1 % and 10 %."""
    return math.log1p(1000.0 * x)


def features(text: str | None) -> list[float]:
    """Surface features of a whole text; an empty or null text has all zeros
    but for its length and unique shares."""
    text = text or ""
    raw = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=128)
    n = max(1, int(raw.sum()))
    words = text.split()
    m = max(1, len(words))
    lines = [x for x in text.split("\n") if x]
    upper, lower = raw[65:91].sum(), raw[97:123].sum()
    digits = raw[48:58].sum()
    stops = raw[[33, 39, 40, 41, 44, 45, 46, 58, 59, 63]].sum()
    marks = raw[33:48].sum() + raw[58:65].sum() + raw[91:97].sum() + raw[123:127].sum() - stops
    adjacent = sum(map(eq, words, islice(words, 1, None)))
    return [
        math.log1p(len(words)),
        len(set(words)) / m if words else 1.0,
        _share(adjacent / m),
        _share(marks / n),
        _share(raw[33] / n),
        _share(raw[124] / n),
        _share(digits / n),
        float(upper) / max(1, int(upper + lower)),
        _share(upper / n),
        min(30.0, len(text) / m) / 10.0,
        1.0 - len(set(lines)) / max(1, len(lines)) if lines else 0.0,
    ]


@dataclass
class Ranking:
    mean: np.ndarray
    scale: np.ndarray
    beta: np.ndarray
    cut: float
    constant: float | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1, CUT at the cut."""
        if self.constant is not None:
            return np.full(len(x), self.constant)
        s = ((x - self.mean) / self.scale) @ self.beta - self.cut
        return 1.0 / (1.0 + np.exp(-np.clip(s + math.log(CUT / (1 - CUT)), -40, 40)))


def fit_pairs(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, l2: float = 1.0) -> Ranking:
    """Fits on feature rows and 0/1 labels. With one class only, every score is that
    class; without rows, 0.5."""
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return Ranking(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES), 0.0,
                       constant=0.5 if not len(y) else float(y[0]))
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z = (x - mean) / scale
    rng = np.random.default_rng(7)
    k = max(len(good), len(bad), pairs)
    d = z[rng.permutation(np.resize(good, k))] - z[rng.permutation(np.resize(bad, k))]
    beta = np.zeros(d.shape[1])
    for _ in range(30):
        p = 1.0 / (1.0 + np.exp(-np.clip(d @ beta, -40, 40)))
        grad = d.T @ (1 - p) - l2 * beta
        hess = (d * (p * (1 - p))[:, None]).T @ d + l2 * np.eye(len(beta))
        step = np.linalg.solve(hess, grad)
        beta += step * min(1.0, 3.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    s = z @ beta
    # The quantile with the fewest (class-balanced) errors; of equally good ones, the middle.
    cuts = np.quantile(s, np.linspace(0, 1, 1001))
    wrong = np.array([(s[good] < c).mean() + (s[bad] >= c).mean() for c in cuts])
    best = cuts[wrong <= wrong.min() + 1e-12]
    return Ranking(mean, scale, beta, float((best[0] + best[-1]) / 2))


def _features_of(batches):
    for batch in batches:
        rows = [features(t.as_py()) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("label"), pa.array(rows, pa.list_(pa.float64()))], names=["label", "x"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Ranking:
    """Ranking learned from labelled rows outside fold 0 (TRAIN_PER_CLASS rows a class)."""
    got = (training_rows(docs, labels, label).select("label", "text")
           .mapInArrow(_features_of, "label int, x array<double>").collect())
    x = np.array([r["x"] for r in got], dtype=float).reshape(-1, N_FEATURES)
    y = np.array([r["label"] for r in got], dtype=int)
    order = np.lexsort((*x.T, y))  # the rows' order depends on the cluster
    return fit_pairs(x[order], y[order])


def _scorer(model: Ranking, keep: list[str]):
    def run(batches):
        for batch in batches:
            rows = np.array([features(t.as_py()) for t in batch.column("text")]).reshape(-1, N_FEATURES)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(model.score(rows), pa.float64())],
                names=[*keep, "quality_score"])
    return run


def score(docs: DataFrame, model: Ranking, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of every row and its ``quality_score``. Null and empty
    texts are scored by their (empty) features."""
    cols = list(dict.fromkeys([*keep, "text"]))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return docs.select(*cols).mapInArrow(_scorer(model, keep), f"{fields}, quality_score double")


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``."""
    return (score(docs, fit(docs, labels), ["doc_id"])
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                    F.col("quality_score").alias("score"),
                    (F.col("quality_score") >= CUT).cast("int").alias("predicted")))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier doesn't reject, all columns, whatever their names. Only the
    text goes to Python; null and empty texts are scored by their (empty) features."""
    model = fit(docs, labels)

    @F.pandas_udf("boolean")
    def good(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for some in texts:
            rows = np.array([features(t if isinstance(t, str) else None) for t in some]).reshape(-1, N_FEATURES)
            yield pd.Series(model.score(rows) >= CUT)

    return docs.filter(good("text"))
