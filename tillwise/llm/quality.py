"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Each class has a mean and a covariance, shrunk towards the pooled covariance and towards a multiple of the identity; the
score is the logistic of the Mahalanobis log-density difference, computed with cached Cholesky factors.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tillwise.llm.common import map_rows, stored

FEATURES = ("log_words", "word_len", "distinct_words", "repeat_next", "top_word", "upper", "digit", "symbol", "stop", "odd_ends", "lines",
            "distinct_lines", "distinct_pairs", "long_words", "bars")
POOLED = 0.15     # weight of the pooled covariance in each class covariance
DIAGONAL = 0.02   # weight of the mean variance times the identity
EPS = 1e-3        # shares enter as log(share + EPS)

# Classes of code points: 0 other letter, 1 upper-case letter, 2 digit, 3 white space, 4 stop or comma, 5 symbol.
_KIND = np.zeros(0x2100, np.uint8)
for _c in range(0x2100):
    _ch = chr(_c)
    _KIND[_c] = (1 if _ch.isupper() else 2 if _ch.isdigit() else 3 if _ch.isspace() else 4 if _ch in ".,;:'?()-" else 0 if _ch.isalpha() else 5)


def features(text: str | None) -> list[float]:
    """Statistics of one whole text, transformed. Null and empty texts have those of a text of no words."""
    text = text or ""
    w = text.split()
    n = len(w)
    lines = [x for x in text.split("\n") if x.strip()]
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = np.bincount(_KIND[np.minimum(points, 0x20FF)], minlength=6)
    chars = max(1, len(text) - int(kinds[3]))
    counts = Counter(w)
    repeats = sum(a == b for a, b in zip(w, w[1:]))
    pairs = len(set(zip(w, w[1:])))
    lengths = np.fromiter(map(len, w), np.int64, n)
    ends = sum(not (x[-1].isalnum() or x[-1] in ".,") for x in w)
    top = max(counts.values(), default=0)
    n1, log = max(1, n), np.log
    return [float(x) for x in (
        log(n + 1), log(len(text) / n1 + 1), log(len(counts) / n1 + EPS), log(repeats / n1 + EPS), log(top / n1 + EPS),
        log(kinds[1] / chars + EPS), log(kinds[2] / chars + EPS), log(kinds[5] / chars + EPS), log(kinds[4] / chars + EPS), log(ends / n1 + EPS),
        log(len(lines) / n1 + EPS), log(len(set(lines)) / max(1, len(lines)) + EPS), log(pairs / max(1, n - 1) + EPS),
        log(float((lengths > 14).sum()) / n1 + EPS), log(text.count("|") / n1 + EPS))]


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and its array of transformed statistics, for every row."""
    return map_rows(docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")),
                    lambda c: {"doc_id": c[0], "x": [features(t) for t in c[1]]}, "doc_id long, x array<double>")


@dataclass(frozen=True)
class Discriminant:
    """Means, Cholesky factors of the inverse problem and log priors of class 0 and 1; ``factors`` is None where the labelled
    rows are of fewer than two classes, and ``prior`` decides."""
    centre: np.ndarray
    scale: np.ndarray
    means: np.ndarray | None
    factors: tuple[np.ndarray, np.ndarray] | None
    logs: tuple[float, float]
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for rows of statistics."""
        if self.factors is None:
            return np.full(len(x), self.prior)
        z = (x - self.centre) / self.scale
        density = []
        for k in (0, 1):
            half = np.linalg.solve(self.factors[k], (z - self.means[k]).T)
            density.append(self.logs[k] - 0.5 * (half ** 2).sum(axis=0))
        return 1.0 / (1.0 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def fit(labelled: DataFrame, pooled: float = POOLED, diagonal: float = DIAGONAL) -> Discriminant:
    """``labelled``: x, label (0 or 1). Uses every row: counts, sums and sums of products per class are all that reaches
    the driver (2 x (p + 2) x p numbers for p statistics)."""
    p = len(FEATURES)
    at = [F.col("x")[i] for i in range(p)]
    cells: list[Column] = [F.count("*"), *[F.sum(a) for a in at]] + [F.sum(at[i] * at[j]) for i in range(p) for j in range(i, p)]
    got = {r["label"]: r["c"] for r in labelled.groupBy("label").agg(F.array(*[c.cast("double") for c in cells]).alias("c")).collect()}
    counts = {k: v[0] for k, v in got.items()}
    n = sum(counts.values())
    prior = counts.get(1, 0.0) / n if n else 0.5
    if len(counts) < 2 or min(counts.values()) < 2:
        return Discriminant(np.zeros(p), np.ones(p), None, None, (0.0, 0.0), prior)
    sums = {k: np.asarray(v[1:p + 1]) for k, v in got.items()}
    products = {}
    for k, v in got.items():
        m = np.zeros((p, p))
        m[np.triu_indices(p)] = v[p + 1:]
        products[k] = m + np.triu(m, 1).T
    centre = (sums[0] + sums[1]) / n
    scale = np.sqrt(np.maximum(np.diag(products[0] + products[1]) / n - centre ** 2, 1e-12))
    scale[scale < 1e-5] = 1.0
    means, covariances = {}, {}
    for k in (0, 1):
        m = sums[k] / counts[k]
        covariances[k] = (products[k] / counts[k] - np.outer(m, m)) / np.outer(scale, scale)
        means[k] = (m - centre) / scale
    both = (counts[0] * covariances[0] + counts[1] * covariances[1]) / n
    factors, logs = [], []
    for k in (0, 1):
        c = (1 - pooled) * covariances[k] + pooled * both
        c = (1 - diagonal) * c + diagonal * max(np.trace(c) / p, 1e-6) * np.eye(p)
        factors.append(np.linalg.cholesky(c))
        logs.append(float(np.log(counts[k] / n) - np.log(np.diag(factors[k])).sum()))
    return Discriminant(centre, scale, np.stack([means[0], means[1]]), (factors[0], factors[1]), (logs[0], logs[1]), prior)


def held_out(doc_id: Column) -> Column:
    """Rows kept out of fitting: CRC-32 of the id as text, modulo 4, is 2. A null id is held out too."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row.

    Labels: one per id (of repeated ones the least), null labels and held-out ids left out. Only statistics of the text enter
    a score. Empty and null texts are scored as texts of no words; with labels of one class its share is every score.
    """
    x = stored(statistics(docs, id_col, text_col), "quality-statistics")
    known = labels.select(F.col("doc_id").alias("__l"), F.col("quality").cast("int").alias("label")).where("label in (0, 1)").groupBy("__l").agg(
        F.min("label").alias("label")).where(~held_out(F.col("__l")))
    model = fit(x.join(known, F.col("doc_id") == F.col("__l")).select("x", "label"))
    scored = map_rows(x, lambda c: {"doc_id": c[0], "score": model.score(np.asarray(c[1], float)).tolist() if c[0] else []}, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
