"""Quality scores learned from preference pairs (Bradley-Terry), thresholded by score quantile.

A document's strength is a weighted sum of features of its whole text. For a pair (preferred, other) the model says
P(preferred wins) = sigmoid(strength difference); weights minimise the logistic loss on feature differences with an L2
penalty (Newton steps). Pairs come from labelled documents: each is paired with `rivals` documents of the other label.
The fit takes at most `most_labelled` labelled documents, those with the smallest hash of their id; this bound is the
only sample, everything else covers all rows. The threshold is the quantile of training strengths that misjudges least
of the training labels; strengths are mapped to scores by a sigmoid that puts this threshold at 0.3.

Results: null or empty text has the features of empty text and a score. Null labels or ids are left out of the fit; an id
labelled twice counts with its smaller label, one with several texts with the smallest of their features. Without both labels every score is 0.5. Rows keep all their columns, whatever their names;
the score's column is named by the caller. Repeated rows give equal scores. A very long text is measured whole. An empty table is scored to no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CUT = 0.3
CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "newline": b"\n",
    "space": b" \t",
    "pipe": b"|",
    "stop": b".",
    "comma": b",;:",
    "loud": b"!?",
    "marks": b"#$%&*@^~=+_",
    "brackets": b"<>{}[]()/\\",
    "control": bytes(range(9)) + bytes(range(14, 32)) + b"\x7f",
    "wide": bytes(range(128, 256)),
}
TABLE = np.zeros((256, len(CLASSES)))
for _k, _name in enumerate(CLASSES):
    TABLE[list(CLASSES[_name]), _k] = 1
NAMES = (*CLASSES, "length", "empty", "word_length", "distinct_words", "common_word", "distinct_lines", "common_line", "line_length", "long_words", "word_repeats", "sentence_length", "capital_words", "odd_ends")


def features(text: str) -> list[float]:
    """Of the whole text, each about 0 to 1."""
    data = text.encode("utf-8", "surrogatepass")
    shares = np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ TABLE / max(1, len(data))
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    n, m = max(1, len(words)), max(1, len(lines))
    counts = Counter(words)
    line_counts = Counter(lines)
    chars = sum(map(len, counts)) / max(1, len(counts))
    joined = len(data) - len(words) + 1
    return [
        *shares.tolist(),
        np.log1p(len(data)) / 12,
        float(not words),
        min(joined / n, 30) / 10,
        len(counts) / n,
        max(counts.values(), default=0) / n,
        len(line_counts) / m,
        max(line_counts.values(), default=0) / m,
        np.log1p(len(data) / m) / 8,
        min(chars, 30) / 10,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        np.log1p(n / (1 + data.count(b"."))) / 5,
        sum(c for w, c in counts.items() if w[0].isupper()) / n,
        sum(c for w, c in counts.items() if not w[-1].isalnum()) / n,
    ]


@dataclass(frozen=True)
class Model:
    weights: tuple[float, ...]
    threshold: float
    scale: float

    def score(self, x: np.ndarray) -> np.ndarray:
        at = np.clip((x @ np.array(self.weights) - self.threshold) * self.scale, -30, 30)
        return 1 / (1 + (1 - CUT) / CUT * np.exp(-at))


def fit_pairs(x: np.ndarray, preferred: np.ndarray, other: np.ndarray, penalty: float = 1.0, steps: int = 25) -> np.ndarray:
    """Weights of the Bradley-Terry model for rows of x; preferred[i] won against other[i]."""
    d = x[preferred] - x[other]
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))
        gradient = d.T @ p - penalty * w
        step = np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d + penalty * np.eye(len(w)), gradient)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(x: np.ndarray, y: np.ndarray, rivals: int = 8, seed: int = 17) -> Model:
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return Model((0.0,) * x.shape[1], float(np.log(CUT / (1 - CUT))), 1.0)
    draw = np.random.default_rng(seed)
    preferred = np.concatenate([np.repeat(good, rivals), draw.choice(good, rivals * len(bad))])
    other = np.concatenate([draw.choice(bad, rivals * len(good)), np.repeat(bad, rivals)])
    middle, spread = x.mean(0), x.std(0)
    spread[spread < 1e-9] = 1
    w = fit_pairs((x - middle) / spread, preferred, other) / spread
    strength = x @ w
    cuts = np.unique(np.quantile(strength, np.linspace(0, 1, 401)))
    cuts = np.concatenate([(cuts[1:] + cuts[:-1]) / 2, cuts[:1]])
    wrong = [(np.count_nonzero((strength >= c) != (y == 1)), abs(c - np.median(cuts))) for c in cuts]
    threshold = float(cuts[min(range(len(cuts)), key=lambda k: wrong[k])])
    return Model(tuple(w.tolist()), threshold, float(4 / max(1e-9, strength.std())))


def train(docs: DataFrame, labels: DataFrame, most_labelled: int = 20_000, key: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """Fit on the most_labelled labelled documents with the smallest hashed ids: this bounds the sample, the broadcast and what the driver gets."""
    known = labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label")).where(F.col("_key").isNotNull() & F.col("_label").isin(0, 1))
    sample = known.groupBy("_key").agg(F.min("_label").alias("_label")).orderBy(F.xxhash64("_key"), "_key").limit(most_labelled)

    @F.pandas_udf("array<double>")
    def measured(x: pd.Series) -> pd.Series:
        return x.map(lambda t: features(t or ""))

    found = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(F.broadcast(sample), "_key")
    single = found.select("_key", "_label", measured("_text").alias("x")).groupBy("_key", "_label").agg(F.min("x").alias("x"))
    rows = single.toPandas().sort_values("_key")
    x = np.array(rows["x"].tolist(), float).reshape(-1, len(NAMES))
    return fit(x, rows["_label"].to_numpy(int))


def scorer(model: Model, text: str = "text") -> Column:
    """The score of a text column, 0 to 1."""

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series(model.score(np.array([features(t or "") for t in part], float).reshape(-1, len(NAMES))))

    return score(F.col(text))


def held_out(key: str = "doc_id", folds: int = 5) -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds == 0, F.lit(False))
