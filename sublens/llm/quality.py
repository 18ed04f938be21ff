"""Quality classifier: a support vector machine on Naive Bayes features.

A text's features are the presence of n-grams in two spellings: the lower-cased
word, and the forms (case, digits, the marks attached, or "=" for a word that
repeats the one before) of one and of two words.  A form n-gram counts once for
each share of the text that it reaches (any, 0.2 %, 1 %, 5 %, 20 %), so that a few
strange words and a page of them differ at any length.

Each indicator is scaled by its log-count ratio between the classes (add-one
smoothed, each class normalised), and a linear machine with hinge loss is fitted to the scaled
indicators by dual coordinate descent.  The margin becomes a score by a
sigmoid fitted to margins of rows held back from the fit.

Learning takes up to ``SAMPLE`` labelled rows (a bounded, documented sample).
Their texts stay distributed: features are counted and looked up by Spark's
tasks, and one task fits the rows' feature numbers.  Scoring covers every row
and whole texts.

Defined cases: NULL and empty texts have no features and get the score of the
bias.  Without labelled rows of both classes the score is the share of label 1
(0.5 without any row).  A NULL id is scored like any other; repeated rows are repeated.
"""

from __future__ import annotations

import itertools
import pickle
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sublens.llm.common import aside, discard, stored
from sublens.llm.linear import class_sizes, constant, count_features, fold, labelled_sample, platt, sigmoid

SAMPLE = 20_000
MIN_ROWS = 5                  # rows a feature must occur in
MAX_FEATURES = 20_000         # of each spelling, the most frequent
COST = 1.0
EPOCHS = 12
THRESHOLD = 0.7
SHARES = (0.0, 0.002, 0.01, 0.05, 0.2)
LETTERS = re.compile(r"[^\W\d_]+")
KNOWN_FORMS = 1 << 17


class Forms(dict):
    """Word -> form, remembered."""

    def __missing__(self, word: str) -> str:
        m = LETTERS.search(word)
        if m is None:
            case = "0" if any(c.isdigit() for c in word) else ""
        else:
            part = m.group()
            case = "U" if len(part) > 1 and part.isupper() else "A" if part[0].isupper() else "a"
        form = case + "".join(c for c in word if not c.isalnum())[:3]
        if len(self) >= KNOWN_FORMS:
            self.clear()
        self[word] = form
        return form


FORMS = Forms()


def features(text: str) -> set[str]:
    """Forms with the shares they reach, and words."""
    words = text.split()
    shape = list(map(FORMS.__getitem__, words))
    for i in [i for i, (a, b) in enumerate(zip(words, words[1:], strict=False), 1) if a == b]:
        shape[i] = "="
    counts = Counter(shape)
    counts.update(map(" ".join, zip(shape, shape[1:], strict=False)))
    n = max(len(words), 1)
    out = {f"{s} {g}" for g, k in counts.items() for s in itertools.takewhile(lambda s, f=k / n: f >= s, SHARES)}
    out.update("w" + w for w in set(text.lower().split()))
    return out


class Model:
    """Feature -> weight, with the sigmoid; a constant if nothing could be learnt."""

    def __init__(self, weights: dict[str, float], bias: float, slope: float, shift: float):
        self.weights, self.bias, self.slope, self.shift = weights, bias, slope, shift

    def score(self, text: str) -> float:
        w = self.weights
        margin = self.bias + float(np.sum([w[f] for f in sorted(features(text).intersection(w))]))
        return float(sigmoid(self.slope * margin + self.shift))


def log_count_ratios(rows: list[np.ndarray], y: np.ndarray, size: int) -> np.ndarray:
    counts = np.ones((2, size))
    for c in (0, 1):
        hit = [rows[i] for i in np.flatnonzero(y == c)]
        if hit:
            counts[c] += np.bincount(np.concatenate(hit), minlength=size)
    counts /= counts.sum(axis=1, keepdims=True)
    return np.log(counts[1] / counts[0])


def dual_descent(rows: list[np.ndarray], y: np.ndarray, scale: np.ndarray, cost: float = COST,
                 epochs: int = EPOCHS, seed: int = 0) -> tuple[np.ndarray, float]:
    """Hinge loss with an L2 penalty (bias included): each row's dual variable is set to its
    best value in turn, kept in [0, cost], and the weights follow."""
    sign = np.where(y == 1, 1.0, -1.0)
    values = [scale[r] for r in rows]
    norms = np.array([v @ v + 1.0 for v in values])
    w, bias, alpha = np.zeros(len(scale)), 0.0, np.zeros(len(rows))
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(rows)):
            r, v = rows[i], values[i]
            gradient = sign[i] * (w[r] @ v + bias) - 1.0
            new = min(max(alpha[i] - gradient / norms[i], 0.0), cost)
            step = (new - alpha[i]) * sign[i]
            if step:
                w[r] += step * v
                bias += step
                alpha[i] = new
                moved += abs(step)
        if moved < 1e-4:
            break
    return w, bias


def train(rows: list[np.ndarray], y: np.ndarray, size: int) -> tuple[np.ndarray, float, float, float]:
    """Weights of the (unscaled) indicators, bias, slope and shift."""
    order = sorted(range(len(y)), key=lambda i: (rows[i].tolist(), y[i]))
    np.random.default_rng(1).shuffle(order)
    rows, y = [rows[i] for i in order], y[order]
    back = np.arange(len(y)) % 5 == 4      # every fifth row is held back for the sigmoid

    def fit_some(pick: np.ndarray) -> tuple[np.ndarray, float]:
        some = [rows[i] for i in np.flatnonzero(pick)]
        scale = log_count_ratios(some, y[pick], size)
        w, bias = dual_descent(some, y[pick], scale)
        return w * scale, bias

    slope, shift = 1.0, 0.0
    if len(set(y[back])) == 2 and len(set(y[~back])) == 2:
        w, bias = fit_some(~back)
        margin = np.array([w[rows[i]].sum() + bias for i in np.flatnonzero(back)])
        slope, shift = platt(margin, y[back])
    return *fit_some(np.ones(len(y), dtype=bool)), slope, shift


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 4, held: int = 2,
        sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> bytes:
    """The pickled model (bounded: at most MAX_FEATURES weights of each spelling)."""
    rows = stored(labelled_sample(docs, labels, label, folds, held, sample, id_col, text_col), "quality-rows")
    sizes = class_sizes(rows)
    if not all(sizes):
        return pickle.dumps(Model({}, constant(*sizes), 1.0, 0.0))
    counted = stored(count_features(rows, features, MIN_ROWS if sum(sizes) >= 1000 else 2), "quality-features")
    names = sorted(r["f"] for word in (True, False) for r in counted.filter(
        F.col("f").startswith("w") == word).orderBy(F.desc(F.col("pos") + F.col("neg")), "f").limit(MAX_FEATURES).collect())
    shared = docs.sparkSession.sparkContext.broadcast({f: i for i, f in enumerate(names)})

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = shared.value
        for b in batches:
            x = [sorted(at[f] for f in features(t.as_py().decode()).intersection(at)) for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.int32())), b.column(1)], ["x", "y"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, y = [], []
        for b in batches:
            x += [np.asarray(v.values, dtype=np.int64) for v in b.column(0)]
            y += b.column(1).to_pylist()
        w, *rest = train(x, np.array(y, dtype=int), len(names))
        model = Model({f: float(w[i]) for i, f in enumerate(names) if w[i]}, *map(float, rest))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["m"])

    numbered = rows.select("t", "y").mapInArrow(number, "x array<int>, y int")
    model = bytes(numbered.repartition(1).mapInArrow(learn, "m binary").first()["m"])
    discard(rows, counted)
    return model


def score(docs: DataFrame, model: bytes, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """docs with the score of every row (0 to 1)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    src = docs.withColumn(out_col, F.lit(0.0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = pickle.loads(shared.value)
        for whole in batches:
            text, at = whole.schema.get_field_index(text_col), whole.schema.get_field_index(out_col)
            for b in (whole.slice(i, 1024) for i in range(0, whole.num_rows, 1024)):
                s = [m.score(t.as_py() or "") for t in b.column(text)]
                yield b.set_column(at, out_col, pa.array(s, pa.float64()))

    return src.mapInArrow(run, src.schema)


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 4, held: int = 2,
             threshold: float = THRESHOLD, sample: int = SAMPLE,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, held_out, score, predicted) for every row of docs."""
    model = fit(docs, labels, label, folds, held, sample, id_col, text_col)
    out = score(docs.select(F.col(id_col), F.col(text_col)), model, text_col, "_score")
    return out.select(F.col(id_col), (fold(id_col, folds) == held).alias("held_out"),
                      F.col("_score").alias("score"), (F.col("_score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 4, held: int = 2,
              threshold: float = THRESHOLD, sample: int = SAMPLE,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows that score below the threshold; all columns kept, whatever their names."""
    model = fit(docs, labels, label, folds, held, sample, id_col, text_col)
    clear, names = aside(docs)
    kept = score(clear, model, names[text_col], "_score").filter(F.col("_score") >= threshold)
    return kept.select(*[F.col(f"`{new}`").alias(old) for old, new in names.items()])
