"""Toxicity classifier with a counterfactual penalty.

A text's features are the presence of its lower-cased words and of their first
3, 4 and 5 letters.  A logistic model is fitted to labelled texts.  From every
labelled sentence that names a group, counterfactual sentences are made by
putting other terms of the same list (a neutral one among them) in its place;
the squared change of the model's margin over these pairs is added to the
loss, so that naming a group, by itself, moves no score.

Learning takes up to ``SAMPLE`` labelled rows (a bounded, documented sample).
Their texts stay distributed: features are counted, chosen and looked up by
Spark, and one task fits the rows' feature numbers.  Scoring covers every row
and whole texts.

Defined cases: NULL and empty texts have no features and get the score of the
bias.  Without labelled rows of both classes the score is the share of label 1
(0.5 without any row).  A NULL id is scored like any other; repeated rows are repeated.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sublens.llm.common import discard, stored
from sublens.llm.linear import class_sizes, constant, count_features, fold, labelled_sample, sigmoid

SAMPLE = 20_000
FEATURES = 8_000              # at most, those that tell the classes apart most
LEAST_RATIO = 20.0            # likelihood ratio from which a difference isn't chance
RIDGE = 1.0                   # L2 penalty, per row weights
COUNTERFACTUAL = 10.0         # weight of the squared change over swapped sentences
MAX_PAIRS = 20_000            # swapped sentences used (bounded by the sample)
STEPS = 300
PREFIXES = (3, 4, 5)
KNOWN_WORDS = 1 << 18
WORD = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"[.!?\n]+")

# Terms that may stand for each other in a sentence; the last of
# each list is neutral.
IDENTITY_TERMS = (
    ("women", "men", "muslims", "christians", "jews", "immigrants", "refugees", "gays", "lesbians", "blacks",
     "whites", "asians", "people"),
    ("woman", "man", "muslim", "christian", "jew", "immigrant", "refugee", "lesbian", "person"),
    ("frauen", "männer", "muslime", "christen", "juden", "einwanderer", "flüchtlinge", "menschen"),
    ("femmes", "hommes", "musulmans", "chrétiens", "juifs", "immigrés", "réfugiés", "gens"),
    ("mujeres", "hombres", "musulmanes", "cristianos", "judíos", "inmigrantes", "refugiados", "personas"),
)


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def word_features(word: str) -> list[str]:
    return [word, *("^" + word[:k] for k in PREFIXES if len(word) >= k)]


def features(words) -> set[str]:
    return {f for w in set(words) for f in word_features(w)}


def counterfactuals(text: str, terms=IDENTITY_TERMS) -> Iterator[tuple[set[str], set[str]]]:
    """Features of each sentence that names a group, and of its swapped forms
    (to the neutral term and to the next of the list)."""
    group = {t: g for g in terms for t in g}
    for sentence in SENTENCE.split(text.lower()):
        words = WORD.findall(sentence)
        if not any(w in group for w in words):
            continue
        here = features(words)
        for put in (lambda g, w: g[-1], lambda g, w: g[(g.index(w) + 1) % len(g)]):
            swapped = features([put(group[w], w) if w in group else w for w in words])
            if swapped != here:
                yield here, swapped


class Model:
    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias
        self.known: dict[str, tuple[str, ...]] = {}

    def score(self, text: str) -> float:
        known, hit = self.known, set()
        for w in set(words_of(text)):
            f = known.get(w)
            if f is None:
                if len(known) >= KNOWN_WORDS:
                    known.clear()
                f = known[w] = tuple(x for x in word_features(w) if x in self.weights)
            if f:
                hit.update(f)
        return float(sigmoid(self.bias + sum(self.weights[f] for f in sorted(hit))))


def likelihood_ratio(na: int, nb: int) -> Column:
    """Statistic of pos and neg rows with a feature, out of na and nb: twice the
    log of how much likelier two shares make them than one."""
    def part(k: Column, n: int, p: Column) -> Column:
        return F.when(k > 0, k * F.log(p)).otherwise(0.0) + F.when(k < n, (n - k) * F.log(1 - p)).otherwise(0.0)

    a, b = F.col("pos"), F.col("neg")
    p = (a + b) / (na + nb)
    return 2 * (part(a, na, a / na) + part(b, nb, b / nb) - part(a, na, p) - part(b, nb, p))


def _csr(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, feature numbers) of the present features."""
    sizes = np.array([len(r) for r in rows], dtype=np.int64)
    return np.repeat(np.arange(len(rows)), sizes), np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64)


def train(rows: list[np.ndarray], y: np.ndarray, plus: list[np.ndarray], minus: list[np.ndarray], size: int,
          counterfactual: float = COUNTERFACTUAL) -> tuple[np.ndarray, float]:
    """Weights and bias; plus and minus are the features that each swap takes
    away and brings."""
    r, c = _csr(rows)
    pr, pc = _csr(plus)
    mr, mc = _csr(minus)
    pairs = len(plus)
    w, bias = np.zeros(size), 0.0
    gw, gb = np.full(size, 1e-8), 1e-8
    for _ in range(STEPS):                # full gradients, a step width for each weight
        m = np.bincount(r, w[c], len(y)) + bias
        g = 1 / (1 + np.exp(-np.clip(m, -30, 30))) - y
        d = np.bincount(c, g[r], size) + RIDGE * w
        if pairs:
            change = np.bincount(pr, w[pc], pairs) - np.bincount(mr, w[mc], pairs)
            k = 2 * counterfactual * len(y) / pairs
            d += k * (np.bincount(pc, change[pr], size) - np.bincount(mc, change[mr], size))
        db = g.sum()
        gw += d * d
        gb += db * db
        w -= 0.5 * d / np.sqrt(gw)
        bias -= 0.5 * db / np.sqrt(gb)
    return w, float(bias)


def _text_features(text: str) -> set[str]:
    return features(words_of(text))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 5, held: int = 0,
        sample: int = SAMPLE, counterfactual: float = COUNTERFACTUAL, terms=IDENTITY_TERMS,
        id_col: str = "doc_id", text_col: str = "text") -> bytes:
    """The pickled model (bounded: at most FEATURES weights)."""
    rows = stored(labelled_sample(docs, labels, label, folds, held, sample, id_col, text_col), "toxicity-rows")
    negative, positive = class_sizes(rows)
    if not negative or not positive:
        return pickle.dumps(Model({}, constant(negative, positive)))
    ratio = likelihood_ratio(positive, negative)
    counted = count_features(rows, _text_features, 3).select("f", ratio.alias("g")).filter(F.col("g") >= LEAST_RATIO)
    names = sorted(r["f"] for r in counted.orderBy(F.desc("g"), "f").limit(FEATURES).collect())
    shared = docs.sparkSession.sparkContext.broadcast({f: i for i, f in enumerate(names)})
    kind = pa.list_(pa.int32())

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(y, x, none) of each row, and (NULL, plus, minus) of each swap."""
        at = shared.value

        def of(found):
            return sorted(at[f] for f in found if f in at)
        for b in batches:
            out = []
            for t, y in zip(b.column(0), b.column(1).to_pylist(), strict=True):
                text = t.as_py().decode()
                out.append((y, of(_text_features(text)), None))
                if counterfactual:
                    out += [(None, of(a - z), of(z - a)) for a, z in counterfactuals(text, terms)]
            y, x, m = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(y, pa.int32()), pa.array(x, kind), pa.array(m, kind)], ["y", "x", "m"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got, swaps = [], []
        for b in batches:
            for y, x, m in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                got.append((x, y)) if y is not None else swaps.append((x, m))
        got.sort()
        swaps = sorted(swaps)[:: -(-len(swaps) // MAX_PAIRS) or 1]

        def number_arrays(lists):
            return [np.array(v, dtype=np.int64) for v in lists]
        w, bias = train(number_arrays(x for x, _ in got), np.array([y for _, y in got], dtype=float),
                        number_arrays(x for x, _ in swaps), number_arrays(m for _, m in swaps), len(names), counterfactual)
        model = Model({f: float(w[i]) for i, f in enumerate(names) if w[i]}, bias)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["m"])

    numbered = rows.select("t", "y").mapInArrow(number, "y int, x array<int>, m array<int>")
    model = bytes(numbered.repartition(1).mapInArrow(learn, "m binary").first()["m"])
    discard(rows)
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


def classify(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 5, held: int = 0,
             threshold: float = 0.5, sample: int = SAMPLE, counterfactual: float = COUNTERFACTUAL,
             terms=IDENTITY_TERMS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, held_out, score, predicted) for every row of docs."""
    model = fit(docs, labels, label, folds, held, sample, counterfactual, terms, id_col, text_col)
    out = score(docs.select(F.col(id_col), F.col(text_col)), model, text_col, "_score")
    return out.select(F.col(id_col), (fold(id_col, folds) == held).alias("held_out"),
                      F.col("_score").alias("score"), (F.col("_score") >= threshold).cast("int").alias("predicted"))
