"""Toxicity by a classifier chain of linear models over words and word beginnings.

Categories are predicted one after another; the log odds of the earlier ones are
features of the later ones. A later model is trained with out-of-fold predictions
of the earlier ones, since those of a model on its own training rows would be too
good. Thresholds also come from out-of-fold predictions.

The fit takes a bounded sample of labelled rows (``TRAIN_ROWS``, chosen by a hash
of the id, every combination of labels alike) and a bounded vocabulary (``VOCABULARY`` features a category, those
with the strongest chi-square); scoring reads every text whole, in one pass
without a shuffle. Features of a text: its words, their first 4, 5 and 6 letters,
and a few numbers on its surface.

Defined cases: null and empty texts have no features; a null ``doc_id`` has no
label; labels that contradict each other count as positive; a null label counts
as 0; with fewer than ``LEAST_POSITIVES`` labelled examples of either kind a category
has probability 0, flags nothing, and a warning says so; repeated rows are scored one
by one, very long texts whole; an empty table gives no rows; columns named like those
that ``scored`` adds are replaced there; ``filtered`` keeps all columns.
"""

from __future__ import annotations

import math
import re
import warnings
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.llm.common import cut, parts

#: Labelled rows that a fit takes at most, about.
TRAIN_ROWS = 16_000
#: Features kept for each category.
VOCABULARY = 512
#: Texts of one id that a fit takes at most.
TEXTS = 4
FOLDS = 4
#: Examples that a category needs of either kind; with fewer it is off, and a warning says so.
LEAST_POSITIVES = 10
#: Strength of the quadratic penalty, steps of the fit, entries a counting task holds.
PENALTY, STEPS, HELD = 1e-4, 250, 300_000
PREFIXES = (4, 5, 6)
SURFACE = 6
WORDS = re.compile(r"[^\W\d_]+")


def features(text: str) -> set[str]:
    words = set(WORDS.findall(text.lower()))
    return words.union(*({w[:n] + "*" for w in words if len(w) > n} for n in PREFIXES))


def surface(text: str) -> list[float]:
    """Length, shares of upper case, of signs and of digits, word length, share of repeated lines."""
    size = len(text) or 1
    lines = text.split("\n")
    letters = sum(map(len, WORDS.findall(text)))
    spaces = text.count(" ") + len(lines) - 1
    digits = sum(map(text.count, "0123456789"))
    upper = sum(map(str.isupper, text))
    return [
        math.log1p(len(text)),
        upper / size,
        (size - letters - spaces) / size,
        digits / size,
        letters / (spaces + 1),
        1 - len(set(lines)) / len(lines),
    ]


def labelled(docs: DataFrame, labels: DataFrame, categories: dict[str, str], most: int = TRAIN_ROWS) -> DataFrame:
    """A bounded sample of labelled documents: doc_id, text, y (one 0/1 a category), weight.

    Up to ``most`` labelled ids are all taken. Of more, every combination of labels
    gets an equal part of the sample, so rare categories keep their examples; the
    weight says how many labelled ids a drawn one stands for. An id with several
    texts gives at most ``TEXTS`` of them, each once.
    """
    known = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        *[F.max(F.coalesce(F.expr(rule).cast("int"), F.lit(0))).alias(f"y{i}") for i, rule in enumerate(categories.values())]
    )
    known = known.select(F.col("doc_id").alias("_id"), F.array(*[f"y{i}" for i in range(len(categories))]).alias("y"))
    sizes = {tuple(row.y): row.n for row in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    drawn = known.withColumn("weight", F.lit(1.0))
    if sum(sizes.values()) > most:
        shares = {y: min(1.0, most / len(sizes) / n) for y, n in sizes.items()}
        same = lambda y: F.col("y") == F.array(*[F.lit(v) for v in y])
        share = F.coalesce(*[F.when(same(y), F.lit(part)) for y, part in shares.items()])
        place = F.pmod(F.xxhash64("_id", F.lit(5)), F.lit(1 << 40)) / F.lit(float(1 << 40))
        drawn = known.withColumn("weight", 1 / share).where(place < share)
    # The drawn labels are bounded by ``most``, so they go to every task.
    rows = docs.select("doc_id", "text").join(F.broadcast(drawn), F.col("doc_id") == F.col("_id"))
    texts = rows.groupBy("doc_id", F.xxhash64("text").alias("_hash")).agg(
        F.first(F.coalesce("text", F.lit(""))).alias("text"), F.first("y").alias("y"), F.first("weight").alias("weight")
    )
    once = F.row_number().over(Window.partitionBy("doc_id").orderBy("_hash"))
    return cut(texts.withColumn("_place", once).where(F.col("_place") <= TEXTS).select("doc_id", "text", "y", "weight"))


def vocabulary(train: DataFrame, size: int, kept: int = VOCABULARY) -> list[str]:
    """The features that tell most about each of ``size`` categories, by chi-square."""
    schema = "feature string, n long, " + ", ".join(f"y{i} long" for i in range(size))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, list[int]] = defaultdict(lambda: [0] * (size + 1))

        def flush() -> pa.RecordBatch:
            names = list(counts)
            columns = np.array(list(counts.values()), np.int64).reshape(-1, size + 1).T
            counts.clear()
            return pa.record_batch(
                [pa.array(names, pa.string()), *map(pa.array, columns)],
                names=["feature", "n", *[f"y{i}" for i in range(size)]],
            )

        for batch in parts(batches):
            for text, y in zip(batch.column("text"), batch.column("y").to_pylist()):
                for name in features(text.as_py()):
                    entry = counts[name]
                    entry[0] += 1
                    for i, value in enumerate(y):
                        entry[i + 1] += value
                if len(counts) > HELD:
                    yield flush()
        yield flush()

    totals = train.agg(F.count("*").alias("n"), *[F.sum(F.get("y", F.lit(i))).alias(f"y{i}") for i in range(size)]).first()
    counts = train.select("text", "y").mapInArrow(counted, schema).groupBy("feature").agg(
        F.sum("n").alias("n"), *[F.sum(f"y{i}").alias(f"y{i}") for i in range(size)]
    )
    counts = cut(counts.where("n >= 4"))
    chosen: list[str] = []
    for i in range(size):
        rows, positive = float(totals.n), float(totals[f"y{i}"] or 0)
        hit, n = F.col(f"y{i}"), F.col("n")
        gap = hit * rows - n * positive
        chi = gap * gap / (n * (rows - n + 0.5) * (positive + 0.5) * (rows - positive + 0.5))
        best = counts.select("feature", chi.alias("chi")).orderBy(F.desc("chi"), "feature").limit(kept)
        chosen += [row.feature for row in best.collect()]
    return list(dict.fromkeys(chosen))


class Rows:
    """Sparse 0/1 features beside dense columns, in compressed rows."""

    def __init__(self, index: list[np.ndarray], dense: np.ndarray, width: int):
        self.row = np.repeat(np.arange(len(index)), [len(i) for i in index])
        self.column = np.concatenate(index).astype(np.int64) if index else np.zeros(0, np.int64)
        self.dense, self.width = dense, width

    def times(self, w: np.ndarray) -> np.ndarray:
        sparse = np.bincount(self.row, w[self.column], len(self.dense)) if len(self.row) else 0.0
        return sparse + self.dense @ w[self.width :]

    def turned(self, v: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(self.column, v[self.row], self.width)[: self.width], v @ self.dense])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_linear(rows: Rows, y: np.ndarray, on: np.ndarray) -> np.ndarray:
    """Weights of a logistic model on rows that count as much as ``on`` says, by accelerated gradient steps."""
    size = rows.width + rows.dense.shape[1]
    weight, ahead, momentum = np.zeros(size), np.zeros(size), 1.0
    n = max(1.0, float(on.sum()))
    # A bound on the curvature from the row norms keeps every step downhill.
    norms = np.bincount(rows.row, minlength=len(y)) + (rows.dense**2).sum(1)
    rate = 1 / (0.25 * max(float(np.mean(norms)), float(norms @ on) / n) + PENALTY)
    for _ in range(STEPS):
        slope = rows.turned((sigmoid(rows.times(ahead)) - y) * on) / n + PENALTY * ahead
        new = ahead - rate * slope
        faster = (1 + math.sqrt(1 + 4 * momentum**2)) / 2
        ahead = new + (momentum - 1) / faster * (new - weight)
        weight, momentum = new, faster
    return weight


def best_threshold(p: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """Middle of the best threshold's plateau by F1, from out-of-fold probabilities."""
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum((y * weight)[order])
    scores = 2 * hits / (np.cumsum(weight[order]) + (y * weight).sum())
    at = int(np.argmax(scores))
    above = p[order][at]
    below = p[order][at + 1] if at + 1 < len(p) else 0.0
    return float((above + below) / 2)


class Chain:
    """A fitted chain: vocabulary, scaling, weights and threshold of every category."""

    def __init__(self, names: list[str], words: list[str]):
        self.names = names
        self.place = {word: i for i, word in enumerate(words)}
        self.middle = np.zeros(SURFACE)
        self.spread = np.ones(SURFACE)
        self.models: list[tuple[np.ndarray, float] | None] = []

    def indices(self, text: str) -> np.ndarray:
        place = self.place
        words = set(WORDS.findall(text.lower()))
        found = {place[w] for w in words if w in place}
        for n in PREFIXES:
            found.update(place[s] for s in {w[:n] + "*" for w in words if len(w) > n} if s in place)
        return np.array(sorted(found), np.int64)

    def scaled(self, numbers: np.ndarray) -> np.ndarray:
        scaled = np.clip((numbers - self.middle) / self.spread, -4, 4)
        return np.concatenate([scaled, np.ones((len(scaled), 1))], 1)

    def score(self, texts: list[str]) -> np.ndarray:
        """Probabilities, a row per text and a column per category."""
        if not texts:
            return np.zeros((0, len(self.names)))
        index = [self.indices(text) for text in texts]
        dense = self.scaled(np.array([surface(text) for text in texts]))
        columns = []
        for model in self.models:
            if model is None:
                columns.append(np.zeros(len(texts)))
            else:
                logit = Rows(index, dense, len(self.place)).times(model[0])
                columns.append(sigmoid(logit))
                dense = np.concatenate([dense, np.clip(logit, -6, 6)[:, None] / 2], 1)
        return np.stack(columns, 1)


def fit(docs: DataFrame, labels: DataFrame, categories: dict[str, str], most: int = TRAIN_ROWS) -> Chain:
    """A chain over ``categories``: name to SQL rule on ``labels``, in chain order."""
    train = labelled(docs, labels, categories, most)
    size = len(categories)
    chain = Chain(list(categories), vocabulary(train, size))

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            texts = batch.column("text").to_pylist()
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    batch.column("y"),
                    batch.column("weight"),
                    pa.array([chain.indices(t).tolist() for t in texts], pa.list_(pa.int64())),
                    pa.array([surface(t) for t in texts], pa.list_(pa.float64())),
                ],
                names=["doc_id", "y", "weight", "found", "numbers"],
            )

    fields = "doc_id long, y array<int>, weight double, found array<long>, numbers array<double>"
    taken = train.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "y", "weight").mapInArrow(indexed, fields)
    taken = sorted(taken.collect(), key=lambda row: (row.doc_id, row.found))
    y = np.array([row.y for row in taken], float).reshape(-1, size)
    counts_as = np.array([row.weight for row in taken], float)
    index = [np.array(row.found, np.int64) for row in taken]
    numbers = np.array([row.numbers for row in taken], float).reshape(-1, SURFACE)
    if len(taken):
        chain.middle, chain.spread = numbers.mean(0), numbers.std(0) + 1e-9
    dense = chain.scaled(numbers)
    fold = np.arange(len(taken)) % FOLDS
    for i in range(size):
        if y[:, i].sum() < LEAST_POSITIVES or (1 - y[:, i]).sum() < LEAST_POSITIVES:
            warnings.warn(f"too few labelled examples of {chain.names[i]}: nothing will be put into it", stacklevel=2)
            chain.models.append(None)
            continue
        rows = Rows(index, dense, len(chain.place))
        outside = np.zeros(len(taken))
        for k in range(FOLDS):
            held = fold == k
            outside[held] = rows.times(fit_linear(rows, y[:, i], ~held * counts_as))[held]
        weights = fit_linear(rows, y[:, i], counts_as)
        chain.models.append((weights, best_threshold(sigmoid(outside), y[:, i], counts_as)))
        dense = np.concatenate([dense, np.clip(outside, -6, 6)[:, None] / 2], 1)
    return chain


def scored(docs: DataFrame, chain: Chain) -> DataFrame:
    """``docs`` with ``p_<category>`` and ``is_<category>`` of every category."""
    added = [f"p_{n}" for n in chain.names] + [f"is_{n}" for n in chain.names]
    kept = docs.select(*[c for c in docs.columns if c not in added])
    schema = T.StructType(list(kept.schema.fields))
    for name in chain.names:
        schema = schema.add(f"p_{name}", "double")
    for name in chain.names:
        schema = schema.add(f"is_{name}", "boolean")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            p = chain.score([t or "" for t in batch.column("text").to_pylist()])
            columns = list(batch.columns) + [pa.array(p[:, i]) for i in range(len(chain.names))]
            for i, model in enumerate(chain.models):
                flags = p[:, i] >= model[1] if model else np.zeros(len(p), bool)
                columns.append(pa.array(flags))
            yield pa.record_batch(columns, names=[*batch.schema.names, *added])

    return kept.mapInArrow(score, schema)


#: Chain order: junk first, as its probability helps to judge toxicity.
CATEGORIES = {"low_quality": "quality = 0", "toxic": "toxic = 1"}


def filtered(docs: DataFrame, labels: DataFrame, reject: str = "toxic") -> DataFrame:
    """The documents that the chain does not put into the category ``reject``."""
    chain = fit(docs, labels, CATEGORIES)
    place = chain.names.index(reject)
    model = chain.models[place]
    if model is None:
        return docs

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            p = chain.score([t or "" for t in batch.column("text").to_pylist()])
            yield batch.filter(pa.array(p[:, place] < model[1]))

    return docs.mapInArrow(kept, docs.schema)
