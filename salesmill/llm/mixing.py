"""Mixing sources to target weights by soft membership.

A softmax classifier over telling words is trained on a bounded sample of labelled documents and gives every document a
posterior over the domains. Each document then gets a rate r >= 0 such that the expected tokens of each domain,
sum over documents of rate * tokens * posterior, come as close as possible to target totals.

The fit is projected-gradient least squares, run as Spark aggregations. A step moves every rate against the gradient of
the point it leads to and clips at zero; such an implicit step is found by Newton's method in one number per domain and
converges whether or not the targets are in reach. A rate is a function of the document's posterior and of the steps so
far, so nothing but the few numbers of each step travels between driver and executors, and every task replays the steps
over its own rows. `Fit` tells the totals before, reached and wanted.

Labels join by broadcast of the sample only (at most `max_labelled` rows), texts never move. Null text has no words and
no tokens; null ids are never labelled; an empty table gives no rows; rows pass one to one. A domain without labelled
documents is left out of the posteriors; without any labels every document is in the first domain.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Recent, long_list, map_batches, staged, texts

#: Domains of the labels table, from its marks.
DOMAINS = ("clean", "low", "toxic")
#: Their target weights.
WEIGHTS = (0.85, 0.14, 0.01)


def domain_of(quality: str = "quality", toxic: str = "toxic") -> Column:
    """0 clean, 1 low quality, 2 toxic; null where there is no mark."""
    return F.when(F.col(toxic) == 1, 2).when(F.col(quality) == 0, 1).when(F.col(quality) == 1, 0)


#: Words are hashed to this many slots before the classifier picks its own.
SLOTS = 1 << 18


def slot_of(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word, 7) % SLOTS


class Features:
    """Which of the chosen word slots a text has, and four figures of its shape and a constant; plus its number of words."""

    def __init__(self, chosen: list[int]):
        at = {slot: i for i, slot in enumerate(chosen)}
        self.n = len(chosen)
        self.column = Recent(lambda word: at.get(slot_of(word), self.n), 300_000)

    def __call__(self, text: str) -> tuple[np.ndarray, int]:
        words = text.lower().encode().split()
        n = len(words)
        out = np.zeros(self.n + 5)
        if n:
            distinct = set(words)
            out[np.fromiter(map(self.column.__getitem__, distinct), np.int64, len(distinct))] = 1.0
            chars = max(1, len(text))
            out[self.n :] = 1.0, len(distinct) / n, np.log1p(n) / 10, sum(map(text.count, "#*$%&|<>")) / chars, n / chars
        return out, n


def train(x: np.ndarray, y: np.ndarray, classes: int, l2: float = 1e-4, rounds: int = 300) -> np.ndarray:
    """Softmax weights (features x classes) by accelerated gradient descent; deterministic."""
    mean, std = x.mean(0), x.std(0)
    std[std == 0] = 1.0
    x = (x - mean) / std
    x[:, -5] = 1.0  # the constant
    w = seen = np.zeros((x.shape[1], classes), x.dtype)
    target = np.eye(classes, dtype=x.dtype)[y]
    step = 1 / (0.5 * np.linalg.norm(x.T @ x / len(x), 2) + l2)
    for i in range(rounds):
        p = softmax(x @ seen)
        new = seen - step * (x.T @ (p - target) / len(x) + l2 * seen)
        seen, w = new + i / (i + 3) * (new - w), new
    mean[-5], std[-5] = 0.0, 1.0
    w = w / std[:, None]
    w[-5] -= mean @ w
    return w.astype(np.float64)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


@dataclass
class Classifier:
    weights: np.ndarray
    present: list[int]
    classes: int
    chosen: list[int]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), self.classes))
        out[:, self.present] = softmax(x @ self.weights) if len(self.present) > 1 else 1.0
        return out


def _choose_slots(sample: DataFrame, classes: int, words: int) -> list[int]:
    """The slots whose presence depends most on the domain (chi-square), over the labelled sample."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [np.unique([slot_of(w) for w in set(t.lower().encode().split())]).astype(np.int64) for t in texts(batch.column("text"))]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
        return pa.RecordBatch.from_arrays([batch.column("domain"), long_list(np.concatenate([np.empty(0, np.int64), *found]), offsets)], names=["domain", "slots"])

    has = map_batches(sample, lambda: one, "domain int, slots array<long>")
    totals = {r.domain: r["count"] for r in sample.groupBy("domain").count().collect()}
    everything = sum(totals.values())
    counts = has.select("domain", F.explode("slots").alias("slot")).groupBy("slot").agg(
        F.count("*").alias("n"), *(F.count_if(F.col("domain") == k).alias(f"n{k}") for k in totals)
    )
    expected = {k: F.col("n") * (total / everything) for k, total in totals.items()}
    chi = sum(((F.col(f"n{k}") - expected[k]) ** 2 / expected[k] for k in totals), F.lit(0.0))
    best = counts.where("n >= 3").select("slot", F.round(chi, 6).alias("chi")).orderBy(F.desc("chi"), "slot").limit(words)
    return sorted(r.slot for r in best.collect())


def fit_classifier(
    docs: DataFrame, labels: DataFrame, domain: Column, classes: int = len(DOMAINS), max_labelled: int = 20_000, words: int = 500,
    id_col: str = "doc_id", text_col: str = "text",
) -> Classifier:
    """Trained on the labelled documents; of more than `max_labelled` those with the least hash of their id."""
    marked = labels.select(F.col(id_col).cast("long").alias("label_id"), domain.cast("int").alias("domain")).where("label_id is not null and domain is not null")
    marked = marked.groupBy("label_id").agg(F.max("domain").alias("domain")).orderBy(F.xxhash64("label_id"), "label_id").limit(max_labelled)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sample = rows.join(F.broadcast(marked), rows["doc_id"] == marked["label_id"]).select("doc_id", "domain", "text")
    # Repeated ids could bring more rows than labels: one row for each id.
    sample = staged(sample.groupBy("doc_id").agg(F.max("domain").alias("domain"), F.max("text").alias("text")))
    chosen = _choose_slots(sample, classes, words)

    def build():
        features = Features(chosen)

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            x = [features(t)[0].astype(np.float32).tobytes() for t in texts(batch.column("text"))]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("domain"), pa.array(x, pa.binary())], names=["doc_id", "domain", "x"])

        return one

    found = map_batches(sample, build, "doc_id long, domain int, x binary").orderBy(F.xxhash64("doc_id"), "doc_id").toArrow()
    y = found.column("domain").to_numpy()
    present = sorted(set(y.tolist())) or [0]
    x = np.frombuffer(b"".join(found.column("x").to_pylist()), np.float32).reshape(-1, len(chosen) + 5)
    weights = train(x, np.searchsorted(present, y), len(present)) if len(present) > 1 else np.zeros((x.shape[1], 1))
    return Classifier(weights, present, classes, chosen)


def posteriors(docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, row (hash of the text), n_tokens (words), p (array of the domains' posteriors): one row per row of `docs`."""

    def build():
        features = Features(model.chosen)

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            p, n = [], []
            found = texts(batch.column("text"))
            for i in range(0, len(found), 1024):
                x, words = zip(*map(features, found[i : i + 1024]))
                p.append(model(np.stack(x)))
                n += words
            p = np.concatenate(p)
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), pa.array(n, pa.int64()), pa.ListArray.from_arrays(np.arange(len(p) + 1, dtype=np.int32) * model.classes, pa.array(p.ravel()))],
                names=["doc_id", "row", "n_tokens", "p"],
            )

        return one

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("row"), F.col(text_col).alias("text"))
    return map_batches(rows, build, "doc_id long, row long, n_tokens long, p array<double>")


def rates_of(p: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Every document starts at 1; each step moves its rate along its posterior and clips at zero."""
    r = np.ones(len(p))
    for step in steps:
        r = np.maximum(0.0, r - p @ step)
    return r


def _matrix(column: pa.Array, classes: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, classes)


@dataclass
class Moments:
    """What one pass over the documents sums at the present rates.

    total: expected tokens of each domain; gram: how they move with a step, over the documents that can still move;
    squares: tokens times squared rates.
    """

    total: np.ndarray
    gram: np.ndarray
    squares: float


def moments(rows: DataFrame, steps: list[np.ndarray], classes: int) -> Moments:
    done = np.array(steps).reshape(-1, classes)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(classes + classes * classes + 1)
        for batch in batches:
            if batch.num_rows:
                p, n = _matrix(batch.column("p"), classes), batch.column("n_tokens").to_numpy().astype(np.float64)
                r = rates_of(p, done)
                free = np.where(r > 0, n, 0.0)
                sums += np.concatenate([(r * n) @ p, (p.T @ (free[:, None] * p)).ravel(), [n @ (r * r)]])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums), dtype=np.int32)), pa.array(sums)], names=["i", "value"])

    found = rows.select("n_tokens", "p").mapInArrow(task, "i int, value double").groupBy("i").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(classes + classes * classes + 1)
    for row in found:
        out[row.i] = row.value
    return Moments(out[:classes], out[classes:-1].reshape(classes, classes), float(out[-1]))


@dataclass
class Fit:
    """steps: of the rates; before, reached, targets: expected tokens of each domain; solved: no rate can improve the fit."""

    steps: list[np.ndarray]
    before: np.ndarray
    reached: np.ndarray
    targets: np.ndarray
    solved: bool

    @property
    def error(self) -> float:
        """Distance of the totals reached from the targets: zero unless no nonnegative rates give the targets."""
        return float(np.linalg.norm(self.reached - self.targets))


def _step(at: Callable[[np.ndarray], Moments], wanted: np.ndarray, pull: float, tolerance: float, passes: int = 40) -> tuple[np.ndarray, Moments]:
    """The projected-gradient step `s` that goes along the gradient of where it arrives: pull * s = totals there - targets.

    That is the least point of a convex function of `s` alone, of one number per domain, whose gradient and curvature one
    pass over the documents sums: Newton steps with a line search find it from anywhere.
    """
    value = lambda s, m: pull / 2 * s @ s + m.squares / 2 + wanted @ s
    step = np.zeros(len(wanted))
    found = at(step)
    for _ in range(passes):
        gradient = pull * step - found.total + wanted
        if np.abs(gradient).max() <= tolerance:
            break
        move = -np.linalg.solve(found.gram + pull * np.eye(len(wanted)), gradient)
        size = 1.0
        while True:
            further = at(step + size * move)
            if value(step + size * move, further) <= value(step, found) + 1e-4 * size * gradient @ move or size < 1e-9:
                break
            size /= 2
        if size < 1e-9:  # as near as doubles come
            break
        step, found = step + size * move, further
    return step, found


def fit_rates(rows: DataFrame, targets, classes: int = len(DOMAINS), rounds: int = 20, tolerance: float = 1e-6) -> Fit:
    """Nonnegative rates of least squared distance between the domains' expected tokens and the targets.

    Each round is a projected-gradient step of all rates, r <- max(0, r - p . s), taken implicitly (see `_step`), which
    converges whatever its length. Rounds end when one no longer improves the fit by `tolerance` of the largest target;
    targets out of reach end at the nearest totals in reach. A fit that does not settle is marked as not solved.

    targets: the domains' target totals, or a function from the present totals to them.
    """
    steps: list[np.ndarray] = []
    start = moments(rows, steps, classes)
    wanted = np.asarray(targets(start.total) if callable(targets) else targets, float)
    scale = max(np.abs(wanted).max(), 1.0)
    trace = max(np.trace(start.gram), 1e-9)
    total, solved = start.total, bool(np.abs(start.total - wanted).max() <= tolerance * scale)
    for i in range(0 if solved else rounds):
        # Ever longer steps: the fewer documents the best rates need, the farther these are.
        pull = trace * max(10.0 ** -(6 + i), 1e-12)
        step, found = _step(lambda s: moments(rows, [*steps, s], classes), wanted, pull, tolerance * scale / 10)
        better = np.linalg.norm(total - wanted) - np.linalg.norm(found.total - wanted)
        if better > 0:
            steps.append(step)
            total = found.total
        if better <= tolerance * scale or np.abs(total - wanted).max() <= tolerance * scale:
            solved = True
            break
    return Fit(steps, start.total, total, wanted, solved)


def with_rates(rows: DataFrame, fit: Fit, classes: int = len(DOMAINS)) -> DataFrame:
    """`rows` of `posteriors` with the column rate."""
    steps = np.array(fit.steps).reshape(-1, classes)

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(rates_of(_matrix(batch.column("p"), classes), steps))], names=[*batch.schema.names, "rate"])

    return map_batches(rows, lambda: one, "doc_id long, row long, n_tokens long, p array<double>, rate double")


def weighted_targets(weights: np.ndarray, keep: int = 0):
    """Totals in the proportions of `weights` whose domain `keep` has what it has now."""
    share = np.asarray(weights, float)
    return lambda totals: share / share[keep] * totals[keep]


def mixed(docs: DataFrame, labels: DataFrame, weights=WEIGHTS, max_labelled: int = 20_000) -> tuple[DataFrame, Fit]:
    """doc_id, row, n_tokens, p, rate for every row of `docs`, and the fit."""
    model = fit_classifier(docs, labels, domain_of(), max_labelled=max_labelled)
    rows = staged(posteriors(docs, model))
    fit = fit_rates(rows, weighted_targets(np.array(weights)))
    return with_rates(rows, fit), fit
