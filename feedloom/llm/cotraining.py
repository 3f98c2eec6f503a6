"""Document quality by co-training: a view of the text and a view of the page teach each other."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.learn import fit_logistic, sigmoid
from feedloom.llm.text import SPACED, hash_words, pieces, utf8
from feedloom.session import staged

#: Labelled documents that the views are fitted on at most.
SAMPLE_DOCS = 4000

#: Rounds of exchange, what a view is sure of, and how many it passes on in a round and class.
ROUNDS = 5
SURE = 0.95
PASSED_ON = 200

#: Hashed word features of the text; hashed sources and languages of the page.
WORD_BINS = 128
PAGE_BINS = 48

#: Features of a document in each view.
WIDTHS = (13 + WORD_BINS, PAGE_BINS + 4)

_CLASSES = np.zeros(256, np.int64)
for _i in range(256):
    _c = chr(_i)
    _CLASSES[_i] = (
        1 if _i >= 128 or _c.islower() else 2 if _c.isupper() else 3 if _c.isdigit() else 4 if _c.isspace()
        else 5 if _c in ".,;:'-" else 6 if _c in "!?" else 7 if _c == "|" else 0
    )


def text_view(column: pa.Array) -> np.ndarray:
    """Features of a piece of texts: kinds of characters, repetition of words, hashed words."""
    data, ends = utf8(column)
    n = len(ends) - 1
    doc = np.repeat(np.arange(n), np.diff(ends))
    kinds = np.bincount(doc * 8 + _CLASSES[data], minlength=n * 8).reshape(n, 8)
    shares = kinds / np.maximum(np.diff(ends), 1)[:, None]
    words, bounds = hash_words(data, ends, SPACED)
    counts = np.diff(bounds)
    owner = np.repeat(np.arange(n), counts)
    some = np.maximum(counts, 1)
    distinct, often = np.zeros(n), np.zeros(n)
    again = np.zeros(n)
    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        if b > a:
            times = np.unique(words[a:b], return_counts=True)[1]
            distinct[i], often[i] = len(times), times.max()
            again[i] = (words[a + 1 : b] == words[a : b - 1]).mean() if b - a > 1 else 0
    bins = np.bincount(
        owner * WORD_BINS + (words % np.uint64(WORD_BINS)).astype(np.int64), minlength=n * WORD_BINS
    ).reshape(n, WORD_BINS)
    letters = (kinds[:, 1] + kinds[:, 2]) / some
    own = np.stack(
        [distinct / some**0.9, often / some, again, np.log1p(letters), (counts == 0).astype(float)], axis=1
    )
    return np.hstack([np.sqrt(shares), own, np.sqrt(bins / some[:, None])])


def page_view(source: list, lang: list, texts: pa.Array) -> np.ndarray:
    """Features of the page without its words: source, language, length and layout."""
    data, ends = utf8(texts)
    n = len(ends) - 1
    size = np.diff(ends)
    doc = np.repeat(np.arange(n), size)
    lines = np.bincount(doc[data == 10], minlength=n) + 1
    out = np.zeros((n, PAGE_BINS))
    for i, pair in enumerate(zip(source, lang, strict=True)):
        for kind, value in zip("sl", pair, strict=True):
            out[i, xxhash.xxh3_64_intdigest(f"{kind}:{value}") % PAGE_BINS] += 1
    layout = np.stack([np.log1p(size) / 10, np.log1p(size) ** 2 / 100, np.log1p(lines) / 5, np.log1p(size / lines) / 10], 1)
    return np.hstack([out, layout])


@dataclass
class View:
    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    calibration: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights[:-1] + self.weights[-1]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.raw(x) * self.calibration[0] + self.calibration[1], -12, 12)


@dataclass
class Model:
    views: list[View]
    combined: np.ndarray

    def scores(self, features: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
        odds = [v.log_odds(x) for v, x in zip(self.views, features, strict=True)]
        together = np.stack(odds, 1) @ self.combined[:-1] + self.combined[-1]
        return sigmoid(together), [sigmoid(o) for o in odds]


def _view(x: np.ndarray, y: np.ndarray, held_x: np.ndarray, held_y: np.ndarray) -> View:
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    view = View(fit_logistic((x - mean) / scale, y, penalty=5.0), mean, scale, np.array([1.0, 0.0]))
    view.calibration = fit_logistic(view.raw(held_x)[:, None], held_y, penalty=0.01)
    return view


@dataclass
class Picks:
    """Documents that a view is sure of: which view, the label it gives, how sure, which document, its features."""

    view: np.ndarray
    label: np.ndarray
    sure: np.ndarray
    turn: np.ndarray
    features: list[np.ndarray]


def surest(
    views: list[View], turns: np.ndarray, features: list[np.ndarray], given: list[np.ndarray], most: int = PASSED_ON
) -> Picks:
    """For each view and label the ``most`` surest documents that the other view was not given yet.

    ``turns`` numbers the documents and orders what is equally sure; ``given`` has those that went
    to each view.
    """
    parts = []
    for v in (0, 1):
        p = sigmoid(views[v].log_odds(features[v])) if len(turns) else np.empty(0)
        for label, sure in ((1, p), (0, 1 - p)):
            rows = np.flatnonzero((sure >= SURE) & ~np.isin(turns, given[1 - v]))
            rows = rows[np.lexsort((turns[rows], -sure[rows]))][:most]
            parts.append((np.full(len(rows), v), np.full(len(rows), label), sure[rows], rows))
    view, label, sure, rows = (np.concatenate(x) for x in zip(*parts, strict=True))
    return Picks(view, label, sure, turns[rows], [x[rows] for x in features])


def cotrain(
    labelled: list[np.ndarray], y: np.ndarray, find: Callable[[list[View], list[np.ndarray]], Picks], seed: int = 0
) -> Model:
    """Fit both views over rounds; ``labelled`` holds the features of each.

    A fourth of the labels calibrates the views and weighs them against each other. In a round
    each view labels the documents it is surest of, and the other learns from them: ``find(views, given)``
    looks for them among all documents without a label. Without labels every score is one half.
    """
    if not len(y):
        none = [View(np.zeros(x.shape[1] + 1), np.zeros(x.shape[1]), np.ones(x.shape[1]), np.array([1.0, 0.0])) for x in labelled]
        return Model(none, np.zeros(3))
    rng = np.random.default_rng(seed)
    held = rng.random(len(y)) < 0.25
    own = ~held
    learnt: list[tuple[list[np.ndarray], list[np.ndarray]]] = [([], []), ([], [])]
    given = [np.empty(0, np.int64), np.empty(0, np.int64)]

    def fit_view(v: int) -> View:
        x = np.vstack([labelled[v][own], *learnt[v][0]])
        return _view(x, np.concatenate([y[own], *learnt[v][1]]).astype(y.dtype), labelled[v][held], y[held])

    views = [fit_view(0), fit_view(1)]
    for _ in range(ROUNDS):
        picks = find(views, given)
        if not len(picks.turn):
            break
        for v in (0, 1):
            rows = picks.view == 1 - v
            learnt[v][0].append(picks.features[v][rows])
            learnt[v][1].append(picks.label[rows])
            given[v] = np.concatenate([given[v], picks.turn[rows]])
        views = [fit_view(0), fit_view(1)]
    odds = np.stack([v.log_odds(x[held]) for v, x in zip(views, labelled, strict=True)], 1)
    return Model(views, fit_logistic(odds, y[held], penalty=0.5))


_FEATURES = "text binary, page binary"
_PICKS = f"view int, label int, sure double, turn long, {_FEATURES}"


def packed(features: np.ndarray) -> pa.Array:
    """Rows of features as half-precision numbers, a binary value each."""
    return pa.array([row.tobytes() for row in np.clip(features, -60_000, 60_000).astype(np.float16)], pa.binary())


def unpacked(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    rows = b"".join(x.as_buffer() for x in column)
    return np.frombuffer(rows, np.float16).reshape(-1, width).astype(np.float32)


def surest_of(unlabelled: DataFrame, views: list[View], given: list[np.ndarray], most: int = PASSED_ON) -> Picks:
    """:func:`surest` over a table of features (``turn``, ``text``, ``page``) of any size.

    Every batch keeps its surest, and the surest of those are taken by a ranking that starts in each task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features = [unpacked(batch.column(i + 1), WIDTHS[i]) for i in (0, 1)]
            found = surest(views, batch.column(0).to_numpy(), features, given, most)
            lists = [packed(x) for x in found.features]
            numbers = [pa.array(found.view, pa.int32()), pa.array(found.label, pa.int32()), pa.array(found.sure), pa.array(found.turn)]
            yield pa.RecordBatch.from_arrays([*numbers, *lists], ["view", "label", "sure", "turn", "text", "page"])

    order = Window.partitionBy("view", "label").orderBy(F.desc("sure"), "turn")
    best = unlabelled.select("turn", "text", "page").mapInArrow(run, _PICKS)
    best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    found = best.orderBy("view", F.desc("label"), "rank").toArrow()
    columns = [found.column(c).to_numpy() for c in ("view", "label", "sure", "turn")]
    return Picks(*columns, [unpacked(found.column(c), w) for c, w in zip(("text", "page"), WIDTHS, strict=True)])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in pieces(batch.column("text")):
            part = batch.slice(a, b - a)
            columns = [part.column("doc_id"), *[packed(x) for x in _both(part)]]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "page"])


def _both(part: pa.RecordBatch) -> list[np.ndarray]:
    texts = part.column("text")
    return [text_view(texts), page_view(*[part.column(c).to_pylist() for c in ("source", "lang")], texts)]


def _inputs(docs: DataFrame, doc_id: str, text: str, source: str, lang: str) -> DataFrame:
    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(text).alias("text"),
        F.col(source).cast("string").alias("source"),
        F.col(lang).cast("string").alias("lang"),
    )


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
    most: int = SAMPLE_DOCS,
) -> Model:
    """Fit on at most ``most`` labelled documents, chosen by hash, and on what the views find among all others.

    The features of all documents are written once; in each round both views score every document that
    is not among those fitted on. Rows without an id have no label. Without labelled documents every score is
    one half.
    """
    known = labels.select(F.col("doc_id").alias("_of"), F.col(label).cast("int").alias("label")).where(
        "_of IS NOT NULL AND label IN (0, 1)"
    )
    rows = _inputs(docs, doc_id, text, source, lang)
    every = staged(
        rows.mapInArrow(_features, f"doc_id long, {_FEATURES}").withColumn("turn", F.xxhash64("doc_id", "text", "page")), "features"
    )
    there = every.select(F.col("doc_id").alias("_of")).distinct()
    ids = known.join(there, "_of", "left_semi").orderBy(F.xxhash64("_of", F.lit("quality")), "_of", "label").limit(most)
    found = every.join(F.broadcast(ids), F.col("doc_id") == F.col("_of")).toArrow().sort_by([("doc_id", "ascending"), ("turn", "ascending")])
    labelled = [unpacked(found.column(c), w) for c, w in zip(("text", "page"), WIDTHS, strict=True)]
    own = found.column("turn").to_numpy()
    return cotrain(
        labelled,
        found.column("label").to_numpy().astype(np.int64),
        lambda views, given: surest_of(every, views, [np.append(own, g) for g in given]),
    )


def quality(
    docs: DataFrame,
    model: Model,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
) -> DataFrame:
    """Scores of each row: ``score``, ``text_score``, ``page_score`` (0 to 1, higher is better).

    ``predicted`` is 1 for a score of at least 0.5. Null texts are empty; null sources and languages
    are values of their own; rows of one ``doc_id`` are scored each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(batch.column("text")):
                part = batch.slice(a, b - a)
                score, (by_text, by_page) = model.scores(_both(part))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        *[pa.array(x) for x in (score, by_text, by_page)],
                        pa.array((score >= 0.5).astype(np.int32)),
                    ],
                    ["doc_id", "score", "text_score", "page_score", "predicted"],
                )

    return _inputs(docs, doc_id, text, source, lang).mapInArrow(
        run, "doc_id long, score double, text_score double, page_score double, predicted int"
    )
