"""Toxicity by a subsequence string kernel, Nyström landmarks and a support vector machine.

The kernel compares two strings by their subsequences of three characters, each weighted by how
far it is stretched, so a word with gaps or inserted characters stays close to the plain
word. A linear machine over Nyström features of landmarks is, for the kernel, one weight per
subsequence; scoring a word is a sum over its subsequences, divided by the word's own norm. It is
cheap and looks at every word. The few words it finds suspicious go to a second machine over
the landmarks, whose kernel falls off steeply with the likeness of the first.
"""

from __future__ import annotations

import ctypes
import gc
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.learn import fit_logistic, fit_svm, sigmoid
from feedloom.llm.text import pieces

#: A subsequence of three characters counts by DECAY for each character it spans, up to SPAN.
DECAY = 0.8
SPAN = 7

#: Codes of characters: a-z, then everything else by code point.
ALPHABET = 64

#: Words longer than this are scored in overlapping parts.
PART = 24

#: Decisions below this count as this: nothing of interest.
FLOOR = -1.0

#: Labelled documents of each class that the model is fitted on at most.
SAMPLE_DOCS = 3000

#: Words are learnt from texts of at most so many bytes, as longer ones have nearly all words; how decisions on words make one on
#: a document is learnt from texts of any length.
WORD_BYTES = 20_000

#: Of longer texts than this, whole sentences from all over the text are fitted on, in about as many bytes.
SAMPLE_BYTES = 40_000

#: Landmarks for each class.
LANDMARKS = 96

#: A first, linear machine passes words on to a second one from this decision on.
GATE = -0.5

#: The second machine's kernel falls by e for each loss of likeness of this size.
WIDTH = 0.25

#: How much a missed toxic document weighs against a clean one that is rejected.
MISSED = 2.0

#: Words whose decision a worker remembers.
_MEMORY = 300_000

_SENTENCE_END = r"[.!?\n|]"
_SENTENCE = re.compile(f"{_SENTENCE_END}+")
_SPELLED = re.compile(r"(?<!\S)\w(?:\s+\w){2,}(?!\S)")
_MARKS = re.compile(r"[\W_]+")
_EDGES = "".join(chr(i) for i in range(128) if not chr(i).isalnum())

_OFFSETS = [(j, k) for k in range(2, SPAN) for j in range(1, k)]


def _codes(words: list[str]) -> np.ndarray:
    """Words of one length as rows of codes."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)
    low = (points >= 97) & (points <= 122)
    return np.where(low, points - 97, 26 + points % (ALPHABET - 26)).astype(np.int64)


def _subsequences(words: list[str]) -> Iterator[tuple[np.ndarray, float]]:
    """For words of one length: codes of subsequences by column, and their weight."""
    codes = _codes(words)
    n = codes.shape[1]
    for j, k in _OFFSETS:
        if n > k:
            a, b, c = codes[:, : n - k], codes[:, j : n - k + j], codes[:, k:]
            yield (a * ALPHABET + b) * ALPHABET + c, DECAY ** (k + 1)


def norms(words: list[str]) -> np.ndarray:
    """The kernel of each word (of one length) with itself, as a square root."""
    found = list(_subsequences(words))
    if not found:
        return np.zeros(len(words))
    codes = np.concatenate([c for c, _ in found], axis=1)
    weights = np.concatenate([np.full(c.shape[1], w) for c, w in found])
    order = np.argsort(codes, axis=1)
    codes = np.take_along_axis(codes, order, 1)
    sums = np.cumsum(weights[order], axis=1)
    last = np.ones(codes.shape, bool)
    last[:, :-1] = codes[:, 1:] != codes[:, :-1]
    row, column = np.nonzero(last)
    ends = sums[row, column]
    first = np.append(True, row[1:] != row[:-1])
    each = ends - np.where(first, 0, np.append(0, ends[:-1]))
    return np.sqrt(np.bincount(row, each * each, len(words)))


def least_norm(length: int) -> float:
    """No word of this length has a smaller norm."""
    return float(np.sqrt(sum((length - k) * DECAY ** (2 * (k + 1)) for _, k in _OFFSETS if length > k)))


class Landmarks:
    """The kernel of words with fixed landmarks, all at unit norm."""

    def __init__(self, words: list[str]):
        self.words = words
        found = []
        for m, word in enumerate(words):
            norm = norms([word])[0]
            for codes, weight in _subsequences([word]):
                found += [(int(c), m, weight / norm) for c in codes[0]]
        codes = np.unique([c for c, _, _ in found])
        #: Row of ``table`` for each subsequence; row 0 is for those of no landmark.
        self.row = np.zeros(ALPHABET**3, np.int32)
        self.row[codes] = np.arange(1, len(codes) + 1)
        self.table = np.zeros((len(codes) + 1, len(words)), np.float32)
        for code, m, value in found:
            self.table[self.row[code], m] += value

    def kernel(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(self.words)), np.float32)
        for _, rows, group in _by_length(words, 500):
            total = np.zeros((len(group), len(self.words)))
            for codes, weight in _subsequences(group):
                total += weight * self.table[self.row[codes]].sum(axis=1)
            out[rows] = total / np.maximum(norms(group), 1e-9)[:, None]
        return out

    def weights(self, by_landmark: np.ndarray) -> np.ndarray:
        """One weight for each subsequence, for a sum over landmarks."""
        return (self.table @ by_landmark.astype(np.float32))[self.row]


def kernel(a: str, b: str) -> float:
    """Likeness of two words, 1 for equal ones."""
    return float(Landmarks([b]).kernel([a])[0, 0])


def _by_length(words: list[str], most: int = 4_000) -> Iterator[tuple[int, np.ndarray, list[str]]]:
    length = np.array([len(w) for w in words])
    for n in np.unique(length).tolist():
        for part in np.array_split(np.flatnonzero(length == n), 1 + (length == n).sum() // most):
            yield n, part, [words[i] for i in part]


def _parts(words: list[str]) -> tuple[np.ndarray, list[str]]:
    """Long words in overlapping parts, and the word of each."""
    owner, parts = [], []
    for i, word in enumerate(words):
        if len(word) <= PART:
            owner.append(i)
            parts.append(word)
        else:
            for a in range(0, len(word) - PART // 2, PART // 2):
                owner.append(i)
                parts.append(word[a : a + PART])
    return np.array(owner, np.int64), parts


def decisions(words: list[str], weights: np.ndarray, constant: float) -> np.ndarray:
    """The machine's decision for each word, at least FLOOR.

    Long words count by their best part; words whose weights do not add up to more than nothing
    get FLOOR. Norms are only worked out where the decision could be over FLOOR at the least norm
    of a word of that length.
    """
    owner, parts = _parts(words)
    best = np.full(len(parts), FLOOR)
    for n, rows, group in _by_length(parts):
        if n < 3:
            continue
        total = np.zeros(len(group))
        for codes, weight in _subsequences(group):
            total += weight * weights[codes].sum(axis=1)
        near = np.flatnonzero((total > 0) & (total / least_norm(n) + constant > FLOOR))
        if len(near):
            norm = norms([group[i] for i in near])
            best[rows[near]] = np.maximum(total[near] / norm + constant, FLOOR)
    out = np.full(len(words), FLOOR)
    np.maximum.at(out, owner, best)
    return out


def words_of(text: str) -> list[str]:
    """Lower-cased words between white space without marks at their ends.

    A word with marks inside also counts without them, and three or more single characters in a
    row also count as one word.
    """
    low = text.lower()
    words = [w for w in (x.strip(_EDGES) for x in low.split()) if w]
    words += [_MARKS.sub("", w) for w in words if not w.isalnum()]
    words += [re.sub(r"\s+", "", m) for m in _SPELLED.findall(low)]
    return words


def sharpened(likeness: np.ndarray) -> np.ndarray:
    return np.exp((likeness - 1) / WIDTH)


@dataclass
class Machine:
    """Both machines: weights of subsequences and a constant, then of landmarks and a constant."""

    weights: np.ndarray
    constant: float
    landmarks: Landmarks
    by_landmark: np.ndarray

    def decide(self, words: list[str]) -> np.ndarray:
        """The decision for each word, FLOOR for those that the first machine lets go."""
        first = decisions(words, self.weights, self.constant)
        out = np.full(len(words), FLOOR)
        suspicious = np.flatnonzero(first > GATE)
        owner, parts = _parts([words[i] for i in suspicious])
        if len(parts):
            near = sharpened(self.landmarks.kernel(parts))
            found = near @ self.by_landmark[:-1] + self.by_landmark[-1]
            np.maximum.at(out, suspicious[owner], found)
        return out


#: Numbers that :func:`pooled` gives.
POOLED = 7


def pooled(found: list[float], words: int) -> list[float]:
    """What a document's word decisions say: the strongest few, all and the telling ones for its length, and its length.

    The strongest of many words are stronger by chance, so the length is there to be weighed against them.
    """
    top = sorted((f for f in found if f > FLOOR), reverse=True)
    strong = [*top[:5], *[FLOOR] * 5]
    telling = [f for f in top if f > 0]
    size = 20 + words
    excess = sum(f - FLOOR for f in telling) / size**0.5
    return [strong[0], strong[1], strong[2], strong[4], excess, float(np.log(size)), 100 * len(telling) / size]


@dataclass
class Model:
    """The machines for words, none without labels of both kinds, and the model over decisions."""

    machine: Machine | None
    logistic: np.ndarray

    def decide(self, words: list[str]) -> np.ndarray:
        return self.machine.decide(words) if self.machine else np.full(len(words), FLOOR)

    def score(self, features: np.ndarray) -> np.ndarray:
        return sigmoid(features @ self.logistic[:-1] + self.logistic[-1])


def _odds(docs: list[list[str]], toxic: np.ndarray) -> dict[str, float]:
    """How much likelier toxic documents have a word than others, in standard errors."""
    counts = [Counter(), Counter()]
    for words, label in zip(docs, toxic.tolist(), strict=True):
        counts[label].update({w for w in words if len(w) >= 3})
    n = [max(int((toxic == label).sum()), 1) for label in (0, 1)]
    share = n[1] / sum(n)
    out = {}
    for word, there in counts[1].items():
        total = there + counts[0][word]
        out[word] = (there - share * total) / (total * share * (1 - share) + 1) ** 0.5
    return out


def fit(texts: list[str], toxic: np.ndarray, rounds: int = 3, seed: int = 0) -> Model:
    """Fit on labelled documents, whose sentences take part by their most telling word.

    A sentence of a clean document is clean. Of a toxic document the most telling sentence
    is toxic, and others are if the machine of the round before says so; the rest take no side.
    A third of the documents, and those over WORD_BYTES, are kept out and fit the step from word decisions to a
    score.
    """
    rng = np.random.default_rng(seed)
    toxic = toxic.astype(np.int64)
    same: dict[str, str] = {}  # one object for each word
    own = (rng.random(len(texts)) < 2 / 3) & np.array([len(t.encode()) <= WORD_BYTES for t in texts], bool)
    rows = np.flatnonzero(own)
    # Sentences matter where words are learnt only.
    sentences, flat = [], []
    for text, mine in zip(texts, own, strict=True):
        doc = [[same.setdefault(w, w) for w in words_of(s)] for s in _SENTENCE.split(text)]
        sentences.append(doc if mine else None)
        flat.append([w for s in doc for w in s])
    odds = _odds([flat[i] for i in rows], toxic[rows])
    telling = [w for w, z in sorted(odds.items(), key=lambda x: (-x[1], x[0])) if z > 2.5]
    plain = sorted({w for i in rows if not toxic[i] for w in flat[i] if len(w) >= 3})
    plain = [plain[i] for i in rng.permutation(len(plain))[:LANDMARKS]]
    chosen = telling[:LANDMARKS] + plain
    if not telling or not plain:
        return Model(None, np.append(np.zeros(POOLED), np.log((toxic.sum() + 1) / ((1 - toxic).sum() + 1))))
    landmarks = Landmarks(chosen)
    values, vectors = np.linalg.eigh(landmarks.kernel(chosen).astype(float))
    useful = values > 1e-6 * values[-1]
    half = vectors[:, useful] / np.sqrt(values[useful])

    score = {w: z - 2.5 for w, z in odds.items()}
    vocabulary = sorted({w for i in rows for w in flat[i] if len(w) >= 3})
    weights, constant = np.zeros(ALPHABET**3), FLOOR
    for _ in range(rounds):
        wanted: Counter = Counter()
        for i in rows:
            best = [
                max(((score.get(w, FLOOR), w) for w in s if len(w) >= 3), default=None) for s in sentences[i]
            ]
            best = [b for b in best if b]
            if not best:
                continue
            if toxic[i]:
                top = max(best)
                for value, word in best:
                    if value > 0 or (value, word) == top and value > FLOOR:
                        wanted[word, 1] += 1
            else:
                for _, word in best:
                    wanted[word, -1] += 1
        pairs = sorted(wanted)
        sides = np.array([side for _, side in pairs], float)
        negative = np.flatnonzero(sides < 0)
        spare = rng.permutation(negative)[8000:]
        keep = np.setdiff1d(np.arange(len(pairs)), spare)
        pairs, sides = [pairs[i] for i in keep], sides[keep]
        times = np.array([min(wanted[p], 20) for p in pairs], float)
        features = landmarks.kernel([w for w, _ in pairs]) @ half
        cost = np.where(sides > 0, times / times[sides > 0].sum(), times / times[sides < 0].sum())
        machine = fit_svm(features, sides, cost * 4000)
        weights, constant = landmarks.weights(half @ machine[:-1]), float(machine[-1])
        score = dict(zip(vocabulary, decisions(vocabulary, weights, constant).tolist(), strict=True))

    machine = _second(weights, constant, [(flat[i], toxic[i]) for i in rows], odds, score)
    held = sorted({w for i in np.flatnonzero(~own) for w in flat[i]})
    score = dict(zip(held, machine.decide(held).tolist(), strict=True))
    kept_out = np.flatnonzero(~own)
    features = np.array([pooled([score[w] for w in flat[i]], len(flat[i])) for i in kept_out])
    weight = np.where(toxic[kept_out] == 1, MISSED, 1.0)
    return Model(machine, fit_logistic(features, toxic[kept_out], weight, penalty=0.1))


def _second(
    weights: np.ndarray, constant: float, docs: list[tuple], odds: dict[str, float], first: dict[str, float]
) -> Machine:
    """Fit the second machine on the words that the first one finds suspicious.

    A word is an example against as often as clean documents have it, and an example for as
    often as toxic ones have it, if that is more than chance. Landmarks are the most frequent.
    """
    n = [max(sum(label == side for _, label in docs), 1) for side in (0, 1)]
    counts = [Counter(), Counter()]
    for words, label in docs:
        counts[label].update({w for w in words if first.get(w, FLOOR) > GATE})
    bad = sorted((w for w in counts[1] if odds[w] > 1.5), key=lambda w: (-counts[1][w], w))
    good = sorted(counts[0], key=lambda w: (-counts[0][w], w))
    landmarks = Landmarks(sorted({*bad[: 2 * LANDMARKS], *good[: 2 * LANDMARKS]}))
    examples = bad[:6000] + good[:6000]
    side = np.array([1.0] * len(bad[:6000]) + [-1.0] * len(good[:6000]))
    cost = np.array([counts[1][w] / n[1] for w in bad[:6000]] + [counts[0][w] / n[0] for w in good[:6000]])
    values, vectors = np.linalg.eigh(sharpened(landmarks.kernel(landmarks.words).astype(float)))
    useful = values > 1e-6 * values[-1]
    half = vectors[:, useful] / np.sqrt(values[useful])
    near = sharpened(landmarks.kernel(examples)) @ half.astype(np.float32)
    fitted = fit_svm(near, side, cost * 200)
    by_landmark = np.append(half @ fitted[:-1], fitted[-1])
    return Machine(weights.astype(np.float32), constant, landmarks, by_landmark)


def fit_labelled(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    doc_id: str = "doc_id",
    text: str = "text",
    most: int = SAMPLE_DOCS,
) -> Model:
    """Fit on at most ``most`` documents of each class, chosen by hash.

    Only labels of documents with ``crc32(doc_id) mod 5`` other than 0 are used; the others are
    held out. Of texts over SAMPLE_BYTES every second, third ... sentence takes part.
    """
    known = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_label")).where(
        "_id IS NOT NULL AND _label IN (0, 1) AND crc32(cast(_id AS string)) % 5 <> 0"
    )
    texts = docs.select(F.col(doc_id).alias("_doc"), F.col(text).alias("_text")).where(F.col("_text").isNotNull())
    nth = F.ceil(F.octet_length("_text") / SAMPLE_BYTES)
    spread = F.filter(F.split("_text", f"(?<={_SENTENCE_END})"), lambda _, i: i % nth == 0)
    shown = F.when(nth <= 1, F.col("_text")).otherwise(F.array_join(spread, ""))
    # The choice is made without the texts; then only those of the chosen are read.
    place = ["_doc", F.xxhash64("_text").alias("_hash")]
    rows = texts.select(*place).join(known, F.col("_doc") == F.col("_id")).distinct()
    taken = []
    for value in (0, 1):
        chosen = (
            rows.where(F.col("_label") == value)
            .orderBy(F.xxhash64("_doc"), "_doc", "_hash")
            .limit(most)
            .select(F.col("_doc").alias("_of"), F.col("_hash").alias("_of_hash"))
        )
        found = (
            texts.withColumn("_hash", F.xxhash64("_text"))
            .join(F.broadcast(chosen), (F.col("_doc") == F.col("_of")) & (F.col("_hash") == F.col("_of_hash")))
            .select("_doc", "_hash", shown.alias("shown"))
            .dropDuplicates(["_doc", "_hash"])
            .toArrow()
        )
        taken += sorted(
            (doc, shown, value) for doc, shown in zip(found["_doc"].to_pylist(), found["shown"].to_pylist(), strict=True)
        )
    model = fit([t for _, t, _ in taken], np.array([v for _, _, v in taken], np.int64))
    # What the fit has used goes back to the system, as the driver has more to do.
    del taken, found
    _give_back()
    return model


def _give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    # Freed memory between what is kept stays with the process until it is told to return that.
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


class _Scorer:
    """Scores texts in a worker and remembers words."""

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[str, float] = {}

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        docs = [words_of(t or "") for t in texts]
        if len(self.known) > _MEMORY:
            self.known = {}
        unknown = list({w for doc in docs for w in doc} - self.known.keys())
        if unknown:
            found = self.model.decide(unknown)
            self.known.update(zip(unknown, found.tolist(), strict=True))
        value = self.known.__getitem__
        features = [pooled(list(map(value, doc)), len(doc)) for doc in docs]
        return self.model.score(np.array(features).reshape(len(docs), -1)) if docs else np.empty(0)


def _scored(model: Model, at: int):
    """Batches with their scores; ``at`` is the place of the text column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        scorer = _Scorer(model)
        for batch in batches:
            for a, b in pieces(batch.column(at)):
                part = batch.slice(a, b - a)
                yield part, scorer(part.column(at).to_pylist())

    return run


def toxicity(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``score`` (0 to 1) and ``predicted`` (score at least 0.5) of each row.

    All words of a text are scored. Null and empty texts have no words and get the score of those.
    """
    scored = _scored(model, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, score in scored(batches):
            yield pa.RecordBatch.from_arrays(
                [part.column(0).cast(pa.int64()), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                ["doc_id", "score", "predicted"],
            )

    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(
        run, "doc_id long, score double, predicted int"
    )


def drop_toxic(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text is not predicted toxic."""
    scored = _scored(model, docs.columns.index(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, score in scored(batches):
            yield part.filter(pa.array(score < 0.5))

    return docs.mapInArrow(run, docs.schema)
