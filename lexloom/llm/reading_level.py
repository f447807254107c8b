"""Reading level of documents: every sentence classified by a word and a character model, documents calibrated from their sentences."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.session import ship

BANDS = 5
#: Words, numbers, and what ends a sentence: a stop before white space, or the end of a line.
TOKEN = re.compile(r"[^\W\d_]+|\d+|[.!?;](?=\s)|\n")
ENDS = frozenset(".!?;\n")
#: Labelled documents used for fitting, at most; half of them fit the sentence models, half the calibration.
MAX_LABELLED = 1_200
#: Labelled documents longer than this are not used for fitting.
MAX_FIT_CHARS = 50_000
GRAM_BUCKETS = 1 << 15
#: Characters scored at a time; bounds a worker's memory.
BLOCK_CHARS = 2_000_000
MIN_WORD_COUNT = 3
#: Words a worker remembers the scores of; more and it starts afresh.
WORD_CACHE = 500_000

LEVELS = "doc_id bigint, n_sentences int, difficulty double, band int, " + ", ".join(f"share_{k} double" for k in range(1, BANDS + 1))


def word_grams(word: str) -> list[int]:
    """Hashed character n-grams (3 and 4) of a word with its borders."""
    framed = f"<{word}>"
    return [zlib.crc32(framed[i : i + n].encode()) % GRAM_BUCKETS for n in (3, 4) for i in range(len(framed) - n + 1)] or [zlib.crc32(framed.encode()) % GRAM_BUCKETS]


def tokens_of(text: str | None) -> list[str]:
    """Lower-case tokens; any number is ``0``; sentence ends stay as tokens."""
    return ["0" if t[0].isdigit() else t for t in TOKEN.findall(text.lower())] if text else []


def sentence_starts(is_end: np.ndarray) -> np.ndarray:
    """Starts of the sentences in a token stream without its end tokens; sentences without words are none."""
    return np.unique((np.cumsum(~is_end) - ~is_end)[np.concatenate(([True], is_end[:-1])) & ~is_end]) if len(is_end) else np.zeros(0, int)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _length_features(n_words: np.ndarray, n_letters: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(n_words)), np.log1p(n_words) - 2.5, n_letters / n_words - 5], axis=1)


@dataclass
class Grams:
    """The n-grams of each word: flat numbers, where each word's begin, and the weight of each in its word."""

    number: np.ndarray
    starts: np.ndarray
    weight: np.ndarray
    word: np.ndarray

    @classmethod
    def of(cls, words: Sequence[str]) -> Grams:
        grams = [word_grams(w) for w in words]
        sizes = np.array([len(g) for g in grams])
        return cls(np.concatenate(grams), np.cumsum([0, *sizes])[:-1], np.repeat(1 / np.sqrt(sizes), sizes), np.repeat(np.arange(len(sizes)), sizes))

    def score(self, weights: np.ndarray) -> np.ndarray:
        """The score of each word from the weights of its n-grams."""
        return np.add.reduceat(weights[self.number] * self.weight[:, None], self.starts, axis=0)

    def pull(self, gradient: np.ndarray) -> np.ndarray:
        """The gradient by n-gram from that by word."""
        return _summed(self.number, gradient[self.word] * self.weight[:, None], GRAM_BUCKETS)


def _summed(number: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(number, values[:, k], n) for k in range(values.shape[1])], axis=1)


def fit_softmax(ids: np.ndarray, scale: np.ndarray, starts: np.ndarray, dense: np.ndarray, labels: np.ndarray, n_words: int, grams: Grams | None = None, *,
                l2: float, rounds: int = 60, rate: float = 0.5) -> tuple[np.ndarray, np.ndarray]:
    """L2-regularised softmax regression over sentences as bags of words; (weights, dense weights). Full gradients with AdaGrad steps.

    The words ``ids`` of sentence i run from ``starts[i]`` to the next start and count with ``scale``. Weights are by word, or,
    with ``grams``, by n-gram: then a word scores what its n-grams add up to.
    """
    row = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(ids))))
    w, d = np.zeros((GRAM_BUCKETS if grams else n_words, BANDS)), np.zeros((dense.shape[1], BANDS))
    w_seen, d_seen = np.full_like(w, 1e-8), np.full_like(d, 1e-8)
    target = np.eye(BANDS)[labels]
    for _ in range(rounds):
        by_word = grams.score(w) if grams else w
        p = _softmax(np.add.reduceat(by_word[ids] * scale[:, None], starts, axis=0) + dense @ d)
        error = (p - target) / len(labels)
        pulled = _summed(ids, error[row] * scale[:, None], n_words)
        grad = (grams.pull(pulled) if grams else pulled) + l2 * w / len(labels)
        dense_grad = dense.T @ error + l2 * d / len(labels)
        w_seen += grad**2
        d_seen += dense_grad**2
        w -= rate * grad / np.sqrt(w_seen)
        d -= rate * dense_grad / np.sqrt(d_seen)
    return w, d


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots of the best non-decreasing fit of y on x."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []
    for a, b in zip(x[order], y[order], strict=True):
        blocks.append([b, 1.0, a, a])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            top = blocks.pop()
            n = blocks[-1][1] + top[1]
            blocks[-1] = [(blocks[-1][0] * blocks[-1][1] + top[0] * top[1]) / n, n, blocks[-1][2], top[3]]
    return np.array([(b[2] + b[3]) / 2 for b in blocks]), np.array([b[0] for b in blocks])


@dataclass
class ReadingModel:
    """The fitted models: word and gram weights, the weights of sentence and word length, and the calibration."""

    word_index: dict[str, int]
    word_weights: np.ndarray
    gram_weights: np.ndarray
    word_dense: np.ndarray
    gram_dense: np.ndarray
    coefficients: np.ndarray
    knots: tuple[np.ndarray, np.ndarray]

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    """Scores texts; remembers per word the sum of its word and character scores."""

    def __init__(self, model: ReadingModel) -> None:
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {e: 0 for e in ENDS}
        self.scores = np.zeros((1, 2 * BANDS + 1))

    def _learn(self, tokens: list[str]) -> None:
        fresh = list(set(tokens) - self.known.keys())
        if len(self.known) + len(fresh) > WORD_CACHE:
            self._forget()
            fresh = list(set(tokens) - ENDS)
        if not fresh:
            return
        m = self.model
        self.known.update(zip(fresh, range(len(self.scores), len(self.scores) + len(fresh)), strict=True))
        at = np.array([m.word_index.get(w, -1) for w in fresh])
        by_word = np.where(at[:, None] >= 0, m.word_weights[at], 0)
        by_gram = Grams.of(fresh).score(m.gram_weights)
        self.scores = np.vstack([self.scores, np.hstack([by_word, by_gram, np.array([len(w) for w in fresh])[:, None]])])

    def sentences(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(document number, distribution over the bands) of every sentence."""
        streams = []
        for text in texts:
            tokens = tokens_of(text)
            tokens.append("\n")
            streams.append(tokens)
        flat = [t for s in streams for t in s]
        self._learn(flat)
        ids = np.array([self.known[t] for t in flat], np.int64)
        is_end = ids == 0
        document = np.repeat(np.arange(len(streams)), [len(s) for s in streams])[~is_end]
        ids, starts = ids[~is_end], sentence_starts(is_end)
        if not len(starts):
            return np.zeros(0, int), np.zeros((0, BANDS))
        n = np.diff(np.append(starts, len(ids)))
        sums = np.add.reduceat(self.scores[ids], starts, axis=0)
        dense = _length_features(n, sums[:, -1])
        root = np.sqrt(n)[:, None]
        by_word = _softmax(sums[:, :BANDS] / root + dense @ self.model.word_dense)
        by_gram = _softmax(sums[:, BANDS : 2 * BANDS] / root + dense @ self.model.gram_dense)
        return document[starts], (by_word + by_gram) / 2

    def documents(self, texts: Sequence[str | None]) -> pd.DataFrame:
        """A row per text: n_sentences, raw features' calibrated difficulty, band and shares; null where there is no sentence."""
        document, p = self.sentences(texts)
        features, n = document_features(document, p, len(texts))
        some = n > 0
        raw = features @ self.model.coefficients if len(self.model.coefficients) else np.full(len(texts), np.nan)
        difficulty = np.where(some & np.isfinite(raw), np.interp(raw, *self.model.knots), np.nan)
        out = pd.DataFrame({"n_sentences": n.astype("int32"), "difficulty": difficulty})
        out["band"] = pd.array([int(np.clip(np.floor(x + 0.5), 1, BANDS)) if x == x else None for x in difficulty], "Int32")
        for k in range(BANDS):
            out[f"share_{k + 1}"] = np.where(some, features[:, 1 + k], np.nan)
        return out


def document_features(document: np.ndarray, p: np.ndarray, n_documents: int) -> tuple[np.ndarray, np.ndarray]:
    """Per document from the distributions of its sentences: their mean, the mean and spread of the expected band, and how sure they are."""
    n = np.bincount(document, minlength=n_documents)
    per = np.maximum(n, 1)
    mean = lambda v: np.bincount(document, v, n_documents) / per
    expected = p @ np.arange(1, BANDS + 1)
    sure = 1 + (p * np.log(np.maximum(p, 1e-12))).sum(axis=1) / np.log(BANDS)
    level = mean(expected)
    weighted = np.bincount(document, expected * sure, n_documents) / np.maximum(np.bincount(document, sure, n_documents), 1e-9)
    spread = np.sqrt(np.maximum(mean(expected**2) - level**2, 0))
    columns = [np.ones(n_documents), *[mean(p[:, k]) for k in range(BANDS)], level, weighted, spread, mean((expected > 3.5).astype(float)), mean((expected < 2.5).astype(float))]
    return np.stack(columns, axis=1), n


def fit(texts: Sequence[str], bands: Sequence[float], *, l2: float = 1.0, ridge: float = 1.0) -> ReadingModel:
    """Fit on labelled texts: every other one for the sentence models (a sentence takes its document's band), the rest for the calibration."""
    first = [(t, b) for i, (t, b) in enumerate(zip(texts, bands, strict=True)) if i % 2 == 0]
    second = [(t, b) for i, (t, b) in enumerate(zip(texts, bands, strict=True)) if i % 2 == 1] or first
    streams = [[*tokens_of(t), "\n"] for t, _ in first]
    flat = [t for s in streams for t in s]
    is_end = np.array([t in ENDS for t in flat], bool)
    starts = sentence_starts(is_end)
    if not len(starts):
        empty = np.zeros((3, BANDS))
        return ReadingModel({}, np.zeros((1, BANDS)), np.zeros((GRAM_BUCKETS, BANDS)), empty, empty, np.zeros(0), (np.zeros(1), np.zeros(1)))
    band = np.clip(np.round([b for _, b in first]).astype(int), 1, BANDS) - 1
    label = np.repeat(band, [len(s) for s in streams])[~is_end][starts]
    words = [t for t, end in zip(flat, is_end, strict=True) if not end]
    number: dict[str, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words])
    n = np.diff(np.append(starts, len(ids)))
    scale = np.repeat(1 / np.sqrt(n), n)
    dense = _length_features(n, np.add.reduceat(np.array([len(w) for w in words]), starts))
    frequent = np.bincount(ids) >= MIN_WORD_COUNT
    kept = np.cumsum(frequent) - 1
    word_weights, word_dense = fit_softmax(np.where(frequent[ids], kept[ids], 0), np.where(frequent[ids], scale, 0.0), starts, dense, label, max(1, int(frequent.sum())), l2=l2)
    gram_weights, gram_dense = fit_softmax(ids, scale, starts, dense, label, len(number), Grams.of(list(number)), l2=l2)
    model = ReadingModel({w: int(kept[i]) for w, i in number.items() if frequent[i]}, word_weights, gram_weights, word_dense, gram_dense, np.zeros(0), (np.zeros(1), np.zeros(1)))
    document, p = model.scorer().sentences([t for t, _ in second])
    x, _ = document_features(document, p, len(second))
    y = np.array([b for _, b in second], float)
    model.coefficients = np.linalg.solve(x.T @ x + ridge * np.diag([0.0] + [1.0] * (x.shape[1] - 1)) + 1e-9 * np.eye(x.shape[1]), x.T @ y)
    model.knots = isotonic(x @ model.coefficients, y)
    return model


def labelled_sample(documents: DataFrame, labels: DataFrame, max_documents: int = MAX_LABELLED, max_chars: int = MAX_FIT_CHARS) -> tuple[list[str], list[float]]:
    """The texts and mean bands of at most ``max_documents`` labelled documents, chosen by a hash of their id; null and impossible bands don't count."""
    bands = labels.where(F.col("band").between(1, BANDS) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.avg("band").alias("level"))
    chosen = bands.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_documents)
    rows = (
        documents.select("doc_id", "text").where(F.col("text").isNotNull() & (F.length("text") <= max_chars))
        .join(F.broadcast(chosen), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_documents).collect()
    )
    return [r["text"] for r in rows], [r["level"] for r in rows]


def reading_levels(documents: DataFrame, model: ReadingModel) -> DataFrame:
    """(doc_id, n_sentences, difficulty, band, share_1..share_5) of every document, over its whole text, in one pass without a shuffle.

    ``difficulty`` is on the annotators' scale, ``band`` its nearest band, ``share_k`` the mean probability of band k over
    the sentences. Defined cases: null, blank or wordless texts have 0 sentences and null levels; texts in languages without
    labels get a level too, as the models see them; without any usable label all levels are null.
    """
    ship(documents.sparkSession)
    held = documents.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = held.value.scorer()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            block = np.cumsum([len(t or "") for t in texts]) // BLOCK_CHARS
            starts = np.flatnonzero(np.diff(block, prepend=-1)).tolist()
            for first, last in zip(starts, [*starts[1:], len(texts)], strict=True) if texts else ():
                levels = scorer.documents(texts[first:last])
                columns = [pa.array(levels[c], from_pandas=True) for c in levels.columns]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), *columns], names=["doc_id", *levels.columns])

    return documents.select("doc_id", "text").mapInArrow(scored, LEVELS)


def profile(levels: DataFrame, documents: DataFrame) -> DataFrame:
    """Documents, mean difficulty and the share at bands 4 and 5 per source and language."""
    about = documents.select("doc_id", "source", F.coalesce(F.lower("lang"), F.lit("und")).alias("lang"))
    return levels.join(about, "doc_id").groupBy("source", "lang").agg(
        F.count("*").alias("n_documents"), F.avg("difficulty").alias("mean_difficulty"), F.avg((F.col("band") >= 4).cast("double")).alias("share_demanding")
    )


def violations(levels: DataFrame, documents: DataFrame) -> DataFrame:
    """(rule, n_violations) of what holds for all levels; all 0."""
    known = levels.join(documents.select("doc_id", "text"), "doc_id", "full")
    shares = sum((F.col(f"share_{k + 1}") for k in range(BANDS)), F.lit(0.0))
    has_level, wordless = F.col("difficulty").isNotNull(), ~F.coalesce(F.col("text").rlike(r"[\p{L}\p{N}]"), F.lit(False))
    rules = {
        "every document has a row": F.col("n_sentences").isNull(), "levels lie within the bands": has_level & ~F.col("difficulty").between(1, BANDS),
        "the band is the nearest": has_level & (F.abs(F.col("band") - F.col("difficulty")) > 0.5 + 1e-9), "shares add up": has_level & (F.abs(shares - 1) > 1e-6),
        "no level without words": wordless & (has_level | (F.col("n_sentences") > 0)), "a level wherever there are sentences": (F.col("n_sentences") > 0) & ~has_level,
    }
    counts = known.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"`{n}`").alias("n_violations")) for n in rules])).alias("r")).select("r.*")


def accuracy(levels: DataFrame, labels: DataFrame) -> DataFrame:
    """One row: labelled documents, mean absolute error, share in the annotators' band and within one of it, correlation."""
    marked = labels.where(F.col("band").between(1, BANDS)).groupBy("doc_id").agg(F.avg("band").alias("level"))
    off = F.abs(F.col("difficulty") - F.col("level"))
    return levels.join(marked, "doc_id").where(F.col("difficulty").isNotNull()).agg(
        F.count("*").alias("n_documents"), F.avg(off).alias("mean_error"),
        F.avg((F.col("band") == F.floor(F.col("level") + 0.5)).cast("double")).alias("same_band"),
        F.avg((F.abs(F.col("band") - F.col("level")) <= 1).cast("double")).alias("within_one"), F.corr("difficulty", "level").alias("correlation"),
    )
