"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Words (runs of letters, lower-cased, with marked ends) give n-grams of one to
four characters, hashed to ``FEATURES`` features.  A text's vector holds each
feature's share of all its n-grams times the feature's inverse document
frequency, which is counted over all training texts.  Weights are learned by
follow-the-regularised-leader with elastic-net penalties (the L1 part keeps
them sparse) from a sample of the labelled documents, drawn by the hash of id
and text.  Each language's quota is its share of ``SAMPLE`` among the labelled
texts, but ``LEAST`` at least, or all its texts where it has fewer; its text of
the least hash is always drawn, so no language is without an example.  A fifth
of each language's sample is kept back to fit the temperature that calibrates
the scores, none of the first four.  Only the classifier is fitted on
a sample: document frequencies and predictions cover every document whole.

The driver gets the sample's sparse vectors (each at most ``FEATURES`` long)
and the document frequencies (``FEATURES`` numbers); tasks get the weights
(languages x ``FEATURES``).  All three are bounded whatever the data.  A text's
logits are sums over its words, so a task works out each distinct word of a
batch once.

Defined cases: a null text, or one without a letter, is ``und`` with score 0.
Rows without lang are not learned from, nor are rows without doc_id, which
count as held out.  Repeated rows are learned from as often as they occur.  With no
labelled row every text is ``und``; a labelled text without a letter is no
example, and a language with only such texts is never predicted.  Equal scores go to the first language in
order.  Other columns are kept or ignored, never read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adledger.llm.common import as_row, slices, with_row

# Hashed features, longest n-gram, and the languages that a table may hold.
FEATURES, LONGEST, LANGUAGES = 1 << 16, 4, 500
# Labelled documents that the classifier is fitted on, shared out by language, and those of a language at least
# (about: each is drawn on its own).
SAMPLE, LEAST = 2000, 40
# Of every so many documents one is held out; of the sample one is for calibration.
FOLDS, CALIBRATION = 5, 5
# Follow-the-regularised-leader: step, its offset, L1, L2, passes.
ALPHA, BETA, L1, L2, PASSES = 1.0, 1.0, 0.002, 0.001, 4
# Brings the vectors to a length of about one.
SCALE = 8.0
UNKNOWN = "und"
# Ranks that the hash of a labelled text has.
RANKS = 1 << 30
# Text of a batch, and numbers that a stretch of its distinct words makes at once.
BATCH_BYTES, HELD = 2 << 20, 1 << 20
_find_words = re.compile(r"[^\W\d_]+").findall
# Distinct words whose n-grams are hashed at once.
_WORDS = 1 << 13
_MULT = np.uint64(0x9E3779B97F4A7C15)


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all words in a row, and the offsets of each word; none for a word without a letter."""
    marked = [f"\x02{w}\x03" if any(map(str.isalpha, w)) else "" for w in words]
    chars = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.array([len(m) for m in marked], np.int64)
    end = np.repeat(np.cumsum(size), size)
    at, owner, feats = np.arange(len(chars)), np.repeat(np.arange(len(words)), size), []
    h = np.zeros(len(chars), np.uint64)
    for n in range(1, LONGEST + 1):
        inside = at + n <= end
        at, owner, end, h = at[inside], owner[inside], end[inside], h[inside]
        h = (h + chars[at + n - 1] + np.uint64(n)) * _MULT
        h ^= h >> np.uint64(31)
        feats.append((owner, (h >> np.uint64(48)).astype(np.int32) if FEATURES == 1 << 16
                      else (h % np.uint64(FEATURES)).astype(np.int32)))
    owner = np.concatenate([o for o, _ in feats])
    order = np.argsort(owner, kind="stable")
    offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(words)))])
    return np.concatenate([f for _, f in feats])[order], offsets


class Batch:
    """The texts of a batch as numbers of its distinct words, with each word's features."""

    def __init__(self, texts: list[str | None]) -> None:
        words = [_find_words(t.lower()) if t else [] for t in texts]
        self.sizes = np.array([len(w) for w in words], np.int64)
        coded = pa.array([x for w in words for x in w], pa.string()).dictionary_encode()
        self.codes = coded.indices.to_numpy().astype(np.int64)
        number = coded.dictionary.to_pylist()
        parts = [word_features(number[i:i + _WORDS]) for i in range(0, len(number), _WORDS)]
        self.feats = np.concatenate([np.empty(0, np.int32), *[f for f, _ in parts]])
        self.offsets = np.concatenate([[0], np.cumsum(np.concatenate([[0], *[np.diff(o) for _, o in parts]]))[1:]])
        self.ends = np.concatenate([[0], np.cumsum(self.sizes)])

    def summed(self, per_word: np.ndarray) -> np.ndarray:
        """For each text, the sum over its words of a row each."""
        got = np.concatenate([per_word[self.codes], np.zeros((1, per_word.shape[1]), per_word.dtype)])
        out = np.add.reduceat(got, self.ends[:-1], axis=0) if len(self.sizes) else got[:0]
        out[self.sizes == 0] = 0
        return out

    def counts(self, i: int) -> np.ndarray:
        """How often each feature is in text ``i``."""
        codes, times = np.unique(self.codes[self.ends[i]:self.ends[i + 1]], return_counts=True)
        n = self.offsets[codes + 1] - self.offsets[codes]
        if not n.sum():
            return np.zeros(FEATURES, np.int64)
        at = np.arange(n.sum()) + np.repeat(self.offsets[codes] - np.cumsum(n) + n, n)
        return np.bincount(self.feats[at], np.repeat(times, n), FEATURES).astype(np.int64)

    def present(self, i: int, mark: np.ndarray) -> None:
        """Set in ``mark`` the features of text ``i``."""
        codes = np.unique(self.codes[self.ends[i]:self.ends[i + 1]])
        n = self.offsets[codes + 1] - self.offsets[codes]
        at = np.arange(n.sum()) + np.repeat(self.offsets[codes] - np.cumsum(n) + n, n)
        mark[self.feats[at]] = True


@dataclass
class Model:
    """Languages, idf-weighted weights (languages x features), biases and the temperature."""

    langs: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        b = Batch(texts)
        size = np.diff(b.offsets)
        total = b.summed(size[:, None].astype(np.float64))[:, 0]
        if not self.langs:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        per_word = np.zeros((len(size), len(self.langs)))
        # Whole words, a bounded number of features at once.
        cuts = np.searchsorted(b.offsets, np.arange(0, len(b.feats), max(1, HELD // len(self.langs))))
        for i, j in pairwise([*np.unique(cuts).tolist(), len(size)]):
            rows = np.concatenate([self.weights[:, b.feats[b.offsets[i]:b.offsets[j]]].T,
                                   np.zeros((1, len(self.langs)))])
            per_word[i:j] = np.add.reduceat(rows, b.offsets[i:j] - b.offsets[i], axis=0)
        per_word[size == 0] = 0
        logits = b.summed(per_word) / np.maximum(total, 1)[:, None] + self.bias
        p = _softmax(logits / self.temperature)
        best = p.argmax(axis=1)
        return ([self.langs[k] if n else UNKNOWN for k, n in zip(best, total, strict=True)],
                [float(x) if n else 0.0 for x, n in zip(p[np.arange(len(p)), best], total, strict=True)])


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(vectors: list[tuple[int, np.ndarray, np.ndarray]], classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and biases by FTRL-proximal over (class, features, values), ``PASSES`` times in order."""
    z, n = np.zeros((classes, FEATURES + 1)), np.zeros((classes, FEATURES + 1))

    def weights(at) -> np.ndarray:
        zi = z[:, at]
        step = -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[:, at])) / ALPHA + L2)
        return np.where(np.abs(zi) <= L1, 0.0, step)

    for _ in range(PASSES):
        for label, feats, values in vectors:
            at, x = np.append(feats, FEATURES), np.append(values, 1.0)
            w = weights(at)
            p = _softmax(w @ x)
            p[label] -= 1
            g = p[:, None] * x
            n_at = n[:, at]
            z[:, at] += g - (np.sqrt(n_at + g * g) - np.sqrt(n_at)) / ALPHA * w
            n[:, at] = n_at + g * g
    w = weights(slice(None))
    return w[:, :-1], w[:, -1]


def _temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least cross-entropy on held-back documents, by golden section on its logarithm.

    A hundredth of each label is spread over all languages, or a sample without errors would ask for none.
    """
    def loss(t: float) -> float:
        log_p = np.log(_softmax(logits / np.exp(t)) + 1e-12)
        return -float(0.99 * log_p[np.arange(len(labels)), labels].mean() + 0.01 * log_p.mean())

    low, high, g = np.log(0.02), np.log(20.0), (5 ** 0.5 - 1) / 2
    for _ in range(60):
        a, b = high - g * (high - low), low + g * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def held_out(folds: int = FOLDS):
    """True where the document is not learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == 0, F.lit(True))


def _document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """Number of texts, and of those that hold each feature: summed in each task, then over tasks."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, df = 0, np.zeros(FEATURES, np.int64)
        for part in slices(batches, "text", BATCH_BYTES):
            b = Batch(part.column("text").to_pylist())
            docs += len(b.sizes)
            mark = np.zeros(FEATURES, bool)
            for i in range(len(b.sizes)):
                mark[:] = False
                b.present(i, mark)
                df += mark
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(df[at], docs))],
                                         ["feature", "n"])

    rows = texts.mapInArrow(count, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    got = rows.toPandas()
    df = np.zeros(FEATURES, np.int64)
    is_total = got["feature"].to_numpy() == -1
    df[got["feature"].to_numpy()[~is_total]] = got["n"].to_numpy()[~is_total]
    return int(got["n"].to_numpy()[is_total].sum()), df


def _sample_vectors(rows: DataFrame) -> list:
    """(lang, features, counts, text's number of features) of the sampled rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", BATCH_BYTES):
            b = Batch(part.column("text").to_pylist())
            feats, counts = [], []
            for i in range(len(b.sizes)):
                c = b.counts(i)
                at = np.flatnonzero(c)
                feats.append(at.astype(np.int32))
                counts.append(c[at])
            yield pa.RecordBatch.from_arrays(
                [part.column("lang"), part.column("key"), pa.array(feats, pa.list_(pa.int32())),
                 pa.array(counts, pa.list_(pa.int64()))], ["lang", "key", "feats", "counts"])

    src = rows.select(F.col("lang").cast("string").alias("lang"), "key", F.col("text").alias("text"))
    got = src.mapInArrow(run, "lang string, key long, feats array<int>, counts array<long>").toArrow()
    return sorted(((r["key"], r["lang"], np.array(r["feats"], np.int64), np.array(r["counts"], np.float64))
                   for b in got.to_batches() for i in range(b.num_rows) for r in [b.slice(i, 1).to_pylist()[0]]),
                  key=lambda r: (r[0], r[1]))


def _quotas(labelled: dict[str, int], sample: int) -> dict[str, int]:
    """For each language the rank below which its texts are drawn, by the number of its labelled texts."""
    total = sum(labelled.values())
    return {lang: min(RANKS, RANKS * max(LEAST * total, sample * n) // (total * n)) for lang, n in labelled.items()}


def fit(docs: DataFrame, sample: int = SAMPLE, folds: int = FOLDS) -> Model:
    """The model learned from text and lang of the documents that are not held out."""
    learned = docs.filter(~held_out(folds))
    labelled = (learned.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
                .withColumn("key", F.xxhash64(F.col("doc_id").cast("string"), "text")))
    # Each labelled document is drawn on its own by its hash; no group is sorted for it.
    rank = F.pmod(F.col("key"), F.lit(RANKS))
    of_lang = (labelled.groupBy(F.col("lang").cast("string").alias("lang"))
               .agg(F.count("*").alias("n"), F.min(rank).alias("first")).sort("lang").limit(LANGUAGES + 1).collect())
    langs = [r["lang"] for r in of_lang]
    if len(langs) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    if not langs:
        return Model([], np.zeros((0, FEATURES)), np.zeros(0), 1.0)
    total, df = _document_frequencies(learned.filter(F.col("text").isNotNull()).select("text"))
    idf = np.log((1 + total) / (1 + df)) + 1
    below = _quotas({r["lang"]: r["n"] for r in of_lang}, sample)
    drawn = labelled.filter(F.create_map(*[F.lit(x) for r in of_lang for x in (
        r["lang"], max(below[r["lang"]], r["first"] + 1))])[F.col("lang").cast("string")] > rank)
    rows = [(k, langs.index(lang), f, c / c.sum() * idf[f] * SCALE)
            for k, lang, f, c in _sample_vectors(drawn) if len(f)]
    fitted, kept, seen = [], [], Counter()
    for _, label, f, v in rows:
        seen[label] += 1
        (fitted if seen[label] % CALIBRATION else kept).append((label, f, v))
    w, bias = train(fitted, len(langs))
    temperature = 1.0
    if kept:
        logits = np.array([w[:, f] @ v + bias for _, f, v in kept])
        temperature = _temperature(logits, np.array([k for k, _, _ in kept]))
    return Model(langs, (w * idf * SCALE).astype(np.float32), bias, temperature)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``row`` (the input row), ``lang_pred`` and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, at, BATCH_BYTES):
            langs, scores = shared.value.predict(b.column("row").field(at).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(langs, pa.string()),
                                              pa.array(scores, pa.float64())], ["row", "lang_pred", "score"])

    src, at = as_row(docs, "text")
    return src.mapInArrow(run, with_row(src.schema, ("lang_pred", T.StringType()), ("score", T.DoubleType())))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document; lang, source and doc_id are no inputs of a prediction."""
    out = predict(docs.select("doc_id", "text"), fit(docs.select("doc_id", "text", "lang")))
    return out.select("row.doc_id", "lang_pred", "score").select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score")
