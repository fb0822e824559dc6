"""LM scoring: a hierarchical Pitman-Yor bigram model, seated by Gibbs sampling.

Every context (the word before; a text's end stands before the next text's
first word) is a Chinese restaurant whose customers are the words that follow
it; each of its tables sends one customer to the root restaurant, the parent
that all contexts share, whose base is uniform.  Gibbs sweeps take customers
out and seat them again; the predictive probabilities of the last ``KEPT``
sweeps are averaged for the score and the perplexity.

Dishes are the end, the ``VOCABULARY`` most frequent training words, and one
dish for all other words, behind which a smoothed unigram model over all those
words tells them apart (it knows every training word, and leaves room for
unknown ones), so the model is a distribution over all texts.  That bound on
dishes bounds what is broadcast (a number per dish and sweep) and what a
restaurant holds, however large the corpus; counts are of the whole corpus.

Work is dealt so that no frequent word or pair makes a hot task: pairs are
dealt by the hash of both words, in sorted blocks of a batch each, a document's
repeats counted.  A pair seen once has one table for certain; only the others
have a seating, kept in a written table with a row per restaurant.  A sweep
reseats all customers, dish by dish; its work goes by the tables, not by the
customers, whose waiting times till a table opens are drawn at once.  The root
is held while the restaurants are swept, then swept itself.

Defined cases: a null or empty text is its end token alone.  Rows without
doc_id aren't learned from and count as held out.  Repeated rows are learned
from and scored each.  With no training text, c and N are zero, V is zero, and
every word is the one unknown word.  Other columns are never read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adledger.llm.common import slices
from adledger.session import stage_table

# Words that are dishes of their own; of every so many documents one is held out.
VOCABULARY, FOLDS = 65_000, 10
# Discount and strength of the root and of the contexts; sweeps, the last of which are averaged.
ROOT, CONTEXT = (0.5, 1.0), (0.75, 1.0)
SWEEPS, KEPT = 3, 2
END, RARE, FIRST = 0, 1, 2
SEED = 7
BATCH_BYTES = 8 << 20
# Distinct (document, pair) entries that a bucket holds, about.
BUCKET_ENTRIES = 3_000_000
SMOOTHING = 0.1


class Batch:
    """Texts as numbers of their distinct words: A-Z lower-cased, between ASCII white space."""

    def __init__(self, texts: pa.Array) -> None:
        texts = pc.fill_null(texts.cast(pa.string()), "")
        said = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        doc, words = pc.list_parent_indices(said), pc.list_flatten(said)
        is_word = pc.greater(pc.binary_length(words), 0)  # white space at an end leaves an empty piece
        self.doc = doc.filter(is_word).to_numpy().astype(np.int64)
        coded = words.filter(is_word).dictionary_encode()
        self.sizes = np.bincount(self.doc, minlength=len(texts))
        self.codes, self.dictionary = coded.indices.to_numpy(), coded.dictionary.cast(pa.binary())

    @cached_property
    def words(self) -> list[bytes]:
        return self.dictionary.to_pylist()

    def pairs(self, dishes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pair, text, count) of the distinct ones; a pair is context << 32 | word; ``dishes`` by word."""
        n = len(self.sizes)
        at = np.arange(len(self.codes)) + self.doc + 1  # an end before each text
        seq = np.full(len(self.codes) + n + 1, END, np.uint64)
        seq[at] = dishes[self.codes]
        bits, low = int(seq.max()).bit_length(), n.bit_length()
        assert 2 * bits + low <= 64, "the numbers of dishes and texts of a batch fit one sort key"
        bits, low = np.uint64(bits), np.uint64(low)
        key = (seq[:-1] << bits | seq[1:]) << low
        key |= np.repeat(np.arange(n, dtype=np.uint64), self.sizes + 1)
        key, times = np.unique(key, return_counts=True)
        doc = (key & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
        key >>= low
        return key >> bits << np.uint64(32) | key & ((np.uint64(1) << bits) - np.uint64(1)), doc, times


def _bucket(pair: np.ndarray, buckets: int) -> np.ndarray:
    h = (pair ^ pair >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return ((h >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


@dataclass
class Words:
    """What tasks know of the training words: frequent ones by dish, and the totals."""

    dish: dict[bytes, int]
    counts: np.ndarray  # by dish; RARE has the sum of the others
    total: int
    distinct: int
    rare_distinct: int

    def base(self, c: np.ndarray) -> np.ndarray:
        """log10 of the smoothed unigram probability of words with these counts."""
        return np.log10((c + SMOOTHING) / (self.total + SMOOTHING * (self.distinct + 1)))

    def inside_rare(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + SMOOTHING) / (self.counts[RARE] + SMOOTHING * (self.rare_distinct + 1)))


def _count_words(train: DataFrame) -> DataFrame:
    """(word, n) of all training tokens; the end is the empty word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", BATCH_BYTES):
            b = Batch(part.column("text"))
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([b.dictionary, pa.array([b""], pa.binary())]),
                 pa.array(np.append(np.bincount(b.codes, minlength=len(b.dictionary)), part.num_rows))], ["word", "n"])

    return train.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _dishes(words: DataFrame, vocabulary: int) -> Words:
    top = words.filter(F.octet_length("word") > 0).orderBy(F.desc("n"), "word").limit(vocabulary).collect()
    all_ = words.agg(F.sum("n").alias("n"), F.count("*").alias("v"),
                     F.sum(F.when(F.octet_length("word") == 0, F.col("n"))).alias("end")).first()
    counts = np.zeros(FIRST + len(top), np.int64)
    counts[END] = all_["end"] or 0
    counts[FIRST:] = [r["n"] for r in top]
    counts[RARE] = (all_["n"] or 0) - counts.sum()
    return Words({bytes(r["word"]): FIRST + i for i, r in enumerate(top)}, counts, all_["n"] or 0, all_["v"],
                 all_["v"] - len(top) - bool(all_["end"]))


def _split(key: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, positions in order) for each bucket that has some."""
    order = np.argsort(key, kind="stable")
    edge = np.searchsorted(key[order], np.arange(parts + 1))
    for k in range(parts):
        if edge[k] < edge[k + 1]:
            yield k, order[edge[k]:edge[k + 1]]


def _raw(x: np.ndarray, kind: str) -> bytes:
    return x.astype(kind).tobytes()


def _packed_pairs(pair: np.ndarray) -> bytes:
    """Sorted pairs as the bytes of contexts, then of words: planes that compress well."""
    return _raw(pair >> np.uint64(32), "<u4") + _raw(pair & np.uint64(0xFFFFFFFF), "<u4")


def _pairs_of(raw: bytes) -> np.ndarray:
    x = np.frombuffer(raw, "<u4").astype(np.uint64)
    return x[:len(x) // 2] << np.uint64(32) | x[len(x) // 2:]


def _count_pairs(train: DataFrame, shared, buckets: int) -> DataFrame:
    """For each bucket: its pairs seen once (``ones``) and the others with their counts (``more``, ``n``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", BATCH_BYTES):
            b = Batch(part.column("text"))
            get = shared.value.dish.get
            pair, _, n = b.pairs(np.array([get(w, RARE) for w in b.words], np.uint64))
            first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
            n, pair = np.add.reduceat(n, first), pair[first]
            for k, at in _split(_bucket(pair, buckets), buckets):
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([_packed_pairs(pair[at])], pa.binary()),
                                                  pa.array([_raw(n[at], "<u4")], pa.binary())], ["bucket", "pairs", "n"])

    def add(_: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(b["bucket"][i].as_py(), b["pairs"][i].as_py(), b["n"][i].as_py()) for b in batches
                for i in range(b.num_rows)]
        pair = np.concatenate([_pairs_of(p) for _, p, _ in rows])
        n = np.concatenate([np.frombuffer(x, "<u4") for _, _, x in rows]).astype(np.int64)
        order = np.argsort(pair, kind="stable")
        pair, n = pair[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
        n, pair = np.add.reduceat(n, first), pair[first]
        yield pa.RecordBatch.from_arrays(
            [pa.array([rows[0][0]]), pa.array([_packed_pairs(pair[n == 1])], pa.binary()),
             pa.array([_packed_pairs(pair[n > 1])], pa.binary()), pa.array([_raw(n[n > 1], "<i8")], pa.binary())],
            ["bucket", "ones", "more", "n"])

    blocks = train.mapInArrow(run, "bucket long, pairs binary, n binary")
    return blocks.groupBy("bucket").applyInArrow(add, "bucket long, ones binary, more binary, n binary")


def _runs(n: int, p0: float, tables: int, law: tuple[float, float], draws: Iterator[float],
          runs: tuple[int, ...] | list[int] = ()) -> list[int]:
    """A proposal for the seating of ``n`` customers of one dish, the first of them as in ``runs``, if any.

    A run is the customers from one that opens a table to the one before the next that does, so there are as many as
    tables.  A table opened after j customers makes the joining of all later ones less likely, by (j / n) ** discount
    in all, so tables open at about that rate; the waiting time to the next has a closed form.  ``tables`` are of
    other dishes.
    """
    d, theta = law
    out = list(runs) or [1]
    j = sum(out)
    while j < n:
        new = (theta + d * (tables + len(out))) * p0
        at = (j / n) ** d - math.log(1 - next(draws)) * d / new
        if at >= 1:
            out[-1] += n - j
            break
        i = min(n - 1, max(j, math.ceil(n * at ** (1 / d)) - 1))
        out[-1] += i - j
        out.append(1)
        j = i + 1
    return out


def _weight(runs: list[int], p0: float, tables: int, law: tuple[float, float]) -> float:
    """The logarithm of the seating's probability over that of its proposal, up to a constant."""
    d, theta = law
    n, out, a = sum(runs), 0.0, 1
    for k, run in enumerate(runs, 1):
        new, b = (theta + d * (tables + k)) * p0, a + run - 1
        out += math.lgamma(b - d * k) - math.lgamma(a - d * k) + new / d * ((b / n) ** d - (a / n) ** d)
        if k < len(runs):
            out += math.log(new) - math.log(-math.expm1(-new / d * (((b + 1) / n) ** d - (b / n) ** d)))
        a = b + 1
    return out


def reseat(dishes: list[int], sizes: list[list[int]], tables: int, p0: list[float], law: tuple[float, float],
           rng: np.random.Generator) -> int:
    """A Gibbs sweep over a restaurant, in place: every customer leaves and is seated again; returns its tables.

    ``tables`` counts all tables, those of dishes that aren't listed too; ``sizes`` has the runs of each dish.  The
    customers of a dish leave together; a new seating of all is proposed and accepted by Metropolis and Hastings' rule,
    which makes it exact.  Only runs are kept: nothing depends on who sits where.
    """
    draws = _draws(rng)
    for w, s in zip(dishes, sizes, strict=True):
        n = sum(s)
        if n == 1:
            continue
        others, p = tables - len(s), p0[w]
        new = _runs(n, p, others, law, draws)
        if new != s:
            gain = _weight(new, p, others, law) - _weight(s, p, others, law)
            if gain >= 0 or next(draws) < math.exp(gain):
                s[:] = new
                tables = others + len(s)
    return tables


def _draws(rng: np.random.Generator) -> Iterator[float]:
    while True:
        yield from rng.random(256).tolist()


def seat_root(customers: np.ndarray, law: tuple[float, float], rng: np.random.Generator,
              seats: dict[int, list[int]] | None = None) -> tuple[np.ndarray, int]:
    """The root's predictive probabilities after a Gibbs sweep over all its customers; and its tables.

    ``seats``, the runs by dish, is kept between calls: customers that are gone leave from the end, those that came are
    seated after the others.
    """
    d, theta = law
    base = 1 / len(customers)
    seats, draws = {} if seats is None else seats, _draws(rng)
    for w in [w for w in seats if not customers[w]]:
        del seats[w]
    tables = sum(map(len, seats.values()))
    for w in np.flatnonzero(customers).tolist():
        n, s = int(customers[w]), seats.get(w, [])
        tables -= len(s)
        while sum(s) > n:
            s[-1] -= min(s[-1], sum(s) - n)
            if not s[-1]:
                s.pop()
        seats[w] = _runs(n, base, tables, law, draws, s)
        tables += len(seats[w])
    tables = reseat(list(seats), list(seats.values()), tables, [base] * len(customers), law, rng)
    t = np.zeros(len(customers), np.int64)
    t[list(seats)] = [len(s) for s in seats.values()]
    p = (customers - d * t + (theta + d * tables) * base) / (theta + customers.sum())
    return p, tables


@dataclass
class Model:
    """The kept sweeps: each context's share for the parent, the parent's probabilities, customers of a context."""

    back_off: np.ndarray  # KEPT x dishes: (theta + d * tables) / (theta + customers)
    root: np.ndarray  # KEPT x dishes
    customers: np.ndarray

    def probability(self, context: np.ndarray, word: np.ndarray, own: np.ndarray) -> np.ndarray:
        """The averaged predictive probability; ``own`` is the mean of customers less discounts of the pair."""
        parent = sum(b[context] * r[word] for b, r in zip(self.back_off, self.root, strict=True)) / len(self.root)
        return own / (CONTEXT[1] + self.customers[context]) + parent


def _restaurants(counted: DataFrame, shared_ones, root: np.ndarray) -> DataFrame:
    """A row for each context with pairs seen more than once: words, their tables, and the first seating."""
    def by_context(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                pair, n = _pairs_of(b["more"][i].as_py()), np.frombuffer(b["n"][i].as_py(), "<i8")
                u = (pair >> np.uint64(32)).astype(np.int64)
                first = np.flatnonzero(np.concatenate([[True], u[1:] != u[:-1]]) if len(u) else np.zeros(0, bool))
                ends = np.append(first, len(u))
                w = (pair & np.uint64(0xFFFFFFFF)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(u[first]), pa.array([_raw(w[a:z], "<u4") for a, z in zip(ends, ends[1:], strict=False)],
                                                  pa.binary()),
                     pa.array([_raw(n[a:z], "<i8") for a, z in zip(ends, ends[1:], strict=False)], pa.binary())],
                    ["u", "words", "n"])

    def seat(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ones, p0 = shared_ones.value
        rows = [(b["words"][i].as_py(), b["n"][i].as_py()) for b in batches for i in range(b.num_rows)]
        w = np.concatenate([np.frombuffer(x, "<u4") for x, _ in rows]).astype(np.int64)
        n = np.concatenate([np.frombuffer(x, "<i8") for _, x in rows])
        order = np.argsort(w)
        w, n, u = w[order], n[order], key[0].as_py()
        draws, tables, sizes = _draws(np.random.default_rng([SEED, 0, u])), int(ones[u]), []
        for dish, c in zip(w.tolist(), n.tolist(), strict=True):
            sizes.append(_runs(c, float(p0[dish]), tables, CONTEXT, draws))
            tables += len(sizes[-1])
        yield _restaurant(u, tables, w, sizes, np.zeros(len(w)))

    rows = counted.select("more", "n").mapInArrow(by_context, "u long, words binary, n binary")
    return rows.groupBy("u").applyInArrow(seat, RESTAURANT)


RESTAURANT = "u long, tables long, words binary, n_tables binary, sizes binary, own binary"


def _restaurant(u: int, tables: int, w: np.ndarray, sizes: list[list[int]], own: np.ndarray) -> pa.RecordBatch:
    k = np.array([len(s) for s in sizes])
    flat = np.array([x for s in sizes for x in s])
    return pa.RecordBatch.from_arrays(
        [pa.array([u]), pa.array([tables]), *[pa.array([_raw(x, t)], pa.binary()) for x, t in
                                              ((w, "<u4"), (k, "<u4"), (flat, "<u4"), (own, "<f8"))]],
        ["u", "tables", "words", "n_tables", "sizes", "own"])


def _swept(state: DataFrame, root: np.ndarray, sweep: int, keep: bool) -> DataFrame:
    shared = state.sparkSession.sparkContext.broadcast(root.tolist())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                w, k = np.frombuffer(r["words"], "<u4"), np.frombuffer(r["n_tables"], "<u4").astype(np.int64)
                flat, ends = np.frombuffer(r["sizes"], "<u4").tolist(), np.concatenate([[0], np.cumsum(k)]).tolist()
                sizes = [flat[a:z] for a, z in zip(ends, ends[1:], strict=False)]
                rng = np.random.default_rng([SEED, sweep, r["u"]])
                tables = reseat(w.tolist(), sizes, r["tables"], shared.value, CONTEXT, rng)
                own = np.frombuffer(r["own"], "<f8")
                if keep:
                    n, t = np.array([sum(s) for s in sizes]), np.array([len(s) for s in sizes])
                    own = own + (n - CONTEXT[0] * t) / KEPT
                yield _restaurant(r["u"], tables, w, sizes, own)

    return stage_table(state.mapInArrow(run, RESTAURANT), "restaurants")


def _sent_up(state: DataFrame, size: int) -> np.ndarray:
    """Tables by dish over all restaurants: the root's customers.  A vector of ``size`` a task is summed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = np.zeros(size, np.int64)
        for b in batches:
            for r in b.to_pylist():
                m[np.frombuffer(r["words"], "<u4")] += np.frombuffer(r["n_tables"], "<u4")
        at = np.flatnonzero(m)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(m[at])], ["w", "m"])

    return _vector(state.select("words", "n_tables").mapInArrow(run, "w long, m long"), "w", "m", size)


def _vector(rows: DataFrame, key: str, value: str, size: int) -> np.ndarray:
    """Sums by a key below ``size`` (a dish), as an array on the driver."""
    got = rows.groupBy(key).agg(F.sum(value).alias(value)).toArrow()
    out = np.zeros(size, np.int64)
    out[got[key].to_numpy()] = got[value].to_numpy()
    return out


def _ones(counted: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs seen once, by context and by word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = np.zeros(2 * size, np.int64)
        for b in batches:
            for i in range(b.num_rows):
                pair = _pairs_of(b["ones"][i].as_py())
                m[:size] += np.bincount((pair >> np.uint64(32)).astype(np.int64), minlength=size)
                m[size:] += np.bincount((pair & np.uint64(0xFFFFFFFF)).astype(np.int64), minlength=size)
        at = np.flatnonzero(m)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(m[at])], ["w", "m"])

    both = _vector(counted.select("ones").mapInArrow(run, "w long, m long"), "w", "m", 2 * size)
    return both[:size], both[size:]


def fit(counted: DataFrame, words: Words) -> tuple[Model, DataFrame]:
    """The model, and the restaurants with each listed pair's mean of customers less discounts."""
    spark, size = counted.sparkSession, len(words.counts)
    ones_u, ones_w = _ones(counted, size)
    rng, seats = np.random.default_rng([SEED]), {}
    root, _ = seat_root(ones_w + 1, ROOT, rng, seats)
    shared = spark.sparkContext.broadcast((ones_u, root))
    state = stage_table(_restaurants(counted, shared, root), "restaurants")
    back_off, roots = [], []
    for sweep in range(1, SWEEPS + 1):
        root, _ = seat_root(_sent_up(state, size) + ones_w, ROOT, rng, seats)
        keep = sweep > SWEEPS - KEPT
        state = _swept(state, root, sweep, keep)
        if keep:
            tables = ones_u + _vector(state.select("u", (F.col("tables")).alias("t")), "u", "t", size)
            # Listed restaurants count their pairs seen once among their tables already.
            listed = _vector(state.select("u", F.lit(1).cast("long").alias("t")), "u", "t", size)
            tables -= ones_u * listed
            back_off.append((CONTEXT[1] + CONTEXT[0] * tables) / (CONTEXT[1] + words.counts))
            roots.append(seat_root(_sent_up(state, size) + ones_w, ROOT, rng, seats)[0])
    return Model(np.array(back_off), np.array(roots), words.counts), state


def _own_by_bucket(state: DataFrame, buckets: int) -> DataFrame:
    """The listed pairs with their ``own`` values, dealt as documents' pairs are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.to_pylist()
            if not rows:
                continue
            pair = np.concatenate([np.uint64(r["u"]) << np.uint64(32) | np.frombuffer(r["words"], "<u4").astype(np.uint64)
                                   for r in rows])
            own = np.concatenate([np.frombuffer(r["own"], "<f8") for r in rows])
            for k, at in _split(_bucket(pair, buckets), buckets):
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([_packed_pairs(pair[at])], pa.binary()),
                                                  pa.array([_raw(own[at], "<f8")], pa.binary())],
                                                 ["bucket", "pairs", "own"])

    return state.select("u", "words", "own").mapInArrow(run, "bucket long, pairs binary, own binary")


ASKED = ("bucket long, batch long, pairs binary, pair_docs binary, pair_n binary, words binary, word_docs binary, "
         "said binary, ids array<{kind}>, own binary")
PARTS = "batch long, ids array<{kind}>, own binary, docs binary, score binary, rare_docs binary, rare binary"


def _asked(rows: DataFrame, shared, buckets: int, kind: str) -> DataFrame:
    """A row for each batch of texts and bucket: the pairs, and the words that are no dishes, to be looked up there.

    One of them also carries the batch's ids and what the task knows by itself: tokens, known ones, base score
    of dishes, and the number of other words.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for part in slices(batches, "text", BATCH_BYTES):
            b, w = Batch(part.column("text")), shared.value
            dish = np.array([w.dish.get(x, -1) for x in b.words], np.int64)
            n = len(b.sizes)
            per_text = lambda x: np.bincount(b.doc, x[b.codes] if len(b.codes) else None, n)
            own = np.concatenate([
                b.sizes + 1.0, per_text((dish >= 0).astype(float)) + float(w.counts[END] > 0),
                per_text(np.where(dish >= 0, w.base(w.counts[np.maximum(dish, 0)]), 0.0)) + w.base(w.counts[END]),
                per_text((dish < 0).astype(float))])
            pair, doc, times = b.pairs(np.where(dish < 0, RARE, dish).astype(np.uint64))
            pairs = dict(_split(_bucket(pair, buckets), buckets))
            at = np.flatnonzero(dish[b.codes] < 0) if len(b.codes) else np.zeros(0, np.int64)
            key = np.array([zlib.crc32(x) % buckets if d < 0 else 0 for x, d in zip(b.words, dish, strict=True)], np.int64)
            words = dict(_split(key[b.codes[at]], buckets)) if len(at) else {}
            for k in sorted({*pairs, *words, number % buckets}):
                row = {"bucket": k, "batch": number}
                if k in pairs:
                    x = pairs[k]
                    row |= {"pairs": _packed_pairs(pair[x]), "pair_docs": _raw(doc[x], "<u4"), "pair_n": _raw(times[x], "<u4")}
                if k in words:
                    x = at[words[k]]
                    said, where = np.unique(b.codes[x], return_inverse=True)
                    row |= {"words": b"\n".join([b.words[i] for i in said.tolist()]), "word_docs": _raw(b.doc[x], "<u4"),
                            "said": _raw(where, "<u4")}
                if k == number % buckets:
                    row |= {"own": _raw(own, "<f8")}
                ids = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), part.column("doc_id")) if "own" in row \
                    else pa.nulls(1, pa.list_(part.column("doc_id").type))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["bucket"]]), pa.array([row["batch"]]),
                     *[pa.array([row.get(c)], pa.binary()) for c in (
                         "pairs", "pair_docs", "pair_n", "words", "word_docs", "said")],
                     ids, pa.array([row.get("own")], pa.binary())],
                    ["bucket", "batch", "pairs", "pair_docs", "pair_n", "words", "word_docs", "said", "ids", "own"])
            number += 1

    return rows.mapInArrow(run, ASKED.format(kind=kind))


def _answered(known: DataFrame, asked: DataFrame, shared, model, kind: str) -> DataFrame:
    """For each batch and bucket, the texts' sums: log probabilities of the pairs, and base scores of rare words."""
    def answer(_: tuple, given: pa.Table, asked: pa.Table) -> pa.Table:
        pairs, own, count = [np.zeros(0, np.uint64)], [np.zeros(0)], {}
        if asked.num_rows:
            for b in given.to_batches():
                count.update((w, n) for w, n in zip(b["word"].to_pylist(), b["n"].to_pylist(), strict=True) if w is not None)
                for p, o in zip(b["pairs"].to_pylist(), b["own"].to_pylist(), strict=True):
                    if p is not None:
                        pairs.append(_pairs_of(p))
                        own.append(np.full(len(pairs[-1]), 1 - CONTEXT[0]) if o is None else np.frombuffer(o, "<f8"))
        pairs, own = np.concatenate(pairs), np.concatenate(own)
        order = np.argsort(pairs)
        pairs, own = np.append(pairs[order], np.uint64(0xFFFFFFFFFFFFFFFF)), np.append(own[order], 0.0)
        out: dict[str, list] = {c: [] for c in ("docs", "score", "rare_docs", "rare")}
        for i in range(asked.num_rows):
            r = {c: asked[c][i].as_py() for c in ("pairs", "pair_docs", "pair_n", "words", "word_docs", "said")}
            row = dict.fromkeys(out)
            if r["pairs"] is not None:
                want = _pairs_of(r["pairs"])
                at = np.searchsorted(pairs, want)
                mine = np.where(pairs[at] == want, own[at], 0.0)
                p = np.log10(model.value.probability((want >> np.uint64(32)).astype(np.int64),
                                                     (want & np.uint64(0xFFFFFFFF)).astype(np.int64), mine))
                docs, local = np.unique(np.frombuffer(r["pair_docs"], "<u4"), return_inverse=True)
                row |= {"docs": _raw(docs, "<u4"),
                        "score": _raw(np.bincount(local, p * np.frombuffer(r["pair_n"], "<u4")), "<f8")}
            if r["words"] is not None:
                c = np.array([count.get(w, 0) for w in r["words"].split(b"\n")], np.int64)[np.frombuffer(r["said"], "<u4")]
                docs, local = np.unique(np.frombuffer(r["word_docs"], "<u4"), return_inverse=True)
                row |= {"rare_docs": _raw(docs, "<u4"),
                        "rare": _raw(np.concatenate([np.bincount(local, shared.value.base(c)), np.bincount(local, c > 0)]),
                                     "<f8")}
            for c in out:
                out[c].append(row[c])
        return pa.table({"batch": asked["batch"], "ids": asked["ids"], "own": asked["own"],
                         **{c: pa.array(x, pa.binary()) for c, x in out.items()}})

    return known.groupBy("bucket").cogroup(asked.groupBy("bucket")).applyInArrow(answer, PARTS.format(kind=kind))


def _added(parts: DataFrame, shared, kind: str) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of each text: the parts of its batch, added."""
    def add(_: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, score, rare = None, [], []
        for b in batches:
            for i in range(b.num_rows):
                if b["own"][i].is_valid:
                    ids, own = b["ids"][i].values, np.frombuffer(b["own"][i].as_py(), "<f8").reshape(4, -1)
                if b["docs"][i].is_valid:
                    score.append((np.frombuffer(b["docs"][i].as_py(), "<u4"), np.frombuffer(b["score"][i].as_py(), "<f8")))
                if b["rare_docs"][i].is_valid:
                    rare.append((np.frombuffer(b["rare_docs"][i].as_py(), "<u4"),
                                 np.frombuffer(b["rare"][i].as_py(), "<f8").reshape(2, -1)))
        n_tokens, known, base, n_rare = own.copy()
        total = np.zeros(len(n_tokens))
        for docs, x in score:
            total[docs] += x
        inside = np.zeros(len(n_tokens))
        for docs, (x, k) in rare:
            inside[docs] += x
            known[docs] += k
        # A rare word's probability among the rare ones is its base probability, but for the constant denominator.
        w = shared.value
        total += inside + n_rare * (w.inside_rare(np.array(0)) - w.base(np.array(0)))
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(n_tokens.astype(np.int64)), pa.array(np.rint(known).astype(np.int64)),
             pa.array(base + inside), pa.array(total)], ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    return parts.groupBy("batch").applyInArrow(
        add, f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double")


def score(docs: DataFrame, vocabulary: int = VOCABULARY, folds: int = FOLDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and perplexity of every document."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    is_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == 0, F.lit(True))
    train = docs.filter(~is_out).select("text")
    counts = stage_table(_count_words(train), "words")
    words = _dishes(counts, vocabulary)
    shared = spark.sparkContext.broadcast(words)
    buckets = 1 + words.total // BUCKET_ENTRIES
    counted = stage_table(_count_pairs(train, shared, buckets), "pairs")
    model, state = fit(counted, words)
    rare = counts.filter(F.octet_length("word") > 0).select((F.crc32("word") % buckets).alias("bucket"), "word", "n")
    known = (counted.select("bucket", F.col("ones").alias("pairs"))
             .unionByName(_own_by_bucket(state, buckets), allowMissingColumns=True)
             .unionByName(rare, allowMissingColumns=True))
    asked = _asked(docs.select("doc_id", "text"), shared, buckets, kind)
    parts = _answered(known, asked, shared, spark.sparkContext.broadcast(model), kind)
    out = _added(parts, shared, kind)
    return out.select("doc_id", is_out.alias("held_out"), "n_tokens", "n_known",
                      F.lit(words.total).cast("long").alias("train_tokens"), "base_score", "score",
                      F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))


def digest(docs: DataFrame) -> DataFrame:
    return score(docs.select("doc_id", "text"))
