"""Benchmark decontamination: find benchmark windows in documents, remove the spans or the documents.

Texts are cut into words (A-Z lower-cased).  A window is ``n`` consecutive
words of a benchmark item; an item of fewer words, but not none, is one window
of its own length.  Every occurrence of a window in a document is found, and
each word inside any occurrence is hit.

The windows are collected into a broadcast hash set.  How many there are is
counted first: blocks of at most ``BLOCK_WINDOWS`` windows are broadcast one
after the other, each scanned against all documents, so that what a task holds
is bounded however large the benchmark grows; the hits of the blocks are
united per document.  With one block (every benchmark up to that size) nothing
is shuffled.  In a task, words are coded by the block's own vocabulary, a
rolling hash over the codes picks candidate positions, and each candidate is
verified word by word.

Defined cases: a null text has no words; an item without words has no window.
Items that repeat an item_id count once; rows without item_id hit words but
are no item.  An empty benchmark contaminates nothing.  Other columns of
either input are kept or ignored, never read.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adledger.llm.common import WORD_BYTES, slices, with_row, words_of
from adledger.session import stage_table

# Production parameter: words of a window.
WINDOW = 10
# Bound of the broadcast: windows in one block (about 100 bytes each).
BLOCK_WINDOWS = 1_000_000
BATCH_BYTES = 4 << 20
_MULT = np.uint64(0x9E3779B97F4A7C15)


def windows(benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """(item_id as string, window as space-joined words), each pair once."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, out = [], []
            for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                w = words_of(text)
                for i in range(max(1, len(w) - n + 1) if w else 0):
                    ids.append(item)
                    out.append(b" ".join(w[i:i + n]))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(out, pa.binary())],
                                             ["item", "window"])

    src = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").alias("text"))
    return src.mapInArrow(cut, "item string, window binary").distinct()


class Matcher:
    """A block's windows, by length; finds their occurrences in a list of words."""

    def __init__(self, rows: list[tuple[str | None, bytes]]) -> None:
        self.code: dict[bytes, int] = {}
        self.items: dict[tuple[int, ...], list[str | None]] = defaultdict(list)
        for item, window in rows:
            key = tuple(self.code.setdefault(w, len(self.code) + 1) for w in window.split(b" "))
            self.items[key].append(item)
        by_length: dict[int, list[tuple[int, ...]]] = defaultdict(list)
        for key in self.items:
            by_length[len(key)].append(key)
        self.hashes = {n: np.unique(self._rolled(np.array(keys, np.uint64).reshape(-1, n)))
                       for n, keys in by_length.items()}

    @staticmethod
    def _rolled(cols: np.ndarray) -> np.ndarray:
        h = np.zeros(len(cols), np.uint64)
        for j in range(cols.shape[1]):
            h = (h + cols[:, j]) * _MULT
            h ^= h >> np.uint64(29)
        return h

    def find(self, words: list[bytes]) -> list[tuple[int, int, list[str | None]]]:
        """(start, length, items) of every occurrence."""
        get = self.code.get
        return self.find_codes(np.array([get(w, 0) for w in words], np.uint64))

    def find_codes(self, codes: np.ndarray) -> list[tuple[int, int, list[str | None]]]:
        found = []
        known = codes != 0
        if not known.any():
            return found
        run = np.concatenate([[0], np.cumsum(known)])
        for n, hashes in self.hashes.items():
            if len(codes) < n:
                continue
            starts = np.flatnonzero(run[n:] - run[:-n] == n)  # only words of the benchmark
            if not len(starts):
                continue
            h = self._rolled(np.lib.stride_tricks.sliding_window_view(codes, n)[starts])
            at = np.searchsorted(hashes, h)
            at[at == len(hashes)] = 0
            for s in starts[hashes[at] == h].tolist():
                if (items := self.items.get(tuple(codes[s:s + n].tolist()))) is not None:
                    found.append((s, n, items))
        return found


def _blocks(benchmark: DataFrame, n: int, block: int) -> Iterator[list[tuple[str | None, bytes]]]:
    """The windows in lists of about ``block``, dealt by their hash; sizes are counted first."""
    win = stage_table(windows(benchmark, n), "windows")
    parts = -(-win.count() // block)
    for k in range(parts):
        part = win if parts == 1 else win.filter(F.pmod(F.xxhash64("window"), F.lit(parts)) == k)
        yield [(r["item"], bytes(r["window"])) for r in part.collect()]


HITS = (("n_words", T.LongType()), ("starts", T.ArrayType(T.IntegerType())), ("lengths", T.ArrayType(T.IntegerType())),
        ("items", T.ArrayType(T.StringType())))


def find_hits(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, block: int = BLOCK_WINDOWS) -> DataFrame:
    """``row`` (the input row) with n_words, the starts and lengths of occurrences, and the items found.

    Beyond one block, the scan is repeated for each block and the finds of a
    document are put together in one row.
    """
    scans = []
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    for rows in _blocks(benchmark, n, block):
        shared = docs.sparkSession.sparkContext.broadcast(Matcher(rows))
        scans.append(_scan(docs.select(row, F.col("text").alias("text")), shared))
    if not scans:
        shared = docs.sparkSession.sparkContext.broadcast(Matcher([]))
        return _scan(docs.select(row, F.col("text").alias("text")), shared)
    if len(scans) == 1:
        return scans[0]
    # One row per document and block: keyed by the row's id and a hash of its text, which alone decide its finds.
    tagged = [s.withColumn("block", F.lit(k)) for k, s in enumerate(scans)]
    key = [F.col("row.doc_id").alias("d"), F.sha2(F.col("row.text"), 256).alias("h"), F.octet_length("row.text").alias("h2")]
    finds = tagged[0].select(*key, "block", "starts", "lengths", "items")
    for t in tagged[1:]:
        finds = finds.unionByName(t.select(*key, "block", "starts", "lengths", "items"))
    finds = finds.filter(F.size("starts") > 0).dropDuplicates(["d", "h", "h2", "block"])
    flat = finds.groupBy("d", "h", "h2").agg(
        *[F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "lengths")],
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")).alias("f")
    base = scans[0].select("row", "n_words", *key).alias("b")
    on = (F.col("b.d").eqNullSafe(F.col("f.d")) & (F.col("b.h") == F.col("f.h")) & (F.col("b.h2") == F.col("f.h2")))
    return base.join(flat, on, "left").select(
        "row", "n_words", *[F.coalesce(F.col(f"f.{c}"), F.array().cast(t)).alias(c) for c, t in
                            (("starts", "array<int>"), ("lengths", "array<int>"), ("items", "array<string>"))])


def _scan(rows: DataFrame, shared) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in slices(batches, "text", BATCH_BYTES):
            n_words, starts, lengths, items = [], [], [], []
            for text in b.column("text").to_pylist():
                w = words_of(text)
                found = m.find(w) if w else []
                n_words.append(len(w))
                starts.append([f[0] for f in found])
                lengths.append([f[1] for f in found])
                items.append(sorted({i for f in found for i in f[2] if i is not None}))
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), pa.array(n_words, pa.int64()), pa.array(starts, pa.list_(pa.int32())),
                 pa.array(lengths, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))],
                ["row", "n_words", "starts", "lengths", "items"])

    return rows.mapInArrow(scan, with_row(rows.schema, *HITS))


def covered(starts: list[int], lengths: list[int]) -> list[tuple[int, int]]:
    """The disjoint spans [from, to) of words that occurrences cover."""
    spans: list[tuple[int, int]] = []
    for s, n in sorted(zip(starts, lengths, strict=True)):
        if spans and s <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(spans[-1][1], s + n))
        else:
            spans.append((s, s + n))
    return spans


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the bytes from each span's first word to the end of its last."""
    raw = text.encode("utf-8", "surrogatepass")
    flat = np.frombuffer(raw.translate(WORD_BYTES), np.uint8) != 0x20
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flat.view(np.int8), [0]])))
    out, last = [], 0
    for a, b in spans:
        out.append(raw[last:edge[2 * a]])
        last = int(edge[2 * b - 1])
    return b"".join([*out, raw[last:]]).decode("utf-8", "surrogatepass")


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, drop_share: float = 0.5,
                  block: int = BLOCK_WINDOWS) -> DataFrame:
    """``docs`` without what the benchmark covers.

    Documents whose hit words are ``drop_share`` of all or more go; from the
    others the hit spans are cut out of the text.  Columns stay as they are.
    """
    hits = find_hits(docs, benchmark, n, block)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", BATCH_BYTES):
            keep, texts = [], []
            cols = [b.column(c).to_pylist() for c in ("text", "n_words", "starts", "lengths")]
            for text, total, starts, lengths in zip(*cols, strict=True):
                spans = covered(starts, lengths)
                hit = sum(z - a for a, z in spans)
                keep.append(not hit or hit < drop_share * total)
                texts.append(cut_spans(text, spans) if hit and keep[-1] else text)
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(texts, pa.string())],
                                             ["row", "text"]).filter(pa.array(keep))

    out = (hits.select("row", F.col("row.text").alias("text"), "n_words", "starts", "lengths")
               .mapInArrow(cut, with_row(hits.schema, ("text", T.StringType()))))
    return out.select(*[(F.col("text") if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """n_words, n_hit, n_items, the hash of the item ids, and contaminated, for every document."""
    hits = find_hits(docs.select("doc_id", "text"), benchmark)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_hit = [sum(z - a for a, z in covered(s, n)) for s, n in
                     zip(b.column("starts").to_pylist(), b.column("lengths").to_pylist(), strict=True)]
            items = [sorted(x) for x in b.column("items").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("n_words"), pa.array(n_hit, pa.int64()),
                 pa.array([len(x) for x in items], pa.int64()),
                 pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]),
                 pa.array([h > 0 for h in n_hit])],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    src = hits.select("row.doc_id", "n_words", "starts", "lengths", "items")
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(tally, f"doc_id {kind}, n_words long, n_hit long, n_items long, "
                                 "items_sha256 string, contaminated boolean")
