"""SimHash near-dedup: 64-bit fingerprints of word shingles, linked at a small bit distance.

Fingerprints are computed in Arrow batches from whole texts.  Equal ones are
one entry from then on, whatever the number of copies.

Two fingerprints that differ in at most ``d`` bits differ in at most ``d``
bytes, so of their eight positional bytes at least ``8 - d`` are shared: the
guaranteed minimum of matches.  The inverted index holds, for each choice of
``8 - d`` byte positions, the postings of the bytes found there; only entries
that meet in a posting can reach the minimum (posting lists of single bytes
would hold 1/256 of all entries each).  For the pairs that meet, shared
positional bytes are tallied and bits compared.

Postings of two entries, nearly all that matter, are verified as they leave
the count.  Longer ones up to ``MAX_POSTING`` are compared inside one task;
only a spanning forest of their links leaves it.  Entries of still longer
postings, as from a great family of near copies, go another exact way, linear
in their number: two entries within ``d`` bits of each other share a midpoint
within ``(d + 1) // 2`` bits of both, so every such entry is spread to all its
midpoints, and each midpoint's entries are linked to the least of them; links
found so are within ``2 * ((d + 1) // 2)`` bits, which is ``d`` for even d (odd
d is refused there).  No group is gathered without bound and nothing is left
out.

Defined cases: a null text, or one without words, has fingerprint zero, linked
like any other; repeated rows share an entry; rows without doc_id get a
component as the others but never name one (null if no row of it has an id).
An empty table gives an empty result.  Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adledger.llm.common import slices
from adledger.llm.components import components
from adledger.session import stage_table

# Production parameters: words of a shingle, and the most differing bits of a link.
SHINGLE, MAX_BITS, SEED = 4, 4, 42
# Longest posting that is compared inside one task (its pairs: eight million).
MAX_POSTING = 4096
# Bound of a broadcast: 64-bit words of the bitmap over postings of three or more.
MARKS = 1 << 18
BATCH_BYTES = 8 << 20


def fingerprint(text: str | None, k: int = SHINGLE) -> int:
    """The fingerprint of one text as an unsigned integer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *(ends[:-1]).tolist()]
    ends = (ends - 1).tolist()
    k = min(k, len(words))
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(flat[a:z], SEED) for a, z in zip(starts, ends[k - 1:])], ">u8")  # noqa: B905
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big")


def with_fingerprints(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """``doc_id`` and ``fp`` (the fingerprint's bits as a signed long) for every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", BATCH_BYTES):
            fp = np.array([fingerprint(t, k) for t in b.column("text").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp)], ["doc_id", "fp"])

    src = docs.select("doc_id", "text")
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, fp long")


def _masks(max_bits: int) -> list[int]:
    out = []
    for chosen in combinations(range(8), 8 - max_bits):
        m = sum(0xFF << (8 * i) for i in chosen)
        out.append(m - (1 << 64) if m >> 63 else m)
    return out


def _near(max_bits: int):
    """SQL: the pair u, v shares the guaranteed positional bytes and is within the distance."""
    x = F.col("u").bitwiseXOR(F.col("v"))
    shared = sum(F.when(x.bitwiseAND(F.lit((0xFF << 8 * i) - ((1 << 64) if i == 7 else 0))) == 0, 1).otherwise(0)
                 for i in range(8))
    return (shared >= 8 - max_bits) & (F.bit_count(x) <= max_bits)


def links(entries: DataFrame, max_bits: int = MAX_BITS, max_posting: int = MAX_POSTING) -> DataFrame:
    """Links (u > v) that connect just the entries (distinct ``fp``) which any chain of near pairs connects."""
    if not 0 <= max_bits < 8:
        raise ValueError("the distance must be under eight bits")
    masks = F.array(*[F.lit(m) for m in _masks(max_bits)])
    # Few entries make many postings: deal them out first, or the written table's few files would be few tasks.
    tasks = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    posted = entries.repartition(tasks, "fp").select("fp", F.posexplode(F.transform(masks, lambda m: F.col("fp").bitwiseAND(m)))
                            .alias("mask", "bytes"))
    counted = (posted.groupBy("mask", "bytes")
                     .agg(F.count("*").alias("n"), F.max("fp").alias("u"), F.min("fp").alias("v")).filter("n > 1"))
    counted = stage_table(counted, "postings")
    pairs = counted.filter("n = 2").filter(_near(max_bits)).select("u", "v")
    longer = counted.filter("n > 2").select("mask", "bytes", "n")
    more = stage_table(_marked(posted, longer).join(longer, ["mask", "bytes"]), "members")
    inside = _inside(more.filter(F.col("n") <= max_posting), max_bits)
    spread = _by_midpoints(more.filter(F.col("n") > max_posting).select("fp").distinct(), max_bits)
    return pairs.unionByName(inside).unionByName(spread).distinct()


def _marked(posted: DataFrame, longer: DataFrame) -> DataFrame:
    """The rows of ``posted`` whose posting is in ``longer``, and a few others.

    Few postings are: a bitmap of their hashes, of ``MARKS`` 64-bit words whatever their number, is broadcast
    so that the others aren't shuffled once more.
    """
    h = F.pmod(F.xxhash64("mask", "bytes"), F.lit(64 * MARKS))
    word, bit = F.floor(h / 64).cast("long").alias("word"), (h % 64).cast("int").alias("bit")
    marks = longer.select(word, bit).groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))
    return (posted.withColumns({"word": word, "bit": bit}).join(F.broadcast(marks), "word")
                  .filter(F.expr("shiftright(bits, bit) & 1L") == 1).select("fp", "mask", "bytes"))


def _inside(members: DataFrame, max_bits: int) -> DataFrame:
    """A spanning forest of the links of each posting (bounded in length)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            us, vs = [], []
            for fps in b.column("fps"):
                x = np.sort(np.asarray(fps.values.to_numpy()).view(np.int64)).copy()
                for a, z in forest(x, max_bits):
                    us.append(max(a, z))
                    vs.append(min(a, z))
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["u", "v"])

    groups = members.groupBy("mask", "bytes").agg(F.collect_list("fp").alias("fps")).select("fps")
    return groups.mapInArrow(run, "u long, v long")


def forest(x: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Breadth-first links between the near ones of a few distinct fingerprints."""
    left, out = x.view(np.uint64), []
    while len(left):
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            a = todo.pop()
            near = np.bitwise_count(left ^ a) <= max_bits
            if near.any():
                found = left[near]
                left = left[~near]
                out += [(int(np.int64(a.view(np.int64))), int(z)) for z in found.view(np.int64)]
                todo += list(found)
    return out


def _by_midpoints(entries: DataFrame, max_bits: int) -> DataFrame:
    """Entries of very long postings, each linked to the least one at each of its midpoints."""
    if max_bits % 2:
        raise ValueError("postings this long need an even distance")
    r = max_bits // 2
    flips = np.array([0, *(sum(1 << i for i in c) for n in range(1, r + 1) for c in combinations(range(64), n))],
                     np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = b.column(0).to_numpy().view(np.uint64)
            for i in range(0, len(fps), 256):
                part = fps[i:i + 256]
                mids = (part[:, None] ^ flips[None, :]).reshape(-1).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(mids), pa.array(np.repeat(part.view(np.int64), len(flips)))], ["mid", "fp"])

    spread = entries.mapInArrow(run, "mid long, fp long")
    least = spread.groupBy("mid").agg(F.min("fp").alias("v"), F.max("fp").alias("w")).filter("v < w")
    return (spread.join(stage_table(least.select("mid", "v"), "midpoints"), "mid")
                  .filter("fp > v").select(F.col("fp").alias("u"), "v").distinct())


def _rooted(rows: DataFrame, name: Column, max_bits: int, max_posting: int) -> tuple[DataFrame, DataFrame]:
    """Of rows with ``fp``: each fingerprint's ``root``, and each root's ``least``, the least ``name`` of its rows."""
    entries = stage_table(rows.groupBy("fp").agg(F.min(name).alias("least")), "entries")
    found = components(links(entries.select("fp"), max_bits, max_posting), "simhash")
    named = entries.join(found.select(F.col("u").alias("fp"), F.col("v").alias("root")), "fp", "left")
    named = named.select("fp", F.coalesce("root", "fp").alias("root"), "least")
    # A fingerprint outside every component is its own root; only the others are grouped.
    return named, stage_table(named.groupBy("root").agg(F.min("least").alias("least")), "roots")


def near_duplicates(docs: DataFrame, k: int = SHINGLE, max_bits: int = MAX_BITS,
                    max_posting: int = MAX_POSTING) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id`` (the smallest doc_id reachable) for every row."""
    rows = stage_table(with_fingerprints(docs, k), "fingerprints")
    named, least = _rooted(rows, F.col("doc_id"), max_bits, max_posting)
    classes = named.select("fp", "root").join(least, "root").select("fp", F.col("least").alias("component_id"))
    return rows.join(stage_table(classes, "classes"), "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, k: int = SHINGLE, max_bits: int = MAX_BITS,
                max_posting: int = MAX_POSTING) -> DataFrame:
    """Just one row of each group of near duplicates, with the columns of ``docs``.

    It is the row of the smallest doc_id; rows without one come after all others.  Of rows that share that doc_id any
    one stays.  Rows are told apart by a number that is written with them.
    """
    number = F.monotonically_increasing_id().alias("number")
    rows = stage_table(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), number), "numbered")
    key = F.struct(F.col("row.doc_id").alias("doc_id"), "number")
    marked = stage_table(with_fingerprints(rows.select(key.alias("doc_id"), F.col("row.text").alias("text")), k),
                         "fingerprints")
    name = F.struct(F.col("doc_id.doc_id").isNull().alias("unnamed"), F.col("doc_id.doc_id"), F.col("doc_id.number"))
    _, least = _rooted(marked, name, max_bits, max_posting)
    return rows.join(least.select("least.number"), "number", "left_semi").select("row.*")


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id, for every document."""
    return near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
