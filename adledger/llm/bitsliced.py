"""Exact top-k search by a bit-sliced index.

Vectors are quantised, each component x to floor(scale * x).  The index cuts
the rows into blocks of about ``BLOCK_ROWS`` and holds, for every dimension
and bit, a bitmap over the block's rows: its slice.  A query's score is the
sum over dimensions of its component times the row's, so the slices are added
at the weights of the query component's bits by bitmap arithmetic (carry-save:
three bitmaps of one weight become one of it and one of the next, for all rows
at once), which leaves the slices of the score.  From the most significant
slice downward, rows are taken for certain while they are fewer than k, and
the rest tied so far is narrowed; rows still tied after the last slice have
equal scores and are resolved by the smaller id.

The query set meets the index in blocks: each block of at most
``BLOCK_QUERIES`` queries is sent once to each block of the index, k rows a
query come back, and a window over those picks the k best.  Blocks are dealt
by a hash, so no key can be hot, and what a task holds is bounded by the block
sizes.  (Every query is scored against every row, which is the operator; no
pair leaves a task but the k best of a block.)

Defined cases: rows whose vector is null, or holds a null or a component that
isn't finite, take no part, nor do rows without id.  Rows repeated in id and
vector count once.  Rows of one id with different vectors all take part; none
is a candidate of a query with its id, and each is a query.  Vectors of
different lengths don't meet.  Scores must fit 62 bits.  An empty table gives
an empty result; other columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adledger.session import stage_table

SCALE, TOP = 64, 20
# Rows of an index block, queries of a query block.
BLOCK_ROWS, BLOCK_QUERIES = 16_384, 256
ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, x): the rows that take part, with quantised vectors, each once."""
    x = F.transform("embedding", lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long"))
    whole = F.forall("embedding", lambda c: F.coalesce(
        ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")), F.lit(False)))
    return (vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
                   .filter(whole).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).distinct())


class Index:
    """One block's bit slices: of each component less the block's least, so that all are positive."""

    def __init__(self, ids: np.ndarray, x: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, x = ids[order], x[order]
        self.rows, self.dims = x.shape
        self.least = int(x.min()) if x.size else 0
        shifted = (x - self.least).astype(np.uint64)
        self.bits = max(1, int(shifted.max()).bit_length()) if x.size else 1
        words = -(-self.rows // 64)
        self.slices = np.zeros((self.dims, self.bits, words), np.uint64)
        padded = np.zeros((words * 64, self.dims), np.uint64)
        padded[:self.rows] = shifted
        for b in range(self.bits):
            on = np.ascontiguousarray(((padded >> np.uint64(b)) & np.uint64(1)).astype(np.uint8).T)
            self.slices[:, b] = np.packbits(on, axis=1, bitorder="little").view("<u8")
        self.there = np.packbits(np.arange(words * 64) < self.rows, bitorder="little").view("<u8")

    def score_slices(self, q: np.ndarray) -> tuple[list[np.ndarray], int]:
        """The slices of (score + offset) from the least significant, and the offset."""
        top = (1 << self.bits) - 1
        inputs: dict[int, list[np.ndarray]] = {}
        # A negative component takes the complement of its dimension's slices: top - u for u.
        flip = np.where(q < 0, ONES, np.uint64(0))[:, None, None]
        turned = self.slices ^ flip
        size = np.abs(q)
        for k in range(int(size.max()).bit_length() if size.size else 0):
            on = (size >> k) & 1 == 1
            if on.any():
                for b in range(self.bits):
                    inputs.setdefault(k + b, []).append(turned[on, b])
        stacks = {w: np.concatenate(parts) for w, parts in inputs.items()}
        out, w = [], 0
        empty = np.zeros((0, self.slices.shape[2]), np.uint64)
        while stacks and w <= max(stacks):
            s = stacks.pop(w, empty)
            carried = [stacks[w + 1]] if w + 1 in stacks else []
            while len(s) > 2:  # full adders on thirds of the stack
                n = len(s) // 3
                a, b, c = s[:n], s[n:2 * n], s[2 * n:3 * n]
                ab = a ^ b
                carried.append((a & b) | (ab & c))
                s = np.concatenate([ab ^ c, s[3 * n:]])
            if len(s) == 2:
                carried.append(s[:1] & s[1:])
                s = s[:1] ^ s[1:]
            if carried:
                stacks[w + 1] = np.concatenate(carried)
            out.append(s[0] if len(s) else np.zeros(self.slices.shape[2], np.uint64))
            w += 1
        # sum |q| (x - least) for positive q, sum |q| (top - (x - least)) for negative ones.
        offset = int((-q * self.least).sum() + (size[q < 0] * top).sum())
        return out, offset

    def top(self, q: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and scores of the k best rows but the query's own, ties to the smaller id."""
        slices, offset = self.score_slices(q)
        tied = self.there.copy()
        a, z = np.searchsorted(self.ids, [own, own + 1])
        for i in range(a, z):
            tied[i // 64] &= ~(np.uint64(1) << np.uint64(i % 64))
        sure, n_sure = np.zeros_like(tied), 0
        for s in reversed(slices):
            high = tied & s
            n = n_sure + int(np.bitwise_count(high).sum())
            if n > k:
                tied = high
            else:
                sure, n_sure, tied = sure | high, n, tied & ~s
                if n == k:
                    break
        at = _positions(sure)
        if n_sure < k:
            at = np.concatenate([at, _positions(tied)[:k - n_sure]])
        scores = np.full(len(at), -offset, np.int64)
        word, bit = at // 64, (at % 64).astype(np.uint64)
        for w, s in enumerate(slices):
            scores += ((s[word] >> bit) & np.uint64(1)).astype(np.int64) << w
        return at, scores


def _positions(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def search(vectors: DataFrame, is_query, k: int = TOP, scale: int = SCALE,
           block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows of each row for which ``is_query`` holds."""
    rows = stage_table(quantised(vectors, scale), "quantised").withColumn("dims", F.size("x"))
    sizes = rows.groupBy("dims").agg(F.count("*").alias("n"), F.sum(is_query.cast("long")).alias("q"))
    # The numbers of blocks; there are as many rows here as lengths of vectors.  While there are fewer index
    # blocks than tasks, each is sent to several, which share the query blocks.
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    h = F.xxhash64("vec_id", "x")
    blocks = lambda n, size: F.greatest(F.lit(1), F.ceil(n / F.lit(size))).cast("long")
    sizes = sizes.withColumn("parts", blocks(F.col("n"), block_rows)).select(
        "dims", "parts", blocks(F.col("q"), block_queries).alias("q_parts"),
        F.greatest(F.lit(1), F.ceil(F.lit(tasks) / F.col("parts"))).cast("long").alias("copies"))
    sizes = F.broadcast(stage_table(sizes, "sizes"))
    rows = rows.join(sizes, "dims")
    index = rows.select("dims", F.pmod(h, "parts").alias("part"), "vec_id", "x")
    asked = rows.filter(is_query).select(
        "dims", "parts", "copies", F.pmod(F.xxhash64(h), "q_parts").alias("q_part"), "vec_id", "x")
    asked = asked.groupBy("dims", "parts", "copies", "q_part").agg(
        F.collect_list(F.struct("vec_id", "x")).alias("asked"))
    numbers = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    asked = asked.select("dims", numbers(F.col("parts")).alias("part"), (F.col("q_part") % F.col("copies")).alias("copy"),
                         "asked")

    def pack(_: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(list(batches))
        xs = np.concatenate([np.asarray(c.flatten()) for c in t["x"].chunks])
        kind = next(f"<i{n}" for n in (1, 2, 4, 8) if n == 8 or not len(xs) or -1 << 8 * n - 1 <= xs.min()
                    and xs.max() < 1 << 8 * n - 1)
        yield pa.RecordBatch.from_arrays(
            [t["dims"].combine_chunks()[:1], t["part"].combine_chunks()[:1], pa.array([kind]),
             pa.array([t["vec_id"].to_numpy().astype("<i8").tobytes()], pa.binary()),
             pa.array([xs.astype(kind).tobytes()], pa.binary())], ["dims", "part", "kind", "ids", "xs"])

    packed = index.groupBy("dims", "part").applyInArrow(pack, "dims int, part long, kind string, ids binary, xs binary")
    packed = stage_table(packed, "index-blocks").join(sizes.select("dims", "copies"), "dims").select(
        "dims", "part", numbers(F.col("copies")).alias("copy"), "kind", "ids", "xs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple = (None, None)
        for b in batches:
            for i in range(b.num_rows):
                r = b.slice(i, 1)
                key = (r["dims"][0].as_py(), r["part"][0].as_py())
                if held[0] != key:  # the pairs of one index block come one after the other
                    ids = np.frombuffer(r["ids"][0].as_buffer(), "<i8")
                    xs = np.frombuffer(r["xs"][0].as_buffer(), r["kind"][0].as_py()).astype("i8").reshape(len(ids), key[0])
                    held = (key, Index(ids, xs))
                queries = r["asked"][0].as_py()
                found = [held[1].top(np.array(q["x"], np.int64), q["vec_id"], k) for q in queries]
                n = [len(at) for at, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat([q["vec_id"] for q in queries], n), pa.int64()),
                     pa.array(np.repeat([_key_of(q["x"]) for q in queries], n), pa.int64()),
                     pa.array(held[1].ids[np.concatenate([at for at, _ in found])], pa.int64()),
                     pa.array(np.concatenate([s for _, s in found]), pa.int64())],
                    ["query_id", "own", "vec_id", "score"])

    key = ["dims", "part", "copy"]
    pairs = packed.repartition(tasks, *key).hint("merge").join(asked.repartition(tasks, *key), key)
    best = pairs.mapInArrow(run, "query_id long, own long, vec_id long, score long")
    w = Window.partitionBy("query_id", "own").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
                .select("query_id", "rank", "vec_id", "score"))


def _key_of(x: list[int]) -> int:
    """A number that tells the vectors of one id apart."""
    return int.from_bytes(hashlib.blake2b(np.array(x, "<i8").tobytes(), digest_size=8).digest(), "little", signed=True)


def digest(vectors: DataFrame) -> DataFrame:
    """The 20 best rows of each row whose vec_id is divisible by 20."""
    return search(vectors.select("vec_id", "embedding"), F.col("vec_id") % 20 == 0)
