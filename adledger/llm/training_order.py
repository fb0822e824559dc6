"""Token-ID output in training order: every sequence gets a global slot, and shards of a fixed stride hold the slots.

Texts become the token ids of a public byte-level vocabulary, an end token
follows each text, and each text is cut into sequences of ``length`` tokens,
the last one padded; ids are written with two bytes, little end first.  The cut
sequences are written once with the number of the task and the place in it,
without padding, as two planes (low bytes, high bytes), compressed; with the
tasks' counts (one number a task reaches the driver) that gives every sequence
an index from 0 to N - 1.
The index is permuted by a keyed Feistel network over the least power of four
that holds N, walked until the value is below N: the slot.  Nobody sorts or
gathers anything for it, and slot and index are computed from one another.

Shards hold ``per_shard`` slots one after the other, ``length`` times the id's
width bytes each, so the bytes of slot s are at ``(s % per_shard) * stride`` of
shard ``s // per_shard``: a reader that stopped at any slot goes on from there
(``read_from``).  Each task gets a range of shards (``repartitionById``: slots are
uniform, so ranges are equal however the texts are distributed), sorts it by
slot and pads it into shards; a file holds neighbouring shards, in order, and a
read from a slot on skips the files before it by their statistics.  A shard is
of bounded size; its Parquet file is compressed by zstd.

Defined cases: a null text is an empty one, which is a sequence of an end token
alone; repeated rows give sequences of their own; an empty table gives no
shard.  Other columns are never read; doc_id goes into the shard's manifest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adledger.llm.bpe import share_vocabulary
from adledger.llm.common import slices
from adledger.session import drop_staged, stage_table

# Tokens of a sequence, slots of a shard, the key of the order.
LENGTH, PER_SHARD, KEY = 1024, 512, 20240229
# Bytes of an id, the id of padding, bytes of a sequence.
WIDTH, PAD = 2, 0xFFFF
STRIDE = LENGTH * WIDTH
ROUNDS = 6
BATCH_BYTES = 4 << 20


def _mixed(x: np.ndarray, key: int) -> np.ndarray:
    """A keyed 64-bit mixing of each element."""
    x = x + np.uint64(key & 0xFFFFFFFFFFFFFFFF)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _feistel(x: np.ndarray, half: int, key: int, back: bool) -> np.ndarray:
    mask = np.uint64((1 << half) - 1)
    left, right = x >> np.uint64(half), x & mask
    for r in reversed(range(ROUNDS)) if back else range(ROUNDS):
        k = key * 0x9E3779B97F4A7C15 + (r + 1) * 0xD1B54A32D192ED03
        if back:
            left, right = right ^ (_mixed(left, k) & mask), left
        else:
            left, right = right, left ^ (_mixed(right, k) & mask)
    return (left << np.uint64(half)) | right


def permuted(index: np.ndarray, n: int, key: int = KEY, back: bool = False) -> np.ndarray:
    """The slots of indices below ``n`` (or, ``back``, the indices of slots): a permutation of 0 .. n - 1."""
    half = max(1, -(-(max(n, 2) - 1).bit_length() // 2))
    x = _feistel(index.astype(np.uint64), half, key, back)
    while (out := x >= n).any():
        x[out] = _feistel(x[out], half, key, back)
    return x.astype(np.int64)


_encodings: dict = {}


def _encoding(shared) -> tiktoken.Encoding:
    """The worker's encoder of a broadcast vocabulary, made once."""
    ranks, pattern, _ = shared.value
    key = (hash(frozenset(ranks.items())), pattern)
    if key not in _encodings:
        _encodings.clear()
        _encodings[key] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encodings[key]


def planes(ids: np.ndarray) -> bytes:
    """The low bytes of all ids, then their high bytes."""
    return ids.astype("<u2").view(np.uint8).reshape(-1, WIDTH).T.tobytes()


def padded(raw: bytes, stride: int) -> bytes:
    """The ids of ``planes``, padded to ``stride`` bytes."""
    row = np.full(stride // WIDTH, PAD, "<u2")
    row.view(np.uint8).reshape(-1, WIDTH)[:len(raw) // WIDTH] = np.frombuffer(raw, np.uint8).reshape(WIDTH, -1).T
    return row.tobytes()


def _rows(schema: T.StructType, *fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([schema["doc_id"] if n == "doc_id" else T.StructField(n, t) for n, t in fields])


LONG, INT, RAW = T.LongType(), T.IntegerType(), T.BinaryType()


def sequences(docs: DataFrame, length: int = LENGTH, path: str | None = None,
              pattern: str | None = None) -> DataFrame:
    """(task, place, doc_id, seq, n_tokens, stride, payload), written to the shared folder.

    The end token is the first id that the vocabulary leaves free; it and the
    padding must fit two bytes.
    """
    shared = share_vocabulary(docs.sparkSession, path, pattern)
    if len(shared.value[0]) >= PAD:
        raise ValueError(f"{len(shared.value[0])} ids, an end token and padding don't fit {WIDTH} bytes")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, place = TaskContext.get().partitionId(), 0
        encoding, end = _encoding(shared), len(shared.value[0])
        press = zstandard.ZstdCompressor(level=3, write_checksum=False, write_content_size=True).compress
        for b in slices(batches, "text", BATCH_BYTES):
            owner, seq, n_tokens, payload = [], [], [], []
            for i, text in enumerate(b.column("text").to_pylist()):
                ids = np.array([*encoding.encode_ordinary(text or ""), end], "<u2")
                starts = range(0, len(ids), length)
                payload += [press(planes(ids[k:k + length])) for k in starts]
                owner += [i] * len(starts)
                seq += range(len(starts))
                n_tokens += [min(length, len(ids) - k) for k in starts]
            yield pa.RecordBatch.from_arrays(
                [pa.array([task] * len(owner), pa.int32()), pa.array(range(place, place + len(owner)), pa.int64()),
                 b.column("doc_id").take(pa.array(owner, pa.int64())), pa.array(seq, pa.int64()),
                 pa.array(n_tokens, pa.int64()), pa.array([length * WIDTH] * len(owner), pa.int32()),
                 pa.array(payload, pa.binary())],
                ["task", "place", "doc_id", "seq", "n_tokens", "stride", "payload"])
            place += len(owner)

    out = _rows(docs.schema, ("task", INT), ("place", LONG), ("doc_id", LONG), ("seq", LONG), ("n_tokens", LONG),
                ("stride", INT), ("payload", RAW))
    return stage_table(docs.select("doc_id", "text").mapInArrow(cut, out), "sequences")


def shards(cut: DataFrame, key: int = KEY, per_shard: int = PER_SHARD) -> DataFrame:
    """The shards of written sequences: (shard, first_slot, payload) and a manifest by slot (doc_id, seq, n_tokens)."""
    spark = cut.sparkSession
    counts = {r["task"]: r["n"] for r in cut.groupBy("task").agg(F.count("*").alias("n")).collect()}
    first, n = {}, 0
    for task in sorted(counts):
        first[task], n = n, n + counts[task]
    shared = spark.sparkContext.broadcast((first, n))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, total = shared.value
        for b in batches:
            base = np.array([start[t] for t in b.column("task").to_pylist()], np.int64)
            slot = permuted(base + b.column("place").to_numpy(), total, key)
            yield pa.RecordBatch.from_arrays(
                [pa.array(slot // per_shard), pa.array(slot), *[b.column(c) for c in rest]], ["shard", "slot", *rest])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        unpress = zstandard.ZstdDecompressor().decompress

        def flush() -> pa.RecordBatch:
            t = pa.Table.from_batches(held).combine_chunks()
            stride = t["stride"][0].as_py()
            lists = [pa.ListArray.from_arrays(pa.array([0, len(t)], pa.int32()), t[c].combine_chunks()
                                              if isinstance(t[c], pa.ChunkedArray) else t[c])
                     for c in ("doc_id", "seq", "n_tokens")]
            return pa.RecordBatch.from_arrays(
                [t["shard"].combine_chunks()[:1], t["slot"].combine_chunks()[:1], *lists,
                 pa.array([b"".join(padded(unpress(x), stride) for x in t["payload"].to_pylist())], pa.binary())],
                ["shard", "first_slot", "doc_ids", "seqs", "n_tokens", "payload"])

        for b in batches:
            shard, at = b.column("shard").to_numpy(), 0
            for z in [*(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]:
                if held and held[0].column("shard")[0].as_py() != shard[at]:
                    yield flush()
                    held.clear()
                held.append(b.slice(at, z - at))
                at = z
        if held:
            yield flush()

    rest = ["doc_id", "seq", "n_tokens", "stride", "payload"]
    fields = [("shard", LONG), ("slot", LONG), ("doc_id", LONG), ("seq", LONG), ("n_tokens", LONG), ("stride", INT), ("payload", RAW)]
    placed = cut.mapInArrow(place, _rows(cut.schema, *fields))
    # As many ranges as tasks, or more so that none gets beyond about 128 MB; a shard is whole in one of them.
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // (1 << 16)))
    each = max(1, -(-(-(-n // per_shard)) // parts))
    ranged = placed.repartitionById(parts, F.floor(F.col("shard") / each).cast("int"))
    out = T.StructType([T.StructField("shard", LONG), T.StructField("first_slot", LONG),
                        T.StructField("doc_ids", T.ArrayType(cut.schema["doc_id"].dataType)),
                        T.StructField("seqs", T.ArrayType(LONG)), T.StructField("n_tokens", T.ArrayType(LONG)),
                        T.StructField("payload", RAW)])
    return ranged.sortWithinPartitions("shard", "slot").mapInArrow(fill, out)


def write(docs: DataFrame, length: int = LENGTH, per_shard: int = PER_SHARD, key: int = KEY) -> DataFrame:
    """The shards of ``docs``, written to the shared folder and read back; the cut sequences are dropped then."""
    cut = sequences(docs, length)
    written = stage_table(shards(cut, key, per_shard), "shards", compression="zstd")
    drop_staged(cut)
    return written


def read_from(written: DataFrame, slot: int, per_shard: int = PER_SHARD, stride: int = STRIDE) -> DataFrame:
    """(slot, doc_id, seq, n_tokens, payload) of all sequences from ``slot`` on; files of earlier shards are skipped."""
    one = F.posexplode(F.arrays_zip("doc_ids", "seqs", "n_tokens"))
    rows = written.filter(F.col("shard") >= slot // per_shard).select("first_slot", "payload", one.alias("at", "m"))
    return rows.select((F.col("first_slot") + F.col("at")).alias("slot"), F.col("m.doc_ids").alias("doc_id"),
                       F.col("m.seqs").alias("seq"), F.col("m.n_tokens").alias("n_tokens"),
                       F.substring("payload", F.col("at") * stride + 1, F.lit(stride)).alias("payload")
                       ).filter(F.col("slot") >= slot)


def digest(docs: DataFrame) -> DataFrame:
    """Where every sequence of every document is, as read back from the written shards, with its bytes' hash."""
    written = write(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                r = b.slice(i, 1)
                ids, raw = r["doc_ids"].flatten(), memoryview(r["payload"][0].as_buffer())
                n = len(ids)
                slot = r["first_slot"][0].as_py() + np.arange(n)
                yield pa.RecordBatch.from_arrays(
                    [ids, r["seqs"].flatten(), r["n_tokens"].flatten(), pa.array(slot),
                     pa.array(np.full(n, r["shard"][0].as_py())), pa.array(np.arange(n) * STRIDE),
                     pa.array([hashlib.sha256(raw[k * STRIDE:(k + 1) * STRIDE]).hexdigest() for k in range(n)])],
                    ["doc_id", "seq", "n_tokens", "slot", "shard", "byte_offset", "ids_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return written.mapInArrow(run, f"doc_id {kind}, seq long, n_tokens long, slot long, shard long, "
                                   "byte_offset long, ids_sha256 string")
