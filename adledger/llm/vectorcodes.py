"""Product codes of integer vectors, by memoised grid cells.

A vector is cut into equal consecutive parts; each part position has a codebook
whose entries move to the floor of the mean of their parts in every round.  The
nearest entry of a part is found over the part's grid cell: each component's
coarse step names a box, and an entry is left out if its least distance to the
box is more than some other entry's greatest one.  What remains for a cell is
remembered by its key, and only these entries are evaluated exactly.  All
arithmetic is on integers, so results are exact and the same in any order.

Spark cuts the rows.  A round is one pass over the table: a task adds up its
parts by entry, at most ``ENTRIES`` sums a part position whatever its rows; the
sums are added by Spark, and the new codebooks (``ENTRIES`` vectors, by the
driver from as many sums) go to all tasks with the next pass.  A task remembers
``CELLS`` cells at most, then starts afresh; results don't depend on it.

Defined cases: rows whose vector is null, empty, or holds a null or non-finite
component take no part, nor do those with a component of ``LIMIT`` or more after
scaling, whose squared distances might not fit 64 bits, those whose length isn't
a multiple of the parts, and those of another length than the row of the least
id has.  Rows of one id are rows of their own; null ids come last, equal ids are
taken by their vectors for the first codebook.  Fewer rows than entries: as many
entries as rows.  An empty table gives no rows.  Null labels are one label.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
# Components from here on are left out (see above); a codebook entry is never greater than its parts.
LIMIT = 1 << 26
# Rows evaluated at once, cells whose boxes are compared at once, and cells that a task remembers.
ROWS, BLOCK, CELLS = 4096, 512, 1 << 16


class Grid:
    """Nearest entries of one codebook, with the cells seen so far."""

    def __init__(self, entries: np.ndarray, width: int | None = None) -> None:
        self.entries = entries
        # Half the spread of a component: a narrower box leaves fewer entries and is met less often.
        self.width = width or max(1, int(entries.std(axis=0).mean()) // 2)
        self.cells: dict[bytes, np.ndarray] = {}

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of each part's nearest entry (ties: the lower) and the squared distance."""
        cells, which = np.unique(parts // self.width, axis=0, return_inverse=True)
        which = which.reshape(-1)
        kept = self._candidates(cells)
        sizes = np.array([len(k) for k in kept])
        flat, ends = np.concatenate(kept).astype(np.int64), np.cumsum(sizes)
        n = sizes[which]
        stop = np.cumsum(n)
        row = np.repeat(np.arange(len(parts)), n)
        entry = flat[np.arange(stop[-1]) - np.repeat(stop - n, n) + np.repeat((ends - sizes)[which], n)]
        dist = np.zeros(len(row), np.int64)
        for d in range(parts.shape[1]):
            gap = parts[row, d] - self.entries[entry, d]
            dist += gap * gap
        best = np.minimum.reduceat(dist, stop - n)
        # Candidates of a cell ascend, so the first of least distance has the lower index.
        hit = np.flatnonzero(dist == np.repeat(best, n))
        first = hit[np.concatenate([[True], row[hit][1:] != row[hit][:-1]])]
        return entry[first], best

    def _candidates(self, cells: np.ndarray) -> list[np.ndarray]:
        keys = [c.tobytes() for c in np.ascontiguousarray(cells)]
        if len(self.cells) + len(keys) > CELLS:
            self.cells = {}
        new = np.array([i for i, k in enumerate(keys) if k not in self.cells], np.int64)
        for i in range(0, len(new), BLOCK):
            some = new[i:i + BLOCK]
            for j, keep in zip(some, self._undominated(cells[some]), strict=True):
                self.cells[keys[j]] = keep
        return [self.cells[k] for k in keys]

    def _undominated(self, cells: np.ndarray) -> list[np.ndarray]:
        """Entries whose least distance to the cell's box is within every entry's greatest one."""
        least = np.zeros((len(cells), len(self.entries)), np.int64)
        most = np.zeros_like(least)
        for d in range(cells.shape[1]):
            steps, at = np.unique(cells[:, d], return_inverse=True)
            low = (steps * self.width)[:, None]
            high, e = low + self.width - 1, self.entries[:, d][None, :]
            least += (np.maximum(np.maximum(low - e, e - high), 0) ** 2)[at.reshape(-1)]
            most += (np.maximum(np.abs(e - low), np.abs(e - high)) ** 2)[at.reshape(-1)]
        keep = least <= most.min(axis=1)[:, None]
        return [np.flatnonzero(k).astype(np.int32) for k in keep]


def scaled(rows: DataFrame) -> DataFrame:
    """vec_id, label, x: the rows that take part, with the components as integers."""
    x = F.transform("embedding", lambda c: F.floor(F.lit(SCALE) * c.cast("double")))
    fit = F.forall("embedding", lambda c: F.coalesce(F.abs(F.lit(SCALE) * c.cast("double")) < LIMIT, F.lit(False))
                   & ~F.coalesce(F.isnan(c.cast("double")), F.lit(True)))
    return (rows.select("vec_id", "label", "embedding")
                .filter(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & (F.size("embedding") % PARTS == 0) & fit)
                .select("vec_id", "label", x.alias("x")))


def first_entries(vectors: DataFrame) -> np.ndarray | None:
    """Part position, entry, component: the vectors of the least ids (None: there is no row)."""
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(ENTRIES + 1).select("x").collect()
    if not first:
        return None
    dim = len(first[0].x)
    same = [r.x for r in first if len(r.x) == dim]
    if len(same) < len(first):  # rows of another length among them: look again without those
        same = [r.x for r in vectors.filter(F.size("x") == dim).orderBy(F.col("vec_id").asc_nulls_last(), "x")
                .limit(ENTRIES).select("x").collect()]
    same = np.array(same[:ENTRIES], np.int64)
    return np.ascontiguousarray(same.reshape(len(same), PARTS, dim // PARTS).transpose(1, 0, 2))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def _assigned(batches: Iterator[pa.RecordBatch], books: np.ndarray, width: int | None):
    """Each batch with its vectors by part, and each part's nearest entry and distance."""
    grids = [Grid(b, width) for b in books]
    for whole in batches:
        for i in range(0, whole.num_rows, ROWS):
            batch = whole.slice(i, ROWS)
            x = _matrix(batch.column("x"))
            parts = np.split(x, PARTS, axis=1)
            found = [g.nearest(p) for g, p in zip(grids, parts, strict=True)]
            yield batch, parts, [f[0] for f in found], [f[1] for f in found]


SUMS = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("entry", T.IntegerType()),
                     T.StructField("n", T.LongType()), T.StructField("total", T.ArrayType(T.LongType()))])


def entry_sums(vectors: DataFrame, books: np.ndarray, width: int | None) -> list[Row]:
    """(part, entry, n, total): number and componentwise sum of the parts nearest to each used entry."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, counts = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
        for _, parts, entries, _ in _assigned(batches, books, width):
            for p in range(PARTS):
                np.add.at(totals[p], entries[p], parts[p])
                counts[p] += np.bincount(entries[p], minlength=books.shape[1])
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(counts[part, entry]),
             pa.array(list(totals[part, entry]), pa.list_(pa.int64()))], ["part", "entry", "n", "total"])

    sums = vectors.select("x").mapInArrow(run, SUMS)
    added = [F.sum(F.col("total")[d]).alias(f"t{d}") for d in range(books.shape[2])]
    return (sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *added)
                .select("part", "entry", "n", F.array(*[f"t{d}" for d in range(books.shape[2])]).alias("total")).collect())


def train(vectors: DataFrame, rounds: int = ROUNDS, width: int | None = None) -> tuple[DataFrame, np.ndarray | None]:
    """The vectors of the codebooks' length, and the codebooks after all rounds."""
    books = first_entries(vectors)
    if books is None:
        return vectors, None
    vectors = vectors.filter(F.size("x") == PARTS * books.shape[2])
    for _ in range(rounds):
        new = books.copy()
        for r in entry_sums(vectors, books, width):
            new[r.part, r.entry] = [t // r.n for t in r.total]
        books = new
    return vectors, books


def codebooks_sha256(books: np.ndarray | None) -> str:
    said = "" if books is None else ",".join(map(str, books.reshape(-1).tolist()))
    return hashlib.sha256(said.encode()).hexdigest()


def encode(vectors: DataFrame, books: np.ndarray | None, width: int | None = None) -> DataFrame:
    """vec_id, label, codes (an index for each part position) and error of every vector."""
    out = T.StructType([vectors.schema["vec_id"], vectors.schema["label"],
                        T.StructField("codes", T.ArrayType(T.IntegerType())), T.StructField("error", T.LongType())])
    if books is None:
        return vectors.sparkSession.createDataFrame([], out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, entries, dists in _assigned(batches, books, width):
            codes = np.stack(entries, axis=1).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, codes.size + 1, PARTS, dtype=np.int32)),
                                             pa.array(codes.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), lists,
                                              pa.array(sum(dists))], ["vec_id", "label", "codes", "error"])

    return vectors.mapInArrow(run, out)


def digest(rows: DataFrame, rounds: int = ROUNDS, width: int | None = None) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every vector that takes part."""
    vectors, books = train(scaled(rows), rounds, width)
    codes = encode(vectors, books, width)
    by_label = codes.groupBy("label").agg(F.sum("error").alias("label_error"))
    hexes = F.concat(*[F.lpad(F.lower(F.hex(F.col("codes")[p])), 2, "0") for p in range(PARTS)])
    named = by_label.withColumnRenamed("label", "of_label")
    return (codes.join(named, F.col("label").eqNullSafe(F.col("of_label")), "left")
                 .select("vec_id", hexes.alias("code"), "error", "label_error",
                         F.lit(codebooks_sha256(books)).alias("codebooks_sha256")))
