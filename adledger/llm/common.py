"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The ASCII white space [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"
# Java regex of the characters between words: everything in ASCII but letters and digits.
NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same for bytes: upper case goes to lower case, what stands between words to a space.
WORD_BYTES = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256))


# Rows and bytes that go to a Python worker at once: texts of some KB, or a few very long ones.
ARROW_ROWS, ARROW_BYTES = 1000, 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Small Arrow batches, on the side of the JVM too: both hold several of them a task."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def with_row(schema: T.StructType, *fields: tuple[str, T.DataType]) -> T.StructType:
    """``row`` of ``schema`` and further fields, whatever the names of the row's columns."""
    return T.StructType([schema["row"], *[T.StructField(n, t) for n, t in fields]])


def as_row(docs: DataFrame, column: str) -> tuple[DataFrame, int]:
    """Just ``row``, the whole input row, and the place of ``column`` in it: a long text goes to Python once."""
    names = docs.columns if column in docs.columns else [c.lower() for c in docs.columns]
    place = names.index(column)
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")), place


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only.  ``lower`` does just that on a text without other letters."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def words_of(text: str | None) -> list[bytes]:
    """The lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text (None: none)."""
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split() if text else []


def slices(batches: Iterator[pa.RecordBatch], column: str | int, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that ``column`` (a number: that field of ``row``) holds about ``max_bytes`` in each.

    A single longer text stays whole, in a batch of its own.
    """
    for batch in batches:
        start, held = 0, 0
        held_in = batch.column(column) if isinstance(column, str) else batch.column("row").field(column)
        sizes = pc.binary_length(held_in).fill_null(0).to_pylist()
        for i, n in enumerate(sizes):
            if held and held + n > max_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < len(sizes):
            yield batch.slice(start)
