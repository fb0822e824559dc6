"""Line dedup: drop the lines that many documents share.

Every text is split at ``\\n``; a line's key is the line stripped of ASCII
white space with A-Z lower-cased.  Lines are exploded with their position,
keys are hashed to 128 bits, distinct documents are counted per hash, and the
texts are put together again from the lines under the threshold.

Only hashes and positions are shuffled for the count and for the join with the
shared hashes; a text moves once, to meet the positions it loses.  A key that
sits in a third of all documents is counted map-side first (per hash and
document, then per hash); in the join its rows can be split, and nothing is
gathered per key.

Defined cases: a null or empty text is one empty line.  Rows that repeat a
doc_id count as one document.  Rows without doc_id count as no document, but
lose shared lines as any other.  An empty table gives an empty result.  A very long
text, or one that loses all its lines, takes time in proportion to its lines.  Other
columns of the input, whatever their names, are kept beside ``doc_id`` and
``text`` and never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adledger.llm.common import SPACES, ascii_lower
from adledger.session import stage_table

# Production parameters: shortest key (code points) and fewest documents.
MIN_CHARS, MIN_DOCS = 1, 10


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _keys(text: Column) -> Column:
    """The line keys of a text, by position."""
    low = ascii_lower(F.coalesce(text, F.lit("")))
    return F.transform(F.split(low, "\n", -1), lambda x: F.trim(x, F.lit(SPACES)))


def _hashes(text: Column, min_chars: int) -> Column:
    """(pos, h1, h2) of the lines that count; two hashes with different seeds make 128 bits."""
    one = F.transform(_keys(text), lambda x, i: F.struct(
        i.alias("pos"), F.length(x).alias("n"), F.xxhash64(x).alias("h1"),
        F.xxhash64(F.lit(MIN_DOCS), x).alias("h2")))
    return F.filter(one, lambda x: x["n"] >= min_chars)


def _without(lines: Column, lost: Column) -> Column:
    """The lines, joined, without those at the positions ``lost``.

    Positions are told apart by hash (``array_except``), so a text takes time in
    proportion to its lines.  Lines and positions are bound as one value, lest
    the text be split again for each line.
    """
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), lost)
    both = F.array(F.struct(lines.alias("lines"), left.alias("left")))
    return F.array_join(F.transform(both, lambda b: F.array_join(
        F.transform(b["left"], lambda i: F.get(b["lines"], i)), "\n")), "")


def shared_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(h1, h2, n_docs) of the keys found in at least ``min_docs`` distinct documents."""
    lines = docs.select(F.col("doc_id").alias("d"), F.inline(_hashes(F.col("text"), min_chars)))
    return (lines.groupBy("h1", "h2").agg(F.countDistinct("d").alias("n_docs"))
                 .filter(F.col("n_docs") >= min_docs))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``row`` (the input row, with the shared lines taken out of its text), ``n_lines``, ``n_dropped``.

    Equal texts lose the same positions, so positions are joined back by
    doc_id and the 128-bit hash of the text; repeated rows and null ids need no
    row number.
    """
    shared = stage_table(shared_lines(docs, min_chars, min_docs).select("h1", "h2"), "shared-lines")
    text = F.coalesce(F.col("text"), F.lit(""))
    key = [F.col("doc_id").alias("d"), F.xxhash64(text).alias("t1"),
           F.xxhash64(F.lit(MIN_DOCS), text).alias("t2")]
    # The text's hashes first: beside inline() they would be worked out again for each of its lines.
    lines = (docs.select(*key, _hashes(F.col("text"), min_chars).alias("lines"))
                 .select("d", "t1", "t2", F.inline("lines")))
    lost = (lines.join(shared, ["h1", "h2"], "left_semi")
                 .groupBy("d", "t1", "t2").agg(F.collect_set("pos").alias("lost")).alias("l"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *key).alias("r")
    out = rows.join(lost, F.col("r.d").eqNullSafe(F.col("l.d")) & (F.col("r.t1") == F.col("l.t1"))
                    & (F.col("r.t2") == F.col("l.t2")), "left")
    lines_of = _lines(F.col("row.text"))
    kept = F.when(F.col("lost").isNull(), F.coalesce(F.col("row.text"), F.lit(""))).otherwise(
        _without(lines_of, F.col("lost")))
    return out.select(F.col("row").withField("text", kept).alias("row"),
                      F.size(lines_of).cast("long").alias("n_lines"),
                      F.when(F.col("lost").isNull(), 0).otherwise(F.size("lost")).cast("long").alias("n_dropped"))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and the hash of the kept text, for every document."""
    return dedup_lines(docs.select("doc_id", "text")).select(
        "row.doc_id", "n_lines", "n_dropped",
        F.sha2(F.encode("row.text", "UTF-8"), 256).alias("kept_sha256"))
