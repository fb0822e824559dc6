"""Byte-level BPE encoding and decoding, by DuckDB queries in each partition.

A text is split by the tokenizer's pattern; each match (piece) is encoded on
its own.  The pieces that a batch brings are encoded together by one recursive
query: its state holds every word's tokens; each round turns them into rows of
token and position, joins neighbours with the merge table, and contracts each
word's leftmost pair of minimum rank, until a word has none left.  Decoding
joins the rows (text, position, id) with the vocabulary and aggregates the
bytes in the order of positions.

A task keeps the encodings of pieces it has seen, up to ``CACHE`` of them,
then starts afresh: memory is bounded, and results don't depend on it.  Most
texts are words between single spaces.  No match of the pattern crosses from a
non-space to a following single space, so texts are cut at such places first,
and the pattern runs once over the distinct stretches of a batch.

Nothing is shuffled.  The rank file is read by the driver and broadcast; it is
as large as the vocabulary, whatever the data.

Defined cases: a null or empty text has no tokens and decodes to no bytes.
Lone surrogates can't be in a Spark string.  A piece that is a token as a whole
is that token, as in the tiktoken library.  Other columns are kept or ignored,
never read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adledger.llm.common import as_row, slices, with_row

# The tokenizer of the registered query; the path comes from the installed package.
VOCABULARY = "byte_bpe_50k.tiktoken"
# Text of a batch, and distinct pieces that a worker remembers.
BATCH_BYTES, CACHE = 1 << 20, 300_000
# The same in ``encode``, which the pipeline runs beside executors whose memory other stages have grown.
CACHE_BESIDE = 100_000
# Bytes of pieces that one query contracts.
QUERIED = 1 << 17
# A piece of more bytes (a word has a few) would make as many rounds for a few tokens each: it is contracted
# in the same order, but from a heap.  Decoded in one query: so many tokens.
LONG_PIECE, DECODED = 256, 1 << 18
# A round's key: rank above, position below.
_POSITIONS = 20

ENCODE = f"""
with recursive state(word, toks, live) as (
  select word, toks, true from words
  union all
  (with live as (select word, toks from state where live and len(toks) > 1),
   token as (select word, unnest(toks[:-2]) as l, unnest(toks[2:]) as r,
                    generate_subscripts(toks[2:], 1) as pos from live),
   best as (select word, min((m.id << {_POSITIONS}) + pos) as k
            from token join merges m on m.pair = (l::bigint << 32) + r group by word)
  select word, case when k is null then toks
                    else toks[:(k & {(1 << _POSITIONS) - 1}) - 1] || [(k >> {_POSITIONS})::int]
                         || toks[(k & {(1 << _POSITIONS) - 1}) + 2:] end, k is not null
  from live left join best using (word))
)
select word, toks from state where not live or len(toks) <= 1 order by word
"""
# One thread reads the ordered rows, so each text's bytes come in the order of positions.
DECODE = """
select doc, string_agg(hex, '') as hex from (select doc, hex from ids join vocabulary using (id) order by pos) group by doc
"""


def default_vocabulary() -> tuple[str, str]:
    """The path of the installed rank file and the pattern that goes with it."""
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}


def merge_pairs(ranks: dict[bytes, int]) -> np.ndarray:
    """Every two tokens that make a token together (both ids in one number), and its id."""
    pairs = [(a << 32 | b, r) for t, r in ranks.items() for i in range(1, len(t))
             if (a := ranks.get(t[:i])) is not None and (b := ranks.get(t[i:])) is not None]
    return np.array(pairs, np.int64).reshape(-1, 2).T.copy()


class Codec:
    """One worker's DuckDB connection, vocabulary and remembered encodings."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, pairs: np.ndarray | None = None) -> None:
        self.cache = CACHE
        self.ranks, self.find = ranks, regex.compile(pattern).findall
        self.bytes_of = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        pairs = merge_pairs(ranks) if pairs is None else pairs
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "300MB", "temp_directory": ""})
        self._table("merges", {"pair": pairs[0], "id": pairs[1]})
        self._table("vocabulary", {"id": np.array(list(ranks.values()), np.int32),
                                   "hex": pa.array([t.hex() for t in ranks])})
        self.forget()

    def _table(self, name: str, cols: dict) -> None:
        self.con.register("given", pa.table(cols))
        self.con.execute(f"create table {name} as select * from given")
        self.con.unregister("given")

    def forget(self) -> None:
        self.pieces = Ragged()

    def close(self) -> None:
        self.con.close()
        self.forget()
        pa.default_memory_pool().release_unused()

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts in a row, and the offsets of each text."""
        if len(self.pieces.at) > self.cache:
            self.forget()
        parts = [stretches(t) if t else [] for t in texts]
        sizes = [len(p) for p in parts]
        number: defaultdict[str, int] = defaultdict()
        number.default_factory = number.__len__
        idx = np.fromiter((number[s] for p in parts for s in p), np.int64, sum(sizes))
        del parts
        place, cut, counts = self._cut(list(number))
        at = self.pieces.at
        self._encode_pieces({p for p in cut if p not in at})
        own = Ragged()
        own.values, own.offsets = self.pieces.take([at[p] for p in cut], counts)
        return own.take(place[idx], sizes)

    def _cut(self, number: list[str]) -> tuple[np.ndarray, list[str], np.ndarray]:
        """Where each stretch lies among all, their pieces in that order, and how many each has.

        A stretch stands for itself behind a space; the first of a text is marked by
        one instead.  Those without a space, or white space at the end, are joined
        again by single spaces, which no piece crosses, and cut by one call: a piece
        that starts with a space is the first of a stretch.
        """
        plain = np.fromiter((" " not in s and not s[-1].isspace() for s in number), bool, len(number))
        joined = [s for s, p in zip(number, plain.tolist(), strict=True) if p]
        cut = self.find(" " + " ".join(joined)) if joined else []
        first = np.flatnonzero(np.fromiter((p[0] == " " for p in cut), bool, len(cut)))
        if len(first) != len(joined):   # a pattern of other cuts: each on its own
            plain[:], cut, first = False, [], first[:0]
        others = [self.find(s[1:] if s[0] == " " else " " + s) for s, p in zip(number, plain.tolist(), strict=True) if not p]
        place = np.empty(len(number), np.int64)
        place[np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])] = np.arange(len(number))
        counts = np.concatenate([np.diff(np.append(first, len(cut))), np.array([len(c) for c in others], np.int64)])
        return place, cut + [p for c in others for p in c], counts

    def _encode_pieces(self, new: set[str]) -> None:
        """Recursive query over the pieces that aren't tokens; in parts, so that it stays in memory."""
        raw = {p: p.encode("utf-8", "surrogatepass") for p in new}
        whole = [p for p, b in raw.items() if b in self.ranks]
        ones = np.array([self.ranks[raw[p]] for p in whole], np.int32)
        self.pieces.extend(whole, ones, np.arange(len(ones) + 1))
        part, held = [], 0
        for p, b in raw.items():
            if b in self.ranks:
                continue
            if len(b) > LONG_PIECE:
                self.pieces.extend([p], ids := self._merge_long(b), np.array([0, len(ids)]))
                continue
            part.append(p)
            held += len(b)
            if held > QUERIED:
                self._merge(part, [raw[x] for x in part])
                part, held = [], 0
        if part:
            self._merge(part, [raw[x] for x in part])

    def _merge(self, pieces: list[str], raw: list[bytes]) -> None:
        ends = np.concatenate([[0], np.cumsum([len(b) for b in raw])]).astype(np.int32)
        tokens = self.bytes_of[np.frombuffer(b"".join(raw), np.uint8)]
        words = pa.table({"word": np.arange(len(raw), dtype=np.int32),
                          "toks": pa.ListArray.from_arrays(pa.array(ends), pa.array(tokens))})
        self.con.register("words", words)
        out = self.con.sql(ENCODE).to_arrow_table()["toks"].combine_chunks()
        self.con.unregister("words")
        if isinstance(out, pa.ChunkedArray):
            out = pa.concat_arrays(out.chunks)
        self.pieces.extend(pieces, out.flatten().to_numpy(), out.offsets.to_numpy() - out.offsets[0].as_py())

    def _merge_long(self, raw: bytes) -> np.ndarray:
        """A long piece: the leftmost pair of minimum rank, one after the other from a heap."""
        import heapq
        get, tok = self.ranks.get, [raw[i:i + 1] for i in range(len(raw))]
        after, before = list(range(1, len(tok) + 1)), list(range(-1, len(tok) - 1))
        heap = [(r, i, tok[i], tok[i + 1]) for i in range(len(tok) - 1) if (r := get(tok[i] + tok[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if tok[i] != a or j >= len(tok) or tok[j] != b:
                continue
            tok[i], tok[j], after[i] = a + b, None, after[j]
            if after[i] < len(tok):
                before[after[i]] = i
                if (r := get(tok[i] + tok[after[i]])) is not None:
                    heapq.heappush(heap, (r, i, tok[i], tok[after[i]]))
            if before[i] >= 0 and (r := get(tok[before[i]] + tok[i])) is not None:
                heapq.heappush(heap, (r, before[i], tok[before[i]], tok[i]))
        return np.array([self.ranks[t] for t in tok if t is not None], np.int32)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """The bytes of each text, by an ordered aggregation over bounded stretches of tokens."""
        doc = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
        pos = np.arange(len(ids), dtype=np.int32)
        texts = [b""] * (len(offsets) - 1)
        for i in range(0, len(ids), DECODED):
            self.con.register("ids", pa.table({"doc": doc[i:i + DECODED], "pos": pos[i:i + DECODED],
                                               "id": ids[i:i + DECODED]}))
            out = self.con.sql(DECODE).to_arrow_table()
            self.con.unregister("ids")
            for d, x in zip(out["doc"].to_pylist(), out["hex"].to_pylist(), strict=True):
                texts[d] += bytes.fromhex(x)
        return texts


class Ragged:
    """Lists of integers in one array; ``at`` numbers their keys."""

    def __init__(self) -> None:
        self.at: dict[str, int] = {}
        self.values, self.offsets = np.empty(0, np.int32), np.zeros(1, np.int64)

    def extend(self, keys: list[str], values: np.ndarray, offsets: np.ndarray) -> None:
        n = len(self.at)
        self.at.update(zip(keys, range(n, n + len(keys)), strict=True))
        self.values, self.offsets = (np.concatenate([self.values, values]),
                                     np.concatenate([self.offsets, self.offsets[-1] + offsets[1:]]))

    def take(self, picked: list[int] | np.ndarray, sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """The picked lists one after the other, and the offsets of groups of ``sizes`` of them."""
        idx = np.asarray(picked, np.int64)
        starts, n = self.offsets[idx], self.offsets[idx + 1] - self.offsets[idx]
        ends = np.concatenate([[0], np.cumsum(n)])
        flat = np.arange(ends[-1]) + np.repeat(starts - ends[:-1], n)
        return self.values[flat], ends[np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])]


_odd_space, _single_space = re.compile(r"[^\S \n]").search, re.compile(r"(?<=\S) (?=\S)").split


def stretches(text: str) -> list[str]:
    """``text`` cut at each single space between two characters that are no white space; the first marked by a space."""
    if ("  " in text or " \n" in text or "\n " in text or text[0] == " " or text[-1] == " " or _odd_space(text)):
        out = _single_space(text)
    else:
        out = text.split(" ")
    out[0] = " " + out[0]
    return out


@contextmanager
def _codec(shared) -> Iterator[Codec]:
    """A codec for one task, closed at its end: workers serve other operators next."""
    codec = Codec(*shared.value)
    try:
        yield codec
    finally:
        codec.close()


def share_vocabulary(spark: SparkSession, path: str | None, pattern: str | None):
    """(ranks, pattern, merge pairs) as a broadcast; by default the installed vocabulary."""
    own, own_pattern = default_vocabulary() if path is None or pattern is None else (path, pattern)
    ranks = read_ranks(path or own)
    return spark.sparkContext.broadcast((ranks, pattern or own_pattern, merge_pairs(ranks)))


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``row`` (the input row) and ``ids`` (array of its text's token ids)."""
    shared = share_vocabulary(docs.sparkSession, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _codec(shared) as codec:
            codec.cache = CACHE_BESIDE
            for b in slices(batches, at, BATCH_BYTES):
                ids, offsets = codec.encode(b.column("row").field(at).to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column("row"), lists], ["row", "ids"])

    src, at = as_row(docs, "text")
    return src.mapInArrow(run, with_row(src.schema, ("ids", T.ArrayType(T.IntegerType()))))


def decode(rows: DataFrame, ids: str = "ids", path: str | None = None) -> DataFrame:
    """``rows`` with the bytes of the token ids (null: none) as ``decoded``, beside ``row`` (the input row)."""
    shared = share_vocabulary(rows.sparkSession, path, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _codec(shared) as codec:
            for b in batches:
                for i in range(0, b.num_rows, 1000):
                    part = b.slice(i, 1000)
                    lists = [x or [] for x in part.column("ids").to_pylist()]
                    flat = np.array([t for x in lists for t in x], np.int32)
                    offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists], dtype=np.int64)])
                    yield pa.RecordBatch.from_arrays(
                        [part.column("row"), pa.array(codec.decode(flat, offsets), pa.binary())], ["row", "decoded"])

    src = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), F.col(ids).alias("ids"))
    return src.mapInArrow(run, with_row(src.schema, ("decoded", T.BinaryType())))


def digest(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, n_tokens and the hashes of the ids and of the bytes decoded from them, for every document."""
    shared = share_vocabulary(docs.sparkSession, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _codec(shared) as codec:
            for b in slices(batches, "text", BATCH_BYTES):
                ids, offsets = codec.encode(b.column("text").to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids, pa.int32()).cast("string"))
                said = [hashlib.sha256(x.encode()).hexdigest() for x in pc.binary_join(lists, " ").to_pylist()]
                back = [hashlib.sha256(x).hexdigest() for x in codec.decode(ids, offsets)]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array(np.diff(offsets)), pa.array(said), pa.array(back)],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    src = docs.select("doc_id", "text")
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, n_tokens long, "
                               "ids_sha256 string, decoded_sha256 string")
