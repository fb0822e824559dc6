"""Token counts of a piece vocabulary, by a compiled finite-state transducer.

Encoding merges neighbours in the order of the pieces' scores.  A row of pieces
is the encoding of its text exactly if every neighbouring pair is: undoing the
merges next to the seam, latest first, must never show a pair that would have
been merged earlier.  So the last piece of each beginning of a text is the one
that may follow the last piece of what precedes it, and a state is finite: for
each ending of the text read so far that begins some longer piece, the place in
the tree of pieces, the last piece before that ending, and the number of pieces
since.  A transition on a character gives the next state and the change of the
number of pieces.  States and transitions are made when they are first met; a
task keeps ``STATES`` of them, then starts afresh.

No piece has a space behind another character, so a single space behind one
leads to the same state from everywhere: a reset.  A chunk of a text is a map of
states: what comes before its first reset (``head``) is to be run from the state
that enters; from there on the number of pieces and the state that leaves are
fixed.  Two neighbouring maps make one.  Texts of up to ``CHUNK`` characters are
counted where they are; longer ones are cut, their chunks are dealt over all
tasks, and the maps are put together by a tree of ``FAN`` at a time.

The tables (as large as the vocabulary) are compiled by the driver and broadcast.

Defined cases: a null or empty text has 0 bytes and 0 tokens.  Characters that
are no piece count their UTF-8 bytes.  Strings of special tokens are ordinary
text.  Repeated rows are rows of their own.  Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adledger.llm.common import slices

MODEL, LIMIT = "piece_bpe_32k.model", 4096
CHUNK, FAN, BATCH_BYTES = 1 << 16, 32, 4 << 20
# Kept by a task: transitions of the transducer, and stretches between resets with their counts.
STATES, STRETCHES = 400_000, 200_000
# The longest Spark string has so many levels of FAN chunks of CHUNK characters.
LEVELS = 3
SPACE = "▁"  # what the vocabulary has for a space
ANY = -1  # no piece; as the last piece: every one may follow


class Vocabulary:
    """Compiled tables: the tree of pieces, their ranks, and the last merge of each."""

    def __init__(self, ranks: dict[str, int]) -> None:
        """``ranks``: of each piece, less for one that is merged earlier; single characters are never merged."""
        if any(SPACE in p.lstrip(SPACE) for p in ranks):
            raise ValueError("a piece has a space behind another character: texts would have no resets")
        self.ids: dict[str, int] = {}
        self.rank: list[int] = []
        self.split: list[tuple[int, int] | None] = []
        for p in sorted(ranks, key=len):
            merged = [p] if len(p) == 1 else self._merge(p, ranks)
            if len(merged) == 1:  # others are never made from their characters
                self._add(p, ranks, merged)
        # Of each character: from place to place in the tree of pieces.
        self.children: dict[str, dict[int, int]] = {}
        self.piece_at, self.inner = [ANY], [False]
        for p, i in self.ids.items():
            node = 0
            for c in p:
                self.inner[node] = True
                places = self.children.setdefault(c, {})
                if node not in places:
                    places[node] = len(self.piece_at)
                    self.piece_at.append(ANY)
                    self.inner.append(False)
                node = places[node]
            self.piece_at[node] = i
        self.ends_in_space = [p[-1] == SPACE for p in self.ids]

    def _add(self, piece: str, ranks: dict[str, int], merged: list) -> None:
        split = None
        if len(piece) > 1:
            left, right = (self.ids[x] for x in self._last)
            split, rank = (left, right), ranks[piece]
            if max(self.rank[left], self.rank[right]) > rank:
                raise ValueError(f"{piece!r} is merged earlier than a part of it")
        self.ids[piece] = len(self.rank)
        self.rank.append(ranks[piece] if split else -1)
        self.split.append(split)

    def _merge(self, text: str, ranks: dict[str, int]) -> list[str]:
        """``text`` encoded by merging; the two last merged pieces are remembered."""
        parts = list(text)
        while len(parts) > 1:
            rank, i = min((ranks.get(parts[k] + parts[k + 1], 1 << 60), k) for k in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            self._last = (parts[i], parts[i + 1])
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        self._texts = None
        return parts

    def follows(self, a: int, b: int) -> bool:
        """Whether pieces ``a`` and ``b`` next to each other stay as they are."""
        texts, limit = self.texts(), 1 << 60
        while True:
            both = self.ids.get(texts[a] + texts[b])
            if both is not None and self.rank[both] < limit:
                return False
            if self.rank[a] > self.rank[b]:  # the later merge is undone; on a tie the right one, made later
                limit, a = self.rank[a], self.split[a][1]
            elif self.split[b] is not None:
                limit, b = self.rank[b] + 1, self.split[b][0]
            else:
                return True

    def texts(self) -> list[str]:
        if self._texts is None:
            self._texts = list(self.ids)
        return self._texts


def read_vocabulary(path: str) -> Vocabulary:
    """Compiled from a byte-fallback merge model whose texts are taken as they are."""
    from sentencepiece import sentencepiece_model_pb2 as pb
    model = pb.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    norm, trained, kind = model.normalizer_spec, model.trainer_spec, pb.ModelProto.SentencePiece
    if (norm.name != "identity" or not norm.add_dummy_prefix or norm.remove_extra_whitespaces
            or trained.model_type != pb.TrainerSpec.BPE or not trained.byte_fallback or trained.treat_whitespace_as_suffix
            or any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in model.pieces)):
        raise ValueError(f"{path}: not a merge model with byte fallback over plain text")
    scores = {p.piece: p.score for p in model.pieces if p.type == kind.NORMAL}
    order = {s: i for i, s in enumerate(sorted(set(scores.values()), reverse=True))}
    return Vocabulary({p: order[s] for p, s in scores.items()})


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path(MODEL)


# An ending in one integer: place << 32 | (last piece before + 1) << 8 | (pieces since, less for later ones, + ZERO).
State = tuple[int, ...]
ZERO = 128
START: State = (ZERO,)


class Transducer:
    """States and transitions met so far; a state is also a tuple that any worker understands."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.keys: list[State] = []
        self.number: dict[State, int] = {}
        self.steps: list[dict[str, tuple[int, int]]] = []
        self.made = 0
        self.pairs: dict[int, bool] = {}
        self.stretches: dict[str, int] = {}
        self.reset = self.keys[self._next(START, SPACE)[0]]

    def _state(self, key: State) -> int:
        s = self.number.get(key)
        if s is None:
            s = self.number[key] = len(self.keys)
            self.keys.append(key)
            self.steps.append({})
        return s

    def _next(self, key: State, c: str) -> tuple[int, int]:
        """The next state and the change of the number of pieces."""
        v = self.v
        places = v.children.get(c)
        if places is None or places.get(0) is None or v.piece_at[places[0]] == ANY:
            return self._state(START), len(c.encode("utf-8", "surrogatepass"))
        moved, last, change = [], ANY, 0
        for ending in key:
            at = places.get(ending >> 32)
            if at is None:
                continue
            rest = ending & 0xFFFFFFFF
            before = rest >> 8
            if c == SPACE and before and ending == rest and not v.ends_in_space[before - 1]:
                before, rest = 0, rest & 255
            piece = v.piece_at[at]
            if piece >= 0 and last < 0 and (not before or self._follows(before - 1, piece)):
                last, change = piece, (rest & 255) - ZERO + 1
            if v.inner[at]:
                moved.append(at << 32 | rest)
        if change:
            moved = [m - change for m in moved]
        moved.append((last + 1) << 8 | ZERO)
        return self._state(tuple(moved)), change

    def _follows(self, a: int, b: int) -> bool:
        k = a << 32 | b
        known = self.pairs.get(k)
        if known is None:
            known = self.pairs[k] = self.v.follows(a, b)
        return known

    def run(self, key: State, text: str) -> tuple[State, int]:
        """The state after ``text`` and the change of the number of pieces."""
        s, n, steps = self._state(key), 0, self.steps
        for c in text:
            step = steps[s].get(c)
            if step is None:
                step = self._make(s, c)
            s, d = step
            n += d
        return self.keys[s], n

    def _make(self, s: int, c: str) -> tuple[int, int]:
        key = self.keys[s]
        self.made += 1
        if self.made + len(self.pairs) > STATES:
            self.made = 1
            for kept in (self.keys, self.number, self.steps, self.pairs):
                kept.clear()
            s = self._state(key)
        self.steps[s][c] = step = self._next(key, c)
        return step

    def between_resets(self, stretches: Iterable[str]) -> int:
        """Pieces of stretches that each stand behind a reset, whose space counts with them."""
        known, n = self.stretches, 0
        for x in stretches:
            m = known.get(x)
            if m is None:
                if len(known) >= STRETCHES:
                    known.clear()
                m = 1 + self.run(self.reset, x)[1]
                if len(x) <= 64:
                    known[x] = m
            n += m
        return n

    def count(self, text: str | None) -> int:
        """Pieces of a whole text, a space put before it."""
        return self.between_resets(cut(text.replace(" ", SPACE))) if text else 0

    def chunk_map(self, chunk: str) -> tuple[str, int, State | None]:
        """(head, n, leaving state, or None if there is no reset) of a stretch of a text."""
        head, *rest = cut(chunk.replace(" ", SPACE))
        if not rest:
            return head, 0, None
        return head, self.between_resets(rest), self.run(self.reset, rest[-1])[0]

    def together(self, maps: Iterable[tuple[str, int, State | None]]) -> tuple[str, int, State | None]:
        """The map of neighbouring stretches."""
        heads, n, leaving = [], 0, None
        for head, m, state in maps:
            if leaving is None:
                heads.append(head)
                leaving = state
            else:
                after, d = self.run(leaving, head)
                n += d
                leaving = after if state is None else state
            n += m
        return "".join(heads), n, leaving

    def total(self, head: str, n: int) -> int:
        """Pieces of a text from its map."""
        return n + self.run(START, SPACE + head)[1]


_reset = re.compile(f"(?<=[^{SPACE}]){SPACE}").split


def cut(text: str) -> list[str]:
    """``text`` cut at its resets, without their spaces."""
    return _reset(text) if SPACE * 2 in text or text[:1] == SPACE else text.split(SPACE)


MAPS = T.StructType([T.StructField("row", T.LongType()), T.StructField("chunk", T.LongType()),
                     T.StructField("head", T.StringType()), T.StructField("n", T.LongType()),
                     T.StructField("leaving", T.ArrayType(T.LongType()))])


def _long_counts(docs: DataFrame, shared, chunk: int) -> DataFrame:
    """row, n_tokens of texts longer than a chunk: maps of their chunks, put together level by level."""
    def cut_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist(), strict=True):
                parts = [text[i:i + chunk] for i in range(0, len(text), chunk)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row] * len(parts)), pa.array(range(len(parts)), pa.int64()), pa.array(parts)],
                    ["row", "chunk", "text"])

    def map_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Transducer(shared.value)
        for batch in slices(batches, "text", BATCH_BYTES):
            head, n, leaving = zip(*map(own.chunk_map, batch.column("text").to_pylist()), strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("chunk"), pa.array(head), pa.array(n, pa.int64()),
                 pa.array(leaving, pa.list_(pa.int64()))], MAPS.names)

    def join_maps(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("chunk")
        head, n, leaving = Transducer(shared.value).together(
            zip(group["head"], map(int, group["n"]),
                [None if x is None else tuple(map(int, x)) for x in group["leaving"]], strict=True))
        return pd.DataFrame({"row": [group["row"].iloc[0]], "chunk": [group["chunk"].iloc[0] // FAN],
                             "head": [head], "n": [n], "leaving": [leaving]})

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Transducer(shared.value)
        for batch in batches:
            said = [own.total(h, n) for h, n in zip(batch.column("head").to_pylist(), batch.column("n").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(said, pa.int64())], ["row", "n_tokens"])

    chunks = docs.select("row", "text").mapInArrow(cut_texts, "row long, chunk long, text string")
    maps = chunks.repartition("row", "chunk").mapInArrow(map_chunks, MAPS)
    for _ in range(LEVELS):
        maps = maps.groupBy("row", F.floor(F.col("chunk") / FAN).alias("block")).applyInPandas(join_maps, MAPS)
    return maps.mapInArrow(finish, "row long, n_tokens long")


def counts(docs: DataFrame, path: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_bytes and n_tokens of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path or default_model()))
    short_out = T.StructType([docs.schema["doc_id"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Transducer(shared.value)
        for batch in slices(batches, "text", BATCH_BYTES):
            said = [own.count(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(said, pa.int64())],
                                             ["doc_id", "n_bytes", "n_tokens"])

    src = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text",
                      F.monotonically_increasing_id().alias("row"))
    is_long = F.coalesce(F.length("text") > chunk, F.lit(False))
    short = src.filter(~is_long).select("doc_id", "n_bytes", "text").mapInArrow(run, short_out)
    long = src.filter(is_long)
    said = long.select("row", "doc_id", "n_bytes").join(_long_counts(long, shared, chunk), "row")
    return short.unionByName(said.select("doc_id", "n_bytes", "n_tokens"))


def digest(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document."""
    return counts(docs, path).withColumn("over_limit", F.col("n_tokens") > limit)
