"""Damage and structure repair of conversations, by bidirectional Dijkstra over the edit lattice.

A repaired conversation's role initials are ``(s?(ua)+)?``.  The lattice has a
place for each row boundary and state of that pattern; edges are the edits: Keep
(0), Rerole to user or assistant (1), Delete (2, the only one of a blank or
duplicate row), each of the first two 5 dearer on a truncated row, and Insert (5)
of an empty user or assistant text.  A heap from the start and one from the end
grow until the least keys of both add up to more than the best crossing, so all
crossings of that cost are finished; of the paths through these the one of the
ASCII-least audit (the edits' initials) is taken.  From a place each initial
leads to one place only, so this is the least initial at every step that leads
to the end at least cost.

On Spark: equal rows are counted first, so a repeated row is one row with a
count.  Rows are sorted by ranges of (conversation, turn, role, text), and each
task packs neighbouring rows of a conversation into segments of ``SEGMENT`` rows
or ``SEGMENT_BYTES`` of text, written to the shared folder.  A conversation of
one segment is solved by itself.  One of many is not gathered: each segment gives
its least costs between the four states (16 numbers), from which the costs to the
end at each seam follow, backwards; with these each segment is solved alone.  Only
the SHA-256 of a repaired text runs through a conversation's segments in order, one
at a time.

Defined cases: null conversation ids are one conversation.  Nulls of role and
text, and of ids and turns within the damage key, are one space.  Rows of one
turn come by role, then text, repeated rows next to each other.  Null turns come
first and don't count for gaps.  Roles with other initials than s, u, a fit
nowhere and are reroled or deleted.  A conversation without rows after the
damage has zeros, an empty audit and the hash of the empty string.  An empty
table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adledger.llm.common import SPACES, slices
from adledger.session import stage_table

SEGMENT, SEGMENT_BYTES, BATCH_BYTES = 512, 1 << 20, 4 << 20
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
# States: nothing yet, after s, after u, after a.
NEW, S, U, A = range(4)
INF = 1 << 60
# Cost from each state to the end behind the last row: inserts only.
END = (0, 2 * INSERT, INSERT, 0)
# The state after u or a: what may come next from each state, and its role.
AFTER = (U, U, A, U)
ROLE = {S: "system", U: "user", A: "assistant"}
# A row's code: its role's initial (x: any other), in capitals if it is truncated; d if it must be deleted.
CODES = "suaxSUAXd"


def _row_edges(code: str) -> list[list[tuple[str, int, int]]]:
    """Of each state: (initial, cost, next state) of the edits of such a row, by initial."""
    out = []
    for q in range(4):
        edges = [("D", DELETE, q)]
        if code != "d":
            dear, role = (TRUNCATED if code.isupper() else 0), code.lower()
            kept = AFTER[q] if role == "ua"[AFTER[q] - U] else S if role == "s" and q == NEW else None
            if kept is not None:
                edges.append(("K", KEEP + dear, kept))
            edges.append(("R", REROLE + dear, AFTER[q]))
        out.append(edges)
    return out


FORWARD = {c: _row_edges(c) for c in CODES}
REVERSE = {c: [[(w, q) for q in range(4) for _, w, to in FORWARD[c][q] if to == p] for p in range(4)] for c in CODES}
INSERTED_FROM = [[q for q in range(4) if AFTER[q] == p] for p in range(4)]


def _out(codes: str, x: int) -> list[tuple[str, int, int]]:
    """Edges of place ``x`` (four times the rows before it, plus the state); none behind the last row."""
    i, q = x >> 2, x & 3
    if i == len(codes):
        return []
    return [("I", INSERT, i << 2 | AFTER[q]), *((e, w, (i + 1) << 2 | p) for e, w, p in FORWARD[codes[i]][q])]


def _into(codes: str, x: int) -> list[tuple[int, int]]:
    i, q = x >> 2, x & 3
    edges = [] if i == len(codes) else [(INSERT, i << 2 | p) for p in INSERTED_FROM[q]]
    return edges + ([(w, (i - 1) << 2 | p) for w, p in REVERSE[codes[i - 1]][q]] if i else [])


def least_audit(codes: str, state: int = NEW, end: tuple[int, ...] = END) -> tuple[int, str, int]:
    """(cost, audit, state behind the last row) of the least path from ``state``, ``end`` being the costs from there on."""
    start, last = state, len(codes) << 2
    ahead, back = {start: 0}, {last | q: c for q, c in enumerate(end) if c < INF}
    heaps = [(0, start)], [(c, x) for x, c in back.items()]
    heapq.heapify(heaps[1])
    best = back.get(start, INF)
    while True:
        top, bottom = (h[0][0] if h else None for h in heaps)
        if top is None and bottom is None:
            break
        if (top or 0) + (bottom or 0) > best:
            break
        if bottom is None or (top is not None and top <= bottom):
            d, x = heapq.heappop(heaps[0])
            if d > ahead[x]:
                continue
            for _, w, y in _out(codes, x):
                if d + w < ahead.get(y, INF):
                    ahead[y] = d + w
                    heapq.heappush(heaps[0], (d + w, y))
                    best = min(best, d + w + back.get(y, INF))
        else:
            d, x = heapq.heappop(heaps[1])
            if d > back[x]:
                continue
            for w, y in _into(codes, x):
                if d + w < back.get(y, INF):
                    back[y] = d + w
                    heapq.heappush(heaps[1], (d + w, y))
                    best = min(best, d + w + ahead.get(y, INF))
    top, bottom = (h[0][0] if h else INF for h in heaps)
    # Below the heaps' least keys all costs are final, and behind the last row; every cheapest path crosses from one
    # side to the other.
    ahead = {x: c for x, c in ahead.items() if c < top}
    back = {x: c for x, c in back.items() if c < bottom or x >= last}
    good = {x for x, c in ahead.items()
            if c + back.get(x, INF) == best or any(c + w + back.get(y, INF) == best for _, w, y in _out(codes, x))}
    waiting = list(good)
    while waiting:
        y = waiting.pop()
        for w, x in _into(codes, y):
            if x not in good and x in ahead and ahead[x] + w == ahead[y]:
                good.add(x)
                waiting.append(x)
    audit, x, spent = [], start, 0
    while x < last:
        e, w, x = min((e, w, y) for e, w, y in _out(codes, x)
                      if spent + w + back.get(y, INF) == best or (y in good and ahead[y] == spent + w))
        audit.append(e)
        spent += w
    return best, "".join(audit), x & 3


def seam_costs(codes: str) -> list[int]:
    """Least costs from each state before the rows to each state right behind the last one (16 numbers, ``INF``: no way)."""
    out = []
    for start in range(4):
        now = [0 if q == start else INF for q in range(4)]
        for c in codes:
            for q in (NEW, S, A, U, A):  # an insert, or two
                now[AFTER[q]] = min(now[AFTER[q]], now[q] + INSERT)
            after = [INF] * 4
            for q in range(4):
                for _, w, p in FORWARD[c][q]:
                    after[p] = min(after[p], now[q] + w)
            now = after
        out += [min(c, INF) for c in now]
    return out


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: the rows after the damage; dropped ones leave a row of no copies."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    src = rows.select("conv_id", "turn", said[2].alias("role"), said[3].alias("text"),
                      (F.crc32(F.concat(said[0], F.lit(":"), said[1])) % 20).alias("hit"))
    hit, gone = F.col("hit"), F.col("hit") == 0
    return src.select(
        "conv_id", F.when(~gone, F.col("turn")).alias("turn"),
        F.when(gone, "").when(hit == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(gone | (hit == 1), "").when(hit == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(gone, 0).when(hit == 3, 2).otherwise(1).cast("long").alias("copies"))


def faults(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text, copies) counted, with ``fault`` of the first copy: blank, duplicate, truncated or null.

    Further copies are duplicates, but blank ones are blank.
    """
    counted = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    kept = F.rtrim(F.col("text"), F.lit(SPACES))
    marked = counted.select("*", (kept == "").alias("blank"), (~F.substring(kept, -1, 1).isin(".", "!", "?")).alias("cut"),
                            F.sha2(F.concat_ws("\n", F.length("role").cast("string"), "role", "text"), 256).alias("said"))
    # Turns at which something is said again: few rows, found from counts that are added up before the shuffle.
    at = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    again = (marked.filter(~F.col("blank") & (F.col("copies") > 0)).groupBy("conv_id", "said")
                   .agg(F.min(at).alias("first"), F.count("*").alias("n")).filter("n > 1")
                   .select(F.col("conv_id").alias("of"), F.col("said").alias("what"), "first"))
    later = F.coalesce(F.col("first.known") & (~F.col("turn").eqNullSafe(F.col("first.turn"))), F.lit(False)) | F.coalesce(
        ~F.col("first.known") & F.col("turn").isNotNull(), F.lit(False))
    joined = marked.join(again, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("said") == F.col("what")), "left")
    return joined.select("conv_id", "turn", "role", "text", "copies",
                         F.when(F.col("blank"), "blank").when(later, "duplicate").when(F.col("cut"), "truncated").alias("fault"))


def _segments_schema(rows: DataFrame) -> T.StructType:
    long, text = T.LongType(), T.StringType()
    cols = [("codes", text), ("roles", T.ArrayType(text)), ("texts", T.ArrayType(text)), ("first", text), ("last", text),
            ("low", long), ("high", long), ("turns", long), ("blank", long), ("duplicate", long),
            ("truncated", long), ("illegal", long)]
    return T.StructType([T.StructField("conv_id", rows.schema["conv_id"].dataType), T.StructField("part", long),
                         T.StructField("seq", long), *(T.StructField(*c) for c in cols)])


class _Segment:
    """Neighbouring rows of a conversation, being packed."""

    def __init__(self, conv, part: int, seq: int) -> None:
        self.conv, self.part, self.seq, self.size = conv, part, seq, 0
        self.codes: list[str] = []
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.first = self.last = ""
        self.low = self.high = None
        self.turns, self.illegal = 0, 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}

    def add(self, turn, role: str, text: str, fault: str | None) -> None:
        initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        if self.last:
            self.illegal += self.last + initial not in ("su", "ua", "au")
        else:
            self.first = initial
        self.last = initial
        if fault:
            self.faults[fault] += 1
        if fault in ("blank", "duplicate"):
            self.codes.append("d")
        else:
            self.codes.append(initial.upper() if fault else initial)
            self.roles.append(role)
            self.texts.append(text)
            self.size += len(role) + len(text)

    def row(self) -> tuple:
        return (self.conv, self.part, self.seq, "".join(self.codes), self.roles, self.texts, self.first, self.last,
                self.low, self.high, self.turns, *self.faults.values(), self.illegal)


def segments(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Neighbouring rows of each conversation packed; (part, seq) numbers all segments in the order of rows."""
    out = _segments_schema(rows)
    arrow = pa.schema([(f.name, _arrow_type(f.dataType)) for f in out])
    order = ("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, now, ready, held = TaskContext.get().partitionId(), 0, None, [], 0
        for batch in slices(batches, "text", BATCH_BYTES):
            for conv, turn, role, text, copies, fault in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for k in range(copies or 1):
                    if now is None or now.conv != conv or len(now.codes) >= segment or now.size >= SEGMENT_BYTES:
                        if now is not None:
                            ready.append(now.row())
                            held += now.size
                        now, seq = _Segment(conv, part, seq), seq + 1
                        if len(ready) >= 1000 or held > BATCH_BYTES:
                            yield _batch(ready, arrow)
                            ready, held = [], 0
                    if copies:
                        now.add(turn, role, text, "duplicate" if k and fault != "blank" else fault)
        if now is not None:
            ready.append(now.row())
        if ready:
            yield _batch(ready, arrow)

    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, out)


def _arrow_type(t: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(t)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)],
                                      schema=schema)


ENDS = T.StructType([T.StructField("of_part", T.LongType()), T.StructField("of_seq", T.LongType()),
                     T.StructField("costs", T.ArrayType(T.LongType()))])


def _ends(packed: DataFrame) -> DataFrame:
    """Of each segment that isn't its conversation's last: the least costs to the end from each state behind it."""
    many = packed.groupBy("conv_id").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("conv_id").alias("of"))
    own = packed.select("conv_id", "part", "seq", "codes").join(many, F.col("conv_id").eqNullSafe(F.col("of")), "left_semi")
    conv = T.StructField("conv_id", packed.schema["conv_id"].dataType)
    costs = T.StructType([conv, T.StructField("part", T.LongType()), T.StructField("seq", T.LongType()),
                          T.StructField("costs", T.ArrayType(T.LongType()))])

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), b.column("part"), b.column("seq"),
                 pa.array([seam_costs(c) for c in b.column("codes").to_pylist()], pa.list_(pa.int64()))], costs.names)

    def backwards(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["part", "seq"], ascending=False)
        end, out = list(END), []
        for part, seq, c in zip(group["part"], group["seq"], group["costs"], strict=True):
            out.append((part, seq, end))
            end = [min(INF, min(int(c[4 * q + p]) + end[p] for p in range(4))) for q in range(4)]
        return pd.DataFrame(out, columns=ENDS.names)

    return own.mapInArrow(between, costs).groupBy("conv_id").applyInPandas(backwards, ENDS)


NUMBERS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


class _Repair:
    """A conversation while its segments come by."""

    def __init__(self, conv) -> None:
        self.conv, self.state, self.audits, self.hash, self.lines = conv, NEW, [], hashlib.sha256(), 0
        self.sums = dict.fromkeys(("turns", "blank", "duplicate", "truncated", "illegal", "cost"), 0)
        self.low = self.high = None
        self.last = ""

    def add(self, r: dict) -> None:
        for k in ("turns", "blank", "duplicate", "truncated", "illegal"):
            self.sums[k] += r[k]
        if r["low"] is not None:
            self.low = r["low"] if self.low is None else self.low
            self.sums["turns"] -= self.high == r["low"]
            self.high = r["high"]
        if r["codes"] and self.last:
            self.sums["illegal"] += self.last + r["first"] not in ("su", "ua", "au")
        self.last = r["last"] or self.last
        left = tuple(r["costs"] or END)
        cost, audit, after = least_audit(r["codes"], self.state, left)
        self.sums["cost"] += cost - left[after]
        self._write(audit, r["codes"], zip(r["roles"], r["texts"], strict=True))
        self.audits.append(audit)

    def _write(self, audit: str, codes: str, kept: Iterator[tuple[str, str]]) -> None:
        row = 0
        for e in audit:
            role, text = "", ""
            if e != "I":
                if codes[row] != "d":
                    role, text = next(kept)
                row += 1
            if e == "D":
                continue
            self.state = S if e == "K" and role[:1] == "s" else AFTER[self.state]
            line = f"{role if e == 'K' else ROLE[self.state]}:{text}"
            self.hash.update((b"\n" if self.lines else b"") + line.encode("utf-8", "surrogatepass"))
            self.lines += 1

    def row(self) -> tuple:
        tail = "I" * (END[self.state] // INSERT)
        self._write(tail, "", iter(()))
        s = self.sums
        gaps = 0 if self.low is None else self.high - self.low + 1 - s["turns"]
        cost = s["cost"] + INSERT * len(tail)
        return (self.conv, gaps, s["blank"], s["duplicate"], s["truncated"], s["illegal"], cost,
                "".join(self.audits) + tail, self.hash.hexdigest())


def repair(packed: DataFrame) -> DataFrame:
    """One row a conversation: its faults, the cost and audit of its cheapest repair, and the repaired text's SHA-256."""
    out = T.StructType([T.StructField("conv_id", packed.schema["conv_id"].dataType),
                        *(T.StructField(n, T.LongType()) for n in NUMBERS),
                        T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])
    arrow = pa.schema([(f.name, _arrow_type(f.dataType)) for f in out])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            ready = []
            for i in range(0, batch.num_rows, 64):
                for r in batch.slice(i, 64).to_pylist():
                    if now is None or now.conv != r["conv_id"]:
                        if now is not None:
                            ready.append(now.row())
                        now = _Repair(r["conv_id"])
                    now.add(r)
            if ready:
                yield _batch(ready, arrow)
        if now is not None:
            yield _batch([now.row()], arrow)

    with_ends = packed.join(_ends(packed), (F.col("part") == F.col("of_part")) & (F.col("seq") == F.col("of_seq")), "left")
    dealt = with_ends.drop("of_part", "of_seq").repartition("conv_id")
    return dealt.sortWithinPartitions("conv_id", "part", "seq").mapInArrow(run, out)


def digest(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Every conversation of ``rows`` damaged, its faults counted, and repaired."""
    return repair(stage_table(segments(faults(damaged(rows)), segment), "conversation-segments"))
