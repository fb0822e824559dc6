"""Conversation repair, token counts and vector codes against brute force, on small tables with every awkward case."""

from __future__ import annotations

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from adledger.llm import bpe, conversations, decontaminate, langid, pseudonyms, tokencounts, training_order, vectorcodes

rng = random.Random(11)
SPACES = " \t\n\x0b\x0c\r"


def sha(said: str) -> str:
    return hashlib.sha256(said.encode()).hexdigest()


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- conversations

def edits(code: str, state: str):
    """(initial, cost, next state) by the rules as stated; states '', s, u, a."""
    after = "a" if state == "u" else "u"
    yield "D", 2, state
    if code != "d":
        dear = 5 if code.isupper() else 0
        if code.lower() == after or (code.lower() == "s" and state == ""):
            yield "K", dear, code.lower()
        yield "R", 1 + dear, after


def cheapest(codes: str) -> tuple[int, str]:
    """(cost, audit) from the end backwards over all edits."""
    best = {"": (0, ""), "a": (0, ""), "s": (10, "II"), "u": (5, "I")}
    for code in reversed(codes):
        now = {q: min((w + best[p][0], e + best[p][1]) for e, w, p in edits(code, q)) for q in ("", "s", "u", "a")}
        for _ in range(3):
            for q in now:
                p = "a" if q == "u" else "u"
                now[q] = min(now[q], (5 + now[p][0], "I" + now[p][1]))
        best = now
    return best[""]


def repaired_by_hand(rows):
    convs = {}
    for conv, turn, role, text in rows:
        kept = convs.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        said = [" " if x is None else str(x) for x in (conv, turn)]
        hit = zlib.crc32(":".join(said).encode()) % 20
        if hit:
            text = "" if hit == 1 else "".join(c for c in text if c not in ".!?") if hit == 2 else text
            kept += [(turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    for conv, kept in convs.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns, seen, codes, found = [r[0] for r in kept if r[0] is not None], set(), "", []
        for _, role, text in kept:
            last, initial = text.rstrip(SPACES)[-1:], role[:1] if role[:1] in ("s", "u", "a") else "x"
            found.append("blank" if not last else "duplicate" if (role, text) in seen else "cut" if last not in ".!?" else "")
            codes += {"": initial, "cut": initial.upper()}.get(found[-1], "d")
            seen.add((role, text))
        cost, audit = cheapest(codes)
        lines, rest, prev = [], iter(kept), ""
        for e in audit:
            _, role, text = next(rest) if e != "I" else (None, "", "")
            if e != "D":
                role = role if e == "K" else "assistant" if prev == "u" else "user"
                lines.append(f"{role}:{text}")
                prev = role[0]
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(kept, kept[1:])]
        yield (conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, found.count("blank"),
               found.count("duplicate"), found.count("cut"), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
               sha("\n".join(lines)))


def talk(spark):
    roles = ["user", "assistant", "system", "tool", "", None, "User"]
    texts = ["Yes.", "no", "What?", "", " \t", None, "Stop! \n", "ok\x0b", "ž.", "long " * 3000 + "."]
    rows = [(c, t, rng.choice(roles[:2] if rng.random() < .6 else roles), rng.choice(texts))
            for c in [*range(60), None] for t in [*range(rng.randrange(9)), *([None] * rng.randrange(2)), 20]]
    rows += rows[::17] + rows[::17]
    rows += [(1000, t, "user" if t % 2 else "assistant", f"{t} is said." if t % 5 else "Same.") for t in range(300)]
    rows += [(1001, 7, "user", "The very same.")] * 40
    return rows, spark.createDataFrame([(*r, "x", 1) for r in rows],
                                       "conv_id long, turn long, role string, text string, `n chars` string, codes int")


@pytest.mark.parametrize("segment", [3, 512])
def test_repair_equals_the_stated_rules(spark, segment):
    rows, df = talk(spark)
    assert rows_of(conversations.digest(df, segment)) == sorted(repaired_by_hand(rows), key=repr)
    assert conversations.digest(df.where("false"), segment).count() == 0


def test_least_audit_from_any_state_and_cut_anywhere():
    for k in range(3000):
        codes = "".join(rng.choice("suaxSUAXd" if k % 2 else "sua") for _ in range(rng.randrange(12)))
        cost, audit, state = conversations.least_audit(codes)
        want = cheapest(codes)
        assert (cost, audit + "I" * (conversations.END[state] // 5)) == want
        size = rng.randrange(1, 5)
        parts, ends, end = [codes[i:i + size] for i in range(0, len(codes), size)], [], list(conversations.END)
        for part in reversed(parts):
            ends.insert(0, end)
            costs = conversations.seam_costs(part)
            end = [min(costs[4 * q + p] + end[p] for p in range(4)) for q in range(4)]
        assert end[0] == want[0]
        state, said = 0, ""
        for part, after in zip(parts, ends, strict=True):
            _, audit, state = conversations.least_audit(part, state, tuple(after))
            said += audit
        assert said + "I" * (conversations.END[state] // 5) == want[1]


# --- token counts

@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=tokencounts.default_model())


def odd_texts(pieces: list[str]) -> list[str]:
    draw = [lambda: rng.choice("ab "), lambda: rng.choice(pieces), lambda: rng.choice("aAtThHeE .,\n\té日1"),
            lambda: " " * rng.randrange(40) + rng.choice(pieces),
            lambda: rng.choice(["=", "-", "--", "//", "<s>", "</s>", "<unk>", "<0x0A>", " ", "__", "▁", "🎉", "\0", "\x85"])]
    return ["".join(make() for _ in range(rng.randrange(30))) for make in draw for _ in range(150)]


def test_counts_equal_the_library_whole_and_in_chunks(library):
    vocabulary = tokencounts.read_vocabulary(tokencounts.default_model())
    own = tokencounts.Transducer(vocabulary)
    for text in [*odd_texts(list(vocabulary.ids)), "A" * 3000, " " * 100, "=" * 999 + " " + "-" * 999]:
        n = len(library.encode(text))
        assert own.count(text) == n
        for size in (1, 2, 7, 50):
            if text:
                head, m, _ = own.together([own.chunk_map(text[i:i + size]) for i in range(0, len(text), size)])
                assert own.total(head, m) == n


def test_counts_do_not_depend_on_what_is_kept(library, monkeypatch):
    monkeypatch.setattr(tokencounts, "STATES", 40)
    monkeypatch.setattr(tokencounts, "STRETCHES", 5)
    own = tokencounts.Transducer(tokencounts.read_vocabulary(tokencounts.default_model()))
    for text in ("the quick brown fox jumps over the lazy dog " * 5, "aéiou" * 50, "日本語 texts and more"):
        assert own.count(text) == len(library.encode(text))


def test_counts_on_spark(spark, library):
    texts = [None, "", " ", "one", "a  b\tc\n d ", "x" * 5000, "word " * 3000, "日本語🎉" * 700, " lead", "-" * 2500 + " y"]
    rows = [*enumerate(texts), (3, "one"), (None, "word " * 3000), (6, texts[6])]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, `n chars` string, row int")
    want = sorted(((i, len((t or "").encode()), len(library.encode(t)) if t else 0) for i, t in rows), key=repr)
    for chunk in (64, 1000, tokencounts.CHUNK):
        assert rows_of(tokencounts.counts(df, chunk=chunk)) == want
    got = tokencounts.digest(df)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "bigint", "bigint", "boolean"]
    assert all(r.over_limit == (r.n_tokens > 4096) for r in got.collect())
    assert tokencounts.digest(df.where("false")).count() == 0


def test_a_vocabulary_without_resets_is_refused():
    with pytest.raises(ValueError):
        tokencounts.Vocabulary({"a": 9, "▁": 8, "a▁": 0})


# --- vector codes

def coded_by_hand(rows, rounds=4):
    fit = []
    for i, v, label in rows:
        if v and all(c is not None and math.isfinite(c) for c in v) and len(v) % 4 == 0:
            x = [math.floor(1024 * c) for c in v]
            if all(abs(1024 * c) < 1 << 26 for c in v):
                fit.append((i, x, label))
    fit.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not fit:
        return []
    fit = [r for r in fit if len(r[1]) == len(fit[0][1])]
    w = len(fit[0][1]) // 4
    cuts = [[r[1][p * w:p * w + w] for r in fit] for p in range(4)]
    books = [[list(x) for x in c[:256]] for c in cuts]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(4):
            mine = {}
            for x in cuts[p]:
                mine.setdefault(near(x, books[p])[1], []).append(x)
            for k, xs in mine.items():
                books[p][k] = [sum(c) // len(xs) for c in zip(*xs, strict=True)]
    found = [[near(cuts[p][k], books[p]) for p in range(4)] for k in range(len(fit))]
    by_label = {}
    for r, f in zip(fit, found, strict=True):
        by_label[r[2]] = by_label.get(r[2], 0) + sum(d for d, _ in f)
    h = sha(",".join(str(c) for book in books for e in book for c in e))
    return [(r[0], "".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f), by_label[r[2]], h)
            for r, f in zip(fit, found, strict=True)]


def vectors():
    r = np.random.default_rng(4)
    rows = [(int(i), r.normal(0, .1, 8).tolist(), int(i) % 3 if i % 7 else None) for i in r.permutation(420)]
    rows += [(1000 + i, rows[0][1], 1) for i in range(150)] + [(1200 + i, [.25] * 8, 2) for i in range(9)]
    return rows + [(5, [.5] * 8, 1), (None, [-.125] * 8, None), (2000, None, 1), (2001, [], 1), (2002, [1.0, None] * 4, 1),
                   (2003, [float("nan")] * 8, 1), (2004, [float("-inf")] * 8, 1), (2005, [.1] * 4, 1), (2006, [.1] * 6, 1),
                   (2007, [1e9] * 8, 1), (2008, [60000.0] * 8, 1)]


@pytest.mark.parametrize("width", [None, 1, 37, 5000])
def test_codes_equal_the_nearest_entries(spark, width):
    rows = vectors()
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, codes string")
    assert rows_of(vectorcodes.digest(df, width=width)) == sorted(coded_by_hand(rows), key=repr)


def test_codes_of_few_and_no_rows(spark):
    few = [(3, [.5, .25, .125, 1.0], None), (1, [.5, .25, .125, -1.0], None), (2, [.5, .25, .125, 1.0], 7)]
    df = spark.createDataFrame(few, "vec_id long, embedding array<float>, label int")
    assert rows_of(vectorcodes.digest(df)) == sorted(coded_by_hand(few), key=repr)
    assert vectorcodes.digest(df.where("false")).count() == 0


def test_cells_keep_every_nearest_entry_and_leave_some_out():
    r = np.random.default_rng(9)
    entries, parts = r.integers(-300, 300, (64, 3)), r.integers(-400, 400, (3000, 3))
    grid = vectorcodes.Grid(entries, 40)
    found, dist = grid.nearest(parts)
    all_of = ((parts[:, None, :] - entries[None]) ** 2).sum(-1)
    assert (found == all_of.argmin(1)).all() and (dist == all_of.min(1)).all()
    assert np.mean([len(c) for c in grid.cells.values()]) < 32


# --- faults of earlier rounds

def luhn(number: str) -> bool:
    twice = [int(c) * (2 - (k + len(number)) % 2) for k, c in enumerate(number)]
    return sum(t // 10 + t % 10 for t in twice) % 10 == 0


def test_tables_of_numbers_hold_no_cards(spark):
    two = [f"{rng.randrange(100):02d}" for _ in range(1000)]
    prices = [f"{rng.randrange(1000)}.{rng.randrange(100):02d}" for _ in range(500)]
    texts = [" ".join(two), " ".join(prices), " ".join(f"{rng.randrange(1000):03d}" for _ in range(1000)), "-".join(two[:300])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r for r in pseudonyms.digest(df).collect()}
    assert all(out[i].text == t and out[i].n_values == 0 for i, t in enumerate(texts))


def test_cards_in_one_piece_or_grouped_as_usual_go(spark):
    made = [next(n for d in range(10) if luhn(n := f"4{rng.randrange(10 ** (k - 2)):0{k - 2}d}{d}")) for k in (13, 15, 16, 19)]
    amex, visa, long = made[1], made[2], made[3]
    said = [*made, " ".join(visa[k:k + 4] for k in range(0, 16, 4)), f"{amex[:4]}-{amex[4:10]}-{amex[10:]}",
            " ".join([*(long[k:k + 4] for k in range(0, 16, 4)), long[16:]])]
    df = spark.createDataFrame([(i, f"pay {x} now") for i, x in enumerate(said)], "doc_id long, text string")
    for r in pseudonyms.digest(df).collect():
        assert r.kinds == "card" and said[r.doc_id] not in r.text and luhn("".join(filter(str.isdigit, r.text))), (said[r.doc_id], r)


def test_extra_columns_of_any_name_and_type_go_along(spark):
    docs = spark.sql("""select id as doc_id, concat('the cat number ', id, ' sat on a mat of ten long words here') as text,
        'en' as lang, id as `n chars`, map('a', id) as `m-ap`, array(id) as `a.b`, 1 as h, 2 as row from range(40)""")
    benchmark = spark.sql("select id as item_id, concat('the cat number ', id, ' sat on a mat of ten long words') as text from range(3)")
    assert langid.predict(docs, langid.fit(docs)).select("row.*").columns == docs.columns
    coded = bpe.decode(bpe.encode(docs).select("row.*", "ids"))
    assert coded.filter(coded.decoded.cast("string") == coded["row.text"]).count() == 40
    for block in (4, 1000):
        kept = decontaminate.decontaminate(docs, benchmark, block=block)
        assert kept.columns == docs.columns and kept.count() == 37


def test_two_vocabularies_of_one_size_have_codecs_of_their_own(spark, tmp_path):
    import base64
    base = [bytes([i]) for i in range(256)]
    paths = []
    for name, pieces in (("one", [b"ab", b"abc"]), ("two", [b"bc", b"abc"])):
        paths.append(str(tmp_path / name))
        with open(paths[-1], "wb") as f:
            f.writelines(base64.b64encode(p) + b" %d\n" % i for i, p in enumerate(base + pieces))
    df = spark.createDataFrame([(1, "xab bc")], "doc_id long, text string").coalesce(1)
    _, pattern = bpe.default_vocabulary()
    got = [bpe.encode(df, p, pattern).first().ids for p in paths * 2]
    assert got == [[120, 256, 32, 98, 99], [120, 97, 98, 32, 256]] * 2
    assert training_order.sequences(df, 4, paths[0], pattern).count() == 2


def test_a_read_from_a_late_slot_opens_later_files_only(spark):
    docs = spark.range(400).selectExpr("id as doc_id", "concat('text number ', id) as text")
    written = training_order.stage_table(training_order.shards(training_order.sequences(docs, 8), per_shard=5), "ranges")
    named = written.selectExpr("_metadata.file_name as f", "shard").groupBy("f")
    spans = sorted((r.low, r.high) for r in named.agg(F.min("shard").alias("low"), F.max("shard").alias("high")).collect())
    assert len(spans) > 3 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
