"""Training-data operators against brute force, on small tables with every awkward case."""

from __future__ import annotations

import hashlib
import math
import random
import time
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from adledger.llm import (bitsliced, bpe, decontaminate, langid, licenses, linededup, pitman_yor, pseudonyms, simhash,
                          training_order)

WORDS = "the of and cat dog house tree river stone light dark über straße été niño".split()
rng = random.Random(5)


def prose(n: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n))


BENCH = [(1, prose(14)), (2, "Short item!"), (3, None), (4, ""), (5, prose(10)), (5, prose(12)), (None, "null id item")]
COPY = prose(60)
TEXTS = [None, "", " ", "\n\n", "one", "a  b\tc\n d ", COPY, COPY, COPY + " tail", prose(400), "x" * 3000,
         "SHARED line\n" + prose(8), *["  shared LINE \t\n" + prose(5) for _ in range(11)],
         "Licensed under CC BY-NC 4.0.\nAll rights reserved. GNU General Public License version 3",
         "the Apache License, Version 2.0 and the MIT license; cc by cc by",
         f"x {BENCH[0][1]} y", "we saw a SHORT, item here", f"{BENCH[4][1]}", "it's 's  日本語 🎉 1２\x1c\x85",
         "card 4539 1488 0343 6467 and 4539148803436467, ip 10.0.0.1 not 300.1.1.1, mail Ann.B9@site.example.org, "
         "ssn 219-09-9999 not 000-12-3456, day 2024-02-29 and 02/29/2024 not 2023-02-29, +1 (736) 555-2678, "
         "DE89 3704 0044 0532 0130 00 bad 4539148803436468"]
ROWS = [(i, t) for i, t in enumerate(TEXTS)] + [(6, COPY), (None, "one"), (None, None), (12, "again")]


@pytest.fixture(scope="module")
def docs(spark):
    langs = ["en", "de", None]
    return spark.createDataFrame(
        [(i, t, langs[k % 3], "s", k, "x", -1) for k, (i, t) in enumerate(ROWS)],
        "doc_id long, text string, lang string, source string, pos long, h1 string, row int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(BENCH, "item_id long, text string")


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols or df.columns) for r in df.collect()), key=repr)


def words(text):
    out, now = [], b""
    for c in (text or "").encode():
        c = c + 32 if 65 <= c <= 90 else c
        if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128:
            now += bytes([c])
        elif now:
            out.append(now)
            now = b""
    return out + [now] * bool(now)


def sha(x: bytes) -> str:
    return hashlib.sha256(x).hexdigest()


def test_top_k_equals_sorting_all_scores(spark):
    r = np.random.default_rng(1)
    vecs = [(int(i), r.normal(size=5).round(2).tolist()) for i in range(130)]
    vecs += [(200, vecs[0][1]), (0, vecs[0][1]), (20, [1.0] * 5), (220, [0.5] * 3), (240, [0.1] * 3), (300, []),
             (301, None), (302, [1.0, None, 1.0, 1.0, 1.0]), (303, [float("nan")] * 5), (None, [1.0] * 5)]
    df = spark.createDataFrame([(*v, "x") for v in vecs], "vec_id long, embedding array<double>, score string")
    ok = {(i, tuple(math.floor(64 * c) for c in v)) for i, v in vecs
          if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)}
    want = []
    for q, x in ok:
        if q % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in ok if i != q and len(x) == len(y))
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scored[:20])]
    got = bitsliced.search(df, bitsliced.F.col("vec_id") % 20 == 0, block_rows=30, block_queries=3)
    assert rows_of(got) == sorted(want, key=repr)
    assert bitsliced.digest(df.where("false")).count() == 0


def test_pitman_yor_counts_and_is_a_distribution(spark, docs):
    out = pitman_yor.score(docs, vocabulary=6).collect()
    train, want = Counter(), []
    for i, t in ROWS:
        if i is not None and zlib.crc32(str(i).encode()) % 10:
            train.update([*(t or "").encode().lower().split(), b""])
    n, v = sum(train.values()), len(train)
    for i, t in ROWS:
        toks = [*(t or "").encode().lower().split(), b""]
        base = sum(math.log10((train[w] + .1) / (n + .1 * (v + 1))) for w in toks)
        held = i is None or zlib.crc32(str(i).encode()) % 10 == 0
        want.append((i, held, len(toks), sum(train[w] > 0 for w in toks), n, round(base, 6)))
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert all(r.score < 0 and math.isfinite(r.score) for r in out)
    copies = {r.score for r in out if r.doc_id in (6, 7)}
    assert len({round(s, 9) for s in copies}) == 1
    assert pitman_yor.score(docs.where("false")).count() == 0


def test_pitman_yor_predictions_sum_to_one():
    counts = np.array([7, 5, 9, 4])
    pairs = {(0, 2): 4, (0, 3): 3, (1, 2): 5, (2, 0): 7, (2, 3): 1, (2, 1): 1, (3, 1): 4}
    state, law = {}, pitman_yor.CONTEXT
    r = np.random.default_rng(0)
    root = np.full(4, .25)
    for u in range(4):
        sizes = {w: [c] for (x, w), c in pairs.items() if x == u}
        tables = pitman_yor.reseat(list(sizes), list(sizes.values()), len(sizes), root.tolist(), law, r)
        assert tables == sum(map(len, sizes.values()))
        assert {w: sum(s) for w, s in sizes.items()} == {w: c for (x, w), c in pairs.items() if x == u}
        state[u] = sizes
    sent = np.zeros(4, np.int64)
    for sizes in state.values():
        for w, s in sizes.items():
            sent[w] += len(s)
    p, tables = pitman_yor.seat_root(sent, pitman_yor.ROOT, r)
    assert abs(p.sum() - 1) < 1e-12
    back = np.array([[(law[1] + law[0] * sum(map(len, state[u].values()))) / (law[1] + counts[u]) for u in range(4)]])
    model = pitman_yor.Model(back, p[None], counts)
    for u in range(4):
        own = np.array([sum(state[u].get(w, [])) - law[0] * len(state[u].get(w, [])) for w in range(4)])
        total = model.probability(np.full(4, u), np.arange(4), own).sum()
        assert abs(total - 1) < 1e-9


@pytest.mark.parametrize("n, p, others", [(12, .3, 3), (300, .02, 40), (2000, .3, 5)])
def test_pitman_yor_sweeps_reseat_every_customer(n, p, others):
    (d, theta), r = pitman_yor.CONTEXT, np.random.default_rng(1)
    most, log = min(n, 700), np.full(min(n, 700) + 1, -np.inf)  # of t tables: the generalised Stirling numbers
    log[1], t = 0.0, np.arange(min(n, 700) + 1)
    for c in range(1, n):
        with np.errstate(divide="ignore"):
            stay = log + np.log(np.maximum(c - d * t, 0))
        log = np.logaddexp(stay, np.concatenate([[-np.inf], log[:-1]]))
    log += np.concatenate([[0], np.cumsum(np.log((theta + d * (others + np.arange(most))) * p))])
    want = np.exp(log - log.max())
    want /= want.sum()
    mean, sd = (want * t).sum(), math.sqrt((want * t ** 2).sum() - (want * t).sum() ** 2)
    sizes, got = [[n]], []
    for _ in range(3000):
        tables = pitman_yor.reseat([0], sizes, others + len(sizes[0]), [p], (d, theta), r)
        assert sum(sizes[0]) == n and tables == others + len(sizes[0])
        got.append(len(sizes[0]))
    assert abs(np.mean(got[3:]) - mean) < .15 * sd and abs(np.std(got[3:]) / sd - 1) < .15
    # From a single table, three sweeps come near the law of the tables.
    starts = []
    for _ in range(60):
        sizes = [[n]]
        for _ in range(3):
            pitman_yor.reseat([0], sizes, others + len(sizes[0]), [p], (d, theta), r)
        starts.append(len(sizes[0]))
    assert abs(np.mean(starts) - mean) < sd


def test_pitman_yor_root_is_swept_from_its_last_seating():
    r, seats = np.random.default_rng(2), {}
    for customers in (np.array([5, 0, 900, 3]), np.array([0, 2, 700, 9]), np.array([1, 2, 1500, 9])):
        p, tables = pitman_yor.seat_root(customers, pitman_yor.ROOT, r, seats)
        assert abs(p.sum() - 1) < 1e-12 and tables == sum(map(len, seats.values()))
        assert {w: sum(s) for w, s in seats.items()} == {w: n for w, n in enumerate(customers.tolist()) if n}


def test_language_id_learns_and_handles_awkward_texts(spark, docs):
    r, rows = random.Random(3), []
    en, de = "the and with this that from house".split(), "der und mit das nicht haus strasse".split()
    for i in range(400):
        lang, v = (("en", en), ("de", de))[i % 2]
        rows.append((i, " ".join(r.choice(v) for _ in range(r.randint(3, 30))), lang))
    rows += [(400, None, "en"), (401, "123 ½ --", "de"), (402, "", None), (None, "und das haus", "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {x.doc_id: x for x in langid.digest(df).collect()}
    assert len(got) == len(rows)
    held = [i for i, _, _ in rows[:400] if got[i].held_out]
    assert held == [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([got[i].lang_pred == rows[i][2] for i in held]) > .97
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (400, 401, 402))
    assert got[None].lang_pred == "de" and all(0 <= x.score <= 1 for x in got.values())
    assert {x.lang_pred for x in langid.digest(df.withColumn("lang", langid.F.lit(None).cast("string"))).collect()} == {"und"}
    assert langid.digest(df.where("false")).count() == 0 and langid.digest(docs).count() == len(ROWS)


def test_language_id_has_examples_of_every_language_however_few_texts_are_labelled(spark):
    said = {"en": "the and with this that from house", "de": "der und mit das nicht haus strasse",
            "fr": "les avec dans pour cette maison rue", "fi": "talo katu tämä kanssa mutta ovat"}
    r, rows = random.Random(4), []
    for i in range(30000):
        # One text in a hundred is labelled, and five of the last language are in all.
        lang = ("en", "de", "fr")[i % 3] if i % 5000 else "fi"
        rows.append((i, " ".join(r.choice(said[lang].split()) for _ in range(12)), lang if i % 100 == i // 100 % 100 or lang == "fi" else None))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(8)
    model = langid.fit(df)
    assert model.langs == ["de", "en", "fi", "fr"] and all(np.abs(w).sum() > 0 for w in model.weights)
    texts = [(lang, " ".join(r.choice(v.split()) for _ in range(12))) for lang, v in said.items() for _ in range(50)]
    pred, score = model.predict([t for _, t in texts])
    assert np.mean([p == lang for p, (lang, _) in zip(pred, texts)]) > .97
    assert np.mean(np.array(score) >= .5) > .9
    # Shares of the sample go by labelled texts; a rare language has all its texts.
    quota = langid._quotas({"a": 10 ** 9, "b": 10 ** 6, "c": 30}, 2000)
    assert quota["c"] == langid.RANKS and 30 < 10 ** 6 * quota["b"] / langid.RANKS <= 40
    assert 1900 < 10 ** 9 * quota["a"] / langid.RANKS <= 2000


def test_license_scan_finds_every_base_place_and_suppresses_contained_ones(docs):
    got = rows_of(licenses.digest(docs), "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    want = []
    for i, t in ROWS:
        w, places = words(t), []
        for phrase, label in licenses.BASE:
            p = phrase.encode().split()
            places += [(k, label) for k in range(len(w)) if w[k:k + len(p)] == p]
        at = [k for k, _ in places]
        want.append((i, len(w), len(places), min(at, default=None), max(at, default=None),
                     ",".join(sorted({x for _, x in places}))))
    assert got == sorted(want, key=repr)
    labels = {r.doc_id: r.labels.split(",") for r in licenses.digest(docs).collect()}
    first = TEXTS.index(next(t for t in TEXTS if t and t.startswith("Licensed")))
    assert labels[first] == ["cc-by", "cc-by-nc", "gpl", "gpl-3.0", "reserved"]
    assert labels[first + 1] == ["apache-2.0", "cc-by", "mit"]
    assert licenses.digest(docs.where("false")).count() == 0
    assert len(licenses.rules()) >= 200


@pytest.mark.parametrize("block", [1_000_000, 4])
def test_decontamination_equals_comparing_all_windows(docs, benchmark, block):
    want = {}
    windows = [(str(i) if i is not None else None, tuple(w[k:k + 10])) for i, t in BENCH for w in [words(t)] if w
               for k in range(max(1, len(w) - 9))]
    for i, t in ROWS:
        w, hit, items = words(t), set(), set()
        for item, x in windows:
            for k in range(len(w) - len(x) + 1):
                if tuple(w[k:k + len(x)]) == x:
                    hit |= set(range(k, k + len(x)))
                    items |= {item} - {None}
        want.setdefault((i, len(w), len(hit), ",".join(sorted(items))), 0)
        want[i, len(w), len(hit), ",".join(sorted(items))] += 1
    got = Counter()
    for r in decontaminate.find_hits(docs, benchmark, block=block).collect():
        n = sum(z - a for a, z in decontaminate.covered(r["starts"], r["lengths"]))
        got[r["row"]["doc_id"], r["n_words"], n, ",".join(sorted(r["items"]))] += 1
    assert got == want
    kept = {r.doc_id: r.text for r in decontaminate.decontaminate(docs, benchmark, block=block).collect()}
    cut = TEXTS.index("we saw a SHORT, item here")
    assert kept[cut] == "we saw a  here" and TEXTS.index(BENCH[4][1]) not in kept and kept[9] == TEXTS[9]
    assert decontaminate.digest(docs.where("false"), benchmark).count() == 0
    assert not any(r.contaminated for r in decontaminate.digest(docs, benchmark.where("false")).collect())


def naive_fingerprint(text):
    w = (text or "").encode().lower().split()
    grams = [b" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def naive_components(ids, fps, bits):
    names = list(range(len(fps)))
    for _ in fps:
        for a in range(len(fps)):
            for b in range(a):
                if (fps[a] ^ fps[b]).bit_count() <= bits:
                    names[a] = names[b] = min(names[a], names[b])
    least = {}
    for k, i in zip(names, ids, strict=True):
        least[k] = min((x for x in (least.get(k), i) if x is not None), default=None)
    return [least[k] for k in names]


def test_simhash_equals_comparing_all_pairs(docs):
    fps = [naive_fingerprint(t) for _, t in ROWS]
    named = naive_components([i for i, _ in ROWS], fps, 4)
    want = sorted(((i, f"{f:016x}", c) for (i, _), f, c in zip(ROWS, fps, named, strict=True)), key=repr)
    assert rows_of(simhash.digest(docs)) == want
    assert simhash.digest(docs.where("false")).count() == 0


def test_one_row_of_each_group_stays(spark):
    import corpus_pipeline
    near = next(x for k in range(99) if 0 < (naive_fingerprint(COPY) ^ naive_fingerprint(x := f"{COPY} {k}")).bit_count() <= 4)
    rows = [(1, COPY), (1, COPY), (2, COPY), (None, COPY), (None, near), (None, prose(50)), (3, prose(70)), (3, prose(70)),
            (None, t := prose(90)), (None, t), (9, u := prose(80)), (9, u), (1, u), (4, None), (5, ""), (None, None)]
    rows = [(i, x, k) for k, (i, x) in enumerate(rows)]
    df = spark.createDataFrame(rows, "doc_id long, text string, key int").repartition(3)
    named = naive_components([k for *_, k in rows], [naive_fingerprint(x) for _, x, _ in rows], 4)
    groups = {}
    for (i, _, k), c in zip(rows, named):
        groups.setdefault(c, []).append((i is None, i or 0))
    got = corpus_pipeline.near_dedup(spark, df, "")
    assert got.columns == df.columns
    kept = [(named[r.key], (r.doc_id is None, r.doc_id or 0)) for r in got.collect()]
    assert sorted(kept) == sorted((c, min(ids)) for c, ids in groups.items())
    assert corpus_pipeline.near_dedup(spark, df.where("false"), "").count() == 0


@pytest.mark.parametrize("longest", [4096, 4])
def test_links_connect_just_what_near_pairs_connect(spark, longest):
    r, fps = random.Random(9), set()
    for _ in range(20):
        x = r.getrandbits(64)
        for _ in range(r.choice([1, 2, 12])):
            y = x
            for _ in range(r.randint(0, 5)):
                y ^= 1 << r.randrange(64)
            fps.add(y)
            x = y if r.random() < .3 else x
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    entries = spark.createDataFrame([(f,) for f in signed], "fp long")
    found = {r.u: r.v for r in simhash.components(simhash.links(entries, 4, longest)).collect()}
    want = naive_components(signed, fps, 4)
    assert [found.get(f, f) for f in signed] == want


def test_training_order_places_every_sequence_once_and_resumes(docs):
    written = training_order.shards(training_order.sequences(docs, 16), per_shard=7)
    path, pattern = bpe.default_vocabulary()
    codec = bpe.Codec(bpe.read_ranks(path), pattern)
    want = Counter()
    for i, t in ROWS:
        ids = [*codec.encode([t])[0].tolist(), len(codec.ranks)]
        for k in range(0, len(ids), 16):
            want[i, k // 16, bytes(np.array((ids[k:k + 16] + [0xFFFF] * 16)[:16], "<u2").tobytes())] += 1
    rows = training_order.read_from(written, 0, 7, 32).collect()
    assert Counter((r.doc_id, r.seq, bytes(r.payload)) for r in rows) == want
    assert sorted(r.slot for r in rows) == list(range(sum(want.values())))
    later = training_order.read_from(written, 23, 7, 32).collect()
    assert sorted(r.slot for r in later) == list(range(23, len(rows)))
    for n in (1, 2, 5, 1000):
        x = training_order.permuted(np.arange(n), n)
        assert sorted(x.tolist()) == list(range(n))
        assert training_order.permuted(x, n, back=True).tolist() == list(range(n))
    assert training_order.digest(docs.where("false")).count() == 0


def test_line_dedup_equals_counting_lines(docs):
    strip = " \t\n\x0b\x0c\r"
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(strip).translate(low)
    seen = {}
    for i, t in ROWS:
        for line in (t or "").split("\n"):
            seen.setdefault(key(line), set()).add(i)
    shared = {k for k, ids in seen.items() if k and len(ids - {None}) >= 10}
    want = []
    for i, t in ROWS:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in shared]
        want.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept).encode())))
    assert shared and rows_of(linededup.digest(docs)) == sorted(want, key=repr)
    kept = linededup.dedup_lines(docs).select("row.*")
    assert kept.columns == docs.columns and kept.count() == len(ROWS)
    assert linededup.digest(docs.where("false")).count() == 0


def test_pseudonyms_keep_format_and_links(docs):
    out = {r.doc_id: r for r in pseudonyms.digest(docs).collect()}
    old, new = TEXTS[-1], out[len(TEXTS) - 1].text
    assert len(new.split()) == len(old.split()) and out[len(TEXTS) - 1].n_values == 9
    for bad in ("300.1.1.1", "000-12-3456", "2023-02-29", "4539148803436468", "@site.example.org"):
        assert bad in new
    for good in ("4539148803436467", "10.0.0.1", "219-09-9999", "2024-02-29", "555-2678", "Ann.B9", "DE89 3704"):
        assert good not in new
    spaced, plain = new.split("card ")[1][:19], new.split(" and ")[1][:16]
    assert spaced.replace(" ", "") == plain  # equal values stay linked
    digits = [int(c) for c in reversed(plain)]
    assert sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0
    iban = new.split("DE")[1][:25].replace(" ", "")
    assert int(iban[2:] + "1314" + iban[:2]) % 97 == 1
    assert all(out[i].text == TEXTS[i] for i in range(10)) and out[0].n_values == 0
    assert pseudonyms.digest(docs.where("false")).count() == 0


def test_pseudonyms_beside_digits_and_capitals(spark):
    card, amex, iban = "4111 1111 1111 1111", "3782 822463 10005", "ES91 2100 0418 4502 0005 1332"
    cases = [  # text, what has to go, kinds, what stays
        (f"card {card} 12/27", [card], "card", "12/27"), (f"card {card} 123", [card], "card", " 123"),
        (f"card {card} 12/27 123 ok", [card], "card", "12/27 123 ok"), (f"no. 12 {card}", [card], "card", "no. 12 "),
        (f"7 {card} 99.50 USD", [card], "card", " 99.50 USD"), (f"12345 {card}", [card], "card", "12345 "),
        (f"{card} {amex} 1234", [card, amex], "card", " 1234"), (f"{card} 3rd", [card], "card", " 3rd"),
        (f"4111111111111111 12 {card}", ["4111111111111111", card], "card", " 12 "),
        (f"{card.replace(' ', '-')} 2024-02-29", [card.replace(" ", "-"), "2024-02-29"], "card,date", " "),
        (f"{card} 219-09-9999", [card, "219-09-9999"], "card,ssn", " "),
        (f"5 6 {card} 10.0.0.1", [card, "10.0.0.1"], "card,ip", "5 6 "),
        (f"{iban} EUR", [iban], "iban", " EUR"), (f"{iban} EUR 100", [iban], "iban", " EUR 100"),
        (f"{iban} 100", [iban], "iban", " 100"), (f"{iban} {card} 1", [iban, card], "card,iban", " 1"),
        (f"{iban.replace(' ', '')} USD", [iban.replace(" ", "")], "iban", " USD"),
        (f"+1 (736) 555-2678 {card}", ["555-2678", card], "card,phone", "+1 ("),
        ("+1 (736) 555-2678 2024 1000", ["555-2678"], "phone", "+1 ("),
        ("4539148803436468 12", [], "", "4539148803436468 12"), (f"{iban[:-1]}3 EUR", [], "", f"{iban[:-1]}3 EUR"),
        (" ".join(["0"] * 11 + ["1"]), [], "", "0 0")]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "doc_id long, text string")
    out = {r.doc_id: r for r in pseudonyms.digest(df).collect()}
    for i, (text, gone, kinds, stays) in enumerate(cases):
        assert (out[i].kinds, out[i].n_values) == (kinds, len(gone)), (text, out[i])
        assert (len(out[i].text) == len(text) or "ip" in kinds) and stays in out[i].text and not any(x in out[i].text for x in gone), (text, out[i])
        assert gone or out[i].text == text
    plain = pseudonyms.digest(spark.createDataFrame([(0, f"is {card} so")], "doc_id long, text string")).first().text
    assert out[0].text.startswith("card " + plain[3:-3])  # linked with the same card elsewhere


def test_permutations_are_one_to_one(spark):
    nums = spark.range(1000).select(pseudonyms.F.lpad(pseudonyms.F.col("id").cast("string"), 3, "0").alias("d"), "id")
    got = nums.select(pseudonyms.permute_digits(pseudonyms.F.col("d"), "k", "t"),
                      pseudonyms.permute_index(pseudonyms.F.col("id"), 1000, "k", "t")).collect()
    assert len({r[0] for r in got}) == 1000 and {r[1] for r in got} == set(range(1000))


def test_bpe_equals_the_library_and_round_trips(docs):
    import tiktoken
    path, pattern = bpe.default_vocabulary()
    ranks = bpe.read_ranks(path)
    encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, t in ROWS:
        ids = encoding.encode_ordinary(t or "")
        want.append((i, len(ids), sha(" ".join(map(str, ids)).encode()), sha((t or "").encode())))
    assert rows_of(bpe.digest(docs)) == sorted(want, key=repr)
    back = bpe.decode(bpe.encode(docs).select("row.doc_id", "row.text", "ids"))
    assert all(bytes(r.decoded) == (r.row.text or "").encode() for r in back.collect())
    assert bpe.digest(docs.where("false")).count() == 0
    codec, r = bpe.Codec(ranks, pattern), random.Random(1)
    texts = ["".join(r.choice("ab 'sdl\n\t \x1c\x85éß1２日🎉.,-\r") for _ in range(r.randint(0, 40))) for _ in range(3000)]
    texts += ["a" * 5000, " " * 300 + "x", "the" * 200]
    ids, ends = codec.encode(texts)
    assert [ids[a:z].tolist() for a, z in zip(ends, ends[1:])] == [encoding.encode_ordinary(t) for t in texts]


def test_bpe_cuts_the_stretches_of_a_batch_by_few_calls_and_remembers_their_pieces():
    import tiktoken
    path, pattern = bpe.default_vocabulary()
    ranks = bpe.read_ranks(path)
    encoding = tiktoken.Encoding("t", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    codec, calls, merged = bpe.Codec(ranks, pattern), [], []
    find, merge = codec.find, codec._merge
    codec.find = lambda s: calls.append(s) or find(s)
    codec._merge = lambda pieces, raw: merged.extend(pieces) or merge(pieces, raw)
    texts = [" ".join(f"qz{chr(97 + i % 26)}x{chr(97 + j % 26)}v, it's{i}\nZw{j}" for j in range(40)) for i in range(200)]
    texts += ["end \n", "tab\t x", " led", "a  b c", "\u00a0x y\u00a0", "nul \u2003 z", "q\n r"]
    for _ in range(2):
        ids, ends = codec.encode(texts)
        assert [ids[a:z].tolist() for a, z in zip(ends, ends[1:])] == [encoding.encode_ordinary(t) for t in texts]
    assert len(calls) < 1200 and len(merged) == len(set(merged)) > 100
    # More than 100,000 pieces stay known (0.10 GB of the check's texts bring several times as many to a task).
    codec.pieces.extend([f"known{i}" for i in range(150_000)], np.zeros(150_000, np.int32), np.arange(150_001))
    codec.encode(["one more"])
    assert "known7" in codec.pieces.at
    codec.close()


def test_pipeline_stages_equal_the_operators(spark, tmp_path):
    import corpus_pipeline
    src = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{src}/documents.parquet")
    now = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, src)
        if k < 4:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        before, now = now, spark.read.parquet(f"{tmp_path}/{name}")
        if name == "near_dedup":
            rows = before.select("doc_id", "text").collect()
            named = naive_components([r.doc_id for r in rows], [naive_fingerprint(r.text) for r in rows], 4)
            assert {r.doc_id for r in now.collect()} == set(named)
    path, pattern = bpe.default_vocabulary()
    texts = {r.doc_id: r.text for r in before.collect()}
    codec = bpe.Codec(bpe.read_ranks(path), pattern)
    assert {r.doc_id: r.ids for r in now.collect()} == {i: codec.encode([t])[0].tolist() for i, t in texts.items()}
    assert len(texts) > 100


def test_line_dedup_takes_a_long_text_in_proportion(spark):
    n = 200_000
    long = "\n".join("shared" if i % 2 else f"own {i}" for i in range(n))
    rows = [(0, long), (1, "shared\n" * n + "shared")] + [(i, "shared") for i in range(2, 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    start = time.perf_counter()
    got = {r.doc_id: r for r in linededup.dedup_lines(docs).select("row.*", "n_lines", "n_dropped").collect()}
    assert time.perf_counter() - start < 60
    assert (got[0].n_lines, got[0].n_dropped) == (n, n // 2)
    assert got[0].text == "\n".join(f"own {i}" for i in range(0, n, 2))
    assert (got[1].text, got[1].n_lines, got[1].n_dropped) == ("", n + 1, n + 1)
    assert (got[5].text, got[5].n_lines, got[5].n_dropped) == ("", 1, 1)


def test_license_suppression_equals_comparing_all_detections(spark):
    rng = np.random.default_rng(5)
    for n, spread in ((1, 3), (63, 9), (64, 9), (65, 400), (129, 30), (3000, 2000)):
        start = rng.integers(0, spread, n)
        found = sorted((int(s), int(s + k), int(p), "x", 0.5, bool(b)) for s, k, p, b in zip(
            start, rng.integers(1, 40, n), rng.permutation(n), rng.random(n) < .2))
        found.sort(key=lambda d: (d[0], -d[1], d[2]))
        if n == 3000:  # one that holds all of the others, of which the last is far behind
            found.insert(0, (0, 10 ** 6, 0, "x", 0.5, False))
        df = spark.createDataFrame([(found,)], f"all {licenses.DETECTIONS}")
        got = [tuple(d) for d in df.select(licenses._uncontained(F.col("all")).alias("kept")).first().kept]
        ends = np.array([d[1] for d in found])
        assert got == [d for i, d in enumerate(found) if d[5] or not (ends[:i] >= d[1]).any()]


def test_license_scan_of_a_long_text_with_many_detections(spark):
    text = "licensed under the mit license and cc by; all rights reserved. " * 16_000   # 1 MB
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    start = time.perf_counter()
    got = licenses.digest(docs).first()
    assert time.perf_counter() - start < 120
    assert (got.n_base, got.first_word, got.base_labels) == (32_000, 6, "cc-by,reserved")
    assert got.last_word == 15_999 * 11 + 8 and "mit" in got.labels.split(",")
