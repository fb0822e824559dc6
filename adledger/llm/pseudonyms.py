"""PII: format-preserving Feistel pseudonyms.

Numbers and dates that identify people are found by one expression, validated,
and replaced by a keyed permutation of their own format, so a value becomes a
value of the same shape and equal values stay linked across documents, sources
and runs with the same key:

- payment cards (13 to 19 digits, Luhn): the digits before the check digit are
  permuted, the check digit is computed anew;
- bank accounts (IBAN, remainder 97): the digits of the account are permuted,
  the check digits computed anew;
- social security numbers (area, group and serial in range): permuted among
  the valid ones by cycle-walking;
- IPv4 addresses (octets up to 255): permuted among the 2^32 by cycle-walking;
- dates of 1900 to 2099 (2024-02-29, 02/29/2024, 29.02.2024): permuted among
  these days by cycle-walking;
- telephone numbers: all digits after the country code are permuted;
- mail addresses: the local part is permuted, its letters within letters of
  their case and its digits within digits; the domain stays.

A candidate that fails its validation is tried shorter at its separators: an
account or a telephone number without its last groups, then all runs of whole
groups for cards, those grouped as cards usually are first, then the longest
from the left.  What fails that too stays as it is.  Separators stay in their places.

Each permutation is a balanced-as-can-be Feistel network on decimal halves
whose round function is a keyed SHA-256; cycle-walking applies it again until
the value is in the domain.  A walk ends after ``WALK`` steps, which a value
reaches with a probability below 1e-30.  All of it is one projection of
built-in functions: no shuffle, no Python.

Defined cases: a null text stays null with no values found; an empty text
stays empty; equal rows get equal results.  Other columns are kept or ignored,
never read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS, WALK = 8, 128
# Days of 1900-01-01 to 2099-12-31, and the number of valid social security numbers.
FIRST_DAY, DAYS = "1900-01-01", 73_049
AREAS, GROUPS, SERIALS = 898, 99, 9_999

# Characters of an account, by country.
ACCOUNTS = {15: "NO", 16: "BE", 18: "DK FK FO FI GL NL SD", 19: "MK SI", 20: "AT BA EE KZ XK LT LU MN", 21: "HR LV LI CH",
            22: "BH BG CR GE DE IE ME RS GB VA", 23: "GI IQ IL OM SO TL AE", 24: "AD CZ MD PK RO SA SK ES SE TN VG",
            25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MR MC SM", 28: "AL AZ BY CY DO SV GT HN HU LB NI PL",
            29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
_BY_COUNTRY = "|".join(rf"(?:{c.replace(' ', '|')})\d{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, c in ACCOUNTS.items())
# What ends a run of numbers, as it is a value of its own; and what a telephone number doesn't run into.
_OWN = (r"\d{4}-\d{2}-\d{2}(?![\w-])|\d{3}-\d{2}-\d{4}(?![\w-])|\d{3}[.-]\d{3}[.-]\d{4}(?![\w-])|\d{2}/\d{2}/\d{4}(?![\w/])"
        r"|\d{2}\.\d{2}\.\d{4}(?!\w)|\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)|[A-Za-z0-9._%+-]{1,64}+@")
_CARD_NEXT = r"[ .-]?(?:\d{13}|(?:\d{4}[ -]){3}\d{4}(?!\d)|\d{4}[ -]\d{6}[ -]\d{4,5}(?!\d))"
# Numbers as cards are usually grouped; the longest form is looked for first.
USUAL_LONG = r"^\d{4} \d{4} \d{4} \d{4} \d{3}(?!\d)"
USUAL = r"^(?:\d{4} \d{4} \d{4} \d{4}|\d{4} \d{6} \d{4,5}|\d{13,19})(?!\d)"

CANDIDATES = "|".join((
    r"(?<![\w.%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{1,63}+)+",
    rf"(?<!\w)(?:{_BY_COUNTRY})(?!\w)",
    r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    r"(?<![\w.])\d{4}-\d{2}-\d{2}(?![\w-])",
    r"(?<![\w.])\d{2}/\d{2}/\d{4}(?![\w/])",
    r"(?<![\w.])\d{2}\.\d{2}\.\d{4}(?!\w)",
    r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)",
    r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    rf"(?<!\w)\+\d{{1,3}}(?:[ .-]?\(\d{{1,4}}\)|[ .-]\d{{1,4}})(?:(?!{_CARD_NEXT})[ .-]?\d{{2,4}}){{1,4}}(?!\w)",
    r"(?<!\w)\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\w)",
    r"(?<![\w.+-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-])",
    rf"(?<![\w.])(?=\d(?:[ -]?\d){{12}})\d++(?!\w)(?:(?: (?!{_OWN})|-)\d++(?!\w))*+",
))
# Without one of these no candidate can be in a text.
GATE = r"@[A-Za-z0-9]|\d\D{0,3}\d"


def _long(c: Column) -> Column:
    return F.coalesce(c.cast("long"), F.lit(0).cast("long"))


def _power(n: Column) -> Column:
    return F.round(F.pow(F.lit(10.0), n)).cast("long")


def _round(key: str, kind: str, n: Column, i: Column, half: Column) -> Column:
    """The keyed round function: 60 bits of a SHA-256."""
    said = F.concat_ws("|", F.lit(key), F.lit(kind), n.cast("string"), i.cast("string"), half.cast("string"))
    return F.conv(F.substring(F.sha2(said, 256), 1, 15), 16, 10).cast("long")


def permute_digits(digits: Column, key: str, kind: str) -> Column:
    """A keyed permutation of all digit strings of one length (up to 36 digits)."""
    n = F.length(digits)
    u = F.floor(n / 2).cast("int")
    v = n - u
    first = F.struct(_long(F.substr(digits, F.lit(1), u)).alias("l"), _long(F.substr(digits, u + 1)).alias("r"))

    def turn(acc: Column, i: Column) -> Column:
        left = (acc["l"] + F.pmod(_round(key, kind, n, i, acc["r"]), _power(u))) % _power(u)
        right = (acc["r"] + F.pmod(_round(key, kind, n, i, acc["l"]), _power(v))) % _power(v)
        return F.when(i % 2 == 0, F.struct(left.alias("l"), acc["r"].alias("r"))).otherwise(
            F.struct(acc["l"].alias("l"), right.alias("r")))

    def joined(acc: Column) -> Column:
        return F.concat(F.when(u > 0, F.lpad(acc["l"].cast("string"), u, "0")).otherwise(""),
                        F.lpad(acc["r"].cast("string"), v, "0"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), first, turn, joined)


def permute_index(index: Column, size: int, key: str, kind: str) -> Column:
    """A keyed permutation of 0 .. size - 1: the digits' permutation, walked until it is back inside."""
    width = len(str(size - 1))

    def step(acc: Column, _: Column) -> Column:
        again = permute_digits(F.lpad(acc["x"].cast("string"), width, "0"), key, kind).cast("long")
        return F.when(acc["x"].between(0, size - 1) & acc["moved"], acc).otherwise(
            F.struct(again.alias("x"), F.lit(True).alias("moved")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(WALK)),
                       F.struct(index.cast("long").alias("x"), F.lit(False).alias("moved")), step, lambda a: a["x"])


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _into(template: Column, digits: Column) -> Column:
    """``template`` with its digits replaced, in order, by ``digits``."""
    chars = F.split(template, "")
    return F.array_join(F.transform(chars, lambda c, i: F.when(
        c.rlike("^[0-9]$"), F.substr(digits, F.length(_digits(F.substr(template, F.lit(1), i + 1))), F.lit(1)))
        .otherwise(c)), "")


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum of a digit string, its last digit counted once."""
    back = F.split(F.reverse(digits), "")
    return F.aggregate(F.transform(back, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        F.floor(c.cast("int") * 2 / 10).cast("int") + c.cast("int") * 2 % 10)), F.lit(0), lambda a, x: a + x)


def _mod97(account: Column) -> Column:
    """The remainder by 97 of an account in which letters count 10 to 35."""
    return F.aggregate(F.split(account, ""), F.lit(0), lambda a, c: F.when(
        c.rlike("^[0-9]$"), (a * 10 + _long(c)).cast("int") % 97).otherwise(
        (a * 100 + F.ascii(c) - 55).cast("int") % 97))


def _card(m: Column, key: str) -> tuple[Column, Column]:
    d = _digits(m)
    body = permute_digits(F.substr(d, F.lit(1), F.length(d) - 1), key, "card")
    check = (10 - luhn_sum(F.concat(body, F.lit("0"))) % 10) % 10
    return ((luhn_sum(d) % 10 == 0) & F.length(d).between(13, 19),
            _into(m, F.concat(body, check.cast("string"))))


def _iban(m: Column, key: str) -> tuple[Column, Column]:
    flat = F.replace(m, F.lit(" "), F.lit(""))
    country, body = F.substr(flat, F.lit(1), F.lit(2)), F.substr(flat, F.lit(5))
    new = _into(body, permute_digits(_digits(body), key, "iban"))
    check = F.lpad((98 - _mod97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0")
    whole = F.concat(country, check, new)
    spaced = F.array_join(F.transform(F.split(m, ""), lambda c, i: F.when(c == " ", " ").otherwise(F.substr(
        whole, F.length(F.replace(F.substr(m, F.lit(1), i + 1), F.lit(" "), F.lit(""))), F.lit(1)))), "")
    ok = (_mod97(F.concat(body, F.substr(flat, F.lit(1), F.lit(4)))) == 1) & F.length(flat).between(15, 34)
    return ok & (F.length(_digits(body)) > 0), spaced


def _ssn(m: Column, key: str) -> tuple[Column, Column]:
    area, group, serial = (F.split(m, "-")[i].cast("int") for i in range(3))
    # Areas 001 to 665 and 667 to 899.
    order = F.when(area > 666, area - 2).otherwise(area - 1).cast("long")
    x = permute_index((order * GROUPS + group - 1) * SERIALS + serial - 1, AREAS * GROUPS * SERIALS, key, "ssn")
    back = F.floor(x / (GROUPS * SERIALS)).cast("int")
    parts = (F.when(back >= 665, back + 2).otherwise(back + 1), F.floor(x / SERIALS) % GROUPS + 1, x % SERIALS + 1)
    new = F.concat_ws("-", *[F.lpad(p.cast("string"), n, "0") for p, n in zip(parts, (3, 2, 4), strict=True)])
    return area.between(1, 899) & (area != 666) & group.between(1, 99) & serial.between(1, 9999), new


def _address(m: Column, key: str) -> tuple[Column, Column]:
    octets = F.transform(F.split(m, r"\."), lambda x: x.cast("long"))
    x = permute_index(F.aggregate(octets, F.lit(0).cast("long"), lambda a, o: a * 256 + o), 1 << 32, key, "ip")
    return (F.forall(octets, lambda o: o <= 255),
            F.concat_ws(".", *[F.shiftright(x, s).bitwiseAND(255).cast("string") for s in (24, 16, 8, 0)]))


def _date(m: Column, key: str, order: str, mark: str) -> tuple[Column, Column]:
    at = {"y": order.index("y"), "m": order.index("m"), "d": order.index("d")}
    part = F.split(m, "[-/.]")
    day = F.concat_ws("-", *[part[at[k]] for k in "ymd"]).try_cast("date")
    first = F.lit(FIRST_DAY).cast("date")
    new = F.date_add(first, permute_index(F.datediff(day, first), DAYS, key, "date").cast("int"))
    pattern = mark.join({"y": "yyyy", "m": "MM", "d": "dd"}[k] for k in order)
    inside = F.coalesce(F.datediff(day, first).between(0, DAYS - 1), F.lit(False))
    return inside, F.when(inside, F.date_format(new, pattern))


def _phone(m: Column, key: str) -> tuple[Column, Column]:
    code = F.regexp_extract(m, r"^\+\d{1,3}", 0)
    rest = F.substr(m, F.length(code) + 1)
    return F.length(_digits(m)).between(7, 15), F.concat(code, _into(rest, permute_digits(_digits(rest), key, "phone")))


def _mail(m: Column, key: str) -> tuple[Column, Column]:
    local, domain = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)
    # Each letter or digit is turned within its own kind by a key stream of the local part's shape
    # and of the characters before it, which makes the map one-to-one.
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(local, "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "9")

    def turned(c: Column, i: Column) -> Column:
        before = F.concat_ws("|", F.lit(key), F.lit("mail"), F.lower(domain), shape, i.cast("string"),
                             F.substr(local, F.lit(1), i))
        shift = F.conv(F.substring(F.sha2(before, 256), 1, 15), 16, 10).cast("long")
        kind = lambda first, n: F.char(F.lit(first) + (F.ascii(c) - first + shift % n) % n)
        return (F.when(c.rlike("^[a-z]$"), kind(97, 26)).when(c.rlike("^[A-Z]$"), kind(65, 26))
                 .when(c.rlike("^[0-9]$"), kind(48, 10)).otherwise(c))

    return F.lit(True), F.concat(F.array_join(F.transform(F.split(local, ""), turned), ""), F.lit("@"), domain)


# Kind, the shape it is known by, and what validates and replaces it; the first that is valid holds.
KINDS: tuple[tuple[str, str, Callable[[Column, str], tuple[Column, Column]]], ...] = (
    ("email", r"@", _mail),
    ("iban", r"^[A-Z]{2}\d{2}", _iban),
    ("date", r"^\d{4}-\d{2}-\d{2}$", lambda m, k: _date(m, k, "ymd", "-")),
    ("date", r"^\d{2}/\d{2}/\d{4}$", lambda m, k: _date(m, k, "mdy", "/")),
    ("date", r"^\d{2}\.\d{2}\.\d{4}$", lambda m, k: _date(m, k, "dmy", ".")),
    ("ip", r"^\d{1,3}(?:\.\d{1,3}){3}$", _address),
    ("ssn", r"^\d{3}-\d{2}-\d{4}$", _ssn),
    ("phone", r"^(?:\+\d{1,3}[ .(-]|\()|^\d{3}[.-]\d{3}[.-]\d{4}$", _phone),
    ("card", r"^(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}(?:\1\d{3})?|\d{4}([ -])\d{6}\2\d{4,5})$", _card),
)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once."""
    return F.transform(F.array(value), use)[0]


def _result(kinds: Column, new: Column) -> Column:
    return F.struct(kinds.alias("kinds"), new.alias("new"))


def _none() -> Column:
    return F.array().cast("array<string>")


def _bare(groups: Column, start: Column, n: Column) -> Column:
    """The digits and letters of ``n`` groups."""
    return F.regexp_replace(F.array_join(F.slice(groups, start + 1, n), ""), "[ -]", "")


def _is_card(digits: Column) -> Column:
    return F.when(digits.rlike(r"^\d{13,19}$"), luhn_sum(digits) % 10 == 0).otherwise(False)


def _cards_within(m: Column, key: str) -> Column:
    """The result for a text in which runs of whole groups that are valid cards are replaced."""
    def usual(groups: Column, i: Column) -> Column:
        near = F.regexp_replace(F.array_join(F.slice(groups, i + 1, 5), ""), "-", " ")
        size = F.lit(0)
        for shape in (USUAL, USUAL_LONG):
            said = F.regexp_extract(near, shape, 0)
            size = F.when(_is_card(F.regexp_replace(said, " ", "")), F.size(F.split(said, " "))).otherwise(size)
        return size

    def longest(groups: Column, i: Column) -> Column:
        # Beside the usual groupings only a number in one piece: other runs of groups are tables of numbers.
        return F.when(_is_card(_bare(groups, i, F.lit(1))), 1).otherwise(0)

    def taken(groups: Column, known: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            # One that is grouped as usual isn't cut by an earlier one that isn't.
            other = _let(longest(groups, i), lambda n: F.when(
                F.forall(F.slice(known, i + 2, F.greatest(n - 1, F.lit(0))), lambda x: x == 0), n).otherwise(0))
            at = lambda n: F.struct((i + n).alias("next"), F.concat(
                acc["runs"], F.array(F.struct(i.alias("i"), n.alias("n")))).alias("runs"))
            return F.when(i < acc["next"], acc).otherwise(_let(F.when(known[i] > 0, known[i]).otherwise(other),
                                                              lambda n: F.when(n > 0, at(n)).otherwise(acc)))

        none = F.struct(F.lit(0).alias("next"), F.array().cast("array<struct<i:int,n:int>>").alias("runs"))
        return F.aggregate(F.sequence(F.lit(0), F.size(groups) - 1), none, step, lambda a: a["runs"])

    def written(groups: Column, runs: Column) -> Column:
        def step(acc: Column, r: Column) -> Column:
            before = F.array_join(F.slice(groups, acc["next"] + 1, r["i"] - acc["next"]), "")
            text = F.array_join(F.slice(groups, r["i"] + 1, r["n"]), "")
            new = F.concat(_card(F.regexp_replace(text, "[ -]$", ""), key)[1], F.regexp_extract(text, "[ -]?$", 0))
            return F.struct((r["i"] + r["n"]).alias("next"), F.concat(acc["out"], F.array(before, new)).alias("out"))

        return F.aggregate(runs, F.struct(F.lit(0).alias("next"), _none().alias("out")), step, lambda a: F.concat(
            F.array_join(a["out"], ""), F.array_join(F.slice(groups, a["next"] + 1, F.size(groups)), "")))

    def replaced(groups: Column) -> Column:
        known = F.transform(F.sequence(F.lit(0), F.size(groups) - 1), lambda i: usual(groups, i))
        return _let(known, lambda k: _let(taken(groups, k), lambda runs: _result(
            F.transform(runs, lambda _: F.lit("card")), written(groups, runs))))

    return F.when(F.length(_digits(m)) >= 13, _let(F.split(m, "(?<=[ -])"), replaced)).otherwise(_result(_none(), m))


def _shortened(m: Column, key: str) -> Column:
    """The result for a candidate that isn't valid as a whole."""
    def headed(kind: str, shape: str, make: Callable[[Column, str], tuple[Column, Column]]) -> Column:
        heads = _let(F.split(m, "(?<=[ .-])"), lambda groups: F.transform(
            F.sequence(F.lit(1), F.size(groups)),
            lambda n: F.regexp_replace(F.array_join(F.slice(groups, 1, n), ""), "[ .-]$", "")))
        valid = F.filter(heads, lambda h: F.when(h.rlike(shape), make(h, key)[0]).otherwise(False))
        return _let(F.get(F.reverse(valid), F.lit(0)), lambda h: F.when(h.isNull(), _cards_within(m, key)).otherwise(
            _let(_cards_within(F.substr(m, F.length(h) + 1), key), lambda rest: _result(
                F.concat(F.array(F.lit(kind)), rest["kinds"]), F.concat(make(h, key)[1], rest["new"])))))

    return (F.when(m.rlike(r"^[A-Z]{2}\d{2}"), headed("iban", r"^[A-Z]{2}\d{2}", _iban))
             .when(m.rlike(r"^\+"), headed("phone", r"^\+", _phone)).otherwise(_cards_within(m, key)))


def _replaced(m: Column, key: str) -> Column:
    """(kinds, new) of a candidate; no kind where no validation holds."""
    out = None
    for kind, shape, make in KINDS:
        ok, new = make(m, key)
        case = _result(F.array(F.lit(kind)), new)
        is_it = F.when(m.rlike(shape), ok).otherwise(False)
        out = F.when(is_it, case) if out is None else out.when(is_it, case)
    return out.otherwise(_shortened(m, key))


def pseudonymise(docs: DataFrame, key: str = "adledger") -> DataFrame:
    """``row`` (the input row with values replaced in its text) and ``kinds`` (of each value, in order)."""
    text = F.col("row.text")
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    gated = F.coalesce(text.rlike(GATE), F.lit(False))
    out = out.select("row", F.when(gated, F.regexp_extract_all(text, F.lit(CANDIDATES), F.lit(0)))
                     .otherwise(F.array().cast("array<string>")).alias("found"))
    new = F.transform("found", lambda m: _replaced(m, key))
    out = out.select("row", F.when(F.size("found") > 0, new)
                     .otherwise(F.array().cast("array<struct<kinds:array<string>,new:string>>")).alias("new"))
    between = F.split(text, CANDIDATES, -1)
    joined = F.array_join(F.zip_with(between, F.col("new"), lambda a, b: F.concat(
        F.coalesce(a, F.lit("")), F.coalesce(b["new"], F.lit("")))), "")
    return out.select(F.col("row").withField("text", F.when(F.size("new") > 0, joined).otherwise(text)).alias("row"),
                      F.flatten(F.transform("new", lambda x: x["kinds"])).alias("kinds"))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, how many values were replaced, their kinds, and the text without them, for every document."""
    return pseudonymise(docs.select("doc_id", "text")).select(
        "row.doc_id", F.size("kinds").cast("long").alias("n_values"),
        F.array_join(F.array_sort(F.array_distinct("kinds")), ",").alias("kinds"),
        F.sha2(F.encode(F.coalesce("row.text", F.lit("")), "UTF-8"), 256).alias("text_sha256"), "row.text")
