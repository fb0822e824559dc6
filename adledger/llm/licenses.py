"""License scans: ordered signature rules over the words of a text.

A text is reduced to its words (A-Z lower-cased, joined by one space).  Words
that are gates of some rule decide which rules' expressions run on it; a
document without a gate word is done after that.  Each rule that matches gives
intervals of words.  An interval that lies inside another detection's longer
interval, or shares it with a rule of higher priority, is suppressed; base
phrases are never suppressed.  All of it is one projection of built-in
functions: nothing is shuffled and no Python runs.

Defined cases: a null or empty text has no words, no detections and score 0.
Repeated rows are scanned each on its own.  Other columns are never read.  Of
detections of the same words the one of the higher priority stays.  However
many detections a text has, each is compared with all before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adledger.llm.common import NON_WORD, ascii_lower

_VERSION = r"(?: v)?(?: version)? ?"
# Fixed values, from the contract of the query: phrase and label.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Hand-written signatures: label, gate word, expressions over lower-case words.
# Rules come in the order of their priority, the first first.
SIGNATURES = (
    ("apache-2.0", "apache", (r"apache (?:software )?licen[cs]e(?: version)? 2(?: 0)?", r"apache 2 0",
                              r"apache license v2(?: 0)?", r"licensed under the apache license",
                              r"www apache org licenses license 2 0")),
    ("apache-1.1", "apache", (r"apache (?:software )?license(?: version)? 1 1", r"apache 1 1")),
    ("apache", "apache", (r"apache (?:software )?licen[cs]e", r"apache software foundation")),
    ("agpl-3.0", "affero", (r"affero general public license(?: version)? 3", r"gnu affero gpl v?3",
                            r"gnu affero general public license")),
    ("agpl-3.0", "agpl", (r"agpl v?3(?: 0)?(?: or later| only)?", r"gnu agpl")),
    ("lgpl-3.0", "lesser", (r"lesser general public license(?: as published by the free software foundation)?"
                            r"(?: either)?(?: version)? v?3(?: 0)?",)),
    ("lgpl-2.1", "lesser", (r"lesser general public license(?: as published by the free software foundation)?"
                            r"(?: either)?(?: version)? v?2 1",)),
    ("lgpl", "lesser", (r"gnu lesser general public license", r"lesser general public license")),
    ("lgpl-2.0", "library", (r"gnu library general public license(?: version 2)?",)),
    ("lgpl-3.0", "lgpl", (r"lgpl v?3(?: 0)?(?: or later| only)?", r"lgplv3")),
    ("lgpl-2.1", "lgpl", (r"lgpl v?2 1(?: or later| only)?",)),
    ("lgpl", "lgpl", (r"gnu lgpl", r"the lgpl")),
    ("gpl-3.0", "gpl", (r"gpl(?: version)? v?3(?: 0)?(?: or later| only)?", r"gnu gpl v?3")),
    ("gpl-2.0", "gpl", (r"gpl(?: version)? v?2(?: 0)?(?: or later| only)?", r"gnu gpl v?2")),
    ("gpl", "gpl", (r"gnu gpl", r"(?:under|of) the gpl", r"gpl compatible")),
    ("gpl-3.0", "general", (r"gnu general public license(?: as published by the free software foundation)?"
                            r"(?: either)?(?: version)? v?3(?: 0)?",)),
    ("gpl-2.0", "general", (r"gnu general public license(?: as published by the free software foundation)?"
                            r"(?: either)?(?: version)? v?2(?: 0)?",)),
    ("gpl", "general", (r"gnu general public licen[cs]e", r"under the terms of the gnu general public license")),
    ("gfdl-1.3", "documentation", (r"free documentation license(?: version)? 1 3",)),
    ("gfdl", "documentation", (r"gnu free documentation license", r"free documentation license")),
    ("mit", "mit", (r"(?:the )?mit licen[cs]e", r"licensed under (?:the )?mit", r"mit licensed",
                    r"released under (?:the )?mit", r"opensource org licenses mit")),
    ("mit", "permission", (r"permission is hereby granted free of charge to any person obtaining a copy",)),
    ("mit", "substantial", (r"shall be included in all copies or substantial portions of the software",)),
    ("mit-0", "attribution", (r"mit no attribution",)),
    ("isc", "isc", (r"(?:the )?isc licen[cs]e", r"licensed under (?:the )?isc")),
    ("isc", "permission", (r"permission to use copy modify and or distribute this software for any purpose",)),
    ("bsd-4-clause", "bsd", (r"bsd 4 clause", r"4 clause bsd", r"original bsd license", r"four clause bsd")),
    ("bsd-4-clause", "advertising", (r"all advertising materials mentioning features or use of this software",)),
    ("bsd-3-clause", "bsd", (r"bsd 3 clause", r"3 clause bsd", r"new bsd license", r"modified bsd license",
                             r"revised bsd license", r"three clause bsd")),
    ("bsd-3-clause", "endorse", (r"may be used to endorse or promote products derived from this software",)),
    ("bsd-2-clause", "bsd", (r"bsd 2 clause", r"2 clause bsd", r"simplified bsd license", r"freebsd license")),
    ("bsd-0-clause", "0bsd", (r"0bsd",)),
    ("bsd-0-clause", "bsd", (r"zero clause bsd", r"bsd zero clause")),
    ("bsd", "bsd", (r"bsd licen[cs]e", r"bsd style license", r"licensed under (?:the )?bsd")),
    ("bsd", "redistribution", (r"redistribution and use in source and binary forms with or without modification",)),
    ("bsd", "redistributions", (r"redistributions of source code must retain the above copyright notice",
                                r"redistributions in binary form must reproduce the above copyright notice")),
    ("mpl-2.0", "mozilla", (r"mozilla public license(?: v| version)? ?2(?: 0)?", r"mozilla org mpl 2 0")),
    ("mpl-1.1", "mozilla", (r"mozilla public license(?: v| version)? ?1 1",)),
    ("mpl", "mozilla", (r"mozilla public licen[cs]e",)),
    ("mpl-2.0", "mpl", (r"mpl v?2(?: 0)?", r"mplv2")),
    ("mpl-1.1", "mpl", (r"mpl v?1 1",)),
    ("epl-2.0", "eclipse", (r"eclipse public license(?: v| version)? ?2(?: 0)?",)),
    ("epl-1.0", "eclipse", (r"eclipse public license(?: v| version)? ?1(?: 0)?",)),
    ("epl", "eclipse", (r"eclipse public licen[cs]e",)),
    ("edl-1.0", "eclipse", (r"eclipse distribution license",)),
    ("cddl-1.1", "distribution", (r"common development and distribution license(?: version)? 1 1",)),
    ("cddl-1.0", "distribution", (r"common development and distribution license(?: version 1 0)?",)),
    ("cddl", "cddl", (r"cddl(?: 1 [01])?",)),
    ("cpl-1.0", "common", (r"common public license(?: version)?(?: 1 0)?",)),
    ("cpal-1.0", "common", (r"common public attribution license(?: version)?(?: 1 0)?",)),
    ("eupl-1.2", "european", (r"european union public licen[cs]e(?: v| version)? ?1 2",)),
    ("eupl", "european", (r"european union public licen[cs]e",)),
    ("eupl", "eupl", (r"eupl(?: v?1 [012])?",)),
    ("artistic-2.0", "artistic", (r"artistic license(?: version)? 2(?: 0)?",)),
    ("artistic", "artistic", (r"(?:the )?artistic licen[cs]e",)),
    ("bsl-1.0", "boost", (r"boost software license(?: version)?(?: 1 0)?",)),
    ("zlib", "zlib", (r"(?:the )?zlib(?: libpng)? license",)),
    ("zlib", "altered", (r"altered source versions must be plainly marked as such",)),
    ("unlicense", "unlicense", (r"(?:the )?unlicense", r"unlicense org")),
    ("unlicense", "unencumbered", (r"free and unencumbered software released into the public domain",)),
    ("wtfpl", "wtfpl", (r"wtfpl(?: 2| version 2)?",)),
    ("wtfpl", "fuck", (r"do what the fuck you want to public license",)),
    ("beerware", "beerware", (r"beerware(?: license)?",)),
    ("beerware", "beer", (r"the beer ware license",)),
    ("vim", "vim", (r"vim license",)),
    ("openssl", "openssl", (r"openssl license", r"dual openssl and ssleay license")),
    ("php-3.01", "php", (r"php license(?: version)?(?: 3 01)?",)),
    ("psf-2.0", "psf", (r"psf license(?: agreement)?(?: version 2)?",)),
    ("psf-2.0", "python", (r"python software foundation license(?: version 2)?",)),
    ("ruby", "ruby", (r"ruby license", r"same terms as ruby")),
    ("perl", "perl", (r"(?:under the )?same terms as perl(?: itself)?",)),
    ("postgresql", "postgresql", (r"postgresql licen[cs]e",)),
    ("ncsa", "ncsa", (r"(?:university of illinois )?ncsa open source license",)),
    ("ms-pl", "microsoft", (r"microsoft public license",)),
    ("ms-rl", "microsoft", (r"microsoft reciprocal license",)),
    ("ofl-1.1", "sil", (r"sil open font license(?: version)?(?: 1 [01])?",)),
    ("ofl-1.1", "ofl", (r"ofl(?: 1 1)?",)),
    ("osl-3.0", "open", (r"open software license(?: v| version)? ?(?:3 0)?",)),
    ("afl-3.0", "academic", (r"academic free license(?: v| version)? ?(?:3 0)?",)),
    ("odbl-1.0", "odbl", (r"odbl(?: 1 0)?",)),
    ("odbl-1.0", "database", (r"open database license(?: 1 0| v1 0)?",)),
    ("odc-by-1.0", "odc", (r"odc by(?: 1 0)?", r"odc attribution license")),
    ("pddl-1.0", "dedication", (r"public domain dedication and license",)),
    ("cc0-1.0", "cc0", (r"cc0(?: 1 0)?(?: universal)?", r"cc0 public domain dedication")),
    ("cc0-1.0", "creative", (r"creative commons (?:cc0|zero)(?: 1 0)?(?: universal)?",)),
    ("cc-pd", "creative", (r"creative commons public domain(?: mark)?(?: 1 0)?",)),
    ("cc-by-nc-nd", "creative", (r"creative commons attribution non ?commercial no ?deriv(?:atives|s)(?: [1234] 0)?",)),
    ("cc-by-nc-sa", "creative", (r"creative commons attribution non ?commercial share ?alike(?: [1234] 0)?",)),
    ("cc-by-nc", "creative", (r"creative commons attribution non ?commercial(?: [1234] 0)?",)),
    ("cc-by-nd", "creative", (r"creative commons attribution no ?deriv(?:atives|s)(?: [1234] 0)?",)),
    ("cc-by-sa", "creative", (r"creative commons attribution share ?alike(?: [1234] 0)?",)),
    ("cc", "creative", (r"creative commons licen[cs]e", r"creativecommons org licenses")),
    ("cc", "creativecommons", (r"creativecommons org licenses(?: by(?: nc)?(?: sa| nd)? [1234] 0)?",)),
    ("cc-by-nc-nd", "cc", (r"cc by nc nd(?: [1234] 0)?",)),
    ("cc-by-nc-sa", "cc", (r"cc by nc sa(?: [1234] 0)?",)),
    ("cc-by-nc", "cc", (r"cc by nc(?: [1234] 0)?",)),
    ("cc-by-nd", "cc", (r"cc by nd(?: [1234] 0)?",)),
    ("cc-by-sa", "cc", (r"cc by sa(?: [1234] 0)?",)),
    ("cc-by-4.0", "cc", (r"cc by 4 0", r"cc by 4 0 international")),
    ("cc-by-3.0", "cc", (r"cc by 3 0(?: unported)?",)),
    ("public-domain", "domain", (r"(?:released|placed|dedicated) (?:in|into|to) the public domain",
                                 r"(?:is|are) (?:in|of) the public domain", r"public domain dedication")),
    ("proprietary", "proprietary", (r"proprietary and confidential", r"proprietary license",
                                    r"confidential and proprietary", r"proprietary software")),
    ("proprietary", "prohibited", (r"(?:unauthorized|unauthorised) (?:copying|use|reproduction|distribution)"
                                   r"(?: \S+){0,8} is strictly prohibited", r"reproduction prohibited")),
    ("proprietary", "permission", (r"without (?:the )?(?:prior )?(?:express )?written permission",)),
    ("reserved", "rights", (r"some rights reserved", r"no rights reserved", r"alle rechte vorbehalten")),
    ("reserved", "droits", (r"tous droits r\S+serv\S+s",)),
    ("reserved", "derechos", (r"todos los derechos reservados",)),
    ("reserved", "rechte", (r"alle rechte vorbehalten",)),
    ("eula", "eula", (r"eula", r"end user license agreement")),
    ("eula", "agreement", (r"end user licen[cs]e agreement", r"software license agreement",
                           r"terms of this license agreement")),
    ("warranty-disclaimer", "warranty", (r"without warranty of any kind(?: express or implied)?",
                                         r"without any warranty", r"no warranty")),
    ("warranty-disclaimer", "warranties", (r"warranties or conditions of any kind",
                                           r"implied warranties of merchantability")),
    ("copyright-notice", "copyright", (r"copyright (?:c )?(?:19|20)\d\d(?: (?:19|20)\d\d)?", r"copyright ©",
                                       r"copyright notice")),
)
# SPDX identifiers; each gives the rule "spdx license identifier <its words>".
SPDX = """0BSD AFL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.1 Apache-2.0 Artistic-2.0 BSD-2-Clause BSD-3-Clause
BSD-4-Clause BSL-1.0 CC0-1.0 CC-BY-3.0 CC-BY-4.0 CC-BY-NC-4.0 CC-BY-NC-ND-4.0 CC-BY-NC-SA-4.0 CC-BY-ND-4.0 CC-BY-SA-3.0
CC-BY-SA-4.0 CDDL-1.0 CDDL-1.1 CPL-1.0 EPL-1.0 EPL-2.0 EUPL-1.1 EUPL-1.2 GFDL-1.3 GPL-2.0-only GPL-2.0-or-later
GPL-3.0-only GPL-3.0-or-later ISC LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later MIT MIT-0 MPL-1.1
MPL-2.0 MS-PL MS-RL NCSA ODbL-1.0 OFL-1.1 OpenSSL OSL-3.0 PDDL-1.0 PHP-3.01 PostgreSQL PSF-2.0 Ruby Unlicense Vim
WTFPL Zlib""".split()
# Ways in which a text says that a license holds for it.
GRANTS = ("licensed under", "released under", "distributed under", "available under", "published under",
          "provided under", "covered by", "subject to")
GRANTED = (("cc-by-nc-nd", "cc by nc nd"), ("cc-by-nc-sa", "cc by nc sa"), ("cc-by-nc", "cc by nc"),
           ("cc-by-sa", "cc by sa"), ("cc-by-nd", "cc by nd"), ("cc-by", "cc by"), ("gpl", "gpl"), ("gpl", "gnu gpl"),
           ("mit", "mit"), ("apache-2.0", "apache 2 0"), ("bsd", "bsd"), ("mpl-2.0", "mpl 2 0"),
           ("public-domain", "public domain"), ("proprietary", "proprietary license"))
# How sure a detection of each kind is.
CONFIDENCE = {"spdx": 1.0, "grant": 0.95, "base": 0.9, "signature": 0.8}


def rules() -> list[tuple]:
    """(priority, label, gate, expression, confidence, base); a lower priority wins."""
    out = []
    for name in SPDX:
        words = name.lower().replace("-", " ").replace(".", " ")
        label = name.lower().removesuffix("-only").removesuffix("-or-later")
        out.append((label, "spdx", f"spdx license identifier {words}", "spdx", False))
    for label, words in GRANTED:
        for said in GRANTS:
            out.append((label, words.split()[0],
                        rf"{said}(?: the| a| an)?(?: terms of(?: the)?)? {words}(?: [1234] 0)?", "grant", False))
    for label, gate, expressions in SIGNATURES:
        out += [(label, gate, e, "signature", False) for e in expressions]
    out += [(label, words.split()[0], words, "base", True) for words, label in BASE]
    return [(i, label, gate, e, CONFIDENCE[kind], base) for i, (label, gate, e, kind, base) in enumerate(out)]


MARK = "\x01"
# Detections are compared one by one within blocks of so many, and by the furthest end of all blocks before.
BLOCK = 64


def scan(docs: DataFrame) -> DataFrame:
    """``row`` (the input row), ``n_words`` and ``found``: detections (start, end, priority, label, confidence, base).

    Suppressed detections are left out.
    """
    table = rules()
    gates = F.array(*[F.lit(g) for g in sorted({r[2] for r in table})])
    lits = F.array(*[F.struct(F.lit(p).alias("priority"), F.lit(label).alias("label"), F.lit(gate).alias("gate"),
                              F.lit(f" ({e})(?= )").alias("expression"), F.lit(c).alias("confidence"),
                              F.lit(b).alias("base")) for p, label, gate, e, c, b in table])
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    flat = F.trim(F.regexp_replace(ascii_lower(F.coalesce(F.col("text"), F.lit(""))), NON_WORD, " "))
    out = docs.select(row, flat.alias("flat"))
    words = F.split(F.col("flat"), " ")
    out = out.select("row", F.concat(F.lit(" "), "flat", F.lit(" ")).alias("flat"),
                     F.when(F.col("flat") == "", 0).otherwise(F.size(words)).cast("long").alias("n_words"),
                     F.array_intersect(words, gates).alias("gates"))
    found = F.when(F.size("gates") == 0, F.array().cast(DETECTIONS)).otherwise(F.array_sort(F.flatten(F.transform(
        F.filter(lits, lambda r: F.array_contains(F.col("gates"), r["gate"])), _places)), _before))
    out = out.select("row", "n_words", found.alias("all"))
    return out.select("row", "n_words", F.when(F.size("all") == 0, F.col("all")).otherwise(
        _uncontained(F.col("all"))).alias("found"))


DETECTIONS = ("array<struct<start:long,end:long,priority:int,label:string,confidence:double,base:boolean>>")


def _places(r: Column) -> Column:
    """All places of one rule, in order: marks at the matches give the starts, the matched words the lengths."""
    marked = F.split(F.regexp_replace(F.col("flat"), r["expression"], F.lit(f" {MARK}$1")), " ")
    at = F.filter(F.transform(marked, lambda w, i: F.when(w.startswith(MARK), i - 1)), lambda i: i.isNotNull())
    matched = F.regexp_extract_all(F.col("flat"), r["expression"], F.lit(1))
    return F.when(F.rlike("flat", r["expression"]), F.zip_with(at, matched, lambda s, m: F.struct(
        s.cast("long").alias("start"), (s + F.size(F.split(m, " "))).cast("long").alias("end"),
        r["priority"].alias("priority"), r["label"].alias("label"), r["confidence"].alias("confidence"),
        r["base"].alias("base")))).otherwise(F.array().cast(DETECTIONS))


def _before(a: Column, b: Column) -> Column:
    """Order: by start, the longer first, then by priority; so what holds an interval stands before it."""
    x = F.struct(a["start"], -a["end"], a["priority"])
    y = F.struct(b["start"], -b["end"], b["priority"])
    return F.when(x < y, -1).when(x > y, 1).otherwise(0)


def _uncontained(found: Column) -> Column:
    """The base detections, and of the others those that no detection before them holds.

    Those before start no later, so one is held just if their furthest end is not
    before its own.  That running maximum is taken exactly: of all blocks before
    by their maxima, within the block one by one.  Ends and maxima are bound as
    one value, lest they be worked out again for each detection.
    """
    ends = F.transform(found, lambda d: d["end"])
    n_blocks = F.ceil(F.size(found) / F.lit(BLOCK)).cast("int")
    bound = F.transform(F.array(F.struct(found.alias("found"), ends.alias("ends"))), lambda a: F.struct(
        a["found"].alias("found"), a["ends"].alias("ends"),
        F.transform(F.sequence(F.lit(0), n_blocks - 1),
                    lambda k: F.array_max(F.slice(a["ends"], k * BLOCK + 1, F.lit(BLOCK)))).alias("maxima")))
    bound = F.transform(bound, lambda a: F.struct(
        a["found"].alias("found"), a["ends"].alias("ends"),
        F.transform(a["maxima"], lambda _, k: F.array_max(F.slice(a["maxima"], F.lit(1), k))).alias("before")))

    def furthest(a: Column, i: Column) -> Column:
        k = F.floor(i / F.lit(BLOCK)).cast("int")
        own = F.array_max(F.slice(a["ends"], k * BLOCK + 1, i - k * BLOCK))
        return F.coalesce(F.greatest(own, F.get(a["before"], k)), F.lit(-1))

    return F.flatten(F.transform(bound, lambda a: F.filter(
        a["found"], lambda d, i: d["base"] | (furthest(a, i) < d["end"]))))


def digest(docs: DataFrame) -> DataFrame:
    """The counts, places and labels of every document."""
    out = scan(docs.select("doc_id", "text"))
    base = F.filter("found", lambda f: f["base"])
    starts = F.transform(base, lambda f: f["start"])
    join = lambda c: F.array_join(F.array_sort(F.array_distinct(F.transform(c, lambda f: f["label"]))), ",")
    return out.select(
        "row.doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), join(base).alias("base_labels"), join(F.col("found")).alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda f: f["confidence"])), F.lit(0.0)).alias("score"))
