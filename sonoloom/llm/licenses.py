"""License scans by ordered signature rules. DataFrame functions only.

A rule is a sequence of words, each a regular expression, with a keyword that its places must hold. Only rules whose
keyword is in a text are tried on it. Of overlapping detections one is left out if another of the same or a better
priority contains it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonoloom.llm.common import packed

#: What is between words once A to Z are lower case.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_START, _END = "\x01", "\x02"
#: How sure a detection of each priority is: identifiers, names with a version, other names, hints.
CONFIDENCE = (1.0, 0.9, 0.75, 0.4)
_BASE_CONFIDENCE = 0.5


@dataclass(frozen=True)
class Rule:
    """A label for the places where `words` stand in a row. A word in brackets may be missing."""

    label: str
    keyword: str
    words: str
    priority: int

    @property
    def pattern(self) -> str:
        """The rule over a text with one space on both sides of every word."""
        said = [(w[1:-1], "(?: (?:{}) )?") if w[0] == "(" else (w, " (?:{}) ") for w in self.words.split()]
        return "".join(form.format(word) for word, form in said)


BASE = (
    Rule("cc-by", "cc", "cc by", 0),
    Rule("gpl", "general", "general public license", 0),
    Rule("reserved", "rights", "all rights reserved", 0),
)

# SPDX identifiers.
IDENTIFIERS = """
0BSD AFL-1.1 AFL-1.2 AFL-2.0 AFL-2.1 AFL-3.0 AGPL-1.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.0 Apache-1.1 Apache-2.0
APSL-1.0 APSL-2.0 Artistic-1.0 Artistic-2.0 BlueOak-1.0.0 BSD-1-Clause BSD-2-Clause BSD-2-Clause-Patent BSD-3-Clause
BSD-3-Clause-Clear BSD-4-Clause BSL-1.0 BUSL-1.1 CC0-1.0 CC-BY-1.0 CC-BY-2.0 CC-BY-2.5 CC-BY-3.0 CC-BY-4.0 CC-BY-NC-2.0
CC-BY-NC-3.0 CC-BY-NC-4.0 CC-BY-NC-ND-3.0 CC-BY-NC-ND-4.0 CC-BY-NC-SA-3.0 CC-BY-NC-SA-4.0 CC-BY-ND-3.0 CC-BY-ND-4.0
CC-BY-SA-2.0 CC-BY-SA-2.5 CC-BY-SA-3.0 CC-BY-SA-4.0 CDDL-1.0 CDDL-1.1 CDLA-Permissive-2.0 CECILL-2.1 CECILL-B CECILL-C
CPL-1.0 curl ECL-2.0 EFL-2.0 Elastic-2.0 EPL-1.0 EPL-2.0 EUPL-1.1 EUPL-1.2 FTL GFDL-1.1-or-later GFDL-1.2-or-later
GFDL-1.3-only GFDL-1.3-or-later GPL-1.0-only GPL-1.0-or-later GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later
HPND ICU IPL-1.0 ISC JSON LGPL-2.0-only LGPL-2.0-or-later LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later
Libpng LPL-1.02 LPPL-1.3c MIT MIT-0 MPL-1.0 MPL-1.1 MPL-2.0 MS-PL MS-RL MulanPSL-2.0 NCSA ODbL-1.0 ODC-By-1.0 OFL-1.0
OFL-1.1 OGL-UK-3.0 OLDAP-2.8 OpenSSL OSL-1.0 OSL-2.0 OSL-2.1 OSL-3.0 PDDL-1.0 PHP-3.0 PHP-3.01 PostgreSQL PSF-2.0
Python-2.0 QPL-1.0 Ruby SISSL Sleepycat SSPL-1.0 UPL-1.0 Unicode-3.0 Unlicense Vim W3C WTFPL X11 Xnet Zlib ZPL-2.0 ZPL-2.1
""".split()

# Label, keyword and words of licenses named with their version, the more special first.
VERSIONED = """
agpl-3.0 affero: (gnu) affero general public licen[cs]e (version|v) (3|v3) (0)
lgpl-2.0 library: (gnu) library general public licen[cs]e (version|v) 2|v2 (0)
lgpl-2.1 lesser: (gnu) lesser general public licen[cs]e (version|v) 2|v2 1
lgpl-3.0 lesser: (gnu) lesser general public licen[cs]e (version|v) 3|v3 (0)
gpl-1.0 general: (gnu) general public licen[cs]e (version|v) 1|v1 (0)
gpl-2.0 general: (gnu) general public licen[cs]e (version|v) 2|v2 (0)
gpl-3.0 general: (gnu) general public licen[cs]e (version|v) 3|v3 (0)
gpl-2.0-or-later general: general public licen[cs]e either version 2 of the licen[cs]e or at your option any later
gpl-3.0-or-later general: general public licen[cs]e either version 3 of the licen[cs]e or at your option any later
gpl-2.0-or-later general: (gnu) general public licen[cs]e (version|v) 2|v2 (0) or (any) later|newer
gpl-3.0-or-later general: (gnu) general public licen[cs]e (version|v) 3|v3 (0) or (any) later|newer
gfdl-1.1 documentation: (gnu) free documentation licen[cs]e (version|v) 1|v1 1
gfdl-1.2 documentation: (gnu) free documentation licen[cs]e (version|v) 1|v1 2
gfdl-1.3 documentation: (gnu) free documentation licen[cs]e (version|v) 1|v1 3
apache-1.0 apache: apache (software) licen[cs]e (version|v) 1|v1 0
apache-1.1 apache: apache (software) licen[cs]e (version|v) 1|v1 1
apache-2.0 apache: apache (software) licen[cs]e (version|v) 2|v2 (0)
apache-2.0 apache: apache 2|v2 0 licen[cs]e
mpl-1.0 mozilla: mozilla public licen[cs]e (version|v) 1|v1 0
mpl-1.1 mozilla: mozilla public licen[cs]e (version|v) 1|v1 1
mpl-2.0 mozilla: mozilla public licen[cs]e (version|v) 2|v2 (0)
epl-1.0 eclipse: eclipse public licen[cs]e (version|v) 1|v1 (0)
epl-2.0 eclipse: eclipse public licen[cs]e (version|v) 2|v2 (0)
cpl-1.0 common: common public licen[cs]e (version|v) 1|v1 (0)
ipl-1.0 ibm: ibm public licen[cs]e (version|v) 1|v1 (0)
cddl-1.0 distribution: common development and distribution licen[cs]e (cddl) (version|v) 1|v1 0
cddl-1.1 distribution: common development and distribution licen[cs]e (cddl) (version|v) 1|v1 1
eupl-1.1 european: european union public licen[cs]e (version|v) 1|v1 1
eupl-1.2 european: european union public licen[cs]e (version|v) 1|v1 2
afl-2.1 academic: academic free licen[cs]e (version|v) 2|v2 1
afl-3.0 academic: academic free licen[cs]e (version|v) 3|v3 (0)
osl-2.1 open: open software licen[cs]e (version|v) 2|v2 1
osl-3.0 open: open software licen[cs]e (version|v) 3|v3 (0)
ofl-1.0 font: (sil) open font licen[cs]e (version|v) 1|v1 0
ofl-1.1 font: (sil) open font licen[cs]e (version|v) 1|v1 1
artistic-1.0 artistic: artistic licen[cs]e (version|v) 1|v1 (0)
artistic-2.0 artistic: artistic licen[cs]e (version|v) 2|v2 (0)
bsl-1.0 boost: boost software licen[cs]e (version|v) 1|v1 (0)
busl-1.1 business: business source licen[cs]e (version|v) 1|v1 1
sspl-1.0 server: server side public licen[cs]e (version|v) 1|v1
elastic-2.0 elastic: elastic licen[cs]e (version|v) 2|v2 (0)
apsl-2.0 apple: apple public source licen[cs]e (version|v) 2|v2 (0)
php-3.01 php: php licen[cs]e (version|v) 3|v3 01
psf-2.0 python: python software foundation licen[cs]e (version|v) 2|v2
zpl-2.1 zope: zope public licen[cs]e (version|v) 2|v2 1
qpl-1.0 q: q public licen[cs]e (version|v) 1|v1 (0)
lppl-1.3c latex: latex project public licen[cs]e (version|v) 1|v1 3c?
ms-pl microsoft: microsoft public licen[cs]e
ms-rl microsoft: microsoft reciprocal licen[cs]e
upl-1.0 universal: universal permissive licen[cs]e (version|v) 1|v1 (0)
mulanpsl-2.0 mulan: mulan permissive software licen[cs]e (version|v) 2|v2
ecl-2.0 educational: educational community licen[cs]e (version|v) 2|v2 (0)
odbl-1.0 database: open (data) (commons) (open) database licen[cs]e (version|v) 1|v1 (0)
pddl-1.0 dedication: (odc) public domain dedication and licen[cs]e
cc0-1.0 cc0: cc0 (1) (0) (universal)
bsd-4-clause bsd: 4|four clause bsd
bsd-3-clause bsd: 3|three clause bsd
bsd-2-clause bsd: 2|two clause bsd
bsd-3-clause bsd: (new|modified|revised) bsd 3|three clause
bsd-2-clause bsd: (simplified) bsd 2|two clause
0bsd bsd: zero clause bsd
gpl-2.0 gplv2: gplv2
gpl-2.0-or-later gplv2: gplv2 or later
gpl-3.0 gplv3: gplv3
gpl-3.0-or-later gplv3: gplv3 or later
lgpl-2.1 lgplv2: lgplv2 1
lgpl-3.0 lgplv3: lgplv3
agpl-3.0 agplv3: agplv3
"""

# Label, keyword and words of licenses named without a version, and of their well-known sentences.
NAMED = """
agpl affero: (gnu) affero general public licen[cs]e
lgpl lesser: (gnu) lesser general public licen[cs]e
lgpl library: (gnu) library general public licen[cs]e
gpl gnu: gnu general public licen[cs]e
gpl gnu: gnu gpl
gpl gpl: licen[cs]ed under (the) (terms) (of) (the) gpl
gfdl gfdl: gfdl
gfdl documentation: (gnu) free documentation licen[cs]e
apache apache: apache (software) licen[cs]e
mit mit: (the) mit licen[cs]e
mit mit: mit licen[cs]ed
mit mit: licen[cs]ed under (the) mit
mit permission: permission is hereby granted free of charge to any person obtaining a copy
mit-no-attribution mit: mit no attribution
isc permission: permission to use copy modify and or distribute this software for any purpose with or without fee
isc isc: (the) isc licen[cs]e
bsd bsd: (the) bsd (style) licen[cs]e
bsd redistribution: redistribution and use in source and binary forms with or without modification are permitted
bsd-3-clause endorse: may be used to endorse or promote products derived from this software
mpl mozilla: mozilla public licen[cs]e
epl eclipse: eclipse public licen[cs]e
cddl distribution: common development and distribution licen[cs]e
eupl european: european union public licen[cs]e
afl academic: academic free licen[cs]e
osl open: open software licen[cs]e
ofl font: (sil) open font licen[cs]e
artistic artistic: (the) artistic licen[cs]e
boost boost: boost software licen[cs]e
busl business: business source licen[cs]e
sspl server: server side public licen[cs]e
elastic elastic: elastic licen[cs]e
zlib zlib: zlib (libpng) licen[cs]e
zlib misrepresented: the origin of this software must not be misrepresented
libpng libpng: libpng licen[cs]e
openssl openssl: openssl licen[cs]e
postgresql postgresql: postgresql licen[cs]e
php php: php licen[cs]e
python python: python software foundation licen[cs]e
ruby ruby: ruby licen[cs]e
perl perl: same terms as perl
vim vim: vim licen[cs]e
w3c w3c: w3c software (notice) (and) licen[cs]e
x11 x11: x11 licen[cs]e
ncsa ncsa: (university) (of) (illinois) ncsa open source licen[cs]e
unlicense unlicense: (the) unlicense
unlicense unencumbered: this is free and unencumbered software released into the public domain
wtfpl wtfpl: wtfpl
wtfpl fuck: do what the fuck you want to public licen[cs]e
sleepycat sleepycat: sleepycat licen[cs]e
freetype freetype: freetype (project) licen[cs]e
icu icu: icu licen[cs]e
unicode unicode: unicode licen[cs]e
curl curl: curl licen[cs]e
beerware beer: beer ware licen[cs]e
json evil: shall be used for good not evil
latex latex: latex project public licen[cs]e
zope zope: zope public licen[cs]e
apple apple: apple public source licen[cs]e
odbl odbl: odbl
odbl database: open database licen[cs]e
odc-by attribution: open data commons attribution licen[cs]e
cc0 cc0: cc0
cc creative: creative commons (public) licen[cs]e
cc creative: licen[cs]ed under (a) creative commons
gov-open open: open government licen[cs]e
public-domain domain: (in|into) the public domain
public-domain domain: public domain dedication
"""

# Label, keyword and words that only hint at terms of use.
HINTS = """
licensed licensed: licensed under
licensed released: released under (the) (terms) (of) (the) ([^ ]+) licen[cs]e
licensed distributed: distributed under (the) (terms) (of) (the) ([^ ]+) licen[cs]e
licensed terms: terms of the|this|its licen[cs]e
licensed license: see (the) license (file) for
copyright copyright: copyright (c) 19[0-9][0-9]|20[0-9][0-9]
copyright copyright: copyright (c) by
copyright copyrighted: copyrighted material
no-warranty warranty: without warranty of any kind
no-warranty warranty: absolutely no warranty
no-warranty merchantability: implied warranty of merchantability
reserved rights: some rights reserved
proprietary proprietary: proprietary and confidential
proprietary permission: without (the) (express) (prior) written permission
proprietary reproduced: may not be reproduced
noncommercial commercial: for non commercial use
noncommercial noncommercial: for noncommercial use
attribution attribution: attribution required
royalty-free royalty: royalty free
"""
_CREATIVE = {
    "by": "attribution",
    "by-sa": "attribution (share) alike|sharealike",
    "by-nd": "attribution (no) derivatives|derivs|noderivatives|noderivs",
    "by-nc": "attribution (non) commercial|noncommercial",
    "by-nc-sa": "attribution (non) commercial|noncommercial (share) alike|sharealike",
    "by-nc-nd": "attribution (non) commercial|noncommercial (no) derivatives|derivs|noderivatives|noderivs",
}


def _lines(said: str, priority: int) -> list[Rule]:
    heads = [line.partition(": ") for line in said.strip().split("\n")]
    return [Rule(*head.split(), words, priority) for head, _, words in heads]


def _creative() -> list[Rule]:
    """Creative Commons licenses by their short and long names, with each version and without."""
    rules = []
    for code, name in _CREATIVE.items():
        short = code.replace("-", " ")
        for version in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            one, two = version.split(".")
            number = f"{one} {two}"
            rules.append(Rule(f"cc-{code}-{version}", "cc", f"cc {short} {number}", 1))
            rules.append(Rule(f"cc-{code}-{version}", "commons", f"creative commons {name} {number}", 1))
        rules.append(Rule(f"cc-{code}", "cc", f"cc {short}", 2))
        rules.append(Rule(f"cc-{code}", "commons", f"creative commons {name}", 2))
    return rules


def _identified() -> list[Rule]:
    """Every SPDX identifier behind its tag, and behind the words license or licensed under."""
    rules = []
    for said in IDENTIFIERS:
        words = " ".join(said.lower().replace("-", " ").replace(".", " ").split())
        rules.append(Rule(said.lower(), "spdx", f"spdx license identifier {words}", 0))
        rules.append(Rule(said.lower(), words.split()[0], f"licen[cs]e|licen[cs]ed (is|under) (the) {words}", 1))
    return rules


#: In order: of equal places the first rule's detection stays.
RULES = (*_identified(), *_creative(), *_lines(VERSIONED, 1), *_lines(NAMED, 2), *_lines(HINTS, 3))


def words_of(text: Column) -> Column:
    """The words of a text, A to Z in lower case.

    `lower` maps just two other characters to ASCII letters; they are replaced before.
    """
    plain = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u0138")), F.lit("\u0130"), F.lit("\u0131"))
    return F.array_remove(F.split(F.lower(plain), _BETWEEN), "")


def _by_keyword(rules: tuple[Rule, ...], base: tuple[Rule, ...]) -> Column:
    """The rules as a literal: an array of (keyword, its rules)."""
    held: dict[str, list[Column]] = {}
    for place, rule in enumerate([*base, *rules]):
        entry = F.struct(
            F.lit(place).alias("place"), F.lit(rule.label).alias("label"), F.lit(rule.pattern).alias("pattern"),
            F.lit(-1 if place < len(base) else rule.priority).alias("priority"),
        )
        held.setdefault(rule.keyword, []).append(entry)
    return F.array(*[F.struct(F.lit(k).alias("keyword"), F.array(*v).alias("rules")) for k, v in held.items()])


def _places(norm: Column, rule: Column) -> Column:
    """(start, end) in words of the matches of a rule. Marks go into the gaps between words, which keep their places."""
    marked = F.split(F.regexp_replace(norm, rule["pattern"], F.lit(f"{_START}$0{_END}")), " ")

    def gaps(mark: str) -> Column:
        return F.filter(F.transform(marked, lambda gap, i: F.when(gap.contains(mark), F.shiftright(i, 1))), lambda g: g.isNotNull())

    return F.zip_with(
        gaps(_START), gaps(_END),
        lambda a, b: F.struct(
            a.alias("start"), (-b).alias("minus_end"), rule["priority"].alias("priority"), rule["place"].alias("place"), rule["label"].alias("label")
        ),
    )


def _resolved(detections: Column) -> Column:
    """Labels and the best priority of the detections that none of the same or a better priority contains.

    They come by start, the longer first, then by priority and order of the rules: what contains a detection is before it,
    so the furthest end of each priority so far tells.
    """
    kinds = len(CONFIDENCE)
    none = F.struct(
        F.array_repeat(F.lit(-1), kinds).alias("ends"), F.array().cast("array<string>").alias("labels"), F.lit(kinds).alias("best")
    )

    def step(state: Column, d: Column) -> Column:
        inside = F.exists(F.transform(state["ends"], lambda e, p: (p <= d["priority"]) & (e >= -d["minus_end"])), lambda x: x)
        ends = F.transform(state["ends"], lambda e, p: F.when(p == d["priority"], F.greatest(e, -d["minus_end"])).otherwise(e))
        return F.struct(
            ends.alias("ends"),
            F.when(inside, state["labels"]).otherwise(F.array_union(state["labels"], F.array(d["label"]))).alias("labels"),
            F.when(inside, state["best"]).otherwise(F.least(state["best"], d["priority"])).alias("best"),
        )

    return F.aggregate(detections, none, step)


def scanned(docs: DataFrame, rules: tuple[Rule, ...] = RULES, base: tuple[Rule, ...] = BASE) -> DataFrame:
    """Every row as struct `row` with `n_words`, `detections`, `base`, `labels` and `score`.

    Words are runs of ASCII letters, digits and all that is not ASCII, A to Z lower-cased, numbered from 0. `detections`
    (start, end, label, priority) are all places of the rules, by start; `base` are those of the base rules, which
    neither suppress nor are suppressed. `labels` are the different ones, sorted, of the base and of the detections that are
    left once those go that lie within another of the same or a better priority; of equal places that of the better
    priority, then of the earlier rule, stays. `score` is the confidence of the best of them, 0 without any.
    Null and empty texts have no words and no labels; whole texts are searched, with time in proportion to their length;
    repeated rows are each scanned; other columns stay within `row`; an empty table gives no rows.
    """
    # A generator computes its columns once, whoever uses them.
    rows = packed(docs).select("row", F.explode(F.array(words_of(F.col("row.text")))).alias("words"))
    keywords = F.array(*map(F.lit, sorted({r.keyword for r in (*base, *rules)})))
    spaced = F.concat(F.lit(" "), F.array_join("words", "  "), F.lit(" "))
    said = F.struct(F.array_intersect("words", keywords).alias("keys"), spaced.alias("norm"))
    some = F.when(F.arrays_overlap("words", keywords), said)
    rows = rows.select("row", F.inline(F.array(F.struct(F.size("words").cast("long").alias("n_words"), some.alias("said")))))
    held = F.filter(_by_keyword(rules, base), lambda k: F.array_contains("said.keys", k["keyword"]))
    tried = F.flatten(F.transform(held, lambda k: F.filter(k["rules"], lambda r: F.regexp_like(F.col("said.norm"), r["pattern"]))))
    places = F.sort_array(F.flatten(F.transform(tried, lambda r: _places(F.col("said.norm"), r))))
    places = F.coalesce(F.when(F.col("said").isNotNull(), places), F.slice(places, 1, 0))
    rows = rows.select("row", F.inline(F.array(F.struct("n_words", places.alias("places")))))
    rows = rows.select(
        "row", "n_words",
        F.filter("places", lambda d: d["priority"] < 0).alias("at_base"), F.filter("places", lambda d: d["priority"] >= 0).alias("at"),
    )
    result = F.struct(F.col("n_words"), F.col("at_base"), F.col("at"), _resolved(F.col("at")).alias("left"))
    rows = rows.select("row", F.inline(F.array(result)))

    def spans(places: str) -> Column:
        return F.transform(
            places,
            lambda d: F.struct(d["start"].alias("start"), (-d["minus_end"]).alias("end"), d["label"].alias("label"), d["priority"].alias("priority")),
        )

    confidence = F.coalesce(F.get(F.array(*map(F.lit, CONFIDENCE)), F.col("left.best")), F.lit(0.0))
    sure = F.when(F.size("at_base") > 0, F.greatest(confidence, F.lit(_BASE_CONFIDENCE))).otherwise(confidence)
    labels = F.array_sort(F.array_union("left.labels", F.transform("at_base", lambda d: d["label"])))
    return rows.select(
        "row", "n_words", spans("at").alias("detections"), spans("at_base").alias("base"), labels.alias("labels"), sure.alias("score")
    )
