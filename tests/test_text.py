import random
import sys
import unicodedata

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sonoloom import fixed_values as V
from sonoloom.functions import text as tx
from sonoloom.operators import tables


def apply(spark, function, values):
    """The function over the values, in their order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    out = df.select("i", function(F.col("t")).alias("o")).collect()
    return [r.o for r in sorted(out)]


TRANSCRIPTS = {
    "एक वॉचमन {watchman} असा तचा साइडीन {side} एक": "एक वॉचमन असा तचा साइडीन एक",
    "दोन बुरगे असा एक बुर्ग्यान <pause> ब्लू कलरचो शर्ट {blue color shirt} घा --</pause>": (
        "दोन बुरगे असा एक बुर्ग्यान ब्लू कलरचो शर्ट घा"
    ),
    "सामान्य वाक्य बिना कोई विशेष टोकन": "सामान्य वाक्य बिना कोई विशेष टोकन",
    "सामान्य वाक्य बिना कोई special tokens": "सामान्य वाक्य बिना कोई special tokens",
    "{english only} should be removed": "should be removed",
    "<pause> <noise> only tokens </pause>": "only tokens",
    "मिक्स्ड {mixed} <tag> कंटेंट -- यहां": "मिक्स्ड कंटेंट यहां",
    "a {over\ntwo lines} b <c\nd> e": "a b e",
    "well-known -- or --- not": "well-known or not",
    "{}<>--": "",
    "open { and < stay": "open { and < stay",
    "": "",
    None: "",
}


def test_transcript_cleaning(spark):
    assert apply(spark, tx.clean_transcript, list(TRANSCRIPTS)) == list(TRANSCRIPTS.values())


def test_transcript_punctuation(spark):
    clean = lambda c: tx.clean_transcript(c, remove_punctuation=True)
    given = ["राम । गया॥ why?! a,b;c:d. 'e' \"f\" (g)", " . ", None]
    assert apply(spark, clean, given) == ["राम गया why abcd e f (g)", "", ""]


# text, language, brackets removed, normalised text
NORMALISED = [
    (None, "en", False, None),
    ("", "en", False, None),
    ("  !? ", "en", False, None),
    ("१२ 34", "en", False, None),
    ("²", "en", False, None),
    ("12\t3", "en", False, None),
    ("12 x", "en", False, "12 x"),
    ("a\x1cb　c\x85", "en", False, "a b c"),
    ("e\u0301", "fr", False, "\u00e9"),
    ("Don't", "en", False, "dont"),
    ("a।", "hi", False, "a।"),
    ("[a[b]c] x", "en", True, "c x"),
    ("[a\nb] (c\rd) x", "en", True, "a b x"),
    ("<a>{b}(c)[d]", "en", True, None),
    ("ラーメン。", "ja", False, "ラメン"),
    ("ラーメン。", "JA_Jpan", False, "ラメン"),
    ("ラーメン。", "jpn_Jpan", False, "ラーメン。"),
    ("你好，世界“x”々", "zh", False, "你好世界“x”"),
    ("안녕ㆍ，", "ko", False, "안녕，"),
]


def test_normalise_edges(spark):
    for language, brackets in {(c[1], c[2]) for c in NORMALISED}:
        cases = {c[0]: c[3] for c in NORMALISED if c[1:3] == (language, brackets)}
        options = dict(drop_digit_only=True, remove_brackets=brackets)
        expected = [(e, e, e or "") for e in cases.values()]

        def all_forms(c):
            return F.struct(
                tx.normalise(c, language, **options).alias("fixed"),
                tx.normalise(c, F.lit(language), **options).alias("by_row"),
                tx.normalise_or_empty(c, language, **options).alias("never_null"),
            )

        assert [tuple(r) for r in apply(spark, all_forms, list(cases))] == expected


def _all_characters(spark):
    codes = [c for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
    return spark.createDataFrame(pa.table({"code": codes, "t": [chr(c) for c in codes]})).repartition(8)


def test_digits_are_python_digits(spark):
    flagged = _all_characters(spark).filter(~tx.keeps_non_digits(F.col("t")))
    expected = {c for c in range(sys.maxunicode + 1) if chr(c).isdigit()}
    assert {r.code for r in flagged.select("code").collect()} == expected


def test_white_space_is_python_white_space(spark):
    blank = _all_characters(spark).filter(tx.squeeze_whitespace(F.col("t")) == "")
    expected = {c for c in range(sys.maxunicode + 1) if chr(c).isspace()}
    assert {r.code for r in blank.select("code").collect()} == expected


@pytest.mark.parametrize("language", ["en", *V.CJK_PUNCTUATION])
def test_punctuation_deletes_exactly_its_class(spark, language):
    gone = _all_characters(spark).filter(tx.remove_punctuation(F.col("t"), language) == "")
    expected = {ord(m) for m in V.ASCII_PUNCTUATION + V.CJK_PUNCTUATION.get(language, "")}
    assert {r.code for r in gone.select("code").collect()} == expected
    assert len(V.ASCII_PUNCTUATION) == 32


def test_composition_of_random_strings(spark):
    rng = random.Random(1)
    pool = "aeou\u0e01A\u1eb8\u093c\u0301\u0308\u0915\u1100\u1161\u11a8\uac00\u212b\uf900x "
    given = ["".join(rng.choices(pool, k=rng.randint(0, 12))) for _ in range(500)] + [None]
    expected = [g and unicodedata.normalize("NFC", g) for g in given]
    assert apply(spark, tx.nfc, given) == expected


def _kept_between(text, pairs, across_lines):
    """Brute force: delete shortest bracketed spans, one kind after the other."""
    for opening, closing in pairs:
        out, i = [], 0
        while i < len(text):
            end = text.find(closing, i + 1) if text[i] == opening else -1
            if end >= 0 and (across_lines or "\n" not in text[i:end]):
                i = end + 1
            else:
                out.append(text[i])
                i += 1
        text = "".join(out)
    return text


def test_brackets_against_brute_force(spark):
    rng = random.Random(2)
    given = ["".join(rng.choices("[]<>{}()ab \n\r ", k=rng.randint(0, 30))) for _ in range(800)]
    expected = [_kept_between(g, ("[]", "<>", "{}", "()"), False) for g in given]
    assert apply(spark, tx.strip_brackets, given) == expected


def test_cleaning_against_brute_force(spark):
    rng = random.Random(3)
    given = ["".join(rng.choices("<>{}ab- \n\t　", k=rng.randint(0, 30))) for _ in range(800)]

    def expected(text):
        # a dash goes if it has a dash beside it
        text = _kept_between(text, ("{}", "<>"), True)
        dashes = [c == "-" and "-" in (text[i - 1 : i], text[i + 1 : i + 2]) for i, c in enumerate(text)]
        return " ".join("".join(c for c, d in zip(text, dashes) if not d).split())

    assert apply(spark, tx.clean_transcript, given) == [expected(g) for g in given]


def test_normalise_table_defaults(spark):
    df = spark.createDataFrame([("A, B。", "ja"), (None, "en"), ("12", "en")], "text string, language string")
    assert [r.text for r in tables.normalise_table(df).collect()] == ["a b", "", "12"]
    assert [r.text for r in tables.normalise_table(df.select("text")).collect()] == ["a b。", "", "12"]
    dropped = tables.normalise_table(df, drop_digit_only=True)
    assert [r.text for r in dropped.collect()] == ["a b", "", ""]


def test_base_language(spark):
    assert apply(spark, tx.base_language, ["eng_Latn", "ZH_Hans_CN", "de", "", None]) == ["eng", "zh", "de", "", None]


def test_composition_of_every_code_point_and_of_marks_in_a_row(spark):
    """What passes the quick check stays in the JVM, and nothing that composition changes passes it."""
    points = [chr(p) for p in (*range(1, 0xD800), *range(0xE000, 0x30000)) if unicodedata.category(chr(p)) != "Cn"]
    marks = [c for c in points if unicodedata.combining(c)]
    pairs = [a + b for a in marks[::9] for b in marks[::17]]
    texts = [*points, *("a" + c for c in points), *("\u1100" + c for c in points), *pairs, *("क" + p for p in pairs)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", tx.nfc(F.col("t")).alias("n"), tx.may_change(F.col("t")).alias("sent"))
    wrong = [r.t for r in rows.collect() if r.n != unicodedata.normalize("NFC", r.t)]
    assert wrong == []
    plain = ["Größe déjà", "नमस्ते दुनिया", "日本語", "한국어", "كتاب", "x"]
    sent = spark.createDataFrame([(t,) for t in plain], "t string").where(tx.may_change(F.col("t"))).collect()
    assert sent == []
