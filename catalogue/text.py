"""Text functions over whole documents and pages."""

from pyspark.sql import functions as F

from catalogue.stand_ins import ADDED, ANNOTATED_SQL, annotated, documents, table
from sonoloom import fixed_values as V
from sonoloom.functions import text as tx
from sonoloom.operators import tables

# ---- the same steps as SQL text, for DuckDB ----


def sql_squeeze(x: str) -> str:
    return rf"trim(regexp_replace({x}, '[\s\x0b\x1c-\x1f\x{{85}}\p{{Z}}]+', ' ', 'g'))"


def sql_punct(x: str, marks: str = "") -> str:
    return f"regexp_replace({x}, '[[:punct:]{marks}]', '', 'g')"


def sql_brackets(x: str) -> str:
    for opening, closing in ("[]", "<>", "{}", "()"):
        x = rf"regexp_replace({x}, '(?-s)\{opening}.*?\{closing}', '', 'g')"
    return x


def sql_digit_only(x: str) -> str:
    digits = rf"\p{{Nd}}{V.OTHER_DIGITS}{V.NEWER_DECIMAL_DIGITS}"
    return rf"regexp_matches(replace({x}, ' ', ''), '\A[{digits}]+\z')"


def sql_normal(x: str, lower: bool = True, brackets: bool = False, digits: bool = False) -> str:
    x = f"nfc_normalize({x})"
    x = sql_punct(sql_brackets(x) if brackets else x)
    x = sql_squeeze(f"lower({x})" if lower else x)
    if digits:
        x = f"CASE WHEN {sql_digit_only(x)} THEN '' ELSE {x} END"
    return f"nullif({x}, '')"


def sql_clean(x: str, punct: bool = False) -> str:
    for pattern in (r"\{[^}]*\}", "<[^>]*>", "--+"):
        x = f"regexp_replace({x}, '{pattern}', '', 'g')"
    if punct:
        x = f"regexp_replace({x}, '[।॥?!,;:.''\"]', '', 'g')"
    return f"coalesce({sql_squeeze(x)}, '')"


# ---- inputs ----


def pages(spark, sf_dir):
    return table(spark, sf_dir, "pages")


# letters with accents, and the same as a letter with a combining mark
_ACCENTS = {"\u00e9": "e\u0301", "\u00e8": "e\u0300", "\u00fc": "u\u0308", "\u00f1": "n\u0303"}


def _decomposed(spark, sf_dir):
    text = F.col("text")
    for letter, parts in _ACCENTS.items():
        text = F.replace(text, F.lit(letter), F.lit(parts))
    return documents(spark, sf_dir).select("doc_id", text.alias("text"))


_DECOMPOSED_SQL = "text"
for _letter, _parts in _ACCENTS.items():
    _DECOMPOSED_SQL = f"replace({_DECOMPOSED_SQL}, '{_letter}', '{_parts}')"

_MARKS = " 。，、；：ー・…—ㆍ〜～々¨【"
_CODES = ("zh_Hans", "ja", "KO_Kore", "jpn_Jpan", "de")


def _cjk(spark, sf_dir):
    codes = F.array(*(F.lit(c) for c in _CODES))
    return documents(spark, sf_dir).select(
        "doc_id",
        F.concat("text", F.lit(_MARKS), "source", F.lit("】")).alias("text"),
        F.element_at(codes, (F.col("doc_id") % len(_CODES) + 1).cast("int")).alias("language"),
    )


_CJK_SQL = f"""
WITH cjk AS (
  SELECT doc_id, text || '{_MARKS}' || source || '】' AS text,
         CASE doc_id % 5 WHEN 0 THEN 'zh' WHEN 1 THEN 'ja' WHEN 2 THEN 'ko' END AS base FROM documents)
SELECT doc_id, CASE base
         WHEN 'zh' THEN {sql_punct("text", V.CJK_PUNCTUATION["zh"])}
         WHEN 'ja' THEN {sql_punct("text", V.CJK_PUNCTUATION["ja"])}
         WHEN 'ko' THEN {sql_punct("text", V.CJK_PUNCTUATION["ko"])}
         ELSE {sql_punct("text")} END AS text FROM cjk"""


def _spaced(spark, sf_dir):
    odd = F.lit("\t\u3000\x1c\u0085\u2028 ")
    return documents(spark, sf_dir).select(
        "doc_id", F.concat(odd, F.replace("text", F.lit(" "), odd), odd).alias("text")
    )


_ODD_SQL = "chr(9) || chr(12288) || chr(28) || chr(133) || chr(8232) || ' '"


def numbered(spark, sf_dir):
    """The documents, and more rows with texts of digits in various scripts."""
    doc = F.col("doc_id")
    text = (
        F.when(doc % 6 == 1, F.col("n_chars").cast("string"))
        .when(doc % 6 == 2, F.concat(F.lit("१२ "), doc.cast("string")))
        .when(doc % 6 == 3, F.concat(doc.cast("string"), F.lit("²③")))
        .when(doc % 6 == 4, F.lit("12\t3"))
        .when(doc % 6 == 5, F.lit(" "))
    )
    own = F.struct("doc_id", "text")
    added = F.when(text.isNotNull(), F.struct((doc + ADDED).alias("doc_id"), text.alias("text")))
    return documents(spark, sf_dir).select(F.inline(F.array_compact(F.array(own, added))))


NUMBERED_SQL = f"""
numbered AS (
  SELECT doc_id, text FROM documents
  UNION ALL
  SELECT doc_id + {ADDED}, CASE doc_id % 6 WHEN 1 THEN CAST(n_chars AS VARCHAR)
                                 WHEN 2 THEN '१२ ' || doc_id
                                 WHEN 3 THEN doc_id || '²③'
                                 WHEN 4 THEN '12' || chr(9) || '3'
                                 WHEN 5 THEN ' ' END
  FROM documents WHERE doc_id % 6 > 0)"""


def _over(source, key, column, function, name="text"):
    return lambda spark, sf_dir: source(spark, sf_dir).select(key, function(F.col(column)).alias(name))


def _docs(function):
    return _over(documents, "doc_id", "text", function)


def _pages(function):
    return _over(pages, "page_id", "html", function)


QUERIES = {
    "nfc": (
        _over(_decomposed, "doc_id", "text", tx.nfc),
        f"SELECT doc_id, nfc_normalize({_DECOMPOSED_SQL}) AS text FROM documents",
    ),
    "punct_default": (
        _docs(tx.remove_punctuation),
        f"SELECT doc_id, {sql_punct('text')} AS text FROM documents",
    ),
    "punct_cjk": (
        lambda spark, sf_dir: _cjk(spark, sf_dir).select(
            "doc_id", tx.remove_punctuation(F.col("text"), F.col("language")).alias("text")
        ),
        _CJK_SQL,
    ),
    "lower_case": (_docs(F.lower), "SELECT doc_id, lower(text) AS text FROM documents"),
    "squeeze_ws": (
        _over(_spaced, "doc_id", "text", tx.squeeze_whitespace),
        f"WITH spaced AS (SELECT doc_id, {_ODD_SQL} || replace(text, ' ', {_ODD_SQL}) || {_ODD_SQL} AS text"
        f" FROM documents) SELECT doc_id, {sql_squeeze('text')} AS text FROM spaced",
    ),
    "strip_brackets": (
        _pages(tx.strip_brackets),
        f"SELECT page_id, {sql_brackets('html')} AS text FROM pages",
    ),
    "digit_only_flag": (
        _over(numbered, "doc_id", "text", tx.keeps_non_digits, "keep"),
        f"WITH {NUMBERED_SQL} SELECT doc_id, NOT {sql_digit_only('text')} AS keep FROM numbered",
    ),
    "text_normalize": (
        _over(numbered, "doc_id", "text", lambda c: tx.normalise(c, "eng_Latn", drop_digit_only=True)),
        f"WITH {NUMBERED_SQL} SELECT doc_id, {sql_normal('text', digits=True)} AS text FROM numbered",
    ),
    "text_normalize_brackets": (
        _pages(lambda c: tx.normalise(c, "en", remove_brackets=True)),
        f"SELECT page_id, {sql_normal('html', brackets=True)} AS text FROM pages",
    ),
    "text_normalize_keep_case": (
        _docs(lambda c: tx.normalise(c, "de", lower_case=False)),
        f"SELECT doc_id, {sql_normal('text', lower=False)} AS text FROM documents",
    ),
    "normalize_table": (
        lambda spark, sf_dir: tables.normalise_table(
            documents(spark, sf_dir).select("doc_id", "text", "lang"), language_column="lang"
        ),
        f"SELECT doc_id, coalesce({sql_normal('text')}, '') AS text, lang FROM documents",
    ),
    "clean_transcript": (
        _over(annotated, "doc_id", "transcript", tx.clean_transcript),
        f"WITH {ANNOTATED_SQL} SELECT doc_id, {sql_clean('transcript')} AS text FROM annotated",
    ),
    "clean_transcript_punct": (
        _pages(lambda c: tx.clean_transcript(c, remove_punctuation=True)),
        f"SELECT page_id, {sql_clean('html', punct=True)} AS text FROM pages",
    ),
    "clean_table": (
        lambda spark, sf_dir: tables.clean_table(
            annotated(spark, sf_dir).select("doc_id", "transcript", "state")
        ),
        f"WITH {ANNOTATED_SQL} SELECT doc_id, {sql_clean('transcript')} AS transcript, state FROM annotated",
    ),
    "base_language": (
        lambda spark, sf_dir: table(spark, sf_dir, "documents").select(
            "doc_id", tx.base_language(F.concat(F.upper("lang"), F.lit("_Latn_"), "source")).alias("base")
        ),
        "SELECT doc_id, lang AS base FROM documents",
    ),
}
