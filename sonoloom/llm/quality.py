"""Quality rules: words, symbols, repetition, and cross-document line frequency. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonoloom.llm.common import content_key, packed, written

_SPACE = r"[\x20\x09-\x0D]+"


def text_lines(text: Column) -> Column:
    """The lines of a text that have a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def with_base(df: DataFrame, text: Column) -> DataFrame:
    """`df` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long) and base_failed.

    Repeated words are counted by sorting the 3-word windows of a text by hash and place: equal neighbours
    mark their places, and the distance between marked places says how many words each adds. Texts whose
    windows are all different are not sorted.
    """
    whole = F.coalesce(text, F.lit(""))
    df = df.withColumns({"words": F.array_remove(F.split(whole, _SPACE), ""), "lines": text_lines(text)})
    hashes = F.transform("words", lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)))
    df = df.select(
        *[c for c in df.columns if c not in ("words", "lines")],
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count(whole, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size("words").cast("long").alias("n_words"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("words") >= 3, F.slice(hashes, 1, F.size("words") - 2)).alias("hashes"),
    )
    windows = F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    df = df.select(
        *[c for c in df.columns if c != "hashes"],
        F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), windows).alias("windows"),
    )
    twice = F.filter(
        "windows",
        lambda w, i: (F.get("windows", i - 1)["h"].eqNullSafe(w["h"])) | (F.get("windows", i + 1)["h"].eqNullSafe(w["h"])),
    )
    df = df.select(
        *[c for c in df.columns if c != "windows"], F.sort_array(F.transform(twice, lambda w: w["at"])).alias("places")
    )
    added = F.transform("places", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("places", i + 1) - p, F.lit(3))))
    repeats = F.coalesce(F.aggregate(added, F.lit(0), lambda a, b: a + b), F.lit(0)).cast("long")
    df = df.select(*[c for c in df.columns if c != "places"], repeats.alias("n_repeat_words"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return df.withColumn("base_failed", failed)


def plain_line(line: Column) -> Column:
    """A normalised line: lower case, one space between words and none around them, every digit as 0."""
    single = F.regexp_replace(line, r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")
    return F.regexp_replace(F.lower(F.trim(single)), r"[1-9]", "0")


def line_id(host: Column, plain: Column) -> Column:
    """16 bytes for a host and a normalised line."""
    return F.unhex(F.md5(F.concat(F.coalesce(host, F.lit("")), F.lit("\x00"), plain).cast("binary")))


def frequent_lines(docs: DataFrame, host: str = "source", max_docs: int = 20) -> DataFrame:
    """(`key`, `line`, `n_words`) for every line of a document that too many documents of its host have.

    `key` is the content key of doc_id, host and text, so repeated rows are one document, and `n_words` are the
    words that this line has in one of them. A line is too frequent if more than `max_docs` documents of its host
    have it, however large the host is. All counts are over all documents; a very common line is counted within
    each task first. Both sides of the join on the line are read or dealt anew, so its rows are split by the
    adaptive join.
    """
    each = docs.select(
        F.col(host).alias("host"), content_key("doc_id", host, "text").alias("key"), text_lines(F.col("text")).alias("lines")
    )  # before the lines are dealt out: the key is then taken once for each row, not for each line
    each = each.select("key", "host", F.posexplode_outer("lines").alias("at", "line")).where(F.col("line").isNotNull())
    each = each.select("key", "host", "at", plain_line(F.col("line")).alias("plain"))
    lines = each.select(
        "key", line_id(F.col("host"), F.col("plain")).alias("line"), (F.col("at") == 0).cast("long").alias("first"),
        (F.length("plain") - F.length(F.replace("plain", F.lit(" "), F.lit(""))) + 1).cast("long").alias("n"),
    )
    # Equal rows begin with the same line, which is therefore first as often as there are rows.
    once = written(lines.groupBy("line", "key").agg(F.sum("n").alias("n_words"), F.sum("first").alias("copies")))
    above = written(once.groupBy("line").agg(F.count("*").alias("n")).where(F.col("n") > max_docs).select("line"))
    repeated = once.where(F.col("copies") > 1).select("key", "copies")
    found = once.drop("copies").join(above, "line").join(repeated, "key", "left")
    return found.select("key", "line", F.expr("n_words div coalesce(copies, 1)").alias("n_words"))


def judged(
    docs: DataFrame, host: str = "source", max_docs: int = 20, min_left: float = 0.5
) -> DataFrame:
    """Every row as struct `row` with the base figures, `n_removed` words, `cleaned` text and `kept`.

    Lines that are too frequent on their host (see `frequent_lines`) are removed; a document is depleted
    if less than `min_left` of its words are left. `kept` is false for those and for base failures. Null
    and blank texts have no words and fail; null and empty hosts are one host; repeated rows are judged alike; an
    empty table gives no rows.
    """
    rows = with_base(packed(docs), F.col("row.text")).withColumn(
        "key", content_key(F.col("row.doc_id"), F.col(f"row.`{host}`"), F.col("row.text"))
    )
    removed = (
        frequent_lines(docs, host, max_docs)
        .groupBy("key")
        .agg(F.sum("n_words").alias("n"), F.collect_set("line").alias("gone"))  # lines of one document
        .withColumnRenamed("key", "k")
    )
    joined = rows.join(removed, F.col("key") == F.col("k"), "left")
    n_removed = F.coalesce("n", F.lit(0)).cast("long")
    kept = ~F.col("base_failed") & (F.col("n_words") - n_removed >= min_left * F.col("n_words"))
    left = F.filter(
        F.split(F.col("row.text"), "\n"),
        lambda x: ~F.array_contains("gone", line_id(F.col(f"row.`{host}`"), plain_line(x))) | ~x.rlike(r"[^\x20\x09-\x0D]"),
    )
    cleaned = F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(F.array_join(left, "\n"))
    return joined.select(
        "row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        n_removed.alias("n_removed"), cleaned.alias("cleaned"), kept.alias("kept"),
    )
