"""Secret scans through a blob ledger: each text version is scanned once for each version of each rule."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sonoloom.llm.common import written

SPANS = "array<struct<kind:string,start:int,end:int>>"
_LEDGER = f"blob binary, rules array<string>, spans {SPANS}"


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of a pattern, of which `group` has at least `least` characters."""

    kind: str
    pattern: str
    group: int
    least: int
    any_case: bool = False

    @property
    def version(self) -> str:
        """Kind and digest of all that decides on the matches: a changed rule is another version."""
        said = "\x00".join([self.pattern, str(self.group), str(self.least), str(self.any_case)])
        return f"{self.kind}@{hashlib.sha256(said.encode()).hexdigest()[:16]}"


#: The first three are the base rules; kinds at one start are listed in this order.
RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 6, any_case=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
    Rule("forge", r"gh[opsru]_[A-Za-z0-9]+", 0, 40),
    Rule("private", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
)
BASE = ("assign", "access", "hex")


def _scanner(rules: tuple[Rule, ...]):
    compiled = [
        (r.version, r.kind, re.compile(r.pattern, re.ASCII | (re.IGNORECASE if r.any_case else 0)), r.group, r.least)
        for r in rules
    ]

    @F.arrow_udf(SPANS)
    def scan(texts: pa.Array, wanted: pa.Array) -> pa.Array:
        out = []
        for text, versions in zip(texts, wanted):
            text, versions, found = text.as_py() or "", set(versions.as_py()), []
            for place, (version, kind, pattern, group, least) in enumerate(compiled):
                if version in versions:
                    found += [
                        (m.start(), place, {"kind": kind, "start": m.start(), "end": m.end()})
                        for m in pattern.finditer(text)
                        if m.end(group) - m.start(group) >= least
                    ]
            out.append([span for *_, span in sorted(found, key=lambda f: f[:2])])
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        return pa.array(out, kind)

    return scan


def _entries(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(_LEDGER).parquet(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], _LEDGER)


def blob_id(text: Column) -> Column:
    """SHA-256 of the text in UTF-8, the address of its content; a null text is the empty one."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def update_ledger(versions: DataFrame, path: str, rules: tuple[Rule, ...] = RULES) -> None:
    """Scan the texts of `versions` for what the ledger at `path` has not seen, and append the findings.

    A ledger row is one scan of one blob: the rule versions it applied and the spans they found (code
    points, end exclusive). A blob is scanned for those rule versions only that no row of it names. Copies
    are joined before the shuffle, so a text that very many versions share travels once for each task.
    """
    spark = versions.sparkSession
    seen = (
        _entries(spark, path).groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
    )  # no longer than all rule versions there have been
    blobs = versions.select(blob_id(F.col("text")).alias("blob"), "text").groupBy("blob").agg(F.first("text").alias("text"))
    now = F.array(*[F.lit(r.version) for r in rules])
    unseen = F.array_except(now, F.coalesce("seen", F.array().cast("array<string>")))
    todo = blobs.join(seen, "blob", "left").select("blob", "text", unseen.alias("rules")).where(F.size("rules") > 0)
    scan = _scanner(rules)
    todo.select("blob", "rules", scan("text", "rules").alias("spans")).write.mode("append").parquet(path)


def findings(versions: DataFrame, path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Every row of `versions` as struct `row`, with the `spans` the ledger has for its text, by start and kind.

    Only findings of the given rules' present versions count. Null texts are empty and have no spans;
    repeated rows and other paths of the same text each get its spans. A text that was never scanned has
    null, so run `update_ledger` before.
    """
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    wanted = F.array(*[F.lit(r.version) for r in rules])
    kinds = F.transform("rules", lambda r: F.when(F.array_contains(wanted, r), F.substring_index(r, "@", 1)))
    valid = F.filter("spans", lambda s: F.array_contains(kinds, s["kind"]))
    present = versions.select(blob_id(F.col("text")).alias("blob")).distinct()
    known = (
        _entries(versions.sparkSession, path)
        .join(present, "blob", "left_semi")
        .select("blob", valid.alias("spans"))
        .groupBy("blob")
        .agg(F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans"))  # the spans of one text, a scan recorded twice once
    )
    placed = F.sort_array(
        F.transform("spans", lambda s: F.struct(s["start"].alias("at"), order[s["kind"]].alias("kind"), s.alias("span")))
    )
    # Written, so that it is no aggregation in the join: adaptive execution then splits a blob with very many paths.
    sorted_spans = written(known.select(F.col("blob").alias("b"), F.transform(placed, lambda p: p["span"]).alias("spans")))
    rows = versions.select(
        F.struct(*[F.col(f"`{c}`") for c in versions.columns]).alias("row"), blob_id(F.col("text")).alias("blob")
    )
    return rows.join(sorted_spans, F.col("blob") == F.col("b"), "left").select("row", "spans")


def redacted(versions: DataFrame, path: str, rules: tuple[Rule, ...] = RULES, mark: str = "[secret]") -> DataFrame:
    """`versions` with every found span of `text` replaced by `mark`; overlapping spans become one mark."""
    found = findings(versions, path, rules)

    @F.arrow_udf("string")
    def masked(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for text, found in zip(texts, spans):
            text, found, at, parts = text.as_py(), found.as_py(), 0, []
            for span in found or []:
                if span["start"] >= at:
                    parts += [text[at : span["start"]], mark]
                at = max(at, span["end"])
            out.append(text if not found else "".join([*parts, text[at:]]))
        return pa.array(out, pa.string())

    names = versions.columns
    new = F.when(F.size("spans") > 0, masked(F.col("row.text"), F.col("spans"))).otherwise(F.col("row.text"))
    return found.select(*[new.alias(n) if n == "text" else F.col(f"row.`{n}`").alias(n) for n in names])
