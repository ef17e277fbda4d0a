"""The registered queries: a Spark query and, beside it, the SQL that must give the same rows."""

from catalogue import audio, composites, storage, tables, text


def registered() -> dict:
    """Key -> (query(spark, sf_dir) -> DataFrame, DuckDB SQL)."""
    merged: dict = {}
    for module in (text, tables, audio, storage, composites):
        merged.update(module.QUERIES)
    return merged
