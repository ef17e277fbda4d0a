"""Order-insensitive, exact comparison of a Spark result with a DuckDB result."""

import math


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, bool):
        return f"bool {value}"
    return f"{type(value).__name__} {value!r}"


def rows(columns, tuples):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(t[i]) for i in order) for t in tuples)


def differences(df, connection, sql):
    """Empty if both give the same columns and the same rows with the same values."""
    table = df.toArrow()
    mine = rows(table.column_names, list(zip(*(c.to_pylist() for c in table.columns))))
    result = connection.execute(sql)
    names = [c[0] for c in result.description]
    theirs = rows(names, result.fetchall())
    if sorted(names) != sorted(table.column_names):
        return [("columns", sorted(table.column_names), sorted(names))]
    if len(mine) != len(theirs):
        return [("row count", len(mine), len(theirs))]
    return [(a, b) for a, b in zip(mine, theirs) if a != b]
