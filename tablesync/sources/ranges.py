"""Ranges of a database table as SQL conditions: disjoint, complete, and of even size.

A range is cut where the rows are, not where the values are: the cut points are rows at equal steps of the
order, which the database finds. They may be values of several columns, so that a value which repeats is cut by
the next column. The conditions are plain comparisons that an index serves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

Texts = tuple[str, ...]


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def can_cut(kind: T.DataType) -> bool:
    """Whether values of a type have a literal that every engine orders as it does its columns."""
    return isinstance(kind, (
        T.IntegralType, T.DecimalType, T.FloatType, T.DoubleType, T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType))


def literal(text: str, kind: T.DataType, engine: str = "") -> str:
    """A value, given as bookmark text, as an SQL literal of an engine."""
    if isinstance(kind, (T.IntegralType, T.DecimalType, T.FloatType, T.DoubleType)):
        return text
    value = "'" + text.replace("'", "''") + "'"
    if isinstance(kind, T.StringType):
        return value
    engine, whole = engine.lower(), isinstance(kind, T.DateType)
    if whole:
        return f"DATE {value}" if engine == "oracle" else f"CAST({value} AS DATE)"
    # An instant keeps its offset where the engine has a type for it.
    zoned = isinstance(kind, T.TimestampType)
    if engine == "oracle":
        return f"TIMESTAMP {_spaced(value)}"
    if engine == "sqlserver":
        return f"CAST({value} AS {'DATETIMEOFFSET' if zoned else 'DATETIME2'})"
    if zoned and engine == "postgresql":
        return f"CAST({value} AS TIMESTAMP WITH TIME ZONE)"
    return f"CAST({_spaced(value)} AS TIMESTAMP)"


def _spaced(value: str) -> str:
    return value.replace("T", " ", 1) if value[11:12] == "T" else value


def _beyond(columns: Sequence[tuple[str, T.DataType]], cut: Texts, engine: str) -> str:
    """Rows after a cut point in the order of the columns."""
    name, value = quoted(columns[0][0]), literal(cut[0], columns[0][1], engine)
    if len(cut) == 1:
        return f"{name} > {value}"
    return f"({name} > {value} OR ({name} = {value} AND {_beyond(columns[1:], cut[1:], engine)}))"


def _up_to(columns: Sequence[tuple[str, T.DataType]], cut: Texts, engine: str, first: bool = True) -> str:
    """Rows at or before a cut point; NULLs of a later column come before its values."""
    name, value = quoted(columns[0][0]), literal(cut[0], columns[0][1], engine)
    if len(cut) == 1:
        inside = f"{name} <= {value}"
    else:
        inside = f"({name} < {value} OR ({name} = {value} AND {_up_to(columns[1:], cut[1:], engine, False)}))"
    return inside if first else f"({inside} OR {name} IS NULL)"


def conditions(
    columns: Sequence[tuple[str, T.DataType]], low: str | None = None, high: str | None = None, cuts: Sequence[Texts] = (),
    engine: str = "", nulls: bool | None = False,
) -> list[str]:
    """One condition per range: every row with low < first column <= high lies in exactly one of them.

    `columns` are names and types, `cuts` values of them in rising order, each cut the last row of its range; an end
    that is None is open. NULLs of the first column: in no range (False), in the first one (None), or in one of
    their own (True).
    """
    name, out = quoted(columns[0][0]), []
    ends = [c for i, c in enumerate(cuts) if i == 0 or c != cuts[i - 1]]
    for i in range(len(ends) + 1):
        parts = []
        if i:
            parts.append(_beyond(columns, ends[i - 1], engine))
        elif low is not None:
            parts.append(_beyond(columns, (low,), engine))
        if i < len(ends):
            parts.append(_up_to(columns, ends[i], engine))
        elif high is not None:
            parts.append(_up_to(columns, (high,), engine))
        out.append(" AND ".join(parts) or f"{name} IS NOT NULL")
    if nulls is None:
        out[0] = f"({out[0]} OR {name} IS NULL)"
    elif nulls:
        out.append(f"{name} IS NULL")
    return out


def inside(column: str, kind: T.DataType, low: str | None, high: str | None, engine: str = "") -> str:
    """The condition of the whole span."""
    return conditions([(column, kind)], low, high, (), engine)[0]


def cut_query(table: str, columns: Sequence[str], where: str, rows: int, parts: int, engine: str = "") -> str | None:
    """The query for the cut points (columns, place) of `parts` even ranges of `rows` rows; None where there is nothing to cut.

    Engines with window functions number the rows once. Others skip to each of the places.
    """
    step = -(-rows // parts)
    if parts < 2 or step >= rows:
        return None
    names = ", ".join(map(quoted, columns))
    if engine.lower() in ("postgresql", "oracle", "sqlserver", "db2"):
        rest = f"place % {step}" if engine.lower() == "sqlserver" else f"MOD(place, {step})"
        return f"SELECT {names}, place FROM (SELECT {names}, ROW_NUMBER() OVER (ORDER BY {names}) AS place FROM {table} WHERE {where}) numbered WHERE {rest} = 0 AND place < {rows}"
    return " UNION ALL ".join(
        f"SELECT {names}, {i} AS place FROM (SELECT {names} FROM {table} WHERE {where} ORDER BY {names} OFFSET {i * step - 1} ROWS FETCH NEXT 1 ROWS ONLY) at{i}"
        for i in range(1, -(-rows // step)))
