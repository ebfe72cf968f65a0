"""The registered queries and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without SQL only its rows are checked."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round double columns, so that both engines agree; adding 0 drops the sign of zero."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in doubles})


def rounded_sql(sql: str, columns: Sequence[str], digits: int = 6) -> str:
    """The same for SQL, with the double columns named."""
    cells = ", ".join(f"round({c}, {digits}) + 0.0E0 AS {c}" for c in columns)
    return f"SELECT * REPLACE ({cells}) FROM ({sql})"


def with_tables(parts: dict[str, str], body: str) -> str:
    """``WITH name AS (...), ... body``."""
    return "WITH " + ", ".join(f"{n} AS ({t})" for n, t in parts.items()) + " " + body
