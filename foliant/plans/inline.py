"""Small literal tables that Spark and SQL engines read alike."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

_SQL_TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}


def _literal(value: object, kind: str) -> str:
    if value is None:
        return f"CAST(NULL AS {_SQL_TYPES[kind]})"
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return f"CAST({value!r} AS {_SQL_TYPES[kind]})"


@dataclass(frozen=True)
class Inline:
    name: str
    ddl: str
    rows: tuple[tuple, ...]

    def df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([tuple(r) for r in self.rows], self.ddl)

    @property
    def cte(self) -> str:
        columns = [c.split() for c in self.ddl.split(", ")]
        if not self.rows:
            return f"{self.name} AS (SELECT {', '.join(f'CAST(NULL AS {_SQL_TYPES[k]}) AS {n}' for n, k in columns)} WHERE FALSE)"
        values = ", ".join("(" + ", ".join(_literal(v, k) for v, (_, k) in zip(r, columns, strict=True)) + ")" for r in self.rows)
        return f"{self.name}({', '.join(n for n, _ in columns)}) AS (VALUES {values})"
