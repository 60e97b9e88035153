"""A registered query: a Spark plan, its columns, and an independent SQL formulation.

The column list drives both sides. Kinds: ``s`` text, ``i`` integer, ``b`` boolean, ``t``
timestamp without zone, ``D`` date, ``a`` array of text (joined by commas), ``dN`` double rounded
to N digits.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.registry.adapters import Warehouse, warehouse
from tickloom.registry.oracle import query


@dataclass(frozen=True)
class Entry:
    name: str
    covers: str
    columns: str
    build: Callable[[Warehouse], DataFrame]
    sql: str | None = None
    replaced: tuple[tuple[str, str], ...] = ()

    def _columns(self) -> list[tuple[str, str]]:
        return [tuple(item.split(":")) for item in self.columns.split()]

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.build(warehouse(spark, sf_dir))
        return df.select(*[_spark_column(name, kind) for name, kind in self._columns()])

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        shown = ", ".join(_sql_column(name, kind) for name, kind in self._columns())
        return query(f"SELECT {shown} FROM ({self.sql})", **dict(self.replaced))


def _spark_column(name: str, kind: str) -> Column:
    column = F.col(name)
    if kind.startswith("d"):
        made = F.round(column.cast("double"), int(kind[1:])) + F.lit(0.0)
    elif kind == "t":
        made = column.cast("timestamp_ntz")
    elif kind == "a":
        made = F.array_join(column, ",")
    else:
        made = column.cast({"s": "string", "i": "bigint", "b": "boolean", "D": "date"}[kind])
    return made.alias(name)


def _sql_column(name: str, kind: str) -> str:
    column = f'"{name}"'
    if kind.startswith("d"):
        made = f"round({column}::DOUBLE, {kind[1:]}) + 0::DOUBLE"
    elif kind == "a":
        made = f"array_to_string({column}, ',')"
    else:
        kinds = {"s": "VARCHAR", "i": "BIGINT", "b": "BOOLEAN", "D": "DATE", "t": "TIMESTAMP"}
        made = f"{column}::{kinds[kind]}"
    return f"{made} AS {column}"
