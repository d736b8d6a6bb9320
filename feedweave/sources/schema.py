"""Registered feed schemas: ordered column names with one of five types, and key columns."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from feedweave.functions.coerce import cut, lenient_date, lenient_float, lenient_int, round_money, trim_blanks
from feedweave.operators.profile import header_names

# Ids and names of the column types, and the text length of a String.
COLUMN_TYPES = {1: "String", 2: "Integer", 3: "Float", 4: "Date", 5: "Description"}
STRING_LENGTH = 250
SPARK_TYPES = {
    "String": T.StringType(),
    "Integer": T.IntegerType(),
    "Float": T.DecimalType(12, 2),
    "Date": T.DateType(),
    "Description": T.StringType(),
}
ARROW = "→"  # separates the steps of a conversion rule


@dataclass(frozen=True)
class FeedSpec:
    """A registered feed. ``bad_date`` and ``decimal_comma`` are explained at the coercions.

    Quoted fields may hold line breaks; with ``multi_line=False`` every line is a record, and one
    with an open quote a reject.
    ``after_import`` is a SELECT over ``{<name>}`` whose rows replace the loaded ones.
    """

    name: str
    columns: tuple[tuple[str, str], ...]
    keys: tuple[str, ...] = ()
    path: str = ""
    delimiter: str = ";"
    enclosure: str = '"'
    header: bool = False
    skip_lines: int = 0
    conversion: tuple[str, ...] = ("csv",)
    multi_line: bool = True
    encoding: str = "UTF-8"
    bad_date: str = "epoch"
    decimal_comma: bool = False
    after_import: str = ""

    def __post_init__(self) -> None:
        unknown = [kind for _, kind in self.columns if kind not in SPARK_TYPES]
        if unknown:
            raise ValueError(f"unknown column types {unknown}")
        names = [name for name, _ in self.columns]
        if len(set(names)) != len(names):
            raise ValueError("a column name occurs twice")
        missing = [key for key in self.keys if key not in names]
        if missing:
            raise ValueError(f"key columns {missing} are not in the feed")

    @staticmethod
    def from_header(name: str, header: str, kinds: Mapping[str, str] | None = None, **options: Any) -> FeedSpec:
        """The spec of a file whose first line names its columns; ``kinds`` gives types other than String."""
        delimiter, enclosure = options.get("delimiter", ";"), options.get("enclosure", '"')
        names = header_names(header, delimiter, enclosure)
        kinds = kinds or {}
        return FeedSpec(name, tuple((n, kinds.get(n, "String")) for n in names), header=True, **options)

    @staticmethod
    def from_record(record: Mapping[str, Any]) -> FeedSpec:
        """The spec a registry row describes."""
        columns = json.loads(record["columns"])
        kinds = [COLUMN_TYPES[int(kind)] for kind in columns["type"]]
        return FeedSpec(
            name=record["local_name"],
            columns=tuple(zip(columns["name"], kinds, strict=True)),
            keys=tuple(json.loads(record["indices"] or "[]")),
            path=record["path"],
            delimiter=record["delimiter"] or ";",
            enclosure=record["enclosure"] or '"',
            header=bool(record["csv_header_row"]),
            skip_lines=int(record["empty_lines"] or 0),
            conversion=tuple(step.strip() for step in (record["conversion_rule"] or "csv").split(ARROW)),
            after_import=record.get("sql_after_import") or "",
            multi_line=record.get("multi_line") is not False,
        )

    def raw_schema(self, bad_line: str) -> T.StructType:
        """All columns as text, plus the column that keeps a line with a wrong field count."""
        names = [name for name, _ in self.columns]
        return T.StructType([T.StructField(name, T.StringType()) for name in [*names, bad_line]])

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(name, SPARK_TYPES[kind]) for name, kind in self.columns])

    def coercions(self) -> list[Column]:
        """One expression per column that turns its text into the stored value."""
        return [self._coerce(F.col(f"`{name}`"), kind).alias(name) for name, kind in self.columns]

    def coercion(self, name: str) -> Column:
        """The expression for one column."""
        return self._coerce(F.col(f"`{name}`"), dict(self.columns)[name])

    def _coerce(self, c: Column, kind: str) -> Column:
        if kind == "Integer":
            return lenient_int(c)
        if kind == "Float":
            return round_money(lenient_float(c, self.decimal_comma))
        if kind == "Date":
            return lenient_date(c, self.bad_date)
        if kind == "String":
            return cut(trim_blanks(c), STRING_LENGTH)
        return trim_blanks(c)


def registered_columns(resources: DataFrame) -> DataFrame:
    """The registry's JSON schemas as rows: feed, position, column, type, whether a key."""
    columns = F.from_json("columns", "struct<name: array<string>, type: array<string>>")
    keys = F.from_json("indices", "array<string>")
    names = F.create_map(*[F.lit(x) for pair in COLUMN_TYPES.items() for x in pair])
    pairs = F.arrays_zip(columns["name"].alias("column_name"), columns["type"].alias("type_id"))
    listed = resources.select("local_name", keys.alias("_keys"), F.posexplode(pairs).alias("position", "_column"))
    return listed.select(
        "local_name",
        "position",
        F.col("_column.column_name").alias("column_name"),
        F.element_at(names, F.col("_column.type_id").try_cast("int")).alias("type_name"),
        F.coalesce(F.array_contains("_keys", F.col("_column.column_name")), F.lit(False)).alias("is_key"),
    )
