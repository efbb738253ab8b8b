"""Declared column types, and which file types they may stand for."""

from __future__ import annotations

import re
from dataclasses import dataclass

#: Declared names by family.
NAMES = {
    "BOOLEAN": "bool", "BOOL": "bool",
    "INT2": "int2", "SMALLINT": "int2", "INT": "int4", "INT4": "int4", "INTEGER": "int4", "INT8": "int8", "BIGINT": "int8",
    "FLOAT4": "float4", "REAL": "float4", "FLOAT8": "float8", "DOUBLE": "float8", "DOUBLE PRECISION": "float8", "FLOAT": "float8",
    "TEXT": "text", "STRING": "text", "VARCHAR": "varchar", "CHARACTER VARYING": "varchar", "CHAR": "char", "CHARACTER": "char", "BPCHAR": "char",
    "DATE": "date", "TIMESTAMP": "timestamp", "TIMESTAMP WITHOUT TIME ZONE": "timestamp",
    "TIMESTAMPTZ": "timestamptz", "NUMERIC": "numeric", "DECIMAL": "numeric", "BYTEA": "bytea",
}
#: File kinds that each family may stand for. Narrowing isn't allowed, and the last three match nothing.
ALLOWED = {
    "bool": {"BOOLEAN"}, "int2": {"SHORT"}, "int4": {"SHORT", "INT"}, "int8": {"SHORT", "INT", "LONG"},
    "float4": {"FLOAT", "DOUBLE"}, "float8": {"FLOAT", "DOUBLE"}, "text": {"STRING"}, "varchar": {"STRING"}, "char": {"STRING"},
    "date": {"DATE"}, "timestamp": {"TIMESTAMP"}, "timestamptz": set(), "numeric": set(), "bytea": set(),
}
SPARK = {"bool": "boolean", "int2": "smallint", "int4": "int", "int8": "bigint", "float4": "float", "float8": "double", "text": "string", "varchar": "string", "char": "string", "date": "date", "timestamp": "timestamp_ntz"}
#: Bytes of a value, as a planner counts them; text by its usual length.
WIDTH = {"bool": 1, "int2": 2, "int4": 4, "int8": 8, "float4": 4, "float8": 8, "text": 32, "varchar": 32, "char": 32, "date": 4, "timestamp": 8}
#: Kinds that hold other values.
COMPLEX = {"LIST", "STRUCT", "MAP", "UNION"}


@dataclass(frozen=True)
class Declared:
    family: str
    size: int | None = None
    array: bool = False

    @classmethod
    def parse(cls, text: str) -> Declared:
        m = re.fullmatch(r"\s*([A-Za-z][A-Za-z0-9 ]*?)\s*(?:\(\s*(\d+)\s*(?:,\s*\d+\s*)?\))?\s*(?:NOT\s+NULL|not\s+null)?\s*((?:\[\s*\])?)\s*(?:NOT\s+NULL|not\s+null)?\s*", text)
        family = NAMES.get(" ".join(m[1].upper().split())) if m else None
        if not family:
            raise ValueError(f'unknown column type "{text}"')
        size = int(m[2]) if m[2] else (1 if family == "char" and m[1].upper() != "BPCHAR" else None)
        return cls(family, size, bool(m[3]))

    @property
    def spark(self) -> str:
        """Spark's type, of an item for arrays."""
        return SPARK[self.family]

    @property
    def width(self) -> int:
        own = self.size or WIDTH.get(self.family, 8)
        return 32 if self.array else own

    def matches(self, kind: str) -> bool:
        return kind in ALLOWED[self.family]
