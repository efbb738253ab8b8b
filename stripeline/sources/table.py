"""A declared table over ORC files.

Columns are matched to the file by position, never by name. Declared types are checked against the file's own before
a scan is returned; the scan reads the file's physical schema and projects it to the declared names and types, so
that filters reach the row-group statistics through the projection.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import char_equal, converted
from .footer import FileMeta, data_files, odd_file, read_footer
from .types import COMPLEX, Declared

#: Options by where they may stand.
VALID = {"table": ("filename", "drop_null_items", "strict_version"), "server": ("drop_null_items", "strict_version"), "column": ()}
#: What a hint names: the option that a table needs, and what a server may have.
HINT = {"table": "filename", "server": ", ".join(VALID["server"]), "column": ""}
FIRST_VERSION = "0.11"


class TableError(ValueError):
    """A table definition that can't be used, or doesn't fit its file."""

    def __init__(self, message: str, hint: str = ""):
        super().__init__(message + (f"\nHINT: {hint}" if hint else ""))
        self.message, self.hint = message, hint


def check_options(options: dict[str, str], context: str = "table") -> None:
    for name in options:
        if name not in VALID[context]:
            raise TableError(f'invalid option "{name}"', f"Valid options in this context are: {HINT[context]}")
    if context == "table" and "filename" not in options:
        raise TableError("filename is required for ORC tables")


@dataclass(frozen=True)
class Server:
    """Options that tables fall back to."""

    name: str = "orc_server"
    options: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        check_options(self.options, "server")


def check_columns(columns: list[tuple[str, Declared]], selected: set[int], meta: FileMeta) -> None:
    """Rules in order: per file column its kind and, if selected, its type; then selected columns that the file lacks;
    then the number of columns."""
    for k, own in enumerate(meta.columns):
        declared = columns[k][1] if k < len(columns) and k in selected else None
        if own.kind == "LIST":
            if declared and not (declared.array and declared.matches(own.item_kind)):
                raise TableError(f"Error occurred while reading column {own.type_id}: ORC and PSQL types do not match, ORC type is {own.item_kind}[]")
            if own.item_kind in COMPLEX:
                raise TableError("Only lists of primitive types are supported currently")
        elif own.kind in ("STRUCT", "MAP"):
            raise TableError(f"{own.kind} kind in ORC files aren't supported")
        elif declared and (declared.array or not declared.matches(own.kind)):
            raise TableError(f"Error occurred while reading column {own.type_id}: ORC and PSQL types do not match, ORC type is {own.kind}")
    if any(k >= len(meta.columns) for k in selected):
        raise TableError("Table definition has more columns than the ORC file")
    if len(columns) != len(meta.columns):
        raise TableError("Column count in table definition does not match with ORC file.")
    for own in meta.columns:
        if own.kind in ("DECIMAL", "UNION"):
            raise TableError(f"Use of not supported type: {own.kind}")


class OrcTable:
    """columns: (name, declared type) in the file's order. The file needn't exist before the first scan."""

    def __init__(self, spark: SparkSession, name: str, columns: list[tuple[str, str]], options: dict[str, str], server: Server | None = None):
        check_options(options)
        self.spark, self.name = spark, name
        self.columns = [(c, Declared.parse(t)) for c, t in columns]
        self.options = (server.options if server else {}) | options
        self.path = self.options["filename"]

    @classmethod
    def of(cls, spark: SparkSession, name: str, path: str) -> OrcTable:
        """A table declared as its file is."""
        back = {"BOOLEAN": "BOOL", "SHORT": "INT2", "INT": "INT4", "LONG": "INT8", "FLOAT": "FLOAT4", "DOUBLE": "FLOAT8", "STRING": "TEXT", "DATE": "DATE", "TIMESTAMP": "TIMESTAMP"}
        files = data_files(spark, path)
        if not files:
            raise TableError(f"Error opening file {path}")
        columns = [(c.name, back[c.item_kind] + "[]" if c.kind == "LIST" else back[c.kind]) for c in read_footer(spark, files[0][0]).columns]
        return cls(spark, name, columns, {"filename": path})

    def files(self) -> list[tuple[str, int]]:
        found = data_files(self.spark, self.path)
        if not found:
            raise TableError(f"Error opening file {self.path}")
        return found

    def meta(self) -> FileMeta:
        """Of the first file, to which all others are held: the same columns in the same order, with the same types."""
        try:
            files = self.files()
            meta = read_footer(self.spark, files[0][0])
            other = odd_file(self.spark, files)
        except TableError:
            raise
        except Exception as e:
            raise TableError(f"Error reading file {self.path}: it is no ORC file") from e
        if other:
            raise TableError(f"Error reading file {other[0]}: its columns aren't those of {files[0][0]}: {other[1]}")
        if self.options.get("strict_version", "false") == "true" and meta.version != FIRST_VERSION:
            raise TableError(f"Unsupported file version {meta.version}, only {FIRST_VERSION} is read")
        return meta

    def scan(self, columns: list[str] | None = None) -> DataFrame:
        """All columns, or the named ones in declared order; only these are checked by type."""
        names = [c for c, _ in self.columns]
        if columns is not None and (missing := set(columns) - set(names)):
            raise TableError(f'column "{sorted(missing)[0]}" does not exist')
        wanted = [k for k, c in enumerate(names) if columns is None or c in columns]
        meta = self.meta()
        check_columns(self.columns, set(wanted), meta)
        drop = self.options.get("drop_null_items", "true") == "true"
        rows = self.spark.read.orc(self.path)
        return rows.select(*(converted(F.col(f"`{meta.columns[k].name}`"), self.columns[k][1], drop, names[k]).alias(names[k]) for k in wanted))

    def count(self) -> DataFrame:
        """count(*) without reading a column."""
        check_columns(self.columns, set(), self.meta())
        return self.spark.read.orc(self.path).agg(F.count("*").alias("count"))

    def where_char_equal(self, column: str, value: str) -> DataFrame:
        """Rows whose fixed-length column equals value under blank padding, with a bound on the raw column that reaches
        the row-group statistics: every padded form of v lies from v up to v followed by the character after the blank."""
        k = [c for c, _ in self.columns].index(column)
        meta = self.meta()
        check_columns(self.columns, set(range(len(self.columns))), meta)
        raw = F.col(f"`{meta.columns[k].name}`")
        rows = self.spark.read.orc(self.path).where(char_equal(raw, value))
        drop = self.options.get("drop_null_items", "true") == "true"
        return rows.select(*(converted(F.col(f"`{meta.columns[i].name}`"), t, drop, c).alias(c) for i, (c, t) in enumerate(self.columns)))

    def register(self, view: str | None = None) -> DataFrame:
        """A temporary view of the whole table, for SQL."""
        rows = self.scan()
        rows.createOrReplaceTempView(view or self.name)
        return rows

    def create(self, catalog_name: str | None = None) -> None:
        """A catalog table over the same files, with the file's own names and types."""
        self.spark.sql(f"CREATE TABLE {catalog_name or self.name} USING orc LOCATION '{self.path}'")

    def stream(self, columns: list[str] | None = None, **options: str) -> DataFrame:
        """New files of a folder as a stream, under the same projection."""
        meta = self.meta()
        names = [c for c, _ in self.columns]
        wanted = [k for k, c in enumerate(names) if columns is None or c in columns]
        check_columns(self.columns, set(wanted), meta)
        rows = self.spark.readStream.schema(self.spark.read.orc(self.path).schema).options(**options).orc(self.path)
        drop = self.options.get("drop_null_items", "true") == "true"
        return rows.select(*(converted(F.col(f"`{meta.columns[k].name}`"), self.columns[k][1], drop, names[k]).alias(names[k]) for k in wanted))


def write_orc(rows: DataFrame, path: str, codec: str = "zlib", stride: int = 10_000, mode: str = "errorifexists", partition_by: list[str] | None = None, **options: str) -> str:
    """Zone-less timestamps are written as ORC timestamps (Spark would store them as numbers)."""
    kept: list[Column] = [F.col(f"`{c}`").cast("timestamp").alias(c) if kind == "timestamp_ntz" else F.col(f"`{c}`") for c, kind in rows.dtypes]
    out = rows.select(*kept).write.mode(mode).option("compression", codec).option("orc.row.index.stride", str(stride)).options(**options)
    (out.partitionBy(*partition_by) if partition_by else out).orc(path)
    return path


def csv_to_orc(spark: SparkSession, source: str, path: str, columns: list[tuple[str, str]], header: bool = True, **options: str) -> str:
    """Text files with the declared columns, in this order, as ORC. A line that doesn't fit the declared types fails the job, unless options say otherwise."""
    schema = ", ".join(f"`{c}` {Declared.parse(t).spark}" for c, t in columns)
    rows = spark.read.schema(schema).options(**({"header": str(header).lower(), "mode": "FAILFAST", "enforceSchema": "true"} | options)).csv(source)
    return write_orc(rows, path)
