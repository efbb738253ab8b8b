"""What an ORC file says about itself: version, codec, stripes, types, row-group statistics. Read on the driver, per file."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class FileColumn:
    name: str
    kind: str
    type_id: int
    item_kind: str | None = None


@dataclass(frozen=True)
class Stripe:
    offset: int
    rows: int
    index_bytes: int
    data_bytes: int
    footer_bytes: int


@dataclass(frozen=True)
class FileMeta:
    path: str
    bytes: int
    version: str
    codec: str
    stride: int
    rows: int
    columns: tuple[FileColumn, ...]
    stripes: tuple[Stripe, ...]
    writer: str = ""


@dataclass(frozen=True)
class Stride:
    """One row group: of each column with statistics its least and greatest value, and how many values aren't null."""

    stripe: int
    number: int
    first_row: int
    rows: int
    bounds: dict[str, tuple[Any, Any]] = field(default_factory=dict)
    values: dict[str, int] = field(default_factory=dict)


def _conf(spark: SparkSession):
    return spark._jsparkSession.sessionState().newHadoopConf()


def data_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(path, bytes) of the data files at path: itself, or those below a folder, by name; empty if there are none."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(_conf(spark))
    found = fs.globStatus(p)
    out = []
    for status in found or []:
        if status.isFile():
            out.append((status.getPath().toString(), status.getLen()))
            continue
        files = fs.listFiles(status.getPath(), True)
        while files.hasNext():
            f = files.next()
            if not f.getPath().getName().startswith(("_", ".")):
                out.append((f.getPath().toString(), f.getLen()))
    return sorted(out)


def remove(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(_conf(spark)).delete(p, True)


def _open(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.orc.OrcFile.createReader(jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.orc.OrcFile.readerOptions(_conf(spark)))


def read_footer(spark: SparkSession, path: str) -> FileMeta:
    reader = _open(spark, path)
    schema = reader.getSchema()
    columns = []
    for name, child in zip(schema.getFieldNames(), schema.getChildren(), strict=True):
        kind = child.getCategory().toString()
        columns.append(FileColumn(name, kind, child.getId(), child.getChildren()[0].getCategory().toString() if kind == "LIST" else None))
    stripes = tuple(Stripe(s.getOffset(), s.getNumberOfRows(), s.getIndexLength(), s.getDataLength(), s.getFooterLength()) for s in reader.getStripes())
    return FileMeta(path, reader.getContentLength(), reader.getFileVersion().getName(), reader.getCompressionKind().toString(), reader.getRowIndexStride(), reader.getNumberOfRows(), tuple(columns), stripes, reader.getWriterVersion().toString())


#: So many files are held against the first one by one, in threads; of more, types and further columns are compared in tasks.
FEW_FILES = 5000


def odd_file(spark: SparkSession, files: list[tuple[str, int]]) -> tuple[str, str] | None:
    """The first file whose columns aren't the first file's, by order, name and type, and what they are; None: all are alike.

    Over FEW_FILES files: whether Spark's own merging of all footers, which runs as a job, finds other columns or types."""
    if len(files) < 2:
        return None
    first = spark.read.orc(files[0][0]).schema
    if len(files) > FEW_FILES:
        try:
            merged = spark.read.option("mergeSchema", "true").orc([p for p, _ in files]).schema
        except Exception as e:
            if "MERGE" not in str(e).upper():
                raise
            return "of the folder", "types differ"
        return None if merged == first else ("of the folder", merged.simpleString())
    jvm, conf = spark.sparkContext._jvm, _conf(spark)
    paths = [jvm.org.apache.hadoop.fs.Path(p) for p, _ in files]
    statuses = jvm.PythonUtils.toSeq([p.getFileSystem(conf).getFileStatus(p) for p in paths])
    found = jvm.org.apache.spark.sql.execution.datasources.orc.OrcUtils.readOrcSchemasInParallel(statuses, conf, False)
    if found.size() == len(files) and found.distinct().size() == 1:
        return None
    for k in range(found.size()):
        if found.apply(k) != found.apply(0):
            return files[k][0], found.apply(k).catalogString()
    return files[-1][0], "no columns"


def _bounds(s) -> tuple[Any, Any] | None:
    for has, get in ((s.hasIntStatistics, s.getIntStatistics), (s.hasDoubleStatistics, s.getDoubleStatistics), (s.hasStringStatistics, s.getStringStatistics), (s.hasDateStatistics, s.getDateStatistics)):
        if has():
            own = get()
            if own.hasMinimum() and own.hasMaximum():
                return own.getMinimum(), own.getMaximum()
    return None


def read_strides(spark: SparkSession, path: str, columns: set[str] | None = None) -> list[Stride]:
    """The row index of a file, of all or the named columns; without one, a stride for each stripe, without bounds. Dates are days since 1970."""
    meta, reader = read_footer(spark, path), _open(spark, path)
    out, first = [], 0
    if not meta.stride:
        for k, s in enumerate(meta.stripes):
            out.append(Stride(k, 0, first, s.rows))
            first += s.rows
        return out
    wanted = [c for c in meta.columns if columns is None or c.name in columns]
    rows = reader.rows()
    try:
        for k, s in enumerate(meta.stripes):
            groups = rows.readRowIndex(k, None, None).getRowGroupIndex() if s.index_bytes else None
            for n in range(-(-s.rows // meta.stride)):
                bounds, values = {}, {}
                for c in wanted:
                    index = groups[c.type_id] if groups is not None else None
                    if index is not None and n < index.getEntryCount():
                        own = index.getEntry(n).getStatistics()
                        values[c.name] = own.getNumberOfValues()
                        if (b := _bounds(own)) is not None and c.kind not in ("BOOLEAN", "TIMESTAMP", "LIST"):
                            bounds[c.name] = b
                out.append(Stride(k, n, first, min(meta.stride, s.rows - n * meta.stride), bounds, values))
                first += out[-1].rows
    finally:
        rows.close()
    return out


def read_stripes(spark: SparkSession, path: str) -> list[Stride]:
    """Statistics of each stripe of a file as a whole, which scans skip by before its row groups (number is -1)."""
    meta, reader = read_footer(spark, path), _open(spark, path)
    out, first = [], 0
    for k, (stripe, found) in enumerate(zip(meta.stripes, reader.getStripeStatistics(), strict=True)):
        own = {c.name: found.getColumn(c.type_id) for c in meta.columns}
        values = {name: x.getNumberOfValues() for name, x in own.items()}
        bounds = {c.name: b for c in meta.columns if c.kind not in ("BOOLEAN", "TIMESTAMP", "LIST") and (b := _bounds(own[c.name])) is not None}
        out.append(Stride(k, -1, first, stripe.rows, bounds, values))
        first += stripe.rows
    return out
