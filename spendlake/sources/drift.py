"""Snapshots whose files do not all have the same schema.

A reader that takes its schema from one footer loses columns, or fails in the middle of a job, once several writers or
versions have filled a folder. Here the footers of all files are read in tasks, a few columns' kinds come back, and one
schema that holds every file is worked out by a fixed rule or refused before any row is read.

The rule: a type may only be widened where no value changes.

* byte -> short -> int -> long; byte, short, int and float -> double
* integers and decimals -> the decimal with digits enough on both sides of the point, 38 at most
* date -> timestamp without time zone
* structs field by field, arrays and maps by what they hold; void gives way to anything
* a column some files lack is NULL in their rows, unless it is required

Anything else is refused: long and double (beyond 2^53 they differ), text and number, timestamps with and without zone,
names that differ in case only. Columns come in the order of their first place in any file, then by name. A folder
without files fails, files without rows count like any other.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

from spendlake.errors import SchemaDrift

MOST_KINDS = 20_000  # distinct (column, type) of one snapshot; they come to the driver
KINDS = "name string, kind string, place int, path string"
SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"

# What Spark reads unsigned integers as; digits of each integer type; types by width.
UNSIGNED = {
    pa.uint8(): T.ShortType(),
    pa.uint16(): T.IntegerType(),
    pa.uint32(): T.LongType(),
    pa.uint64(): T.DecimalType(20, 0),
}
DIGITS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 20}
INTEGERS = list(DIGITS)
IN_DOUBLE = [*INTEGERS[:3], T.FloatType(), T.DoubleType()]


def widened(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type that holds every value of both, or None."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return _widened_struct(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        inner = widened(a.elementType, b.elementType)
        return inner and T.ArrayType(inner)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        key, value = widened(a.keyType, b.keyType), widened(a.valueType, b.valueType)
        return T.MapType(key, value) if key and value else None
    if a in INTEGERS and b in INTEGERS:
        return max(a, b, key=INTEGERS.index)
    if {a, b} == {T.DateType(), T.TimestampNTZType()}:
        return T.TimestampNTZType()
    if a in IN_DOUBLE and b in IN_DOUBLE:
        return T.DoubleType()
    return _widened_decimal(a, b)


def _widened_struct(a: T.StructType, b: T.StructType) -> T.StructType | None:
    fields = {f.name: f.dataType for f in a}
    for f in b:
        kind = widened(fields.get(f.name, T.NullType()), f.dataType)
        if kind is None:
            return None
        fields[f.name] = kind
    if len({n.lower() for n in fields}) < len(fields):
        return None
    return T.StructType([T.StructField(n, k) for n, k in fields.items()])


def _widened_decimal(a: T.DataType, b: T.DataType) -> T.DecimalType | None:
    if not all(isinstance(t, T.DecimalType) or t in DIGITS for t in (a, b)):
        return None
    sides = [(t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (DIGITS[t], 0) for t in (a, b)]
    whole, scale = max(w for w, _ in sides), max(s for _, s in sides)
    return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None


def _opened(path: str) -> pa.NativeFile:
    if path.startswith("file:"):
        return pafs.LocalFileSystem().open_input_file("/" + path.removeprefix("file:").lstrip("/"))
    scheme, _, rest = path.partition("://")
    fs, name = pafs.FileSystem.from_uri(f"{'s3' if scheme == 's3a' else scheme}://{quote(rest)}")
    return fs.open_input_file(name)


def _nullable(kind: T.DataType) -> T.DataType:
    """The type without what it says of NULLs and without comments."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_nullable(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(_nullable(kind.keyType), _nullable(kind.valueType))
    return kind


def _arrow_kind(field: pa.Field, physical: dict[str, str]) -> T.DataType:
    if physical.get(field.name) == "INT96":
        return T.TimestampType()
    return UNSIGNED.get(field.type) or from_arrow_type(field.type, prefer_timestamp_ntz=True)


def footer_schema(path: str) -> T.StructType:
    """The schema of one Parquet file as Spark reads it: what Spark noted in the footer, else what the columns are."""
    with _opened(path) as file:
        meta = pq.read_metadata(file)
    noted = (meta.metadata or {}).get(SPARK_SCHEMA)
    if noted:
        return _nullable(T._parse_datatype_json_string(noted.decode()))
    columns = [meta.schema.column(i) for i in range(len(meta.schema))]
    physical = {c.path: c.physical_type for c in columns}
    fields = [T.StructField(f.name, _arrow_kind(f, physical)) for f in meta.schema.to_arrow_schema()]
    return _nullable(T.StructType(fields))


def file_columns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The columns of every file: one row each."""
    for batch in batches:
        for path in batch.column("path").to_pylist():
            schema = footer_schema(path)
            columns = [schema.names, [f.dataType.json() for f in schema], list(range(len(schema))), [path] * len(schema)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, (pa.string(), pa.string(), pa.int32(), pa.string()))],
                ["name", "kind", "place", "path"],
            )


def snapshot_files(spark: SparkSession, path: str) -> DataFrame:
    """(path): the Parquet files of a snapshot. Their content is not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    return reader.load(path).select("path")


def column_kinds(files: DataFrame) -> DataFrame:
    """(name, kind, files, place, example): every type a column has in the files, in how many of them, and one of them."""
    return files.mapInArrow(file_columns, KINDS).groupBy("name", "kind").agg(
        F.count("*").alias("files"), F.min("place").alias("place"), F.min("path").alias("example")
    )


def drift_report(spark: SparkSession, path: str) -> DataFrame:
    """(name, types, files, lacking, verdict): each column, its types in the files of a snapshot, and what reading them
    makes of it: ``same``, ``widened to <type>`` or ``refused``; ``lacking`` files do not have it."""
    columns, n_files = _columns(spark, path)
    rows = []
    for name, kinds in columns.items():
        types = {k.simpleString() for k, *_ in kinds}
        have = sum(n for _, n, *_ in kinds)
        target = _target(name, columns)
        verdict = "refused" if target is None else "same" if len(kinds) == 1 else f"widened to {target.simpleString()}"
        rows.append((name, ", ".join(sorted(types)), have, n_files - have, verdict))
    return spark.createDataFrame(rows, "name string, types string, files long, lacking long, verdict string")


Kinds = dict[str, list[tuple[T.DataType, int, str]]]


def _columns(spark: SparkSession, path: str) -> tuple[Kinds, int]:
    """Of each column its types, with the number of files and one of them; the number of all files."""
    files = snapshot_files(spark, path)
    n_files = files.count()
    if not n_files:
        raise SchemaDrift(path, ["no files"])
    found = column_kinds(files).limit(MOST_KINDS + 1).collect()
    if len(found) > MOST_KINDS:
        raise SchemaDrift(path, [f"more than {MOST_KINDS} columns and types"])
    columns: Kinds = {}
    first = {}
    for r in found:
        first[r["name"]] = min(first.get(r["name"], r["place"]), r["place"])
    for r in sorted(found, key=lambda r: (first[r["name"]], r["name"], r["kind"])):
        columns.setdefault(r["name"], []).append((T._parse_datatype_json_string(r["kind"]), r["files"], r["example"]))
    return columns, n_files


def _target(name: str, columns: Kinds) -> T.DataType | None:
    if sum(name.lower() == other.lower() for other in columns) > 1:
        return None
    return common_type(k for k, *_ in columns[name])


def common_type(kinds: Iterable[T.DataType]) -> T.DataType | None:
    """The narrowest type that holds all of them, or None."""
    out: T.DataType | None = T.NullType()
    for kind in kinds:
        out = out and widened(out, kind)
    return out


def drift_schema(spark: SparkSession, path: str, required: Iterable[str] = ()) -> T.StructType:
    """The schema that holds all files of a snapshot; ``SchemaDrift`` if there is none or a required column is lacking."""
    columns, n_files = _columns(spark, path)
    fields, faults = [], []
    for name, kinds in columns.items():
        target = _target(name, columns)
        if target is None:
            where = "; ".join(f"{k.simpleString()} in {n} files, one is {example}" for k, n, example in kinds)
            faults.append(f"{name}: {where}")
        fields.append(T.StructField(name, target or T.NullType()))
    for name in required:
        lacking = n_files - sum(n for _, n, *_ in columns.get(name, []))
        if lacking:
            faults.append(f"{name}: {lacking} of {n_files} files lack it")
    if faults:
        raise SchemaDrift(path, faults)
    return T.StructType(fields)


def read_drifting(spark: SparkSession, path: str, required: Iterable[str] = ()) -> DataFrame:
    """All rows of a snapshot in the schema that holds every file."""
    schema = drift_schema(spark, path, required)
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(path)
