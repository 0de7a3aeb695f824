"""File sources and sinks: the generic reader (batch and incremental) and the directory writer.

``read_files`` plays the role of a table-valued file reader: one entry point for
every built-in format, options passed through. Schemas are declared, or inferred
once from the files present and kept beside the table (``SchemaStore``), because a
streaming file source must not infer on every start.

``read_files_rescued`` binds every file by its own column names and keeps what the schema has
no place for (other columns, values of another type, malformed lines) in a rescue column.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fs import exists

CORRUPT_COLUMN = "_corrupt_record"
RESCUE_COLUMN = "_rescued_data"


def _options(fmt: str, header: bool | None, sep: str | None, mode: str | None,
             multi_line: bool | None, corrupt_column: str | None, extra: dict) -> dict:
    o: dict = {}
    if fmt == "csv":
        o["header"] = "true" if header is None or header else "false"
        if sep is not None:
            o["sep"] = sep
    if mode is not None:
        o["mode"] = mode
    if multi_line:
        o["multiLine"] = "true"
    if corrupt_column and fmt in ("csv", "json"):
        o["columnNameOfCorruptRecord"] = corrupt_column
    o.update({k: str(v) for k, v in extra.items()})
    return o


def with_corrupt_column(schema: T.StructType, name: str = CORRUPT_COLUMN) -> T.StructType:
    """Schema plus the string column that keeps the raw text of malformed rows."""
    if name in schema.fieldNames():
        return schema
    return T.StructType(list(schema.fields) + [T.StructField(name, T.StringType(), True)])


def read_files(spark: SparkSession, path: str, format: str = "csv", schema: T.StructType | str | None = None,
               header: bool | None = None, sep: str | None = None, mode: str | None = None,
               multi_line: bool | None = None, infer_schema: bool = False,
               corrupt_column: str | None = None, **options) -> DataFrame:
    """Batch scan of a directory of files in any built-in format."""
    o = _options(format, header, sep, mode, multi_line, corrupt_column, options)
    r = spark.read.format(format).options(**o)
    if schema is not None:
        r = r.schema(schema)
    elif infer_schema and format in ("csv", "json", "xml"):
        r = r.option("inferSchema", "true")
    return r.load(path)


def read_files_stream(spark: SparkSession, path: str, schema: T.StructType | str, format: str = "csv",
                      header: bool | None = None, sep: str | None = None, mode: str | None = None,
                      multi_line: bool | None = None, corrupt_column: str | None = None,
                      max_files_per_trigger: int | None = None, max_bytes_per_trigger: str | None = None,
                      **options) -> DataFrame:
    """Incremental scan: each run reads only the files added since the last commit of the
    checkpoint the consuming query uses. ``max_files_per_trigger`` / ``max_bytes_per_trigger``
    bound the size of one micro-batch for very large inputs."""
    o = _options(format, header, sep, mode, multi_line, corrupt_column, options)
    if max_files_per_trigger:
        o["maxFilesPerTrigger"] = str(max_files_per_trigger)
    if max_bytes_per_trigger:
        o["maxBytesPerTrigger"] = str(max_bytes_per_trigger)
    return spark.readStream.format(format).options(**o).schema(schema).load(path)


def write_files(df: DataFrame, path: str, format: str = "csv", header: bool = True, sep: str = ",",
                mode: str = "overwrite", partition_by=None, **options) -> None:
    """Directory writer (CSV with header and delimiter, or any format). Overwriting replaces
    the whole directory, partitions that the new rows lack included."""
    w = df.write.format(format).mode(mode).option("partitionOverwriteMode", "static")
    if format == "csv":
        w = w.option("header", "true" if header else "false").option("sep", sep)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.options(**{k: str(v) for k, v in options.items()}).save(path)


def headers(spark: SparkSession, paths: str | list[str], sep: str = ",", since: str | None = None, **options) -> list:
    """The header of every CSV file, one row a file: ``(path, modified, columns)``. The first
    line of each file is found in one pass over the text of the files, added up inside each
    task. ``since``: only files modified after that time."""
    r = spark.read.options(**{k: str(v) for k, v in options.items() if k in ("lineSep", "encoding", "pathGlobFilter", "recursiveFileLookup")})
    if since:
        r = r.option("modifiedAfter", since)
    lines = r.text(paths).select("value", F.monotonically_increasing_id().alias("at"), F.col("_metadata.file_path").alias("path"),
                                 F.col("_metadata.file_block_start").alias("start"), F.col("_metadata.file_modification_time").alias("modified"))
    first = lines.where("start = 0 AND value <> ''").groupBy("path").agg(F.min_by("value", "at").alias("line"), F.max("modified").alias("modified"))
    files = first.collect()  # a row a file
    if not files:
        return []
    # parsed by the CSV reader itself, so quotes and separators are understood as in the rows
    texts = sorted({r["line"] for r in files})
    wide = ", ".join(f"c{k} string" for k in range(max(t.count(sep) for t in texts) + 1))
    parse = {"sep": sep, **{k: str(v) for k, v in options.items() if k in ("quote", "escape", "charToEscapeQuoteEscaping")}}
    read = spark.createDataFrame([(t,) for t in texts], "line string").select("line", F.from_csv("line", wide, parse).alias("c")).collect()
    names = {r["line"]: _trimmed(list(r["c"])) for r in read}
    return [(r["path"], r["modified"], names[r["line"]]) for r in files]


def _trimmed(names: list) -> tuple:
    """Column names of a header row: nothing behind the last one, blanks numbered."""
    while names and names[-1] is None:
        names.pop()
    return tuple(n if n is not None else f"_c{k}" for k, n in enumerate(names))


def _typed(value: Column, t: T.DataType, date: str | None, time: str | None) -> Column:
    """A text as a value of type ``t``, NULL where it is none."""
    if isinstance(t, T.StringType):
        return value
    if isinstance(t, T.DateType) and date:
        return F.try_to_timestamp(value, F.lit(date)).cast("date")
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)) and time:
        return F.try_to_timestamp(value, F.lit(time)).cast(t)
    if isinstance(t, (T.StructType, T.ArrayType, T.MapType)):
        return F.from_json(value, t)
    return value.try_cast(t)


def _bound(df: DataFrame, schema: T.StructType, names: tuple, rescue: str, raw: Column | None, date: str | None, time: str | None) -> DataFrame:
    """Columns ``_0, _1, ...`` of texts, called ``names`` in their file, as ``schema`` and the
    rescue column."""
    place: dict[str, int] = {}
    for k, n in enumerate(names):
        place.setdefault(n, k)
    out, kept = [], []
    for f in schema.fields:
        if f.name not in place:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        text = F.col(f"_{place[f.name]}")
        value = _typed(text, f.dataType, date, time)
        out.append(value.alias(f.name))
        if not isinstance(f.dataType, T.StringType):
            kept.append((f.name, text, text.isNotNull() & value.isNull()))
    for k, n in enumerate(names):
        if n not in schema.fieldNames() or place[n] != k:  # unknown, or the name a second time
            kept.append((n if place[n] == k else f"{n}_{k}", F.col(f"_{k}"), F.col(f"_{k}").isNotNull()))
    if raw is not None:
        kept.append((CORRUPT_COLUMN, raw, raw.isNotNull()))
    none = F.lit(None).cast("string").alias(rescue)
    if not kept:
        return df.select(*out, none)
    entry = F.array(*[F.when(bad, F.struct(F.lit(n).alias("key"), v.alias("value"))) for n, v, bad in kept])
    held = F.filter(entry, lambda e: e.isNotNull())
    return df.select(*out, F.when(F.size(held) > 0, F.to_json(F.map_from_entries(held))).alias(rescue))


def read_files_rescued(spark: SparkSession, paths: str | list[str], schema: T.StructType, format: str = "csv", sep: str = ",",
                       multi_line: bool = False, rescue_column: str = RESCUE_COLUMN, **options) -> DataFrame:
    """Batch scan of CSV (with header lines) or JSON files that binds each file by its own
    names. A column the file lacks is NULL. What the schema has no place for is kept in
    ``rescue_column`` as a JSON object by name: columns it does not list, values that are not
    of the column's type (NULL in the column), and under ``_corrupt_record`` lines that do not
    parse or have more or fewer values than their header. Nothing is dropped.

    Files with equal headers are read by one scan; the driver holds a row a file (as any file
    scan does). ``dateFormat`` and ``timestampFormat`` apply to their columns."""
    date, time = options.get("dateFormat"), options.get("timestampFormat")
    if format == "json":
        return _rescued_json(spark.read.options(**{k: str(v) for k, v in options.items()}).text(paths), schema, rescue_column, date, time)
    if format != "csv":
        raise ValueError(f"rescue reads csv and json, not {format}")
    groups: dict[tuple, list[str]] = {}
    for path, _, names in headers(spark, paths, sep, **options):
        groups.setdefault(names, []).append(path)
    out = spark.createDataFrame([], T.StructType([*[T.StructField(f.name, f.dataType) for f in schema.fields], T.StructField(rescue_column, T.StringType())]))
    for names, files in sorted(groups.items()):
        texts = T.StructType([T.StructField(f"_{k}", T.StringType()) for k in range(len(names))] + [T.StructField(CORRUPT_COLUMN, T.StringType())])
        # all columns are asked for, so a line with too many or too few values is known as such
        r = (spark.read.schema(texts).options(**{k: str(v) for k, v in options.items()}).option("header", "true").option("enforceSchema", "true")
             .option("sep", sep).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT_COLUMN).option("multiLine", multi_line))
        out = out.unionByName(_bound(r.csv(sorted(files)), schema, names, rescue_column, F.col(CORRUPT_COLUMN), date, time))
    return out


def _rescued_json(lines: DataFrame, schema: T.StructType, rescue: str, date: str | None, time: str | None) -> DataFrame:
    whole = F.from_json("value", "map<string,string>")
    df = lines.where("trim(value) <> ''").select("value", whole.alias("_m"))
    known = F.array(*[F.lit(f.name) for f in schema.fields])
    values = {f.name: F.col("_m").getItem(f.name) for f in schema.fields}
    typed = {f.name: _typed(values[f.name], f.dataType, date, time) for f in schema.fields}
    bad = [F.when(values[n].isNotNull() & typed[n].isNull(), F.struct(F.lit(n).alias("key"), values[n].alias("value"))) for n in typed if not isinstance(schema[n].dataType, T.StringType)]
    bad.append(F.when(F.col("_m").isNull(), F.struct(F.lit(CORRUPT_COLUMN).alias("key"), F.col("value").alias("value"))))
    other = F.filter(F.map_entries("_m"), lambda e: ~F.array_contains(known, e["key"]))
    held = F.concat(F.coalesce(other, F.expr("cast(array() as array<struct<key:string,value:string>>)")), F.filter(F.array(*bad), lambda e: e.isNotNull()))
    return df.select(*[typed[f.name].alias(f.name) for f in schema.fields], F.when(F.size(held) > 0, F.to_json(F.map_from_entries(held))).alias(rescue))


def file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None, **options) -> DataFrame:
    """Stream of the files that appear under ``path``: ``path, modificationTime, length``. Their
    content is not read."""
    o = {k: str(v) for k, v in options.items()}
    if max_files_per_trigger:
        o["maxFilesPerTrigger"] = str(max_files_per_trigger)
    schema = "path string, modificationTime timestamp, length long, content binary"
    return spark.readStream.format("binaryFile").schema(schema).options(**o).load(path).select("path", "modificationTime", "length")


_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """A type that holds the values of both: the wider number, else text."""
    x, y = a.simpleString(), b.simpleString()
    if x == y or isinstance(b, T.NullType):
        return a
    if x in _NUMERIC and y in _NUMERIC:
        return a if _NUMERIC.index(x) > _NUMERIC.index(y) else b
    return T.StringType()


class SchemaStore:
    """Infer a source schema once, keep it as JSON beside the table, reuse it on later runs.

    Inference is one distributed pass over all files. The headers of CSV files that came
    since are compared with the kept schema: a new column is an error unless
    ``allow_new_columns``; then the stored schema grows by the new columns (by name), and
    columns whose files now need a wider type get it. Columns in another order are an error
    in either case, since a scan with a schema binds by place: read such files with
    ``read_files_rescued``, which binds by name.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def _load(self) -> dict | None:
        if not exists(self.spark, self.path):
            return None  # nothing stored yet
        rows = self.spark.read.text(self.path).take(1)
        kept = json.loads(rows[0][0]) if rows else None
        return {"schema": kept, "seen": None} if kept and "schema" not in kept else kept

    def load(self) -> T.StructType | None:
        kept = self._load()
        return kept and T.StructType.fromJson(kept["schema"])

    def save(self, schema: T.StructType, seen: str | None = None) -> None:
        text = json.dumps({"schema": json.loads(schema.json()), "seen": seen})
        self.spark.createDataFrame([(text,)], "v string").coalesce(1).write.mode("overwrite").text(self.path)

    def _new_headers(self, source_path: str, kept: dict | None, options: dict) -> list:
        """Headers of the files modified since the last look (a second earlier, as file times
        are coarse)."""
        sep = options.pop("sep", None) or ","
        return headers(self.spark, source_path, sep, since=kept and kept["seen"], **options)

    def resolve(self, source_path: str, format: str = "csv", allow_new_columns: bool = False,
                **read_options) -> T.StructType:
        kept, seen, found = self._load(), None, []
        stored = kept and T.StructType.fromJson(kept["schema"])
        named = format == "csv" and read_options.get("header") not in (None, False, "false")
        if named:
            found = self._new_headers(source_path, kept, {k: v for k, v in read_options.items() if k not in ("header", "multi_line")})
            latest = max((m for _, m, _ in found), default=None)
            seen = (latest - dt.timedelta(seconds=1)).strftime("%Y-%m-%dT%H:%M:%S") if latest else kept and kept["seen"]
            self._compare(found, stored, allow_new_columns)
        if stored is not None and not allow_new_columns:
            if kept["seen"] != seen:
                self.save(stored, seen)
            return stored  # no scan of rows once a schema is kept
        r = self.spark.read.format(format).options(**_options(
            format, read_options.pop("header", None), read_options.pop("sep", None), None,
            read_options.pop("multi_line", None), None, read_options))
        r = r.option("inferSchema", "true") if format in ("csv", "json", "xml") else r
        groups: dict[tuple, list[str]] = {}  # files of one header are inferred together
        for path, _, names in found if named else ():
            groups.setdefault(names, []).append(path)
        grown = stored
        for files in [sorted(g) for _, g in sorted(groups.items(), key=lambda g: len(g[0]))] if named else [source_path]:
            grown = self._grown(grown, r.load(files).schema)
        if grown is None:
            raise ValueError(f"no files to infer a schema from under {source_path}")
        if grown != stored or kept["seen"] != seen:
            self.save(grown, seen)
        return grown

    @staticmethod
    def _grown(stored: T.StructType | None, inferred: T.StructType) -> T.StructType:
        if stored is None:
            return inferred
        now = {f.name: f for f in inferred.fields}
        grown = [T.StructField(f.name, _wider(f.dataType, now[f.name].dataType)) if f.name in now else f for f in stored.fields]
        return T.StructType(grown + [f for f in inferred.fields if f.name not in stored.fieldNames()])

    @staticmethod
    def _compare(found: list, stored: T.StructType | None, allow_new_columns: bool) -> None:
        """Raise where a file's columns are not the schema's first ones, in its order."""
        want = stored.fieldNames() if stored is not None else None
        for path, _, names in found:
            want = want if want is not None else list(names)
            new = [n for n in names if n not in want]
            if new and not allow_new_columns and stored is not None:
                raise ValueError(f"{path} has columns that the stored schema lacks: {new}")
            if list(names)[: len(want)] != want[: len(names)]:
                raise ValueError(f"{path} has its columns in another order ({', '.join(names)}) than the schema ({', '.join(want)}); "
                                 "read_files_rescued binds them by name")


def read_bus_stream(spark: SparkSession, servers: str, topics: list[str] | str,
                    starting_offsets: str = "earliest", **options) -> DataFrame:
    """Message-bus source (Kafka protocol): several topics (e.g. one per region) as one
    stream of ``topic, partition, offset, timestamp, key, value`` with text payloads.
    Needs the Kafka connector on the cluster's classpath; without it Spark raises
    ``Failed to find the data source: kafka`` when the stream is defined."""
    topic_list = topics if isinstance(topics, str) else ",".join(topics)
    df = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
          .option("subscribe", topic_list).option("startingOffsets", starting_offsets)
          .options(**{k: str(v) for k, v in options.items()}).load())
    return df.selectExpr("topic", "partition", "offset", "CAST(timestamp AS TIMESTAMP_NTZ) AS timestamp",
                         "CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")
