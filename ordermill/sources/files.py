"""File sources: one multi-path read per format, never a read per file."""

from __future__ import annotations

import csv
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.arrays import each_element
from ..session import clock

ORDER_TEXT_FIELDS = ["order_id", "customer_name", "customer_email", "product", "product_category", "quantity", "price",
                     "discount", "total_amount", "order_date", "store_location", "source", "notes"]


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([*[T.StructField(c, T.StringType()) for c in columns], T.StructField("_corrupt_record", T.StringType())])


CSV_SCHEMA = text_schema(ORDER_TEXT_FIELDS)

_ORDER = T.StructType(
    [T.StructField(c, T.StringType()) for c in ORDER_TEXT_FIELDS]
    + [
        T.StructField("device_type", T.StringType()),
        T.StructField("device_info", T.StructType([T.StructField("model", T.StringType()), T.StructField("os_version", T.StringType())])),
    ]
)
_ORDERS = T.ArrayType(_ORDER)
JSON_SCHEMA = T.StructType(
    [
        T.StructField("orders", _ORDERS), T.StructField("data", _ORDERS), T.StructField("items", _ORDERS),
        T.StructField("app_version", T.StringType()), T.StructField("upload_time", T.StringType()),
        T.StructField("app_info", T.StructType([T.StructField(c, T.StringType()) for c in ("version", "platform", "upload_timestamp")])),
        T.StructField("_corrupt_record", T.StringType()),
    ]
    + list(_ORDER.fields)
)


def _tagged(df: DataFrame, source_type: str, as_of: str) -> DataFrame:
    return df.withColumns(
        {"source_file": F.col("_metadata.file_name"), "source_type": F.lit(source_type), "ingested_at": clock(as_of)}
    )


def list_files(spark: SparkSession, paths: str | list[str]) -> list[tuple[str, str, int | None, int | None]]:
    """(path as asked, file, bytes, modified in ms) of every file; a path without any has nulls.

    This is the listing that every file scan makes on the driver anyway; hidden files are left out as a scan does.
    """
    context = spark.sparkContext
    jvm, conf = context._jvm, context._jsc.hadoopConfiguration()
    out = []
    for asked in [paths] if isinstance(paths, str) else paths:
        path = jvm.org.apache.hadoop.fs.Path(asked)
        fs = path.getFileSystem(conf)
        found = []
        for root in fs.globStatus(path) or []:
            walk = fs.listFiles(root.getPath(), True)
            while walk.hasNext():
                one = walk.next()
                if one.getPath().getName()[:1] not in "._":
                    found.append((asked, one.getPath().toString(), one.getLen(), one.getModificationTime()))
        out += sorted(found) or [(asked, None, None, None)]
    return out


def _header(spark: SparkSession, file: str, encoding: str) -> tuple[str, ...]:
    """The column names in a file's first line, decompressed as a scan does; blank and repeated names get a number."""
    context = spark.sparkContext
    jvm, path = context._jvm, context._jvm.org.apache.hadoop.fs.Path(file)
    conf = context._jsc.hadoopConfiguration()
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    stream = path.getFileSystem(conf).open(path)
    try:
        stream = codec.createInputStream(stream) if codec is not None else stream
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8" if encoding == AUTO else encoding)).readLine() or ""
    finally:
        stream.close()
    names: list[str] = []
    for i, name in enumerate(next(csv.reader([line.lstrip("\ufeff")]), [])):
        name = name.strip() or f"_c{i}"
        names.append(name if name not in names else f"{name}_{i}")
    return tuple(names)


AUTO = "auto"


def _utf8_or_latin1(c: Column) -> Column:
    """Text read byte by byte: as UTF-8 where its bytes are that, else as latin-1."""
    wide = F.try_validate_utf8(F.encode(c, "ISO-8859-1").cast("string"))
    return F.when(F.length(c) == F.octet_length(c), c).otherwise(F.coalesce(wide, c))


def _read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType, encoding: str, header: bool, multi_line: bool, **options) -> DataFrame:
    """CSV files by the names in each file's own header, one read per distinct header.

    Columns of `schema` that a file lacks are null, others that it has are kept as text after them. With `header` off
    the columns are taken in the order of `schema`.
    """
    reader = spark.read.option("header", header).option("mode", "PERMISSIVE").option("escape", '"').option("multiLine", multi_line)
    reader = reader.option("columnNameOfCorruptRecord", "_corrupt_record").option("encoding", "ISO-8859-1" if encoding == AUTO else encoding)
    reader = reader.options(ignoreCorruptFiles=False, ignoreMissingFiles=False, **options)
    fields = {f.name: f for f in schema.fields if f.name != "_corrupt_record"}
    corrupt = T.StructField("_corrupt_record", T.StringType())
    if header:
        layouts: dict[tuple[str, ...], list[str]] = {}
        for _, file, size, _ in list_files(spark, path):
            if size:
                layouts.setdefault(_header(spark, file, encoding), []).append(file)
    else:
        layouts = {tuple(fields): path if isinstance(path, list) else [path]}
    parts = []
    for names, group in layouts.items():
        read = T.StructType([T.StructField(n, fields[n].dataType if n in fields else T.StringType()) for n in names] + [corrupt])
        rows = reader.schema(read).csv(group)
        decode = lambda c, kind: _utf8_or_latin1(c) if encoding == AUTO and isinstance(kind, T.StringType) else c
        known = [decode(F.col(f"`{n}`"), f.dataType).alias(n) if n in names else F.lit(None).cast(f.dataType).alias(n) for n, f in fields.items()]
        more = [decode(F.col(f"`{n}`"), T.StringType()).alias(n) for n in names if n not in fields]
        tag = F.col("_metadata.file_name").alias("source_file")
        parts.append(rows.select(*known, *more, decode(F.col("_corrupt_record"), T.StringType()).alias("_corrupt_record"), tag))
    if not parts:
        empty = T.StructType([*fields.values(), corrupt, T.StructField("source_file", T.StringType())])
        return spark.createDataFrame([], empty)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_csv_orders(spark: SparkSession, path: str | list[str], as_of: str, encoding: str = AUTO, schema: T.StructType = CSV_SCHEMA,
                    header: bool = True, multi_line: bool = False) -> DataFrame:
    """Order CSV by header names; ragged rows are kept with `_corrupt_record` set.

    By default text is UTF-8, or latin-1 where its bytes are no UTF-8. `multi_line` allows line breaks inside quotes,
    at the price of reading each file in one task. A file that cannot be read to its end fails the read.
    """
    rows = _read_csv(spark, path, schema, encoding, header, multi_line)
    return rows.withColumns({"source_type": F.lit("file_csv"), "ingested_at": clock(as_of)})


def read_csv_typed(spark: SparkSession, path: str | list[str], schema: str | T.StructType, date_format: str = "yyyy-MM-dd") -> DataFrame:
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return _read_csv(spark, path, wanted, AUTO, True, False, dateFormat=date_format, timestampNTZFormat=date_format).drop("source_file")


def read_json_envelopes(spark: SparkSession, path: str | list[str], as_of: str, multi_line: bool = True) -> DataFrame:
    """One row per JSON document (or per element of a top-level array).

    A file is one document or array; with `multi_line` off, each line is one, and large files split.
    """
    reader = spark.read.schema(JSON_SCHEMA).option("multiLine", multi_line).option("columnNameOfCorruptRecord", "_corrupt_record")
    return _tagged(reader.json(path), "file_json", as_of)


def json_orders(envelopes: DataFrame) -> DataFrame:
    """Rows of `orders`, else `data`, else `items`, else the document itself; envelope fields are copied."""
    single = F.struct(*[F.col(f.name) for f in _ORDER.fields])
    rows = F.coalesce("orders", "data", "items", F.array(single))
    carried = ["app_version", "upload_time", "app_info", "source_file", "source_type", "ingested_at"]
    good = envelopes.filter(F.col("_corrupt_record").isNull())
    return each_element(good.select(rows.alias("rows"), *carried), "rows", "o").select("o.*", *carried)


def read_json_orders(spark: SparkSession, path: str | list[str], as_of: str, multi_line: bool = True) -> DataFrame:
    return json_orders(read_json_envelopes(spark, path, as_of, multi_line))


def flatten_nested_orders(df: DataFrame) -> DataFrame:
    """Lift device and app fields to flat columns."""
    lifted: dict[str, Column] = {
        "device_model": F.col("device_info.model"), "device_os": F.col("device_info.os_version"),
        "app_version": F.coalesce(F.col("app_info.version"), F.col("app_version")), "app_platform": F.col("app_info.platform"),
        "upload_timestamp": F.coalesce(F.col("app_info.upload_timestamp"), F.col("upload_time")),
    }
    return df.withColumns(lifted).drop("device_info", "app_info", "upload_time")


def json_structure_profile(documents: DataFrame, text: str = "value", keys: list[str] | None = None) -> DataFrame:
    """Top-level keys of each JSON document with the type and, for lists, the length of each."""
    ids = keys or [c for c in documents.columns if c != text]
    names = ", ".join(f"d.`{i}`" for i in ids)
    entries = documents.sparkSession.sql(
        f"select {names}, e.key as key, schema_of_variant(e.value) as told, size(try_cast(e.value as array<variant>)) as length "
        f"from {{documents}} d, lateral variant_explode(try_parse_json(d.`{text}`)) e where e.key is not null", documents=documents,
    )
    told = F.col("told")
    # a number written with a fraction is a short decimal; a decimal of more digits than a long has is a whole number
    whole = told.rlike(r"^DECIMAL\((19|[23][0-9]),0\)$")
    kind = (
        F.when(told == "VOID", "null").when(told.startswith("ARRAY"), "list").when(told.startswith("OBJECT"), "dict").when(told == "BOOLEAN", "bool")
        .when(told == "STRING", "str").when((told == "BIGINT") | whole, "int").otherwise("float")
    )
    return entries.select(*ids, "key", kind.alias("kind"), F.when(kind == "list", F.col("length")).alias("length"))


def read_json_documents(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.option("wholetext", True).text(path).select(F.col("_metadata.file_name").alias("source_file"), "value")


def readable_files(spark: SparkSession, files: list[str]) -> list[str]:
    """The files that can be read to their ends: one pass over all, and more only over halves that hold another."""
    if not files:
        return []
    try:
        reader = spark.read.options(ignoreCorruptFiles=False, ignoreMissingFiles=False)
        reader.text(files).write.format("noop").mode("overwrite").save()
    except (PySparkException, Py4JJavaError):
        if len(files) == 1:
            return []
        half = len(files) // 2
        return readable_files(spark, files[:half]) + readable_files(spark, files[half:])
    return files


def read_many_files(spark: SparkSession, path: str | list[str], fmt: str, as_of: str, schema: T.StructType = CSV_SCHEMA, multi_line: bool | None = None,
                    skip_unreadable: bool = False) -> DataFrame:
    """The orders in all matching files of a format; unreadable records are left out, not fatal.

    With `skip_unreadable`, files that cannot be read to their ends are left out whole, after a pass that reads all once
    more; `ingest_file_summary` with the listing shows them as failed.
    """
    if skip_unreadable:
        path = readable_files(spark, [file for _, file, _, _ in list_files(spark, path) if file])
    if fmt == "csv":
        return read_csv_orders(spark, path, as_of, schema=schema, multi_line=bool(multi_line)).filter("_corrupt_record is null")
    return read_json_orders(spark, path, as_of, multi_line is not False)


def ingest_file_summary(df: DataFrame, listed: list[tuple] | None = None) -> DataFrame:
    """Records and corrupt records per file with a status, and one row for all files.

    With the listing (`list_files`), files that gave no row are there as failed. `df` must be materialised or keep
    another column than the corrupt-record one.
    """
    per_file = df.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("records"), F.count_if(F.col("_corrupt_record").isNotNull()).alias("bad_records")
    )
    if listed is not None:
        names = [(file.rsplit("/", 1)[-1] if file else asked,) for asked, file, _, _ in listed]
        every = df.sparkSession.createDataFrame(names, "source_file string")
        per_file = every.join(per_file, "source_file", "left").na.fill(0, ["records", "bad_records"])
    ok = F.col("records") > F.col("bad_records")
    files = per_file.withColumn("status", F.when(ok, "success").otherwise("failed"))
    total = files.agg(
        F.lit("(all)").alias("source_file"), F.sum("records").alias("records"), F.sum("bad_records").alias("bad_records"),
        F.concat(F.count_if(F.col("status") == "success").cast("string"), F.lit("/"), F.count(F.lit(1)).cast("string")).alias("status"),
    )
    return files.unionByName(total)


def file_admission(spark: SparkSession, path: str | list[str], max_mb: float = 100, digest: bool = True) -> DataFrame:
    """Verdict per file from the listing alone; only accepted files are read, for the digest.

    A path without files is a row with the reason `missing`.
    """
    listed = spark.createDataFrame(list_files(spark, path), "asked string, path string, length bigint, modified bigint")
    extension = F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1))
    reason = (
        F.when(F.col("path").isNull(), "missing").when(F.col("length") == 0, "empty").when(F.col("length") > max_mb * 1024 * 1024, "too large")
        .when(~extension.isin(".csv", ".json"), "unsupported type")
    )
    name = F.coalesce(F.regexp_extract("path", r"([^/]+)$", 1), F.col("asked"))
    judged = listed.select(
        name.alias("file"), "length", extension.alias("extension"), F.timestamp_millis("modified").alias("modificationTime"), "path",
        reason.alias("reason"), reason.isNull().alias("accepted"),
    )
    if digest:
        paths = [r["path"] for r in judged.filter("accepted").select("path").collect()]
        bare = lambda c: F.regexp_replace(c, r"^[a-z0-9]+:/+", "/")
        if paths:
            sums = spark.read.format("binaryFile").load(paths).select(bare(F.col("path")).alias("_p"), F.md5("content").alias("md5"))
            judged = judged.join(sums, bare(F.col("path")) == F.col("_p"), "left").drop("_p")
        else:
            judged = judged.withColumn("md5", F.lit(None).cast("string"))
    return judged.drop("path")
