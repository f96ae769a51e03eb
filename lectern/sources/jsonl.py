"""JSON-lines sources and Bronze shaping.

Every function returns a lazy DataFrame; the only eager helpers are the
inventory (a metadata scan) and the row-count gate, which reads a metric
gathered by ``observe`` during a write instead of re-scanning the table.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters replaced in column names (runs become one '_'),
# the corrupt-record column, the suffix of sample files, row gates.
BAD_NAME_CHARS = r"[ ,;{}()\n\t=]+"
CORRUPT = "_corrupt_record"
SAMPLE_SUFFIX = "sample.json"
#: What a line holds beyond the schema (a VARIANT, NULL on lines that conform), and the line's hash.
RESCUED = "_rescued"
ROW_HASH = "_row_hash"
MIN_ROWS = 100
REVIEWS_WARN_BELOW = 1_000_000


def clean_name(name: str, strip_edges: bool = False) -> str:
    """Runs of illegal characters → ``_`` (hyphens stay)."""
    out = re.sub(BAD_NAME_CHARS, "_", name)
    return out.strip("_") if strip_edges else out


def clean_column_names(df: DataFrame) -> DataFrame:
    """S4 as one projection (no rename loop, one plan node)."""
    return df.select(*[F.col(f"`{c}`").alias(clean_name(c)) for c in df.columns])


def flatten_struct(df: DataFrame, struct_col: str = "genres", key: str = "book_id",
                   prefix: str = "genre_", keep: tuple[str, ...] = ()) -> DataFrame:
    """S3: each struct field → its own column ``prefix`` + clean name.

    Field names with commas or spaces are back-quoted; audit columns named in
    ``keep`` (and any ``_``-prefixed column) are carried along.
    """
    st = df.schema[struct_col].dataType
    fields = st.fieldNames()
    carry = [c for c in df.columns if c != struct_col and c != key
             and (c in keep or c.startswith("_"))]
    return df.select(
        F.col(key),
        *[F.col(f"{struct_col}.`{f}`").alias(prefix + clean_name(f, strip_edges=True))
          for f in fields],
        *[F.col(f"`{c}`") for c in carry])


def shape_bronze(df: DataFrame, struct_col: str = "genres", key: str = "book_id") -> DataFrame:
    """Flatten when the nested struct is present, else clean names."""
    if struct_col in df.columns and isinstance(df.schema[struct_col].dataType, T.StructType):
        return flatten_struct(df, struct_col, key)
    return clean_column_names(df)


def add_audit_columns(df: DataFrame, batch_id: str, source_file: Column | None = None) -> DataFrame:
    """Ingestion time, source file (kept by ``parse_lines``, else ``_metadata.file_path``) and batch id."""
    if source_file is None:
        source_file = F.col("_source_file" if "_source_file" in df.columns else "_metadata.file_path")
    return df.withColumns({
        "_ingestion_timestamp": F.current_timestamp(),
        "_source_file": source_file,
        "_batch_id": F.lit(batch_id),
    })


def parse_ddl(spark: SparkSession, ddl: str) -> T.StructType:
    """``"a STRING, b BIGINT"`` → StructType, parsed by Spark's own DDL parser."""
    return spark.createDataFrame([], ddl).schema


def merge_hints(schema: T.StructType, hints: str | None,
                spark: SparkSession | None = None) -> T.StructType:
    """DDL hints (``col TYPE, …``) override inferred types; new columns are added."""
    if not hints:
        return schema
    spark = spark or SparkSession.getActiveSession()
    by_name = {f.name: f for f in parse_ddl(spark, hints).fields}
    fields = [by_name.pop(f.name, f) for f in schema.fields]
    return T.StructType(fields + list(by_name.values()))


def with_corrupt_column(schema: T.StructType) -> T.StructType:
    """Always declare ``_corrupt_record``: inference omits it when no line is bad."""
    if CORRUPT in schema.fieldNames():
        return schema
    return T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])


def keep_files(df: DataFrame, exclude: str | None = None) -> DataFrame:
    """The one file filter of inventory and load: every file (of any suffix, compressed or not) but those whose
    name ends with ``exclude``.  Inference reads all files: at worst it finds a column too many."""
    name = F.col("path") if "path" in df.columns else F.col("_metadata.file_name")
    return df if exclude is None else df.filter(~name.endswith(exclude))


# Types as ``schema_of_variant`` writes them, outside of quoted names.
_VARIANT_TYPE = re.compile(r"(`(?:[^`]|``)*`)|(^|: |ARRAY<)(OBJECT|VOID|VARIANT|FLOAT|DECIMAL\(\d+,\s*\d+\))")
_JSON_TYPES = {"OBJECT": "STRUCT", "VOID": "STRING", "VARIANT": "STRING", "FLOAT": "DOUBLE"}


def _without_empty(dtype: T.DataType) -> T.DataType:
    """Structs without fields as strings: no file format has a place for them."""
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _without_empty(f.dataType)) for f in dtype.fields]) if dtype.fields \
            else T.StringType()
    return T.ArrayType(_without_empty(dtype.elementType)) if isinstance(dtype, T.ArrayType) else dtype


def variant_schema(found: str | None) -> T.StructType:
    """The result of ``schema_of_variant_agg`` as a schema for ``from_json``.

    Numbers with a fraction are doubles; what is only ever null, or of several types, is a string.
    """
    if not found or not found.startswith("OBJECT<") or found == "OBJECT<>":
        return T.StructType([])
    ddl = _VARIANT_TYPE.sub(lambda m: m[1] or m[2] + _JSON_TYPES.get(m[3], "DOUBLE"), found)
    return _without_empty(T.DataType.fromDDL(ddl))


def infer_schema(lines: DataFrame, hints: str | None = None, sampling_ratio: float = 1.0) -> T.StructType:
    """Schema of JSON lines (column ``value``) in one aggregate, with hints; lines that are no objects say nothing."""
    rows = lines.sample(sampling_ratio, seed=0) if sampling_ratio < 1 else lines
    v = F.try_parse_json("value")
    found = rows.select(F.when(F.schema_of_variant(v).startswith("OBJECT"), v).alias("v")).agg(
        F.schema_of_variant_agg("v").alias("s")).first()["s"]
    schema = variant_schema(found)
    return merge_hints(T.StructType([f for f in schema.fields if f.name != CORRUPT]), hints, lines.sparkSession)


def missed(v: Column, typed: Column, dtype: T.DataType) -> Column:
    """What a JSON value (VARIANT) holds beyond its typed form: unknown fields, and values of another type.

    NULL where nothing is missed.  An array keeps its length, with nulls at the elements that conform.
    """
    other = F.when(~F.is_variant_null(v), v)
    if isinstance(dtype, T.StructType):
        return _once(v.try_cast(_FIELDS), lambda m: F.when(m.isNull(), other).otherwise(_missed_fields(m, typed, dtype)))
    if isinstance(dtype, T.ArrayType):
        def elements(a: Column) -> Column:
            rest = F.transform(a, lambda x, i: missed(x, F.get(typed, i), dtype.elementType))
            return F.when(a.isNull(), other).otherwise(
                F.to_variant_object(_some(rest, lambda r: F.exists(r, lambda x: x.isNotNull()))))
        return _once(v.try_cast("array<variant>"), elements)
    if isinstance(dtype, T.MapType):
        def values(m: Column) -> Column:
            rest = F.map_filter(F.transform_values(m, lambda k, x: missed(x, F.try_element_at(typed, k), dtype.valueType)),
                                lambda k, x: x.isNotNull())
            return F.when(m.isNull(), other).otherwise(F.to_variant_object(_some(rest, lambda r: F.size(r) > 0)))
        return _once(v.try_cast(_FIELDS), values)
    return F.when(typed.isNull(), other)


#: A JSON object by its fields; NULL for any other value.
_FIELDS = "map<string,variant>"


def _once(x: Column, use) -> Column:
    """``use(x)`` with ``x`` computed once, however often it is used."""
    return F.get(F.transform(F.array(x), use), 0)


def _some(x: Column, keep) -> Column:
    """``x`` where ``keep(x)``, else NULL; ``x`` is computed once."""
    return F.get(F.filter(F.array(x), keep), 0)


def _missed_fields(m: Column, typed: Column, dtype: T.StructType) -> Column:
    """``missed`` of an object that is there as a map of its fields."""
    def field(k: Column, x: Column) -> Column:
        case = F.when(F.lit(False), x)
        for f in dtype.fields:
            case = case.when(k == f.name, missed(x, typed.getField(f.name), f.dataType))
        return case.otherwise(F.when(~F.is_variant_null(x), x))
    rest = F.map_filter(F.transform_values(m, field), lambda k, x: x.isNotNull())
    return F.to_variant_object(_some(rest, lambda r: F.size(r) > 0))


def parse_lines(lines: DataFrame, schema: T.StructType, options: Mapping[str, str] | None = None,
                rescue: bool = True) -> DataFrame:
    """Text lines (``value``, and ``_source_file`` or file metadata) → columns of ``schema``, PERMISSIVE.

    ``_corrupt_record`` holds lines that don't parse or have a value of another type; ``_rescued`` only what the
    schema misses (fields it doesn't know, at any depth, and those values), NULL on lines that conform;
    ``_row_hash`` the line's hash and ``_source_file`` its file.  Blank lines are no records.
    """
    parser = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **(options or {})}
    source = F.col("_source_file") if "_source_file" in lines.columns else F.col("_metadata.file_path")
    v = F.try_parse_json("value")
    rows = lines.filter(F.trim("value") != "").select(
        F.from_json("value", with_corrupt_column(schema), parser).alias("_parsed"), *([v.alias("_v")] if rescue else []),
        F.col("value").alias("_line"), F.xxhash64("value").alias(ROW_HASH), source.alias("_source_file"))
    rescued = []
    if rescue:
        known = T.StructType([f for f in schema.fields if f.name != CORRUPT])

        def beyond(m: Column) -> Column:
            # A line that isn't an object is corrupt; one that only JSON with repeated names explains is kept as text.
            return (F.when(m.isNotNull(), _missed_fields(m, F.col("_parsed"), known))
                    .when(F.col("_v").isNull() & F.col(f"_parsed.{CORRUPT}").isNull(), F.col("_line").cast("variant")))
        rescued = [_once(F.col("_v").try_cast(_FIELDS), beyond).alias(RESCUED)]
    return rows.select("_parsed.*", *rescued, ROW_HASH, "_source_file")


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                    hints: str | None = None, exclude: str | None = None) -> DataFrame:
    """One JSON document per line of every file, PERMISSIVE, bad lines kept in ``_corrupt_record``.

    Without a schema the folder is inferred once, then hints are merged and the
    corrupt-record column declared, and the data is read with that explicit schema.
    """
    lines = keep_files(spark.read.text(path), exclude)
    if schema is None:
        schema = infer_schema(lines, hints)
    elif isinstance(schema, str):
        schema = parse_ddl(spark, schema)
    return parse_lines(lines, schema, rescue=False)


def rejected_records(df: DataFrame, source_col: str = "_source_file") -> DataFrame:
    """Corrupt lines per source file, on a Bronze table.

    Run it on the written Bronze data: Spark rejects a query over *raw* JSON
    whose only data column is ``_corrupt_record``.
    """
    src = F.col(source_col) if source_col in df.columns else F.col("_metadata.file_path")
    return (df.filter(F.col(CORRUPT).isNotNull())
            .groupBy(src.alias("source_file")).agg(F.count(F.lit(1)).alias("rejected")))


#: Why a line is rejected, or (the last) kept with a part that the schema misses.
REASONS = ("not_json", "wrong_type", "unknown_field")


def reject_reason(df: DataFrame) -> Column:
    """One of ``REASONS`` for a Bronze row, NULL for a line that conforms.

    A corrupt line that is a JSON object has a value of another type; any other is no record at all.
    """
    v = F.try_parse_json(CORRUPT)
    bad = F.when(F.schema_of_variant(v).startswith("OBJECT"), "wrong_type").otherwise("not_json")
    drifted = F.when(F.col(RESCUED).isNotNull(), "unknown_field") if RESCUED in df.columns else F.lit(None)
    return F.when(F.col(CORRUPT).isNotNull(), bad).otherwise(drifted)


def rejects_by_reason(df: DataFrame, source_col: str = "_source_file") -> DataFrame:
    """Lines per source file and reason, with the file's lines: ``source_file, reason, lines, of_lines``.

    One pass over two narrow columns; files without such a line have no row.
    """
    marked = df.select(F.col(source_col).alias("source_file"), reject_reason(df).alias("reason"))
    counts = marked.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("of_lines"), *[F.count_if(F.col("reason") == r).alias(r) for r in REASONS])
    long = counts.unpivot(["source_file", "of_lines"], list(REASONS), "reason", "lines")
    return long.filter("lines > 0").select("source_file", "reason", "lines", "of_lines")


def reject_gate(df: DataFrame, max_share: float = 0.01, max_drift: float = 1.0) -> list[dict]:
    """S2 in the gate: files of which more than ``max_share`` of the lines are rejected, or more than ``max_drift`` drifted.

    Returns one entry per such file and cause; reads the counts per file, of which only failing files reach the driver.
    """
    by_file = rejects_by_reason(df).groupBy("source_file", "of_lines").agg(
        F.sum(F.when(F.col("reason") != "unknown_field", F.col("lines")).otherwise(0)).alias("rejected"),
        F.sum(F.when(F.col("reason") == "unknown_field", F.col("lines")).otherwise(0)).alias("drifted"))
    share = lambda c: F.col(c) / F.col("of_lines")
    bad = by_file.filter((share("rejected") > max_share) | (share("drifted") > max_drift)).orderBy("source_file")
    return [r.asDict() for r in bad.collect()]


def raw_inventory(spark: SparkSession, datasets: Mapping[str, str], exclude: str | None = None) -> DataFrame:
    """Files and bytes per dataset, of the files that ingest reads with the same ``exclude``.

    ``binaryFile`` with only ``path``/``length`` selected: the file contents
    are pruned and never read.
    """
    parts = []
    for name, path in datasets.items():
        files = keep_files(spark.read.format("binaryFile").load(path).select("path", "length"), exclude)
        parts.append(files.agg(F.count(F.lit(1)).alias("files"),
                               F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
                     .select(F.lit(name).alias("dataset"), "files", "bytes"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_counted(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: tuple[str, ...] = (), fmt: str = "parquet",
                  options: Mapping[str, str] | None = None) -> int:
    """S15 + A8: write and return the row count gathered during the write."""
    obs = Observation("rows")
    w = (df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).format(fmt)
         .options(**(options or {})))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return int(obs.get.get("rows", 0))


def row_gate(count: int, dataset: str, minimum: int = MIN_ROWS,
             warn_below: int | None = None) -> dict:
    """Pass when ``count > minimum``; warn (not fail) under ``warn_below``."""
    status = "pass" if count > minimum else "fail"
    if status == "pass" and warn_below is not None and count < warn_below:
        status = "warn"
    return {"dataset": dataset, "rows": count, "status": status}


def read_path_sql(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Path-addressed SQL scan (``SELECT * FROM parquet.`path```)."""
    return spark.sql(f"SELECT * FROM {fmt}.`{path}`")


def register(df: DataFrame, name: str) -> DataFrame:
    """Expose a table to SQL by name without copying it."""
    df.createOrReplaceTempView(name)
    return df


def register_tables(spark: SparkSession, tables: Mapping[str, DataFrame], database: str = "default",
                    bucket_by: str | None = None, buckets: int = 200) -> list[dict]:
    """Save each table in the session catalog and count it back; an error is reported per table.

    With ``bucket_by`` a table lies in buckets of that key, sorted by it: joins and aggregates of such tables on
    the key need no exchange, now and in every later run.  Rows are dealt by the key first, so a bucket is one file.
    Returns ``{"table", "rows", "error"}`` for each; the other tables are saved whatever one of them does.
    """
    report = []
    for name, df in tables.items():
        full = f"{database}.{name}"
        try:
            writer = (df.repartition(buckets, bucket_by) if bucket_by else df).write.mode("overwrite")
            if bucket_by:
                writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
            writer.saveAsTable(full)
            report.append({"table": full, "rows": spark.table(full).count(), "error": None})
        except Exception as e:  # noqa: BLE001 - reported to the caller
            report.append({"table": full, "rows": 0, "error": f"{type(e).__name__}: {str(e)[:300]}"})
    return report
