"""Log files: `;`-separated text with a JSON attribute column, and the stats file beside it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from logsonde.functions.time import epoch_seconds
from logsonde.functions.typing import parse_timestamp, to_number
from logsonde.schema import ATTRIBUTE_SCHEMA, CSV_FIELDS, CSV_SCHEMA, JSON_COLUMN

SEPARATOR = ";"


def first_existing_path(spark: SparkSession, paths: Sequence[str]) -> str:
    """The first path that exists on its file system, or an error naming all of them."""
    for p in paths:
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if fs.globStatus(path):
            return p
    raise FileNotFoundError(f"no log file found; looked for: {', '.join(paths)}")


def read_raw(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """The file as text columns. JSON quotes stay as they are because quoting is off."""
    return (
        spark.read.schema(CSV_SCHEMA)
        .options(sep=SEPARATOR, header=True, quote="", escape="", enforceSchema=True)
        .csv(path if isinstance(path, str) else list(path))
    )


def type_columns(raw: DataFrame) -> DataFrame:
    """CSV columns with their types; a value that does not fit becomes null."""
    typed = {}
    for name, kind in CSV_FIELDS:
        if name not in raw.columns:
            continue
        if isinstance(kind, T.TimestampType):
            typed[name] = parse_timestamp(name)
        elif isinstance(kind, (T.IntegerType, T.LongType)):
            typed[name] = to_number(name).try_cast(kind)
        else:
            typed[name] = F.col(name).cast(kind)
    return raw.withColumns(typed)


def parse_json(column: str | Column, schema: T.StructType = ATTRIBUTE_SCHEMA) -> Column:
    """JSON text as a struct; blank and malformed text give null instead of an error."""
    c = F.col(column) if isinstance(column, str) else column
    text = F.nullif(F.trim(c), F.lit(""))
    checked = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    parsed = F.from_json(text, checked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    fields = F.struct(*[parsed[f.name].alias(f.name) for f in schema.fields])
    return F.when(text.isNotNull() & parsed["_bad"].isNull(), fields)


def infer_attributes(df: DataFrame, column: str = JSON_COLUMN, max_keys: int = 1000) -> T.StructType:
    """The attribute schema seen in the rows: the union of all keys, each with the type that holds all its values.

    Types are those of the JSON tokens, so quoted numbers stay text. The rows are aggregated to one schema before
    anything reaches the driver. More than `max_keys` keys are refused: dynamic keys are data, not columns.
    """
    text = F.nullif(F.trim(F.col(column)), F.lit(""))
    seen = df.select(F.schema_of_variant_agg(F.try_parse_json(text)).alias("s")).first()["s"]
    if not seen or not seen.startswith("OBJECT<"):
        return T.StructType([])
    found = T._parse_datatype_string("struct<" + seen[len("OBJECT<") : -1].replace("OBJECT<", "STRUCT<").replace("VARIANT", "STRING").replace("VOID", "STRING") + ">")
    if len(found) > max_keys:
        raise ValueError(f"{len(found)} attribute keys are more than {max_keys}")
    number = (T.DecimalType, T.FloatType)
    return T.StructType(
        [
            T.StructField(f.name, T.DoubleType() if isinstance(f.dataType, number) else f.dataType)
            for f in sorted(found.fields, key=lambda f: f.name)
        ]
    )


def flatten_attributes(
    df: DataFrame,
    column: str = JSON_COLUMN,
    schema: T.StructType = ATTRIBUTE_SCHEMA,
    keys: Sequence[str] | None = None,
) -> DataFrame:
    """`df` without the JSON column and with its keys as columns; `keys` keeps only some of them.

    Only keys of the pruned schema are parsed. A frame without the column is returned as it is.
    """
    if column not in df.columns:
        return df
    if keys is not None:
        schema = T.StructType([f for f in schema.fields if f.name in keys])
    parsed = df.withColumn("_attributes", F.from_json(F.coalesce(column, F.lit("{}")), schema))
    own = [c for c in df.columns if c != column and c not in schema.fieldNames()]
    attributes = []
    for f in schema.fields:
        c = F.col(f"_attributes.{f.name}")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), c)
        attributes.append(c.alias(f.name))
    return parsed.select(*own, *attributes)


def with_event_seq(df: DataFrame) -> DataFrame:
    """Adds `EventSeq`, a tie-break for events of the same time that follows the file order.

    The number comes from the partition and the place in it, so no shuffle or global count is
    needed. Write the table before using it twice: it is only fixed once written.
    """
    return df if "EventSeq" in df.columns else df.withColumn("EventSeq", F.monotonically_increasing_id())


def read_logs(
    spark: SparkSession,
    paths: str | Sequence[str],
    attributes: Sequence[str] | None = None,
    infer: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """The canonical event table from the first of `paths` that exists.

    `attributes` keeps only these JSON keys, `infer` takes the keys from the file instead of the
    fixed schema, `limit` keeps that many rows.
    """
    path = first_existing_path(spark, [paths] if isinstance(paths, str) else paths)
    raw = read_raw(spark, path)
    if limit is not None:
        raw = raw.limit(limit)
    schema = infer_attributes(raw) if infer else ATTRIBUTE_SCHEMA
    return with_event_seq(flatten_attributes(type_columns(raw), schema=schema, keys=attributes))


def limit_rows(df: DataFrame, n: int) -> DataFrame:
    """The first n events in event order (a bounded top-n in each task, no full sort)."""
    return df.orderBy("Timestamp", "EventSeq").limit(n)


def read_stats(spark: SparkSession, path: str) -> DataFrame | None:
    """The one-row stats file, or None with the reason printed when it cannot be read."""
    try:
        stats = spark.read.option("multiLine", True).json(path)
        if "TotalEvents" in stats.columns and "FailureEvents" in stats.columns:
            return stats
        print(f"stats file {path} has no TotalEvents and FailureEvents")
    except Exception as error:  # the file is optional, so a failure is reported only
        print(f"cannot read stats file {path}: {str(error).splitlines()[0]}")
    return None


def _no_separator(c: Column) -> Column:
    return F.translate(c, SEPARATOR, ",")


def attributes_json(df: DataFrame) -> Column:
    """The attribute columns that `df` has as one JSON text, null attributes left out."""
    return F.to_json(F.struct(*[F.col(f.name) for f in ATTRIBUTE_SCHEMA.fields if f.name in df.columns]))


def _utc_text(df: DataFrame, name: str) -> Column:
    """A time as ISO-8601 text in UTC with seven digits, whatever the session's zone."""
    seconds = epoch_seconds(df, name)
    micros = F.pmod(F.floor(F.extract(F.lit("SECOND"), F.col(name)) * 1_000_000), F.lit(1_000_000)).cast("int")
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / 86_400).cast("int"))
    of_day = F.pmod(seconds, F.lit(86_400))
    text = F.format_string(
        "%sT%02d:%02d:%02d.%06d0Z", day.cast("string"), F.floor(of_day / 3600), F.floor(of_day / 60) % 60, of_day % 60, micros
    )
    return F.when(F.col(name).isNotNull(), text)


def csv_columns(df: DataFrame) -> list[Column]:
    """The text of each CSV column of the log format."""
    out = []
    for name, _ in CSV_FIELDS:
        c = F.col(name)
        if name == "Timestamp":
            c = _utc_text(df, name)
        elif name == "Priority":
            c = F.lower(c)
        elif name == "Description":
            c = _no_separator(c)
        out.append(F.coalesce(c.cast("string"), F.lit("")).alias(name))
    return [*out, _no_separator(attributes_json(df)).alias(JSON_COLUMN)]


def csv_line(df: DataFrame) -> DataFrame:
    """(EventSeq, line): each event as a line of the log format."""
    return df.select("EventSeq", F.concat_ws(SEPARATOR, *csv_columns(df)).alias("line"))


def write_logs(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.select(*csv_columns(df)).write.mode(mode).options(
        sep=SEPARATOR, header=True, quote="", escape="", emptyValue="", nullValue=""
    ).csv(path)


def write_stats(stats: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The one-row counters as JSON."""
    stats.coalesce(1).write.mode(mode).json(path)
