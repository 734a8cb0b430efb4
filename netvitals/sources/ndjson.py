"""NDJSON and Parquet history: reading, rejects, table registration, streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from netvitals.schema import PROBE_COLUMNS, PROBE_DDL

CORRUPT = "_corrupt_record"


def with_time(rows: DataFrame) -> DataFrame:
    """Adds ``ts``: the ISO text where it parses, else the epoch second; fills ``unix_ts``
    the other way round."""
    said = F.try_to_timestamp(F.col("timestamp"))
    ts = F.coalesce(said, F.timestamp_seconds("unix_ts"))
    return rows.withColumn("ts", ts).withColumn(
        "unix_ts", F.coalesce("unix_ts", F.unix_seconds("ts"))
    )


def extra_of(value: Column) -> Column:
    """The fields of a JSON object outside the declared ones as JSON text, null without any; each
    value is kept as it was, whatever its type. Lines without such fields are not parsed again."""
    unknown = F.array_except(F.json_object_keys(value), F.array(*[F.lit(c) for c in PROBE_COLUMNS]))
    fields = F.from_json(value, "map<string, variant>")
    kept = F.map_filter(fields, lambda k, v: ~k.isin(PROBE_COLUMNS))
    return F.when(F.size(unknown) > 0, F.to_json(kept))


def parsed_lines(lines: DataFrame, extra: bool = False) -> DataFrame:
    """(value, p, ok): text lines that are not blank, parsed once under the whole schema; ``ok``
    tells those that are JSON objects, ``extra`` adds their fields outside the schema. By an expression rather than by the JSON reader, whose
    verdict on a line depends on which columns a query selects."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_json("value", f"{PROBE_DDL}, {CORRUPT} STRING", options)
    # a generator's result is kept, so that the filter and the columns share one parse
    rows = lines.filter(F.trim("value") != "").select("value", F.explode(F.array(parsed)).alias("p"))
    doubtful = F.col("p").isNull() | F.col(f"p.{CORRUPT}").isNotNull()
    ok = F.when(doubtful, F.json_object_keys("value").isNotNull()).otherwise(True)
    rows = rows.withColumn("ok", ok)
    return rows.withColumn("extra", extra_of(F.col("value"))) if extra else rows


def split_parsed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(probe rows, rejected lines) of `parsed_lines`, with their ``extra`` if it was asked for."""
    more = ["extra"] if "extra" in rows.columns else []
    good = rows.filter("ok").select(*[F.col(f"p.{c}") for c in PROBE_COLUMNS], *more)
    return with_time(good), rows.filter("NOT ok").select(F.col("value").alias("line"))


def parse_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(probe rows, rejected lines) of text lines, streaming or not.

    Blank lines vanish. A field of the wrong type is null in an otherwise kept row; only a
    line that is no JSON object is a reject.
    """
    return split_parsed(parsed_lines(lines))


def lenient_ndjson(spark: SparkSession, path) -> tuple[DataFrame, DataFrame]:
    """(probe rows, rejected lines) of NDJSON files under the fixed schema."""
    return parse_lines(spark.read.text(path))


def read_probes(spark: SparkSession, path) -> DataFrame:
    """Probe rows of NDJSON files; lines that are no JSON objects are left out."""
    return lenient_ndjson(spark, path)[0]


def raw_table(spark: SparkSession, name: str, path: str) -> None:
    """Registers NDJSON files for SQL as a temporary view, with the rows of `read_probes`
    whichever columns a query reads."""
    read_probes(spark, path).createOrReplaceTempView(name)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """Columnar history written by the compaction job, with its ``hour`` partitions."""
    return spark.read.schema(f"{PROBE_DDL}, ts TIMESTAMP, hour STRING").parquet(path)


def line_stream(spark: SparkSession, path: str, files_per_trigger: int | None = 200) -> DataFrame:
    """Lines of NDJSON files as they arrive. Progress is kept by the query's checkpoint, so
    nothing is lost between runs; a file transport stands in for a message broker."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)


def probe_stream(spark: SparkSession, path: str, files_per_trigger: int | None = 200) -> DataFrame:
    """Probe rows of a `line_stream`."""
    return parse_lines(line_stream(spark, path, files_per_trigger))[0]


def dedup_events(
    rows: DataFrame, lateness: str | None = "10 minutes", keys: tuple[str, ...] = ("event_id",)
) -> DataFrame:
    """One row per event_id (or ``keys``), for at-least-once sources; rows without an id are all kept.

    On a stream, ids are remembered for ``lateness`` and later records are dropped, so use it
    for live views, never before an archive. A batch keeps the copy with the greatest (ts,
    content) whatever the order of arrival.
    """
    known, nameless = rows.filter("event_id IS NOT NULL"), rows.filter("event_id IS NULL")
    if rows.isStreaming:
        # two branches of one source; the watermark stays with the branch that needs it
        return known.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(list(keys)).unionByName(nameless)
    content = F.xxhash64(*[F.col(c) for c in rows.columns])
    newest = Window.partitionBy(*keys).orderBy(F.desc("ts"), content)
    first = known.withColumn("_copy", F.row_number().over(newest)).filter("_copy = 1").drop("_copy")
    return first.unionByName(nameless)
