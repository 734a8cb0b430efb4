"""Records as variants: fields outside the declared schema are kept, typed on demand and counted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netvitals.schema import PROBE_COLUMNS, PROBE_DDL


def variant_lines(lines: DataFrame) -> DataFrame:
    """(value, record): text lines that are not blank, each parsed once into a VARIANT, null where
    it is no JSON."""
    rows = lines.filter(F.trim("value") != "")
    return rows.select("value", F.try_parse_json("value").alias("record"))


def typed_probes(variants: DataFrame) -> DataFrame:
    """Probe columns of `variant_lines` beside the whole ``record``; a field of the wrong type is
    null here and as it was in the record."""
    fields = [f.split() for f in PROBE_DDL.split(",")]
    typed = [F.try_variant_get("record", f"$.{name}", kind).alias(name) for name, kind in fields]
    return variants.filter("record IS NOT NULL").select(*typed, "record")


def fields_of(variants: DataFrame) -> DataFrame:
    """(value, key, field): the top-level fields of every record that is an object; others have
    none."""
    return variants.sparkSession.sql(
        """SELECT value, e.key, e.field
           FROM {variants}, LATERAL variant_explode(record) AS e(pos, key, field) WHERE e.key IS NOT NULL""",
        variants=variants,
    )


def schema_drift(variants: DataFrame, known: list[str] | None = None) -> DataFrame:
    """(field, kind, records): fields outside ``known`` (the probe columns by default) with each
    type they come in and the number of records that hold it."""
    known = PROBE_COLUMNS if known is None else known
    unknown = fields_of(variants).filter(~F.col("key").isin(known))
    kind = F.coalesce(F.schema_of_variant("field"), F.lit("VOID"))
    return unknown.groupBy(F.col("key").alias("field"), kind.alias("kind")).agg(F.count(F.lit(1)).alias("records"))


def drift_schema(variants: DataFrame) -> DataFrame:
    """One row with the merged schema of all records, as SQL text."""
    return variants.agg(F.schema_of_variant_agg("record").alias("merged"))


def extra_fields(variants: DataFrame, known: list[str] | None = None) -> DataFrame:
    """(value, extra): the fields of each record outside ``known`` as JSON text by name, for
    records that have some: what a table of the declared columns would lose."""
    known = PROBE_COLUMNS if known is None else known
    unknown = fields_of(variants).filter(~F.col("key").isin(known))
    pair = F.struct("key", F.to_json("field").alias("json"))
    return unknown.groupBy("value").agg(F.map_from_entries(F.array_distinct(F.collect_list(pair))).alias("extra"))
