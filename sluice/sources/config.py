"""Label map and schema dimensions.

The label map is a small JSON document (device code → label, device, group, schema, hasData;
schema → expected headers and aliases).  It is read with ``spark.read.json(multiLine)`` and
exploded into two tiny dimension tables that are broadcast (fixed size: one row per device
code / schema).  Column orders (headerless files, canonical header lines) come from a
separate JSON document mapping schema id → ordered header list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LABEL_SCHEMA = T.StructType([
    T.StructField("code", T.StringType()),
    T.StructField("label_name", T.StringType()),
    T.StructField("device_address", T.StringType()),
    T.StructField("physical_group", T.StringType()),
    T.StructField("schema_id", T.StringType()),
    T.StructField("has_data", T.BooleanType()),
])

SCHEMA_DIM = T.StructType([
    T.StructField("schema_id", T.StringType()),
    T.StructField("expected_headers", T.ArrayType(T.StringType())),
    T.StructField("header_aliases", T.MapType(T.StringType(), T.StringType())),
    T.StructField("column_order", T.ArrayType(T.StringType())),
])

# The deployment's default label map (device code → label, device, group,
# schema, hasData) and the two schemas that carry header allow-lists.
DEFAULT_LABELS = [
    ("001", "E3 Site Total Power", "mb-001", "electrical_grid", "power_pulse_v1", True),
    ("002", "ModHopper Wireless Transceiver #2", "mb-002", "modhopper_status", "status_only_v1", False),
    ("003", "F3 and P2 Booster Pump Flex IO", "mb-003", "booster_pump", "booster_flex_v1", True),
    ("004", "E1 Booster Pump Power Meter", "mb-004", "electrical_grid", "wattnode_64_v1", True),
    ("005", "E4 and E5 Solar and Hydro Plant Power", "mb-005", "solar_field", "solar_hydro_pulse_v1", True),
    ("006", "F1 F2 and P1 Hydro Plant Flex IO", "mb-006", "hydro_plant", "hydro_flex_v1", True),
    ("007", "Deep Well ModHopper Transceiver", "mb-007", "modhopper_status", "status_only_v1", False),
    ("008", "F4 T1 and T2 Deep Well Pump Flex IO", "mb-008", "deep_well", "deep_well_flex_v1", True),
    ("009", "E2 Deep Well Pump Power Meter", "mb-009", "deep_well", "wattnode_64_v1", True),
]

# schema id → (expected headers, header aliases).
DEFAULT_SCHEMAS = {
    "default_v1": ([], {}),
    "status_only_v1": ([], {}),
    "power_pulse_v1": ([
        "SCE Main Power Pulse #1",
        "SCE Main Power Pulse #1 Demand",
        "SCE Main Power Pulse #1 Instantaneous",
        "SCE Main Power Pulse #1 Min",
        "SCE Main Power Pulse #1 Max",
        "#2 Pulse from SCE net meter",
        "#2 Pulse from SCE net meter Demand",
        "#2 Pulse from SCE net meter Instantaneous",
        "#2 Pulse from SCE net meter Min",
        "#2 Pulse from SCE net meter Max",
        "Power from SCE Main Power Pulse #1",
        "Power from SCE Main Power Pulse #1 Demand",
        "Power from SCE Main Power Pulse #1 Instantaneous",
        "Power from SCE Main Power Pulse #1 Min",
        "Power from SCE Main Power Pulse #1 Max",
        "Power to SCE #2 Pulse from SCE net meter",
        "Power to SCE #2 Pulse from SCE net meter Demand",
        "Power to SCE #2 Pulse from SCE net meter Instantaneous",
        "Power to SCE #2 Pulse from SCE net meter Min",
        "Power to SCE #2 Pulse from SCE net meter Max",
    ], {}),
    "solar_hydro_pulse_v1": ([
        "Solar Array Power",
        "Solar Array Power Demand",
        "Solar Array Power Instantaneous",
        "Solar Array Power Min",
        "Solar Array Power Max",
        "Hydro Plant Power",
        "Hydro Plant Power Demand",
        "Hydro Plant Power Instantaneous",
        "Hydro Plant Power Min",
        "Hydro Plant Power Max",
        "Hydo Plant Power",
        "Hydo Plant Power Demand",
        "Hydo Plant Power Instantaneous",
        "Hydo Plant Power Min",
        "Hydo Plant Power Max",
    ], {
        "hydo plant power": "Hydro Plant Power",
        "hydo plant power demand": "Hydro Plant Power Demand",
        "hydo plant power instantaneous": "Hydro Plant Power Instantaneous",
        "hydo plant power min": "Hydro Plant Power Min",
        "hydo plant power max": "Hydro Plant Power Max",
    }),
}


def default_labels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DEFAULT_LABELS, LABEL_SCHEMA)


def default_schemas(spark: SparkSession, column_orders: dict[str, list[str]] | None = None) -> DataFrame:
    ids = sorted(set(DEFAULT_SCHEMAS) | set(column_orders or {}))
    rows = [(i, DEFAULT_SCHEMAS.get(i, ([], {}))[0], DEFAULT_SCHEMAS.get(i, ([], {}))[1],
             (column_orders or {}).get(i)) for i in ids]
    return spark.createDataFrame(rows, SCHEMA_DIM)


def load_label_map(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Label-map JSON → (labels dim, schemas dim).  A document without ``labels`` is
    rejected; ``hasData`` defaults to true."""
    doc = spark.read.option("multiLine", True).json(path)
    if "labels" not in doc.columns:
        raise ValueError("invalid label map: no 'labels' object")
    labels_json = doc.select(F.to_json("labels").alias("j"))
    lab = labels_json.select(F.explode(F.from_json("j", "map<string,struct<labelName:string,deviceAddress:string,"
                                                   "physicalGroup:string,schemaId:string,hasData:boolean>>"))
                             .alias("code", "v"))
    labels = lab.select(
        "code",
        F.coalesce(F.col("v.labelName"), F.concat(F.lit("Label "), F.col("code"))).alias("label_name"),
        F.coalesce(F.col("v.deviceAddress"), F.concat(F.lit("mb-"), F.col("code"))).alias("device_address"),
        F.coalesce(F.col("v.physicalGroup"), F.lit("unknown")).alias("physical_group"),
        F.coalesce(F.col("v.schemaId"), F.lit("default_v1")).alias("schema_id"),
        F.coalesce(F.col("v.hasData"), F.lit(True)).alias("has_data"),
    )
    if "schemas" in doc.columns:
        sch = doc.select(F.explode(F.from_json(F.to_json("schemas"),
                                               "map<string,struct<expectedHeaders:array<string>,"
                                               "headerAliases:map<string,string>,columnOrder:array<string>>>"))
                         .alias("schema_id", "v"))
        schemas = sch.select("schema_id",
                             F.coalesce("v.expectedHeaders", F.array().cast("array<string>")).alias("expected_headers"),
                             F.coalesce("v.headerAliases", F.create_map().cast("map<string,string>"))
                             .alias("header_aliases"),
                             F.col("v.columnOrder").alias("column_order"))
    else:
        schemas = spark.createDataFrame([], SCHEMA_DIM)
    return labels, schemas


def load_column_orders(spark: SparkSession, path: str) -> DataFrame:
    """Column orders file (schema id → ordered header list) as a dim ``(schema_id, column_order)``.

    Read with Spark (no driver-side parsing); an unreadable or malformed file yields an empty
    dim, as the reference falls back to no orders on any error."""
    empty = spark.createDataFrame([], "schema_id string, column_order array<string>")
    try:
        doc = spark.read.option("multiLine", True).json(path)
        if doc.columns == ["_corrupt_record"]:
            return empty
        orders = doc.select(F.explode(F.from_json(F.to_json(F.struct(*[F.col(f"`{c}`") for c in doc.columns])),
                                                  "map<string,array<string>>")).alias("schema_id", "column_order"))
        return orders.where(F.col("column_order").isNotNull())
    except Exception:  # missing path and similar: no orders
        return empty


def with_column_orders(schemas: DataFrame, orders: DataFrame) -> DataFrame:
    """Fill ``column_order`` from an orders dim (schema_id, column_order) where a schema has none."""
    o = orders.select("schema_id", F.col("column_order").alias("_co"))
    full = schemas.join(o, "schema_id", "full_outer")
    return full.select("schema_id",
                       F.coalesce("expected_headers", F.array().cast("array<string>")).alias("expected_headers"),
                       F.coalesce("header_aliases", F.create_map().cast("map<string,string>")).alias("header_aliases"),
                       F.coalesce("column_order", "_co").alias("column_order"))


def resolve_label(files: DataFrame, labels: DataFrame, code_col: str = "label_code") -> DataFrame:
    """Attach label fields by code (broadcast: one row per device code).

    No code → ``unknown`` everywhere; a code missing from the map keeps ``mb-<code>``,
    ``Unknown Label``, group ``unknown``, schema ``default_v1`` and hasData true.
    """
    lab = F.broadcast(labels.select(F.col("code").alias("_code"), F.col("label_name").alias("_ln"),
                                    F.col("device_address").alias("_da"), F.col("physical_group").alias("_pg"),
                                    F.col("schema_id").alias("_sid"), F.col("has_data").alias("_hd")))
    j = files.join(lab, F.col(code_col) == F.col("_code"), "left")
    unknown = F.col(code_col) == "unknown"
    return j.select(
        *files.columns,
        F.when(unknown, "Unknown Label").otherwise(F.coalesce("_ln", F.lit("Unknown Label"))).alias("label_name"),
        F.when(unknown, "unknown").otherwise(F.coalesce("_da", F.concat(F.lit("mb-"), F.col(code_col))))
        .alias("device_address"),
        F.when(unknown, "unknown").otherwise(F.coalesce("_pg", F.lit("unknown"))).alias("label_group"),
        F.when(unknown, "default_v1").otherwise(F.coalesce("_sid", F.lit("default_v1"))).alias("schema_id"),
        F.when(unknown, True).otherwise(F.coalesce("_hd", F.lit(True))).alias("has_data"),
    )


def canonical_header_lines(labels: DataFrame, schemas: DataFrame) -> DataFrame:
    """Device code → tab-joined canonical header line (schemas with a column order)."""
    s = schemas.where(F.col("column_order").isNotNull() & (F.size("column_order") > 0))
    return labels.join(F.broadcast(s), "schema_id").select(
        "code", F.array_join("column_order", "\t").alias("header_line"))

