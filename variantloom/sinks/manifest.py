"""Resource manifest: one row per resource, the latest wins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Manifest columns in order; sizes are integers, the rest text.
MANIFEST_COLUMNS = (
    "resource", "version", "source", "local_path", "size", "checksum", "download_date", "status", "expected_size",
    "actual_size", "verification_timestamp", "chromosome", "ancestry", "started_at", "completed_at",
    "software_version", "preparation_command",
)
_SIZES = {"size", "expected_size", "actual_size"}
MANIFEST_SCHEMA = T.StructType(
    [T.StructField(c, T.LongType() if c in _SIZES else T.StringType()) for c in MANIFEST_COLUMNS]
)


def conform(raw: DataFrame) -> DataFrame:
    """Add missing columns as null, cast leniently, keep the fixed order."""
    return raw.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in raw.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in MANIFEST_SCHEMA
        ]
    )


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.csv(path, sep="\t", header=True, inferSchema=False)
    cleaned = raw.select(*[F.when(~F.col(c).isin("NA", ""), F.col(c)).alias(c) for c in raw.columns])
    return conform(cleaned)


def upsert(current: DataFrame, rows: DataFrame) -> DataFrame:
    """New rows replace those of the same resource; sorted by resource."""
    fresh = conform(rows)
    fresh = fresh.withColumn("actual_size", F.coalesce("actual_size", "size"))
    kept = conform(current).join(fresh.select("resource"), "resource", "left_anti").select(*MANIFEST_COLUMNS)
    return kept.unionByName(fresh).orderBy("resource")


def lookup(manifest: DataFrame, resource: str) -> DataFrame:
    return manifest.filter(F.col("resource") == resource)
