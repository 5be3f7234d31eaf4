"""Metadata tables: units, nodes and the two signal catalogues.

Paths are Spark paths: whatever a Spark reader can open will do.  A missing table raises ``FileNotFoundError``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import uuid_text

FILES = {"units": "units.parquet", "nodes": "nodes.parquet", "uuid_signals": "signal_data_point_rel.parquet", "int_signals": "signal_data_point_rel_int.parquet"}
_UUIDS = {"nodes": ("node_id", "parent_node", "predecessor"), "uuid_signals": ("signal_id", "node_id"), "int_signals": ("node_id",), "units": ()}


@dataclass
class Metadata:
    """The four metadata tables of a dataset, lazily read."""

    units: DataFrame
    nodes: DataFrame
    uuid_signals: DataFrame
    int_signals: DataFrame


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    path = f"{base.rstrip('/')}/{FILES[name]}"
    try:
        df = spark.read.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            raise FileNotFoundError(path) from e
        raise
    return df.withColumns({c: uuid_text(c) for c in _UUIDS[name] if c in df.columns and c != "signal_id" or name == "uuid_signals" and c == "signal_id"})


def load_metadata(spark: SparkSession, base: str) -> Metadata:
    return Metadata(**{n: read_table(spark, base, n) for n in FILES})


def canonical_uuid_signals(df: DataFrame) -> DataFrame:
    """signal_id, node_id, unit of the UUID catalogue under the catalogue's names; the integer id is null."""
    return df.select(F.lit(None).cast("bigint").alias("signal_id"), F.col("signal_id").alias("signal_id_uuid"), F.col("node_id").alias("node_id_uuid"), F.col("unit").alias("unit_code"))


def canonical_int_signals(df: DataFrame) -> DataFrame:
    return df.select(F.col("signal_id").try_cast("bigint").alias("signal_id"), F.lit(None).cast("string").alias("signal_id_uuid"), F.col("node_id").alias("node_id_uuid"), F.col("unit").alias("unit_code"))
