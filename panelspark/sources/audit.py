"""Audit log of upstream calls: request hashes, secrets, idempotent append."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.upsert import append_if_absent, one_per_key
from ..session import stored
from .snapshots import path_exists

# ---- Fixed values: parameter names that hold secrets ------------------------
DROPPED_PARAMETERS = ["api_key", "key"]
MASKED_PARAMETERS = ["registrationkey"]
MASK = "***"
# ------------------------------------------------------------------------------
BATCH_PARAMETERS = ["_batch_id"]


def public_parameters(params: Column) -> Column:
    """Drop or mask secrets in a map of request parameters."""
    kept = F.map_filter(params, lambda k, _: ~k.isin(DROPPED_PARAMETERS))
    return F.transform_values(kept, lambda k, v: F.when(k.isin(MASKED_PARAMETERS), F.lit(MASK)).otherwise(v))


def sorted_json(params: Column) -> Column:
    """JSON text of a map with its keys in order, so equal maps give equal text."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(params))))


def request_hash(endpoint: Column, params: Column, payload: Column) -> Column:
    """sha256 of the call. The batch is no part of it, so a repeated call in a
    later batch is recognised."""
    stable = F.map_filter(params, lambda k, _: ~k.isin(BATCH_PARAMETERS))
    text = F.to_json(
        F.struct(endpoint.alias("endpoint"), sorted_json(stable).alias("params"), sorted_json(payload).alias("payload"))
    )
    return F.sha2(text, 256)


def audit_rows(calls: DataFrame) -> DataFrame:
    """Calls with hash and public parameters as JSON text."""
    empty = F.create_map().cast("map<string,string>")
    params = public_parameters(F.coalesce("params", empty))
    payload = public_parameters(F.coalesce("payload", empty))
    return calls.select(
        "etl_batch_id",
        request_hash(F.col("endpoint"), params, payload).alias("request_hash"),
        "requested_at",
        "endpoint",
        sorted_json(params).alias("params_json"),
        sorted_json(payload).alias("payload_json"),
        "http_status",
        "response_json",
        "notes",
    )


def new_calls(log: DataFrame, calls: DataFrame) -> DataFrame:
    """Audit rows to append: known hashes are left alone."""
    return append_if_absent(log, audit_rows(calls), ["request_hash"], order="requested_at")


def record_calls(spark: SparkSession, path: str, calls: DataFrame) -> int:
    """Append the calls that the log does not have; returns how many.

    The log is cut into 256 folders by the first letters of the hash. A file of calls
    reads only the folders it falls in, and of those only the hashes.
    """
    rows = stored(audit_rows(calls).withColumn("shard", F.substring("request_hash", 1, 2)), "calls")
    fresh = rows
    if path_exists(spark, path):
        shards = [r[0] for r in rows.select("shard").distinct().collect()]  # at most 256
        log = spark.read.schema(rows.schema).parquet(path).filter(F.col("shard").isin(shards))
        known = log.select("shard", "request_hash")
        fresh = rows.join(known, ["shard", "request_hash"], "left_anti").select(*rows.columns)
    fresh = stored(one_per_key(fresh, ["request_hash"], "requested_at", last=False), "new_calls")
    fresh.repartition("shard").write.mode("append").partitionBy("shard").parquet(path)
    return fresh.count()


def as_json(cols: list[str]) -> Column:
    return F.to_json(F.struct(*cols))


def json_text(col: str, field: str) -> Column:
    return F.get_json_object(col, f"$.{field}")
