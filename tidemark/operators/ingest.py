"""Feed records -> typed silver rows (map-only, identical for batch and stream)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.envelope import month_bucket, operation_type, surrogate_key


def normalise_feed(feed: DataFrame) -> DataFrame:
    """Feed record -> (raw_json, kafka_event_offset, kafka_partition, kafka_timestamp).

    The raw payload is kept: the silver table is the replayable source of truth.
    """
    return feed.select(
        F.col("value").cast("string").alias("raw_json"),
        F.col("offset").cast("long").alias("kafka_event_offset"),
        F.col("partition").cast("int").alias("kafka_partition"),
        F.col("timestamp").cast("timestamp").alias("kafka_timestamp"),
    )


def to_silver(
    feed: DataFrame,
    ingested_at: Column | None = None,
    exact_decimal: bool = False,
    spec: schemas.TableSpec | None = None,
) -> DataFrame:
    """Parse, type and key change envelopes into silver rows.

    * permissive ``from_json``: malformed, NULL or empty payloads still give a row
      (parsed fields NULL, op UNKNOWN, raw kept); a wrong-typed field is NULL alone;
    * the business key comes from ``after``, else ``before`` (deletes);
      payload columns and event time come from ``after`` only;
    * ``ingested_at`` defaults to ``current_timestamp()`` (one value per
      micro-batch); batch tests may pass a literal to make delete months stable;
    * ``spec`` describes the captured table (default: the account table, 14 silver
      columns); ``exact_decimal`` selects its DECIMAL(14,2) balance variant.

    No shuffle: this is a projection, so it runs inside one stage per partition.
    """
    spec = spec or (schemas.ACCOUNTS_EXACT if exact_decimal else schemas.ACCOUNTS)
    stamp = ingested_at if ingested_at is not None else F.current_timestamp()
    event = F.from_json(F.col("raw_json"), spec.parse_envelope())
    parsed = normalise_feed(feed).withColumn("event", event).select(
        "raw_json",
        "kafka_event_offset",
        "kafka_partition",
        "kafka_timestamp",
        F.col("event.op").alias("operation_code"),
        F.coalesce(F.col(f"event.after.{spec.key}"), F.col(f"event.before.{spec.key}")).alias(spec.key),
        *[F.col(f"event.after.{c}").alias(c) for c in spec.payload_columns],
        F.col(f"event.after.{spec.event_time}").alias(spec.event_time),
        F.col("event.source.lsn").alias("source_commit_lsn"),
    )
    return parsed.select(
        *parsed.columns,
        operation_type(F.col("operation_code")).alias("operation_type"),
        surrogate_key(F.col(spec.key), F.col("source_commit_lsn")).alias("surrogate_key"),
        stamp.cast("timestamp").alias("ingested_at"),
    ).withColumn("event_month", month_bucket(F.col(spec.event_time), F.col("ingested_at")))
