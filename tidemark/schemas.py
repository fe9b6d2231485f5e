"""Fixed schemas of the change-feed data model.

Nothing is inferred: every reader and parser in the package is given one of
these ``StructType`` values, so a malformed record can never change a schema.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql.types import (
    DataType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Exact type of the source table's balance column (NUMERIC(14,2)).
BALANCE_DECIMAL = DecimalType(14, 2)

SOURCE_INFO = StructType(
    [
        StructField("lsn", LongType()),
        StructField("ts_ms", LongType()),
    ]
)


def pick(schema: StructType, names: list[str]) -> StructType:
    return StructType([schema[n] for n in names])


def extend(schema: StructType, more: dict[str, str]) -> StructType:
    """``schema`` with further columns, given as name and type."""
    out = StructType(list(schema.fields))
    for name, kind in more.items():
        out = out.add(name, kind)
    return out


# Silver columns that describe the delivery, not the captured row.
DELIVERY_COLUMNS = ("raw_json", "kafka_event_offset", "kafka_partition", "kafka_timestamp", "operation_code")
INGEST_COLUMNS = ("ingested_at", "event_month")


@dataclass(frozen=True)
class TableSpec:
    """Shape of one captured table: business key, payload columns taken from the
    ``after`` image, the event-time column (text, as the connector sends it), and
    image fields that are parsed but never projected."""

    key: str = "account_id"
    key_type: DataType = LongType()
    payload: tuple = (("current_balance", DoubleType()), ("currency", StringType()))
    event_time: str = "transaction_timestamp"
    unused: tuple = ("updated_at",)

    def with_type(self, column: str, data_type: DataType) -> "TableSpec":
        payload = tuple((c, data_type if c == column else t) for c, t in self.payload)
        return replace(self, payload=payload)

    @property
    def payload_columns(self) -> list[str]:
        return [c for c, _ in self.payload]

    def image(self) -> StructType:
        """One row image (``before`` / ``after``) of the captured table."""
        fields = [StructField(self.key, self.key_type)]
        fields += [StructField(c, t) for c, t in self.payload]
        fields += [StructField(self.event_time, StringType())]
        fields += [StructField(c, StringType()) for c in self.unused]
        return StructType(fields)

    def envelope(self) -> StructType:
        """Change envelope carried in the feed record's ``value``."""
        image = self.image()
        return StructType(
            [
                StructField("before", image),
                StructField("after", image),
                StructField("source", SOURCE_INFO),
                StructField("op", StringType()),
                StructField("ts_ms", LongType()),
            ]
        )

    def parse_envelope(self) -> StructType:
        """The envelope pruned to the fields silver projects (key from both images,
        payload and event time from ``after``, the LSN, the op). Parsing fewer fields
        is cheaper; under permissive parsing with partial results a field's value
        never depends on its siblings, so the projected values are the same."""
        after = StructType([f for f in self.image().fields if f.name not in self.unused])
        return StructType(
            [
                StructField("before", StructType([StructField(self.key, self.key_type)])),
                StructField("after", after),
                StructField("source", StructType([StructField("lsn", LongType())])),
                StructField("op", StringType()),
            ]
        )

    def silver(self) -> StructType:
        """Append-only event table, in write order."""
        return StructType(
            [
                StructField("raw_json", StringType()),
                StructField("kafka_event_offset", LongType()),
                StructField("kafka_partition", IntegerType()),
                StructField("kafka_timestamp", TimestampType()),
                StructField("operation_code", StringType()),
                StructField(self.key, self.key_type),
                *[StructField(c, t) for c, t in self.payload],
                StructField(self.event_time, StringType()),
                StructField("source_commit_lsn", LongType()),
                StructField("operation_type", StringType()),
                StructField("surrogate_key", LongType(), nullable=False),
                StructField("ingested_at", TimestampType()),
                StructField("event_month", StringType()),
            ]
        )

    def gold_columns(self) -> list[str]:
        return ["surrogate_key", self.key, *self.payload_columns, self.event_time, "source_commit_lsn", "operation_type"]


# The captured account table; balances arrive as JSON doubles (the connector
# flattens NUMERIC), or exactly as DECIMAL(14,2) ("1250.75" and 1250.75 both parse,
# overflow -> NULL).
ACCOUNTS = TableSpec()
ACCOUNTS_EXACT = ACCOUNTS.with_type("current_balance", BALANCE_DECIMAL)


def row_image(balance_type=DoubleType()) -> StructType:
    return ACCOUNTS.with_type("current_balance", balance_type).image()


def envelope(balance_type=DoubleType()) -> StructType:
    return ACCOUNTS.with_type("current_balance", balance_type).envelope()


ENVELOPE = ACCOUNTS.envelope()
ENVELOPE_DECIMAL = ACCOUNTS_EXACT.envelope()

# One record of the durable, ordered change log (same shape as a Kafka row,
# minus the columns the ingest never reads).
FEED = StructType(
    [
        StructField("value", StringType()),
        StructField("offset", LongType()),
        StructField("partition", IntegerType()),
        StructField("timestamp", TimestampType()),
    ]
)


def silver(balance_type=DoubleType()) -> StructType:
    """Account silver (14 columns, write order)."""
    return ACCOUNTS.with_type("current_balance", balance_type).silver()


SILVER = silver()
SILVER_COLUMNS = [f.name for f in SILVER.fields]

# Gold: one current row per business key, in presentation order.
GOLD_COLUMNS = ACCOUNTS.gold_columns()

# Silver preview as shown next to gold.
PREVIEW_COLUMNS = [
    "surrogate_key",
    "account_id",
    "operation_type",
    "current_balance",
    "currency",
    "transaction_timestamp",
    "source_commit_lsn",
    "kafka_event_offset",
    "event_month",
    "ingested_at",
]

# Row identity of a silver row: its feed position and arrival. A later re-ingest of the same
# positions makes new rows, which an earlier invalidation does not touch.
ROW_IDENTITY = ["kafka_partition", "kafka_event_offset", "ingested_at"]

# What an invalidation run keeps: surrogate keys, their visible copies, and since which run they are kept.
KEPT = StructType(
    [
        StructField("surrogate_key", LongType()),
        StructField("_copies", LongType()),
        StructField("_from_version", LongType()),
        StructField("_from_cutoff", LongType()),  # rows of the stream sink up to here stay hidden, in microseconds
    ]
)

# Arrivals of backfills that runs have covered, and the run that covered them first.
ARRIVALS = StructType([StructField("ingested_at", TimestampType()), StructField("_first_version", LongType())])

# State snapshots and invalidation runs, one row per version: the latest arrival that it covers, in microseconds.
SNAPSHOT_LOG = StructType([StructField("version", LongType()), StructField("cutoff", LongType())])

# Layouts of the visible rows, one row per layout: the run it follows, that run's cut-off, and the number of buckets.
LAYOUT_LOG = StructType([StructField("version", LongType()), StructField("cutoff", LongType()), StructField("buckets", IntegerType())])

# Maintenance log, one row per run.
HISTORY = StructType(
    [
        StructField("version", LongType()),
        StructField("timestamp", TimestampType()),
        StructField("operation", StringType()),
        StructField("metrics", MapType(StringType(), StringType())),
    ]
)

# Source table snapshot (5 columns, exact balance).
SOURCE = StructType(
    [
        StructField("account_id", LongType(), nullable=False),
        StructField("current_balance", BALANCE_DECIMAL, nullable=False),
        StructField("currency", StringType(), nullable=False),
        StructField("transaction_timestamp", TimestampType(), nullable=False),
        StructField("updated_at", TimestampType(), nullable=False),
    ]
)

# Set-based mutation batch; ``seq`` is the request's position in the batch.
REQUEST = StructType(
    [
        StructField("seq", LongType()),
        StructField("action", StringType()),
        StructField("account_id", LongType()),
        StructField("balance", DoubleType()),
        StructField("currency", StringType()),
    ]
)

# The names under which silver and gold are registered.
SILVER_VIEW = "silver_accounting_cdc_staging"
GOLD_VIEW = "gold_accounting_current"
