"""Which fields of a change envelope the typed parse had to null, and why.

``from_json`` with a fixed schema nulls a field of another type and keeps its siblings (E3), and
nulls everything of a malformed payload (E2); afterwards such a null looks like a real one. Beside
the typed parse, the payload is read once more as VARIANT, which keeps every value with its own type:
a field that the VARIANT has and the typed struct lacks was nulled for its type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schemas
from .ingest import normalise_feed

MALFORMED = "malformed"


def _leaves(schema: StructType, path: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    out = []
    for f in schema.fields:
        out += _leaves(f.dataType, (*path, f.name)) if isinstance(f.dataType, StructType) else [(*path, f.name)]
    return out


def field_faults(feed: DataFrame, spec: schemas.TableSpec = schemas.ACCOUNTS) -> DataFrame:
    """(kafka_partition, kafka_event_offset, field, found): one row for each field that the parse nulled.

    ``field`` is its path in the envelope (``after.account_id``), ``found`` the type that the payload has
    there (``STRING``, ``DECIMAL(2,1)``, ``OBJECT<...>``, ...). A payload that is no JSON gives one row, with
    ``field`` ``malformed`` and no type. JSON nulls, absent fields and a payload that is null are no
    faults. Map-side only: no shuffle. A struct that is no object (``"after": 7``) is reported under its own name.
    """
    envelope = spec.parse_envelope()
    rows = normalise_feed(feed).select("kafka_partition", "kafka_event_offset", "raw_json", F.try_parse_json("raw_json").alias("v")).withColumn(
        "event", F.from_json("raw_json", envelope))
    checks = []
    structs = [(f.name,) for f in envelope.fields if isinstance(f.dataType, StructType)]
    for path in [*structs, *_leaves(envelope)]:
        there = F.try_variant_get("v", "$." + ".".join(path), "variant")
        kind = F.schema_of_variant(there)
        wrong = there.isNotNull() & (kind != "VOID")
        if path in structs:
            wrong = wrong & ~kind.startswith("OBJECT")
        else:
            wrong = wrong & F.col("event." + ".".join(path)).isNull()
        checks.append(F.when(wrong, F.struct(F.lit(".".join(path)).alias("field"), kind.alias("found"))))
    bad = F.when(F.col("raw_json").isNotNull() & F.col("v").isNull(), F.struct(F.lit(MALFORMED).alias("field"), F.lit(None).cast("string").alias("found")))
    found = F.array_compact(F.array(bad, *checks))
    return rows.select("kafka_partition", "kafka_event_offset", F.inline(found))
