"""Exact duplicates by progressive refinement.

Rows are compared by length, then by a hash of a short prefix; only groups in which two rows
still agree have their whole content hashed. The first two rounds move a few bytes a row. The
third needs the texts of the surviving groups in one place with the group's key: a bitmap of
fixed size, built from the surviving keys, drops nearly all other rows before the shuffle (its
false positives are removed by the join that follows, so the result is exact at any size).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, free_name, measured, named_ids

PREFIX_CHARS = 64

#: Bits of the bitmap of surviving keys. Its size is fixed: 2**22 bits are 512 KB.
BITMAP_BITS = 1 << 22
_BLOCK_BITS = 8 * 4096  # bits that one row of bitmap_construct_agg holds


def _position(*keys: str) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BITMAP_BITS))


def _bit_is_set(bitmap: Column, position: Column) -> Column:
    at = F.pmod(position, F.lit(_BLOCK_BITS)).cast("int")
    byte = F.conv(F.hex(F.substring(bitmap, (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, F.pmod(at, F.lit(8))) == 1


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Which row of each group of identical texts stays.

    One row per distinct id and text: doc_id, keep_id (largest id of the group), group_size (input rows of
    the group), kept, copies (input rows of this id and text), n_bytes, prefix_hash, full_hash (SHA-256
    of the text, null where length or prefix already tell the text from all others).

    - A null text counts as the empty text.
    - Rows that repeat both id and text are one document: one result row, with ``copies`` > 1.
    - Rows of one id with different texts are different documents: a result row each.
    - Null ids: a group's keep_id is null only if all its ids are; such a row is the one kept.
    - Other columns are ignored. An empty table gives an empty result.
    """
    text = F.coalesce(F.col("_text"), F.lit(""))
    rows = named_ids(docs, id_col, text_col).select(
        "_id", text.alias("_text"), F.octet_length(text).alias("n_bytes"),
        F.xxhash64(F.substring(text, 1, PREFIX_CHARS)).alias("prefix_hash"))
    key = ["n_bytes", "prefix_hash"]

    # Rounds 1 and 2 on pre-aggregated keys: lengths that occur twice, then prefixes that do.
    by_prefix = rows.groupBy(*key).agg(F.count("*").alias("n"))
    by_length = by_prefix.groupBy("n_bytes").agg(F.sum("n").alias("rows")).where("rows > 1").select("n_bytes")
    surviving = cut(by_prefix.where("n > 1").join(by_length, "n_bytes", "left_semi").select(*key), "dedup-keys")

    alone = rows.select("_id", *key).join(surviving, key, "left_anti").select(
        "_id", F.lit(1).cast("long").alias("copies"), *key, F.lit(None).cast("string").alias("full_hash"),
        F.col("_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))

    # Round 3: whole content of surviving groups only.
    bits = surviving.select(_position(*key).alias("p")).groupBy(
        F.expr(f"p div {_BLOCK_BITS}").alias("block")).agg(
        F.bitmap_construct_agg(F.expr(f"p % {_BLOCK_BITS}")).alias("bits"))
    candidates = (
        rows.withColumn("p", _position(*key))
        .join(F.broadcast(bits), F.expr(f"p div {_BLOCK_BITS}") == F.col("block"))  # at most BITMAP_BITS / 8 bytes
        .where(_bit_is_set(F.col("bits"), F.col("p")))
        .select("_id", "_text", *key))
    members = cut(
        candidates.join(surviving, key, "left_semi")
        .select("_id", *key, F.sha2("_text", 256).alias("full_hash"))
        .groupBy("_id", *key, "full_hash").agg(F.count("*").alias("copies")), "dedup-members")
    group = [*key, "full_hash"]
    groups = measured(members.groupBy(*group).agg(F.max("_id").alias("keep_id"), F.sum("copies").alias("group_size")),
                      "dedup-groups", F.lit(112))
    hashed = members.join(groups, group).select("_id", "copies", *group, "keep_id", "group_size")

    return alone.unionByName(hashed).select(
        F.col("_id").alias("doc_id"), "keep_id", "group_size", F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "copies", *key, "full_hash")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of identical texts, all columns unchanged.

    Which one: see ``exact_groups``; of rows that repeat id and text (null and empty text being the
    same), any one.
    """
    kept = cut(exact_groups(docs, id_col, text_col).where("kept").select(
        F.col("doc_id").alias("keep"), "copies", "n_bytes", "prefix_hash", "full_hash"), "dedup-kept")
    text = F.coalesce(docs[text_col], F.lit(""))

    def rows_of(side: DataFrame) -> DataFrame:
        # an id may have several texts, of which some stay
        return docs.join(side, docs[id_col].eqNullSafe(side["keep"]) & (F.octet_length(text) == side["n_bytes"])
                         & (F.xxhash64(F.substring(text, 1, PREFIX_CHARS)) == side["prefix_hash"])
                         & (side["full_hash"].isNull() | (F.sha2(text, 256) == side["full_hash"])), "left_semi")

    once = rows_of(kept.where("copies = 1"))
    repeated = rows_of(measured(kept.where("copies > 1"), "dedup-repeated", F.lit(128)))
    same = free_name(docs, "_same")
    return once.unionByName(repeated.withColumn(same, F.coalesce(F.col(text_col), F.lit("")))
                            .dropDuplicates([id_col, same]).drop(same))
