"""Mixing sources to target weights by Pareto order sampling.

Each source's target share fixes how often its documents are taken on average. What is certain is
allotted as whole copies; for the rest every document has an inclusion probability, and documents
are ranked by their random odds divided by their inclusion odds, u/(1-u) : p/(1-p). The first ones
in that order make the sample. Its size is fixed in words, the unit of the targets: documents enter
in rank order while they bring the source's words nearer to its target.

The order is not sorted as a whole: ranks fall into buckets of which only words are summed, and
only the documents of the one bucket that a source's target falls into are sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, free_name, measured, word_count

MAX_COPIES = 3
WEIGHTS = (1, 2, 3)
SEED = 11
BUCKETS = 8192

#: How far a document's expected copies may lie from its source's mean: longer ones are likelier.
TILT = 0.5


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """(source, source_size, target) from one row per source with its size.

    Sources in code-point order, null last, have the weights in turn. All sizes together are shared
    by weight; a target stops at ``max_copies`` times the source's size, and the excess goes to the
    others by weight until none is above. The one level at which shares below their stop meet the
    rest of the total is found on running sums over sources in the order of stop / weight.
    """
    numbered = sizes.withColumn("i", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("i") - 1) % len(weights) + 1)
    stops = numbered.select("source", "source_size", weight.cast("long").alias("weight"),
                            (F.col("source_size") * max_copies).alias("stop"), "i")
    order = Window.orderBy(F.col("stop") / F.col("weight"), "i")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    rest = F.sum("source_size").over(whole) - F.coalesce(F.sum("stop").over(before), F.lit(0))
    open_weight = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = stops.withColumn("level", rest / open_weight)
    # the first source in this order whose stop is not reached sets the level for all that follow
    reached = F.min(F.when(F.col("level") * F.col("weight") <= F.col("stop"), F.struct("i2", "level"))).over(whole)
    ranked = level.withColumn("i2", F.row_number().over(order)).withColumn("first", reached)
    share = F.when(F.col("first").isNull() | (F.col("i2") < F.col("first.i2")), F.col("stop").cast("double")).otherwise(
        F.col("first.level") * F.col("weight"))
    return ranked.select("source", "source_size", share.alias("target"))


def uniform(*cols: Column, seed: int = SEED) -> Column:
    """A number strictly between 0 and 1 from the columns' values, the same on every run."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("null")) for c in cols]))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES, seed: int = SEED, tilt: float = TILT) -> DataFrame:
    """How often each row is taken: one row per input row.

    doc_id, source, text_hash (MD5), size (words), source_size, target (its source's, in words), copies
    (0 to ``max_copies``), taken (size x copies).

    - A null text has size 0; a text without words is taken ``floor(target / source_size)`` times
      (0 where the source has no words at all).
    - A null source is a source like any other, last in order.
    - Repeated rows (same id and text) draw the same random number and rank side by side; which of
      them a cut between them takes makes no difference to the rows taken. Null ids draw by text.
    - An empty table gives an empty result. Other columns are ignored.
    """
    rows = docs.select(
        F.col(id_col).alias("_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
        F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("hash"))
    rows = cut(rows, "mix-sizes")
    sums = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.sum(F.col("size").cast("double") * F.col("size")).alias("squares"),
        F.min("size").alias("shortest"), F.max("size").alias("longest"))
    targets = source_targets(sums.select("source", "source_size"), weights, max_copies)
    # Expected copies: the source's mean, tilted by size so that expected words are the same. Sum over a
    # source of size x (size - centre) is 0 for centre = squares / source_size.
    centre = F.col("squares") / F.col("source_size")
    reach = F.greatest(F.col("longest") - centre, centre - F.col("shortest"))
    mean = F.col("target") / F.col("source_size")
    slope = F.when(reach > 0, F.lit(tilt) * F.least(mean, max_copies - mean) / reach).otherwise(0.0)
    plan = (
        sums.alias("s").join(targets.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source")))
        .select("s.source", "s.source_size", "target", "squares", "longest", "shortest")
        .withColumn("mean", F.when(F.col("source_size") > 0, F.least(mean, F.lit(float(max_copies)))).otherwise(0.0))
        .withColumn("centre", F.when(F.col("source_size") > 0, centre).otherwise(0.0))
        .withColumn("slope", F.when(F.col("source_size") > 0, F.greatest(slope, F.lit(0.0))).otherwise(0.0))
        .select("source", "source_size", "target", "mean", "centre", "slope"))
    plan = measured(plan, "mix-plan", F.lit(64) + F.coalesce(F.octet_length("source"), F.lit(0)))

    p = F.col("expected") - F.col("certain")
    u = uniform(F.col("_id"), F.col("hash"), seed=seed)
    # Pareto rank, odds(u) / odds(p), brought to 0..1; p = 0 is never sampled
    odds = (u / (1 - u)) * ((1 - p) / p)
    drawn = (
        rows.alias("r").join(plan.alias("p"), F.col("r.source").eqNullSafe(F.col("p.source")))
        .select("r.*", "source_size", "target", "mean", "centre", "slope")
        .withColumn("expected", F.greatest(F.lit(0.0), F.least(
            F.lit(float(max_copies)), F.col("mean") + F.col("slope") * (F.col("size") - F.col("centre")))))
        .withColumn("certain", F.floor("expected"))
        .withColumn("rank", F.when((p > 0) & (F.col("size") > 0), odds / (1 + odds)))
        .withColumn("bucket", F.floor(F.col("rank") * BUCKETS))
        .select("_id", "source", "size", "hash", "source_size", "target", "certain", "rank", "bucket"))

    # Words wanted beyond the certain copies, and where in the order they are reached.
    buckets = drawn.groupBy("source", "bucket").agg(
        F.sum(F.when(F.col("rank").isNotNull(), F.col("size")).otherwise(0)).alias("words"),
        F.sum(F.col("size") * F.col("certain")).alias("sure"), F.first("target").alias("target"))
    of_source = Window.partitionBy("source")
    upto = of_source.orderBy(F.col("bucket").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    reached = (
        buckets.withColumn("wanted", F.col("target") - F.sum("sure").over(of_source))
        .withColumn("upto", F.sum("words").over(upto))
        .where((F.col("bucket").isNotNull()) & (F.col("upto") >= F.col("wanted")))
        .groupBy("source").agg(F.min("bucket").alias("last"), F.min_by("upto", "bucket").alias("upto"),
                               F.min_by("words", "bucket").alias("words"), F.first("wanted").alias("wanted"))
        .select("source", "last", (F.col("wanted") - (F.col("upto") - F.col("words"))).alias("left")))
    reached = measured(reached, "mix-reached", F.lit(40) + F.coalesce(F.octet_length("source"), F.lit(0)))

    placed = drawn.alias("d").join(reached.alias("c"), F.col("d.source").eqNullSafe(F.col("c.source")), "left").select(
        "d.*", "last", "left")
    at = F.col("bucket") == F.col("last")
    plain = placed.where(~F.coalesce(at, F.lit(False))).withColumn(
        "more", (F.col("rank").isNotNull() & (F.col("last").isNull() | (F.col("bucket") < F.col("last")))).cast("long"))
    in_order = Window.partitionBy("source").orderBy("rank", "_id", "hash").rowsBetween(Window.unboundedPreceding, -1)
    # at the border a document enters if at least half of it is still wanted
    border = placed.where(at).withColumn("sofar", F.coalesce(F.sum("size").over(in_order), F.lit(0))).withColumn(
        "more", (F.col("sofar") + F.col("size") / 2 <= F.col("left")).cast("long")).drop("sofar")
    copies = F.col("certain") + F.col("more")
    return plain.unionByName(border).select(
        F.col("_id").alias("doc_id"), "source", F.col("hash").alias("text_hash"), "size", "source_size", "target",
        copies.alias("copies"), (F.col("size") * copies).alias("taken"))


def apply_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """``docs`` with each row as often as ``mix`` takes it (0 to 3 times), all columns unchanged.

    Rows are matched by id, source and text hash. Rows equal in all three share the copies of their
    group evenly, the odd ones going to any of them.
    """
    taken = mix(docs, id_col, text_col, source_col, **options)
    taken = taken.groupBy("doc_id", "source", "text_hash").agg(F.sum("copies").alias("copies"), F.count("*").alias("rows"))
    taken = cut(taken.where("copies > 0"), "mix-taken")
    match = (docs[id_col].eqNullSafe(taken["doc_id"]) & docs[source_col].eqNullSafe(taken["source"])
             & (F.md5(F.coalesce(docs[text_col], F.lit(""))) == taken["text_hash"]))
    copies = free_name(docs, "_copies")

    def times(side: DataFrame, count: Column) -> DataFrame:
        found = docs.join(side, match).select(*[docs[c] for c in docs.columns], count.alias(copies))
        return found.withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies)))).drop(copies)

    single = times(taken.where("rows = 1"), taken["copies"])
    # repeated rows: as many of each group as it has copies
    several = measured(taken.where("rows > 1"), "mix-several", F.lit(128))
    n, first = free_name(docs, "_n"), free_name(docs, "_h")
    one = docs.join(several, docs[id_col].eqNullSafe(several["doc_id"]) & docs[source_col].eqNullSafe(several["source"])
                    & (F.md5(F.coalesce(docs[text_col], F.lit(""))) == several["text_hash"])).select(
        *[docs[c] for c in docs.columns], several["copies"].alias(n), several["text_hash"].alias(first))
    one = one.dropDuplicates([id_col, source_col, first]).withColumn(
        n, F.explode(F.sequence(F.lit(1).cast("long"), F.col(n)))).drop(n, first)
    return single.unionByName(one)
