"""Document fingerprints: a Merkle tree over sections and paragraphs.

A text falls into sections (at blank lines), these into paragraphs (lines), sentences, and runs of a
few words, the leaves. Every node's digest is the MD5 of its children's digests, a leaf's that of its
text; so equal roots mean equal texts, and where roots differ, only branches with differing digests
need to be followed to the edits.

A fingerprint is the tree written out: the root's digest in full, then ``-`` and the sections, joined
by ``|``. A section is 16 digits of its digest, ``:`` and its paragraphs, joined by ``,``; a paragraph 16 digits
of its digest and, each behind a ``.``, 8 digits of each leaf's. Likeness is computed from two
fingerprints alone: equal branches count whole, differing ones are descended into.
All of it is built from string and array functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut

SECTION, PARAGRAPH = "\n\n", "\n"
# scripts without spaces: every character counts as a word (as ranges: looking up scripts is slow)
_CHARS = r"\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u2E80-\u9FFF\uF900-\uFAFF\x{20000}-\x{3FFFF}"
# with and without the marks and characters of those scripts: the same runs, but patterns of ASCII are faster
WIDE_MARKS = ("。", "！", "？")
SENTENCE, WIDE_SENTENCE = r"[^.!?]+[.!?]*|[.!?]+", r"[^.!?。！？]+[.!?。！？]*|[.!?。！？]+"
RUN, WIDE_RUN = r"(?:[^ ]{1,64} *){1,4}| +", rf"(?:(?:[{_CHARS}]|[^ {_CHARS}]{{1,64}}) *){{1,4}}| +"


def _all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _runs(paragraph: Column) -> Column:
    wide = F.lit(False)
    for mark in WIDE_MARKS:
        wide = wide | F.contains(paragraph, F.lit(mark))
    sentences = F.when(wide, _all(paragraph, WIDE_SENTENCE)).otherwise(_all(paragraph, SENTENCE))
    return F.flatten(F.transform(sentences, lambda s: F.when(
        F.octet_length(s) > F.length(s), _all(s, WIDE_RUN)).otherwise(_all(s, RUN))))


def _leaf_digests(text: Column) -> Column:
    """array (sections) of arrays (paragraphs) of arrays of leaf digests. Null is empty."""
    return F.transform(F.split(F.coalesce(text, F.lit("")), SECTION), lambda s: F.transform(
        F.split(s, PARAGRAPH), lambda p: F.transform(_runs(p), F.md5)))


def _branches(leaves: Column) -> Column:
    """array (sections) of struct(digest, written) from leaf digests."""
    def paragraph(own: Column) -> Column:
        digest = F.md5(F.array_join(own, ""))
        return F.struct(digest.alias("digest"), F.concat(
            F.substring(digest, 1, 16), F.array_join(F.transform(own, lambda x: F.concat(F.lit("."), F.substring(x, 1, 8))), "")).alias("written"))

    def section(own: Column) -> Column:
        digest = F.md5(F.array_join(own["digest"], ""))
        return F.struct(digest.alias("digest"), F.concat(F.substring(digest, 1, 16), F.lit(":"), F.array_join(own["written"], ",")).alias("written"))

    return F.transform(F.transform(leaves, lambda s: F.transform(s, paragraph)), section)


def _written(branches: Column) -> Column:
    return F.concat(F.md5(F.array_join(branches["digest"], "")), F.lit("-"), F.array_join(branches["written"], "|"))


def with_fingerprints(rows: DataFrame, **texts: Column) -> DataFrame:
    """``rows`` and a fingerprint column for each of ``texts`` (name and text)."""
    kept = rows.columns
    built = rows.select(*kept, *[_branches(_leaf_digests(t)).alias(f"_branches_{name}") for name, t in texts.items()])
    return built.select(*kept, *[_written(F.col(f"_branches_{name}")).alias(name) for name in texts])


def root(fingerprint: Column) -> Column:
    """32 hex digits; equal for equal texts only."""
    return F.substring(fingerprint, 1, 32)


def sections(fingerprint: Column) -> Column:
    return F.split(F.substring(fingerprint, F.lit(34), F.length(fingerprint)), "[|]")


def paragraphs(section: Column) -> Column:
    return F.split(F.substring(section, F.lit(18), F.length(section)), ",")


def leaves(paragraph: Column) -> Column:
    return F.slice(F.split(paragraph, "[.]"), 2, 1 << 30)


def _marks(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def _total(parts: Column, weight) -> Column:
    return F.aggregate(parts, F.lit(0), lambda a, x: a + weight(x))


def with_likeness(rows: DataFrame, **pairs: tuple[str, str]) -> DataFrame:
    """``rows`` and, for each name, the likeness (0 to 1) of two of its fingerprint columns.

    It is the Dice coefficient of the trees' distinct nodes, found from the root down: 1 if the roots are
    equal; sections that both have count with all that is below them; of the others, paragraphs
    that both have do; of the paragraphs left, the leaves are compared. The root counts too, so texts of
    equal parts in another order are less than 1 alike.
    """
    kept = rows.columns
    whole = lambda s: 2 + _marks(s, ",") + _marks(s, ".")  # noqa: E731  a section, its paragraphs and leaves
    of_paragraph = lambda p: 1 + _marks(p, ".")

    def level(frame: DataFrame, name: str, up: str, parts) -> DataFrame:
        """The distinct parts of both sides' branches, what both have, and what only one has."""
        a, b = (F.array_distinct(parts(F.col(f"_{name}_{up}_{side}"))) for side in "ab")
        frame = frame.withColumns({f"_{name}_a": a, f"_{name}_b": b})
        return frame.withColumn(f"_{name}_both", F.array_intersect(f"_{name}_a", f"_{name}_b"))

    out = rows
    for name, (left, right) in pairs.items():
        out = out.withColumns({f"_{name}_top_a": F.col(left), f"_{name}_top_b": F.col(right)})
        out = level(out, name, "top", sections).withColumnsRenamed({f"_{name}_{x}": f"_{name}_s_{x}" for x in ("a", "b", "both")})
        out = out.withColumns({f"_{name}_sx_{x}": F.array_except(f"_{name}_s_{x}", f"_{name}_s_both") for x in "ab"})
        below = lambda c: F.flatten(F.transform(c, paragraphs))
        out = level(out, name, "sx", below).withColumnsRenamed({f"_{name}_{x}": f"_{name}_p_{x}" for x in ("a", "b", "both")})
        out = out.withColumns({f"_{name}_px_{x}": F.array_except(f"_{name}_p_{x}", f"_{name}_p_both") for x in "ab"})
        out = level(out, name, "px", lambda c: F.flatten(F.transform(c, leaves)))
        both = (_total(F.col(f"_{name}_s_both"), whole) + _total(F.col(f"_{name}_p_both"), of_paragraph) + F.size(f"_{name}_both"))
        alone = lambda x: (1 + F.size(f"_{name}_sx_{x}") + F.size(f"_{name}_px_{x}") + F.size(f"_{name}_{x}") - F.size(f"_{name}_both"))  # noqa: E731, B023
        out = out.withColumn(name, F.when(root(F.col(left)) == root(F.col(right)), 1.0).otherwise(
            2.0 * both / (2 * both + alone("a") + alone("b"))))
        kept = [*kept, name]
        out = out.select(*kept)
    return out


def differing(a: Column, b: Column) -> Column:
    """Where two fingerprints differ: (section, paragraph) positions from 0, of differing sections only.
    A section or paragraph that one of them lacks counts as differing."""
    def places(x: Column, y: Column) -> Column:
        longer = F.greatest(F.coalesce(F.size(x), F.lit(0)), F.coalesce(F.size(y), F.lit(0)))
        return F.filter(F.sequence(F.lit(0), longer - 1), lambda i: ~F.get(x, i).eqNullSafe(F.get(y, i)))

    sa, sb = sections(a), sections(b)
    inside = lambda i: F.transform(
        places(paragraphs(F.get(sa, i)), paragraphs(F.get(sb, i))), lambda j: F.struct(i.alias("section"), j.alias("paragraph")))
    return F.when(root(a) == root(b), F.array().cast("array<struct<section:int,paragraph:int>>")).otherwise(
        F.flatten(F.transform(places(sa, sb), inside)))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every row, map side only.

    - Null and empty texts have one empty section with one empty paragraph.
    - Equal texts have equal fingerprints; repeated rows and null ids get a result row each. Other columns
      are ignored. A text of any length is read whole; its fingerprint has about two fifths of its length.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return with_fingerprints(rows, fingerprint=F.col("text")).select("doc_id", "fingerprint")


def next_ids(docs: DataFrame, id_col: str, measure: Column, parts: int | None = None) -> DataFrame:
    """(own, previous, previous_measure) of every distinct id, as struct(id): the next smaller id (null
    first; the largest for the smallest), and the largest ``measure`` of its rows.

    Ids are dealt by range and written once, so that order within a part and the edges between parts
    are seen alike. Only one row per part meets in one task.
    """
    spark = docs.sparkSession
    parts = parts or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select(F.struct(F.col(id_col).alias("id")).alias("own"), measure.alias("measure")).groupBy("own").agg(
        F.max("measure").alias("measure"))
    dealt = cut(ids.repartitionByRange(parts, "own").withColumn("part", F.spark_partition_id()), "ids")
    inside = Window.partitionBy("part").orderBy("own")
    before = F.lag(F.struct("own", "measure")).over(inside)
    edges = dealt.groupBy("part").agg(F.max_by(F.struct("own", "measure"), "own").alias("last"))
    around = Window.orderBy("part")
    edges = edges.select("part", F.coalesce(F.lag("last").over(around), F.max_by("last", "part").over(Window.partitionBy())).alias("edge"))
    found = dealt.withColumn("before", before).join(edges, "part").withColumn("before", F.coalesce("before", "edge"))
    return found.select("own", F.col("before.own").alias("previous"), F.col("before.measure").alias("previous_measure"))


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text against an edited version of itself and against the next document.

    The edited text has the last floor(n/4) code points replaced by the first as many (or all) of the
    next document in ascending id (after the last: the first). Returns doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next; one row per input row.

    - A null text counts as empty. Null ids come first in order.
    - Rows of one id have the same next document; if the next id has several rows, its smallest text.
    - A table with one id is its own next document. An empty table gives an empty result.
    - Texts of any length are read whole.
    """
    # a struct is never null, so one key serves for all joins and each row's text moves once
    rows = docs.select(F.struct(F.col(id_col).alias("id")).alias("own"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    quarter = F.expr("length(text) div 4").cast("int")
    order = next_ids(rows.select("own.id", "text"), "id", quarter)
    # every document sends its beginning and its fingerprint to the document before it
    sent = with_fingerprints(rows.join(order, "own"), next_print=F.col("text")).select(
        F.col("previous").alias("target"), F.substring("text", F.lit(1), F.col("previous_measure")).alias("start"),
        "next_print", F.xxhash64("text").alias("h"))
    sent = sent.groupBy("target").agg(F.min_by(F.struct("start", "next_print"), F.struct("start", "h")).alias("next"))
    n = F.length("text")
    edited = F.concat(F.substring("text", F.lit(1), n - quarter), F.substring("next.start", F.lit(1), quarter))
    met = rows.join(sent, F.col("own") == F.col("target")).select(
        "own.id", "text", edited.alias("edited"), n.cast("long").alias("n_chars"), F.col("next.next_print").alias("next_print"))
    printed = with_fingerprints(met.withColumn("edited_sha256", F.sha2("edited", 256)), fingerprint=F.col("text"), edited_fingerprint=F.col("edited"))
    columns = [F.col("id").alias("doc_id"), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint"]
    return with_likeness(printed.select(*columns, "next_print"), near_edited=("fingerprint", "edited_fingerprint"),
                         near_next=("fingerprint", "next_print")).drop("next_print")
