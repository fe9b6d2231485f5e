"""Spelling variants by permuterm rotations.

A word gets a terminator and is rotated: from ``a x b`` come, among others, ``b $ a x`` and, of the word
``a b``, the whole rotation ``b $ a``. Sorted, all rotations that start with ``b $ a`` lie together: the
words that have one character in that place, and first the word that has none. So a word that differs
in one replaced, inserted or deleted character is found in the prefix range that skips this
character, and in no other: a replacement has one place, and of a run of equal characters, of
which any could be the inserted one, only the first is skipped.

A range holds a word for each character that can stand in the place, so it is bounded by the alphabet.
It is scanned in sorted order; what goes on is one row for each of its words (how many neighbours, and
the best one), never the pairs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, small_batches

#: What a word is made of (fixed by the operator's contract; A-Z are lower-cased).
LETTERS = "A-Za-zÀ-ÿ"
MIN_CHARS = 7
MIN_COUNT = 2
#: A form has to be this many times as frequent as the word.
FORM_RATIO = 10

#: Ends a word in its rotations; no word may hold it.
TERMINATOR = "\x00"

#: Distinct words that a task counts before it hands their counts on.
_FLUSH = 1 << 17


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                min_count: int = MIN_COUNT, slip_every: int | None = None) -> DataFrame:
    """(word, n): maximal runs of LETTERS in all texts, A-Z lower-cased, and how often they occur.

    ``slip_every`` puts in misspellings: with h the crc32 of ``<id>:<run>``, a run whose h it divides
    loses its code point h % length. Words of under ``min_chars`` code points or ``min_count``
    occurrences are left out.

    - A null text has no words; a null id is written as nothing. Rows that repeat count each time.
    - Whole texts are read, a match at a time. Other columns are ignored; an empty table has no words.
    """
    small_batches(docs.sparkSession)
    run = re.compile(f"[{LETTERS}]{{{min_chars},}}".replace("A-Z", ""))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["word", "n"])
            found.clear()
            return batch

        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                if not text.is_valid:
                    continue
                lowered = text.as_buffer().to_pybytes().lower().decode()  # of bytes, lower() takes A-Z only
                for word, n in Counter(m[0] for m in run.finditer(lowered)).items():
                    if slip_every:
                        h = zlib.crc32(f"{key.as_py()}:{word}".encode())
                        if h % slip_every == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1:]
                    if len(word) >= min_chars:
                        found[word] += n
                if len(found) >= _FLUSH:
                    yield out()
        yield out()

    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text"))
    counts = rows.mapInArrow(count, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, best) for every word that is near another: how many words differ from it by one
    inserted, deleted or replaced code point, and ``best`` of them, a struct of ``less`` (its n, negated)
    and ``near`` (the word): the one of largest n, ties by code points.

    ``words`` has distinct words and their n; none may hold the TERMINATOR (an error). Empty and null
    words have no neighbours.
    """
    rest = F.when(F.contains("word", F.lit(TERMINATOR)), F.raise_error(F.lit("a word holds the terminator"))).otherwise(F.col("word"))
    n_chars = F.length("word")
    # i in 0..length is the whole rotation from i on; -1..-length skips the character -i - 1
    turned = words.where(F.length("word") > 0).select(rest.alias("word"), "n").select("word", "n", F.explode(F.sequence(-n_chars, n_chars)).alias("i"))
    at = F.when(F.col("i") < 0, -F.col("i") - 1).otherwise(F.col("i"))
    start = F.when(F.col("i") < 0, -F.col("i") + 1).otherwise(F.col("i") + 1)
    rotations = turned.select(
        F.concat(F.col("word").substr(start, n_chars), F.lit(TERMINATOR), F.col("word").substr(F.lit(1), at)).alias("prefix"),
        F.when(F.col("i") < 0, F.col("word").substr(at + 1, F.lit(1))).otherwise("").alias("skipped"), "n")

    before, behind = F.substring_index("prefix", TERMINATOR, -1), F.substring_index("prefix", TERMINATOR, 1)
    word = F.concat(before, "skipped", behind)
    edited = F.col("skipped") != ""
    first_of_run = edited & ~F.endswith(before, F.col("skipped"))
    best = F.struct((-F.col("n")).alias("less"), word.alias("near"))
    # the words with a character in the place, best first, then the one without
    scan = Window.partitionBy("prefix").orderBy(F.desc(edited), F.desc("n"), "skipped").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    place = Window.partitionBy("prefix").orderBy(F.desc(edited), F.desc("n"), "skipped")
    scanned = rotations.select(
        word.alias("word"), edited.alias("edited"), first_of_run.alias("first_of_run"), F.row_number().over(place).alias("place"),
        F.sum(edited.cast("int")).over(scan).alias("replaced"), F.sum(first_of_run.cast("int")).over(scan).alias("inserted"),
        F.first(best).over(scan).alias("top"), F.nth_value(best, 2).over(scan).alias("second"),
        F.min(F.when(first_of_run, best)).over(scan).alias("longer"), F.min(F.when(~edited, best)).over(scan).alias("shorter"),
        F.count("*").over(scan).alias("size")).where("size > 1")
    other = F.when(F.col("replaced") > 1, F.when(F.col("place") == 1, F.col("second")).otherwise(F.col("top")))
    without = F.when(F.col("first_of_run"), F.col("shorter"))
    found = scanned.select(
        "word",
        F.when(F.col("edited"), F.col("replaced") - 1 + without.isNotNull().cast("int")).otherwise(F.col("inserted")).alias("n_near"),
        F.when(F.col("edited"), F.least(other, without)).otherwise(F.col("longer")).alias("best"))
    return found.where("n_near > 0").groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root): where each (word, form) link leads when forms are followed to the last.

    Links must not run in circles; those to ever more frequent words don't. Each round doubles the
    steps, so rounds are as many as the longest path's length has binary digits.
    """
    at = cut(links.select("word", F.col("form").alias("root")), "spelling-links")
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        moved = at.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root"), F.col("onward").isNotNull().alias("moved"))
        moved = cut(moved, "spelling-links")
        at = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return at


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
             min_count: int = MIN_COUNT, ratio: int = FORM_RATIO, slip_every: int | None = None) -> DataFrame:
    """(word, form, root, n, n_near, form_n): every word, its near words, and what it may be a variant of.

    A word's form is the near word of largest n (ties: the first by code points) if that n is ``ratio``
    times the word's at least; its root is the form's form and so on to the last, or the word itself.
    Which words there are, and what null, empty, repeated and very long inputs give: see ``word_counts``.
    """
    words = cut(word_counts(docs, id_col, text_col, min_chars, min_count, slip_every), "spelling-words")
    near = words.join(neighbours(words), "word", "left")
    form_n = -F.col("best.less")
    is_form = form_n >= F.col("n") * ratio
    formed = cut(near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                             F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, form_n).alias("form_n")), "spelling-forms")
    last = roots(formed.where("form is not null").select("word", "form"))
    return formed.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
