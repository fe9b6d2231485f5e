"""Line deduplication with a log-template tree of fixed depth.

A line's place in the tree is its token count and its leading tokens, with variable fields (tokens
with a digit) replaced by a wildcard. Under one such leaf, lines with equal tokens make a template.
Templates are generalised: of each, the tokens that most documents of the leaf have in that position
stay, as many as the similarity asks for (and those as frequent as the last of them), the others become
wildcards too. As tokens are ranked, not held against a fixed count, a field with many values is a
wildcard however large the corpus is. Lines whose template, as it is or generalised, occurs in enough
documents are dropped. Lines of too few tokens for a template count by exact equality. Long lines that
fewer documents share word for word are dropped but for the first.

A first pass over the texts makes only a few hashes of each line: of its place as far as its leading
tokens tell it, and of the whole line if it may be a long passage. A second one takes up the lines whose
place enough documents share, or whose passage two do, and only those are ever cut into tokens. What
comes after works on these lines, and once for each distinct template.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD_SEPARATORS, cut, measured

MIN_DOCS = 10
MIN_TOKENS = 3
LONG_WORDS = 50
DEPTH = 3
SIMILARITY = 0.6
WILDCARD = "<*>"

_SPACE = " \t\n\x0b\x0c\r"
_NO_SPACES = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"


def _words(line: Column) -> Column:
    """The line's words; in scripts without spaces every character is one."""
    return F.size(F.split(F.btrim(line, F.lit(_SPACE)), WORD_SEPARATORS)) + F.regexp_count(line, F.lit(_NO_SPACES))


def _short_place(normal: Column) -> Column:
    return F.xxhash64(F.lit("short"), normal)


def _lines(rows: DataFrame, min_tokens: int, depth: int, long_words: int) -> DataFrame:
    """(id, h, pos, line, normal, short, place, passage) of all lines.

    ``normal`` has single spaces between tokens; ``place`` is a hash of the leading tokens (of a short
    line, of all), which lines of one leaf share; ``passage`` a hash of the line, null if it is too short for one.
    """
    line, normal = F.col("line"), F.col("normal")
    odd = F.startswith(line, F.lit(" ")) | F.endswith(line, F.lit(" "))
    for mark in ("  ", *"\t\x0b\x0c\r"):  # string searches: a pattern takes ten times as long
        odd = odd | F.contains(line, F.lit(mark))
    found = rows.select("id", "h", F.posexplode(F.split("text", "\n")).alias("pos", "line")).select(
        "*", F.when(odd, F.btrim(F.regexp_replace(line, WORD_SEPARATORS, " "), F.lit(" "))).otherwise(line).alias("normal"))
    start = F.substring_index(normal, " ", depth)
    masked = F.when(start.rlike("[0-9]"), F.regexp_replace(start, "[^ ]*[0-9][^ ]*", WILDCARD)).otherwise(start)
    short = F.substring_index(normal, " ", min_tokens - 1) == normal
    n = F.length(line)
    # without characters of more than one byte, so many words need as many spaces
    may_be_long = (n > long_words) & ((F.octet_length(line) > n) | (n > 2 * long_words))
    return found.select("*", short.alias("short"), F.when(short, _short_place(normal)).otherwise(F.xxhash64(masked)).alias("place"),
                        F.when(may_be_long, F.xxhash64(F.when(odd, F.btrim(line, F.lit(_SPACE))).otherwise(line))).alias("passage"))


def _tokens(normal: Column) -> Column:
    """The line's tokens; those with a digit as wildcards (few lines have any)."""
    tokens = F.split(normal, " ")
    return F.when(normal.rlike("[0-9]"), F.transform(tokens, lambda w: F.when(w.rlike("[0-9]"), F.lit(WILDCARD)).otherwise(w))).otherwise(tokens)


def candidates(rows: DataFrame, min_docs: int, min_tokens: int, depth: int, long_words: int) -> DataFrame:
    """The lines of ``_lines`` that may go, with ``busy`` (enough documents share the place) and ``first``
    (where a passage of two documents or more is first: by id, text hash and position)."""
    lines = _lines(rows, min_tokens, depth, long_words)
    places = cut(lines.select("id", "h", "pos", "place", "passage"), "line-places")
    # each document counts once, whatever number of its lines (or repeated rows) have the place
    lines_with_words = places.where(F.col("place") != _short_place(F.lit("")))
    busy = lines_with_words.select("place", "id", "h").distinct().groupBy("place").agg(F.count("*").alias("n")).where(
        F.col("n") >= min_docs).select("place", F.lit(True).alias("busy"))
    document = F.struct("id", "h")
    shared = places.where("passage is not null").groupBy("passage").agg(
        F.min(F.struct("id", "h", "pos")).alias("first"), F.min(document).alias("least"), F.max(document).alias("most")).where(
        ~F.col("least").eqNullSafe(F.col("most"))).select("passage", "first")
    return cut(lines.join(measured(busy, "line-busy", F.lit(16)), "place", "left").join(
        measured(shared, "line-shared", F.lit(40)), "passage", "left").where("busy or first is not null"), "line-candidates")


def recurring_lines(rows: DataFrame, min_docs: int, min_tokens: int, depth: int, similarity: float, long_words: int) -> DataFrame:
    """(id, h, positions): the lines to drop of each text, from (id, h, text) rows."""
    found = candidates(rows, min_docs, min_tokens, depth, long_words)
    tokens = F.when(~F.col("short"), _tokens(F.col("normal")))
    placed = found.where("busy").select("id", "h", "pos", "short", "place", "normal", tokens.alias("tokens")).select(
        "id", "h", "pos", "tokens",
        F.when(F.col("short"), F.col("place")).otherwise(F.xxhash64(F.size("tokens"), F.slice("tokens", 1, depth))).alias("leaf"),
        F.when(F.col("short"), F.xxhash64("normal")).otherwise(F.xxhash64("tokens")).alias("template"))
    placed = cut(placed, "line-placed")
    in_docs = cut(placed.select("leaf", "template", "id", "h").distinct(), "line-docs")
    busy = in_docs.select("leaf", "id", "h").distinct().groupBy("leaf").agg(F.count("*").alias("docs")).where(
        F.col("docs") >= min_docs).select("leaf")
    templates = in_docs.join(measured(busy, "line-leaves", F.lit(16)), "leaf", "left_semi").groupBy("leaf", "template").agg(
        F.count("*").alias("docs"))
    templates = cut(templates, "line-templates")
    own = templates.where(F.col("docs") >= min_docs).select("leaf", "template")

    # Constant tokens are those that min_docs documents of the leaf have there; of each template the
    # most frequent of them, as many as the similarity asks for.
    spelled = placed.where("tokens is not null").groupBy("leaf", "template").agg(F.first("tokens").alias("tokens"))
    spelled = cut(spelled.join(templates, ["leaf", "template"]), "line-tokens")
    at = spelled.select("leaf", "template", "docs", F.posexplode("tokens").alias("at", "token"))
    constant = at.where(F.col("token") != WILDCARD).groupBy("leaf", "at", "token").agg(F.sum("docs").alias("n")).where(
        F.col("n") >= min_docs).select("leaf", "at", "token", "n")
    known = at.join(constant, ["leaf", "at", "token"]).groupBy("leaf", "template").agg(
        F.array_sort(F.collect_list(F.struct("at", "token", "n"))).alias("constant"))
    known = known.join(spelled.select("leaf", "template", F.size("tokens").alias("size")), ["leaf", "template"]).where(
        F.size("constant") >= F.col("size") * similarity)
    last = F.get(F.sort_array("constant.n", asc=False), F.ceil(F.col("size") * similarity).cast("int") - 1)
    known = known.withColumn("last", last).withColumn("constant", F.filter("constant", lambda c: c["n"] >= F.col("last")))
    general = known.select("leaf", "template", F.xxhash64(F.to_json(F.transform(
        "constant", lambda c: F.struct(c["at"].alias("at"), c["token"].alias("token"))))).alias("general"))
    general = measured(general, "line-general", F.lit(32))
    wide = in_docs.join(general, ["leaf", "template"]).select("leaf", "general", "id", "h").distinct().groupBy("leaf", "general").agg(
        F.count("*").alias("docs")).where(F.col("docs") >= min_docs)
    generalised = general.join(wide, ["leaf", "general"]).select("leaf", "template")

    recurring = measured(own.unionByName(generalised), "line-recurring", F.lit(24))
    gone = placed.join(recurring, ["leaf", "template"], "left_semi").select("id", "h", "pos")
    repeated = found.where(F.col("first").isNotNull() & ~F.struct("id", "h", "pos").eqNullSafe(F.col("first"))).where(
        _words(F.col("line")) > long_words).select("id", "h", "pos")
    return gone.unionByName(repeated).groupBy("id", "h").agg(F.collect_set("pos").alias("positions"))


def drop_recurring(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS,
                   min_tokens: int = MIN_TOKENS, depth: int = DEPTH, similarity: float = SIMILARITY,
                   long_words: int = LONG_WORDS) -> DataFrame:
    """(doc_id, text, n_lines, dropped): every row's text without its recurring lines.

    - A line of fewer than ``min_tokens`` words counts by exact equality, digits included. A blank line is
      never dropped.
    - A variable field keeps its value if more documents of the leaf have that value there than have the
      line's own fixed words; such lines group by the value too.
    - A line of over ``long_words`` words that two documents or more share word for word stays in the
      first of them only (by id and text hash), or in none if its template recurs. In scripts without
      spaces every character counts as a word. Of shorter lines those in fewer than ``min_docs``
      documents stay.
    - A null text stays null and counts no lines; an empty one has one empty line.
    - Rows that repeat id and text count as one document; each has its result row. Null ids count like
      any other id.
    - Other columns are ignored. An empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    found = recurring_lines(rows, min_docs, min_tokens, depth, similarity, long_words).withColumnsRenamed({"id": "id_", "h": "h_"})
    found = measured(found, "line-gone", F.lit(24) + 4 * F.size("positions"))
    lines = F.split("text", "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("positions"))
    return rows.join(found, F.col("id").eqNullSafe(F.col("id_")) & (F.col("h") == F.col("h_")), "left").select(
        F.col("id").alias("doc_id"),
        F.when(F.col("positions").isNull(), F.col("text")).otherwise(
            F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")).alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.coalesce(F.size("positions"), F.lit(0)).cast("long").alias("dropped"))
