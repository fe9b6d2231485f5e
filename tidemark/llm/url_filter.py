"""URL filters from association rules.

FP-growth mines combinations of URL tokens that go with a bad label. Tokens that stand in exactly the
same URLs (a site's scheme, host and fixed query items) say the same: they are one item, or else k of
them would make 2^k item sets. Rules are pruned by support and confidence, and a rule is dropped if a more
general one is at least as confident. Matching goes by an inverted index: each rule is filed under its
rarest item, a URL looks up its own tokens, and the few rules found are checked in full; any token of an
item stands for it. Hand-written host and path rules come first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, measured

MIN_SUPPORT = 0.002
MIN_CONFIDENCE = 0.5
MIN_ROWS = 10
BAD = "label=block"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def listed_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null.

    A rule ``host/path`` fits its host and all subdomains if the path starts with the rule's path.
    """
    best = None
    for rule, verdict in sorted(rules, key=lambda r: (len(r[0]), r[0])):  # longest last, asked first
        of_host, slash, of_path = rule.partition("/")
        fits = ((host == of_host) | F.endswith(host, F.lit("." + of_host))) & F.startswith(path, F.lit(slash + of_path))
        answer = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict")))
        best = answer if best is None else F.coalesce(answer, best)
    return best


def tokens_of(url: Column) -> Column:
    """Distinct tokens of a URL: scheme, host labels and their words, top-level domain, path
    segments (numbers as #), file type, query items and fragment. Null has none."""
    host, path, rest = host_of(url), path_of(url), _rest(url)

    def marked(parts: Column, mark: str) -> Column:
        return F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(mark), x))

    segments = F.transform(F.split(path, "/"), lambda s: F.regexp_replace(F.regexp_replace(s, r"\.[A-Za-z0-9]+$", ""), r"[0-9]+", "#"))
    labels = F.split(host, r"\.")
    return F.array_distinct(F.filter(F.concat(
        marked(F.array(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1)), "scheme="),
        marked(F.slice(labels, -1, 1), "tld="),
        marked(F.slice(labels, 1, F.greatest(F.size(labels) - 1, F.lit(0))), "host="),
        marked(F.filter(F.split(host, r"[.-]"), lambda w: F.array_position(labels, w) == 0), "word="),
        marked(segments, "path="),
        marked(F.array(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1)), "type="),
        marked(F.split(F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1), "&"), "query="),
        marked(F.array(F.regexp_extract(rest, r"#(.*)$", 1)), "fragment="),
    ), lambda t: t.isNotNull()))


def _items(baskets: DataFrame) -> DataFrame:
    """(item, members): tokens that stand in exactly the same rows, and the first of them by name.

    Rows are told by their number and two 64-bit sums over row hashes.
    """
    of_rows = [F.bit_xor(F.xxhash64(F.lit(seed), "row")).alias(f"rows{seed}") for seed in (1, 2)]
    tokens = baskets.select("row", F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"), *of_rows)
    # members of one item share a URL, so their number is bounded by a URL's tokens
    return tokens.groupBy("n", "rows1", "rows2").agg(F.sort_array(F.collect_list("token")).alias("members")).select(
        F.col("members")[0].alias("item"), "members")


def mine(labelled: DataFrame, url_col: str = "url", bad_col: str = "bad", min_support: float = MIN_SUPPORT,
         min_confidence: float = MIN_CONFIDENCE, min_rows: int = MIN_ROWS) -> DataFrame:
    """Rules (items, members, confidence, support, rule) for bad URLs, from (url, bad) rows.

    Support is the share of labelled rows with all items and a bad label, confidence that among rows
    with all items; a rule also needs ``min_rows`` bad rows and more confidence than the share of bad rows
    overall. An item is named by the first of its tokens; ``members`` has all tokens of each item.
    Rows with a null url or label are ignored; without any bad row there is no rule. URLs of any
    length are read whole.
    """
    baskets = cut(labelled.where(F.col(url_col).isNotNull() & F.col(bad_col).isNotNull()).select(
        F.monotonically_increasing_id().alias("row"), tokens_of(F.col(url_col)).alias("tokens"), F.col(bad_col).cast("boolean").alias("bad")), "url-baskets")
    items = cut(_items(baskets), "url-items")
    n = baskets.where((F.size("tokens") > 0) | F.col("bad")).count()
    # the first token of each item stands for all of them, in the same rows
    kept = baskets.select("row", "bad", F.explode("tokens").alias("item")).join(
        measured(items.select("item"), "url-firsts", F.lit(16) + F.octet_length("item")), "item", "left_semi").groupBy("row", "bad").agg(
        F.collect_list("item").alias("tokens"))
    marked = kept.unionByName(baskets.where((F.size("tokens") == 0) & F.col("bad")).select("row", "bad", "tokens")).select(
        F.concat("tokens", F.when(F.col("bad"), F.array(F.lit(BAD))).otherwise(F.array().cast("array<string>"))).alias("items"))
    least = max(min_support, min_rows / max(min_rows, n))
    found = FPGrowth(itemsCol="items", minSupport=least, minConfidence=min_confidence).fit(marked).associationRules
    rules = cut(found.where((F.col("consequent") == F.array(F.lit(BAD))) & (F.col("lift") > 1)).select(
        F.array_sort("antecedent").alias("items"), "confidence", "support"), "url-rules")
    # Drop a rule if a part of its items alone is at least as confident.
    parts = rules.select(F.col("items").alias("part"), F.col("confidence").alias("part_confidence"))
    general = rules.select("items", "confidence", F.explode("items").alias("item")).join(
        parts.withColumn("item", F.col("part")[0]), "item").where(
        (F.size("part") < F.size("items")) & (F.size(F.array_except("part", "items")) == 0)
        & (F.col("part_confidence") >= F.col("confidence"))).select("items").distinct()
    left = rules.join(general, "items", "left_anti")
    spelled = left.select("items", F.explode("items").alias("item")).join(items, "item").groupBy("items").agg(
        F.sort_array(F.collect_list(F.struct("item", "members")))["members"].alias("members"))
    return left.join(spelled, "items").withColumn("rule", F.array_join("items", " & "))


def match(urls: DataFrame, rules: DataFrame, url_col: str = "url") -> DataFrame:
    """(url, mined_rule, confidence) of the distinct urls that a rule matches: the most confident
    rule, then the best supported one, then the first by name. A url has an item if it has one of its members."""
    index = rules.select("rule", "members", "confidence", "support")
    distinct = cut(urls.select(F.col(url_col).alias("url")).where(F.col("url").isNotNull()).distinct()
                   .withColumn("tokens", tokens_of(F.col("url"))), "url-tokens")
    often = distinct.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    spread = index.select("rule", F.posexplode("members").alias("at", "own")).select("rule", "at", "own", F.explode("own").alias("token"))
    rarest = spread.join(often, "token", "left").groupBy("rule", "at", "own").agg(F.sum(F.coalesce("n", F.lit(0))).alias("n")).groupBy(
        "rule").agg(F.min_by("own", F.struct("n", "at")).alias("own"))
    filed = index.join(rarest, "rule").select("rule", "members", "confidence", "support", F.explode("own").alias("token"))
    filed = measured(filed, "url-index", F.lit(64) + 3 * F.octet_length(F.to_json("members")))
    hits = distinct.select("url", "tokens", F.explode("tokens").alias("token")).join(filed, "token").where(
        F.forall("members", lambda own: F.arrays_overlap(own, F.col("tokens"))))
    return hits.groupBy("url").agg(F.max_by(F.struct("rule", "confidence"), F.struct("confidence", "support", "rule")).alias("best")).select(
        "url", F.col("best.rule").alias("mined_rule"), F.col("best.confidence").alias("confidence"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]], labelled: DataFrame, id_col: str = "page_id",
          url_col: str = "url", min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(page_id, host, path, rule, verdict, mined_rule, confidence), one row per input row.

    ``rules`` are pairs of ``host/path`` and a verdict; ``labelled`` has (url, bad). The verdict is
    that of the longest listed rule that fits; else ``block`` if a mined rule matches, else ``allow``.

    - A null url, or one without ``://``, has an empty host and path; it can only match mined rules
      on tokens that it has (a null url has none).
    - Repeated rows, null ids: a result row each. Empty tables: an empty result, or no mined rules.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).withColumns(
        {"host": host_of(F.col("url")), "path": path_of(F.col("url"))}).withColumn(
        "listed", listed_rule(F.col("host"), F.col("path"), rules))
    mined = match(rows.where(F.col("listed").isNull()).select("url"), mine(labelled, min_support=min_support, min_confidence=min_confidence))
    return rows.join(mined, "url", "left").select(
        "page_id", "host", "path", F.col("listed.rule").alias("rule"),
        F.coalesce("listed.verdict", F.when(F.col("mined_rule").isNotNull(), "block").otherwise("allow")).alias("verdict"),
        F.when(F.col("listed").isNull(), F.col("mined_rule")).alias("mined_rule"),
        F.when(F.col("listed").isNull(), F.col("confidence")).alias("confidence"))
