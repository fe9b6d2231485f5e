"""Queries of the corpus operators, each over its whole tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import (bpe, chat_format, exact_dedup, hard_negatives, html_extract, language_id, line_dedup, merkle, mixing,
                          simhash, spelling, toxicity, url_filter)
from tidemark.llm.common import table


#: The listed rules of op1: host and path, verdict.
URL_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed rules, then mined ones, on every page's url.

    The number that a url's path ends in names the document that the page shows; a url is labelled bad
    if that document's labels say toxic or low quality.
    """
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    bad = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("bad"))
    shown = F.try_to_number(F.regexp_extract(url_filter.path_of(F.col("url")), r"([0-9]{1,18})[^0-9]*$", 1), F.lit("9" * 18)).cast("long")
    labelled = pages.select("url", shown.alias("doc_id")).join(bad, "doc_id").select("url", "bad")
    return url_filter.judge(pages, URL_RULES, labelled)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the mix takes each document: equal budget, sources weighted 1, 2, 3 in turn."""
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "source_size", "target", "taken", "size", F.col("copies").cast("long").alias("copies"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which document of each group of identical texts stays."""
    docs = table(spark, sf_dir, "documents")
    groups = exact_dedup.exact_groups(docs)
    # Texts told apart by length or prefix have not been hashed; the contract wants all hashes.
    text = F.coalesce(docs["text"], F.lit(""))
    hashes = docs.select(
        F.col("doc_id").alias("id"), F.octet_length(text).alias("n"),
        F.xxhash64(F.substring(text, 1, exact_dedup.PREFIX_CHARS)).alias("p"), F.sha2(text, 256).alias("text_sha256"))
    alone = groups.where("full_hash is null")
    match = alone["doc_id"].eqNullSafe(hashes["id"]) & (alone["n_bytes"] == hashes["n"]) & (alone["prefix_hash"] == hashes["p"])
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    # rows that repeat id and text are documents too
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return alone.join(hashes, match).select(*columns).unionByName(
        groups.where("full_hash is not null").withColumn("text_sha256", F.col("full_hash")).select(*columns, each).select(*columns))


def op4_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle fingerprints of every document, its edited text, and how alike they and the next are."""
    return merkle.compare_with_next(table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints over 3-word shingles and components of those within 3 bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; a third of them is held out of training."""
    docs = table(spark, sf_dir, "documents")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3))
    network = language_id.fit(docs, train=fold != 1)
    found = language_id.identify(docs.select("doc_id", "text"), network)
    return found.select("doc_id", F.coalesce(fold == 1, F.lit(False)).alias("held_out"), "language.lang_pred", "language.score")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document's encoding, and of the text it decodes to."""
    ids = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"))
    back = bpe.decode(ids, digest_col="ids_sha256")
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids_sha256",
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without lines whose template recurs in ten documents or more, and without the
    later copies of long lines."""
    return line_dedup.drop_recurring(table(spark, sf_dir, "documents"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, from its host's winning path."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    texts = html_extract.extract(pages, url_filter.host_of(F.col("url")))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; a fifth of the labels is held out of training."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))
    model = toxicity.fit(docs, labels, train=fold != 0)
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, with misspellings put in, their near words and the forms they may stand for."""
    return spelling.variants(table(spark, sf_dir, "documents"), slip_every=31)


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation rebuilt from its event log, rendered, and read back from the rendered text.

    Assistant turns come as streamed deltas. Conversation -1 holds the template's own marks.
    """
    marks = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", marks), (-1, 1, "assistant", marks)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    read = chat_format.read_back(chat_format.render(chat_format.reconstruct(chat_format.events_of(turns))))
    said = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit("\n"), m["text"], F.lit("\n"))), "")
    learned = F.array_join("messages.loss", "")  # null where the mask covers nothing, which array_join leaves out
    return read.select("conv_id", F.size("messages").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.length(learned).cast("long").alias("loss_chars"), F.sha2(learned, 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five hard negatives for each of the five positives of every hundredth vector."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", label), anchor=F.col("vec_id") % 100 == 0)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline over documents."""
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_url_filter, op2_mixing, op3_exact_dedup, op4_merkle, op5_simhash, op6_language_id, op7_bpe, op8_line_dedup,
              op9_html_extraction, op10_toxicity, op11_spelling_variants, op12_chat_format, op13_hard_negatives, pipeline)
}

ORACLE: dict[str, str] = {
    "op2_mixing": f"""
        WITH r AS (
          SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
                 md5(coalesce(text, '')) AS hash FROM documents),
        s AS (
          SELECT source, sum(size)::BIGINT AS source_size, sum(size::DOUBLE * size) AS squares, min(size) AS shortest,
                 max(size) AS longest FROM r GROUP BY source),
        n AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS i, source_size * {mixing.MAX_COPIES} AS stop FROM s),
        w AS (SELECT *, list_extract({list(mixing.WEIGHTS)}, (i - 1) % {len(mixing.WEIGHTS)} + 1) AS weight FROM n),
        l AS (
          SELECT *, row_number() OVER (ORDER BY stop / weight, i) AS i2,
                 (sum(source_size) OVER () - coalesce(sum(stop) OVER b, 0))::DOUBLE
                 / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
          FROM w WINDOW b AS (ORDER BY stop / weight, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        f AS (SELECT min(i2) AS first, arg_min(level, i2) AS reached FROM l WHERE level * weight <= stop),
        t AS (SELECT l.*, CASE WHEN first IS NULL OR i2 < first THEN stop::DOUBLE ELSE reached * weight END AS target FROM l, f),
        m AS (
          SELECT source, source_size, target, squares / source_size AS centre, target / source_size AS mean,
                 greatest(longest - squares / source_size, squares / source_size - shortest) AS reach FROM t),
        e AS (
          SELECT r.*, m.source_size, m.target, CASE WHEN m.source_size > 0 THEN greatest(0.0::DOUBLE, least({mixing.MAX_COPIES}::DOUBLE,
                   least(mean, {mixing.MAX_COPIES}::DOUBLE) + CASE WHEN reach > 0 THEN greatest(
                     {mixing.TILT}::DOUBLE * least(mean, {mixing.MAX_COPIES} - mean) / reach, 0.0::DOUBLE) ELSE 0.0::DOUBLE END
                   * (size - centre))) ELSE 0.0::DOUBLE END AS expected
          FROM r JOIN m ON r.source IS NOT DISTINCT FROM m.source),
        u AS (
          SELECT *, floor(expected)::BIGINT AS certain, expected - floor(expected) AS p,
                 (('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, 'null') || ':' || hash), 1, 12))::BIGINT::DOUBLE
                  + 0.5::DOUBLE) / {1 << 48}::DOUBLE AS u FROM e),
        o AS (SELECT *, CASE WHEN p > 0 AND size > 0 THEN (u / (1 - u)) * ((1 - p) / p) END AS odds FROM u),
        k AS (
          SELECT *, target - sum(size * certain) OVER (PARTITION BY source) AS wanted, CASE WHEN odds IS NOT NULL THEN coalesce(
                   sum(CASE WHEN odds IS NOT NULL THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY odds / (1 + odds) NULLS LAST,
                     doc_id NULLS FIRST, hash ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) END AS sofar FROM o),
        c AS (SELECT *, certain + CASE WHEN sofar + size / 2 <= wanted THEN 1 ELSE 0 END AS copies FROM k)
        SELECT doc_id, source_size, target, (size * copies)::BIGINT AS taken, size, copies::BIGINT AS copies FROM c""",
    "op8_line_dedup": f"""
        WITH l AS (
          SELECT doc_id, text, md5(text) AS h, unnest(string_split(text, chr(10))) AS line,
                 generate_subscripts(string_split(text, chr(10)), 1) AS pos
          FROM (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL)),
        t AS (
          SELECT doc_id, h, pos, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS line FROM l),
        w AS (SELECT *, string_split_regex(line, '[\\x20\\x09-\\x0D]+') AS words FROM t WHERE line <> ''),
        placed AS (
          SELECT doc_id, h, pos, line, words, len(words) < {line_dedup.MIN_TOKENS} AS short,
                 CASE WHEN len(words) < {line_dedup.MIN_TOKENS} THEN words
                      ELSE list_transform(words, lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END) END AS template,
                 struct_pack(n := len(words), lead := template[1:{line_dedup.DEPTH}]) AS leaf FROM w),
        in_docs AS (SELECT DISTINCT leaf, template, short, doc_id, h FROM placed),
        busy AS (
          SELECT leaf FROM (SELECT DISTINCT leaf, doc_id, h FROM in_docs) GROUP BY leaf HAVING count(*) >= {line_dedup.MIN_DOCS}),
        templates AS (
          SELECT leaf, template, short, count(*) AS docs FROM in_docs WHERE leaf IN (SELECT leaf FROM busy) GROUP BY leaf, template, short),
        spelled AS (
          SELECT leaf, template, docs, unnest(template) AS token, generate_subscripts(template, 1) AS i FROM templates WHERE NOT short),
        constant AS (
          SELECT leaf, i, token, sum(docs) AS n FROM spelled WHERE token <> '<*>' GROUP BY leaf, i, token
          HAVING sum(docs) >= {line_dedup.MIN_DOCS}),
        known AS (
          SELECT leaf, template, list(struct_pack(i := i, token := token, n := n) ORDER BY i) AS c, list_reverse_sort(list(n)) AS ns,
                 len(template) * {line_dedup.SIMILARITY}::DOUBLE AS least
          FROM spelled JOIN constant USING (leaf, i, token) GROUP BY leaf, template),
        general AS (
          SELECT leaf, template, list_transform(list_filter(c, lambda x: x.n >= ns[ceil(least)::INT]),
                 lambda x: struct_pack(i := x.i, token := x.token)) AS general
          FROM known WHERE len(c) >= least),
        wide AS (
          SELECT leaf, general FROM (SELECT DISTINCT leaf, general, doc_id, h FROM in_docs JOIN general USING (leaf, template))
          GROUP BY leaf, general HAVING count(*) >= {line_dedup.MIN_DOCS}),
        recurring AS (
          SELECT leaf, template FROM templates WHERE docs >= {line_dedup.MIN_DOCS}
          UNION SELECT leaf, template FROM general JOIN wide USING (leaf, general)),
        long AS (
          SELECT doc_id, h, pos, row_number() OVER (PARTITION BY line ORDER BY doc_id NULLS FIRST, h, pos) AS nth,
                 dense_rank() OVER (PARTITION BY line ORDER BY doc_id NULLS FIRST, h)
                 + dense_rank() OVER (PARTITION BY line ORDER BY doc_id DESC NULLS LAST, h DESC) - 1 AS in_docs
          FROM placed
          WHERE len(words) + len(regexp_extract_all(line, '[\\p{{Han}}\\p{{Hiragana}}\\p{{Katakana}}\\p{{Thai}}\\p{{Lao}}\\p{{Khmer}}\\p{{Myanmar}}]'))
                > {line_dedup.LONG_WORDS}),
        gone AS (
          SELECT doc_id, h, pos FROM placed WHERE (leaf, template) IN (SELECT (leaf, template) FROM recurring)
          UNION SELECT doc_id, h, pos FROM long WHERE nth > 1 AND in_docs > 1),
        stay AS (
          SELECT l.doc_id, l.text, coalesce(string_agg(line, chr(10) ORDER BY l.pos) FILTER (WHERE gone.pos IS NULL), '') AS rest,
                 count(*) AS n_lines, count(gone.pos) AS dropped
          FROM l LEFT JOIN gone ON l.doc_id IS NOT DISTINCT FROM gone.doc_id AND l.h = gone.h AND l.pos = gone.pos
          GROUP BY l.doc_id, l.text)
        SELECT d.doc_id, s.rest AS text, coalesce(s.n_lines, 0) AS n_lines, coalesce(s.dropped, 0) AS dropped
        FROM documents d LEFT JOIN stay s ON d.doc_id IS NOT DISTINCT FROM s.doc_id AND d.text = s.text""",
    "op3_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
    "op12_chat_format": r"""
        WITH t AS (
          SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
          UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
        f AS (
          SELECT *, role = 'assistant' AS loss, length(CASE WHEN role = 'assistant' THEN '<s></s>' ELSE '[INST][/INST]' END)
                 + length(url_encode(role)) + 1 + length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g')) AS n FROM t)
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (loss), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (loss), '')) AS loss_sha256,
               sum(n)::BIGINT AS formatted_chars
        FROM f GROUP BY conv_id""",
    "op13_hard_negatives": """
        WITH r AS (
          SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                 list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
          FROM embeddings
          WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
          SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same, list_dot_product(a.v, r.v)::BIGINT AS score
          FROM r AS a, r WHERE a.vec_id % 100 = 0),
        p AS (
          SELECT anchor_id, id AS positive_id, score AS positive_score,
                 row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS i FROM s WHERE same AND id <> anchor_id),
        n AS (
          SELECT anchor_id, positive_id, id AS negative_id, positive_score, score AS negative_score,
                 row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS rank
          FROM p JOIN s USING (anchor_id)
          WHERE i <= 5 AND NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
        SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5""",
}
