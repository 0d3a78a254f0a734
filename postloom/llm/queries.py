"""One query per operator, with production parameters, on its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.llm import collocations, hard_negatives, html, language, lattice, lines, minhash, mixing, multi_index, pieces, tokens, toxicity, urls
from postloom.llm.common import table


def op1_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"))


def op2_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Per document and sample its scores, the number and a digest of its ids, and the round trip."""
    found = pieces.encode(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "sample", F.size("ids").cast("long").alias("n_pieces"), F.hex(F.xxhash64("ids")).alias("ids_digest"),
        "log_prob", "value", "log_inclusion", "round_trip",
    )


def op3_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return language.identify(docs, language.learn(docs))


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.token_counts(table(spark, folder, "documents"))


def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.filter_urls(table(spark, folder, "pages"))


def op7_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract(table(spark, folder, "pages"))


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Per document its text without repeats, the spans removed and their number of characters."""
    cut = lines.deduplicate(table(spark, folder, "documents"))
    length = F.expr("aggregate(removed, 0L, (sum, span) -> sum + (span.end - span.start))")
    return cut.select("doc_id", "text", "removed", length.alias("removed_chars"))


def op9_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lattice.link(table(spark, folder, "embeddings"))


def op10_nearest(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest rows to every row whose id is divisible by 20."""
    return multi_index.search(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Ten negatives for each of five positives of every row whose id is divisible by 100."""
    vectors = table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0, label=label)


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


def op13_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.judge(docs, toxicity.learn(docs, table(spark, folder, "labels")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_source_mix": op3_source_mix,
    "op4_language_id": op4_language_id,
    "op5_token_counts": op5_token_counts,
    "op6_url_filter": op6_url_filter,
    "op7_html_text": op7_html_text,
    "op8_line_dedup": op8_line_dedup,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_nearest": op10_nearest,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_collocations": op12_collocations,
    "op13_toxicity": op13_toxicity,
}

# Components by reachability; `nodes` has (id), `links` has (a, b) in both directions.
_COMPONENTS = """
    reached AS (
        SELECT id AS a, id AS b FROM nodes
        UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
    ),
    components AS (SELECT a AS id, min(b) AS component_id FROM reached GROUP BY a)"""

ORACLE_SQL: dict[str, str] = {
    # All pairs that share a shingle, and their exact similarity.
    "op1_minhash_dedup": rf"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [w]
                ELSE list_transform(range(1, len(w) - 2), lambda i: w[i:i + 3]) END) AS shingle
            FROM words),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        common AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
            FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL),
        links AS (
            SELECT a, b FROM common JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
            WHERE 100 * shared >= 80 * (s.n + t.n - shared)),
        nodes AS (SELECT doc_id AS id FROM documents), {_COMPONENTS}
        SELECT id AS doc_id, coalesce(n, 0) AS n_shingles, component_id, id = component_id AS kept
        FROM components LEFT JOIN sizes ON doc_id = id""",
    # The article of each page of these tables, cut at its blocks.
    "op7_html_text": r"""
        WITH articles AS (SELECT page_id, url, regexp_extract(html, '(?s)<article>(.*?)</article>', 1) AS article FROM pages),
        plain AS (
            SELECT page_id, url, list_transform(string_split_regex(replace(article, '<br>', ' '), '</?(?:p|h1)>'),
                lambda x: replace(replace(replace(replace(regexp_replace(x, '<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&')) AS b
            FROM articles),
        texts AS (
            SELECT page_id, url, array_to_string(
                list_filter(list_transform(b, lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> ''), chr(10)) AS text
            FROM plain)
        SELECT *, CAST(length(text) AS BIGINT) AS n_chars FROM texts""",
    # All pairs of a label.
    "op9_embedding_dedup": f"""
        WITH RECURSIVE vectors AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
        links AS (
            SELECT x.id AS a, y.id AS b FROM vectors x JOIN vectors y ON x.label = y.label AND x.id <> y.id
            WHERE list_cosine_similarity(x.v, y.v) >= 0.93),
        nodes AS (SELECT id FROM vectors), {_COMPONENTS}
        SELECT id AS vec_id, (SELECT count(*) FROM links WHERE a = id) AS n_links, component_id, id = component_id AS kept
        FROM components""",
    # Every anchor's scores with all rows.
    "op11_hard_negatives": """
        WITH whole AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scores AS (
            SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
            FROM whole a JOIN whole b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
        positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id,
            CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
            vec_id AS negative_id, positive_score, score AS negative_score
        FROM positives JOIN scores USING (anchor_id)
        WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        QUALIFY rank <= 10""",
    # All n-grams counted.
    "op12_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents),
        numbered AS (SELECT lang, row_number() OVER () AS p, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
        words AS (SELECT lang, p, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM numbered),
        runs AS (
            SELECT lang, word, lead(word) OVER following AS next, lead(word, 2) OVER following AS third
            FROM words WINDOW following AS (PARTITION BY p ORDER BY i)),
        grams AS (
            SELECT lang, 1 AS size, word AS phrase FROM runs
            UNION ALL SELECT lang, 2, word || ' ' || next FROM runs WHERE next IS NOT NULL
            UNION ALL SELECT lang, 3, word || ' ' || next || ' ' || third FROM runs WHERE third IS NOT NULL),
        counts AS (SELECT lang, size, phrase, CAST(count(*) AS HUGEINT) AS f FROM grams GROUP BY ALL HAVING count(*) >= 10),
        totals AS (SELECT lang, count(*) AS n FROM grams WHERE size = 1 GROUP BY lang),
        candidates AS (SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE size >= 2),
        cuts AS (
            SELECT c.lang, c.phrase, c.a, cut, l.f AS l, r.f AS r, 1000000 * c.a * c.a // (l.f * r.f) AS score
            FROM candidates c JOIN (VALUES (1), (2)) AS places (cut) ON cut < c.size
            JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:cut], ' ')
            JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(w[cut + 1:], ' ')),
        lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
        held AS (
            SELECT lang, array_to_string(w[i:i + 1], ' ') AS phrase, max(a) AS most
            FROM candidates, (VALUES (1), (2)) AS places (i) WHERE size = 3 GROUP BY ALL)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
            CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score
        FROM lowest LEFT JOIN held USING (lang, phrase) JOIN totals USING (lang)
        WHERE most IS NULL OR 100 * most < 50 * a QUALIFY rank <= 2000""",
}
