"""The registered queries of the operators, and DuckDB SQL for those it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import (
    decontaminate,
    embeddings,
    language,
    lexical,
    licenses,
    lines,
    mixing,
    negatives,
    repeats,
    secrets,
    simhash,
    token_store,
    urls,
)

# The rules of the URL filter and their verdicts.
URL_RULES = (
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = F.aggregate(
        "pieces", F.lit(0).cast("long"), lambda total, piece: total + piece["words"]
    )
    return mixing.plan(table(spark, sf_dir, "documents"), "doc_id").select(
        "doc.doc_id", "size", "source_size", "target", taken.alias("taken")
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select("doc_id", "item_id", "similarity", "changed")


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.read_documents(
        token_store.write_segments(table(spark, sf_dir, "documents"))
    )


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(secrets.span_text("base_spans"), 256).alias("base_sha256"),
        secrets.span_text("spans").alias("spans"),
    )


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents")).select(
        "doc_id", "held_out", "lang_pred", "score", "rejected"
    )


def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = spark.createDataFrame(list(URL_RULES), "rule string, verdict string")
    return urls.judge(table(spark, sf_dir, "pages"), listed)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.remove_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Some labels are wrong on purpose.
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(
        F.col("label")
    )
    rows = table(spark, sf_dir, "embeddings").withColumn("label", label)
    return negatives.mine(rows, F.col("vec_id") % 50 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_mixing,
        op2_decontamination,
        op3_token_store,
        op4_licenses,
        op5_secrets,
        op6_language,
        op7_embeddings,
        op8_repeats,
        op9_urls,
        op10_simhash,
        op11_lines,
        op12_lexical,
        op13_negatives,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op1_mixing": r"""
        WITH sized AS (
            SELECT doc_id, source,
                len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                coalesce('=' || source, '') AS of_source,
                md5(concat(coalesce(doc_id::VARCHAR, ''), '/', coalesce(text, ''))) AS turn
            FROM documents),
        sources AS (
            SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
        weighed AS (
            SELECT source, source_size, 2 * source_size AS most,
                [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]
                    AS weight
            FROM sources),
        levels AS (
            SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(most) OVER before, 0))
                / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
            FROM weighed
            WINDOW before AS (ORDER BY most / weight, source NULLS FIRST
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        water AS (
            SELECT min(level) AS water FROM (
                SELECT level FROM levels WHERE most / weight > level
                ORDER BY most / weight, source NULLS FIRST LIMIT 1)),
        targets AS (
            SELECT source, source_size,
                coalesce(least(most::DOUBLE, water * weight), most::DOUBLE) AS target
            FROM levels, water),
        blocks AS (
            SELECT of_source, turn[:4] AS block, sum(size)::BIGINT AS words_in
            FROM sized GROUP BY ALL),
        drawn AS (
            SELECT of_source, block, pass, coalesce(sum(words_in) OVER (
                PARTITION BY of_source, pass
                ORDER BY md5(concat_ws('/', block, pass, 20241, of_source)), block
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins
            FROM blocks, (VALUES (0), (1)) AS passes (pass)),
        placed AS (
            SELECT row_number() OVER () AS r, *, turn[:4] AS block, coalesce(sum(size) OVER (
                PARTITION BY of_source, turn[:4] ORDER BY turn, size
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS within
            FROM sized)
        SELECT doc_id, size, source_size, target,
            sum(greatest(0, least(size, floor(target + 0.5)
                - pass * source_size - begins - within)))::BIGINT AS taken
        FROM placed JOIN targets ON placed.source IS NOT DISTINCT FROM targets.source
            JOIN drawn USING (of_source, block)
        GROUP BY r, doc_id, size, source_size, target
    """,
    "op7_embeddings": """
        WITH RECURSIVE vectors AS (
            SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        units AS (
            SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS norm FROM vectors),
        links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM units a JOIN units b
                ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
            WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.9),
        reached AS (
            SELECT a, b FROM links
            UNION
            SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a),
        lowest AS (SELECT a, min(b) AS b FROM reached GROUP BY a),
        counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
        SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links,
            least(vec_id, coalesce(lowest.b, vec_id)) AS component_id,
            coalesce(vec_id = least(vec_id, coalesce(lowest.b, vec_id)), false) AS kept
        FROM embeddings
        LEFT JOIN lowest ON lowest.a = vec_id LEFT JOIN counted ON counted.a = vec_id
    """,
    "op9_urls": r"""
        WITH parted AS (
            SELECT page_id,
                translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
            FROM pages),
        rules (rule, listed) AS (VALUES ('net/', 'block'), ('example.net/en/', 'allow'),
            ('example.com/de/', 'block'), ('org/fr/', 'allow')),
        ruled AS (
            SELECT rule, listed, split_part(rule, '/', 1) AS rule_host,
                substr(rule, strpos(rule, '/')) AS rule_path
            FROM rules)
        SELECT page_id, host, path, best.rule AS rule, coalesce(best.listed, 'allow') AS verdict
        FROM parted LEFT JOIN LATERAL (
            SELECT rule, listed FROM ruled
            WHERE (host = rule_host OR suffix(host, '.' || rule_host))
                AND prefix(path, rule_path)
            ORDER BY length(rule) DESC, rule DESC LIMIT 1) best ON true
    """,
    "op11_lines": r"""
        WITH split AS (
            SELECT row_number() OVER () AS r, doc_id,
                string_split(coalesce(text, ''), chr(10)) AS lines
            FROM documents),
        lines AS (
            SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS nth FROM split),
        keyed AS (
            SELECT *, translate(
                trim(line, concat(' ', chr(9), chr(11), chr(12), chr(13))),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
            FROM lines),
        common AS (
            SELECT k, max(doc_id) AS latest FROM keyed WHERE length(k) >= 20
            GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
        judged AS (
            SELECT r, doc_id, line, nth, coalesce(doc_id <> latest, false) AS gone
            FROM keyed LEFT JOIN common USING (k))
        SELECT doc_id, count(*)::BIGINT AS n_lines, count_if(gone)::BIGINT AS n_dropped,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY nth) FILTER (NOT gone), ''))
                AS kept_sha256
        FROM judged GROUP BY r, doc_id
    """,
    "op12_lexical": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents),
        sized AS (SELECT r, doc_id, terms, len(terms)::BIGINT AS n FROM docs WHERE len(terms) > 0),
        whole AS (SELECT count(*)::BIGINT AS documents, sum(n)::BIGINT AS length FROM sized),
        postings AS (
            SELECT r, term, count(*)::BIGINT AS tf
            FROM (SELECT r, unnest(terms) AS term FROM sized) GROUP BY r, term),
        weighed AS (
            SELECT term, floor(1000 * ln((2 * documents + 2) / (2 * count(*) + 1)))::BIGINT AS w
            FROM postings, whole GROUP BY term, documents),
        damped AS (
            SELECT r, doc_id, 10 + (90 * n * documents) // length AS m FROM sized, whole),
        asked AS (
            SELECT DISTINCT q, item_id, term FROM (
                SELECT row_number() OVER () AS q, item_id, unnest(regexp_extract_all(
                    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
                FROM benchmark)),
        scored AS (
            SELECT q, item_id, doc_id, r,
                sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
            FROM asked JOIN postings USING (term) JOIN weighed USING (term) JOIN damped USING (r)
            GROUP BY q, item_id, doc_id, r),
        ranked AS (
            SELECT *, row_number() OVER (
                PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank
            FROM scored WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
    """,
    "op13_negatives": """
        WITH vectors AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        pairs AS (
            SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
                list_dot_product(a.v, b.v)::BIGINT AS score
            FROM vectors a JOIN vectors b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
        positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
            QUALIFY row_number() OVER (
                PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
        mined AS (
            SELECT anchor_id, positive_id, row_number() OVER (
                PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
                vec_id AS negative_id, positive_score, score AS negative_score
            FROM positives JOIN pairs USING (anchor_id)
            WHERE NOT same AND 50 * positive_score <= 100 * score
                AND 100 * score <= 95 * positive_score)
        SELECT * FROM mined WHERE rank <= 3
    """,
}
