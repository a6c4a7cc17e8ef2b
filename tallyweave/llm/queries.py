"""The dealt operators as queries over the benchmark tables, with SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from ..sources.tables import parquet_table
from . import language
from .bpe import bpe_digests
from .collocations import collocations
from .exact import exact_groups
from .fingerprints import edited_fingerprints, written
from .html_text import page_texts
from .licenses import license_scan
from .mixing import mix
from .simhash import simhash_groups
from .token_counts import token_counts
from .toxicity import fit, is_held_out, toxicity_scores
from .variants import misspelt, variants
from .warc import archived

PIECES = "piece_bpe_32k.model"
WORDS = "word_bpe_49k.json"


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file, by default that of the installed ones."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship_package(spark)
    return parquet_table(spark, folder, name)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def op1_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan(documents(spark, folder)).drop("spans")


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    model = fit(docs, parquet_table(spark, folder, "labels"))
    return toxicity_scores(docs, model).select(
        "doc_id", is_held_out().alias("held_out"), "score", "predicted"
    )


# The mixture of op3: a source's domain is a rule over its name.
DOMAIN = "substr(md5(coalesce(source, '')), 1, 1)"
MIX_WEIGHTS = {"lang": {"en": 6, "de": 2, "fr": 2}, "source": {"src0": 2}}
MIX_SHARE, MIX_EPOCHS, MIX_SEED = (3, 2), 4, 20


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix(
        documents(spark, folder), F.expr(DOMAIN), MIX_SHARE, MIX_EPOCHS, MIX_SEED, MIX_WEIGHTS
    )


def _level_sql(name: str, nodes: str, parent: str, weight: str) -> str:
    return f"""
{name}_rate AS (
    SELECT *, above - coalesce(sum(room) OVER (sorted ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
           sum(weight) OVER (sorted ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS onward
    FROM (SELECT *, {weight} AS weight FROM ({nodes}))
    WINDOW sorted AS (PARTITION BY {parent} ORDER BY room / weight, {name})),
{name}_budget AS (
    SELECT *, coalesce(least(room, rate.rest * weight // rate.onward), room) AS budget FROM (
        SELECT *, first(CASE WHEN rest * weight // onward < room THEN {{'rest': rest, 'onward': onward}} END IGNORE NULLS)
               OVER (PARTITION BY {parent} ORDER BY room / weight, {name}
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rate
        FROM {name}_rate))"""


OP3_MIXING = f"""
WITH units AS (
    SELECT {DOMAIN} AS domain, lang, source, doc_id,
           sum(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))) AS tokens
    FROM documents GROUP BY ALL),
leaves AS (
    SELECT domain, lang, source, sum(tokens) AS tokens, count(*) AS docs,
           sum(tokens) * {MIX_EPOCHS} AS room
    FROM units GROUP BY ALL),""" + _level_sql(
    "domain",
    f"""SELECT domain, sum(room) AS room,
               (SELECT sum(tokens) * {MIX_SHARE[0]} // {MIX_SHARE[1]} FROM units) AS above
        FROM leaves GROUP BY ALL""", "1", "1") + "," + _level_sql(
    "lang",
    """SELECT leaves.domain, leaves.lang, sum(leaves.room) AS room, any_value(b.budget) AS above
        FROM leaves JOIN domain_budget b ON leaves.domain = b.domain GROUP BY ALL""", "domain",
    "CASE lang WHEN 'en' THEN 6 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END") + "," + _level_sql(
    "source",
    """SELECT leaves.*, b.budget AS above FROM leaves
        JOIN lang_budget b ON leaves.domain = b.domain AND leaves.lang IS NOT DISTINCT FROM b.lang""",
    "domain, lang", "CASE source WHEN 'src0' THEN 2 ELSE 1 END") + f""",
planned AS (
    SELECT u.*, CASE WHEN s.tokens > 0 THEN s.budget // s.tokens ELSE 1 END AS whole,
           CASE WHEN s.tokens > 0 THEN s.budget % s.tokens ELSE 0 END AS part
    FROM units u JOIN source_budget s
      ON u.domain = s.domain AND u.lang IS NOT DISTINCT FROM s.lang
     AND u.source IS NOT DISTINCT FROM s.source),
placed AS (
    SELECT *, coalesce(sum(tokens) OVER (
                 PARTITION BY domain, lang, source
                 ORDER BY substr(md5('{MIX_SEED}|' || whole || '|' || doc_id), 1, 15), doc_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
    FROM planned WHERE part > 0)
SELECT doc_id, domain, lang, source, unnest(range(CAST(whole AS BIGINT))) AS epoch,
       CAST(tokens AS BIGINT) AS tokens, CAST(NULL AS BIGINT) AS before, CAST(tokens AS BIGINT) AS taken
FROM planned
UNION ALL
SELECT doc_id, domain, lang, source, CAST(whole AS BIGINT), CAST(tokens AS BIGINT),
       CAST(earlier AS BIGINT), CAST(least(tokens, part - earlier) AS BIGINT)
FROM placed WHERE earlier < part
"""


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_groups(documents(spark, folder)).select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


def op6_exact(spark: SparkSession, folder: str) -> DataFrame:
    return exact_groups(documents(spark, folder)).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


def op5_html(spark: SparkSession, folder: str) -> DataFrame:
    return page_texts(table(spark, folder, "pages"))


OP6_EXACT = """
WITH plain AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS text
    FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(text) AS text_sha256
FROM plain WINDOW same AS (PARTITION BY text)
"""


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(documents(spark, folder), vocabulary(PIECES))


def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    records = archived(table(spark, folder, "pages"))
    is_response = F.col("record_type") == "response"
    return records.select(
        "page_id",
        F.when(is_response, F.octet_length("payload")).otherwise(F.col("bytes")).cast("long")
        .alias("payload_bytes"),
        F.when(is_response, F.sha1("payload")).otherwise(F.col("digest")).alias("payload_digest"),
        "record_type", "refers_to",
    )


OP8_WARC = """
WITH payloads AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
    FROM pages),
grouped AS (
    SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS last_id FROM payloads)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN last_id END AS refers_to
FROM grouped
"""


def op9_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_digests(documents(spark, folder), vocabulary(WORDS))


def op10_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return edited_fingerprints(documents(spark, folder)).select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        written(F.col("fingerprint")).alias("fingerprint"),
        written(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        "near_edited", "near_next",
    )


def op11_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return language.languages(docs, language.fit(docs)).select(
        "doc_id", language.is_held_out().alias("held_out"), "lang_pred", "score"
    )


MISSPELT = 31  # one run in so many loses a code point


def op12_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variants(documents(spark, folder), misspelt(MISSPELT))


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(documents(spark, folder))


def _gram_sql(size: int) -> str:
    ahead = [f"lead(word, {at}) OVER piece" for at in range(1, size)]
    phrase = " || ' ' || ".join(["word", *ahead])
    return f"""
    SELECT lang, phrase, {size} AS size, count(*) AS n FROM (
        SELECT lang, {phrase} AS phrase FROM words
        WINDOW piece AS (PARTITION BY doc, piece ORDER BY place))
    WHERE phrase IS NOT NULL GROUP BY ALL HAVING count(*) >= 30"""


OP13_COLLOCATIONS = f"""
WITH texts AS (
    SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents),
split AS (SELECT doc, lang, regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]') AS pieces FROM texts),
pieces AS (SELECT doc, lang, unnest(pieces) AS text, generate_subscripts(pieces, 1) AS piece FROM split),
listed AS (SELECT doc, lang, piece, regexp_extract_all(text, '[^\x20\x09]+') AS found FROM pieces),
words AS (SELECT doc, lang, piece, unnest(found) AS word, generate_subscripts(found, 1) AS place FROM listed),
totals AS (SELECT lang, count(*) AS n FROM words GROUP BY lang),
counts AS MATERIALIZED ({" UNION ALL ".join(map(_gram_sql, range(1, 5)))}),
candidates AS MATERIALIZED (
    SELECT lang, phrase, size, n AS a, string_split(phrase, ' ') AS own FROM counts WHERE size > 1),
cuts AS (
    SELECT c.lang, c.phrase, c.a, k, l.n AS l, r.n AS r, 2000000::HUGEINT * c.a // (l.n + r.n) AS score
    FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) c
    JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(own[1:k], ' ')
    JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(own[k + 1:], ' ')),
best AS (
    SELECT * FROM cuts
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
    SELECT lang, array_to_string(own[begin_at:begin_at + len - 1], ' ') AS phrase, max(a) AS longer FROM (
        SELECT *, unnest(range(1, size - len + 2)) AS begin_at
        FROM (SELECT *, unnest(range(2, size)) AS len FROM candidates))
    GROUP BY ALL),
ranked AS (
    SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
    FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
    WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


QUERIES = {
    "op1_licenses": (op1_licenses, None),
    "op2_toxicity": (op2_toxicity, None),
    "op3_mixing": (op3_mixing, OP3_MIXING),
    "op4_simhash": (op4_simhash, None),
    "op5_html": (op5_html, None),
    "op6_exact": (op6_exact, OP6_EXACT),
    "op7_token_counts": (op7_token_counts, None),
    "op8_warc": (op8_warc, OP8_WARC),
    "op9_bpe": (op9_bpe, None),
    "op10_fingerprints": (op10_fingerprints, None),
    "op11_language": (op11_language, None),
    "op12_variants": (op12_variants, None),
    "op13_collocations": (op13_collocations, OP13_COLLOCATIONS),
}
