"""Queries over vectors, dialogs and prompts."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import prompts as pr
from ..operators import cells as ce
from ..operators import documents as dc
from ..operators import keyword as kw
from ..operators import ranking as rk
from ..operators import retrieval as rt
from ..session import scratch_path, stored
from ..sources.tables import parquet_table
from .upkeep import _contents

K = 4
FEATURES = 1_024
SYNC_FEATURES = 256
# The vectors of the tests lie evenly in all directions, so that cells tell little
# and most of them have to be looked into; the share of the exact hits found is 0.9 or more.
PROBED, CANDIDATES = 0.9, 100
FUSED = 20  # hits of each search that are fused


def _vectors(spark: SparkSession, folder: str) -> DataFrame:
    return parquet_table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("passage_id"), F.col("embedding").alias("vector"), "label"
    )


def _questions(spark: SparkSession, folder: str) -> DataFrame:
    return parquet_table(spark, folder, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("question")
    )


def _probes(spark: SparkSession, folder: str) -> DataFrame:
    """The query set of the vector searches: ids divisible by 100."""
    return _vectors(spark, folder).filter("passage_id % 100 = 0").select(
        F.col("passage_id").alias("query_id"), "vector"
    )


def _passages(spark: SparkSession, folder: str) -> DataFrame:
    return parquet_table(spark, folder, "documents").select(
        F.col("doc_id").alias("passage_id"), F.col("text").alias("content"),
        F.concat("source", F.lit("/"), F.col("doc_id").cast("string")).alias("source"),
    )


def vector_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The nearest other vectors."""
    return rt.top_k(_vectors(spark, folder), _probes(spark, folder), K, skip_same=True)


def vector_topk_filtered(spark: SparkSession, folder: str) -> DataFrame:
    """The nearest vectors of one label, with their label."""
    vectors = _vectors(spark, folder)
    hits = rt.filtered_top_k(vectors, _probes(spark, folder), 5, F.col("label") == 3)
    return rt.with_columns_of(hits, vectors, "label")


def vector_near(spark: SparkSession, folder: str) -> DataFrame:
    """The nearest other vectors by cells and codes."""
    vectors = _vectors(spark, folder)
    model = ce.fit_cells(vectors)
    probes = math.ceil(len(model.centres) * PROBED)
    return ce.near_top_k(
        ce.cell_index(vectors, model), vectors, _probes(spark, folder), model, K + 1, probes,
        CANDIDATES, skip_same=True,
    )


def _by_keyword(spark: SparkSession, folder: str, k: int) -> DataFrame:
    return kw.keyword_top_k(kw.inverted_index(_passages(spark, folder)), _questions(spark, folder), k)


def keyword_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that say best what every question says."""
    return _by_keyword(spark, folder, K)


def keyword_quality(spark: SparkSession, folder: str) -> DataFrame:
    """How well keyword search finds the documents that hold every question's text."""
    questions = _questions(spark, folder)
    held = rk.holders(_passages(spark, folder), questions)
    return rk.measures(questions, _by_keyword(spark, folder, K), held, K)


def hybrid_topk(spark: SparkSession, folder: str) -> DataFrame:
    """Every question's documents by keywords and by vectors, fused."""
    near = _near_texts(spark, folder, _questions(spark, folder), "question", FUSED)
    return kw.fused(_by_keyword(spark, folder, FUSED), near, k=K)


def _near_texts(
    spark: SparkSession, folder: str, questions: DataFrame, column: str, k: int
) -> DataFrame:
    """The nearest of all documents to every question; one model makes both sides' vectors."""
    model, counts = rt.model_and_counts(
        _passages(spark, folder), "passage_id", "content", FEATURES
    )
    asked = rt.word_counts(
        model, questions.select("query_id", F.col(column).alias("content")), "query_id"
    )
    return rt.top_k_by_counts(counts, asked, k, model)


def _found(spark: SparkSession, folder: str, questions: DataFrame, column: str) -> DataFrame:
    # stored, so that their size is known and texts stay in place where they are few
    hits = stored(_near_texts(spark, folder, questions, column, K), "near-texts")
    return rt.with_columns_of(hits, _passages(spark, folder), "content", "source")


def _hits(spark: SparkSession, folder: str) -> DataFrame:
    return _found(spark, folder, _questions(spark, folder), "question")


def rag_context(spark: SparkSession, folder: str) -> DataFrame:
    found = rt.contexts(_hits(spark, folder))
    return found.withColumn("sources", F.array_join("sources", ","))


def _prompts(spark: SparkSession, folder: str) -> DataFrame:
    """Every question with its grounded prompt and sources."""
    return rt.grounded_prompts(_questions(spark, folder), _hits(spark, folder))


def prompt_fill(spark: SparkSession, folder: str) -> DataFrame:
    return _prompts(spark, folder).select("query_id", "prompt")


def rag_eval(spark: SparkSession, folder: str) -> DataFrame:
    """All questions in one batch, saved and read back.

    A label of the question's document tells whether it is relevant; the
    result is the prompt a model would be given, or the refusal.
    """
    labels = parquet_table(spark, folder, "labels").select(
        F.col("doc_id").alias("query_id"),
        F.when(F.col("quality") == 1, "Yes, it is.").otherwise("No.").alias("answer"),
    )
    asked = _prompts(spark, folder).join(labels, "query_id", "left")
    path = scratch_path(spark, "evaluation")
    rt.evaluate(asked).write.parquet(path)
    return spark.read.parquet(path).withColumn("sources", F.array_join("sources", ","))


def prompt_augment(spark: SparkSession, folder: str) -> DataFrame:
    best = _hits(spark, folder).filter("rank = 1").select("query_id", "content")
    asked = _questions(spark, folder).join(best, "query_id", "left")
    passage = F.coalesce("content", F.lit(""))
    return asked.select("query_id", pr.with_passage("question", passage).alias("prompt"))


def prompt_defaults(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as prompts; only labelled ones bring their own options."""
    documents = parquet_table(spark, folder, "documents")
    labels = parquet_table(spark, folder, "labels").select(
        "doc_id", (F.col("quality") / 2).alias("temperature"),
        F.when(F.col("toxic") == 1, F.lit(50)).cast("long").alias("max_new_tokens"),
    )
    return documents.join(labels, "doc_id", "left").select(
        "doc_id",
        pr.temperature_or_default("temperature").alias("temperature"),
        pr.new_tokens_or_default("max_new_tokens").alias("max_new_tokens"),
    )


def route_relevance(spark: SparkSession, folder: str) -> DataFrame:
    documents = parquet_table(spark, folder, "documents")
    labels = parquet_table(spark, folder, "labels").select(
        "doc_id", F.when(F.col("quality") == 1, "YES.").otherwise("No").alias("answer")
    )
    routed = pr.routed("answer", F.col("lang"), F.array("source"))
    return documents.join(labels, "doc_id", "left").select(
        "doc_id", routed.alias("r")
    ).select("doc_id", "r.result", F.array_join("r.sources", ",").alias("sources"))


def _dialogs(spark: SparkSession, folder: str) -> DataFrame:
    turns = parquet_table(spark, folder, "conversations")
    message = F.struct("role", F.col("text").alias("content"))
    return dc.gather(turns, ["conv_id"], "turn", message, "messages").select(
        "conv_id",
        pr.question_of("messages").alias("question"),
        pr.history_of("messages").alias("history"),
    )


def chat_split(spark: SparkSession, folder: str) -> DataFrame:
    return _dialogs(spark, folder).select(
        "conv_id", "question", F.size("history").cast("long").alias("n_history"),
        pr.transcript("history").alias("chat_history"),
    )


def query_route(spark: SparkSession, folder: str) -> DataFrame:
    """The prompt of a dialog, and what to retrieve for it.

    The first message and the question stand in for a rewritten question.
    """
    dialogs = _dialogs(spark, folder)
    rewritten = F.concat(F.try_element_at("history", F.lit(1))["content"], F.lit(" "), "question")
    return dialogs.select(
        "conv_id",
        pr.retrieval_query("history", "question", rewritten).alias("query"),
        pr.fill(pr.WITH_HISTORY, chat_history=pr.transcript("history"), question="question")
        .alias("prompt"),
    )


def dialog_prompts(spark: SparkSession, folder: str) -> DataFrame:
    """What a dialog's question is asked with: relevance, rewriting, short and instructed answers."""
    dialogs = _dialogs(spark, folder)
    history = pr.transcript("history")
    return dialogs.select(
        "conv_id",
        pr.fill(pr.RELEVANCE, chat_history=history, question="question").alias("relevance"),
        pr.fill(pr.REWRITE, chat_history=history, question="question").alias("rewriting"),
        pr.fill(pr.ASSISTANT, question="question").alias("short_answer"),
        pr.fill(pr.INSTRUCTION, system=F.lit(pr.SYSTEM), instruction="question").alias("instructed"),
    )


def dialog_grounded(spark: SparkSession, folder: str) -> DataFrame:
    """The grounded prompt of every dialog, with its history and passages for its question."""
    asked = _dialogs(spark, folder).withColumnRenamed("conv_id", "query_id")
    hits = _found(spark, folder, asked, "question")
    return rt.grounded_prompts(asked, hits, history="history").select(
        F.col("query_id").alias("conv_id"), F.md5("prompt").alias("prompt_md5"),
        F.array_join("sources", ",").alias("sources"),
    )


def _weights(vectors: DataFrame, *keys: str) -> DataFrame:
    """The weights that are not 0, a row each; a text without any has one row."""
    placed = F.transform("vector", lambda value, at: F.struct(at.alias("at"), value.alias("value")))
    some = F.filter(placed, lambda item: item["value"] != 0)
    return vectors.select(*keys, F.explode_outer(some).alias("w")).select(
        *keys, F.col("w.at").cast("long").alias("bucket"), F.round("w.value", 6).alias("weight")
    )


def text_vectors(spark: SparkSession, folder: str) -> DataFrame:
    documents = parquet_table(spark, folder, "documents").select("doc_id", "text")
    _, vectors = rt.model_and_vectors(documents, "doc_id", "text", FEATURES, kind="float64")
    return _weights(vectors, "doc_id")


def index_sync(spark: SparkSession, folder: str) -> DataFrame:
    """An index over the documents before, brought in step with those after."""
    before, after = (d.select("id", "content") for d in _contents(spark, folder))
    model = rt.text_model(before, "content", SYNC_FEATURES)
    index = rt.text_vectors(model, before, "float64")
    synced = rt.sync_index(index, after, "id", "content", model, "float64")
    return _weights(synced.withColumn("content_md5", F.md5("content")), "id", "content_md5")


_STORED = """
    vectors AS (SELECT vec_id AS passage_id, CAST(embedding AS DOUBLE[]) AS vector, label
                FROM embeddings),
    probes AS (SELECT passage_id AS query_id, vector FROM vectors WHERE passage_id % 100 = 0)"""


def _ranked(scores: str, k: int) -> str:
    return f"""
    hits AS (
        SELECT * FROM (
            SELECT *, row_number() OVER (PARTITION BY query_id
                                         ORDER BY score DESC, passage_id) AS rank
            FROM ({scores}))
        WHERE rank <= {k})"""


def _near(condition: str, k: int) -> str:
    return _ranked(f"""
        SELECT q.query_id, c.passage_id, c.label,
               round(list_inner_product(q.vector, c.vector), 9) AS score
        FROM probes q JOIN vectors c ON {condition}""", k)


def _word_weights(name: str, texts: str, fitted: str, features: int) -> str:
    """Weights of `texts` (id, content) by the word frequencies in `fitted`."""

    def counts(source: str) -> str:
        return f"""
            SELECT id, CAST('0x' || substr(md5(word), 1, 8) AS BIGINT) % {features} AS bucket,
                   count(*) AS n
            FROM (SELECT id, unnest(regexp_split_to_array(
                             lower(coalesce(content, '')), '[^\\pL\\pN]+')) AS word
                  FROM ({source}))
            WHERE word <> '' GROUP BY ALL"""

    return f"""
    {name}_raw AS (
        SELECT id, bucket, n * ln((total + 1) / (having_it + 1)) AS weight
        FROM ({counts(texts)})
        JOIN (SELECT bucket, count(*) AS having_it FROM ({counts(fitted)}) GROUP BY ALL)
        USING (bucket), (SELECT count(*) AS total FROM ({fitted}))),
    {name} AS (
        SELECT id, bucket, weight / sqrt(sum(weight * weight) OVER (PARTITION BY id)) AS weight
        FROM {name}_raw WHERE weight <> 0)"""


def _text_hits(asked: str, k: int = K) -> str:
    """Hits of `asked` (id, content) among all documents."""
    documents = "SELECT doc_id AS id, text AS content FROM documents"
    return f"""
    passages AS (SELECT doc_id AS passage_id, text AS content, source || '/' || doc_id AS source
                 FROM documents),
    {_word_weights("passage_weights", documents, documents, FEATURES)},
    {_word_weights("query_weights", asked, documents, FEATURES)},
    products AS (
        SELECT q.id AS query_id, p.id AS passage_id, sum(q.weight * p.weight) AS score
        FROM query_weights q JOIN passage_weights p USING (bucket) GROUP BY ALL),
    {_ranked(f"""
        SELECT q.id AS query_id, p.passage_id, round(coalesce(score, 0), 9) AS score
        FROM ({asked}) q CROSS JOIN passages p
        LEFT JOIN products s ON s.query_id = q.id AND s.passage_id = p.passage_id""", k)}"""


_HITS = f"""
    questions AS (SELECT item_id AS query_id, text AS question FROM benchmark),
    {_text_hits("SELECT query_id AS id, question AS content FROM questions")}"""
_GATHERED = """
    contexts AS (
        SELECT query_id, string_agg(content, chr(10) || chr(10) ORDER BY rank) AS context,
               string_agg(source, ',' ORDER BY rank) AS sources
        FROM hits JOIN passages USING (passage_id) GROUP BY query_id)"""
_CONTEXTS = f"{_HITS},{_GATHERED}"


_KEYWORD_SCORES = f"""
    terms AS (
        SELECT doc_id AS passage_id, unnest(list_filter(regexp_split_to_array(
                   lower(coalesce(text, '')), '[^\\pL\\pN]+'), lambda w: w <> '')) AS term
        FROM documents),
    term_counts AS (SELECT passage_id, term, count(*) AS n FROM terms GROUP BY ALL),
    sizes AS (SELECT passage_id, sum(n) AS length FROM term_counts GROUP BY ALL),
    whole AS (SELECT (SELECT count(*) FROM documents) AS total,
                     (SELECT sum(n) FROM term_counts) / (SELECT count(*) FROM documents) AS mean),
    rarities AS (SELECT term, ln(1 + (any_value(total) - count(*) + 0.5) / (count(*) + 0.5)) AS rarity
                 FROM term_counts, whole GROUP BY term),
    asked_terms AS (
        SELECT DISTINCT item_id AS query_id, unnest(list_filter(regexp_split_to_array(
                   lower(coalesce(text, '')), '[^\\pL\\pN]+'), lambda w: w <> '')) AS term
        FROM benchmark),
    keyword_scores AS (
        SELECT query_id, passage_id,
               round(sum(rarity * n * {kw.REPEATS + 1}
                         / (n + {kw.REPEATS} * (1 - {kw.LENGTH} + {kw.LENGTH} * length / mean))), 9) AS score
        FROM asked_terms JOIN term_counts USING (term) JOIN sizes USING (passage_id)
        JOIN rarities USING (term), whole GROUP BY ALL)"""
_TERM_LINE = """' ' || array_to_string(list_filter(regexp_split_to_array(
                   lower(coalesce(text, '')), '[^\\pL\\pN]+'), lambda w: w <> ''), ' ') || ' '"""
_KEYWORD_HITS = f"""{_KEYWORD_SCORES},
    keyword_hits AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, passage_id) AS rank
        FROM keyword_scores)"""


def _filled(template: str, **slots: str) -> str:
    """The template as a SQL text with expressions in its slots."""
    text = "'" + template.replace("'", "''") + "'"
    for slot, expression in slots.items():
        text = text.replace("{" + slot + "}", f"' || {expression} || '")
    return text


_PROMPTS = f"""{_CONTEXTS},
    prompts AS (
        SELECT query_id, question, coalesce(sources, '') AS sources,
               {_filled(pr.WITH_CONTEXT, chat_history="''", context="coalesce(context, '')",
                        question="question")} AS prompt
        FROM questions LEFT JOIN contexts USING (query_id))"""

_DIALOGS = """
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back
        FROM conversations),
    dialogs AS (
        SELECT conv_id, max(text) FILTER (WHERE back = 1) AS question, count(*) - 1 AS n_history,
               coalesce(string_agg(role || ': ' || text, chr(10) ORDER BY turn)
                        FILTER (WHERE back > 1), '') AS chat_history,
               first(text ORDER BY turn) AS opening
        FROM placed GROUP BY conv_id)"""

QUERIES = {
    "vector_topk": (vector_topk, f"""WITH {_STORED},
        {_near("q.query_id <> c.passage_id", K)}
        SELECT query_id, passage_id, score, rank FROM hits"""),
    "vector_topk_filtered": (vector_topk_filtered, f"""WITH {_STORED},
        {_near("c.label = 3", 5)}
        SELECT query_id, passage_id, score, rank, label FROM hits"""),
    "vector_near": (vector_near, None),
    "keyword_topk": (keyword_topk, f"""WITH {_KEYWORD_HITS}
        SELECT query_id, passage_id, score, rank FROM keyword_hits WHERE rank <= {K}"""),
    "keyword_quality": (keyword_quality, f"""WITH {_KEYWORD_HITS},
        kept AS (
            SELECT doc_id AS passage_id, {_TERM_LINE} AS line FROM documents),
        asked AS (
            SELECT item_id AS query_id, {_TERM_LINE} AS line FROM benchmark),
        held AS (
            SELECT query_id, passage_id FROM asked JOIN kept ON contains(kept.line, asked.line)
            WHERE len(string_split(trim(asked.line), ' ')) >= {rk.ANCHOR}),
        per AS (
            SELECT query_id, count(*) AS n, count(rank) AS hit, min(rank) AS first_hit,
                   coalesce(sum(1 / log2(rank + 1.0)), 0) AS gained
            FROM held LEFT JOIN (SELECT query_id, passage_id, rank FROM keyword_hits WHERE rank <= {K})
            USING (query_id, passage_id) GROUP BY query_id)
        SELECT query_id, coalesce(n, 0) AS n_relevant, coalesce(hit, 0) AS n_found,
               round(hit / n, 9) AS recall,
               CASE WHEN n > 0 THEN round(coalesce(1 / first_hit, 0), 9) END AS reciprocal_rank,
               CASE WHEN n > 0 THEN round(gained / list_sum(list_transform(
                   range(1, least(n, {K}) + 1), lambda r: 1 / log2(r + 1.0))), 9) END AS ndcg
        FROM asked LEFT JOIN per USING (query_id)"""),
    "hybrid_topk": (hybrid_topk, f"""WITH {_KEYWORD_HITS},
        {_text_hits("SELECT item_id AS id, text AS content FROM benchmark", FUSED)},
        shares AS (
            SELECT query_id, passage_id, round(sum(1 / ({kw.FUSION} + rank)), 9) AS score FROM (
                SELECT query_id, passage_id, rank FROM hits
                UNION ALL SELECT query_id, passage_id, rank FROM keyword_hits WHERE rank <= {FUSED})
            GROUP BY ALL)
        SELECT query_id, passage_id, score, rank FROM (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, passage_id) AS rank
            FROM shares) WHERE rank <= {K}"""),
    "rag_context": (rag_context, f"WITH {_CONTEXTS} SELECT * FROM contexts"),
    "prompt_fill": (prompt_fill, f"WITH {_PROMPTS} SELECT query_id, prompt FROM prompts"),
    "rag_eval": (rag_eval, f"""WITH {_PROMPTS}
        SELECT question,
               CASE WHEN quality = 1 THEN prompt ELSE '{pr.REFUSAL}' END AS result,
               CASE WHEN quality = 1 THEN sources ELSE '' END AS sources
        FROM prompts LEFT JOIN labels ON doc_id = query_id"""),
    "prompt_augment": (prompt_augment, f"""WITH {_HITS}
        SELECT query_id, question || '{pr.MORE_CONTEXT}' || content AS prompt
        FROM hits JOIN passages USING (passage_id) JOIN questions USING (query_id)
        WHERE rank = 1"""),
    "prompt_defaults": (prompt_defaults, """
        SELECT doc_id, coalesce(quality / 2, 1.0) AS temperature,
               CASE WHEN toxic = 1 THEN 50 ELSE CAST(100 AS BIGINT) END AS max_new_tokens
        FROM documents LEFT JOIN labels USING (doc_id)"""),
    "route_relevance": (route_relevance, f"""
        SELECT doc_id, CASE WHEN quality = 1 THEN lang ELSE '{pr.REFUSAL}' END AS result,
               CASE WHEN quality = 1 THEN source ELSE '' END AS sources
        FROM documents LEFT JOIN labels USING (doc_id)"""),
    "chat_split": (chat_split, f"""WITH {_DIALOGS}
        SELECT conv_id, question, n_history, chat_history FROM dialogs"""),
    "query_route": (query_route, f"""WITH {_DIALOGS}
        SELECT conv_id,
               CASE WHEN n_history > 0 THEN opening || ' ' || question ELSE question END AS query,
               {_filled(pr.WITH_HISTORY, chat_history="chat_history", question="question")}
                   AS prompt
        FROM dialogs"""),
    "dialog_prompts": (dialog_prompts, f"""WITH {_DIALOGS}
        SELECT conv_id,
               {_filled(pr.RELEVANCE, chat_history="chat_history", question="question")} AS relevance,
               {_filled(pr.REWRITE, chat_history="chat_history", question="question")} AS rewriting,
               {_filled(pr.ASSISTANT, question="question")} AS short_answer,
               {_filled(pr.INSTRUCTION.replace("{system}", pr.SYSTEM), instruction="question")}
                   AS instructed
        FROM dialogs"""),
    "dialog_grounded": (dialog_grounded, f"""WITH {_DIALOGS},
        {_text_hits("SELECT conv_id AS id, question AS content FROM dialogs")},{_GATHERED}
        SELECT conv_id, coalesce(sources, '') AS sources,
               md5({_filled(pr.WITH_CONTEXT, chat_history="chat_history",
                            context="coalesce(context, '')", question="question")}) AS prompt_md5
        FROM dialogs LEFT JOIN contexts ON query_id = conv_id"""),
    "text_vectors": (text_vectors, f"""WITH
        {_word_weights("weights", *["SELECT doc_id AS id, text AS content FROM documents"] * 2,
                       FEATURES)}
        SELECT doc_id, bucket, round(weight, 6) AS weight
        FROM documents LEFT JOIN weights ON id = doc_id"""),
    "index_sync": (index_sync, f"""WITH
        before AS (SELECT doc_id AS id, text AS content FROM documents WHERE lang <> 'de'),
        after AS (SELECT doc_id AS id,
                         CASE WHEN lang = 'fr' THEN text || ' (revised)' ELSE text END AS content
                  FROM documents WHERE lang <> 'en'),
        {_word_weights("weights", "SELECT * FROM after", "SELECT * FROM before", SYNC_FEATURES)}
        SELECT after.id, md5(content) AS content_md5, bucket, round(weight, 6) AS weight
        FROM after LEFT JOIN weights ON weights.id = after.id"""),
}
