"""Curation queries over conversations, documents, embeddings and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scores as S
from ..functions.hashing import content_hash, short_md5
from ..functions.probing import strip
from ..operators import curation, datasets, dedup, formatting, interactions, quality, sampling, topics, web
from ..sources.readers import table

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _interactions(spark: SparkSession, d: str) -> DataFrame:
    return interactions.from_conversations(table(spark, d, "conversations"))


def _examples(spark: SparkSession, d: str) -> DataFrame:
    rows = interactions.from_conversations(table(spark, d, "conversations"), history=5)  # as many as ``chatml`` takes
    return formatting.chatml(rows, system_prompt="You are helpful.")


#: Interactions, their ChatML examples and the first reason to reject one.
_INTER = """t AS (SELECT *, lag(text) OVER w AS u, lag(role) OVER w AS ur, max(CASE WHEN role = 'system' THEN text END) OVER (PARTITION BY conv_id) AS sys FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
i AS (SELECT conv_id || '-' || turn AS id, conv_id, turn, u AS user_input, text AS assistant_output, sys, list({'user': u, 'assistant': text}) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev,
  least(1.0, 0.5 * 1.2 * CASE WHEN u <> '' AND text <> '' THEN 1.1 ELSE 1.0 END) AS quality_score FROM t WHERE role = 'assistant' AND ur = 'user')"""
_EX = f"""{_INTER}, e AS (SELECT id, conv_id, turn, user_input, assistant_output, quality_score,
  length('You are helpful.' || CASE WHEN coalesce(sys, '') <> '' THEN chr(10) || chr(10) || 'Context: ' || sys ELSE '' END) + length(user_input) + length(assistant_output)
  + coalesce(list_sum(list_transform(coalesce(prev, [])[greatest(len(coalesce(prev, [])) - 4, 1):], lambda p: length(p.user) + length(p.assistant))), 0) AS chars,
  sha256(coalesce(sys, '') || chr(1) || user_input || chr(1) || assistant_output || chr(1) || coalesce(array_to_string(list_transform(prev[greatest(len(prev) - 4, 1):], lambda p: p.user || chr(2) || p.assistant), chr(3)), '')) AS h
  FROM i WHERE user_input <> '' AND assistant_output <> ''),
x AS (SELECT *, (chars // 4)::BIGINT AS tokens FROM e)"""


@query(f"""WITH {_INTER} SELECT id, length(user_input) AS user_chars, length(assistant_output) AS assistant_chars, coalesce(len(prev), 0) AS turns, round(quality_score, 4) AS quality_score,
substr(sha256(user_input || assistant_output), 1, 16) AS content_hash FROM i""")
def interactions_from_conversations(spark: SparkSession, d: str) -> DataFrame:
    return _interactions(spark, d).select(
        "id", F.length("user_input").alias("user_chars"), F.length("assistant_output").alias("assistant_chars"), F.size("previous_turns").alias("turns"), F.round("quality_score", 4).alias("quality_score"),
        content_hash(F.col("user_input"), F.col("assistant_output")).alias("content_hash"),
    )


@query(f"""WITH {_INTER}, r AS (SELECT *, row_number() OVER (PARTITION BY sha256(user_input || assistant_output) ORDER BY conv_id, turn) AS k FROM i) SELECT id FROM r WHERE k = 1""")
def interactions_deduplicated(spark: SparkSession, d: str) -> DataFrame:
    rows = _interactions(spark, d).withColumn("h", content_hash(F.col("user_input"), F.col("assistant_output"), chars=64))
    return dedup.quality_then_first(rows, interactions.trainable(0.5), ["h"], "_src_order", "_line_no").select("id")


@query(f"""WITH {_EX} SELECT id, tokens AS estimated_tokens FROM x WHERE tokens <= 4096""")
def examples_chatml(spark: SparkSession, d: str) -> DataFrame:
    return _examples(spark, d).where("estimated_tokens <= 4096").select(F.col("source_id").alias("id"), "estimated_tokens")


@query(f"""WITH {_INTER}, a AS (SELECT id, 'Be brief.' || chr(10) || 'Context tags: conversation' AS ins, CASE WHEN coalesce(sys, '') <> '' THEN sys || chr(10) || chr(10) || user_input ELSE user_input END AS inp, assistant_output AS out FROM i)
SELECT id, md5(ins || inp || out) AS digest FROM a WHERE (length(ins) + length(inp) + length(out)) // 4 <= 2048""")
def examples_alpaca(spark: SparkSession, d: str) -> DataFrame:
    rows = formatting.alpaca(_interactions(spark, d), "Be brief.").where("estimated_tokens <= 2048")
    return rows.select(F.col("source_id").alias("id"), F.md5(F.concat("instruction", "input_text", "output_text")).alias("digest"))


@query(f"""WITH {_INTER} SELECT id, md5(CASE WHEN coalesce(sys, '') <> '' THEN '<|system|>' || chr(10) || sys || chr(10) ELSE '' END || '<|user|>' || chr(10) || user_input || chr(10) || '<|assistant|>' || chr(10) || assistant_output) AS digest FROM i""")
def examples_raw(spark: SparkSession, d: str) -> DataFrame:
    return formatting.raw_text(_interactions(spark, d)).select(F.col("source_id").alias("id"), F.md5("output_text").alias("digest"))


@query(f"""WITH {_EX}, j AS (SELECT *, CASE WHEN tokens < 60 THEN 'too_short' WHEN tokens > 700 THEN 'too_long' WHEN quality_score < 0.5 THEN 'below_quality' END AS r FROM x),
k AS (SELECT *, CASE WHEN r IS NULL AND row_number() OVER (PARTITION BY r IS NULL, h ORDER BY conv_id, turn) > 1 THEN 'duplicate' ELSE r END AS reason FROM j)
SELECT coalesce(reason, 'passed') AS reason, count(*) AS n FROM k GROUP BY 1""")
def examples_filtered(spark: SparkSession, d: str) -> DataFrame:
    rows = _examples(spark, d).withColumn("o", F.array(*[F.split("source_id", "-")[k].cast("bigint") for k in (0, 1)]))
    judged = quality.judged(rows, "o", min_tokens=60, max_tokens=700)
    return judged.groupBy(F.coalesce("reject_reason", F.lit("passed")).alias("reason")).agg(F.count("*").alias("n"))


@query(f"""WITH {_EX}, k AS (SELECT *, row_number() OVER (PARTITION BY h ORDER BY conv_id, turn) AS n FROM x WHERE tokens BETWEEN 10 AND 4096 AND quality_score >= 0.5)
SELECT count(*) AS total, count(*) AS chatml, 0::BIGINT AS alpaca, 0::BIGINT AS preference, 0::BIGINT AS raw, 0::BIGINT AS corrections, 0::BIGINT AS synthetic, round(avg(quality_score), 6) AS avg_quality, coalesce(sum(tokens), 0)::BIGINT AS total_tokens,
(sum(tokens) // count(*))::BIGINT AS avg_tokens FROM k WHERE n = 1""")
def dataset_stats(spark: SparkSession, d: str) -> DataFrame:
    """The whole path: conversations to interactions, ChatML, filters, deduplication and statistics."""
    rows = _examples(spark, d).withColumn("o", F.array(*[F.split("source_id", "-")[k].cast("bigint") for k in (0, 1)]))
    return datasets.dataset_statistics(quality.judged(rows, "o").where("reject_reason IS NULL"))


@query("""SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY md5('42|' || doc_id::VARCHAR), doc_id) <= floor(count(*) OVER () * 0.9) THEN 'train' ELSE 'validation' END AS split FROM documents""")
def dataset_split(spark: SparkSession, d: str) -> DataFrame:
    return datasets.split(table(spark, d, "documents").select("doc_id"), "doc_id")


@query("""SELECT source, NULL AS lang, count(*) AS n FROM documents GROUP BY source UNION ALL SELECT NULL, lang, count(*) FROM documents GROUP BY lang UNION ALL SELECT NULL, NULL, count(*) FROM documents""")
def ingestion_stats(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select(F.col("source").alias("source_type"), F.col("lang").alias("outcome"))
    return datasets.ingestion_statistics(rows).select(F.col("source_type").alias("source"), F.col("outcome").alias("lang"), "n")


@query("""SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS n FROM documents) WHERE n = 1""")
def exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("h"))
    return dedup.first_of(rows, ["h"], "doc_id").select("doc_id")


@query("""SELECT doc_id FROM (SELECT doc_id, n_chars, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id DESC) AS n FROM documents) WHERE n = 1 AND n_chars > 500""")
def dedup_before_quality(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", "n_chars", F.sha2("text", 256).alias("h"))
    return dedup.first_then_quality(rows, F.col("n_chars") > 500, ["h"], F.desc("doc_id")).select("doc_id")


@query("""WITH n AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE / sqrt(list_sum(list_transform(embedding, lambda y: y::DOUBLE * y::DOUBLE)))) AS v FROM embeddings)
SELECT a.vec_id AS a, b.vec_id AS b, round(list_dot_product(a.v, b.v), 4) AS cosine FROM n a JOIN n b ON a.vec_id < b.vec_id WHERE list_dot_product(a.v, b.v) >= 0.4""")
def semantic_pairs(spark: SparkSession, d: str) -> DataFrame:
    return dedup.similar_pairs(table(spark, d, "embeddings"), 0.4).withColumn("cosine", F.round("cosine", 4))


@query("""WITH q AS (SELECT vec_id AS query, embedding AS e FROM embeddings WHERE vec_id % 100 = 0), r AS (SELECT query, vec_id, list_dot_product(e::DOUBLE[], embedding::DOUBLE[]) / sqrt(list_dot_product(e::DOUBLE[], e::DOUBLE[]) * list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS c FROM q JOIN embeddings ON vec_id <> query)
SELECT query, n AS rank, vec_id, round(c, 4) AS cosine FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY c DESC, vec_id) AS n FROM r) WHERE n <= 5""")
def memory_recall(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "embeddings")
    return sampling.nearest(v.where("vec_id % 100 = 0"), v).withColumn("cosine", F.round("cosine", 4))


_W = r"list_filter(regexp_split_to_array(lower(text), '\s+'), lambda w: w <> '')"


@query(f"""WITH w AS (SELECT doc_id, n_chars, {_W} AS w FROM documents), m AS (SELECT *, len(w) AS n, len(list_distinct(w)) AS types, len(list_distinct(list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1]))) AS pairs FROM w)
SELECT doc_id, round(CASE WHEN n_chars < 50 THEN n_chars / 50 WHEN n_chars > 1000 THEN 1000 / n_chars ELSE 1 END, 4) AS length_score, round(CASE WHEN n = 0 THEN 0 WHEN n = 1 THEN 1 ELSE (types / n + pairs / (n - 1)) / 2 END, 4) AS diversity FROM m""")
def quality_scores(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents")
    return t.select("doc_id", F.round(curation.length_score(F.col("text")), 4).alias("length_score"), F.round(curation.diversity_score(F.col("text")), 4).alias("diversity"))


@query(f"""WITH w AS (SELECT doc_id, unnest({_W}) AS w FROM documents), c AS (SELECT w, count(*) AS n FROM w GROUP BY 1), a AS (SELECT sum(n) AS a FROM c)
SELECT doc_id, round(ln(exp(-avg(ln(n / a)))), 4) AS log_perplexity FROM w JOIN c USING (w), a GROUP BY 1""")
def quality_perplexity(spark: SparkSession, d: str) -> DataFrame:
    rows = curation.unigram_perplexity(table(spark, d, "documents"), "doc_id", "text")
    return rows.select("doc_id", F.round(F.log("perplexity"), 4).alias("log_perplexity"))


@query(f"""WITH g AS (SELECT doc_id, list_distinct(list_transform(range(1, greatest(len(w) - 12, 0) + 1), lambda i: array_to_string(w[i : i + 12], ' '))) AS g FROM (SELECT doc_id, {_W} AS w FROM documents)),
b AS (SELECT DISTINCT unnest(list_transform(range(1, greatest(len(w) - 12, 0) + 1), lambda i: array_to_string(w[i : i + 12], ' '))) AS x FROM (SELECT {_W} AS w FROM benchmark)),
h AS (SELECT doc_id, count(*) AS m FROM (SELECT doc_id, unnest(g) AS x FROM g) JOIN b USING (x) GROUP BY 1)
SELECT doc_id, coalesce(m, 0) AS matched, len(g) AS total, round(CASE WHEN len(g) > 0 THEN coalesce(m, 0) / len(g) ELSE 0 END, 6) AS ratio, coalesce(m, 0) / greatest(len(g), 1) >= 0.3 AS contaminated FROM g LEFT JOIN h USING (doc_id)""")
def ngram_contamination(spark: SparkSession, d: str) -> DataFrame:
    rows = curation.ngram_contamination(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return rows.withColumn("ratio", F.round("ratio", 6))


@query(r"""SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, 'https?://[^\s<>"]+', '<URL>', 'g'), '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}', '<EMAIL>', 'g'), '[ \t]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g')) AS digest FROM documents""")
def normalised_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.md5(curation.normalised_text(F.col("text"))).alias("digest"))


@query("""SELECT conv_id, count(*) AS turns, md5(string_agg(role || ':' || text, chr(10) ORDER BY turn)) AS digest FROM conversations GROUP BY 1""")
def conversation_messages(spark: SparkSession, d: str) -> DataFrame:
    m = curation.conversation_messages(table(spark, d, "conversations"))
    text = F.array_join(F.transform("messages", lambda x: F.concat_ws(":", x["role"], x["content"])), "\n")
    return m.select("conv_id", F.col("turns").cast("long"), F.md5(text).alias("digest"))


@query("""SELECT doc_id, round(least(1, length(text) / 512), 6) AS difficulty, (length(text) // 4)::BIGINT AS tokens, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> ''))::BIGINT AS words FROM documents""".replace("\\\\", "\\"))
def text_measures(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", F.round(S.length_difficulty(t), 6).alias("difficulty"), S.token_estimate(t).alias("tokens"), S.word_count(t).cast("long").alias("words"))


@query(r"""SELECT doc_id, round(CASE WHEN length(trim(text, E' \n\t')) = 0 THEN 0.0 WHEN length(text) < 10 THEN 0.3 ELSE 0.7 - CASE WHEN len(string_split(text, '...')) - 1 > 3 OR len(string_split(text, '?')) - 1 > 5 THEN 0.2 ELSE 0 END - CASE WHEN regexp_matches(text, '(\.\.\.|,|and|but|or)$') THEN 0.1 ELSE 0 END END, 4) AS score FROM documents""")
def response_scores(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.round(S.response_score(F.col("text")), 4).alias("score"))


@query(r"""WITH s AS (SELECT doc_id, text, len(list_filter(regexp_split_to_array(text, '[.!?]+'), lambda x: length(regexp_replace(x, '^\s+|\s+$', '', 'g')) > 20)) AS n FROM documents)
SELECT doc_id, round(CASE WHEN length(text) = 0 THEN 0.0 WHEN length(text) < 200 THEN 0.1 WHEN n < 2 THEN 0.2 ELSE 0.5 + least(0.2, length(text) / 10000) + least(0.15, n / 50) END, 4) AS quality FROM s""")
def page_quality(spark: SparkSession, d: str) -> DataFrame:
    """No document has code or boilerplate signs, so the oracle leaves those terms out."""
    return table(spark, d, "documents").select("doc_id", F.round(S.page_quality(F.col("text")), 4).alias("quality"))


@query(r"""WITH u AS (SELECT page_id, url, regexp_extract(url, '^(\w+)://([^/?#]+)', 2) AS host, regexp_extract(url, '^(\w+)://', 1) AS scheme, regexp_extract(url, '^\w+://[^/?#]+([^?#]*)', 1) AS path FROM pages),
p AS (SELECT *, regexp_replace(host, '^www\.', '') AS bare FROM u)
SELECT page_id, CASE WHEN scheme <> 'https' THEN 'not_https' WHEN bare = 'spam-farm.example.org' OR bare LIKE '%.spam-farm.example.org' THEN 'domain_blocked' WHEN NOT (bare = 'example.com' OR bare LIKE '%.example.com' OR bare = 'example.net' OR bare LIKE '%.example.net') THEN 'unknown_domain'
WHEN (bare = 'example.net' OR bare LIKE '%.example.net') AND starts_with(path, '/de/') THEN 'path_restricted' END AS reason FROM p""")
def url_policy(spark: SparkSession, d: str) -> DataFrame:
    policy = spark.createDataFrame(
        [("spam-farm.example.org", "blocked", [], []), ("example.com", "trusted", [], []), ("example.net", "trusted", [], ["/de/"])], "domain string, verdict string, allowed_paths array<string>, blocked_paths array<string>"
    )
    return web.validated(table(spark, d, "pages").select("page_id", "url"), policy).select("page_id", "reason")


@query(r"""SELECT page_id, CASE WHEN regexp_matches(lower(url), '/docs/|documentation') THEN 'documentation' WHEN regexp_matches(lower(url), '/tutorial|/learn') THEN 'tutorial' WHEN regexp_matches(lower(url), '/api|/reference') THEN 'api_reference' WHEN regexp_matches(lower(url), '/blog/|/posts/') THEN 'blog_post' ELSE 'unknown' END AS kind FROM pages""")
def page_content_type(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", web.content_type(F.col("url")).alias("kind"))


@query(r"""WITH s AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<noscript\b.*?</noscript\s*>|<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g') AS t FROM pages) SELECT page_id, md5(t) AS digest FROM s""")
def page_stripped_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", F.md5(web.stripped_text(F.col("html"))).alias("digest"))


@query()
def page_compliance(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "pages").select("page_id", "url", "html", web.stripped_text(F.col("html")).alias("text"), F.when(F.col("page_id") % 50 == 7, 403).otherwise(200).alias("http_status"))
    return web.compliance(p, flag_copyright=True).select("page_id", "violations", "verdict", "confidence")


@query()
def page_structure(spark: SparkSession, d: str) -> DataFrame:
    s = web.structured(table(spark, d, "pages"))
    return s.select("page_id", "title", F.size("sections").alias("sections"), F.size("links").alias("links"), F.length("markdown").alias("chars"), F.round(S.extract_quality(F.col("text"), F.size("code_blocks"), F.size("sections")), 4).alias("quality"))


@query()
def page_chunks(spark: SparkSession, d: str) -> DataFrame:
    s = web.structured(table(spark, d, "pages"), "text").select("page_id", F.posexplode(web.chunked(F.col("text"))).alias("chunk", "text"))
    return s.select("page_id", "chunk", F.length("text").alias("chars"), S.strategies(F.col("text"), F.lit(False)).alias("strategies"))


@query("""SELECT coalesce(lang, '') AS topic, substr(md5(lang), 1, 12) AS topic_id, count(*) AS frequency, round(0.4 * 0.8 + 0.3 * least(1, ln(count(*) + 1) / 5) + 0.2 * greatest(0, 1 - 3 / 30) + 0.1 * 0.7, 4) AS priority FROM documents GROUP BY lang""")
def topic_priorities(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "documents").groupBy("lang").agg(F.count("*").alias("frequency"))
    p = S.topic_priority(F.lit(0.8), F.col("frequency"), F.lit(3), F.lit("user_question"))
    return g.select(F.coalesce("lang", F.lit("")).alias("topic"), short_md5(F.col("lang")).alias("topic_id"), "frequency", F.round(p, 4).alias("priority"))


@query("""SELECT quality, toxic, count(*) AS n, round(avg(n_chars), 4) AS chars FROM documents JOIN labels USING (doc_id) GROUP BY 1, 2""")
def labelled_documents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id").groupBy("quality", "toxic").agg(F.count("*").alias("n"), F.round(F.avg("n_chars"), 4).alias("chars"))


@query(r"""SELECT conv_id, turn, round(0.15 * least(1, length(text) / 500) + 0.30 * 0.5 + 0.20 * least(1, ((contains(l, 'function'))::INT + contains(l, 'class')::INT + contains(l, 'implement')::INT + contains(l, 'code')::INT + contains(l, 'script')::INT + contains(l, 'program')::INT) / 3)
+ 0.10 * least(1, (contains(l, 'first')::INT + contains(l, 'then')::INT + contains(l, 'next')::INT + contains(l, 'finally')::INT + contains(l, 'step')::INT + contains(l, 'process')::INT) / 4), 4) AS complexity FROM (SELECT *, lower(text) AS l FROM conversations WHERE role = 'user')""")
def prompt_complexity(spark: SparkSession, d: str) -> DataFrame:
    """The conversations have neither technical terms nor question forms, so the oracle has no terms for them."""
    t = table(spark, d, "conversations").where("role = 'user'")
    return t.select("conv_id", "turn", F.round(S.prompt_complexity(F.col("text")), 4).alias("complexity"))


@query(r"""SELECT doc_id, md5(regexp_replace(text, '^\s+|\s+$', '', 'g')) AS digest FROM documents""")
def stripped_documents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.md5(strip(F.col("text"))).alias("digest"))
