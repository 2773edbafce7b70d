"""Topic discovery and the topic work queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import short_md5
from ..functions.scores import topic_priority

#: Families of terms and questions that name a topic.
FAMILIES = {
    "python_module": r"(?i)\b(asyncio|typing|pathlib|dataclass(?:es)?|logging|collections|itertools|functools|contextlib|multiprocessing|threading|concurrent|subprocess|json|pickle|sqlite3|urllib|requests|aiohttp)\b",
    "ml_term": r"(?i)\b(transformer|attention|embedding|tokeniz\w+|fine[- ]?tun\w+|lora|qlora|gguf|llama|gpt|bert|diffusion|stable[- ]?diffusion|vae|gan|backprop\w*|gradient|optimizer|loss|epoch|batch)\b",
    "web_tech": r"(?i)\b(react|vue|angular|svelte|next\.?js|nuxt|fastapi|flask|django|express|graphql|rest|websocket|http/?\d?|oauth|jwt|cors)\b",
    "devops": r"(?i)\b(docker|kubernetes|k8s|terraform|ansible|aws|gcp|azure|cloudrun|lambda|ec2|s3|ci/?cd|github[- ]?actions|jenkins)\b",
    "how_to": r"(?i)how (?:do|can|to|should) (?:I|we|you) (\w+(?:\s+\w+){0,3})",
    "what_is": r"(?i)what (?:is|are|does) (?:a |an |the )?(\w+(?:\s+\w+){0,2})",
}
#: Documentation pages by tag.
DOCUMENTATION = {
    "python": "https://docs.python.org/3/library/%s.html", "react": "https://react.dev/reference/react/%s", "typescript": "https://www.typescriptlang.org/docs/handbook/%s.html",
    "rust": "https://doc.rust-lang.org/std/%s/index.html", "go": "https://pkg.go.dev/%s", "node": "https://nodejs.org/api/%s.html", "fastapi": "https://fastapi.tiangolo.com/%s/",
    "pytorch": "https://pytorch.org/docs/stable/%s.html", "huggingface": "https://huggingface.co/docs/transformers/main/en/%s",
}


def mentions(events: DataFrame, text: str = "text") -> DataFrame:
    """(row's columns, family, name): the distinct names of at least three characters in each event."""
    found = F.concat(*[_family(text, f, p) for f, p in FAMILIES.items()])
    return events.withColumn("m", F.explode(F.array_distinct(found))).select("*", "m.family", "m.name").drop("m").where(F.length("name") >= 3)


def _family(text: str, family: str, pattern: str) -> Column:
    return F.transform(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(1)), lambda x: F.struct(F.lit(family).alias("family"), F.lower(F.trim(x)).alias("name")))


def discovered(found: DataFrame, now: Column, most: int, least: int = 2, min_confidence: float = 0.5) -> DataFrame:
    """Topics with frequency, confidence (the first one's, a little more for each other) and priority, the best first."""
    rows = found.groupBy("name").agg(
        F.count("*").alias("frequency"), F.min_by("confidence", "ts").alias("first_confidence"), F.min_by("source", "ts").alias("source"), F.max("ts").alias("last_seen"),
        F.array_sort(F.collect_set("family")).alias("tags"), F.slice(F.array_sort(F.collect_set(F.substring("text", 1, 100))), 1, 3).alias("samples"),
    )
    rows = rows.withColumn("confidence", F.least(F.lit(1.0), F.col("first_confidence") + 0.05 * (F.col("frequency") - 1)))
    rows = rows.where((F.col("frequency") >= least) & (F.col("confidence") >= min_confidence))
    days = F.floor((F.unix_timestamp(now) - F.unix_timestamp("last_seen")) / 86400)
    rows = rows.withColumns({"topic_id": short_md5(F.col("name")), "priority": topic_priority(F.col("confidence"), F.col("frequency"), days, F.col("source"))})
    return rows.orderBy(F.desc("priority"), "name").limit(most)


#: Pages for any web technology and for any topic.
WEB_REFERENCE, ANY_REFERENCE = "https://developer.mozilla.org/en-US/docs/Web/%s", "https://devdocs.io/#q=%s"


def documentation_urls(tags: Column, name: Column, most: int = 5) -> Column:
    """Pages by the first family that a topic has: the module's, those of two model libraries, the web's; then a search for the name."""
    slug, none = F.replace(F.lower(name), F.lit(" "), F.lit("-")), F.array().cast("array<string>")
    page = lambda template, of: F.format_string(template, of)
    special = (
        F.when(F.array_contains(tags, "python_module"), F.array(page(DOCUMENTATION["python"], F.lower(name))))
        .when(F.array_contains(tags, "ml_term"), F.array(page(DOCUMENTATION["huggingface"], slug), page(DOCUMENTATION["pytorch"], slug)))
        .when(F.array_contains(tags, "web_tech"), F.array(page(WEB_REFERENCE, slug))).otherwise(none)
    )
    return F.slice(F.concat(special, F.array(page(ANY_REFERENCE, slug))), 1, most)


def as_queue_topics(topics: DataFrame) -> DataFrame:
    level = F.when(F.col("priority") >= 0.8, 2).when(F.col("priority") >= 0.6, 3).otherwise(4)
    return topics.select("topic_id", F.col("name").alias("title"), F.lit("pending").alias("status"), level.alias("priority"), F.slice("samples", 1, 3).alias("samples"))


def pending(queue: DataFrame, limit: int) -> DataFrame:
    return queue.where("status = 'pending'").orderBy("priority", "created_at").limit(limit)


def dequeued(queue: DataFrame, limit: int, per_domain: int = 1) -> DataFrame:
    """The next pending topics, at most so many of a domain."""
    w = Window.partitionBy("domain").orderBy("priority", "created_at", "topic_id")
    rows = queue.where("status = 'pending'").withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= per_domain).drop("_n")
    return rows.orderBy("priority", "created_at", "topic_id").limit(limit)


def enqueued(queue: DataFrame, topics: DataFrame) -> DataFrame:
    return queue.unionByName(topics.join(queue.select("topic_id"), "topic_id", "left_anti"), allowMissingColumns=True)


def after_attempt(queue: DataFrame, outcomes: DataFrame, retries: int = 3) -> DataFrame:
    """Completed or, up to ``retries`` failures, pending again; then failed."""
    rows = queue.join(outcomes, "topic_id", "left")
    tries = F.coalesce("retry_count", F.lit(0)) + F.coalesce((~F.col("ok")).cast("int"), F.lit(0))
    status = F.when(F.col("ok").isNull(), F.col("status")).when(F.col("ok"), "completed").when(tries <= retries, "pending").otherwise("failed")
    return rows.withColumns({"status": status, "retry_count": tries}).drop("ok")


def queue_statistics(queue: DataFrame) -> DataFrame:
    return queue.groupBy("status").agg(F.count("*").alias("topics"), F.sum(F.coalesce("examples", F.lit(0))).alias("examples"))


def retained(queue: DataFrame, now: Column, completed_days: int = 30, failed_days: int = 7) -> DataFrame:
    age = F.datediff(now, "updated_at")
    return queue.where(~(((F.col("status") == "completed") & (age > completed_days)) | ((F.col("status") == "failed") & (age > failed_days))))
