"""Interactions to training examples, and between example formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scores as S
from ..schemas import EXAMPLE, conform

MESSAGE = "struct<role:string,content:string>"


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def target() -> Column:
    """What the assistant should have said."""
    return F.when(F.col("is_correction") & (F.coalesce("correction_improved", F.lit("")) != ""), F.col("correction_improved")).otherwise(F.col("assistant_output"))


def usable(df: DataFrame) -> DataFrame:
    return df.where((F.coalesce("user_input", F.lit("")) != "") & (F.coalesce("assistant_output", F.lit("")) != ""))


def _common(df: DataFrame, kind: str) -> DataFrame:
    return df.withColumns({"format_type": F.lit(kind), "source_id": F.col("id"), "is_synthetic": F.lit(False)})


def truncated_messages(messages: Column, budget: int) -> Column:
    """System and last two messages stay; earlier ones are kept from the newest while they fit, in that order."""
    tokens = lambda m: F.floor(F.length(m["content"]) / 4).cast("int")
    total = F.aggregate(messages, F.lit(0), lambda a, m: a + tokens(m))
    system = F.filter(F.slice(messages, 1, 1), lambda m: m["role"] == "system")
    rest = F.slice(messages, F.size(system) + 1, F.size(messages))
    last = F.when(F.size(rest) >= 2, F.slice(rest, -2, 2)).otherwise(rest)
    earlier = F.reverse(F.when(F.size(rest) > 2, F.slice(rest, 1, F.size(rest) - 2)).otherwise(F.array().cast(f"array<{MESSAGE}>")))
    left = F.lit(budget) - F.aggregate(F.concat(system, last), F.lit(0), lambda a, m: a + tokens(m))
    start = F.struct(left.cast("int").alias("left"), F.array().cast(f"array<{MESSAGE}>").alias("kept"))
    kept = F.aggregate(
        earlier, start, lambda s, m: F.when(s["left"] >= tokens(m), F.struct((s["left"] - tokens(m)).alias("left"), F.concat(s["kept"], F.array(m)).alias("kept"))).otherwise(s), lambda s: s["kept"]
    )
    return F.when(total <= budget, messages).otherwise(F.concat(system, kept, last))


def chatml(df: DataFrame, system_prompt: str | None = None, max_turns: int = 5, max_tokens: int = 4096) -> DataFrame:
    system = F.concat_ws("\n\n", F.lit(system_prompt), F.when(F.coalesce("system_context", F.lit("")) != "", F.concat(F.lit("Context: "), "system_context")))
    first = F.when(system != "", F.array(message("system", system))).otherwise(F.array().cast(f"array<{MESSAGE}>"))
    turns = F.coalesce("previous_turns", F.array().cast("array<struct<user:string,assistant:string>>"))
    turns = F.when(F.size(turns) > max_turns, F.slice(turns, -max_turns, max_turns)).otherwise(turns)
    history = F.filter(F.flatten(F.transform(turns, lambda t: F.array(message("user", t["user"]), message("assistant", t["assistant"])))), lambda m: m["content"].isNotNull())
    messages = F.concat(first, history, F.array(message("user", F.col("user_input")), message("assistant", target())))
    cut = lambda m: F.when(S.message_tokens(m) > max_tokens, truncated_messages(m, max_tokens)).otherwise(m)
    measured = lambda m: F.struct(m.alias("messages"), S.message_tokens(m).alias("estimated_tokens"))
    # Messages are made once: neither a later filter nor a later column puts them together again.
    made = F.transform(F.transform(F.array(messages), cut), measured)
    out = _common(usable(df), "chatml").select("*", F.inline(made))
    return conform(out, EXAMPLE)


def _shortened(text: Column, tokens: Column) -> Column:
    return F.when(F.length(text) <= tokens * 4, text).otherwise(F.concat(F.substring(text, F.lit(1), (tokens * 4 - 3).cast("int")), F.lit("...")))


def alpaca(df: DataFrame, system_prompt: str | None = None, with_context: bool = True, max_tokens: int = 2048) -> DataFrame:
    hints = F.filter(F.coalesce("tags", F.array().cast("array<string>")), lambda t: ~t.startswith("event:") & ~t.startswith("response:"))
    task = (
        F.when((F.col("source_type") == "feedback") & F.col("is_correction"), "The following is a corrected interaction. Learn from the improved response.")
        .when(F.col("source_type") == "auth_record", "Respond appropriately to this authentication-related request.")
        .when(F.col("source_type") == "telemetry", "Respond to the user's request based on the given context.")
    )
    built = F.concat_ws("\n", F.lit(system_prompt), task, F.when(F.size(hints) > 0, F.concat(F.lit("Context tags: "), F.array_join(hints, ", "))))
    instruction = F.when(built != "", built).otherwise("Respond to the user's request.")
    asked = F.when(F.lit(with_context) & (F.coalesce("system_context", F.lit("")) != ""), F.concat_ws("\n\n", "system_context", "user_input")).otherwise(F.col("user_input"))
    out = _common(usable(df), "alpaca").withColumns({"instruction": instruction, "input_text": asked, "output_text": target()})
    estimate = S.token_estimate(F.col("instruction"), F.col("input_text"), F.col("output_text"))
    left = F.lit(max_tokens) - F.floor(F.length("instruction") / 4)
    half = F.floor(left / 2)
    out = out.withColumns({
        "input_text": F.when(estimate > max_tokens, _shortened(F.col("input_text"), half)).otherwise(F.col("input_text")),
        "output_text": F.when(estimate > max_tokens, _shortened(F.col("output_text"), left - half)).otherwise(F.col("output_text")),
    })
    return conform(out.withColumn("estimated_tokens", estimate), EXAMPLE)


def raw_text(df: DataFrame, system_token: str = "<|system|>", user_token: str = "<|user|>", assistant_token: str = "<|assistant|>") -> DataFrame:
    text = F.concat_ws(
        "\n", F.when(F.coalesce("system_context", F.lit("")) != "", F.concat_ws("\n", F.lit(system_token), "system_context")),
        F.concat_ws("\n", F.lit(user_token), "user_input"), F.concat_ws("\n", F.lit(assistant_token), target()),
    )
    return conform(_common(usable(df), "raw").withColumn("output_text", text).withColumn("estimated_tokens", S.token_estimate(F.col("output_text"))), EXAMPLE)


#: How good an outcome is.
OUTCOME_ORDER = {"positive_feedback": 5, "success": 4, "engaged": 3, "partial": 2, "unknown": 1, "deferred": 0, "dismissed": -1, "failure": -2, "negative_feedback": -3}


def outcome_rank(outcome: Column) -> Column:
    out = F.lit(0)
    for name, rank in OUTCOME_ORDER.items():
        out = F.when(outcome == name, rank).otherwise(out)
    return out


def preferences_from_corrections(df: DataFrame, system_prompt: str | None = None) -> DataFrame:
    rows = df.where("is_correction AND coalesce(correction_original, '') <> '' AND coalesce(correction_improved, '') <> ''")
    prompt = F.concat_ws("\n", F.lit(f"<|system|>\n{system_prompt}" if system_prompt else None), F.concat(F.lit("<|user|>\n"), F.coalesce("user_input", F.lit(""))), F.lit("<|assistant|>\n"))
    out = _common(rows, "preference").withColumns({"prompt": prompt, "chosen": F.col("correction_improved"), "rejected": F.col("correction_original")})
    return conform(out.withColumn("estimated_tokens", S.token_estimate(F.col("prompt"), F.col("chosen"), F.col("rejected"))), EXAMPLE)


def preferences_from_pairs(df: DataFrame, *order: str) -> DataFrame:
    """Rows of the same input pair up in order, 1 with 2, 3 with 4; the better outcome is chosen, of equal ones the earlier."""
    rows = df.where("NOT is_correction AND coalesce(user_input, '') <> ''")
    number = F.row_number().over(Window.partitionBy("user_input").orderBy(*order))
    rank = F.struct(outcome_rank(F.col("outcome")).alias("rank"), F.col("confidence"))
    rows = rows.withColumns({"n": number, "rank": rank})
    row = F.struct("n", "rank", "id", "assistant_output", "quality_score", "source_type")
    pairs = rows.groupBy("user_input", F.floor((F.col("n") - 1) / 2).alias("pair")).agg(F.min(row).alias("a"), F.max(row).alias("b"), F.count("*").alias("size")).where("size = 2")
    later = F.col("b.rank") > F.col("a.rank")
    out = pairs.select(
        F.lit("preference").alias("format_type"), F.concat(F.lit("<|user|>\n"), "user_input", F.lit("\n<|assistant|>\n")).alias("prompt"), F.when(later, F.col("b.assistant_output")).otherwise(F.col("a.assistant_output")).alias("chosen"),
        F.when(later, F.col("a.assistant_output")).otherwise(F.col("b.assistant_output")).alias("rejected"), ((F.col("a.quality_score") + F.col("b.quality_score")) / 2).alias("quality_score"),
        F.col("b.id").alias("source_id"), F.col("b.source_type").alias("source_type"), F.lit(False).alias("is_correction"), F.lit(False).alias("is_synthetic"),
    ).where("coalesce(chosen, '') <> '' AND coalesce(rejected, '') <> '' AND chosen <> rejected")
    return conform(out.withColumn("estimated_tokens", S.token_estimate(F.col("prompt"), F.col("chosen"), F.col("rejected"))), EXAMPLE)


def last_message(messages: Column, role: str) -> Column:
    return F.try_element_at(F.filter(messages, lambda m: m["role"] == role), F.lit(-1))["content"]


def to_alpaca(df: DataFrame) -> DataFrame:
    """ChatML examples as instruction, input and output; the last message of a role counts."""
    m = F.col("messages")
    return df.withColumns({"instruction": F.coalesce(last_message(m, "system"), F.lit("")), "input_text": F.coalesce(last_message(m, "user"), F.lit("")), "output_text": F.coalesce(last_message(m, "assistant"), F.lit("")), "format_type": F.lit("alpaca")})


def to_chatml(df: DataFrame) -> DataFrame:
    parts = F.array(message("system", F.col("instruction")), message("user", F.col("input_text")), message("assistant", F.col("output_text")))
    return df.withColumns({"messages": F.filter(parts, lambda m: F.coalesce(m["content"], F.lit("")) != ""), "format_type": F.lit("chatml")})


def training_text(messages: Column, terminator: str = "</s>") -> Column:
    """A role header for each turn, then a terminator."""
    return F.concat(F.array_join(F.transform(messages, lambda m: F.concat(F.lit("<|"), m["role"], F.lit("|>\n"), m["content"])), "\n"), F.lit(terminator))


def rendered(df: DataFrame) -> Column:
    """An example as text for a judge, by its format."""
    chat = F.array_join(F.transform("messages", lambda m: F.concat(F.upper(F.substring(m["role"], 1, 1)), F.substring(m["role"], 2, 100), F.lit(": "), m["content"])), "\n\n")
    return (
        F.when(F.col("format_type") == "chatml", chat)
        .when(F.col("format_type") == "alpaca", F.concat_ws("\n\n", F.concat(F.lit("Instruction: "), "instruction"), F.concat(F.lit("Input: "), "input_text"), F.concat(F.lit("Output: "), "output_text")))
        .when(F.col("format_type") == "preference", F.concat_ws("\n\n", F.concat(F.lit("Prompt: "), "prompt"), F.concat(F.lit("Chosen: "), "chosen"), F.concat(F.lit("Rejected: "), "rejected")))
        .otherwise(F.to_json(F.struct(*df.columns)))
    )


def with_rewrite(df: DataFrame, rewritten: str = "rewritten") -> DataFrame:
    """The rewritten response in the last assistant message, the output or the chosen text."""
    n = F.array_max(F.transform("messages", lambda m, i: F.when(m["role"] == "assistant", i)))
    new = F.col(rewritten)
    return df.withColumns({
        "messages": F.transform("messages", lambda m, i: F.when(i == n, message("assistant", new)).otherwise(m)), "output_text": F.when(F.col("output_text").isNotNull(), new),
        "chosen": F.when(F.col("chosen").isNotNull(), new), "is_rewritten": F.lit(True),
    })


def experience_from_correction(df: DataFrame) -> DataFrame:
    """A streamed correction as an experience of raised quality."""
    return df.select(F.col("user_input").alias("prompt"), F.col("correction_original").alias("response"), F.col("correction_improved").alias("correction"), F.lit("correction").alias("feedback_type"), (F.col("quality_score") * 1.5).alias("reward"), F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"))


def preference_from_experience(df: DataFrame, most: int | None = None, *order: str) -> DataFrame:
    out = df.where("coalesce(correction, '') <> ''").select("id", "prompt", F.col("correction").alias("chosen"), F.col("response").alias("rejected"))
    return out.orderBy(*order).limit(most) if most else out
