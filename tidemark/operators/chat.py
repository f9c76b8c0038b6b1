"""Chat datasets: role and content normalisation, validity, rendering, target spans, hold-out split.

Two forms. Turn tables hold one row per turn (conv_id, turn, ...) and are never gathered per conversation, except
to render texts of bounded length. Record expressions work on one array column, where a record is one row already.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.ordered import cutoff_key, latest, order_rows, running_sum

# What opens a turn of each role in rendered text. What closes it is our choice.
OPENERS = {"user": "<|turn>user\n", "model": "<|turn>model\n"}
CLOSER = "<turn|>\n"
LEADING_BOS = "<bos>"
IGNORED_LABEL = -1

KEYS = ("conv_id",)
#: Characters that one rendered text may have: a value must fit into a fraction of an executor.
MAX_CHARS = 100_000_000
#: Characters of a conversation in whose range the messages of one part begin.
PART_CHARS = 1_000_000


# --------------------------------------------------------------------------- roles and content


def role_of(source: Column | None = None, role: Column | None = None) -> Column:
    """``user`` or ``model``; null for a role that is left out. ``from`` wins when a turn has both keys."""
    by_role = (
        F.lit(None).cast("string")
        if role is None
        else F.when(role == "user", "user").when(role.isin("assistant", "model"), "model")
    )
    if source is None:
        return by_role
    by_source = F.when(source == "human", "user").when(source.isin("gpt", "assistant", "model"), "model")
    return F.when(source.isNotNull(), by_source).otherwise(by_role)


def lenient_role(source: Column) -> Column:
    """``human`` is the user, everything else the model."""
    return F.when(source == "human", "user").otherwise("model")


def standard_role(source: Column) -> Column:
    """from/value roles under their role/content names, nothing left out."""
    return F.when(source == "human", "user").when(source == "gpt", "assistant").otherwise(source)


def content_text(content: Column, null_text: str | None = "None") -> Column:
    """Text of a JSON content value: a string as it is, a list as its text parts joined by one blank.

    Other values give their JSON text; JSON null gives ``null_text``.
    """
    parts = F.from_json(content, "array<string>")
    text_parts = F.filter(parts, lambda p: F.get_json_object(p, "$.type") == "text")
    joined = F.array_join(F.transform(text_parts, lambda p: F.coalesce(F.get_json_object(p, "$.text"), F.lit(""))), " ")
    scalar = F.get_json_object(F.concat(F.lit('{"c":'), content, F.lit("}")), "$.c")
    return F.when(F.ltrim(content).startswith("["), joined).otherwise(F.coalesce(scalar, F.lit(null_text)))


def variant_text(content: Column) -> Column:
    """``content_text`` of a variant as the JSON reader makes it of a string, a list or anything else."""
    return F.when(content.isNotNull(), content_text(F.to_json(content)))


def has_text(text: Column) -> Column:
    return text.rlike(r"(?U)\S")


# --------------------------------------------------------------------------- turn tables


def normalise(turns: DataFrame, role: Column, text: Column, order: str = "turn") -> DataFrame:
    """Turns as (conv_id, turn, role, text) with roles ``user`` and ``model``; other roles are left out."""
    out = turns.select(*KEYS, order, role.alias("role"), text.alias("text"))
    return out.filter(F.col("role").isNotNull())


def without_blank(messages: DataFrame) -> DataFrame:
    return messages.filter(has_text(F.col("text")))


def conversation_facts(
    turns: DataFrame, role: Column, text: Column, malformed: Column | None = None, order: str = "turn"
) -> DataFrame:
    """One row per conversation: messages left after dropping turns, and whether it is valid.

    Valid means: no malformed turn, at least two messages, the first from the user, strictly alternating.
    Each message is compared with the role of the message before it, so a conversation of any length is
    checked without gathering it.
    """
    rows = turns.select(
        *KEYS,
        order,
        F.when(has_text(text), role).alias("_role"),
        (F.lit(False) if malformed is None else malformed).alias("_malformed"),
    )
    rows = order_rows(rows, KEYS, [order], cuts_from=turns).scan(_before=latest("_role", inclusive=False)).rows()
    repeats = F.col("_role") == F.coalesce("_before", F.lit("model"))
    out = rows.groupBy(*KEYS).agg(
        F.count("_role").alias("n_messages"),
        F.coalesce(F.bool_or(repeats), F.lit(False)).alias("repeats"),
        F.bool_or("_malformed").alias("malformed"),
    )
    return out.withColumn("valid", (F.col("n_messages") >= 2) & ~F.col("repeats") & ~F.col("malformed"))


def dataset_counts(facts: DataFrame) -> DataFrame:
    return facts.agg(
        F.count(F.lit(1)).alias("raw_size"),
        F.count_if("valid").alias("size"),
        F.count_if(~F.col("valid")).alias("filtered_out"),
    )


def valid_messages(messages: DataFrame, facts: DataFrame) -> DataFrame:
    return messages.join(facts.filter("valid").select(*KEYS), list(KEYS), "left_semi")


def segment(role: Column, text: Column, openers: dict[str, str] = OPENERS, closer: str = CLOSER) -> Column:
    """Rendered form of one message."""
    return F.concat(opener(role, openers), text, F.lit(closer))


def opener(role: Column, openers: dict[str, str] = OPENERS) -> Column:
    out = F.lit(None).cast("string")
    for name, opening in openers.items():
        out = F.when(role == name, opening).otherwise(out)
    return out


def without_bos(text: Column, bos: str = LEADING_BOS) -> Column:
    return F.when(text.startswith(bos), F.substring(text, len(bos) + 1, 2**31 - 1)).otherwise(text)


def rendered(messages: DataFrame, order: str = "turn", max_chars: int = MAX_CHARS) -> DataFrame:
    """Text of each conversation as (conv_id, n_chars, text), one row each.

    A conversation of more than ``max_chars`` characters cannot be one value; it is listed with its length and no
    text, and its messages are never gathered. ``rendered_parts`` has the text of any conversation.
    """
    rows = messages.select(*KEYS, order, segment(F.col("role"), F.col("text")).alias("_segment"))
    sizes = rows.groupBy(*KEYS).agg(F.sum(F.length("_segment")).alias("n_chars"))
    large = sizes.filter(F.col("n_chars") > max_chars)
    texts = rows.join(large, list(KEYS), "left_anti").groupBy(*KEYS).agg(
        F.array_sort(F.collect_list(F.struct(order, "_segment"))).alias("_all")
    )
    text = without_bos(F.array_join(F.transform("_all", lambda s: s["_segment"]), ""))
    short = texts.select(*KEYS, text.alias("text"))
    return short.select(*KEYS, F.length("text").cast("bigint").alias("n_chars"), "text").unionByName(
        large.select(*KEYS, "n_chars", F.lit(None).cast("string").alias("text"))
    )


def rendered_parts(
    messages: DataFrame, order: str = "turn", part_chars: int = PART_CHARS, cuts_from: DataFrame | None = None
) -> DataFrame:
    """The text of each conversation as ordered parts (conv_id, part, start, text), of any length in all.

    A part holds the whole messages that begin within its ``part_chars`` characters of the conversation; a part without a
    beginning is left out. Joined in order, the parts are the text of ``rendered``. Only a part is ever gathered.
    """
    rows = messages.select(*KEYS, order, segment(F.col("role"), F.col("text")).alias("_segment"))
    rows = rows.withColumn("_length", F.length("_segment"))
    rows = order_rows(rows, KEYS, [order], cuts_from=cuts_from).scan(_start=running_sum("_length", inclusive=False)).rows()
    rows = rows.withColumn("part", F.floor(F.col("_start") / F.lit(part_chars)).cast("bigint"))
    parts = rows.groupBy(*KEYS, "part").agg(
        F.min("_start").alias("start"), F.array_sort(F.collect_list(F.struct("_start", "_segment"))).alias("_all")
    )
    text = F.array_join(F.transform("_all", lambda s: s["_segment"]), "")
    text = F.when(F.col("start") == 0, without_bos(text)).otherwise(text)
    return parts.select(*KEYS, "part", "start", text.alias("text"))


def target_spans(messages: DataFrame, order: str = "turn", cuts_from: DataFrame | None = None) -> DataFrame:
    """Character spans of each message in the rendered text: opener, then body; only model bodies are targets."""
    rows = messages.withColumns(
        {
            "_opener": F.length(opener(F.col("role"))),
            "_length": F.length(segment(F.col("role"), F.col("text"))),
        }
    )
    before = running_sum("_length", inclusive=False)
    rows = order_rows(rows, KEYS, [order], cuts_from=cuts_from).scan(_start=before).rows()
    body = F.col("_start") + F.col("_opener")
    spans = F.array(
        F.struct(F.col("_start").alias("span_start"), body.alias("span_end"), F.lit(False).alias("is_target")),
        F.struct(
            body.alias("span_start"),
            (F.col("_start") + F.col("_length")).alias("span_end"),
            (F.col("role") == "model").alias("is_target"),
        ),
    )
    return rows.select(*KEYS, order, F.inline(spans))


def masked_labels(tokens: DataFrame, spans: DataFrame) -> DataFrame:
    """Labels of the tokens (conv_id, pos, char_start, token_id): the token inside target spans, else the ignored label.

    Each token starts in exactly one span. Spans and tokens are put in one order and the span opened last decides,
    which needs no range join.
    """
    opened = spans.select(
        *KEYS, F.col("span_start").alias("_at"), F.lit(0).alias("_kind"), F.lit(-1).cast("bigint").alias("pos"),
        F.lit(None).cast("int").alias("token_id"), F.col("is_target").alias("_target"),
    )
    placed = tokens.select(
        *KEYS, F.col("char_start").cast("bigint").alias("_at"), F.lit(1).alias("_kind"), F.col("pos").cast("bigint"),
        F.col("token_id").cast("int"), F.lit(None).cast("boolean").alias("_target"),
    )
    rows = order_rows(opened.union(placed), KEYS, ["_at", "_kind", "pos"]).scan(_in=latest("_target")).rows()
    label = F.when(F.coalesce("_in", F.lit(False)), F.col("token_id")).otherwise(F.lit(IGNORED_LABEL))
    return rows.filter("_kind = 1").select(*KEYS, "pos", "token_id", label.alias("label"))


def prompt_response(turns: DataFrame, text: str = "text", order: str = "turn") -> DataFrame:
    """Texts of the turns numbered 0 and 1."""
    return turns.groupBy(*KEYS).agg(
        F.max(F.when(F.col(order) == 0, F.col(text))).alias("prompt"),
        F.max(F.when(F.col(order) == 1, F.col(text))).alias("response"),
    )


def size_band(n: Column) -> Column:
    """Guidance for a dataset of ``n`` records. Between 100 and 999 there is none."""
    return (
        F.when(n < 100, "below 100")
        .when(n.between(1000, 5000), "1000 to 5000")
        .when(n > 5000, "above 5000")
        .otherwise("unspecified")
    )


def holdout(df: DataFrame, key: str, seed: int, share: float = 0.8) -> DataFrame:
    """Exact seeded split in a column ``part``: the first ``int(share * n)`` rows in a hashed order train, the rest test.

    Only the key at the border is computed; the rows themselves are not ordered.
    """
    mix = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    keys = df.select(mix.alias("_mix"), key)
    last = cutoff_key(keys, ["_mix", key], F.lit(1), int(keys.count() * share), early=False)
    if last is None or last == ():
        return df.withColumn("part", F.lit("test" if last == () else "train"))
    border = F.struct(F.lit(last[0]).alias("_mix"), F.lit(last[1]).cast(df.schema[key].dataType).alias(key))
    return df.withColumn("part", F.when(F.struct(mix.alias("_mix"), key) <= border, "train").otherwise("test"))


# --------------------------------------------------------------------------- records: one array column


def record_messages(conversations: Column, content: Callable[[Column], Column] = lambda c: c) -> Column:
    """Messages of a from/value or role/content record; null when a turn has neither key.

    Turns are structs with the fields from, value, role and content, of which ``content`` makes text.
    """
    messages = F.transform(
        conversations,
        lambda t: F.struct(
            role_of(t["from"], t["role"]).alias("role"),
            F.coalesce(F.when(t["from"].isNotNull(), t["value"]).otherwise(content(t["content"])), F.lit("")).alias("text"),
        ),
    )
    usable = F.filter(messages, lambda m: m["role"].isNotNull() & has_text(m["text"]))
    return F.when(~F.exists(conversations, lambda t: t["from"].isNull() & t["role"].isNull()), usable)


def record_is_valid(messages: Column) -> Column:
    """At least two messages, the user first, strictly alternating."""
    letters = F.array_join(F.transform(messages, lambda m: F.left(m["role"], F.lit(1))), "")
    return F.coalesce(letters.rlike("^(um)+u?$"), F.lit(False))


def record_text(messages: Column) -> Column:
    """Rendered text of a valid record, null otherwise."""
    text = F.array_join(F.transform(messages, lambda m: segment(m["role"], m["text"])), "")
    return F.when(record_is_valid(messages), without_bos(text))


def lenient_record(conversations: Column) -> Column:
    return F.transform(
        conversations, lambda t: F.struct(lenient_role(t["from"]).alias("role"), t["value"].alias("text"))
    )


def record_problem(conversations: Column) -> Column:
    """Why a from/value record cannot be used, null when it can."""
    complete = F.forall(conversations, lambda t: t["from"].isNotNull() & t["value"].isNotNull())
    return (
        F.when(conversations.isNull(), "no conversations")
        .when(F.size(conversations) == 0, "no turns")
        .when(~complete, "turn without from or value")
    )


def line_problem(line: Column) -> Column:
    """Why a raw line of from/value records cannot be used, bad syntax included; null when it can."""
    parsed = F.from_json(line, "conversations array<struct<from: string, value: string>>, _bad string", {"columnNameOfCorruptRecord": "_bad"})
    problem = record_problem(parsed["conversations"])
    return F.when(parsed["_bad"].isNotNull() | F.try_parse_json(line).isNull(), "not JSON").otherwise(problem)
