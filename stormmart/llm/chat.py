"""Operator 5: preference formatting.

A pair is two conversations, chosen and rejected, as arrays of turns. Their
longest common prefix of turns is rendered once as the prompt; what follows in
each is its completion, with the spans that carry loss: text and end mark of
assistant turns. Columns per pair: ``prompt_turns``, ``prompt``, ``chosen``,
``rejected`` and the masks ``chosen_mask``, ``rejected_mask`` - spans
``start:length`` in characters of the completion, joined by commas; all other
characters are masked. DataFrame and SQL functions only.

Defined cases: rows without conversation id belong to no conversation and are
left out; exactly repeated rows are one turn; turns are ordered by turn (null
first), role and text; a null role or text is rendered as empty; two sides that
are equal have empty completions and ``usable`` false; an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: the chat template -----------------------------------------
TURN_OPEN = "<|im_start|>"
TURN_END = "<|im_end|>\n"
LEARNED_ROLE = "assistant"
# --- end of fixed values -------------------------------------------------------


def conversations_as_arrays(turns: DataFrame, key: str = "conv_id", out: str = "turns") -> DataFrame:
    """One row per conversation: its turns as a sorted array of (turn, role, text)."""
    return (turns.where(F.col(key).isNotNull())
            .groupBy(key)
            .agg(F.array_sort(F.collect_set(F.struct(
                F.coalesce(F.col("turn"), F.lit(-1 << 62)).alias("turn"),
                F.coalesce(F.col("role"), F.lit("")).alias("role"),
                F.coalesce(F.col("text"), F.lit("")).alias("text")))).alias(out)))


def _head(t: Column) -> Column:
    return F.concat(F.lit(TURN_OPEN), t["role"], F.lit("\n"))


def render(turns: Column) -> Column:
    """Turns as one text in the chat template."""
    return F.array_join(F.transform(
        turns, lambda t: F.concat(_head(t), t["text"], F.lit(TURN_END))), "")


def loss_spans(turns: Column) -> Column:
    """Spans of the rendered turns that carry loss, as ``start:length,...``."""
    empty = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        head = F.length(_head(t)).cast("long")
        body = (F.length(t["text"]) + len(TURN_END)).cast("long")
        span = F.concat_ws(":", (acc["at"] + head).cast("string"), body.cast("string"))
        return F.struct(
            (acc["at"] + head + body).alias("at"),
            F.when(t["role"] != LEARNED_ROLE, acc["spans"])
            .when(acc["spans"] == "", span)
            .otherwise(F.concat_ws(",", acc["spans"], span)).alias("spans"))

    return F.aggregate(turns, empty, step, lambda acc: acc["spans"])


def common_prefix(a: Column, b: Column) -> Column:
    """Number of leading turns (role and text) that two conversations share."""
    n = F.least(F.size(a), F.size(b))
    differs = F.filter(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
        lambda i: (i <= n) & ((F.element_at(a, i)["role"] != F.element_at(b, i)["role"])
                              | (F.element_at(a, i)["text"] != F.element_at(b, i)["text"])))
    return F.when(n == 0, 0).otherwise(F.coalesce(F.array_min(differs) - 1, n))


def format_preferences(pairs: DataFrame, key: str, chosen: str = "chosen_turns",
                       rejected: str = "rejected_turns") -> DataFrame:
    """Prompt and masked completions of every pair of turn arrays."""
    c, r = F.col(chosen), F.col(rejected)
    cut = pairs.select(key, c.alias("__c"), r.alias("__r"), common_prefix(c, r).alias("prompt_turns"))

    def tail(side: str) -> Column:
        return F.slice(F.col(side), F.col("prompt_turns") + 1, F.greatest(F.size(side), F.lit(1)))

    parts = cut.select(key, "prompt_turns",
                       F.slice("__c", F.lit(1), F.col("prompt_turns")).alias("__p"),
                       tail("__c").alias("__c"), tail("__r").alias("__r"))
    return parts.select(
        key, F.col("prompt_turns").cast("long").alias("prompt_turns"),
        render(F.col("__p")).alias("prompt"),
        render(F.col("__c")).alias("chosen"), loss_spans(F.col("__c")).alias("chosen_mask"),
        render(F.col("__r")).alias("rejected"), loss_spans(F.col("__r")).alias("rejected_mask"),
        ((F.size("__c") > 0) & (F.size("__r") > 0)).alias("usable"))


def with_cut_reply(turns: Column) -> Column:
    """A worse version of a conversation: its last assistant turn ends half-way."""
    last = F.array_max(F.filter(
        F.transform(turns, lambda t, i: F.when(t["role"] == LEARNED_ROLE, i)),
        lambda i: i.isNotNull()))
    return F.transform(turns, lambda t, i: F.struct(
        t["turn"].alias("turn"), t["role"].alias("role"),
        F.when(i == last, t["text"].substr(F.lit(1), F.floor(F.length(t["text"]) / 2).cast("int")))
        .otherwise(t["text"]).alias("text")))


def op5_preference_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as a preference pair: chosen is the conversation,
    rejected the same one with its last assistant reply cut half-way."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    chosen = conversations_as_arrays(turns, "conv_id", "chosen_turns")
    pairs = chosen.withColumn("rejected_turns", with_cut_reply(F.col("chosen_turns")))
    return format_preferences(pairs, "conv_id")


ORACLE_OP5 = """
WITH t AS (
  SELECT DISTINCT conv_id, coalesce(turn, -4611686018427387904) AS turn,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i FROM t),
lasts AS (
  SELECT *, max(CASE WHEN role = 'assistant' THEN i END) OVER (PARTITION BY conv_id) AS la,
         count(*) OVER (PARTITION BY conv_id) AS n FROM numbered),
sides AS (
  SELECT *, CASE WHEN i = la THEN substring(text, 1, length(text) // 2) ELSE text END AS other
  FROM lasts),
prefixed AS (
  SELECT *, coalesce(min(CASE WHEN text <> other THEN i - 1 END) OVER (PARTITION BY conv_id), n)
            AS p FROM sides),
drawn AS (
  SELECT *, '<|im_start|>' || role || chr(10) AS head, '<|im_end|>' || chr(10) AS tail
  FROM prefixed),
placed AS (
  SELECT *,
    coalesce(sum(CASE WHEN i > p THEN length(head || text || tail) END) OVER
      (PARTITION BY conv_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS at_c,
    coalesce(sum(CASE WHEN i > p THEN length(head || other || tail) END) OVER
      (PARTITION BY conv_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS at_r
  FROM drawn)
SELECT conv_id, CAST(max(p) AS BIGINT) AS prompt_turns,
  coalesce(string_agg(head || text || tail, '' ORDER BY i) FILTER (WHERE i <= p), '') AS prompt,
  coalesce(string_agg(head || text || tail, '' ORDER BY i) FILTER (WHERE i > p), '') AS chosen,
  coalesce(string_agg(CAST(at_c + length(head) AS BIGINT) || ':' || length(text || tail), ','
    ORDER BY i) FILTER (WHERE i > p AND role = 'assistant'), '') AS chosen_mask,
  coalesce(string_agg(head || other || tail, '' ORDER BY i) FILTER (WHERE i > p), '') AS rejected,
  coalesce(string_agg(CAST(at_r + length(head) AS BIGINT) || ':' || length(other || tail), ','
    ORDER BY i) FILTER (WHERE i > p AND role = 'assistant'), '') AS rejected_mask,
  max(n) > max(p) AS usable
FROM placed GROUP BY conv_id
"""
