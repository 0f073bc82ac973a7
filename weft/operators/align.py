"""Schema alignment and prompt rendering (P1-P4, P18, F1, U1, K3 projection).

All pure column expressions: one narrow stage, no shuffle, usable on
streaming DataFrames as well.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.functions.templates import ChatFormat, render_dialog as _dialog, render_prompt as _prompt

HISTORY_TYPE = "array<struct<query:string,answer:string>>"
TARGETS = ("prompt", "query", "response", "history")


def align(df: DataFrame, prompt: str | None = "instruction", query: str | None = "input",
          response: str | None = "output", history: str | None = None, prefix: str = "") -> DataFrame:
    """Map source columns onto prompt/query/response/history.

    A mapped column is renamed to its target; an unmapped one (None or "")
    becomes an all-null column; ``prefix`` is added as a literal column.
    """
    mapping = dict(zip(TARGETS, (prompt, query, response, history)))
    out = df
    for target, src in mapping.items():
        if src == target:
            continue
        if src:
            out = out.withColumnRenamed(src, target)
        else:
            dtype = HISTORY_TYPE if target == "history" else "string"
            out = out.withColumn(target, F.lit(None).cast(dtype))
    return out.withColumn("prefix", F.lit(prefix))


def _nonempty(c: Column, is_array: bool) -> Column:
    return F.coalesce(F.size(c) > 0 if is_array else F.length(c) > 0, F.lit(False))


def keep_nonempty(df: DataFrame, prompt: str = "prompt", response: str = "response") -> DataFrame:
    """keep rows whose prompt and response are non-empty (string or list)."""
    is_arr = df.schema[response].dataType.typeName() == "array"
    return df.where(_nonempty(F.col(prompt), False) & _nonempty(F.col(response), is_arr))


def dialog_query(prompt: str = "prompt", query: str = "query") -> Column:
    """``prompt`` plus ``"\\n" + query`` when the query is non-empty."""
    q = F.col(query)
    return F.when(F.coalesce(F.length(q) > 0, F.lit(False)), F.concat(F.col(prompt), F.lit("\n"), q)) \
        .otherwise(F.col(prompt))


def clean_prefix(prefix: str = "prefix") -> Column:
    """null/empty prefix -> ''."""
    return F.coalesce(F.col(prefix), F.lit(""))


def with_dialog(df: DataFrame, template: ChatFormat, prompt="prompt", query="query", response="response",
                history="history", prefix="prefix") -> DataFrame:
    """F1 -> P2 -> P3: adds ``dialog`` (alternating query/response array)."""
    kept = keep_nonempty(df, prompt, response)
    return kept.withColumn("dialog", _dialog(template, dialog_query(prompt, query), F.col(response),
                                             F.col(history) if history in df.columns else None,
                                             clean_prefix(prefix) if prefix in df.columns else None))


def with_prompt(df: DataFrame, template: ChatFormat, prompt="prompt", query="query", history="history",
                prefix="prefix", out: str = "prompt_text") -> DataFrame:
    """The inference prompt as one string."""
    return df.withColumn(out, _prompt(template, dialog_query(prompt, query),
                                      F.col(history) if history in df.columns else None,
                                      clean_prefix(prefix) if prefix in df.columns else None))


def chat_messages(system: Column | None, locked: Column | None, history: Column | None, query: Column) -> Column:
    """role/content message list: system prompt (if non-empty), locked
    turns, history turns, then the current user message."""
    msg_t = "array<struct<role:string,content:string>>"
    empty = F.array().cast(msg_t)

    def turns(arr: Column | None) -> Column:
        if arr is None:
            return empty
        return F.flatten(F.transform(F.coalesce(arr, F.array().cast(HISTORY_TYPE)), lambda h: F.array(
            F.struct(F.lit("user").alias("role"), h["query"].alias("content")),
            F.struct(F.lit("assistant").alias("role"), h["answer"].alias("content")))))

    sys_part = empty if system is None else F.when(
        F.coalesce(F.length(system) > 0, F.lit(False)),
        F.array(F.struct(F.lit("system").alias("role"), system.alias("content")))).otherwise(empty)
    cur = F.array(F.struct(F.lit("user").alias("role"), query.alias("content")))
    return F.concat(sys_part, turns(locked), turns(history), cur)


def concat_aligned(dfs: list[DataFrame]) -> DataFrame:
    """Concatenate aligned datasets by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def instruction_to_chat(df: DataFrame, instruction: str = "instruction", inp: str = "input",
                        output: str = "output") -> DataFrame:
    """K3 projection: ``input = instruction`` or ``instruction\\ninput`` when
    input is non-empty; one-turn ``chat`` array."""
    text = F.when(F.coalesce(F.length(F.col(inp)) > 0, F.lit(False)),
                  F.concat_ws("\n", F.col(instruction), F.col(inp))).otherwise(F.col(instruction))
    return df.withColumn("chat", F.array(F.struct(text.alias("input"), F.col(output).alias("output"))))
