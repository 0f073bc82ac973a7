"""Inputs derived from the driver tables (Spark side and DuckDB side).

Every derived input is a Spark plan over the given tables, so its size
grows with them.  The SQL fragments are the same derivations written for
DuckDB, used by the oracle queries as CTEs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.operators.history import chat_pairs
from weft.session import read_table


def conversations(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "conversations")


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    """(conv_id, turn, query, response, prompt): user turn + next assistant turn."""
    return chat_pairs(conversations(spark, sf))


PAIRS_SQL = """pairs AS (
  SELECT u.conv_id, u.turn, u.text AS query, b.text AS response, s.prompt
  FROM conversations u
  JOIN conversations b ON b.conv_id = u.conv_id AND b.turn = u.turn + 1 AND b.role = 'assistant'
  LEFT JOIN (SELECT conv_id, arg_min(text, turn) AS prompt FROM conversations
             WHERE role = 'system' GROUP BY conv_id) s ON s.conv_id = u.conv_id
  WHERE u.role = 'user')"""


def prefs(spark: SparkSession, sf: str) -> DataFrame:
    """Preference rows: chosen = own answer, rejected = the answer at the same
    turn of the next conversation (null where that turn does not exist)."""
    p = pairs(spark, sf)
    other = p.select((F.col("conv_id") - 1).alias("conv_id"), "turn", F.col("response").alias("rejected"))
    return (p.join(other, ["conv_id", "turn"], "left")
             .select("conv_id", "turn", F.col("query").alias("prompt"), F.col("response").alias("chosen"),
                     "rejected", F.col("prompt").alias("system")))


PREFS_SQL = PAIRS_SQL + """,
prefs AS (
  SELECT p.conv_id, p.turn, p.query AS prompt, p.response AS chosen, o.response AS rejected, p.prompt AS system
  FROM pairs p LEFT JOIN pairs o ON o.conv_id = p.conv_id + 1 AND o.turn = p.turn)"""


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "documents")


def instructions(spark: SparkSession, sf: str) -> DataFrame:
    """Instruction rows: instruction = user text, input = '' on even
    conversations and the conversation's whole system text (or '') on odd
    ones, output = assistant text."""
    p = pairs(spark, sf)
    return p.select("conv_id", "turn", F.col("query").alias("instruction"),
                    F.when(F.col("conv_id") % 2 == 1, F.coalesce(F.col("prompt"), F.lit(""))).otherwise(F.lit("")).alias("input"),
                    F.col("response").alias("output"))


INSTRUCTIONS_SQL = PAIRS_SQL + """,
instructions AS (
  SELECT conv_id, turn, query AS instruction,
         CASE WHEN conv_id % 2 = 1 THEN coalesce(prompt, '') ELSE '' END AS input,
         response AS output
  FROM pairs)"""


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Long predictions (conv_id, turn, model, text), whole texts: m1 = the
    answer two turns earlier in the same conversation, m2 = the answer at
    the same turn of the next conversation (each absent where that pair
    does not exist)."""
    p = pairs(spark, sf)
    m1 = p.select("conv_id", (F.col("turn") + 2).alias("turn"), F.lit("m1").alias("model"),
                  F.col("response").alias("text"))
    m1 = m1.join(p.select("conv_id", "turn"), ["conv_id", "turn"], "left_semi")
    m2 = p.select((F.col("conv_id") - 1).alias("conv_id"), "turn", F.lit("m2").alias("model"),
                  F.col("response").alias("text"))
    m2 = m2.join(p.select("conv_id", "turn"), ["conv_id", "turn"], "left_semi")
    return m1.unionByName(m2)


PREDICTIONS_SQL = PAIRS_SQL + """,
predictions AS (
  SELECT o.conv_id AS conv_id, o.turn + 2 AS turn, 'm1' AS model, o.response AS text FROM pairs o
  JOIN pairs p ON p.conv_id = o.conv_id AND p.turn = o.turn + 2
  UNION ALL
  SELECT o.conv_id - 1, o.turn, 'm2', o.response FROM pairs o
  JOIN pairs p ON p.conv_id = o.conv_id - 1 AND p.turn = o.turn)"""
