"""Input tables of the registered queries, derived from the given tables.

The conversations hold no reasoning, think tags, odd roles or tool schemas, so
the same SQL adds them in both engines. Every turn and every text stays whole;
the CASE expressions only vary the form of a row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

VARIED_COLUMNS = (
    "conv_id",
    "turn",
    """CASE WHEN role = 'user' AND conv_id % 7 = 3 AND turn > 1 THEN ' function '
       WHEN role = 'user' AND conv_id % 5 = 2 AND turn > 1 THEN 'think'
       WHEN role = 'user' AND conv_id % 7 = 5 AND turn > 2 THEN 'observer'
       WHEN role = 'user' AND conv_id % 7 = 5 THEN ' critic'
       ELSE role END AS role""",
    """CASE WHEN role = 'system' AND conv_id % 5 < 2 THEN '  ' || chr(10)
       WHEN role = 'assistant' AND (conv_id + turn) % 3 = 0
         THEN '<think>' || chr(10) || text || chr(10) || '</think>' || chr(10) || chr(10) || text
       WHEN role = 'assistant' AND (conv_id + turn) % 11 = 4 THEN '<think></think>' || text
       ELSE text END AS content""",
    """CASE WHEN role = 'assistant' AND (conv_id + turn) % 9 = 0
       THEN text END AS reasoning_content""",
    """CASE WHEN role = 'assistant' AND (conv_id + turn) % 3 = 1 THEN text
       WHEN role = 'assistant' AND (conv_id + turn) % 3 = 2 THEN '   ' END AS reasoning""",
    """CASE WHEN role = 'assistant' AND (conv_id + turn) % 6 = 2
       THEN ' ' || text || chr(10) END AS thinking""",
    """CASE WHEN conv_id % 8 = 4
       THEN ' [ {"type": "function",' || chr(10) || ' "function" : {"name": "look  up"} } ]'
       WHEN conv_id % 8 = 6 THEN '[{"name":"caf' || chr(92) || 'u00e9","type":1,"name":"' || chr(92) || 'u0061' || chr(92)
         || '/b"}, {"type":"function", "type" : {"k":[1, 2]},"name":"' || chr(92) || 'n"}]'
       ELSE CASE conv_id % 4
       WHEN 0 THEN '[{"type":"function","function":{"name":"lookup","parameters":{"type":"object"}}}]'
       WHEN 1 THEN '  '
       WHEN 2 THEN 'not json' END END AS tools""",
)
VARIED_TURNS_SQL = f"SELECT {', '.join(VARIED_COLUMNS)} FROM conversations"


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/conversations.parquet")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def varied_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns with reasoning fields, think tags, odd roles and tools."""
    return conversations(spark, sf_dir).selectExpr(*VARIED_COLUMNS)


def reply_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat prompt/response rows, one for each user turn, with the reply that follows at once.

    The reply stands in ``response``, in ``completion`` beside a blank response, or in
    ``answer`` beside NULLs. Unanswered prompts have NULLs only. An equi-join on
    conversation and turn, so long conversations spread out.
    """
    turns = conversations(spark, sf_dir)
    asked = turns.filter("role = 'user'").alias("q")
    replied = turns.filter("role = 'assistant'").withColumn("turn", F.col("turn") - 1).alias("a")
    reply, form = F.col("a.text"), F.col("conv_id") % 3
    return asked.join(replied, ["conv_id", "turn"], "left").select(
        "conv_id",
        "turn",
        F.col("q.text").alias("prompt"),
        F.when(form == 0, F.lit("")).when(form == 1, reply).alias("response"),
        F.when(form == 0, reply).alias("completion"),
        F.when(form == 2, reply).alias("answer"),
    )


def message_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A message-list table: whole conversations, one to a row, with tools."""
    fields = ("role", "content", "reasoning_content", "reasoning", "thinking")
    grouped = varied_turns(spark, sf_dir).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", *fields))).alias("m"),
        F.min_by("tools", "turn").alias("tools"),
    )
    return grouped.select("conv_id", F.transform("m", lambda m: m.dropFields("turn")).alias("messages"), "tools")


def shapeless_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that have neither a message list nor a prompt: the system turns as they are."""
    return conversations(spark, sf_dir).filter("role = 'system'")
