"""Preference formatting of conversations, with DataFrame functions only.

The longest common turn prefix of a chosen and a rejected conversation is
rendered once as the prompt; what follows in each is its completion. Only the
assistant's words and end marks of a completion are to be learned: their
character ranges are the mask.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm.common import read_table, typed

OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"
LEARNED_ROLE = "assistant"


def _turns(side: DataFrame, name: str) -> DataFrame:
    """Per pair_id its distinct turns in order of (turn, role, text)."""
    cell = F.struct(F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"))
    return (side.where("pair_id is not null").groupBy("pair_id").agg(F.array_sort(F.collect_set(cell)).alias("all"))
            .select("pair_id", F.transform("all", lambda t: F.struct(t.role.alias("role"), t.text.alias("text"))).alias(name)))


def _head(turn) -> F.Column:
    return F.concat(F.lit(OPEN), turn.role, F.lit(CLOSE))


def _rendered(turns: F.Column) -> F.Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), t.text, F.lit(END))), "")


def _mask(turns: F.Column) -> F.Column:
    """``start:end`` of what is to be learned in the rendered turns, comma-joined."""
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc, turn):
        begin = acc.at + F.length(_head(turn))
        end = begin + F.length(turn.text) + len(END)
        span = F.concat_ws(":", begin.cast("string"), end.cast("string"))
        return F.struct(end.cast("bigint").alias("at"),
                        F.when(turn.role == LEARNED_ROLE, F.concat(acc.out, F.array(span))).otherwise(acc.out).alias("out"))

    return F.array_join(F.aggregate(turns, start, step, lambda acc: acc.out), ",")


def preference_rows(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """One row per pair_id found on either side (pair_id, turn, role, text).

    A side without turns has an empty conversation: the prompt is then empty.
    Rows without a pair_id belong to no pair. Null roles and texts count as
    empty, a null turn sorts first, repeated turns count once, turns with equal
    numbers follow role and text. Extra columns are ignored.
    """
    columns = {"pair_id": "bigint", "turn": "bigint", "role": "string", "text": "string"}
    empty = F.array().cast("array<struct<role:string,text:string>>")
    both = (_turns(typed(chosen, **columns), "chosen").join(_turns(typed(rejected, **columns), "rejected"),
                                                            "pair_id", "full")
            .select("pair_id", F.coalesce("chosen", empty).alias("c"), F.coalesce("rejected", empty).alias("r")))
    same = F.zip_with("c", "r", lambda a, b: F.coalesce(a.eqNullSafe(b), F.lit(False)))
    miss = F.array_position(same, False)
    common = F.when(miss == 0, F.least(F.size("c"), F.size("r"))).otherwise(miss - 1).cast("int")
    both = both.withColumn("n_prompt_turns", common)

    def rest(side: str) -> F.Column:
        return F.slice(side, F.col("n_prompt_turns") + 1, F.greatest(F.size(side) - F.col("n_prompt_turns"), F.lit(0)))

    return both.select(
        "pair_id", F.col("n_prompt_turns").cast("bigint").alias("n_prompt_turns"),
        _rendered(F.slice("c", 1, F.col("n_prompt_turns"))).alias("prompt"),
        _rendered(rest("c")).alias("chosen"), _mask(rest("c")).alias("chosen_mask"),
        _rendered(rest("r")).alias("rejected"), _mask(rest("r")).alias("rejected_mask"))


def preference_sides(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs from plain conversations: a conversation is chosen; rejected is the
    same with its last assistant turn's text replaced by that of its neighbour
    (ids 2i and 2i + 1 are neighbours). Without a neighbour's answer the
    rejected one ends before that turn."""
    turns = typed(conversations, conv_id="bigint", turn="bigint", role="string", text="string").where("conv_id is not null")
    last = (turns.where(F.col("role") == LEARNED_ROLE).groupBy("conv_id")
            .agg(F.max(F.struct("turn", "text")).alias("last")))
    other = last.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.col("last.text").alias("answer"))
    chosen = turns.withColumnRenamed("conv_id", "pair_id")
    until = turns.join(last.select("conv_id", F.col("last.turn").alias("last_turn")), "conv_id", "left")
    kept = until.where(F.col("last_turn").isNull() | ~F.coalesce(F.col("turn") >= F.col("last_turn"), F.lit(False)))
    swapped = last.join(other, "conv_id").select(
        "conv_id", F.col("last.turn").alias("turn"), F.lit(LEARNED_ROLE).alias("role"), F.col("answer").alias("text"))
    rejected = kept.drop("last_turn").unionByName(swapped).withColumnRenamed("conv_id", "pair_id")
    return chosen, rejected


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference_rows(*preference_sides(read_table(spark, sf_dir, "conversations")))


_SIDE = f"""
  SELECT pair_id, string_agg('{OPEN}' || role || '|>' || chr(10) || text || '<|end|>' || chr(10), '' ORDER BY k) AS rendered,
         string_agg((till - length(text) - {len(END)})::VARCHAR || ':' || till::VARCHAR, ',' ORDER BY k)
           FILTER (role = '{LEARNED_ROLE}') AS mask
  FROM (SELECT *, sum(length(role) + length(text) + {len(OPEN) + len(CLOSE) + len(END)})
                  OVER (PARTITION BY pair_id ORDER BY k) AS till
        FROM {{side}} JOIN miss USING (pair_id) WHERE k > common) GROUP BY pair_id"""

SQL = f"""
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
           FROM conversations WHERE conv_id IS NOT NULL),
answers AS (SELECT conv_id, max(turn) AS last_turn, arg_max(text, (turn, text)) AS answer
            FROM t WHERE role = '{LEARNED_ROLE}' GROUP BY conv_id),
mixed AS (SELECT t.conv_id, turn, role, text FROM t LEFT JOIN answers a USING (conv_id)
          WHERE last_turn IS NULL OR turn < last_turn
          UNION SELECT a.conv_id, a.last_turn, '{LEARNED_ROLE}', b.answer
          FROM answers a JOIN answers b ON b.conv_id = xor(a.conv_id, 1)),
c AS (SELECT conv_id AS pair_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k FROM t),
r AS (SELECT conv_id AS pair_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k FROM mixed),
miss AS (SELECT pair_id, coalesce(min(k) FILTER (NOT same), max(k) + 1) - 1 AS common FROM (
           SELECT coalesce(c.pair_id, r.pair_id) AS pair_id, coalesce(c.k, r.k) AS k,
                  c.k IS NOT NULL AND r.k IS NOT NULL AND c.role = r.role AND c.text = r.text AS same
           FROM c FULL JOIN r ON c.pair_id = r.pair_id AND c.k = r.k) GROUP BY pair_id),
p AS (SELECT pair_id, string_agg('{OPEN}' || role || '|>' || chr(10) || text || '<|end|>' || chr(10), '' ORDER BY k) AS rendered
      FROM c JOIN miss USING (pair_id) WHERE k <= common GROUP BY pair_id),
cs AS ({_SIDE.format(side='c')}), rs AS ({_SIDE.format(side='r')})
SELECT pair_id, common::BIGINT AS n_prompt_turns, coalesce(p.rendered, '') AS prompt,
       coalesce(cs.rendered, '') AS chosen, coalesce(cs.mask, '') AS chosen_mask,
       coalesce(rs.rendered, '') AS rejected, coalesce(rs.mask, '') AS rejected_mask
FROM miss LEFT JOIN p USING (pair_id) LEFT JOIN cs USING (pair_id) LEFT JOIN rs USING (pair_id)
"""
