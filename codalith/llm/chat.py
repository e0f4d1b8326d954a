"""Preference formatting: chosen and rejected conversations to a shared prompt and two masked completions.

The longest common prefix of turns (same role and text) is rendered once as the prompt; what follows
in either conversation is its completion. The mask of a completion lists the character spans that are
trained on: what the assistant says with its end mark. DataFrame functions only.

Defined results: null text counts as empty, null role as "unknown", a null list of turns as an empty one
and a null turn in it as a turn of null role and text; turns are ordered by turn, then role and text, null
turns first; repeated turns stay; rows of null conv_id belong to no conversation; a conversation without
an assistant's turn has nothing to prefer and gives no pair; one without a partner is paired with its own
prompt, so that the rejected completion is empty. One conversation is one output row, so it must fit a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codalith.llm import common

OPEN, CLOSE, TRAINED = "<|im_start|>", "<|im_end|>\n", "assistant"


def _plain(turn: Column) -> list[Column]:
    return [F.coalesce(turn["role"], F.lit("unknown")).alias("role"), F.coalesce(turn["text"], F.lit("")).alias("text")]


def conversations(turns: DataFrame) -> DataFrame:
    """(pair, conv_id, turns): each conversation's (role, text) in order; conversations 2k and 2k + 1 are pair k and stay in one partition."""
    known = turns.where(F.col("conv_id").isNotNull()).select(F.shiftright("conv_id", 1).alias("pair"), "conv_id", F.struct("turn", *_plain(F.struct("role", "text"))).alias("t"))
    grouped = known.repartition("pair").groupBy("pair", "conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return grouped.select("pair", "conv_id", F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def _rendered(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit("\n"), turn["text"], F.lit(CLOSE))


def _text(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _rendered), "")


def _mask(turns: Column) -> Column:
    """(start, length) in characters of what is trained on, in the text of turns."""
    def step(state: Column, turn: Column) -> Column:
        head = F.length(turn["role"]) + F.lit(len(OPEN) + 1)
        size = F.length(turn["text"]) + F.lit(len(CLOSE))
        span = F.array(F.struct((state["at"] + head).alias("start"), size.alias("length")))
        spans = F.when(turn["role"] == TRAINED, F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct((state["at"] + head + size).alias("at"), spans.alias("spans"))

    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    return F.aggregate(turns, empty, step, lambda s: s["spans"])


def format_preferences(pairs: DataFrame, pair_id: str = "pair_id") -> DataFrame:
    """pairs has pair_id, chosen and rejected (arrays of role and text); gives prompt, both completions and masks."""
    whole = lambda c: F.coalesce(F.transform(c, lambda t: F.struct(*_plain(t))), F.array().cast("array<struct<role:string,text:string>>"))
    pairs = pairs.select(pair_id, whole("chosen").alias("chosen"), whole("rejected").alias("rejected"))
    shorter = F.least(F.size("chosen"), F.size("rejected"))
    differs = F.zip_with(F.slice("chosen", 1, shorter), F.slice("rejected", 1, shorter), lambda a, b: ~((a["role"] == b["role"]) & (a["text"] == b["text"])))
    first = F.array_position(differs, True).cast("int")
    cut = pairs.withColumn("n_prompt_turns", F.when(first > 0, first - 1).otherwise(shorter))
    tail = lambda c: F.slice(c, F.col("n_prompt_turns") + 1, F.greatest(F.size(c) - F.col("n_prompt_turns"), F.lit(0)))
    parts = cut.select(pair_id, "n_prompt_turns", F.slice("chosen", 1, F.col("n_prompt_turns")).alias("head"), tail("chosen").alias("c"), tail("rejected").alias("r"))
    return parts.select(pair_id, "n_prompt_turns", _text(F.col("head")).alias("prompt"), _text(F.col("c")).alias("chosen"), _text(F.col("r")).alias("rejected"), _mask(F.col("c")).alias("chosen_mask"), _mask(F.col("r")).alias("rejected_mask"))


def preference_pairs(turns: DataFrame) -> DataFrame:
    """A pair for every conversation with an assistant's turn: chosen as it is; rejected ends with the last reply of its neighbour.

    Conversations 2k and 2k + 1 are neighbours: each is rejected with the other's last reply in place
    of its own last reply, and nothing after it. Turns are shuffled once, by their pair.
    """
    own = conversations(turns).withColumn("last", F.array_position(F.reverse(F.col("turns.role")), TRAINED).cast("int"))
    own = own.where("last > 0").select("pair", "conv_id", "turns", (F.size("turns") - F.col("last")).alias("before"))
    both = own.groupBy("pair").agg(F.collect_list(F.struct("conv_id", "turns", "before")).alias("both"))  # two at most
    each = both.select("both", F.explode("both").alias("own"))
    reply = F.flatten(F.transform(F.filter("both", lambda c: c["conv_id"] != F.col("own.conv_id")), lambda c: F.slice(c["turns"], c["before"] + 1, 1)))
    rejected = F.concat(F.slice("own.turns", 1, F.col("own.before")), reply)
    return each.select(F.col("own.conv_id").alias("pair_id"), F.col("own.turns").alias("chosen"), rejected.alias("rejected"))


def _digest(name: str) -> list[Column]:
    mask = F.array_join(F.transform(f"{name}_mask", lambda s: F.concat_ws(":", s["start"].cast("string"), s["length"].cast("string"))), ",")
    return [F.length(name).cast("long").alias(f"{name}_chars"), F.md5(name).alias(f"{name}_md5"), mask.alias(f"{name}_spans")]


def op1_preference_format(spark, sf_dir: str) -> DataFrame:
    done = format_preferences(preference_pairs(common.table(spark, sf_dir, "conversations")))
    return done.select(F.col("pair_id").cast("long").alias("pair_id"), F.col("n_prompt_turns").cast("long").alias("n_prompt_turns"), F.length("prompt").cast("long").alias("prompt_chars"), F.md5("prompt").alias("prompt_md5"), *_digest("chosen"), *_digest("rejected"))


def _sql_side(name: str) -> str:
    return f"""length({name}) AS {name}_chars, md5({name}) AS {name}_md5, {name}_spans"""


OP1_SQL = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL
), last AS (SELECT conv_id, max(i) AS i FROM t WHERE role = '{TRAINED}' GROUP BY conv_id)
, reply AS (SELECT xor(t.conv_id, 1) AS conv_id, last.i AS partner_i, role, text FROM t JOIN last ON t.conv_id = last.conv_id AND t.i = last.i)
, chosen AS (SELECT t.* FROM t JOIN last USING (conv_id))
, rejected AS (
  SELECT t.conv_id, t.role, t.text, t.i FROM t JOIN last ON t.conv_id = last.conv_id AND t.i < last.i
  UNION ALL SELECT last.conv_id, reply.role, reply.text, last.i FROM last JOIN reply USING (conv_id)
), cut AS (
  SELECT last.conv_id, coalesce(min(CASE WHEN c.role IS DISTINCT FROM r.role OR c.text IS DISTINCT FROM r.text THEN coalesce(c.i, r.i) END) - 1, max(c.i)) AS n
  FROM last JOIN chosen c ON last.conv_id = c.conv_id LEFT JOIN rejected r ON c.conv_id = r.conv_id AND c.i = r.i GROUP BY last.conv_id
), sides AS (
  SELECT 'chosen' AS side, * FROM chosen UNION ALL SELECT 'rejected', conv_id, role, text, i FROM rejected
), shown AS (
  SELECT side, s.conv_id, i, role, n, '{OPEN}' || role || chr(10) || text || '{CLOSE.strip()}' || chr(10) AS whole, length(role) + {len(OPEN) + 1} AS head, length(text) + {len(CLOSE)} AS size
  FROM sides s JOIN cut USING (conv_id)
), placed AS (
  SELECT *, CAST(coalesce(sum(length(whole)) OVER (PARTITION BY side, conv_id, i <= n ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS place FROM shown
), joined AS (
  SELECT conv_id, n,
    coalesce(string_agg(CASE WHEN side = 'chosen' AND i <= n THEN whole END, '' ORDER BY i), '') AS prompt,
    coalesce(string_agg(CASE WHEN side = 'chosen' AND i > n THEN whole END, '' ORDER BY i), '') AS chosen,
    coalesce(string_agg(CASE WHEN side = 'rejected' AND i > n THEN whole END, '' ORDER BY i), '') AS rejected,
    coalesce(string_agg(CASE WHEN side = 'chosen' AND i > n AND role = '{TRAINED}' THEN (place + head) || ':' || size END, ',' ORDER BY i), '') AS chosen_spans,
    coalesce(string_agg(CASE WHEN side = 'rejected' AND i > n AND role = '{TRAINED}' THEN (place + head) || ':' || size END, ',' ORDER BY i), '') AS rejected_spans
  FROM placed GROUP BY conv_id, n
)
SELECT CAST(conv_id AS BIGINT) AS pair_id, CAST(n AS BIGINT) AS n_prompt_turns, length(prompt) AS prompt_chars, md5(prompt) AS prompt_md5, {_sql_side("chosen")}, {_sql_side("rejected")}
FROM joined
"""
