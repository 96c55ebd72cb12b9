"""Preference formatting with DataFrame functions only.

A pair is a chosen and a rejected conversation. Their longest common prefix of turns (role and text equal, in order) is rendered
once as the prompt; what follows on each side is its completion. A turn is rendered as ``<|role|>\\ntext<|end|>\\n``. A
completion comes with its mask: the code point ranges (start:end, comma-joined) that a loss counts, which are the texts and end
marks of assistant turns; everything else, and the whole prompt, is masked out.

Turns are ordered by number; turns with one number by role, then text, and repeats of a turn (number, role and text equal) count once. A
null role is rendered as ``user``, a null text as empty; turns without a number come first. Rows without a conversation
belong to no pair. A side without turns is empty, and so is the prompt then. A conversation is rendered in one row, in time in
proportion to its turns and their texts, however long they are; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from millrace.llm._columns import let, sums_before

END = "<|end|>"


def rendered(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"), turn["text"], F.lit(END + "\n"))


def joined(turns: Column) -> Column:
    return F.array_join(F.transform(turns, rendered), "")


def mask(turns: Column) -> Column:
    """The ranges of assistant texts with their end marks in the rendered ``turns``."""
    frame = len("<||>\n") + len(END) + 1
    sizes = F.transform(turns, lambda t: F.length(t["role"]) + F.length(t["text"]) + F.lit(frame))

    def span(turn: Column, start: Column) -> Column:
        begin = start + F.length(turn["role"]) + F.lit(5)
        end = begin + F.length(turn["text"]) + F.lit(len(END))
        return F.when(turn["role"] == "assistant", F.concat_ws(":", begin.cast("string"), end.cast("string")))

    return F.array_join(F.zip_with(turns, sums_before(sizes), span), ",")


def common(a: Column, b: Column) -> Column:
    """How many turns two ordered lists have in common from the start on."""
    shared = F.least(F.size(a), F.size(b))
    differ = F.zip_with(a, b, lambda x, y: ~(x["role"].eqNullSafe(y["role"]) & x["text"].eqNullSafe(y["text"])))
    first = F.array_position(differ, F.lit(True)).cast("int")
    return F.when(first > 0, first - 1).otherwise(shared)


def conversations(turns: DataFrame, key: Column, turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(key, turns): each conversation's turns in order. Rows with a null key belong to none."""
    rows = turns.select(key.alias("key"), F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("user")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")).alias("t"))
    found = rows.filter(F.col("key").isNotNull()).groupBy("key").agg(F.sort_array(F.collect_list("t")).alias("all"))
    once = let(F.col("all"), lambda a: F.filter(a, lambda t, i: (i == 0) | ~t.eqNullSafe(F.get(a, i - 1))))
    return found.select("key", once.alias("turns"))


def format_pairs(pairs: DataFrame) -> DataFrame:
    """The formatted pairs (pair_id, n_prompt, prompt, chosen, chosen_mask, rejected, rejected_mask) of (pair_id, a, b): ordered turns of both sides."""
    sides = pairs.select("pair_id", "a", "b", common(F.col("a"), F.col("b")).alias("n"))
    after = lambda c: F.slice(F.col(c), F.col("n") + 1, F.greatest(F.size(c), F.lit(1)))
    cut = sides.select("pair_id", "n", F.slice("a", F.lit(1), F.col("n")).alias("prompt"), after("a").alias("a"), after("b").alias("b"))
    return cut.select(
        "pair_id",
        F.col("n").cast("long").alias("n_prompt"),
        joined(F.col("prompt")).alias("prompt"),
        joined(F.col("a")).alias("chosen"),
        mask(F.col("a")).alias("chosen_mask"),
        joined(F.col("b")).alias("rejected"),
        mask(F.col("b")).alias("rejected_mask"),
    )


def paired(turns: DataFrame, pair: Column, chosen: Column, **names: str) -> DataFrame:
    """(pair_id, a, b) from turns of which ``pair`` names the pair and ``chosen`` the side. A side without turns is empty."""
    found = conversations(turns, F.when(pair.isNotNull() & chosen.isNotNull(), F.struct(pair.alias("pair"), chosen.alias("chosen"))), **names)
    side = lambda c: F.flatten(F.collect_list(F.when(F.col("key.chosen") == c, F.col("turns"))))
    return found.groupBy(F.col("key.pair").alias("pair_id")).agg(side(True).alias("a"), side(False).alias("b"))


def contrasted(found: DataFrame) -> DataFrame:
    """(pair_id, a, b) from conversations (key, turns) without preferences: the rejected side has another conversation's answer.

    Conversations 2k and 2k + 1 lend each other their last assistant turns; one whose key is no whole number has no partner. Where there is
    none to lend, the rejected side lacks the turn; a conversation without an assistant turn has nothing to prefer, so its sides are equal.
    """
    number = F.col("key").try_cast("bigint")
    partner = F.when(number.cast("string") == F.col("key").cast("string"), number.bitwiseXOR(F.lit(1)).cast(found.schema["key"].dataType))
    last = F.size("turns") - F.array_position(F.reverse(F.transform("turns", lambda t: t["role"])), F.lit("assistant")).cast("int")
    place = found.select("key", "turns", last.alias("last"))  # the turns' number if there is no assistant turn
    own = place.filter(F.col("last") < F.size("turns"))
    lent = own.select(partner.alias("key"), F.get("turns", F.col("last"))["text"].alias("other"))
    both = place.join(lent, "key", "left")
    turn = F.get("turns", F.col("last"))
    answer = F.array(F.struct(turn["turn"].alias("turn"), turn["role"].alias("role"), F.col("other").alias("text")))
    none = F.slice("turns", F.lit(1), F.lit(0))
    swapped = F.concat(F.slice("turns", F.lit(1), F.col("last")), F.when(F.col("other").isNotNull(), answer).otherwise(none), F.slice("turns", F.col("last") + 2, F.size("turns")))
    return both.select(F.col("key").alias("pair_id"), F.col("turns").alias("a"), F.when(F.col("last") < F.size("turns"), swapped).otherwise(F.col("turns")).alias("b"))


def digest(turns: DataFrame) -> DataFrame:
    """The rows of query op9: every conversation as chosen, with its partner's last answer as rejected."""
    ids = F.col("conv_id")
    return format_pairs(contrasted(conversations(turns, ids.cast("long") if isinstance(turns.schema["conv_id"].dataType, IntegralType) else ids)))


ORACLE = r"""
WITH t AS (SELECT DISTINCT conv_id AS c, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
a AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS p FROM t),
l AS (SELECT c, max(p) AS p FROM a WHERE role = 'assistant' GROUP BY c),
answer AS (SELECT c, p, text FROM a JOIN l USING (c, p)),
b AS (SELECT a.c, a.role, CASE WHEN own.c IS NULL THEN a.text ELSE other.text END AS text, row_number() OVER (PARTITION BY a.c ORDER BY a.p) AS p
  FROM a LEFT JOIN answer AS own ON own.c = a.c AND own.p = a.p LEFT JOIN answer AS other ON other.c = xor(a.c, 1) AND own.c IS NOT NULL WHERE own.c IS NULL OR other.c IS NOT NULL),
s AS (SELECT c, true AS side, role, text, p FROM a UNION ALL SELECT c, false, role, text, p FROM b),
same AS (SELECT c, p, count(*) = 2 AND min(role) = max(role) AND min(text) = max(text) AS same FROM s GROUP BY c, p),
prefix AS (SELECT c, coalesce(min(p) FILTER (WHERE NOT same) - 1, max(p)) AS k FROM same GROUP BY c),
r AS (SELECT s.*, k, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS line FROM s JOIN prefix USING (c)),
m AS (SELECT *, CAST(coalesce(sum(length(line)) FILTER (WHERE p > k) OVER (PARTITION BY c, side ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(role) + 5 AS BIGINT) AS pos FROM r)
SELECT c AS pair_id, CAST(any_value(k) AS BIGINT) AS n_prompt,
coalesce(string_agg(line, '' ORDER BY p) FILTER (WHERE side AND p <= k), '') AS prompt,
coalesce(string_agg(line, '' ORDER BY p) FILTER (WHERE side AND p > k), '') AS chosen,
coalesce(string_agg(pos || ':' || (pos + length(text) + 7), ',' ORDER BY p) FILTER (WHERE side AND p > k AND role = 'assistant'), '') AS chosen_mask,
coalesce(string_agg(line, '' ORDER BY p) FILTER (WHERE NOT side AND p > k), '') AS rejected,
coalesce(string_agg(pos || ':' || (pos + length(text) + 7), ',' ORDER BY p) FILTER (WHERE NOT side AND p > k AND role = 'assistant'), '') AS rejected_mask
FROM m GROUP BY c
"""
