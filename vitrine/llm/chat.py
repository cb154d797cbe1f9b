"""Chat formatting in budgeted windows.

Prefix sums of the tokens of turns choose spans of whole turns; a window is the system turn, a
limited history repeated from before the span, and the span. Targets are masked where they repeat.
Everything is built-in expressions; the unit of work is a block of consecutive turns of a conversation,
which is told how the conversation opens and what came just before, so a long one is spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm.common import WORD, staged

BUDGET = 512
HISTORY_TOKENS = 128
HISTORY_TURNS = 2
#: Turn numbers in a block.
BLOCK_TURNS = 256
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: Tokens that the template adds to a turn.
FRAME = 4


def escape(text: Column) -> Column:
    """No control string is left in the text, and `unescape` gives it back."""
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&nl;"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&nl;"), F.lit("\n")))


def count_tokens(text: Column) -> Column:
    """Tokens of a turn: a quarter of its characters, but at least its words."""
    return F.greatest(F.ceil(F.length(text) / 4), F.regexp_count(text, F.lit(WORD))).cast("long")


def _blocks(rows: DataFrame, width: int, history_turns: int) -> DataFrame:
    """`conv_id, block, e`: the turns of each block, sorted, behind what it is told. Kinds of entries: 0 a turn
    of its own, 1 the conversation's opening (a system turn or nothing), 2 a turn of the block before,
    3 in the first block of several."""
    found = rows.groupBy("conv_id", "block").agg(F.min(F.struct("turn", "role")).alias("first"))
    opens = found.groupBy(F.col("conv_id").alias("_conv")).agg(
        F.min(F.struct("block", "first")).alias("open"), F.count("*").alias("n")).where(F.col("n") > 1).drop("n")
    same = F.col("conv_id").eqNullSafe(F.col("_conv"))
    opening = (F.col("role") == "system") & (F.col("block") == F.col("open.block")) & F.col("turn").eqNullSafe(F.col("open.first.turn"))
    system = rows.join(opens.where("open.first.role = 'system'"), same & opening).groupBy("_conv").agg(F.min("text").alias("_system"))
    told = found.join(opens, same).select("conv_id", "block", "open").join(system, same, "left")
    kind = F.when(F.col("block") == F.col("open.block"), 3).otherwise(1)
    told = told.select("conv_id", "block", kind.alias("kind"), F.col("open.first.turn").alias("turn"),
                       F.when(F.col("_system").isNotNull(), "system").otherwise("").alias("role"), F.coalesce("_system", F.lit("")).alias("text"))
    late = rows.where(F.col("turn").cast("double") >= (F.col("block") + 1) * width - history_turns)
    parts = [rows.withColumn("kind", F.lit(0)), late.withColumns({"block": F.col("block") + 1, "kind": F.lit(2)}), told]
    every = parts[0].unionByName(parts[1]).unionByName(told)
    entries = every.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list(F.struct("kind", "turn", "role", "text"))).alias("e"))
    return entries.where(F.expr("e[0].kind = 0"))


def windows(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text", budget: int = BUDGET, history_tokens: int = HISTORY_TOKENS,
            history_turns: int = HISTORY_TURNS, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """`conv_id, block, alone, window, n_repeated, formatted, mask`: the training windows of each conversation.

    Turns come in order of `turn`, then role and text (ties, repeated rows); a null turn stands before turn 0,
    null role or text as empty, a null identifier as one conversation. Blocks are `block_turns` turn
    numbers wide (turns that are no numbers: one block) and open a window of their own, with
    history from the last `history_turns` numbers of the block before; `alone` is whether the conversation has one
    block only. A leading system turn stands in every window. A span takes turns while system turn,
    history allowance and span fit the budget; a turn too long for any budget has a window of its own, whole.
    `window` counts inside the block, `n_repeated` is how many turns at the start were in an earlier window. `mask` has
    (begin, length) in characters of the assistant texts of the span: the targets, each in one window only.
    """
    turn = F.col(turn_col)
    numeric = isinstance(conversations.schema[turn_col].dataType, T.NumericType)
    block = F.coalesce(F.floor(turn / block_turns), F.lit(0)) if numeric else F.lit(0)
    rows = conversations.select(F.col(id_col).alias("conv_id"), block.cast("long").alias("block"), turn.alias("turn"),
                                F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"))
    if not numeric:
        rows = rows.withColumn("turn", F.col("turn").cast("string"))
    talks = _blocks(rows, block_turns, history_turns if numeric else 0)
    talks = staged(talks, head=F.expr("filter(e, t -> t.kind = 1 and t.role = 'system')"), own=F.expr("filter(e, t -> t.kind = 0)"),
                   later=F.expr("exists(e, t -> t.kind = 1)"), alone=F.expr("not exists(e, t -> t.kind in (1, 3))"))
    # The opening turn may itself be the last of the block before.
    past = F.expr("""filter(e, t -> t.kind = 2 and not (size(head) > 0 and
        struct(t.turn, t.role, t.text) <=> struct(head[0].turn, head[0].role, head[0].text)))""")
    talks = staged(talks, history=past)
    talks = staged(talks, history=F.expr(f"slice(history, greatest(size(history) - {history_turns}, 0) + 1, {history_turns})"))
    talks = talks.select("conv_id", "block", "alone", "later", F.expr("concat(head, history, own)").alias("turns"),
                         F.expr("if(later, size(head), cast(own[0].role = 'system' as int))").alias("system"),
                         F.expr("if(later, size(head) + size(history), cast(own[0].role = 'system' as int))").alias("first"))
    made = F.transform("turns", lambda t: F.struct(
        F.concat(F.lit(OPEN), _escape_role(t["role"]), F.lit("\n"), escape(t["text"]), F.lit(CLOSE + "\n")).alias("body"),
        (t["role"] == "assistant").alias("target"), F.length(_escape_role(t["role"])).alias("role_length"),
        (count_tokens(t["text"]) + FRAME).alias("tokens")))
    talks = staged(talks, parts=made).drop("turns")
    # Prefix sums: the tokens of the first i turns.
    talks = staged(talks, sums=F.expr("""aggregate(parts, array(0L), (a, p) -> concat(a, array(element_at(a, -1) + p.tokens)))"""))
    talks = staged(talks, room=F.expr(f"{budget}L - get(sums, system)"))
    # Starts of spans: a turn that does not fit behind the span so far opens the next one. Every
    # span but the conversation's first keeps room for its history.
    talks = staged(talks, starts=F.expr(f"""aggregate(sequence(first, greatest(first, size(parts) - 1)), array(first), (a, i) ->
        if(i < size(parts) and i > element_at(a, -1) and
           get(sums, i + 1) - get(sums, element_at(a, -1)) > room - if(later or size(a) > 1, {history_tokens}L, 0L),
           concat(a, array(i)), a))"""))
    rows = talks.select("conv_id", "block", "alone", "later", "system", "parts", "sums", "starts", F.posexplode("starts").alias("window", "begin"))
    rows = staged(rows, end=F.expr("coalesce(get(starts, window + 1), size(parts))"),
                  past=F.expr(f"""coalesce(array_min(filter(sequence(greatest(system, begin - {history_turns}), begin),
                      j -> get(sums, begin) - get(sums, j) <= {history_tokens}L)), begin)"""))
    rows = staged(rows, used=F.expr("""concat(slice(parts, 1, system), slice(parts, past + 1, end - past))"""),
                  n_repeated=F.expr("if(window = 0 and not later, 0, system + begin - past)"))
    rows = staged(rows, lengths=F.transform("used", lambda p: F.length(p["body"])))
    rows = staged(rows, offsets=F.expr("""aggregate(lengths, array(0), (a, n) -> concat(a, array(element_at(a, -1) + n)))"""))
    mask = F.expr(f"""filter(transform(used, (p, i) -> if(p.target and i >= n_repeated, struct(
        get(offsets, i) + {len(OPEN)} + p.role_length + 1 as begin,
        length(p.body) - {len(OPEN)} - p.role_length - 1 - {len(CLOSE) + 1} as length), null)), m -> m is not null)""")
    return rows.select("conv_id", "block", "alone", F.col("window").cast("long").alias("window"), F.col("n_repeated").cast("long").alias("n_repeated"),
                       F.array_join(F.transform("used", lambda p: p["body"]), "").alias("formatted"), mask.alias("mask"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted window as an array of (role, text), control strings restored."""
    bodies = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda b: b != "")
    plain = F.transform(bodies, lambda b: F.substr(b, F.lit(len(OPEN) + 1)))
    return F.transform(plain, lambda b: F.struct(
        _unescape_role(F.substring_index(b, "\n", 1)).alias("role"),
        unescape(F.substr(b, F.length(F.substring_index(b, "\n", 1)) + 2)).alias("text")))


def read_targets(formatted: Column, mask: Column) -> Column:
    """The text under the mask, control strings restored."""
    return F.array_join(F.transform(mask, lambda m: unescape(F.substr(formatted, m["begin"] + 1, m["length"]))), "")
