r"""Chat formatting in budgeted windows, by DataFrame functions only.

A turn is written as ``<|im_start|>role\ntext<|im_end|>\n``. Inside roles and texts a
backslash is doubled and ``<|`` becomes ``<\|``, so no control string can come from a text,
and both are undone exactly. A conversation is cut into windows of whole turns: prefix
sums of turn tokens give every turn its place, and a window holds the turns that begin
within the same step of half the room for new turns, so that it keeps within the room unless
one turn alone is longer than the step; such a turn is a window of its own. Every window
begins with the system turn and the last few turns before it, as many as fit into the
room for history. What a window repeats is not under the loss mask again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def _unescaped(text: str) -> str:
    """SQL: the text before escaping."""
    return rf"regexp_replace({text}, r'(?s)\\(.)', '$1')"


def _role(role: Column) -> Column:
    # a role ends at the first line end, so its own are written as backslash and n
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def _unescaped_role(role: str) -> str:
    lines = rf"regexp_replace({role}, r'(?<!\\)((?:\\\\)*)\\n', '$1\n')"
    return _unescaped(lines)


def tokens(piece: Column) -> Column:
    """Estimated tokens of a formatted turn: a quarter of its bytes, rounded up."""
    return F.ceil(F.octet_length(piece) / 4)


def windows(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    budget: int = 1024, history_tokens: int = 256, history_turns: int = 2,
) -> DataFrame:
    """One row per window: ``conv``, ``window``, ``text``, ``repeated`` (leading turns not new), ``loss`` (spans).

    ``loss`` holds start and end code points of the assistant texts that are new in the
    window, as written. Turns stand in order of ``turn`` (null first), then role and
    text; repeated rows are turns of their own. Null roles and texts are empty, rows
    without a conversation are one conversation. Other columns are not looked at.
    """
    turn = rows.select(
        rows[conv_col].alias("conv"), rows[turn_col].alias("turn"), F.coalesce(rows[role_col], F.lit("")).alias("kind"),
        _role(rows[role_col]).alias("role"), escaped(rows[text_col]).alias("body"))
    turn = turn.withColumn("piece", F.concat(F.lit(START), "role", F.lit("\n"), "body", F.lit(END))).withColumn("tokens", tokens(F.col("piece")))
    order = Window.partitionBy("conv").orderBy("turn", "kind", "body")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = turn.withColumn("at", F.row_number().over(order))
    system = (F.col("at") == 1) & (F.col("kind") == "system")
    at = at.withColumn("system", system)
    new = F.when(~F.col("system"), F.col("tokens")).otherwise(0)
    at = at.withColumn("before", F.sum(new).over(so_far) - new)
    reserved = F.first(F.when(F.col("system"), F.col("tokens")).otherwise(0)).over(so_far)
    step = F.greatest(F.floor((F.lit(budget - history_tokens) - reserved) / 2), F.lit(1))
    at = at.withColumn("step", step).withColumn("slot", F.floor(F.col("before") / F.col("step"))).withColumn("large", F.col("tokens") > F.col("step"))
    previous = [F.lag(c).over(order) for c in ("slot", "large", "system")]
    opens = previous[0].isNull() | previous[2] | (previous[0] != F.col("slot")) | previous[1] | F.col("large")
    at = at.withColumn("opens", F.when(~F.col("system"), opens).otherwise(False))
    at = at.withColumn("window", F.sum(F.col("opens").cast("int")).over(so_far) - 1)
    last = F.max("window").over(Window.partitionBy("conv"))
    copies = [F.struct(F.col("window"), F.lit(False).alias("again"))]
    for j in range(1, history_turns + 1):
        there, first, before = (F.lead(c, j).over(order) for c in ("window", "opens", "before"))
        near = first & (before - F.col("before") <= history_tokens)
        copies.append(F.when(near, F.struct(there.alias("window"), F.lit(True).alias("again"))))
    everywhere = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda w: F.struct(w.alias("window"), (w > 0).alias("again")))
    at = at.withColumn("copies", F.when(F.col("system"), everywhere).otherwise(F.array_compact(F.array(*copies))))
    placed = at.select("conv", "at", "kind", "piece", F.length("role").alias("head"), F.length("body").alias("size"), F.explode("copies").alias("c"))
    item = F.struct("at", F.col("c.again").alias("again"), ((F.col("kind") == "assistant") & ~F.col("c.again")).alias("loss"),
                    "head", "size", "piece")
    grouped = placed.groupBy("conv", F.col("c.window").alias("window")).agg(F.array_sort(F.collect_list(item)).alias("turns"))
    head = len(START) + 1
    spans = F.expr(f"""aggregate(turns, named_struct('pos', 0, 'spans', CAST(array() AS ARRAY<STRUCT<start: INT, end: INT>>)),
        (a, x) -> named_struct('pos', a.pos + length(x.piece), 'spans', if(x.loss, concat(a.spans, array(named_struct(
            'start', a.pos + {head} + x.head, 'end', a.pos + {head} + x.head + x.size))), a.spans)), a -> a.spans)""")
    return grouped.select(
        "conv", "window", F.array_join(F.transform("turns", lambda x: x["piece"]), "").alias("text"),
        F.size(F.filter("turns", lambda x: x["again"])).alias("repeated"), spans.alias("loss"))


def conversations(formatted: DataFrame) -> DataFrame:
    """Read windows back: ``conv``, ``turns`` (role, text), ``learned`` (texts under the mask), ``formatted_chars``."""
    role, body = "substring_index(p, '\\n', 1)", "substr(p, length(substring_index(p, '\\n', 1)) + 2)"
    parts = f"transform(slice(split(text, r'<\\|im_end\\|>\\n', -1), 1 + repeated, size(split(text, r'<\\|im_end\\|>\\n', -1)) - 1 - repeated), p -> substr(p, {len(START) + 1}))"
    turns = F.expr(f"transform({parts}, p -> named_struct('role', {_unescaped_role(role)}, 'text', {_unescaped(body)}))")
    learned = F.expr("transform(loss, s -> " + _unescaped("substr(text, s.start + 1, s.end - s.start)") + ")")
    read = formatted.select("conv", F.struct("window", turns.alias("turns"), learned.alias("learned")).alias("w"), F.length("text").alias("chars"))
    grouped = read.groupBy("conv").agg(F.array_sort(F.collect_list("w")).alias("w"), F.sum("chars").alias("formatted_chars"))
    return grouped.select("conv", F.flatten("w.turns").alias("turns"), F.flatten("w.learned").alias("learned"), "formatted_chars")
