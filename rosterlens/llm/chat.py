"""Chat formatting with a grammar round trip, in DataFrame functions only.

    conversation := turn*
    turn         := "<s>" role "\\n" body "</s>"
    body         := text                               (assistant: under the loss mask)
                  | "<<SYS>>\\n" text "\\n<</SYS>>"    (system)
                  | "[INST] " text " [/INST]"          (any other role)

A turn is rendered with its text as it is, read back by the parser and compared
with the source; while it differs, or the content could be taken for one of the
template's control strings, the next way of escaping is tried: control strings
and backslashes first, then every ``<`` and ``[``. Escapes are a backslash and
a letter, so both are undone by the one parser. The finished conversation is
read back once more as a whole, and falls back to full escaping if it differs;
``round_trip`` says whether the result reads back, and ``chat_digests`` raises
an error where it does not.

Defined results: null text and null role are empty; turns go by (turn, role,
text), nulls first; repeated rows are repeated turns; a null conv_id is a
conversation of its own; other columns are ignored, also those named like the
operator's own; an empty table gives an empty result; a very long text is
escaped whole. A conversation is one row of the result and so of one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# ---------------------------------------------------------------- fixed values
# Control strings of the template, each with the letter that stands for it.
CONTROL = [("<s>", "s"), ("</s>", "e"), ("[INST]", "i"), ("[/INST]", "j"), ("<<SYS>>", "y"), ("<</SYS>>", "z")]
# ------------------------------------------------------------ end fixed values
BACKSLASH, LINE = ("\\", "b"), ("\n", "n")
FULL = [("<", "l"), ("[", "k")]
ASSISTANT, SYSTEM = "assistant", "system"


def _replace(c: Column, pairs) -> Column:
    for old, new in pairs:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def escaped(c: Column, level: int, line: bool = False) -> Column:
    """The text at an escaping level: 0 as it is, 1 control strings, 2 all openings."""
    if level == 0:
        return c
    marks = [BACKSLASH, *(CONTROL if level == 1 else FULL), *([LINE] if line else [])]
    return _replace(c, [(old, "\\" + letter) for old, letter in marks])


def unescaped(c: Column) -> Column:
    """Undoes every level: after a backslash stands a letter, the backslash's own last."""
    return _replace(c, [("\\" + letter, old) for old, letter in [*CONTROL, *FULL, LINE, BACKSLASH]])


def head(role: Column) -> Column:
    return F.concat(F.lit("<s>"), role, F.lit("\n"))


def _wrap(role: Column) -> tuple[Column, Column]:
    before = F.when(role == ASSISTANT, "").when(role == SYSTEM, "<<SYS>>\n").otherwise("[INST] ")
    after = F.when(role == ASSISTANT, "").when(role == SYSTEM, "\n<</SYS>>").otherwise(" [/INST]")
    return before, after


def rendered(role: Column, text: Column, level: int) -> Column:
    before, after = _wrap(role)
    return F.concat(head(escaped(role, level, True)), before, escaped(text, level), after, F.lit("</s>"))


def parsed_turn(piece: Column) -> Column:
    """(role, text) of one turn without its closing string."""
    inner = F.substr(piece, F.lit(4))
    at = F.instr(inner, "\n")
    role = unescaped(F.substr(inner, F.lit(1), at - 1))
    body = F.substr(inner, at + 1)
    before, after = _wrap(role)
    text = F.substr(body, F.length(before) + 1, F.length(body) - F.length(before) - F.length(after))
    return F.struct(role.alias("role"), unescaped(text).alias("text"))


def parsed(formatted: Column) -> Column:
    """The turns of a formatted conversation."""
    pieces = F.split(formatted, "</s>")
    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), parsed_turn)


def _round_trip(role: Column, text: Column, level: int) -> Column:
    """Whether the turn reads back identically and its content holds no control string."""
    out = rendered(role, text, level)
    same = F.to_json(parsed(out)) == F.to_json(F.array(F.struct(role.alias("role"), text.alias("text"))))
    clear = F.lit(True)
    for s, _ in CONTROL:
        clear = clear & ~F.contains(escaped(role, level, True), F.lit(s)) & ~F.contains(escaped(text, level), F.lit(s))
    return same & clear


def format_chats(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns, loss_spans, round_trip): turns read back from
    ``formatted``; loss_spans (start, length, in characters of ``formatted``)
    cover each assistant text."""
    role, text = F.col("role"), F.col("text")
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("level", F.when(_round_trip(role, text, 0), 0).when(_round_trip(role, text, 1), 1).otherwise(2))

    def by_level(f) -> Column:
        return F.when(F.col("level") == 0, f(0)).when(F.col("level") == 1, f(1)).otherwise(f(2))

    rows = rows.withColumn("piece", by_level(lambda k: rendered(role, text, k)))
    rows = rows.withColumn("skip", by_level(lambda k: F.length(head(escaped(role, k, True)))))
    rows = rows.withColumn("size", by_level(lambda k: F.length(escaped(text, k))))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("at", F.coalesce(F.sum(F.length("piece")).over(order), F.lit(0)))
    one = F.struct("turn", "role", "text", "at", "piece", "skip", "size")
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("rows"))
    source = F.transform("rows", lambda r: F.struct(r["role"].alias("role"), r["text"].alias("text")))
    spans = F.transform(F.filter("rows", lambda r: r["role"] == ASSISTANT), lambda r: F.struct(
        (r["at"] + r["skip"]).alias("start"), r["size"].alias("length")))
    out = grouped.select("conv_id", F.array_join(F.transform("rows", lambda r: r["piece"]), "").alias("formatted"),
                         source.alias("source"), spans.alias("loss_spans"))
    out = out.withColumn("turns", parsed(F.col("formatted")))
    out = out.withColumn("same", F.to_json("turns") == F.to_json("source"))

    def full(before: Column) -> Column:
        return F.array_join(F.transform(before, lambda r: rendered(r["role"], r["text"], 2)), "")

    full_spans = F.filter(F.transform("source", lambda r, i: F.struct(
        (F.length(full(F.slice("source", F.lit(1), i))) + F.length(head(escaped(r["role"], 2, True)))).cast("long").alias("start"),
        F.length(escaped(r["text"], 2)).alias("length"), r["role"].alias("role"))), lambda r: r["role"] == ASSISTANT)
    out = out.withColumn("formatted", F.when(F.col("same"), F.col("formatted")).otherwise(full(F.col("source"))))
    out = out.withColumn("loss_spans", F.when(F.col("same"), F.col("loss_spans")).otherwise(
        F.transform(full_spans, lambda r: F.struct(r["start"].alias("start"), r["length"].alias("length")))))
    out = out.withColumn("turns", F.when(F.col("same"), F.col("turns")).otherwise(parsed(F.col("formatted"))))
    return out.select("conv_id", "formatted", "turns", "loss_spans",
                      (F.col("same") | (F.to_json("turns") == F.to_json("source"))).alias("round_trip"))


def chat_digests(turns: DataFrame) -> DataFrame:
    """What a reader of the formatted text recovers, as counts and digests. The
    loss columns are cut from the text by its mask, ``loss_spans``."""
    chats = format_chats(turns)
    broken = F.raise_error(F.lit("a formatted conversation does not read back")).cast("array<struct<role:string,text:string>>")
    chats = chats.withColumn("turns", F.when(F.col("round_trip"), F.col("turns")).otherwise(broken))
    line = F.lit("\n")
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], line, t["text"], line)), "")
    loss = F.array_join(F.transform("loss_spans", lambda s: unescaped(
        F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
    return chats.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
                        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                        F.length("formatted").cast("long").alias("formatted_chars"))
