"""Chat formatting with a grammar round trip.

Turns are rendered as ``<|im_start|>role`` newline text ``<|im_end|>`` newline. A deterministic parser reads the rendered text
back; turns that it recovers differently are escaped and the conversation is rendered and parsed again, until source and
recovered turns are identical. Texts without conflicts stay as they are. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
# Escaping lengthens every ``<``, backslashes, ``|`` by one backslash; the parser always takes one away again.
_CONTROL = r"<(\\*)\|"
_ESCAPED = r"<\\(\\*)\|"


def escape_text(text: Column) -> Column:
    """No ``<|`` remains, and ``unescape_text`` gives back the text exactly."""
    return F.regexp_replace(text, F.lit(_CONTROL), F.lit(r"<\\$1|"))


def unescape_text(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_ESCAPED), F.lit("<$1|"))


_ROLE_ESCAPES = {"%": "%25", "\n": "%0A", "<": "%3C", "|": "%7C"}


def escape_role(role: Column) -> Column:
    """A role must not end its line or hold a control string."""
    for raw, code in _ROLE_ESCAPES.items():
        role = F.replace(role, F.lit(raw), F.lit(code))
    return role


def unescape_role(role: Column) -> Column:
    for raw, code in reversed(_ROLE_ESCAPES.items()):
        role = F.replace(role, F.lit(code), F.lit(raw))
    return role


def render(turns: Column) -> Column:
    """One text from turns that are structs of ``role`` and ``text``, as they stand."""
    parts = F.transform(turns, lambda t: F.concat(F.lit(START), t["role"], F.lit("\n"), t["text"], F.lit(END)))
    return F.array_join(parts, "")


def parse(formatted: Column) -> Column:
    """The turns of a rendered text. A turn ends at the first end mark; its role is what stands before the first newline.
    Escapes are undone. What does not begin with a start mark becomes a turn with a NULL role, so it equals no source."""
    pieces = F.split(formatted, r"<\|im_end\|>\n")
    whole = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    rest = F.element_at(pieces, -1)
    pieces = F.when(rest == "", whole).otherwise(F.concat(whole, F.array(F.concat(F.lit("\n"), rest))))

    def turn(piece: Column) -> Column:
        line = F.substring_index(piece, "\n", 1)
        good = F.startswith(piece, F.lit(START)) & (F.instr(piece, "\n") > 0) & ~F.contains(F.substr(piece, F.lit(len(START) + 1)), F.lit(START))
        return F.struct(
            F.when(good, unescape_role(F.substr(line, F.lit(len(START) + 1)))).alias("role"),
            unescape_text(F.substr(piece, F.length(line) + 2)).alias("text"),
        )

    return F.transform(pieces, turn)


def _loss_spans(turns: Column) -> Column:
    """[begin, end) in code points of each assistant text in the rendered turns (as rendered, with escapes)."""
    head = lambda t: F.length(t["role"]) + len(START) + 1
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<role:string,begin:int,end:int>>").alias("spans"))

    def step(state: Column, t: Column) -> Column:
        first = state["at"] + head(t)
        last = first + F.length(t["text"])
        span = F.struct(t["role"].alias("role"), first.alias("begin"), last.alias("end"))
        return F.struct((last + len(END)).alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    spans = F.filter(F.aggregate(turns, begin, step)["spans"], lambda s: s["role"] == "assistant")
    return F.transform(spans, lambda s: F.struct(s["begin"].alias("begin"), s["end"].alias("end")))


def loss_texts(formatted: Column, loss_spans: Column) -> Column:
    """The texts that the loss mask covers, cut out of the rendered text by its spans, with escapes undone."""
    return F.transform(loss_spans, lambda s: unescape_text(F.substr(formatted, s["begin"] + 1, s["end"] - s["begin"])))


def format_chats(rows: DataFrame, rounds: int = 3) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, ``loss_spans``, ``escaped_turns`` and ``identical``.

    Input rows have conv_id, turn, role, text; other columns are ignored. Turns are ordered by turn, then role and text, so
    that ties have one order; repeated rows are turns of their own. A NULL text or role counts as empty, NULL turns come
    first, rows with a NULL conv_id form one conversation. An empty table gives no rows. In each of at most ``rounds``
    rounds those turns are escaped that the parser got wrong, and in a text whose number of turns is wrong all that hold a
    control string; the second round already finds nothing left, so ``identical`` is always true.

    A conversation is one text and so one row: its turns meet in one task, whatever else is in the table.
    """
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    ordered = F.array_sort(F.collect_list(F.struct(F.coalesce("turn", F.lit(-(2**63))).alias("turn"), role.alias("role"), text.alias("text"))))
    chats = rows.groupBy("conv_id").agg(ordered.alias("_ordered")).select(
        "conv_id", F.transform("_ordered", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("_source"),
        F.transform("_ordered", lambda t: F.lit(False)).alias("_flags"),
    )
    for _ in range(rounds):
        chats = chats.withColumn("_turns", _with_escapes(F.col("_source"), F.col("_flags")))
        chats = chats.withColumn("formatted", render(F.col("_turns"))).withColumn("_parsed", parse(F.col("formatted")))
        same_count = F.size("_parsed") == F.size("_source")
        wrong = F.when(same_count, F.zip_with("_parsed", "_source", lambda p, s: ~p.eqNullSafe(s))).otherwise(
            F.transform("_source", _has_control)
        )
        chats = chats.withColumn("_flags", F.zip_with("_flags", wrong, lambda f, w: f | w))
    return chats.select(
        "conv_id", "formatted", _loss_spans(F.col("_turns")).alias("loss_spans"),
        F.size(F.filter("_flags", lambda f: f)).alias("escaped_turns"),
        F.col("_parsed").eqNullSafe(F.col("_source")).alias("identical"),
    )


def _has_control(turn: Column) -> Column:
    return F.contains(turn["text"], F.lit("<|")) | turn["role"].rlike(r"[\n<|]")


def _with_escapes(turns: Column, flags: Column) -> Column:
    return F.zip_with(turns, flags, lambda t, escaped: F.struct(
        F.when(escaped, escape_role(t["role"])).otherwise(t["role"]).alias("role"),
        F.when(escaped, escape_text(t["text"])).otherwise(t["text"]).alias("text"),
    ))
