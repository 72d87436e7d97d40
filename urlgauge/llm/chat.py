"""Chat formatting from event logs, in DataFrame functions only.

A log row is an event of a conversation: `kind` is message, delta, edit or regenerate. In the order
of `seq`, `message` and `delta` append text to the message `msg` (the first event creates it, with
its role), `edit` replaces its text and `regenerate` does so too, and both drop every message that
began after the changed one and before the event: what followed was an answer to the old text. Events of a
message that has been dropped change nothing. Such events are rare, so conversations where they may occur
are told by running counts and only those are folded event by event.

Rendering marks each turn as `<turn ROLE>TEXT</turn>` and a line feed. Inside texts `&` and `<` are
escaped as `&amp;` and `&lt;`, in roles `>` too as `&gt;`, so no text can open or close a turn, and
unescaping gives back every text exactly. `loss` holds one (start, length) pair, in code points from
0, per assistant message: the place of its escaped text in `formatted`.

A null text or role counts as empty, a null kind as message. A `message` event without a msg is a message
of its own, so equal rows are messages of their own; for the other kinds a null msg counts as seq. Rows of
one seq are ordered by role and text. A null conversation is a
conversation. A conversation is one output row, so its text has to fit in a row; conversations
are never split, but any number of them share the work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

CLOSE = "</turn>\n"
OPEN = "<turn "


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescape(text: Column) -> Column:
    text = F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&gt;"), F.lit(">"))
    return F.replace(text, F.lit("&amp;"), F.lit("&"))


def fold_events(log: DataFrame) -> DataFrame:
    """(conv_id, seq, kind, msg, role, text) to final messages (conv_id, seq, role, text).

    `seq` of a message is that of its first event; messages of the same first seq keep msg order."""
    kind = F.coalesce(F.col("kind"), F.lit("message"))
    rows = log.select(
        "conv_id", "seq", kind.isin("edit", "regenerate").alias("_reset"),
        ((kind == "message") & F.col("msg").isNull()).alias("_alone"),
        F.coalesce(F.col("msg").cast("string"), F.col("seq").cast("string")).alias("_msg"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("seq").asc_nulls_first(), F.col("role"), F.col("text")]
    # Shuffled once, by conversation: everything below is partitioned alike.
    within = Window.partitionBy("conv_id").orderBy(*order)
    rows = rows.withColumn("_at", F.row_number().over(within))
    rows = rows.withColumn("_own", F.when(F.col("_alone"), F.col("_at")))
    each = Window.partitionBy("conv_id", "_msg", "_own").orderBy("_at")
    seen = each.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumns({
        "_begin": F.min("_at").over(seen),
        "_last_reset": F.coalesce(F.max(F.when(F.col("_reset"), F.col("_at"))).over(seen), F.lit(0))})
    rows = _without_late_events(rows, within, each)
    messages = rows.groupBy("conv_id", "_msg", "_own", "_begin", "_last_reset", "_live").agg(
        F.min_by("seq", "_at").alias("seq"), F.min_by("role", "_at").alias("role"),
        F.sort_array(F.collect_list(F.when(
            F.col("_at") >= F.col("_last_reset"), F.struct("_at", "text")))).alias("_parts"))
    earlier = (Window.partitionBy("conv_id").orderBy("_begin")
               .rowsBetween(Window.unboundedPreceding, -1))
    reset_before = F.coalesce(F.max(F.when(F.col("_live").isNull(), F.col("_last_reset"))).over(earlier), F.lit(0))
    kept = messages.withColumn("_kept", F.coalesce("_live", reset_before <= F.col("_begin"))).where("_kept")
    return kept.select("conv_id", F.col("_begin").alias("seq"), "role",
                       F.array_join(F.col("_parts.text"), "").alias("text"))


def _without_late_events(rows: DataFrame, within: Window, each: Window) -> DataFrame:
    """Add `_live`: null, or, where a message is changed after a change of another may have dropped it, whether the
    message is left in the end; `_last_reset` is then that of its changes while it was not dropped."""
    before = within.rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.count_if("_reset").over(before), F.lit(0))
    rows = rows.withColumns({"_resets": earlier, "_own_resets": F.count_if("_reset").over(
        each.rowsBetween(Window.unboundedPreceding, -1))})
    since = F.col("_resets") - F.first("_resets").over(each.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("_late", F.col("_reset") & (since > F.coalesce("_own_resets", F.lit(0))))
    whole = within.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("_late", F.max("_late").over(whole))
    event = F.struct(F.col("_at").alias("at"), F.col("_begin").alias("begin"), F.col("_reset").alias("reset"))
    rows = rows.withColumn("_events", F.collect_list(F.when(F.col("_late"), event)).over(whole))
    left = F.when(F.col("_late") & (F.col("_at") == 1), F.aggregate(
        F.array_sort("_events"), F.array().cast("array<struct<begin:int,reset:int>>"), _after))
    rows = rows.withColumn("_left", left).drop("_events")
    rows = rows.withColumn("_left", F.max("_left").over(whole))
    own = F.get(F.filter("_left", lambda m: m["begin"] == F.col("_begin")), F.lit(0))
    return rows.withColumns({
        "_live": F.when(F.col("_late"), own.isNotNull()),
        "_last_reset": F.when(F.col("_late"), F.coalesce(own["reset"], F.lit(0))).otherwise(F.col("_last_reset"))})


def _after(messages: Column, event: Column) -> Column:
    """The messages left after an event: begin and last change of each, by begin."""
    def entry(reset: Column) -> Column:
        return F.struct(event["begin"].cast("int").alias("begin"), reset.cast("int").alias("reset"))

    changed = F.concat(F.filter(messages, lambda m: m["begin"] < event["begin"]), F.array(entry(event["at"])))
    there = F.exists(messages, lambda m: m["begin"] == event["begin"])
    return F.when(event["at"] == event["begin"], F.concat(messages, F.array(entry(F.when(event["reset"], event["at"]).otherwise(0))))) \
        .when(there & event["reset"], changed).otherwise(messages)


def render(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss array of (start, length)."""
    role = F.replace(escape(F.coalesce("role", F.lit(""))), F.lit(">"), F.lit("&gt;"))
    body = escape(F.coalesce("text", F.lit("")))
    rows = messages.withColumns({"_head": F.concat(F.lit(OPEN), role, F.lit(">")), "_body": body})
    length = F.length("_head") + F.length("_body") + len(CLOSE)
    order = Window.partitionBy("conv_id").orderBy(F.col("seq").asc_nulls_first(), F.col("role"), F.col("text"))
    run = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({"_place": F.row_number().over(order), "_end": F.sum(length).over(run)})
    start = (F.col("_end") - length + F.length("_head")).cast("bigint")
    piece = F.struct(
        "_place", F.concat("_head", "_body", F.lit(CLOSE)).alias("piece"),
        F.when(F.coalesce("role", F.lit("")) == loss_role, F.struct(
            start.alias("start"), F.length("_body").cast("bigint").alias("length"))).alias("loss"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(piece)).alias("_pieces"))
    return whole.select(
        "conv_id", F.array_join(F.col("_pieces.piece"), "").alias("formatted"),
        F.filter(F.col("_pieces.loss"), lambda x: x.isNotNull()).alias("loss"))


def read_turns(formatted: Column) -> Column:
    """The array of (role, text) that a formatted conversation holds."""
    parts = F.filter(F.split(formatted, CLOSE), lambda x: x != "")
    return F.transform(parts, lambda x: F.struct(
        unescape(F.substring_index(F.substr(x, F.lit(len(OPEN) + 1)), ">", 1)).alias("role"),
        unescape(F.substr(x, F.instr(x, ">") + 1)).alias("text")))


def read_loss(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, joined without anything between."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substr(
        formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def digests(rendered: DataFrame) -> DataFrame:
    """Counts and digests read back from the rendered conversations."""
    read = rendered.select(
        "conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"),
        read_loss(F.col("formatted"), F.col("loss")).alias("lost"))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
        F.length("lost").cast("bigint").alias("loss_chars"), F.sha2(F.col("lost"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))
