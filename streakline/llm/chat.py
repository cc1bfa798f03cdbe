"""Chat formatting by event-sourced reconstruction.

A conversation is a log of events.  Folding it is relational: the last reset of
a message voids its earlier pieces, and a regeneration voids the messages that
had been opened after its own.  The surviving pieces are partitioned by
conversation, sorted by sequence and rendered as a stream, so a task never holds
a conversation, however long.

Events (any further columns are ignored): conv_id, message, seq (any type with
an order, unique within a message), kind, role, text.  ``start`` opens a message, ``delta`` appends to it,
``edit`` replaces its text so far, ``regenerate`` does so and drops the messages
that began after it and before the event.  ``text`` of the last two is the first
piece of the new text.  A message without ``start`` begins at its first event
and has the empty role.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from streakline.llm.tables import stored

OPEN, BODY, CLOSE = "<s>[INST]", "[/INST]", "</s>\n"
#: Characters of a streamed delta, and of a part of the formatted text (a part ends at a piece's end).
DELTA_CHARS, PART_CHARS = 4096, 1 << 16
LOSS_ROLE = "assistant"


def escape(text: str) -> str:
    """Control strings begin with < or [ and none has a backslash next; in texts one always follows."""
    return text.replace("<", "<\\").replace("[", "[\\")


def unescape(text: str) -> str:
    return re.sub(r"([<\[])\\", r"\1", text)


def events_of(conversations: DataFrame) -> DataFrame:
    """Streamed events of finished rows (conv_id, turn, role, text): a start, then deltas of DELTA_CHARS characters.

    Rows with equal turns follow each other by a hash of role and text; repeated rows are messages of their own.
    """
    rows = conversations.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("message"),
    ).withColumn("tie", F.xxhash64("role", "text"))
    steps = F.sequence(F.lit(0), F.ceil(F.char_length("text") / DELTA_CHARS).cast("int"))
    sub = F.col("sub")
    return rows.withColumn("sub", F.explode(steps)).select(
        "conv_id", "message", F.struct("turn", "tie", "message", "sub").alias("seq"),
        F.when(sub == 0, "start").otherwise("delta").alias("kind"), "role",
        F.when(sub > 0, F.expr(f"substring(text, (sub - 1) * {DELTA_CHARS} + 1, {DELTA_CHARS})")).otherwise("").alias("text"),
    )


def fold(events: DataFrame) -> DataFrame:
    """Final pieces of text: conv_id, place (of the message), seq, role, text; a message without text has its start's empty piece."""
    key = ["conv_id", "message"]
    same = lambda a, b: F.expr(f"{a}.conv_id <=> {b}.conv_id and {a}.message <=> {b}.message")
    begun = F.col("kind") == "start"
    messages = events.groupBy(*key).agg(
        F.min("seq").alias("place"), F.coalesce(F.min_by("role", F.when(begun, F.col("seq"))), F.lit("")).alias("of_role"),
        F.max(F.when(F.col("kind").isin("edit", "regenerate"), F.col("seq"))).alias("reset"),
    )
    # a message goes when a regeneration of an earlier one came after it began: running over the events from the last to the first
    regenerated = events.filter("kind = 'regenerate'").select(*key, F.col("seq").alias("at")).alias("r")
    m = messages.alias("m")
    again = regenerated.join(m, same("r", "m")).select("m.conv_id", F.col("at"), F.col("place").alias("from_place"))
    touched = again.select(F.col("conv_id").alias("touched")).distinct()
    begins = messages.join(touched, F.col("conv_id").eqNullSafe(F.col("touched")), "left_semi")
    later = Window.partitionBy("conv_id").orderBy(F.col("at").desc()).rowsBetween(Window.unboundedPreceding, -1)
    dropped = (
        begins.select("conv_id", "message", F.col("place").alias("at"), F.lit(None).cast(events.schema["seq"].dataType).alias("from_place"), "place")
        .unionByName(again.withColumns({"message": F.lit(None), "place": F.lit(None)}))
        .withColumn("least", F.min("from_place").over(later))
        .filter("place is not null and least < place").select("conv_id", "message").alias("d")
    )
    live = m.join(dropped, same("m", "d"), "left_anti").select("conv_id", "message", "place", "of_role", "reset").alias("l")
    e = events.filter("kind in ('start', 'delta', 'edit', 'regenerate')").alias("e")
    return (
        e.join(live, same("e", "l"))
        .withColumn("void", F.coalesce(F.col("e.seq") < F.col("l.reset"), F.lit(False)))
        .filter(~F.col("void") | (F.col("e.seq") == F.col("l.place")))  # a message's first event stays to open it
        .select(
            F.col("e.conv_id").alias("conv_id"), F.col("l.place").alias("place"), F.col("e.seq").alias("seq"), F.col("l.of_role").alias("role"),
            F.when((F.col("e.kind") == "start") | F.col("void"), "").otherwise(F.coalesce(F.col("e.text").cast("string"), F.lit(""))).alias("text"),
            (F.col("e.seq") == F.col("l.place")).alias("first"),
        )
    )


def _render(id_type: pa.DataType):
    def run(batches):
        conv, started = None, False
        part, size, loss = 0, 0, []
        pieces: list[str] = []
        in_loss = False
        out: list[tuple] = []

        def cut():
            nonlocal part, size, pieces, loss
            if pieces:
                out.append((conv, part, "".join(pieces), loss))
                part += 1
            size, pieces, loss = 0, [], []

        def put(text: str, counts: bool) -> None:
            nonlocal size
            if counts and text:
                loss.append({"start": size, "end": size + len(text)})
            pieces.append(text)
            size += len(text)

        def rows():
            batch = list(zip(*out)) or [[]] * 4
            kinds = (id_type, pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(batch, kinds)], names=["conv_id", "part", "text", "loss"])

        for batch in batches:
            for c, role, text, first in zip(*(x.to_pylist() for x in batch.columns)):
                if not started or c != conv:
                    if started:
                        put(CLOSE, False)
                        cut()
                    conv, started, part = c, True, 0
                elif first:
                    put(CLOSE, False)
                if first:
                    put(OPEN + escape(role) + BODY, False)
                    in_loss = role == LOSS_ROLE
                put(escape(text), in_loss)
                if size >= PART_CHARS:
                    cut()
            if out:
                yield rows()
        if started:
            put(CLOSE, False)
            cut()
        if out:
            yield rows()

    return run


def render(pieces: DataFrame) -> DataFrame:
    """Formatted text in parts: conv_id, part (from 0), text, loss (spans of the part, in code points, that count for the loss).

    A conversation is the concatenation of its parts.  Every turn is
    ``<s>[INST]role[/INST]text</s>`` and a line feed, with role and text escaped.
    """
    kind = pieces.schema["conv_id"].dataType
    ordered = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "place", "seq")
    return ordered.select("conv_id", "role", "text", "first").mapInArrow(
        _render(to_arrow_type(kind)), f"conv_id {kind.simpleString()}, part long, text string, loss array<struct<start: bigint, end: bigint>>"
    )


CONTROL = re.compile(r"<s>\[INST\]|\[/INST\]|</s>\n")


def _read(id_type: pa.DataType):
    """Turns and loss text out of the parts of each conversation, without holding more than a part."""

    def run(batches):
        conv, started = None, False
        state = None

        def fresh():
            return {"turns": 0, "all": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0, "chars": 0}

        def result():
            return (conv, state["turns"], state["all"].hexdigest(), state["loss_chars"], state["loss"].hexdigest(), state["chars"])

        def read(text: str, loss: list[dict]) -> None:
            at = 0
            for match in CONTROL.finditer(text):
                state["all"].update(unescape(text[at : match.start()]).encode())
                at = match.end()
                if match[0] == OPEN:
                    state["turns"] += 1
                else:
                    state["all"].update(b"\n")
            state["all"].update(unescape(text[at:]).encode())
            for span in loss:
                under = unescape(text[span["start"] : span["end"]])
                state["loss"].update(under.encode())
                state["loss_chars"] += len(under)
            state["chars"] += len(text)

        def rows(out):
            kinds = (id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * 6, kinds)],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

        for batch in batches:
            out = []
            for c, text, loss in zip(*(x.to_pylist() for x in batch.columns)):
                if not started or c != conv:
                    if started:
                        out.append(result())
                    conv, started, state = c, True, fresh()
                read(text, loss)
            yield rows(out)
        if started:
            yield rows([result()])

    return run


def read_back(parts: DataFrame) -> DataFrame:
    """Per conversation, read from the formatted parts: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    kind = parts.schema["conv_id"].dataType
    return parts.repartition("conv_id").sortWithinPartitions("conv_id", "part").select("conv_id", "text", "loss").mapInArrow(
        _read(to_arrow_type(kind)),
        f"conv_id {kind.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


def format_chats(events: DataFrame) -> DataFrame:
    """Stored formatted parts of the conversations that ``events`` fold to (see :func:`render`)."""
    return stored(render(fold(events)), "chats")
