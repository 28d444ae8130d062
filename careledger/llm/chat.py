r"""Chat formatting from an event log.

A log holds one row per event of a conversation: kind delta appends text to a message, edit replaces
it, regenerate clears it for the deltas that follow. An edit or a regeneration also takes back
all that was logged before it for later messages. Events are dealt by conversation and sorted by
sequence; which events stand is one running minimum over the later ones, so no conversation is
held in memory. Deltas that stand are joined for each message, and each message is rendered:

    <s>[ROLE]role[/ROLE]text</s>

Inside roles and texts every < and [ gets a backslash behind it and every backslash is doubled, so
no control string survives in them and unescaping gives back each text exactly.

Defined results: null texts and roles are empty; events without a message number belong to message
null, which comes first; events of one sequence number count in the order of message, kind, text;
conversations without an id are one conversation; repeated events are repeated (as deltas they
append twice), unless drop_repeats is set for logs that may deliver an event twice.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_PIECE = re.compile(r"<s>\[ROLE\](.*?)\[/ROLE\](.*)</s>", re.DOTALL)
_ESCAPED = re.compile(r"([<\[])\\|\\(\\)")
# Roles whose texts are under the loss mask.
TRAINED = ("assistant",)


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), r"([<\[])", r"$1\\")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def messages(events: DataFrame, drop_repeats: bool = False) -> DataFrame:
    """conv_id, message, role, text: the final messages of events (conv_id, seq, message, kind, role,
    text); a message whose events were all taken back is gone."""
    events = events.select(
        "conv_id", "seq", "message", "kind", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    if drop_repeats:
        events = events.dropDuplicates()
    # From the last event back: the earliest message that anything later takes back from.
    later = Window.partitionBy("conv_id").orderBy(
        F.desc("seq"), F.desc("message"), F.desc("kind"), F.desc("text"),
    ).rowsBetween(Window.unboundedPreceding, -1)
    from_here = F.when(F.col("kind").isin("edit", "regenerate"), F.coalesce("message", F.lit(-(2**63))))
    at = F.coalesce("message", F.lit(-(2**63)))
    stands = events.withColumn("cut", F.min(from_here).over(later)).where(F.col("cut").isNull() | (at < F.col("cut")))
    parts = F.array_sort(F.collect_list(F.struct("seq", "kind", "text", "role")))
    return (
        stands.groupBy("conv_id", "message").agg(parts.alias("parts"))
        .select(
            "conv_id", "message", F.element_at(F.col("parts.role"), -1).alias("role"),
            F.array_join(F.col("parts.text"), "").alias("text"),
        )
    )


def render(final: DataFrame) -> DataFrame:
    """conv_id, message, piece: the template around each final message. A conversation is its pieces in
    the order of message."""
    return final.select("conv_id", "message", F.concat(
        F.lit("<s>[ROLE]"), escape(F.col("role")), F.lit("[/ROLE]"), escape(F.col("text")), F.lit("</s>"),
    ).alias("piece"))


def read_back(piece: str) -> tuple[str, str]:
    """(role, text) of a rendered message."""
    role, text = _PIECE.fullmatch(piece).groups()
    return unescape(role), unescape(text)


def _digest(id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = object()
        now, n, chars, loss = none, 0, 0, 0
        turns, trained = hashlib.sha256(), hashlib.sha256()

        def row():
            return pa.RecordBatch.from_arrays([
                pa.array([now], id_type), pa.array([n], pa.int64()), pa.array([turns.hexdigest()]),
                pa.array([loss], pa.int64()), pa.array([trained.hexdigest()]), pa.array([chars], pa.int64()),
            ], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for batch in batches:
            for conv, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if conv != now or now is none:
                    if now is not none:
                        yield row()
                    now, n, chars, loss = conv, 0, 0, 0
                    turns, trained = hashlib.sha256(), hashlib.sha256()
                role, text = read_back(piece)
                n, chars = n + 1, chars + len(piece)
                turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                if role in TRAINED:
                    loss += len(text)
                    trained.update(text.encode("utf-8", "surrogatepass"))
        if now is not none:
            yield row()

    return run


def digests(pieces: DataFrame) -> DataFrame:
    """One row per conversation, read back from its rendered pieces as they stream by in order."""
    kind = pieces.schema["conv_id"].dataType.simpleString()
    id_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    return (
        pieces.repartition("conv_id").sortWithinPartitions("conv_id", "message").select("conv_id", "piece")
        .mapInArrow(_digest(id_type), f"conv_id {kind}, n_turns bigint, turns_sha256 string, "
                    "loss_chars bigint, loss_sha256 string, formatted_chars bigint")
    )


def log_of(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """An event log of finished conversations: each row one message by a single delta. Rows that share
    a turn stay messages of their own, by role and text."""
    rows = turns.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    number = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("bigint")
    return rows.withColumn("message", number).select(
        "conv_id", F.col("message").alias("seq"), "message", F.lit("delta").alias("kind"), "role", "text",
    )
