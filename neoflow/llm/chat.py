"""Chat formatting by event-sourced reconstruction.

A log holds events (conv_id, message_id, seq, kind, role, text): ``open`` starts a
message, ``delta`` appends a streamed part, ``edit`` puts another text in place
of what is there, ``regenerate`` throws it away for deltas that follow. The log
is partitioned by conversation and, within it, message, so that a conversation
with a third of all events is split; each message's events are folded in order
of seq. Messages are ordered by their opening event and rendered by a template
whose control strings can't come from a text.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, BREAK, END = "<s>", "\n", "</s>\n"
#: Role whose texts are learned from.
LEARNED = "assistant"
#: Characters of a delta in a log made from turns.
DELTA = 1000
#: Every control string begins with "<" or "["; "&" comes first, so that this can be undone.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lbrack;"))

_ESCAPED = re.compile("&(?:amp|lt|lbrack|break);")
_PLAIN = {"&amp;": "&", "&lt;": "<", "&lbrack;": "[", "&break;": "\n"}


def escape(text: Column) -> Column:
    for plain, name in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(name))
    return text


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _PLAIN[m[0]], text) if "&" in text else text


def reconstruct(events: DataFrame) -> DataFrame:
    """Events -> (conv_id, message_id, opened, role, text), one row per message.

    A null text is empty, a null role the empty role. A message without an
    ``open`` event is left out. Events that repeat a seq apply in the order of their
    kind, then text; an empty log has no messages.
    """
    message = Window.partitionBy("conv_id", "message_id")
    begins = F.col("kind").isin("open", "edit", "regenerate")
    order = F.struct(F.col("seq").alias("seq"), F.col("kind").alias("kind"))
    last = F.max(F.when(begins, order)).over(message)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o", "t"))), lambda x: x["t"]), "")
    live = events.withColumns({"o": order, "last": last, "t": F.coalesce("text", F.lit(""))})
    opening = F.col("kind") == "open"
    return (live.withColumn("t", F.when(F.col("o") >= F.col("last"), F.col("t")))
            .groupBy("conv_id", "message_id")
            .agg(F.min(F.when(opening, F.col("seq"))).alias("opened"),
                 F.min(F.when(opening, F.coalesce("role", F.lit("")))).alias("role"), text.alias("text"))
            .filter(F.col("opened").isNotNull()))


def render(messages: DataFrame) -> DataFrame:
    """Adds ``rendered`` (the message's part of the conversation's formatted text: parts
    in order of ``opened`` make the whole), ``loss_start`` and ``loss_end`` (code points
    within it; equal where nothing is learned)."""
    role = F.replace(escape(F.col("role")), F.lit("\n"), F.lit("&break;"))
    head, body = F.concat(F.lit(TURN), role, F.lit(BREAK)), escape(F.col("text"))
    start = F.length(head).cast("long")
    return messages.select("*", F.concat(head, body, F.lit(END)).alias("rendered"), start.alias("loss_start"),
                           F.when(F.col("role") == LEARNED, start + F.length(body)).otherwise(start).alias("loss_end"))


def read_back(rendered: str) -> tuple[str, str]:
    """(role, text) of one turn of formatted text."""
    if not (rendered.startswith(TURN) and rendered.endswith(END)):
        raise ValueError("not a turn of this template")
    role, _, text = rendered[len(TURN):-len(END)].partition(BREAK)
    return unescape(role), unescape(text)


class _Digest:
    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = 0

    def add(self, rendered: str, start: int, end: int) -> None:
        role, text = read_back(rendered)
        self.turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        learned = unescape(rendered[start:end])
        self.loss.update(learned.encode("utf-8", "surrogatepass"))
        self.n, self.loss_chars, self.chars = self.n + 1, self.loss_chars + len(learned), self.chars + len(rendered)

    def row(self, conv_id) -> dict:
        return {"conv_id": conv_id, "n_turns": self.n, "turns_sha256": self.turns.hexdigest(),
                "loss_chars": self.loss_chars, "loss_sha256": self.loss.hexdigest(), "formatted_chars": self.chars}


_ROW = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long")


def _digests(batches):
    """Rows come sorted by conversation and place; only running hashes are held."""
    now, digest = None, None
    fields = pa.schema([(n, pa.string() if kind == "string" else pa.int64())
                        for n, kind in (x.split() for x in _ROW.split(", "))])
    for batch in batches:
        done = []
        for conv, text, start, end in zip(*(c.to_pylist() for c in batch.columns)):
            if digest is None or conv != now:
                if digest is not None:
                    done.append(digest.row(now))
                now, digest = conv, _Digest()
            digest.add(text, start, end)
        yield pa.RecordBatch.from_pylist(done, schema=fields)
    if digest is not None:
        yield pa.RecordBatch.from_pylist([digest.row(now)], schema=fields)


def conversation_digests(rendered: DataFrame) -> DataFrame:
    """Each conversation's formatted text, read back turn by turn, as counts and hashes."""
    return (rendered.select(F.col("conv_id").cast("long").alias("conv_id"), "opened", "rendered",
                            "loss_start", "loss_end")
            .repartition("conv_id").sortWithinPartitions("conv_id", "opened")
            .select("conv_id", "rendered", "loss_start", "loss_end").mapInArrow(_digests, _ROW))


def events_of_turns(turns: DataFrame) -> DataFrame:
    """A table of turns (conv_id, turn, role, text) as a log that could have made it: each turn is
    opened and its text streamed in deltas of DELTA characters. By a hash of the turn, a quarter
    stream a draft first that is regenerated, a quarter one that an edit replaces by the first part.
    Rows that repeat a turn follow each other by role and text (null first)."""
    tie = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text"))
    turns = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", tie.alias("tie"))
    none = F.lit(None).cast("string")
    event = lambda kind, text, role=none: F.struct(
        F.lit(kind).alias("kind"), role.alias("role"), text.alias("text"))
    parts = F.coalesce(F.regexp_extract_all("text", F.lit(f"(?s).{{1,{DELTA}}}"), F.lit(0)), F.array().cast("array<string>"))
    deltas = F.transform("parts", lambda x: event("delta", x))
    draft = event("delta", F.concat(F.lit("Draft: "), F.coalesce(F.get("parts", F.lit(0)), F.lit(""))))
    way = F.pmod(F.xxhash64("conv_id", "turn", "tie"), F.lit(4))
    after = (F.when(way == 0, F.concat(F.array(draft, draft, event("regenerate", none)), deltas))
             .when(way == 1, F.concat(F.array(draft, event("edit", F.get("parts", F.lit(0)))),
                                      F.slice(deltas, F.lit(2), F.greatest(F.size("parts"), F.lit(1)))))
             .otherwise(deltas))
    return (turns.withColumn("parts", parts)
            .select("conv_id", "turn", "tie", F.posexplode(
                F.concat(F.array(event("open", none, F.col("role"))), after)).alias("step", "e"))
            .select("conv_id", F.struct("turn", "tie").alias("message_id"),
                    F.struct("turn", "tie", "step").alias("seq"), "e.kind", "e.role", "e.text"))
