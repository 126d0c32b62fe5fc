"""Chat formatting with a grammar round trip.

A turn is rendered as ``<|im_start|>role LF text<|im_end|> LF``. The rendered
conversation is read again by a deterministic parser and compared with the
source. Turns that do not come back alike on their own are escaped, and the whole
is compared again, until it is identical. The escape puts one backslash more
into each ``<\\...\\|`` (and writes a line feed in a role as backslash n, a
backslash there as two); the parser takes one away from each. So it is reversible for
every text, and an escaped text has no ``<|`` and hence no control string.

Turns are brought together by conversation and sorted by Spark; a task streams
them and holds one conversation at a time, as its rendered text is one value.
Hot first turns or texts do not matter, as only the conversation is a key.

Defined cases: a null text or role is an empty one; a null conversation id is a
conversation of its own; turns are sorted by turn (null last), then role and
text, and rows that repeat a turn all stay; an empty table gives an empty table;
further columns never matter.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarifa.llm.common import partitions, type_of

START, END = "<|im_start|>", "<|im_end|>"
_CONFLICT, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
Turn = tuple[str, str]


def escape(text: str) -> str:
    return _CONFLICT.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def _escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role), flags=re.S)


def render(turns: list[Turn], escaped: list[bool]) -> tuple[str, list[tuple[int, int]]]:
    """The text, and where each turn's text begins and ends in it."""
    parts, spans, at = [], [], 0
    for (role, text), e in zip(turns, escaped, strict=True):
        head = START + (_escape_role(role) if e else role) + "\n"
        body = escape(text) if e else text
        parts += [head, body, END, "\n"]
        spans.append((at + len(head), at + len(head) + len(body)))
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), spans


def parse(text: str) -> list[Turn] | None:
    """The turns of a rendered text; None if it is not in the language."""
    turns, at = [], 0
    while at < len(text):
        if not text.startswith(START, at):
            return None
        line = text.find("\n", at)
        end = text.find(END, line) if line >= 0 else -1
        if end < 0 or not text.startswith("\n", end + len(END)):
            return None
        turns.append((_unescape_role(text[at + len(START) : line]), unescape(text[line + 1 : end])))
        at = end + len(END) + 1
    return turns


def format_turns(turns: list[Turn], learn: frozenset[str] = frozenset({"assistant"})) -> tuple[str, list[tuple[int, int]]]:
    """The rendered text and the spans under the loss mask."""
    escaped = [False] * len(turns)
    while True:
        text, spans = render(turns, escaped)
        if parse(text) == turns:
            return text, [s for s, (role, _) in zip(spans, turns, strict=True) if role in learn]
        clash = [e or parse(render([t], [False])[0]) != [t] for e, t in zip(escaped, turns, strict=True)]
        escaped = clash if clash != escaped else [True] * len(turns)


def _format(batches: Iterator[pa.RecordBatch], learn: frozenset[str], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    now, turns, out = None, [], []

    def close():
        if turns:
            text, spans = format_turns(turns, learn)
            out.append((now[0], len(turns), text, [{"start": a, "stop": b} for a, b in spans]))

    def flush():
        columns = list(zip(*out, strict=True))
        types = [kind, pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))]
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["id", "n_turns", "formatted", "loss"])

    for batch in batches:
        size = 0
        for i, role, text in zip(*(batch.column(c).to_pylist() for c in ("id", "role", "text")), strict=True):
            if now != (i,):
                close()
                now, turns = (i,), []
            turns.append((role or "", text or ""))
            size += len(text or "")
            if size > 8 << 20 and out:
                yield flush()
                size = 0
        if out:
            yield flush()
    close()
    if out:
        yield flush()


def formatted(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", learn: frozenset[str] = frozenset({"assistant"})) -> DataFrame:
    """(id, n_turns, formatted, loss): one row a conversation; loss: spans of code points to learn from."""
    from functools import partial

    from pyspark.sql.pandas.types import to_arrow_type

    rows = conversations.select(F.col(id_col).alias("id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    rows = rows.repartition(partitions(conversations.sparkSession), "id").sortWithinPartitions("id", F.col("turn").asc_nulls_last(), "role", "text")
    run = partial(_format, learn=learn, kind=to_arrow_type(conversations.schema[id_col].dataType))
    return rows.mapInArrow(run, f"id {type_of(conversations, id_col)}, n_turns bigint, formatted string, loss array<struct<start:bigint,stop:bigint>>").withColumnRenamed("id", id_col)


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, loss in zip(batch.column("formatted").to_pylist(), batch.column("loss").to_pylist(), strict=True):
            turns = parse(text)
            whole, learnt, chars = hashlib.sha256(), hashlib.sha256(), 0
            for role, said in turns:
                whole.update(f"{role}\n{said}\n".encode())
            for span in loss:
                said = unescape(text[span["start"] : span["stop"]])
                learnt.update(said.encode())
                chars += len(said)
            out.append((len(turns), whole.hexdigest(), chars, learnt.hexdigest(), len(text)))
        columns = list(zip(*out, strict=True)) if out else [[]] * 5
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([batch.column("id"), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]], names=["id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def digests(texts: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """What the parser reads back from formatted conversations, one row each."""
    rows = texts.select(F.col(id_col).alias("id"), "formatted", "loss")
    return rows.mapInArrow(_read_back, f"id {type_of(texts, id_col)}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint").withColumnRenamed("id", id_col)
