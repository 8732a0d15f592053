"""Chat formatting by columnar byte assembly, with a loss mask.

A turn is written between the markers of its role, its text with every control
string escaped: ``[SYS] text [/SYS]``, ``[INST] text [/INST]`` (user),
``<s> text </s>`` (assistant), ``[ROLE] role [AS] text [/ROLE]`` (any other).
A control string in a text, with any number of backslashes after its first
character, gets one more there; reading takes one away.  No unescaped control
string is left in a text, and none can form across a marker's edge, so the
formatted string reads back to exactly the same turns.  The loss mask lists
the UTF-8 byte ranges of the assistant texts in the formatted string.

Turns are sorted by conversation, turn, role and text in range partitions, so
a conversation of any size is spread over tasks.  A task formats its slice
column by column: segment lengths, cumulative offsets and scatter indices in
numpy, headers and texts copied into one preallocated buffer that becomes the
Arrow column.  A conversation that begins and ends inside a slice is one
``whole`` row; others come in several parts, in the order of ``part``.

Results in special cases: null or empty text is an empty text; a null role is
the role ``""``; null turns come first; turns that share a number go by role,
then text, and repeated rows are turns of their own; rows with a null
conversation id form one conversation with a null id; a conversation without
assistant turns has an empty mask; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlens.llm.common import Stages, plain, read_table, ship
from offerlens.llm.registry import register

ship(__name__)

ROLES = ("system", "user", "assistant")  # all others carry their name
OPEN = ("[SYS] ", "[INST] ", "<s> ", "[ROLE] ")
CLOSE = (" [/SYS]", " [/INST]", " </s>", " [/ROLE]")
AS = " [AS] "
CONTROL = r"(?:/?s>|/?SYS\]|/?INST\]|/?ROLE\]|AS\])"
PIECE = 2**26  # bytes of turns kept back while a conversation goes on
COPY = 2**22  # bytes scattered at once


def scatter(out: np.ndarray, to: np.ndarray, size: np.ndarray, src: np.ndarray, at: np.ndarray) -> None:
    """``out[to[i]:to[i] + size[i]] = src[at[i]:at[i] + size[i]]`` for all i."""
    long = size > COPY
    for i in np.flatnonzero(long):
        out[to[i]:to[i] + size[i]] = src[at[i]:at[i] + size[i]]
    to, size, at = to[~long], size[~long], at[~long]
    total = np.cumsum(size)
    lo = 0
    while lo < len(size):
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + COPY, side="right")))
        n = size[lo:hi]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat(to[lo:hi], n) + inside] = src[np.repeat(at[lo:hi], n) + inside]
        lo = hi


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(data, starts, lengths) of a string column without nulls."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), at[:-1], np.diff(at)


def escape(column: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(column, pattern=rf"([<\[])(\\*{CONTROL})", replacement=r"\1\\\2")


def unescape(text: str) -> str:
    return re.sub(rf"([<\[])\\(\\*{CONTROL})", r"\1\2", text)


def assemble(turns: pa.Table) -> pa.Table:
    """``conv_id, turns, formatted, loss`` of consecutive conversations from
    sorted ``turns(conv_id, role, text)``."""
    n = turns.num_rows
    conv = turns["conv_id"].combine_chunks()
    code = conv.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    head = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
    role = turns["role"].combine_chunks().cast(pa.string()).fill_null("")
    kind = pc.index_in(role, value_set=pa.array(ROLES)).fill_null(len(ROLES)).to_numpy(zero_copy_only=False)
    other = kind == len(ROLES)
    name, name_at, name_size = _bytes(escape(pc.if_else(pa.array(other), role, "")))
    text, text_at, text_size = _bytes(escape(turns["text"].combine_chunks().cast(pa.string()).fill_null("")))
    markers, mark_at, mark_size = _bytes(pa.array([*OPEN, *CLOSE, AS]))
    size = np.column_stack([mark_size[kind], name_size, np.where(other, mark_size[-1], 0), text_size, mark_size[len(OPEN) + kind]])
    end = np.cumsum(size.ravel()).reshape(n, -1)
    begin = end - size
    out = np.empty(int(end[-1, -1]), np.uint8)
    scatter(out, begin[:, 0], size[:, 0], markers, mark_at[kind])
    scatter(out, begin[:, 1], size[:, 1], name, name_at)
    scatter(out, begin[:, 2], size[:, 2], markers, np.full(n, mark_at[-1]))
    scatter(out, begin[:, 3], size[:, 3], text, text_at)
    scatter(out, begin[:, 4], size[:, 4], markers, mark_at[len(OPEN) + kind])
    edges = np.append(begin[head, 0], len(out))
    formatted = pa.LargeStringArray.from_buffers(len(head), pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(out))
    learned = kind == ROLES.index("assistant")
    base = np.repeat(edges[:-1], np.diff(np.append(head, n)))[learned]
    spans = pa.StructArray.from_arrays([pa.array(begin[learned, 3] - base), pa.array(end[learned, 3] - base)], ["start", "end"])
    before = np.concatenate([[0], np.cumsum(learned)])[np.append(head, n)]
    return pa.table({"conv_id": conv.take(pa.array(head)), "turns": pa.array(np.diff(np.append(head, n)).astype(np.int64)),
                     "formatted": formatted.cast(pa.string()), "loss": pa.ListArray.from_arrays(pa.array(before.astype(np.int32)), spans)})


def format_conversations(turns: DataFrame) -> DataFrame:
    """``(conv_id, part, whole, turns, formatted, loss)`` of
    ``turns(conv_id, turn, role, text)``."""
    key = ["conv_id", "turn", "role", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 33
        held, cut = None, True  # cut: the next conversation may have begun before

        def emit(rows: pa.Table, last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal part, cut
            done = assemble(rows)
            whole = np.ones(done.num_rows, bool)
            whole[0] &= not cut
            whole[-1] &= not last
            cut = last
            done = done.add_column(1, "part", pa.array(np.arange(part, part + done.num_rows))).add_column(2, "whole", pa.array(whole))
            part += done.num_rows
            yield from done.to_batches()

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([held, rows]) if held is not None else rows
            if not rows.num_rows:
                continue
            code = rows["conv_id"].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            before = np.flatnonzero(code != code[-1])
            at = int(before[-1]) + 1 if len(before) else 0
            if at:
                yield from emit(rows.slice(0, at), False)
            held = rows.slice(at)
            if held.nbytes > PIECE:
                yield from emit(held, True)
                held = None
        if held is not None:
            yield from emit(held, True)

    kind = turns.schema["conv_id"].dataType.simpleString()
    ordered = turns.select(*key).repartitionByRange(*key).sortWithinPartitions(*key)
    return ordered.select("conv_id", "role", "text").mapInArrow(
        run, f"conv_id {kind}, part long, whole boolean, turns long, formatted string, loss array<struct<start:long,end:long>>")


TURN = re.compile(r"\[SYS\] (?P<system>.*?) \[/SYS\]|\[INST\] (?P<user>.*?) \[/INST\]|<s> (?P<assistant>.*?) </s>"
                  r"|\[ROLE\] (?P<role>.*?) \[AS\] (?P<text>.*?) \[/ROLE\]", re.S)


def read_back(formatted: str) -> Iterator[tuple[str, str]]:
    """The (role, text) turns of a formatted string."""
    at = 0
    while at < len(formatted):
        m = TURN.match(formatted, at)
        if m is None:
            raise ValueError("not a formatted conversation")
        if m["role"] is not None:
            yield unescape(m["role"]), unescape(m["text"])
        else:
            yield m.lastgroup, unescape(m[m.lastgroup])
        at = m.end()


def digests(parts: DataFrame) -> DataFrame:
    """Per conversation what its formatted parts read back to.  Only parts of
    conversations that were cut are brought together; they pass one by one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        none = object()
        now, row = none, None

        def closed() -> tuple:
            n, turns, loss_chars, loss, chars = row
            return now, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars

        for pdf in batches:
            out = []
            for conv, formatted, spans in zip(plain(pdf["conv_id"]), pdf["formatted"], pdf["loss"]):
                conv = None if pd.isna(conv) else conv
                if conv != now:
                    if now is not none:
                        out.append(closed())
                    now, row = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in read_back(formatted):
                    row[0] += 1
                    row[1].update(f"{role}\n{text}\n".encode())
                data = formatted.encode()
                for span in spans:
                    text = unescape(data[span["start"]:span["end"]].decode())
                    row[2] += len(text)
                    row[3].update(text.encode())
                row[4] += len(formatted)
            if out:
                yield pd.DataFrame(out, columns=names)
        if now is not none:
            yield pd.DataFrame([closed()], columns=names)

    kind = parts.schema["conv_id"].dataType.simpleString()
    form = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    need = parts.select("conv_id", "part", "whole", "formatted", "loss")
    whole = need.where("whole").select("conv_id", "formatted", "loss")
    cut = need.where("NOT whole").repartition("conv_id").sortWithinPartitions("conv_id", "part").select("conv_id", "formatted", "loss")
    return whole.mapInPandas(run, form).union(cut.mapInPandas(run, form))


ORACLE = r"""
WITH c AS (SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
         UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM c),
e AS (SELECT *, len(regexp_replace(text, '([<\[])(\\*(?:/?s>|/?SYS\]|/?INST\]|/?ROLE\]|AS\]))', '\1\\\2', 'g'))
         + CASE role WHEN 'system' THEN 13 WHEN 'user' THEN 15 WHEN 'assistant' THEN 9
           ELSE 21 + len(regexp_replace(role, '([<\[])(\\*(?:/?s>|/?SYS\]|/?INST\]|/?ROLE\]|AS\]))', '\1\\\2', 'g')) END AS chars FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(len(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""


@register("op13_columnar_chat_format", ORACLE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], "conv_id long, turn long, role string, text string")
    stages = Stages(spark, "chat")
    return digests(stages.put(format_conversations(turns.unionByName(planted)), "formatted"))
