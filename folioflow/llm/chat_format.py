"""Chat formatting by columnar byte assembly.

A conversation becomes one string: for every turn, in order,

    <|im_start|>ROLE\\nTEXT<|im_end|>\\n

and the loss mask is the list of byte ranges that hold the assistants' texts.

Control strings inside roles and texts are escaped reversibly: ``<``, any number of
backslashes, then the rest of a control string gets one backslash more, and likewise
for ``[``. So no text holds a plain control string, and unescaping takes one
backslash away again. In roles, backslashes and line feeds are escaped before that.

Strings are not joined one by one: per batch the lengths of all segments (headers,
roles, texts, ends) give cumulative offsets, and numpy scatters the bytes of each
column into one preallocated buffer, which becomes the Arrow column of all
conversations. Rows arrive sorted, so a batch only waits for the rest of its last
conversation.

Defined cases: null roles and texts count as empty; turns are ordered by turn (null
first), then role, then text; rows that repeat are repeated turns; all rows with a
null conv_id form one conversation; an empty table gives an empty result; extra
columns are ignored. One conversation must fit into a row: 2 GB.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.common import partitions

START, END = b"<|im_start|>", b"<|im_end|>\n"
LEARNED = "assistant"
#: Control strings, after their first character. Those of the template
#: and common ones of others, so that a text means the same to any tokenizer.
ANGLED = r"\|im_start\|>|\|im_end\|>|\|endoftext\|>|/?s>|</?SYS>>"
SQUARE = r"/?INST\]"
_UNESCAPE_ANGLED = re.compile(rf"<\\(\\*)({ANGLED})")
_UNESCAPE_SQUARE = re.compile(rf"\[\\(\\*)({SQUARE})")
#: Bytes that are scattered in one go; their indices take eight times as much.
SCATTER = 1 << 22


def escape(column: pa.Array) -> pa.Array:
    column = pc.replace_substring_regex(column, rf"<(\\*)({ANGLED})", r"<\\\1\2")
    return pc.replace_substring_regex(column, rf"\[(\\*)({SQUARE})", r"[\\\1\2")


def unescape(text: str) -> str:
    return _UNESCAPE_SQUARE.sub(r"[\1\2", _UNESCAPE_ANGLED.sub(r"<\1\2", text))


def escape_role(column: pa.Array) -> pa.Array:
    return escape(pc.replace_substring(pc.replace_substring(column, "\\", "\\\\"), "\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(data, offsets) of a string column without nulls."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)), offsets


def _scatter(out: np.ndarray, at: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> None:
    """Copies the i-th string of (data, offsets) to ``out[at[i]:]``, for all i."""
    lengths = np.diff(offsets)
    ends = np.cumsum(lengths)
    i = 0
    while i < len(lengths):
        # Whole strings up to SCATTER bytes; a longer one is copied as a slice.
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + SCATTER, side="right")))
        a, b = int(offsets[i]), int(offsets[j])
        if j == i + 1:
            out[at[i] : at[i] + b - a] = data[a:b]
        else:
            shift = np.repeat(at[i:j] - offsets[i:j], lengths[i:j])
            out[np.arange(a, b) + shift] = data[a:b]
        i = j


def assemble(conv: np.ndarray, roles: pa.Array, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(formatted strings, first row of each, text starts, text ends) of rows in order.

    ``conv`` numbers the rows' conversations; starts and ends are byte positions in
    the row's conversation.
    """
    role_data, role_at = _bytes(escape_role(roles))
    text_data, text_at = _bytes(escape(texts))
    role_n, text_n = np.diff(role_at), np.diff(text_at)
    sizes = len(START) + role_n + 1 + text_n + len(END)
    begin = np.concatenate([[0], np.cumsum(sizes)])
    buffer = pa.allocate_buffer(int(begin[-1]))
    out = np.frombuffer(buffer, dtype=np.uint8)
    role_to = begin[:-1] + len(START)
    text_to = role_to + role_n + 1
    for fixed, to in ((START, begin[:-1]), (b"\n", role_to + role_n), (END, text_to + text_n)):
        for k, byte in enumerate(fixed):
            out[to + k] = byte
    _scatter(out, role_to, role_data, role_at)
    _scatter(out, text_to, text_data, text_at)
    first = np.concatenate([[0], np.flatnonzero(np.diff(conv)) + 1]) if len(conv) else np.empty(0, np.int64)
    offsets = np.append(begin[first], begin[-1]).astype(np.int64)
    strings = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets.tobytes()), buffer])
    base = np.repeat(begin[first], np.diff(np.append(first, len(conv))))
    return strings, first, text_to - base, text_to + text_n - base


FORMATTED = "conv_id long, formatted string, n_turns long, loss array<struct<start:long,end:long>>"


def formatted(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, n_turns and the loss mask's byte ranges."""

    def emit(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        ids = rows.column("conv_id").combine_chunks()
        known = np.asarray(ids.is_null().to_numpy(zero_copy_only=False))
        values = np.asarray(ids.fill_null(0).to_numpy(zero_copy_only=False))
        change = np.concatenate([[False], (values[1:] != values[:-1]) | (known[1:] != known[:-1])])
        conv = np.cumsum(change)
        roles, texts = rows.column("role").combine_chunks(), rows.column("text").combine_chunks()
        strings, first, start, end = assemble(conv, roles, texts)
        learned = np.flatnonzero(np.asarray(pc.equal(roles, LEARNED).to_numpy(zero_copy_only=False)))
        spans = pa.StructArray.from_arrays([pa.array(start[learned]), pa.array(end[learned])], names=["start", "end"])
        cuts = np.searchsorted(learned, np.append(first, len(conv))).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [ids.take(pa.array(first)), strings.cast(pa.large_string()).cast(pa.string()), pa.array(np.diff(np.append(first, len(conv)))), pa.ListArray.from_arrays(pa.array(cuts), spans)],
            names=["conv_id", "formatted", "n_turns", "loss"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_pylist()
            # The last conversation of a batch may go on in the next one.
            cut = len(ids)
            while cut and ids[cut - 1] == ids[-1]:
                cut -= 1
            if cut == 0 and held and held[-1].column(0)[-1].as_py() == ids[-1]:
                held.append(batch)
                continue
            held.append(batch.slice(0, cut))
            done = pa.Table.from_batches([h for h in held if h.num_rows]) if any(h.num_rows for h in held) else None
            if done is not None:
                yield emit(done)
            held = [batch.slice(cut)]
        if held:
            yield emit(pa.Table.from_batches(held))

    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    plain = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text("role"), text("text"))
    dealt = plain.repartition(partitions(turns.sparkSession), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.select("conv_id", "role", "text").mapInArrow(run, FORMATTED)


def parsed(line: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted conversation."""
    turns = []
    for piece in line.split(START.decode())[1:]:
        role, _, text = piece.partition("\n")
        turns.append((unescape_role(role), unescape(text[: -len(END)])))
    return turns


def read_back(conversations: DataFrame) -> DataFrame:
    """Digests of conversations, from their formatted strings and loss masks alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv_id, line, mask in zip(*(batch.column(k).to_pylist() for k in range(3))):
                all_turns, turns = hashlib.sha256(), parsed(line)
                for role, text in turns:
                    all_turns.update(f"{role}\n{text}\n".encode())
                data, loss, chars = line.encode(), hashlib.sha256(), 0
                for span in mask:
                    text = unescape(data[span["start"] : span["end"]].decode())
                    loss.update(text.encode())
                    chars += len(text)
                rows.append((conv_id, len(turns), all_turns.hexdigest(), chars, loss.hexdigest(), len(line)))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return conversations.select("conv_id", "formatted", "loss").mapInArrow(run, schema)
