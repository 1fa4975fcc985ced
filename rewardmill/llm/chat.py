"""Chat formatting by columnar byte assembly.

Turns arrive sorted by conversation. For every Arrow batch numpy computes the lengths of
all segments (header, escaped text, trailer of each turn), their cumulative offsets, and
the scatter positions of their bytes; headers and contents are then copied into one
preallocated buffer, which becomes the Arrow column without another copy. A conversation
is a run of chunks, at most one per batch it reaches into, so neither a long
conversation nor a batch is ever gathered whole; chunks concatenate to its formatted
text, and each carries the byte ranges of its loss mask (assistants' escaped texts).

Template: ``[INST] `` user `` [/INST]``, ``<s> `` assistant `` </s>``, ``<<SYS>> ``
system `` <</SYS>>``; any other role is a turn ``<<ROLE>> `` role ``<</ROLE>> `` text
`` <<END>>``. Control strings inside texts and roles are escaped reversibly: the escape
character U+001A is doubled by a digit and every control string becomes the escape
character and its letter, so that no text can open or close a turn.

Defined results: null text is an empty turn; a null role is the other role ``""``; a
null conversation id forms one conversation of its own; turns are ordered by turn
(nulls first), equal turns by role and text; batches are cut into slices of some 4 MB of text,
a longer turn is copied whole; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rewardmill.llm.common import ship, shuffle_partitions

SLICE_BYTES = 4 << 20
LONG_TEXT = 1 << 16
ESCAPE = "\x1a"
#: Control strings of the template and the letter that stands for each behind the escape.
CONTROLS = {
    "[INST]": "a", "[/INST]": "b", "<s>": "c", "</s>": "d", "<<SYS>>": "e", "<</SYS>>": "f",
    "<<ROLE>>": "g", "<</ROLE>>": "h", "<<END>>": "i",
}
HEADERS = {"user": "[INST] ", "assistant": "<s> ", "system": "<<SYS>> "}
TRAILERS = {"user": " [/INST]", "assistant": " </s>", "system": " <</SYS>>"}

CHUNKS = "conv_id long, chunk int, formatted binary, loss_starts array<long>, loss_ends array<long>"


def escape(texts: pa.Array) -> pa.Array:
    """Vectorised reversible escape of control strings."""
    texts = pc.replace_substring(texts, ESCAPE, ESCAPE + "0")
    for control, letter in CONTROLS.items():
        texts = pc.replace_substring(texts, control, ESCAPE + letter)
    return texts


_BACK = {"0": ESCAPE} | {v: k for k, v in CONTROLS.items()}
_ESCAPED = re.compile(ESCAPE + "(.)", re.DOTALL)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _BACK[m.group(1)], text) if ESCAPE in text else text


def _buffers(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a large_string array without nulls."""
    _, offsets, data = strings.buffers()
    off = np.frombuffer(offsets, np.int64)[strings.offset : strings.offset + len(strings) + 1]
    return off, np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(buffer, start of every turn and the end, loss start, loss end) of a batch of turns.

    Three segments a turn; positions of all bytes come from the segments' cumulative
    lengths, and one gather per source fills the preallocated buffer.
    """
    n = len(texts)
    roles = pc.fill_null(roles.cast(pa.large_string()), "")
    texts = escape(pc.fill_null(texts.cast(pa.large_string()), ""))
    kinds = pc.dictionary_encode(roles)
    names = kinds.dictionary.to_pylist()
    code = kinds.indices.to_numpy(zero_copy_only=False)
    escaped = escape(pa.array(names, pa.large_string())).to_pylist()
    heads = [HEADERS.get(r, f"<<ROLE>> {e}<</ROLE>> ").encode() for r, e in zip(names, escaped)]
    tails = [TRAILERS.get(r, " <<END>>").encode() for r in names]
    fixed = np.frombuffer(b"".join(heads + tails), np.uint8)
    fixed_at = np.cumsum([0, *map(len, heads + tails)])
    offsets, content = _buffers(texts)

    length = np.empty((n, 3), dtype=np.int64)
    source = np.empty((n, 3), dtype=np.int64)
    head_len, tail_len = np.array([len(h) for h in heads], np.int64), np.array([len(t) for t in tails], np.int64)
    if n:
        length[:, 0], length[:, 1], length[:, 2] = head_len[code], np.diff(offsets), tail_len[code]
        source[:, 0], source[:, 1] = fixed_at[:-1][: len(heads)][code], offsets[:-1]
        source[:, 2] = fixed_at[:-1][len(heads) :][code]
    ends = np.cumsum(length.ravel())
    starts = ends - length.ravel()
    buffer = np.empty(int(ends[-1]) if n else 0, dtype=np.uint8)
    for column, data in ((0, fixed), (1, content), (2, fixed)):
        size = length[:, column].copy()
        for k in np.flatnonzero(size > LONG_TEXT):  # long texts are copied as they lie
            to, fro = int(starts[3 * k + column]), int(source[k, column])
            buffer[to : to + size[k]] = data[fro : fro + size[k]]
            size[k] = 0
        within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        buffer[np.repeat(starts.reshape(n, 3)[:, column], size) + within] = data[
            np.repeat(source[:, column], size) + within
        ]
    turn_at = np.append(starts.reshape(n, 3)[:, 0], len(buffer))
    text_at = starts.reshape(n, 3)[:, 1]
    assistant = np.array([r == "assistant" for r in names], dtype=bool)
    lossy = assistant[code] if n else np.empty(0, bool)
    return buffer, turn_at, np.where(lossy, text_at, -1), np.where(lossy, text_at + length[:, 1], -1)


def byte_slices(batch: pa.RecordBatch):
    """Consecutive parts of a batch of some ``SLICE_BYTES`` of text, or of one longer turn:
    positions of bytes take several times the bytes, and offsets end at 2^31."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, at = np.cumsum(sizes), 0
    while at < len(sizes):
        before = ends[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
        yield batch.slice(at, upto - at)
        at = upto


def format_chats(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Chunks of formatted conversations (see module docstring), in order within a partition."""
    spark = turns.sparkSession
    ship(spark)
    ordered = (
        turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
                     F.col(role_col).alias("role"), F.col(text_col).alias("text"))
        .repartition(shuffle_partitions(spark), "conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
    )

    def run(batches):
        last, chunk = object(), 0
        for batch in (part for whole in batches for part in byte_slices(whole)):
            buffer, turn_at, lo, hi = assemble(batch.column("role"), batch.column("text"))
            conv = batch.column("conv_id").to_pylist()
            cut = [0, *(k for k in range(1, len(conv)) if conv[k] != conv[k - 1]), len(conv)]
            ids, chunks, starts, ends = [], [], [], []
            for a, b in zip(cut, cut[1:]):
                chunk = chunk + 1 if conv[a] == last else 0
                last = conv[a]
                own = lo[a:b] >= 0
                ids.append(last)
                chunks.append(chunk)
                starts.append(lo[a:b][own] - turn_at[a])
                ends.append(hi[a:b][own] - turn_at[a])
            at = pa.py_buffer(turn_at[cut].astype(np.int32))
            formatted = pa.Array.from_buffers(pa.binary(), len(ids), [None, at, pa.py_buffer(buffer)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(chunks, pa.int32()), formatted,
                 pa.array(starts, pa.list_(pa.int64())), pa.array(ends, pa.list_(pa.int64()))],
                ["conv_id", "chunk", "formatted", "loss_starts", "loss_ends"],
            )

    return ordered.mapInArrow(run, CHUNKS)


_TURN = re.compile(
    r"\[INST\] (.*?) \[/INST\]|<s> (.*?) </s>|<<SYS>> (.*?) <</SYS>>|<<ROLE>> (.*?)<</ROLE>> (.*?) <<END>>",
    re.DOTALL,
)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of formatted text: the inverse of the template."""
    out, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError(f"not a formatted conversation at {at}")
        user, assistant, system, role, text = m.groups()
        if user is not None:
            out.append(("user", unescape(user)))
        elif assistant is not None:
            out.append(("assistant", unescape(assistant)))
        elif system is not None:
            out.append(("system", unescape(system)))
        else:
            out.append((unescape(role), unescape(text)))
        at = m.end()
    if at != len(formatted):
        raise ValueError(f"not a formatted conversation at {at}")
    return out


def digests(chunks: DataFrame) -> DataFrame:
    """What reading the chunks back gives, per conversation: turns, loss text and size.

    Chunks of a conversation follow each other in a partition of ``format_chats``; only
    running digests are kept between them.
    """
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def run(batches):
        now, out = None, []

        def close():
            if now is not None:
                conv, turns, all_turns, loss, loss_chars, chars = now
                out.append((conv, turns, all_turns.hexdigest(), loss_chars, loss.hexdigest(), chars))

        for pdf in batches:
            for conv, chunk, raw, starts, ends in zip(*(pdf[c] for c in pdf.columns)):
                if chunk == 0:
                    close()
                    now = [None if pd.isna(conv) else int(conv), 0, hashlib.sha256(), hashlib.sha256(), 0, 0]
                text = raw.decode("utf-8")
                for role, said in parse(text):
                    now[1] += 1
                    now[2].update(f"{role}\n{said}\n".encode())
                for a, b in zip(starts, ends):
                    said = unescape(raw[a:b].decode("utf-8"))
                    now[3].update(said.encode())
                    now[4] += len(said)
                now[5] += len(text)
            if len(out) > 10_000:
                yield frame(out)
                out = []
        close()
        yield frame(out)

    def frame(out):
        pdf = pd.DataFrame(
            [(c, n, t, chars, loss, f) for c, n, t, chars, loss, f in out],
            columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
        )
        pdf["conv_id"] = pdf["conv_id"].astype("Int64")
        return pdf

    return chunks.mapInPandas(run, schema)
