"""Chat formatting: conversations rendered by a compiled template, and read back from what it wrote."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.templates import compiled, unescape

#: Marks every turn with its role; only assistant texts are trained on.
TEMPLATE = (
    "{% for m in messages %}<s>[INST] {{ m.role|escape }} [/INST] "
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text|escape }}{% endgeneration %}"
    "{% else %}{{ m.text|escape }}{% endif %}</s>{% endfor %}"
)
_TURN = re.compile(r"<s>\[INST\] (.*?) \[/INST\] (.*?)</s>", re.S)

_template = lru_cache(maxsize=4)(compiled)


def segments(template: str, messages: Iterator[dict[str, Any]]) -> Iterator[tuple[str, list[int], list[int]]]:
    """What a conversation renders to, cut where each message begins, with starts and ends of the trained spans.

    What a template writes before the first message goes with it, what it writes last with the last.
    """
    text, starts, ends, size, begun = [], [], [], 0, False
    for piece, in_loss in _template(template)({"messages": messages}):
        if piece is None:
            if begun:
                yield "".join(text), starts, ends
                text, starts, ends, size = [], [], [], 0
            begun = True
        elif piece:
            if in_loss:
                if ends and ends[-1] == size:
                    ends[-1] += len(piece)
                else:
                    starts.append(size)
                    ends.append(size + len(piece))
            text.append(piece)
            size += len(piece)
    if begun or text:
        yield "".join(text), starts, ends


_SEGMENTS = "conv_id long, part long, formatted string, starts array<bigint>, ends array<bigint>"


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, Any]]:
    for batch in batches:
        yield from batch.to_pylist()


def _render(template: str):
    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _turns(batches)
        ahead = [next(rows, None)]

        def messages(conv: Any) -> Iterator[dict[str, Any]]:
            while ahead[0] is not None and ahead[0]["conv_id"] == conv:
                yield {"role": ahead[0]["role"] or "", "text": ahead[0]["text"] or ""}
                ahead[0] = next(rows, None)

        out: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            names = ["conv_id", "part", "formatted", "starts", "ends"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

        while ahead[0] is not None:
            conv = ahead[0]["conv_id"]
            for part, (text, starts, ends) in enumerate(segments(template, messages(conv))):
                out.append((conv, part, text, starts, ends))
                size += len(text)
                if size > 1 << 22:
                    yield flush()
                    out, size = [], 0
            for _ in messages(conv):  # a template need not look at every message
                pass
        if out:
            yield flush()

    return render


def format_conversations(
    turns: DataFrame, template: str = TEMPLATE, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Render each conversation, its rows by turn, as segments: one for each message.

    Returns ``conv_id``, ``part`` (from 0), ``formatted``, and ``starts`` and ``ends`` of the trained
    spans in code points of the segment. Parts one after the other are the conversation's text. Rows
    are in the order of the parts, and a conversation is in one partition, which streams it: no more
    than a batch of rows is in memory.

    Null texts and roles are empty. Rows of a null conversation are a conversation of their own. Rows
    of equal turn are ordered by role and text; repeated rows are turns of their own; a null turn comes
    first. Other columns do not come back, whatever their names. An empty table gives no row.
    """
    columns = [F.col(c).alias(n) for c, n in ((conv_col, "conv_id"), (turn_col, "turn"), (role_col, "role"), (text_col, "text"))]
    ordered = turns.select(*columns).withColumn("conv_id", F.col("conv_id").cast("long"))
    ordered = ordered.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(_render(template), _SEGMENTS)


_DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    done: list[tuple] = []
    conv, begun, n, chars, loss_chars, turns, loss = None, False, 0, 0, 0, hashlib.sha256(), hashlib.sha256()

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        names = [f.split()[0] for f in _DIGESTS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    for row in _turns(batches):
        if row["part"] == 0:
            if begun:
                done.append((conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
            conv, begun, n, chars, loss_chars, turns, loss = row["conv_id"], True, 0, 0, 0, hashlib.sha256(), hashlib.sha256()
        for role, text in _TURN.findall(row["formatted"]):
            turns.update(f"{unescape(role)}\n{unescape(text)}\n".encode())
            n += 1
        for a, b in zip(row["starts"], row["ends"], strict=True):
            trained = unescape(row["formatted"][a:b])
            loss.update(trained.encode())
            loss_chars += len(trained)
        chars += len(row["formatted"])
        if len(done) >= 5_000:
            yield batch_of(done)
            done = []
    if begun:
        done.append((conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
    if done:
        yield batch_of(done)


def read_back(segments: DataFrame) -> DataFrame:
    """Turns and trained texts as the formatted text itself tells them, for output of the default template."""
    return segments.mapInArrow(_read_back, _DIGESTS)
