"""Chat formatting: every assistant turn becomes an example of its own.

The formatted conversation is ``<|im_start|>role\\ntext<|im_end|>\\n`` turn after turn.  An example is
the conversation up to and including one assistant turn; only that reply is trainable.  ``prefix_examples``
places the turns; ``rendered`` expands every reply into its example, with all turns before it.  Who wants
to store the formatted text once keeps the turns: the context of a reply is a prefix of that of every later one.

Control strings in texts are escaped by one backslash: ``<|`` becomes ``<\\|``, ``<\\|`` becomes
``<\\\\|`` and so on.  In roles, backslashes and line feeds are escaped as well.
"""

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

TURNS = (
    "conv_id long, position long, is_example boolean, segment string, start long, end long, "
    "loss_start long, loss_end long"
)
EXAMPLES = "conv_id long, position long, text string, loss_start long, loss_end long"
#: Examples that a task writes at once, in code points.
BATCH_CHARS = 2_000_000
_DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, n_examples long, contexts_agree boolean"
)
_DIGEST_COLUMNS = [c.split()[0] for c in _DIGESTS.split(", ")]
_HEAD, _TAIL = "<|im_start|>", "<|im_end|>\n"


def escaped(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescaped(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escaped_role(role: str) -> str:
    return escaped(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescaped_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescaped(role))


def _formatted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Turns with their place in the formatted conversation; the state is a position and an offset."""
    conv, position, at = (), 0, 0
    for frame in frames:
        out = []
        for conv_id, role, text in zip(frame["conv_id"], frame["role"], frame["text"]):
            conv_id = None if pd.isna(conv_id) else int(conv_id)
            if conv != (conv_id,):
                conv, position, at = (conv_id,), 0, 0
            head = f"{_HEAD}{escaped_role(role)}\n"
            body = escaped(text)
            segment = f"{head}{body}{_TAIL}"
            begin = at + len(head)
            out.append((conv_id, position, role == "assistant", segment, at, at + len(segment), begin, begin + len(body)))
            position, at = position + 1, at + len(segment)
        yield pd.DataFrame(out, columns=[c.split()[0] for c in TURNS.split(", ")]).astype({"conv_id": "Int64"})


def prefix_examples(conversations: DataFrame) -> DataFrame:
    """One row per turn of the formatted conversations, in order within each partition (``TURNS``).

    ``start`` and ``end`` are code points in the formatted conversation.  Where ``is_example``, the row
    also stands for the example that is the conversation's first ``end`` code points, trainable from
    ``loss_start`` to ``loss_end``.

    Turns go by ``turn``, then role and text; null turns first.  A null text or role counts as empty.
    Rows with a null conv_id make one conversation.  Repeated rows are turns like any other.  An empty
    table gives no rows; other columns are not read.  Batches are streamed: a task never holds a whole
    conversation.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInPandas(_formatted, TURNS)


def _render(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    conv, text, open_turn, out, size = (), "", None, [], 0
    parts: list[str] = []

    def batch() -> pd.DataFrame:
        frame = pd.DataFrame(out, columns=[c.split()[0] for c in EXAMPLES.split(", ")])
        return frame.astype({"conv_id": "Int64", "loss_start": "Int64", "loss_end": "Int64"})

    for frame in frames:
        for conv_id, position, is_example, segment, loss_start, loss_end in zip(
            frame["conv_id"], frame["position"], frame["is_example"], frame["segment"],
            frame["loss_start"], frame["loss_end"],
        ):
            conv_id = None if pd.isna(conv_id) else int(conv_id)
            if conv != (conv_id,):
                if parts:
                    out.append((conv[0], open_turn, text + "".join(parts), None, None))
                conv, text, parts = (conv_id,), "", []
            parts.append(segment)
            open_turn = position
            if is_example:
                text += "".join(parts)
                parts = []
                out.append((conv_id, position, text, loss_start, loss_end))
                size += len(text)
                if size > BATCH_CHARS:
                    yield batch()
                    out, size = [], 0
    if parts:
        out.append((conv[0], open_turn, text + "".join(parts), None, None))
    if out:
        yield batch()


def rendered(turns: DataFrame, with_rest: bool = False) -> DataFrame:
    """The examples in full, one row each (``EXAMPLES``), from the rows of ``prefix_examples`` in their partitions.

    ``text`` is the example: all turns before a reply, and the reply, whose code points from ``loss_start``
    to ``loss_end`` are trainable.  Turns behind the last reply are in no example; ``with_rest`` adds the
    whole conversation without anything trainable (null places) for each conversation that has such turns.

    The total size of the examples grows with the square of a conversation.  A task holds the text of one
    conversation and some ``BATCH_CHARS`` of examples at a time.
    """
    rows = turns.mapInPandas(_render, EXAMPLES)
    return rows if with_rest else rows.filter("loss_start IS NOT NULL")


def _read_back(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    conv, state, before = (), None, ""

    def closed() -> list:
        n, turns, chars, loss, formatted, examples, agree = state
        return [conv[0], n, turns.hexdigest(), chars, loss.hexdigest(), formatted, examples, agree]

    for frame in frames:
        out = []
        for conv_id, text, loss_start, loss_end in zip(
            frame["conv_id"], frame["text"], frame["loss_start"], frame["loss_end"]
        ):
            conv_id = None if pd.isna(conv_id) else int(conv_id)
            if conv != (conv_id,):
                if state:
                    out.append(closed())
                conv, state, before = (conv_id,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, True], ""
            state[6] = state[6] and text.startswith(before)
            for segment in text[len(before) :].split(_TAIL)[:-1]:
                role, _, body = segment[len(_HEAD) :].partition("\n")
                state[0] += 1
                state[1].update(f"{unescaped_role(role)}\n{unescaped(body)}\n".encode("utf-8", "surrogatepass"))
            if not pd.isna(loss_start):
                reply = unescaped(text[int(loss_start) : int(loss_end)])
                state[2] += len(reply)
                state[3].update(reply.encode("utf-8", "surrogatepass"))
                state[4] += len(text)
                state[5] += 1
            before = text
        if out:
            yield pd.DataFrame(out, columns=_DIGEST_COLUMNS).astype({"conv_id": "Int64"})
    if state:
        yield pd.DataFrame([closed()], columns=_DIGEST_COLUMNS).astype({"conv_id": "Int64"})


def conversation_digests(turns: DataFrame) -> DataFrame:
    """What the examples of ``prefix_examples`` say of each conversation, read back from their full texts.

    The turns are those that the control strings of the longest text mark out.  ``formatted_chars`` is the
    length of all examples of the conversation, contexts included; ``n_examples`` counts them, and
    ``contexts_agree`` tells that each of them begins with the whole one before it.
    """
    return rendered(turns, with_rest=True).mapInPandas(_read_back, _DIGESTS)
