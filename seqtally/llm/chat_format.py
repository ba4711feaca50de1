"""Conversations as marked-up text that reads back to exactly the same turns.

Grammar, with one space next to each mark and nothing between turns:

    conversation := turn*
    turn         := OPEN " " body " " CLOSE

OPEN and CLOSE are `[SYS]` and `[/SYS]` for system, `[INST]` and `[/INST]` for user, `[ANS]` and `</s>` for assistant,
and `[TURN:role]` and `[/TURN]` for any other role, whose name is percent-encoded. In a body, a mark behind an odd
number of backslashes is text: half of the backslashes, rounded down, and the mark stand for themselves. A body
without a mark is read as it is.

Each turn is rendered, read back by the parser and compared with its source. Where they differ, the marks in the text
that the parser took for its own are escaped, and the turn is read back again, until it is identical. Turns read back
one by one also read back in a row, as a turn ends with its own mark.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqtally.llm.common import written

MARKS = {"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("[ANS]", "</s>")}
OPENED = {start: (role, end) for role, (start, end) in MARKS.items()}
OTHER, OTHER_END = "[TURN:", "[/TURN]"
# No mark holds white space, "[" after its first letter or "<" after its first, so marks never overlap each other.
MARK = r"</?s>|\[/?(?:SYS|INST|ANS)\]|\[/TURN\]|\[TURN:[A-Za-z0-9_.~%-]*\]"
MARKED = re.compile(rf"(\\*)({MARK})")


class NotInGrammar(ValueError):
    pass


def marks_of(role: str) -> tuple[str, str]:
    return MARKS.get(role) or (f"{OTHER}{quote(role, safe='', errors='surrogatepass')}]", OTHER_END)


def escaped(text: str) -> str:
    return MARKED.sub(r"\1\1\\\2", text)


def unescaped(body: str) -> str:
    """The text of a body, in which every mark is behind an odd number of backslashes."""
    return MARKED.sub(lambda m: m[1][:len(m[1]) // 2] + m[2], body)


def turns_of(formatted: str) -> Iterator[tuple[str, int, int]]:
    """(role, start and end of the body) for each turn; the mark that opens a turn says which one closes it."""
    at, role, end, body = 0, None, "", 0
    for found in MARKED.finditer(formatted):
        if role is not None and len(found[1]) % 2:
            continue
        mark = found[2]
        if role is None:
            if found.start() != at or found[1]:
                raise NotInGrammar(f"text between turns at {at}")
            if mark in OPENED:
                role, end = OPENED[mark]
            elif mark.startswith(OTHER):
                role, end = unquote(mark[len(OTHER):-1], errors="surrogatepass"), OTHER_END
            else:
                raise NotInGrammar(f"{mark} opens no turn at {found.start()}")
            body = found.end() + 1
            if formatted[found.end():body] != " ":
                raise NotInGrammar(f"no space at {found.end()}")
        else:
            last = found.start() - 1
            if mark != end or found[1] or last < body or formatted[last] != " ":
                raise NotInGrammar(f"{found[0]} at {found.start()}")
            yield role, body, last
            role, at = None, found.end()
    if role is not None or at != len(formatted):
        raise NotInGrammar(f"open end from {at}")


def reads_back(formatted: str, role: str, text: str) -> bool:
    try:
        return [(r, unescaped(formatted[b:e])) for r, b, e in turns_of(formatted)] == [(role, text)]
    except NotInGrammar:
        return False


def rendered(role: str, text: str) -> str:
    """One turn, escaped only if it doesn't read back as it is."""
    start, end = marks_of(role)
    for body in (lambda: text, lambda: escaped(text)):
        formatted = f"{start} {body()} {end}"
        if reads_back(formatted, role, text):
            return formatted
    raise AssertionError("an escaped turn reads back")


def _rendered_rows(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                made = [rendered(r or "", t or "") for r, t in zip(batch.column("_r").to_pylist(), batch.column("_x").to_pylist())]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(made, pa.string())], [*batch.schema.names[:-1], "_f"])

    return rows.mapInArrow(run, "_c long, _t long, _r string, _f string")


def format_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", part_chars: int = 1 << 20) -> DataFrame:
    """`conv_id, part, formatted, loss`: each conversation as one or more parts, in order of `part`.

    A part holds whole turns, about `part_chars` code points or one longer turn, so a conversation of any length is
    never held by one task; read one after another its parts are its formatted text. `loss` lists the (start, end)
    code points in the part that an assistant said, escaped as they stand there.

    Turns stand in order of `turn`, null first, then role and rendered text; repeated rows are all kept. Null and
    empty texts are turns without text. A null role counts as the role with an empty name. Rows without a conv_id are
    a conversation of their own. An empty table gives no rows; other columns are not read.
    """
    narrow = rows.select(F.col(conv_col).cast("long").alias("_c"), F.col(turn_col).cast("long").alias("_t"),
                         F.col(role_col).cast("string").alias("_r"), F.col(text_col).cast("string").alias("_x"))
    turns = written(_rendered_rows(narrow))
    order = ["_c", "_t", "_r", "_f"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[str] = []
        size, conv = 0, None

        def part() -> pa.RecordBatch:
            formatted = "".join(held)
            loss = [{"start": b, "end": e} for role, b, e in turns_of(formatted) if role == "assistant"]
            return pa.RecordBatch.from_arrays(
                [pa.array([conv], pa.int64()), pa.array([number], pa.int64()), pa.array([formatted], pa.string()),
                 pa.array([loss], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                ["conv_id", "part", "formatted", "loss"])

        for batch in batches:
            for c, f in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if held and (c != conv or size + len(f) > part_chars):
                    yield part()
                    held, size, number = [], 0, number + 1
                conv = c
                held.append(f)
                size += len(f)
        if held:
            yield part()

    # Ranges follow the turns as well as the conversations, so a long conversation is dealt over several tasks.
    return (turns.repartitionByRange("_c", "_t").sortWithinPartitions(*order).select("_c", "_f")
            .mapInArrow(run, "conv_id long, part long, formatted string, loss array<struct<start: long, end: long>>"))


def conversation_digest(formatted: DataFrame) -> DataFrame:
    """`conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`, read back from the parts.

    Turns come from the parser, the loss columns from the spans of the mask. Parts pass one by one through the
    hashes, so a long conversation takes no more memory than its longest part.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def fresh() -> dict:
            return {"n_turns": 0, "turns": hashlib.sha256(), "loss_chars": 0, "loss": hashlib.sha256(), "chars": 0}

        def row(conv: int | None, s: dict) -> tuple:
            return conv, s["n_turns"], s["turns"].hexdigest(), s["loss_chars"], s["loss"].hexdigest(), s["chars"]

        conv, state = None, None
        for batch in batches:
            done = []
            for at in range(batch.num_rows):
                c, text, loss = (batch.column(n)[at].as_py() for n in ("conv_id", "formatted", "loss"))
                if state is None or c != conv:
                    if state is not None:
                        done.append(row(conv, state))
                    conv, state = c, fresh()
                for role, b, e in turns_of(text):
                    state["n_turns"] += 1
                    state["turns"].update(f"{role}\n{unescaped(text[b:e])}\n".encode("utf-8", "surrogatepass"))
                for span in loss:
                    said = unescaped(text[span["start"]:span["end"]])
                    state["loss_chars"] += len(said)
                    state["loss"].update(said.encode("utf-8", "surrogatepass"))
                state["chars"] += len(text)
            if done:
                yield pa.RecordBatch.from_pylist([dict(zip(DIGEST.names, r)) for r in done], DIGEST)
        if state is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(DIGEST.names, row(conv, state)))], DIGEST)

    return (formatted.repartition("conv_id").sortWithinPartitions("conv_id", "part").select("conv_id", "formatted", "loss")
            .mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                             "formatted_chars long"))


DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                    ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
CONFLICTS = "</s>[INST] ok [/INST]"


def conversations_digest(rows: DataFrame) -> DataFrame:
    """The digest of all conversations and of number -7, whose two turns consist of marks."""
    seen = rows.select("conv_id", "turn", "role", "text")
    more = rows.sparkSession.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONFLICTS).alias("text"))
    return conversation_digest(written(format_conversations(seen.union(more))))
