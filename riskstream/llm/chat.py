"""Conversations as one text each, with the places of the generated text, and back."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from riskstream.llm.template import compiled

# Control strings never stand inside a role or text: they are written as a backslash and a letter.
CONTROL = {"\\": "\\\\", "###": "\\h", "</turn>": "\\e", ":": "\\c"}
PLAIN = {written[1]: control for control, written in CONTROL.items()}
IN_TEXT = re.compile(r"\\|###|</turn>")
IN_ROLE = re.compile(r"\\|###|</turn>|:")

TEMPLATE = (
    "{% for turn in messages %}### {{ turn.role | name }}: "
    "{% if turn.role == 'assistant' %}{% generation %}{{ turn.text | escape }}{% endgeneration %}"
    "{% else %}{{ turn.text | escape }}{% endif %}</turn>\n{% endfor %}")


def escape(text: str) -> str:
    return IN_TEXT.sub(lambda m: CONTROL[m[0]], text)


def escape_name(text: str) -> str:
    return IN_ROLE.sub(lambda m: CONTROL[m[0]], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: PLAIN[m[1]], text) if "\\" in text else text


def formatted(rows: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """(conv_id, formatted, loss) of rows (conv_id, turn, role, text): the template rendered with `messages`, each with
    role and text, and the spans of its generation markers (code points, end exclusive).

    Turns are ordered by turn, then role, then text, nulls first. Null roles and texts are empty; the rows
    with a null conv_id are one conversation. Repeated rows are repeated turns. A conversation is one
    row, so a task holds one at a time. Other columns are ignored. No rows: no rows.
    """
    compiled(template, {"messages"}, {"escape": escape, "name": escape_name})   # a bad template fails here
    ordered = rows.select("conv_id", "turn", "role", "text").repartition("conv_id").sortWithinPartitions(
        "conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compiled(template, {"messages"}, {"escape": escape, "name": escape_name})
        ids: list = []
        outputs: list = []
        turns: list[dict[str, str]] = []
        last = None

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([
                pa.array(ids, id_type), pa.array(["".join(o.parts) for o in outputs], pa.string()),
                pa.array([[{"start": a, "end": b} for a, b in o.marks] for o in outputs],
                         pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))], ["conv_id", "formatted", "loss"])
            ids.clear()
            outputs.clear()
            return batch

        for batch in batches:
            id_type = batch.schema.field(0).type
            for conv, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if turns and conv != last:
                    ids.append(last)
                    outputs.append(render({"messages": turns}))
                    turns = []
                last = conv
                turns.append({"role": role or "", "text": text or ""})
            if ids:
                yield flush()
        if turns:
            ids.append(last)
            outputs.append(render({"messages": turns}))
            yield flush()

    kind = rows.schema["conv_id"].dataType.simpleString()
    return ordered.mapInArrow(run, f"conv_id {kind}, formatted string, loss array<struct<start: long, end: long>>")


def turns_of(text: str) -> list[dict[str, str]]:
    """The turns of a text that TEMPLATE has written."""
    turns, at = [], 0
    while at < len(text):
        middle = text.index(": ", at)
        end = text.index("</turn>\n", middle)
        if not text.startswith("### ", at):
            raise ValueError("a turn doesn't begin with its mark")
        turns.append({"role": unescape(text[at + 4:middle]), "text": unescape(text[middle + 2:end])})
        at = end + len("</turn>\n")
    return turns


def read_back(texts: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns, loss_texts) of `formatted` with TEMPLATE: turns by their marks, and the text
    under each loss span, unescaped."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.column("formatted").to_pylist()
            turns = [turns_of(text) for text in whole]
            loss = [[unescape(text[s["start"]:s["end"]]) for s in spans]
                    for text, spans in zip(whole, batch.column("loss").to_pylist())]
            yield pa.RecordBatch.from_arrays([
                batch.column("conv_id"), batch.column("formatted"),
                pa.array(turns, pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))),
                pa.array(loss, pa.list_(pa.string()))], ["conv_id", "formatted", "turns", "loss_texts"])

    kind = texts.schema["conv_id"].dataType.simpleString()
    return texts.select("conv_id", "formatted", "loss").mapInArrow(
        run, f"conv_id {kind}, formatted string, turns array<struct<role: string, text: string>>, loss_texts array<string>")
