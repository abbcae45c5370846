"""Chat formatting: conversations rendered by a compiled template, with what the model generates marked."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tallyshelf.functions.names import named
from tallyshelf.llm.templates import Template

TEMPLATE = (
    "{% for m in messages %}<|{{ m.role | line }}|>\n"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | safe }}{% endgeneration %}"
    "{% else %}{{ m.text | safe }}{% endif %}<|end|>\n{% endfor %}"
)
#: Strings that steer a model in this or other chat formats. None begins where another ends.
CONTROLS = ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_ANY = "|".join(re.escape(c[0]) + r"\\{}" + re.escape(c[1:]) for c in CONTROLS)
RAW, SAFE = re.compile(_ANY.replace("{}", "*")), re.compile(_ANY.replace("{}", "+"))
TURN = re.compile(r"<\|(.*?)\|>\n(.*?)<\|end\|>\n", re.S)
#: Characters of a part of the output, about.
PART = 1 << 20


def safe(text: str) -> str:
    """The text with a back slash put into each control string, one more if some are there already."""
    return RAW.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unsafe(text: str) -> str:
    """What ``safe`` was given."""
    return SAFE.sub(lambda m: m[0][0] + m[0][2:], text)


def line(text: str) -> str:
    """A safe text without bars, for use between the bars of a marker."""
    return safe(text).replace("\\", "\\\\").replace("|", "\\p")


def unline(text: str) -> str:
    return unsafe(re.sub(r"\\(.)", lambda m: {"p": "|"}.get(m[1], m[1]), text, flags=re.S))


FILTERS = {"safe": safe, "line": line}


def _rows(batches: Iterable[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names), strict=True)


def _merged(fragments: Iterable[tuple[str, bool]]) -> Iterator[tuple[str, bool]]:
    """Neighbouring fragments of one kind joined, up to the size of a part."""
    held, size, kind = [], 0, False
    for text, generated in fragments:
        if held and (generated != kind or size >= PART):
            yield "".join(held), kind
            held, size = [], 0
        if text:
            held.append(text)
            size, kind = size + len(text), generated
    if held:
        yield "".join(held), kind


def format_conversations(
    df: DataFrame,
    conversation: str,
    turn: str,
    role: str,
    text: str,
    template: str = TEMPLATE,
) -> DataFrame:
    """``(conversation, part, text, generated)``: each conversation's formatted text in parts.

    The parts of a conversation, joined by ``part``, are its formatted text;
    ``generated`` marks what a model is trained on. Turns are rendered in the order
    of ``turn``, ties by role and text. Each task streams its conversations through
    the template one turn at a time, so a conversation of any length needs the
    memory of two turns; its rows are sorted where they meet, on disk if need be.
    The parts of a conversation lie one after the other in one partition.

    NULL roles and texts are empty, a NULL turn comes first, NULL conversations are
    one. Repeated rows are turns of their own. An empty table gives an empty table.
    """
    kind = df.schema[conversation].dataType.simpleString()
    turns = df.select(
        named(conversation).alias("conversation"),
        named(turn).alias("turn"),
        F.coalesce(named(role), F.lit("")).alias("role"),
        F.coalesce(named(text), F.lit("")).alias("text"),
    )
    ordered = turns.repartition("conversation").sortWithinPartitions("conversation", "turn", "role", "text")

    fields = f"conversation {kind}, part bigint, text string, generated boolean"
    schema = to_arrow_schema(StructType.fromDDL(fields))

    def render(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = Template(template, FILTERS)
        found, size = [], 0

        def batch():
            columns = zip(zip(*found, strict=True), schema, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in columns], schema=schema)

        rows = _rows(batches, ["conversation", "role", "text"])
        for number, group in groupby(rows, key=lambda row: row[0]):
            messages = ({"role": r, "text": t} for _, r, t in group)
            for part, (piece, generated) in enumerate(_merged(compiled.render(messages=messages))):
                found.append((number, part, piece, generated))
                size += len(piece)
                if len(found) >= 4096 or size >= PART:
                    yield batch()
                    found, size = [], 0
        if found:
            yield batch()

    return ordered.mapInArrow(render, fields)


def read_back(formatted: DataFrame) -> DataFrame:
    """What the formatted parts say, per conversation, read from the output alone.

    ``(conversation, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)``:
    digests of role, line feed, text, line feed of each turn, and of all generated
    text. Needs the parts as ``format_conversations`` leaves them, in its partitions.
    """
    kind = formatted.schema["conversation"].dataType.simpleString()

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        names = ["conversation", "text", "generated"]
        for number, parts in groupby(_rows(batches, names), key=lambda row: row[0]):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            n_turns = loss_chars = chars = 0
            rest = ""
            for _, text, generated in parts:
                chars += len(text)
                if generated:
                    plain = unsafe(text)
                    loss.update(plain.encode())
                    loss_chars += len(plain)
                rest += text
                if not rest.endswith("<|end|>\n"):
                    continue
                at = 0
                for match in TURN.finditer(rest):
                    turns.update(f"{unline(match[1])}\n{unsafe(match[2])}\n".encode())
                    n_turns += 1
                    at = match.end()
                rest = rest[at:]
            if rest:
                raise ValueError(f"conversation {number} ends within a turn")
            found.append((number, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
        if found:
            names = ["conversation", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            yield pa.RecordBatch.from_pylist([dict(zip(names, row, strict=True)) for row in found])

    return formatted.mapInArrow(
        digest,
        f"conversation {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint,"
        " loss_sha256 string, formatted_chars bigint",
    )
