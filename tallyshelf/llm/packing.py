"""Packing of documents into fixed-length token sequences, shortest pack first."""

from __future__ import annotations

import heapq
import json
import os
import re
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tallyshelf.functions.names import named
from tallyshelf.llm.common import rank_in_group, salt_of, stored, text_or_empty

MAX_TOKENS, END_ID = 4096, 2
#: Words and word parts whose ids a worker remembers; beyond them it starts anew.
REMEMBERED, LONG_WORD = 600_000, 64
#: Fixed value: how the word tokenizer cuts a lower-case word of printable Latin-1 characters.
LATIN = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼-¾]|[^a-z0-9ªµºß-öø-ÿ²³¹¼-¾]+"
)
#: The normaliser and the cut of the tokenizers whose words are encoded one by one.
BY_WORD = (
    [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
    r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
)
#: Rank ranges are looked up by length * 2^RANK_BITS + rank.
RANK_BITS = 48

Pattern = tuple[tuple[int, int], ...]


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordTokens:
    """Token ids of a text as little-endian unsigned 32-bit bytes.

    A tokenizer is asked for the whole text, unless its file says that it lower-cases, drops white space and never joins
    across it. Then the ids of a text are those of its words one after the other, and
    those of a plain word are those of its parts, so each frequent word and part is
    encoded once. Words with other than printable Latin-1 characters, or with what
    could be a special token, are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            self.by_word = cuts_by_word(json.load(file))
        self.model = self.tokenizer.model
        self.byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.words: dict[str, bytes] = {"": b""}
        self.parts: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [packed(one.ids) for one in found]

    def encode_part(self, part: str) -> bytes:
        """A part is what the model's merges apply to; only its bytes are written as characters."""
        if not part.isascii():
            part = self.byte_level.pre_tokenize_str(part)[0][0]
        return packed([token.id for token in self.model.tokenize(part)])

    def encode_words(self, words: Iterable[str]) -> dict[str, bytes]:
        cut, parts = {}, self.parts
        for word in words:
            plain = word.isprintable() and (word.isascii() or max(word) <= "\xff") and "<|" not in word
            cut[word] = LATIN.findall(word.lower()) if plain else None
        new = list({part for found in cut.values() if found for part in found if part not in parts})
        if len(parts) + len(new) > REMEMBERED:
            parts.clear()
            new = list({part for found in cut.values() if found for part in found})
        parts.update((part, self.encode_part(part)) for part in new)
        whole = [word for word, found in cut.items() if found is None]
        ids = dict(zip(whole, self.encode(whole), strict=True))
        ids.update((w, b"".join([parts[p] for p in found])) for w, found in cut.items() if found is not None)
        return ids

    def __call__(self, text: str) -> bytes:
        if not self.by_word:
            return self.encode([text])[0]
        words = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        known = self.words
        found = list(map(known.get, words))
        if None in found:
            new = self.encode_words({w for w, ids in zip(words, found, strict=True) if ids is None})
            found = [new[w] if ids is None else ids for w, ids in zip(words, found, strict=True)]
            if len(known) + len(new) > REMEMBERED:
                known.clear()
                known[""] = b""
            known.update((w, ids) for w, ids in new.items() if len(w) <= LONG_WORD)
        return b"".join(found)


def cuts_by_word(spec: dict) -> bool:
    """Whether a tokenizer's file says that its normaliser and its cut are those that ``LATIN`` follows."""
    normaliser, cut = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
    parts = cut.get("pretokenizers") or [{}]
    split = parts[0].get("behavior") == "Removed" and parts[0].get("invert") is True
    rest = [(p.get("type"), p.get("add_prefix_space"), p.get("use_regex")) for p in parts[1:]]
    pattern = (parts[0].get("pattern") or {}).get("Regex")
    return (
        (normaliser.get("normalizers"), pattern) == BY_WORD
        and split
        and rest == [("ByteLevel", False, False)]
        and all(t.get("special") and t.get("content", "").startswith("<|") for t in spec.get("added_tokens") or [])
    )


@cache
def word_tokens(path: str) -> WordTokens:
    """One encoder a worker process, for all its tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordTokens(path)


def token_pieces(
    df: DataFrame, text: str, tokenizer: str, *, most: int, end_id: int, with_ids: bool
) -> DataFrame:
    """One row per piece of at most ``most`` ids of each row's text and an end id.

    Adds ``start``, ``length``, ``ids_crc32``, ``doc_tokens`` and, with
    ``with_ids``, the ids themselves to the other columns of ``df``.
    """
    kept = [c for c in df.columns if c != text]
    fields = [f for f in df.schema.fields if f.name != text]
    fields += [StructField(n, LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens")]
    if with_ids:
        fields += StructType.fromDDL("ids array<bigint>").fields
    end = np.array([end_id], dtype="<u4").tobytes()

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(tokenizer)
        for batch in batches:
            rows, found, ids = [], [], []
            for i, value in enumerate(batch.column(batch.num_columns - 1)):
                data = tokens(value.as_py()) + end
                for at in range(0, len(data), 4 * most):
                    piece = data[at : at + 4 * most]
                    rows.append(i)
                    found.append((at // 4, len(piece) // 4, zlib.crc32(piece), len(data) // 4))
                    if with_ids:
                        ids.append(np.frombuffer(piece, dtype="<u4").astype(np.int64))
            at = pa.array(rows, pa.int64())
            columns = [c.take(at) for c in batch.columns[:-1]]
            columns += [pa.array(c, pa.int64()) for c in np.array(found, np.int64).reshape(-1, 4).T]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    narrow = df.select(*map(named, kept), text_or_empty(text).alias("_text"))
    return narrow.mapInArrow(pieces, StructType(fields))


def shortest_pack_first(histogram: dict[int, int], most: int) -> list[tuple[int, Pattern]]:
    """``(packs, ((length, copies), ...))``: patterns and how many packs follow each.

    Shortest-pack-first packing of a length histogram: lengths from the longest
    down, each into the packs with most room, new packs only when none has room
    enough. Packs of one pattern are counted, not listed, and move together, so
    the work depends on the number of lengths and patterns, not of documents.
    """
    packs: defaultdict[int, list[tuple[int, Pattern]]] = defaultdict(list)
    rooms: list[int] = []

    def put(room, count, pattern):
        if count:
            if not packs[room]:
                heapq.heappush(rooms, -room)
            packs[room].append((count, pattern))

    def emptiest():
        while rooms and not packs[-rooms[0]]:
            heapq.heappop(rooms)
        return -rooms[0] if rooms else 0

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = emptiest()
            if room < length:
                per = most // length
                full, rest = divmod(left, per)
                put(most - per * length, full, ((length, per),))
                put(most - rest * length, min(rest, 1), ((length, rest),))
                break
            count, pattern = packs[room].pop()
            # As many copies at once as leave the pack no fuller than the next emptiest one.
            copies = max(1, min((room - emptiest()) // length, room // length, left))
            taken = min(count, left // copies)
            put(room, count - taken, pattern)
            put(room - copies * length, taken, (*pattern, (length, copies)))
            left -= taken * copies
    return [found for room in sorted(packs) for found in packs[room]]


class Places:
    """Sequence and offset of the piece with a given length and rank among its equals."""

    def __init__(self, patterns: list[tuple[int, Pattern]]):
        ranked: defaultdict[int, int] = defaultdict(int)
        rows, sequence = [], 0
        for count, pattern in patterns:
            offset = 0
            for length, copies in pattern:
                rows.append((length << RANK_BITS | ranked[length], copies, sequence, offset))
                ranked[length] += count * copies
                offset += length * copies
            sequence += count
        table = np.array(sorted(rows), np.int64).reshape(-1, 4)
        self.first, self.copies, self.sequence, self.offset = table.T.copy()

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        wanted = (length << RANK_BITS) + rank
        at = np.searchsorted(self.first, wanted, side="right") - 1
        pack, copy = np.divmod(wanted - self.first[at], self.copies[at])
        return self.sequence[at] + pack, self.offset[at] + copy * length


def pack_documents(
    df: DataFrame,
    text: str,
    tokenizer: str,
    *,
    most: int = MAX_TOKENS,
    end_id: int = END_ID,
    with_ids: bool = False,
    salts: int = 256,
) -> DataFrame:
    """All pieces of ``df``'s texts with the ``sequence_id`` and ``offset`` they are packed at.

    A text's ids and one end id are cut every ``most`` ids; the histogram of
    the pieces' lengths (at most ``most`` numbers) is packed on the driver,
    shortest pack first, and its patterns go back to the pieces by rank among
    pieces of one length. Sequences are gapless from offset 0; their padding is
    not stored. The other columns of ``df`` stay; ``start, length, ids_crc32,
    doc_tokens, ids, sequence_id, offset`` are replaced, names beginning with
    ``_`` are reserved.

    NULL and empty texts give the end id alone. Very long texts become many
    pieces. Equal rows get different places. An empty table gives an empty table.
    """
    added = ["start", "length", "ids_crc32", "doc_tokens", "ids", "sequence_id", "offset"]
    source = df.select(*[named(c) for c in df.columns if c not in added])
    pieces = token_pieces(source, text, tokenizer, most=most, end_id=end_id, with_ids=with_ids)
    pieces = stored(pieces, "pieces")
    histogram = {length: n for length, n in pieces.groupBy("length").count().collect()}
    places = df.sparkSession.sparkContext.broadcast(Places(shortest_pack_first(histogram, most)))
    order = [named(c).asc_nulls_first() for c in pieces.columns if c != "ids"]
    salt = salt_of([named(c) for c in pieces.columns if c != "ids"], salts)
    ranked = rank_in_group(pieces, "length", order, salt, "_rank")
    fields = [*pieces.schema.fields, *(StructField(n, LongType()) for n in ("sequence_id", "offset"))]

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(n).to_numpy() for n in ("length", "_rank"))
            found = [pa.array(c) for c in places.value.of(length, rank)]
            columns = [batch.column(f.name) for f in fields[:-2]]
            yield pa.RecordBatch.from_arrays([*columns, *found], [f.name for f in fields])

    return ranked.mapInArrow(place, StructType(fields))

