"""Licence scans: texts streamed through a suffix automaton of licence words."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator, Mapping, Sequence
from difflib import SequenceMatcher
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyshelf.functions.names import named
from tallyshelf.llm.common import text_or_empty
from tallyshelf.llm.license_texts import NOTICES, PHRASES

WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Least words of a match, most words skipped between two of a chain, least share of a notice.
LEAST_MATCH, MOST_GAP, LEAST_SHARE = 3, 8, 0.75
#: A notice's siblings have at least this share of its words in order.
SIBLING = 0.6


def words(text: bytes) -> list[bytes]:
    """Words of an UTF-8 text: runs of ASCII letters (A-Z lowered), digits and all beyond ASCII."""
    return WORDS.findall(text.lower())


class SuffixAutomaton:
    """The generalised suffix automaton of several sequences of small integers.

    A state stands for the sub-sequences with the same set of ends; ``ends`` has
    them, as (sequence, position after the last item).
    """

    def __init__(self, sequences: Sequence[Sequence[int]]):
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[list[tuple[int, int]]] = [[]]
        for number, sequence in enumerate(sequences):
            state = 0
            for at, item in enumerate(sequence, 1):
                state = self._extend(state, item)
                self.ends[state].append((number, at))
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.ends[self.link[state]] += self.ends[state]
        self.ends = [sorted(set(found)) for found in self.ends]

    def _new(self, length: int, link: int, step: dict[int, int]) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        self.ends.append([])
        return len(self.link) - 1

    def _split(self, parent: int, item: int) -> int:
        """The state of the parent's longest sub-sequence and ``item``, made if another one holds it."""
        held = self.step[parent][item]
        if self.length[held] == self.length[parent] + 1:
            return held
        copy = self._new(self.length[parent] + 1, self.link[held], dict(self.step[held]))
        self.link[held] = copy
        while parent >= 0 and self.step[parent].get(item) == held:
            self.step[parent][item] = copy
            parent = self.link[parent]
        return copy

    def _extend(self, state: int, item: int) -> int:
        if item in self.step[state]:
            return self._split(state, item)
        fresh = self._new(self.length[state] + 1, 0, {})
        while state >= 0 and item not in self.step[state]:
            self.step[state][item] = fresh
            state = self.link[state]
        if state >= 0:
            self.link[fresh] = self._split(state, item)
        return fresh

    def maximal_matches(self, items: Sequence[int], least: int) -> Iterator[tuple[int, int, int]]:
        """``(end, length, state)`` of matches that the next item does not prolong."""
        state, length = 0, 0
        for at, item in enumerate(items):
            grown = self.step[state].get(item)
            if grown is None:
                if length >= least:
                    yield at, length, state
                while state > 0 and item not in self.step[state]:
                    state = self.link[state]
                    length = self.length[state]
                grown = self.step[state].get(item)
                if grown is None:
                    continue
            state, length = grown, length + 1
        if length >= least:
            yield len(items), length, state


def telling(text: Sequence[bytes], sibling: Sequence[bytes]) -> set[int]:
    """Places k of a notice where words k - 1 and k must stand side by side to rule the sibling out.

    These are around the words the sibling lacks, and where it has words between. Empty
    for texts that are no siblings.
    """
    matcher = SequenceMatcher(None, text, sibling, autojunk=False)
    if sum(m.size for m in matcher.get_matching_blocks()) < SIBLING * len(text):
        return set()
    edges = {k for tag, low, high, *_ in matcher.get_opcodes() if tag != "equal" for k in range(low, high + 1)}
    return edges - {0, len(text)}


class LicenceScanner:
    """Finds phrases and licence notices in lists of words."""

    def __init__(self, notices: Mapping[str, Sequence[str]], phrases: Mapping[str, str]):
        texts = [(label, words(text.encode())) for label, group in notices.items() for text in group]
        self.phrases = [(words(p.encode()), label) for p, label in phrases.items()]
        known = {w for _, text in texts for w in text} | {w for p, _ in self.phrases for w in p}
        self.number = {w: i for i, w in enumerate(sorted(known), 1)}
        self.labels = [label for label, _ in texts]
        self.sizes = [len(text) for _, text in texts]
        self.telling = [
            np.array(sorted(set().union(*[telling(text, t) for n, t in texts if n != label])), np.int64)
            for label, text in texts
        ]
        self.automaton = SuffixAutomaton([[self.number[w] for w in text] for _, text in texts])

    def numbers(self, found: list[bytes]) -> np.ndarray:
        get = self.number.get
        return np.fromiter((get(w, 0) for w in found), np.int32, len(found))

    def phrase_places(self, ids: np.ndarray) -> list[tuple[int, str]]:
        places = []
        for phrase, label in self.phrases:
            at = np.nonzero(ids[: len(ids) - len(phrase) + 1] == self.number[phrase[0]])[0]
            for k, word in enumerate(phrase[1:], 1):
                at = at[ids[at + k] == self.number[word]]
            places += [(int(i), label) for i in at]
        return places

    def spans(self, ids: np.ndarray) -> list[tuple[int, int, str, float]]:
        """``(first word, end word, label, share)`` of each notice covered to the least share.

        Matches of a notice are chained while places rise in text and notice and at
        most ``MOST_GAP`` words of the text are skipped; a chain's share is that of
        the notice's words it covers. Where words tell the notice from those of other
        labels, the text must have them without others between. Of notices that
        overlap, the one that covers most words is kept.
        """
        matches: dict[int, list[tuple[int, int, int]]] = {}
        edges = np.flatnonzero(np.diff(np.r_[False, ids > 0, False]))
        for low, high in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if high - low < LEAST_MATCH:
                continue
            for end, length, state in self.automaton.maximal_matches(ids[low:high].tolist(), LEAST_MATCH):
                for notice, at in self.automaton.ends[state]:
                    matches.setdefault(notice, []).append((low + end - length, at - length, length))
        found = []
        for notice, hits in matches.items():
            for chain in self._chains(sorted(hits), LEAST_SHARE * self.sizes[notice]):
                place = np.full(self.sizes[notice], -1)
                for start, at, length in chain:
                    place[at : at + length] = np.arange(start, start + length)
                edges = self.telling[notice]
                if np.all((place[edges] == place[edges - 1] + 1) & (place[edges - 1] >= 0)):
                    covered = sum(length for _, _, length in chain)
                    end = chain[-1][0] + chain[-1][2]
                    found.append((covered, chain[0][0], end, self.labels[notice], min(1.0, covered / len(place))))
        kept: list[tuple[int, int, str, float]] = []
        for _, first, end, label, share in sorted(found, key=lambda f: (-f[0], -f[4], f[1], f[3])):
            at = bisect_left(kept, (first,))
            if (at == len(kept) or kept[at][0] >= end) and (at == 0 or kept[at - 1][1] <= first):
                kept.insert(at, (first, end, label, share))
        return kept

    def _chains(self, hits: list[tuple[int, int, int]], least: float) -> Iterator[list[tuple[int, int, int]]]:
        """The chains of at least so many words: the best of each stretch of hits, then those beside it.

        A chain is a list of hits, cut so that none covers words of the one before.
        """
        begin, reach = 0, -1
        stretches = []
        for k, (start, _, length) in enumerate(hits):
            if k > begin and start - reach > MOST_GAP:
                stretches.append(hits[begin:k])
                begin, reach = k, -1
            reach = max(reach, start + length)
        stretches.append(hits[begin:])
        while stretches:
            stretch = stretches.pop()
            best = self._best(stretch)
            taken: list[tuple[int, int]] = []
            for k in sorted(range(len(best)), key=lambda k: (-best[k][0], best[k][1])):
                first, end = best[k][1], stretch[k][0] + stretch[k][2]
                if best[k][0] < least:
                    break
                at = bisect_left(taken, (first,))
                if (at == len(taken) or taken[at][0] >= end) and (at == 0 or taken[at - 1][1] <= first):
                    taken.insert(at, (first, end))
                    yield self._chain(stretch, best, k)
            if taken:
                # What lies between the chains taken may hold others.
                lows, highs = [0, *[end for _, end in taken]], [*[first for first, _ in taken], None]
                starts = [h[0] for h in stretch]
                for low, high in zip(lows, highs, strict=True):
                    inner = stretch[bisect_left(starts, low) : None if high is None else bisect_left(starts, high)]
                    stretches.append([h for h in inner if high is None or h[0] + h[2] <= high])

    @staticmethod
    def _best(hits: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
        """Words covered, first word, hit before and words cut of the best chain that ends with each hit."""
        best: list[tuple[int, int, int, int]] = []
        for k, (start, place, length) in enumerate(hits):
            own = (length, start, -1, 0)
            for j in range(k - 1, -1, -1):
                s, p, n = hits[j]
                if start - s > MOST_GAP + max(n, length) + LONGEST:
                    break
                skip = max(0, s + n - start, p + n - place)
                if s < start and p < place and skip < length and start + skip - (s + n) <= MOST_GAP:
                    own = max(own, (best[j][0] + length - skip, best[j][1], j, skip), key=lambda c: (c[0], -c[1]))
            best.append(own)
        return best

    @staticmethod
    def _chain(hits: list[tuple[int, int, int]], best: list[tuple[int, int, int, int]], at: int):
        chain = []
        while at >= 0:
            start, place, length = hits[at]
            _, _, before, skip = best[at]
            chain.append((start + skip, place + skip, length - skip))
            at = before
        return chain[::-1]


#: No match is longer than the longest notice.
LONGEST = max(len(words(text.encode())) for group in NOTICES.values() for text in group)

@cache
def _scanner(notices: tuple, phrases: tuple) -> LicenceScanner:
    """One scanner a worker process, for all its tasks."""
    return LicenceScanner(dict(notices), dict(phrases))


FIELDS = (
    "n_words bigint, base array<struct<word:bigint,label:string>>,"
    " spans array<struct<first:bigint,end:bigint,label:string,share:double>>"
)


def scan_licenses(
    df: DataFrame,
    key: str,
    text: str,
    notices: Mapping[str, Sequence[str]] = NOTICES,
    phrases: Mapping[str, str] = PHRASES,
) -> DataFrame:
    """``(key, n_words, base, spans)``: one row per row of ``df``.

    ``base`` has every place of a phrase, ``spans`` the stretches that cover a
    licence notice: each text runs once through the suffix automaton of all
    notices, which gives its maximal matches, and long ones are chained. Words no
    notice has end a match at once. The automaton is small and goes to the workers with the code.

    NULL texts count as empty, with no words and empty lists. Very long texts are
    streamed whole. Repeated rows and NULL keys stay, other columns are left out. An
    empty table gives an empty table.
    """

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(tuple((k, tuple(v)) for k, v in notices.items()), tuple(phrases.items()))
        place = pa.struct([("word", pa.int64()), ("label", pa.string())])
        span = pa.struct(
            [("first", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("share", pa.float64())]
        )
        for batch in batches:
            counts, base, spans = [], [], []
            for value in batch.column(1):
                found = words(value.as_py().encode())
                ids = scanner.numbers(found)
                counts.append(len(found))
                base.append([{"word": w, "label": n} for w, n in sorted(scanner.phrase_places(ids))])
                spans.append(
                    [dict(zip(("first", "end", "label", "share"), s, strict=True)) for s in scanner.spans(ids)]
                )
            columns = [
                batch.column(0),
                pa.array(counts, pa.int64()),
                pa.array(base, pa.list_(place)),
                pa.array(spans, pa.list_(span)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["key", "n_words", "base", "spans"])

    kind = df.schema[key].dataType.simpleString()
    narrow = df.select(named(key).alias("key"), text_or_empty(text).alias("text"))
    return narrow.mapInArrow(scan, f"key {kind}, {FIELDS}")
