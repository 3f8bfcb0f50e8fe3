"""License scan by patience alignment.

A text is aligned with each template: words unique to both are anchors, the
longest increasing subsequence of the anchors is kept, and the gaps between
kept anchors are aligned the same way, recursively (common words at the ends of
a gap first; a gap without anchors by a longest common subsequence). Coverage is the share of
the template's words that found a partner; a template is reported where it is
covered to ``COVERAGE`` or more, or wholly if it has at most ``SHORT`` words.
Besides, a copy must have the words that tell a license from its neighbours: its
names, its version numbers and a word of its own clauses; and it must not hold, between its
words, those that make it another license (``license_texts``).

Where to align. A copy that lacks at most a share of 1 - COVERAGE of the words
must hold one of the template's longest words (one more than may be missing);
texts without any are done after one multi-pattern search. In the others, words
that are unique in the template vote for where a copy would begin; votes within
a quarter of the template's length form one window, so several copies in one
text, and copies in very long texts, are each found. A copy with more words than
that put in between has no window: where a text without one holds enough of a
longer template's unique words, all of it from the first to the last of them is
aligned. Templates include an SPDX tag for each license.

Defined results: null and empty texts have no license; equal or overlapping
finds are settled by matched words, then template order; words compare in lower case and
without punctuation around them; positions count white-space separated words.
"""

from __future__ import annotations

import bisect
import re
from collections import Counter

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quire.llm.common import arrow_map, bounded_batches
from quire.llm.license_texts import CLAUSES, NAMES, QUALIFIERS, TEMPLATES

COVERAGE = 0.8
#: Templates of so many words are notices: each of their words counts.
SHORT = 20

FOUND = T.ArrayType(
    T.StructType(
        [
            T.StructField("license", T.StringType()),
            T.StructField("coverage", T.DoubleType()),
            T.StructField("matched", T.IntegerType()),
            T.StructField("start_word", T.IntegerType()),
            T.StructField("end_word", T.IntegerType()),
        ]
    )
)
_VERSION = re.compile(r"\d+\.\d+")
_EDGES = re.compile(r"^\W+|\W+$")


def normalized(text: str) -> list[str]:
    """The white-space separated words in lower case, without punctuation around them."""
    return [_EDGES.sub("", w) for w in text.lower().split()]


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest subsequence of pairs (sorted by first) whose seconds increase, by patience sorting."""
    tops: list[int] = []
    held: list[int] = []
    back = [-1] * len(pairs)
    for i, (_, b) in enumerate(pairs):
        pile = bisect.bisect_left(tops, b)
        back[i] = held[pile - 1] if pile else -1
        if pile == len(tops):
            tops.append(b)
            held.append(i)
        else:
            tops[pile], held[pile] = b, i
    out, i = [], held[-1] if held else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def _common(a: list[str], b: list[str], a0: int, a1: int, b0: int, b1: int) -> list[tuple[int, int]]:
    """A longest common subsequence of two gaps."""
    n, m = a1 - a0, b1 - b0
    table = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        row, below = table[i], table[i + 1]
        for j in range(m - 1, -1, -1):
            row[j] = below[j + 1] + 1 if a[a0 + i] == b[b0 + j] else max(below[j], row[j + 1])
    out, i, j = [], 0, 0
    while i < n and j < m:
        if a[a0 + i] == b[b0 + j]:
            out.append((a0 + i, b0 + j))
            i, j = i + 1, j + 1
        elif table[i + 1][j] >= table[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Patience alignment of two word lists: matched positions, increasing in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {b[j]: j for j in range(b0, b1) if in_b[b[j]] == 1}
        anchors = increasing([(i, place[a[i]]) for i in range(a0, a1) if a[i] in place and in_a[a[i]] == 1])
        if not anchors:
            if in_a.keys() & in_b.keys():
                out += _common(a, b, a0, a1, b0, b1)
            continue
        out += anchors
        for (i, j), (k, m) in zip([(a0 - 1, b0 - 1), *anchors], [*anchors, (a1, b1)], strict=True):
            if i + 1 < k and j + 1 < m:
                todo.append((i + 1, k, j + 1, m))
    return sorted(out)


class Template:
    def __init__(self, name: str, text: str, coverage: float) -> None:
        self.name, self.words = name, [w for w in normalized(text) if w]
        n = len(self.words)
        self.coverage = coverage = 1.0 if n <= SHORT else coverage
        numbers = {w for v, w in zip(["", *self.words], self.words) if _VERSION.fullmatch(w) or (v == "version" and w.isdigit())}
        own, foreign = CLAUSES.get(name, (frozenset(), frozenset()))
        self.needs = [{w} for w in sorted(NAMES.intersection(self.words) | numbers)] + ([own] if own else [])
        self.refuses = foreign.union(*(QUALIFIERS[w] for w in QUALIFIERS if w in self.words))
        self.missing = int(n * (1 - coverage) + 1e-9)
        self.musts = sorted(self.words, key=lambda w: (-len(w), w))[: self.missing + 1]
        counts = Counter(self.words)
        self.at = {w: i for i, w in enumerate(self.words) if counts[w] == 1}
        self.slack = max(2, n // 4)

    def windows(self, words: list[str]) -> list[tuple[int, int]]:
        """Where copies could lie: each has enough votes for beginning there."""
        votes = sorted(i - self.at[w] for i, w in enumerate(words) if w in self.at)
        need = max(1, len(self.at) - self.missing)
        out: list[tuple[int, int]] = []
        k = 0
        while k < len(votes):
            stop = bisect.bisect_right(votes, votes[k] + self.slack)
            if stop - k >= need:
                out.append((max(0, votes[k] - self.slack), min(len(words), votes[stop - 1] + len(self.words) + self.slack)))
                k = stop
            else:
                k += 1
        if not out and len(self.words) > SHORT:
            seen = [i for i, w in enumerate(words) if w in self.at]
            if len({words[i] for i in seen}) >= need:
                out = [(max(0, seen[0] - len(self.words)), min(len(words), seen[-1] + len(self.words)))]
        return out

    def holds(self, words: list[str], pairs: list[tuple[int, int]]) -> bool:
        """Whether an alignment with words is a copy of this license, not of a neighbour."""
        if not pairs or len(pairs) < self.coverage * len(self.words):
            return False
        matched = {self.words[j] for _, j in pairs}
        if any(matched.isdisjoint(need) for need in self.needs):
            return False
        at = {i for i, _ in pairs}
        return not any(words[i] in self.refuses for i in range(pairs[0][0], pairs[-1][0]) if i not in at)


class Scanner:
    def __init__(self, templates: dict[str, str], coverage: float) -> None:
        self.templates = [Template(k, v, coverage) for k, v in templates.items()]
        self.musts = ahocorasick.Automaton()
        for i, t in enumerate(self.templates):
            for w in t.musts:
                self.musts.add_word(w, self.musts.get(w, frozenset()) | {i})
        self.musts.make_automaton()

    def scan(self, text: str | None) -> list[tuple]:
        if not text:
            return []
        hits: set[int] = set()
        for _, which in self.musts.iter(text.lower()):
            hits |= which
        if not hits:
            return []
        words = normalized(text)
        found = []
        for i in sorted(hits):
            t = self.templates[i]
            for start, stop in t.windows(words):
                pairs = align(words[start:stop], t.words)
                if t.holds(words[start:stop], pairs):
                    found.append((len(pairs), i, len(pairs) / len(t.words), start + pairs[0][0], start + pairs[-1][0] + 1))
        out: list[tuple] = []
        for n, i, coverage, start, stop in sorted(found, key=lambda x: (-x[0], -x[2], x[1], x[3])):
            if all(stop <= x[3] or x[4] <= start for x in out):
                out.append((self.templates[i].name, coverage, n, start, stop))
        return sorted(out, key=lambda x: x[3])


_scanners: dict[tuple, Scanner] = {}


def scan(df: DataFrame, text: str = "text", out: str = "licenses", templates: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """df with an array of the licenses found, in text order."""
    bounded_batches(df.sparkSession)
    given = dict(templates or TEMPLATES)

    def rows(column: list[bytes | None]) -> dict[str, list]:
        key = (tuple(given.items()), coverage)
        if key not in _scanners:
            _scanners.clear()
            _scanners[key] = Scanner(given, coverage)
        fields = [f.name for f in FOUND.elementType]
        return {out: [[dict(zip(fields, x, strict=True)) for x in _scanners[key].scan(None if t is None else t.decode())] for t in column]}

    return arrow_map(df, [text], T.StructType([T.StructField(out, FOUND)]), rows)
