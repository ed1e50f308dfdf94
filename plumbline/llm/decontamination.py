"""Benchmark decontamination by template canonicalisation.

Words lose their outer punctuation and case.  Numbers, units after a number and
names become typed placeholders; what is left is the template.  A text has three:
names are its words capitalised inside a sentence, all its capitalised words (a name
may start a sentence or line), or none (a copy may be in one case).  Windows of ``WINDOW`` template words, ``LITERALS`` of them literal
at least, are joined by hash with those of the same form of the benchmark items, and so are windows
of ``WINDOW`` plain words, whatever they are.  Hits of one form on one
diagonal (place in the document minus place in the item) are one alignment of
the two texts; its slots give pairs of item value and document value.  Slots
must be consistent: within a type, one item value always stands for one document
value and the reverse.  An alignment with equal values is ``verbatim``; with
consistent but other values it is ``reparameterised``; an inconsistent one is
cut to its verbatim windows.  A document leaks an item if an alignment covers a
run of ``RUN`` words, or all of a shorter item.

The windows of the benchmark go to every task in blocks of ``BLOCK`` windows, so
what is sent is bounded, and one pass over the documents serves each block.
Documents aren't shuffled: a hot passage costs its hits alone.

Null texts and items hold no words and leak nothing.  Items with fewer than
``WINDOW`` words are compared as one window of their length, as templates if they
have ``SHORTEST`` words; a one-word item is leaked by every text with the word.  Repeated rows are judged one by one; repeated items each
give a row.  Empty tables give no rows.  Only id and text columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm._shared import text_of
from plumbline.llm._words import Words, chunks, mix, runs

WINDOW, LITERALS, RUN, SHORTEST = 8, 4, 13, 5
BLOCK = 500_000
#: hits that are aligned at once
HITS = 2_000_000
# fixed values: units of measure that may follow a number
UNITS = (
    "mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams kilogram kilograms ounce ounces pound pounds ton tons ml l liter liters litre litres gallon gallons "
    "second seconds minute minutes hour hours day days week weeks month months year years dollar dollars euro euros cent cents percent degrees mph kmh meters metres kilometers kilometres"
).split()
_PUNCT = np.zeros(256, bool)
_PUNCT[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?:;"]] = True
NUMBER, UNIT, NAME = 1, 2, 3
#: forms of a text: names are capitalised words inside a sentence, all capitalised words, or none; plain words
INSIDE, TITLE, NO_NAMES, PLAIN = FORMS = range(4)
_MARKS = mix(np.arange(1, 5, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))

#: stands before the first letter of a word that is a capital beyond ASCII
_CAPITAL = 1
_FOLD = {c: chr(c).lower() if len(chr(c).lower()) > 1 or not chr(c).isupper() else chr(_CAPITAL) + chr(c).lower() for c in range(128, 0x1E944) if chr(c).lower() != chr(c)}
_INNER = re.compile(r"(?<=\w)\x01")


def folded(text: str) -> bytes:
    """The text with letters beyond ASCII in lower case, marked where one begins a word; Templates folds A-Z, whose case tells names."""
    if not text.isascii():
        text = text.translate(_FOLD)
        if "\x01" in text:
            text = _INNER.sub("", text)
    return text.encode()


class Templates:
    """Template words of a few texts: ``kind`` of each word by form (0 literal), ``plain`` (hash of the word itself)."""

    def __init__(self, texts: list[bytes]):
        w = self.words = Words(texts, lower=True)
        start, end = w.start.copy(), w.end.copy()
        for _ in range(8):
            start += (start < end - 1) & _PUNCT[w.data[start]]
            end -= (start < end - 1) & _PUNCT[w.data[end - 1]]
        marked = (start < end - 1) & (w.data[start] == _CAPITAL) if len(start) else np.zeros(0, bool)
        start += marked
        self.start, self.end, self.of = start, end, w.of
        self.plain = w.hash_of(start, end)
        kind = np.zeros(len(start), np.int8)
        if len(start):
            first = w.raw[start]
            number = (first >= 48) & (first <= 57)
            before = np.concatenate(([False], number[:-1])) & np.concatenate(([False], w.of[1:] == w.of[:-1]))
            # the letter after the first one, which has two bytes or more beyond ASCII
            second = w.raw[np.minimum(start + 1 + (first >= 0xC0) + (first >= 0xE0) + (first >= 0xF0), end - 1)]
            small = (second >= 97) & (second <= 122) | (second >= 0xC0)
            title = ((first >= 65) & (first <= 90) | marked) & small
            inside = np.concatenate(([False], (w.of[1:] == w.of[:-1]) & ~_ENDS[w.raw[w.end[:-1] - 1]])) & (w.raw[np.maximum(w.start - 1, 0)] != 10)
            kind[before & np.isin(self.plain, _UNIT_HASHES)] = UNIT
            kind[number] = NUMBER
            title &= kind == 0
        else:
            title = inside = np.zeros(0, bool)
        self.kind = {v: np.where(names, NAME, kind) for v, names in ((INSIDE, title & inside), (TITLE, title), (NO_NAMES, False))}
        self.kind[PLAIN] = self.kind[INSIDE]

    def word(self, i: int) -> bytes:
        return self.words.data[self.start[i] : self.end[i]].tobytes()

    def windows(self, k: int, form: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of windows: of all plain words, or of templates with enough literal words."""
        if form == PLAIN:
            return runs(self.plain, self.of, k)
        kind = self.kind[form]
        at, h = runs(np.where(kind > 0, _MARKS[kind], self.plain), self.of, k)
        literal = np.concatenate(([0], np.cumsum(kind == 0)))
        enough = literal[at + k] - literal[at] >= min(LITERALS, k)
        return at[enough], h[enough]


_u = Words([u.encode() for u in UNITS])
_UNIT_HASHES = _u.hash


class Sieve:
    """Which hashes may be among the known ones: all that are, and about one in sixteen others; the search of the known ones is costly."""

    def __init__(self, known: np.ndarray):
        self.shift = np.uint64(64 - max(12, (16 * len(known)).bit_length()))
        self.seen = np.zeros(1 << (64 - int(self.shift)), bool)
        self.seen[known.astype(np.uint64) >> self.shift] = True

    def holds(self, h: np.ndarray) -> np.ndarray:
        return np.flatnonzero(self.seen[h.astype(np.uint64, copy=False) >> self.shift])


class Items:
    """Windows of benchmark items, by length of the window."""

    def __init__(self, rows: list[tuple[object, str]]):
        self.ids = [i for i, _ in rows]
        self.t = t = Templates([folded(x) for _, x in rows])
        self.n, self.first = t.words.n, t.words.first
        self.by_length: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, Sieve]] = {}
        for form in FORMS:
            for k in sorted({min(int(n), WINDOW) for n in self.n if n >= (1 if form == PLAIN else SHORTEST)}):
                at, h = t.windows(k, form)
                size = self.n[t.of[at]]
                own = size >= WINDOW if k == WINDOW else size == k
                order = np.argsort(h[own], kind="stable")
                self.by_length[form, k] = h[own][order], at[own][order], Sieve(h[own])

    def hits(self, d: Templates) -> Iterator[tuple[int, int, list[tuple[int, int, np.ndarray]]]]:
        """(text, item, [(form, diagonal, words of d on it)]) for diagonals with a run that is long enough."""
        texts = len(d.words.n)
        found, total = [], np.zeros(texts, np.int64)
        for (form, k), (known, place, sieve) in self.by_length.items():
            at, h = d.windows(k, form)
            likely = sieve.holds(h)
            at, h = at[likely], h[likely]
            lo, hi = np.searchsorted(known, h, "left"), np.searchsorted(known, h, "right")
            own = np.flatnonzero(hi > lo)
            if len(own):
                found.append((form, k, place, at[own], lo[own], hi[own] - lo[own]))
                total += np.bincount(d.of[at[own]], hi[own] - lo[own], texts).astype(np.int64)
        if not found:
            return
        # texts together that make about HITS hits, so that a passage of many items doesn't fill the memory
        part = np.cumsum(total) // HITS
        for x in np.unique(part[total > 0]):
            yield from self._aligned(d, found, part == x)

    def _aligned(self, d: Templates, found: list[tuple], wanted: np.ndarray) -> Iterator[tuple[int, int, list[tuple[int, int, np.ndarray]]]]:
        cols: list[list[np.ndarray]] = [[], [], [], [], []]
        for form, k, place, at, lo, times in found:
            own = wanted[d.of[at]]
            a, low, n = at[own], lo[own], times[own]
            first = np.repeat(a, n)
            there = place[np.repeat(low, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)]
            for c, v in zip(cols, (d.of[first], self.t.of[there], np.full(len(first), form * 256 + k), first - there, first), strict=True):
                c.append(v)
        text, item, kind, shift, first = (np.concatenate(c) for c in cols)
        order = np.lexsort((first, shift, kind, item, text))
        text, item, kind, shift, first = (v[order] for v in (text, item, kind, shift, first))
        same = (text[1:] == text[:-1]) & (item[1:] == item[:-1]) & (kind[1:] == kind[:-1]) & (shift[1:] == shift[:-1])
        width = kind % 256
        # runs of words of one diagonal, and the longest of each
        joined = same & (first[1:] <= first[:-1] + width[:-1])
        begin = np.flatnonzero(np.concatenate(([True], ~joined)))
        finish = np.concatenate((begin[1:] - 1, [len(first) - 1]))
        length = first[finish] + width[finish] - first[begin]
        diagonal = np.flatnonzero(np.concatenate(([True], ~same)))
        of = np.searchsorted(diagonal, begin, "right") - 1
        longest = np.maximum.reduceat(length, np.searchsorted(of, np.arange(len(diagonal))))
        enough = np.flatnonzero(longest >= np.minimum(RUN, self.n[item[diagonal]]))
        stop = np.concatenate((diagonal[1:], [len(first)]))
        now, held = None, []
        for g in enough:
            x, y = diagonal[g], stop[g]
            key = int(text[x]), int(item[x])
            if key != now:
                if now:
                    yield *now, held
                now, held = key, []
            held.append((int(kind[x]) // 256, int(shift[x]), np.unique((first[x:y, None] + np.arange(width[x])).ravel())))
        if now:
            yield *now, held

    def judge(self, d: Templates, item: int, diagonals: list[tuple[int, int, np.ndarray]]) -> tuple[int, int, int, str] | None:
        """(words covered, longest run, slots, kind) of the best alignment, if it leaks."""
        best = None
        need = min(RUN, int(self.n[item]))
        for form, shift, covered in diagonals:
            kinds = d.kind[form]
            there, back, same = {}, {}, True
            slot = covered[kinds[covered] > 0]
            for i in slot.tolist():
                mine, theirs, kind = d.word(i), self.t.word(i - shift), int(kinds[i])
                same = same and mine == theirs
                there.setdefault((kind, theirs), set()).add(mine)
                back.setdefault((kind, mine), set()).add(theirs)
            kind = "verbatim" if same else "reparameterised"
            if any(len(v) > 1 for x in (there, back) for v in x.values()):
                kind, covered = "verbatim", covered[d.plain[covered] == self.t.plain[covered - shift]]
            cut = np.flatnonzero(np.concatenate(([True], np.diff(covered) > 1, [True]))) if len(covered) else np.zeros(1, np.int64)
            longest = int(np.diff(cut).max(initial=0))
            if longest >= need and (best is None or len(covered) > best[0]):
                best = (len(covered), longest, len(slot), kind)
        return best


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """A row for each document and item it leaks: ids, item_words, covered words, longest run, slots, kind."""
    spark = docs.sparkSession
    # ids travel as text: pandas would make numbers with nulls among them inexact
    rows = docs.select(F.col(id_col).cast("string").alias("__id"), text_of(text_col).alias("__text"))
    types = {id_col: docs.schema[id_col].dataType, item_col: benchmark.schema[item_col].dataType}
    schema = f"`{id_col}` string, `{item_col}` string, item_words long, covered_words long, longest_run long, slots long, kind string"
    columns = [id_col, item_col, "item_words", "covered_words", "longest_run", "slots", "kind"]

    def search(block: list[tuple[object, str]]) -> DataFrame:
        sent = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            items = Items(sent.value)
            for b in batches:
                texts, ids = [folded(t) for t in b["__text"]], b["__id"].tolist()
                for lo, hi in chunks(texts):
                    d = Templates(texts[lo:hi])
                    out = []
                    for doc, item, diagonals in items.hits(d):
                        if got := items.judge(d, item, diagonals):
                            out.append((ids[lo + doc], items.ids[item], int(items.n[item]), *got))
                    if out:
                        yield pd.DataFrame(out, columns=columns)

        return rows.mapInPandas(run, schema).withColumns({c: F.col(c).cast(t) for c, t in types.items()})

    out = None
    for block in _blocks(benchmark, item_col, item_text_col):
        out = search(block) if out is None else out.unionByName(search(block))
    return out


def _blocks(benchmark: DataFrame, item_col: str, item_text_col: str) -> Iterator[list[tuple[object, str]]]:
    """Items in blocks of about BLOCK words; one empty block for an empty table."""
    block, held, any_yet = [], 0, False
    for r in benchmark.select(F.col(item_col).cast("string").alias("i"), text_of(item_text_col).alias("t")).toLocalIterator():
        block.append((r["i"], r["t"]))
        held += len(r["t"].split())
        if held >= BLOCK:
            yield block
            block, held, any_yet = [], 0, True
    if block or not any_yet:
        yield block


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of docs that leak no item, with all their columns; documents aren't shuffled."""
    for block in _blocks(benchmark, item_col, item_text_col):
        docs = docs.filter(~_leak_test(docs.sparkSession.sparkContext.broadcast(block))(text_of(text_col)))
    return docs


def _leak_test(sent: Broadcast):
    @F.pandas_udf("boolean")
    def leaks(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        items = Items(sent.value)
        for b in batches:
            texts = [folded(t) for t in b]
            found = np.zeros(len(texts), bool)
            for lo, hi in chunks(texts):
                d = Templates(texts[lo:hi])
                for doc, item, diagonals in items.hits(d):
                    found[lo + doc] = found[lo + doc] or items.judge(d, item, diagonals) is not None
            yield pd.Series(found)

    return leaks
