"""Operator 1: benchmark decontamination by pigeonhole edit matching.

Texts are compared lower-cased with white space runs as one space. An item of m characters may be met
with at most k = floor(rate * m) edits. It is cut into k + 1 pieces, so any passage within k edits holds
at least one piece unchanged, at a place that is off by at most k. All pieces of all items are found in
one pass over a document (Aho-Corasick); each hit gives a stretch of the document in which Myers'
bit-parallel distance looks for the whole item.

Items are a stated query set: they are read in blocks of at most ``block_chars`` characters, and each
block is held against all documents, so what is broadcast is bounded by that parameter. An item too short for
one edit is its own piece and must stand between word borders (a few letters inside a word say nothing). Empty and
null items are not searched; ``min_chars`` leaves out shorter ones (after normalising), which it does not by default.
Null and empty documents match nothing. Repeated items and rows are matched each.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from riskspark.llm.common import slices, table

RATE = 0.05
MIN_CHARS = 0
BLOCK_CHARS = 16_000_000
RESULT = "doc_id long, item_id long, distance long, norm_start long, norm_end long"


def normalise(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """k + 1 pieces of nearly equal length that make up the item, with their offsets."""
    cuts = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def bounded(text: str, start: int, end: int) -> bool:
    """Whether a passage begins and ends at word borders."""
    return not (start > 0 and text[start - 1].isalnum() and text[start].isalnum()) and not (end < len(text) and text[end].isalnum() and text[end - 1].isalnum())


class Pattern:
    """Myers' bit vectors of one item: finds the end with the least distance in a stretch of text."""

    def __init__(self, item: str):
        self.m, self.item = len(item), item
        self.mask = (1 << self.m) - 1
        self.peq: dict[str, int] = {}
        for i, c in enumerate(item):
            self.peq[c] = self.peq.get(c, 0) | 1 << i
        self.reverse: Pattern | None = None

    def ends(self, text: str) -> tuple[int, int]:
        """(least distance of the item to any substring of ``text``, first end of such a substring)."""
        pv, mv, score, high, mask, peq = self.mask, 0, self.m, 1 << self.m - 1, self.mask, self.peq
        best, at = score, 0
        for j, c in enumerate(text, 1):
            eq = peq.get(c, 0)
            xv = eq | mv
            xh = ((eq & pv) + pv ^ pv) | eq
            ph = mv | ~(xh | pv) & mask
            mh = pv & xh
            if ph & high:
                score += 1
            elif mh & high:
                score -= 1
            ph = ph << 1 & mask  # the search may start anywhere: row 0 stays 0
            mh = mh << 1 & mask
            pv = mh | ~(xv | ph) & mask
            mv = ph & xv
            if score < best:
                best, at = score, j
        return best, at

    def find(self, text: str) -> tuple[int, int, int]:
        """(distance, start, end) of a closest substring; the start comes from the item read backwards."""
        best, end = self.ends(text)
        if self.reverse is None:
            self.reverse = Pattern(self.item[::-1])
        stretch = text[max(0, end - self.m - best):end][::-1]
        # among the substrings that end here: distance of the whole item to prefixes of the reversed stretch
        row = self.reverse.prefix_distance(stretch)
        length = min(range(len(row)), key=lambda i: (row[i], abs(i - self.m)))
        return best, end - length, end

    def prefix_distance(self, text: str) -> list[int]:
        """Distance of the item to each prefix of ``text``."""
        pv, mv, score, high, mask, peq = self.mask, 0, self.m, 1 << self.m - 1, self.mask, self.peq
        out = [score]
        for c in text:
            eq = peq.get(c, 0)
            xv = eq | mv
            xh = ((eq & pv) + pv ^ pv) | eq
            ph = mv | ~(xh | pv) & mask
            mh = pv & xh
            if ph & high:
                score += 1
            elif mh & high:
                score -= 1
            ph = (ph << 1 | 1) & mask  # row 0 grows with the text
            mh = mh << 1 & mask
            pv = mh | ~(xv | ph) & mask
            mv = ph & xv
            out.append(score)
        return out


class Items:
    """A block of items: the automaton of their pieces, and their patterns."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        import ahocorasick

        self.items = [(n, t, int(rate * len(t))) for n, t in items]
        where: dict[str, list[tuple[int, int]]] = {}
        for i, (_, t, k) in enumerate(self.items):
            for offset, piece in pieces(t, k):
                where.setdefault(piece, []).append((i, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, places in where.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.automaton.make_automaton()
        self.patterns: dict[int, Pattern] = {}

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item id, distance, start, end) of each item within its budget, once per text."""
        stretches: dict[int, set[int]] = {}
        for end, (length, places) in self.automaton.iter(text):
            for i, offset in places:
                stretches.setdefault(i, set()).add(end + 1 - length - offset)
        out = []
        for i, starts in stretches.items():
            number, item, k = self.items[i]
            best = None
            if not k:  # the piece is the item
                at = next((a for a in sorted(starts) if bounded(text, a, a + len(item))), None)
                if at is not None:
                    out.append((number, 0, at, at + len(item)))
                continue
            spans: list[list[int]] = []
            for at in sorted(starts):  # stretches that overlap are read once
                a, b = max(0, at - k), min(len(text), at + len(item) + k)
                if spans and a <= spans[-1][1]:
                    spans[-1][1] = b
                else:
                    spans.append([a, b])
            for a, b in spans:
                exact = text.find(item, a, b)
                if exact >= 0:
                    best = (0, exact, exact + len(item))
                    break
                if b - a < len(item) - k:
                    continue
                if i not in self.patterns:
                    self.patterns[i] = Pattern(item)
                pattern = self.patterns[i]
                d, _ = pattern.ends(text[a:b])
                if d <= k and (best is None or d < best[0]):
                    d, s, e = pattern.find(text[a:b])
                    best = (d, a + s, a + e)
            if best:
                out.append((number, *best))
        return out


_READY: dict[int, tuple] = {}


def _block_matcher(shared, rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if id(shared) not in _READY:
            _READY.clear()
            _READY[id(shared)] = (shared, Items(shared.value, rate))
        items = _READY[id(shared)][1]
        for rows, texts in slices(batches):
            at, found = [], []
            for i, t in enumerate(texts):
                for m in items.matches(normalise(t)):
                    at.append(i)
                    found.append(m)
            if at:
                out = rows.select(["doc_id"]).take(pa.array(at))
                for j, name in enumerate(("item_id", "distance", "norm_start", "norm_end")):
                    out = out.append_column(name, pa.array([f[j] for f in found], pa.int64()))
                yield from out.combine_chunks().to_batches()
    return run


def item_blocks(items: DataFrame, block_chars: int, min_chars: int) -> Iterator[list[tuple[int, str]]]:
    """Blocks of (item id, normalised text); each is as many items as fit ``block_chars`` (one item at least)."""
    block: list[tuple[int, str]] = []
    chars = 0
    for row in items.toLocalIterator():
        t = normalise(row.text)
        if len(t) < max(1, min_chars):
            continue
        if block and chars + len(t) > block_chars:
            yield block
            block, chars = [], 0
        block.append((row.item_id, t))
        chars += len(t)
    if block:
        yield block


def contamination(docs: DataFrame, items: DataFrame, rate: float = RATE, min_chars: int = MIN_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document row and item that it holds within the budget: doc_id, item_id, distance, norm_start,
    norm_end (of the closest passage, in the normalised text). ``docs`` needs doc_id and text, ``items`` item_id and
    text; other columns are not read. Items without an id are searched too and reported with a null id."""
    spark = docs.sparkSession
    out = spark.createDataFrame([], RESULT)
    for block in item_blocks(items.select("item_id", "text"), block_chars, min_chars):
        shared = spark.sparkContext.broadcast(block)
        out = out.unionByName(docs.select("doc_id", "text").mapInArrow(_block_matcher(shared, rate), RESULT))
    return out


def _clean_rows(shared, rate: float, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if id(shared) not in _READY:
            _READY.clear()
            _READY[id(shared)] = (shared, Items(shared.value, rate))
        items = _READY[id(shared)][1]
        for rows, texts in slices(batches, text):
            yield from rows.filter(pa.array([not items.matches(normalise(t)) for t in texts], pa.bool_())).combine_chunks().to_batches()
    return run


def drop_contaminated(docs: DataFrame, items: DataFrame, rate: float = RATE, min_chars: int = MIN_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` that hold no item within its budget, each row judged by its own text."""
    for block in item_blocks(items.select("item_id", "text"), block_chars, min_chars):
        docs = docs.mapInArrow(_clean_rows(docs.sparkSession.sparkContext.broadcast(block), rate, "text"), docs.schema)
    return docs


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per contaminated document and benchmark item: doc_id, item_id, distance, norm_start, norm_end."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op1_decontaminate": op1_decontaminate}
