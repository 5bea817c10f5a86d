"""Benchmark decontamination by pigeonhole edit matching.

Method: a test item may occur with up to e edits, a tenth of its length. It is cut into e + 1
pieces, so at least one piece of any such occurrence is unchanged. One Aho-Corasick automaton
finds all exact piece hits in a whole text; each hit names a window in which the item would
lie, and Myers' bit-parallel algorithm gives the lowest edit distance of the item to any part
of the window. Hits whose windows overlap are verified once. Before that, the pigeonhole rule
is held against growing parts of the item around the hit: if n pieces in a row occur with at
most n - 1 edits, so does one of their halves with its share, so a hit whose pair, then four
and so on of pieces don't occur is dropped early, and no occurrence is lost.

Items and texts are compared in lower case with runs of white space as one space.

The test set is the stated query set, held against all rows in blocks: its size is measured
first, and each block of at most ``BLOCK_CHARS`` characters is broadcast to one narrow pass
over the texts, without a shuffle.

Nulls, ties and odd rows: a null text is empty; an item that is null or has no characters
besides white space matches nothing; an item shorter than ten characters matches only
unchanged; of occurrences with equal distance the first end counts; repeated items and rows
each count; null ids stay null; empty tables give no hits; the other columns of ``docs`` are
kept by ``clean`` and ignored by ``hits``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkgate.llm.common import map_rows, short_batches

#: Edits allowed for each character of an item.
ERROR_RATE = 0.1
#: Characters of test items that a pass over the texts looks for.
BLOCK_CHARS = 4_000_000


def normal(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """``item`` cut into ``errors + 1`` pieces of nearly equal length, with their places."""
    cuts = [len(item) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def letters(item: str) -> dict[str, int]:
    """Bit i of a character's mask says that it is character i of the item."""
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def distance(masks: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """Lowest edit distance of an item of length ``m`` to a part of ``text``, and that part's
    end (the first such). Myers: a column of the distance table is two words of m bits."""
    full, top = (1 << m) - 1, m - 1
    plus, minus, score = full, 0, m
    best = (m, 0)
    for at, c in enumerate(text, 1):
        same = masks.get(c, 0)
        vertical = same | minus
        flat = (((same & plus) + plus) ^ plus) | same
        up = minus | (full & ~(flat | plus))
        down = plus & flat
        score += (up >> top) - (down >> top & 1)
        if score < best[0]:
            best = (score, at)
        up, down = up << 1 & full, down << 1 & full
        plus = down | (full & ~(vertical | up))
        minus = up & vertical
    return best


def growing(cuts: list[int], piece: int) -> list[tuple[int, int]]:
    """The halves, quarters and so on of the pieces that hold one piece, smallest first."""
    low, high, out = 0, len(cuts) - 1, []
    while high - low > 1:
        out.append((low, high))
        middle = (low + high) // 2
        low, high = (low, middle) if piece < middle else (middle, high)
    return out[:0:-1]


class Finder:
    """Test items, ready to be looked for in texts."""

    def __init__(self, items: list[tuple[int | None, str]]):
        import ahocorasick
        self.items = []
        places: dict[str, list[tuple[int, int, list]]] = {}
        for item_id, text in items:
            if not (item := normal(text)):
                continue
            errors = math.floor(ERROR_RATE * len(item))
            cut = pieces(item, errors)
            cuts = [at for at, _ in cut] + [len(item)]
            parts: dict[tuple[int, int], tuple] = {}
            for i, (at, piece) in enumerate(cut):
                around = []
                for low, high in growing(cuts, i):
                    if (low, high) not in parts:
                        parts[low, high] = (cuts[low], cuts[high] - cuts[low], high - low - 1,
                                            letters(item[cuts[low]:cuts[high]]))
                    around.append(parts[low, high])
                places.setdefault(piece, []).append((len(self.items), at, around))
            self.items.append((item_id, len(item), errors, letters(item)))
        self.machine = ahocorasick.Automaton()
        for piece, where in places.items():
            self.machine.add_word(piece, (len(piece), where))
        if places:
            self.machine.make_automaton()

    @staticmethod
    def _occurs(text: str, item_at: int, part: tuple) -> bool:
        """Whether a part of an item occurs near where it would be, with its share of edits."""
        offset, m, errors, masks = part
        start = item_at + offset - errors
        return distance(masks, m, text[max(0, start):start + m + 2 * errors])[0] <= errors

    def hits(self, text: str | None) -> list[dict]:
        if not self.items or not (text := normal(text)):
            return []
        windows: dict[int, list[list[int]]] = {}
        for last, (size, where) in self.machine.iter(text):
            for item, at, around in where:
                _, m, errors, _ = self.items[item]
                start = last + 1 - size - at - errors
                end = start + m + 2 * errors
                mine = windows.get(item)
                if mine and mine[-1][0] <= start and end <= mine[-1][1]:
                    continue
                if not all(self._occurs(text, last + 1 - size - at, part) for part in around):
                    continue
                mine = windows.setdefault(item, [])
                if mine and start <= mine[-1][1] and end >= mine[-1][0]:
                    mine[-1] = [min(start, mine[-1][0]), max(end, mine[-1][1])]
                else:
                    mine.append([start, end])
        out = []
        for item in sorted(windows):
            item_id, m, errors, masks = self.items[item]
            best = None
            for start, end in windows[item]:
                start = max(0, start)
                n, at = distance(masks, m, text[start:end])
                if n <= errors and (best is None or (n, start + at) < best):
                    best = (n, start + at)
            if best:
                out.append({"item_id": item_id, "n_errors": best[0], "end": best[1]})
        return out


def _blocks(items: DataFrame, id_col: str, text_col: str) -> list[DataFrame]:
    """The items in blocks of bounded size; one block if they are few."""
    rows = items.select(F.col(id_col).cast("bigint").alias("item_id"), F.col(text_col).alias("text"))
    size = rows.agg(F.sum(F.length("text")).alias("n")).first().n or 0
    n = -(-size // BLOCK_CHARS) or 1
    return [rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) for k in range(n)]


def _held(block: DataFrame):
    """The items of one block, for the tasks."""
    rows = ((r.item_id, r.text) for r in block.collect())
    return block.sparkSession.sparkContext.broadcast(
        sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")))


def hits(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, n_errors, end``: the items that texts hold, with the fewest edits
    and the end of that occurrence in the text as compared."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    found = None
    for block in _blocks(items, item_id_col, item_text_col):
        one = map_rows(rows, _finding(_held(block)), "doc_id bigint, item_id string, n_errors int, end int")
        found = one if found is None else found.unionByName(one)
    return found.withColumn("item_id", F.col("item_id").cast("bigint"))


def _finding(held):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        finder = Finder(held.value)
        for frame in frames:
            rows = [(i, None if h["item_id"] is None else str(h["item_id"]), h["n_errors"], h["end"])
                    for i, text in zip(frame["doc_id"], frame["text"]) for h in finder.hits(text)]
            if rows:
                yield pd.DataFrame(rows, columns=["doc_id", "item_id", "n_errors", "end"])
    return run


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
          item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text holds no item, whole."""
    short_batches(docs.sparkSession)
    for block in _blocks(items, item_id_col, item_text_col):
        docs = docs.where(_is_clean(_held(block))(docs[text_col]))
    return docs


def _is_clean(held):
    @F.pandas_udf("boolean")
    def check(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        finder = Finder(held.value)
        for texts in batches:
            yield pd.Series([not finder.hits(t) for t in texts], dtype=bool)
    return check
