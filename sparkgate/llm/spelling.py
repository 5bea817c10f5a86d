"""Spelling variants: words one edit apart, and the common word that a rare one stands for.

Two words are near if one inserted, deleted or replaced code point makes them equal: exactly
then their common prefix and common suffix reach the length of the longer one, less one. The
words are compared in dense blocks: padded matrices of code points, read from the left and from
the right, whose rows are compared pair by pair. Which rows share a block is decided by windows:
an edit lies in one window of two code points, so two near words agree before and after it. Each
word goes to the blocks of its windows, once as the shorter (or equal) word of a pair and once
as the longer, under a hash of what surrounds the window. A pair counts only in the window of
its first difference, and only by the exact comparison, so hashes can add work but no pairs.

A block's words differ within one window only: of words up to ``2 * MOST_WINDOWS`` letters a
block holds at most 90**2 + 90**3 (the letters are 90), however many words there are. Longer
words have windows of a ``MOST_WINDOWS``-th of their length, so that a word of any length is
sent at most ``2 * MOST_WINDOWS`` times. What leaves a block is one row per word, with its
number of near words and the best of them; the words' own rows and these are added up by word.

Nulls, ties and odd rows: a null text has no words; a null id is written as the empty string
before the colon; repeated rows count as often as they occur. A word's form is the near word of
largest count, the first in code-point order among equals. Other columns are ignored; an empty
table gives no rows. Counts fall at least tenfold along a chain of forms, so roots are found in
a number of pointer-doubling rounds fixed by the largest count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkgate.llm.common import slices
from sparkgate.session import materialize

#: Letters of a run, and the least number of code points and occurrences of a word.
LETTERS = r"[A-Za-zÀ-ÿ]"
LEAST_LETTERS, LEAST_COUNT = 7, 2
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: One run in so many loses a letter, by a hash of its document and itself.
ERROR_ONE_IN = 31
#: A form is at least so many times as frequent as the word.
FORM_TIMES = 10
#: Most windows of a word; windows are two code points wide up to twice as many letters.
MOST_WINDOWS = 32
#: Code points compared at a time, rows of the blocks taken together, letters of a slice of words.
BLOCK_CELLS, ROWS, SLICE_LETTERS = 4_000_000, 40_000, 200_000

BLOCKS = "block bigint, slot int, word string, n bigint"
NEAR = "word string, n bigint, n_near bigint, near string, near_n bigint"


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                errors: int | None = ERROR_ONE_IN) -> DataFrame:
    """``word, n``: the words of all texts, of at least 7 code points and 2 occurrences.

    ``errors`` plants a deletion in one run of so many, chosen by a hash (None: no errors).
    """
    # runs of fewer letters have no word, so the pattern asks for 7 at once
    runs = docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.col(f"`{text_col}`"), F.lit(f"{LETTERS}{{{LEAST_LETTERS},}}+"), F.lit(0))).alias("run"))
    run = F.col("run")
    words = runs.select("id", F.when(run.rlike("[A-Z]"), F.translate(run, UPPER, LOWER)).otherwise(run).alias("run"))
    if errors is not None:
        at = F.pmod("h", F.length("run")).cast("int")
        words = words.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))).select(
            F.when(F.col("h") % errors == 0, F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))).otherwise(
                run).alias("run"))
    return words.where(F.length("run") >= LEAST_LETTERS).groupBy(F.col("run").alias("word")).agg(
        F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT)


def windows(m: int) -> tuple[int, int]:
    """Width and number of the windows of a pair whose shorter word has ``m`` code points."""
    width = max(2, -(-m // MOST_WINDOWS))
    return width, -(-m // width)


def _codes(words: list[str]) -> np.ndarray:
    """Words of one length as the rows of a matrix of code points."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _starts(codes: np.ndarray, base: int) -> np.ndarray:
    """Hashes of the first 0, 1, ... code points of each row."""
    powers = np.multiply.accumulate(np.full(codes.shape[1], base, np.uint64))
    out = np.zeros((codes.shape[0], codes.shape[1] + 1), np.uint64)
    np.cumsum(codes.astype(np.uint64) * powers, axis=1, out=out[:, 1:])
    return out


def _deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each word with the blocks it belongs to."""
    for frame in slices(frames, "word", SLICE_LETTERS):
        for letters, same in frame.groupby(frame["word"].str.len()):
            codes = _codes(same["word"].to_list())
            before, after = _starts(codes, 0x9E3779B97F4A7C15), _starts(codes[:, ::-1], 0xD6E8FEB86659FD93)
            blocks, slots = [], []
            for m in (letters, letters - 1):     # as the shorter or equal word, as the longer one
                width, n = windows(m)
                i = np.arange(n)
                blocks.append(_mixed(_mixed(before[:, width * i]) + after[:, np.maximum(0, m - width * (i + 1))]))
                slots.append(m * MOST_WINDOWS + i)
            block, slot = np.concatenate(blocks, axis=1), np.concatenate(slots)
            yield pd.DataFrame({
                "block": block.ravel().view(np.int64), "slot": np.tile(slot, len(same)).astype(np.int32),
                "word": np.repeat(same["word"].to_numpy(), len(slot)), "n": np.repeat(same["n"].to_numpy(), len(slot))})


def _pairs(ends: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows of one block each, about ``most`` at a time; row i's block ends before
    row ``ends[i]``."""
    partners = ends - np.arange(len(ends)) - 1
    upto = np.concatenate([[0], partners.cumsum()])
    a = 0
    while a < len(ends):
        b = max(a + 1, int(np.searchsorted(upto, upto[a] + most, "right")) - 1)
        left = np.repeat(np.arange(a, b), partners[a:b])
        yield left, left + 1 + np.arange(len(left)) - np.repeat(upto[a:b] - upto[a], partners[a:b])
        a = b


def _near_in_blocks(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Near words within whole blocks, whose rows follow each other."""
    new = np.flatnonzero((np.diff(rows["block"]) != 0) | (np.diff(rows["slot"]) != 0)) + 1
    size = np.diff(np.concatenate([[0], new, [len(rows)]]))
    block, size = np.repeat(np.arange(len(size)), size), np.repeat(size, size)
    rows, block, size = rows[size > 1], block[size > 1], size[size > 1]
    shorter = rows["slot"].to_numpy() // MOST_WINDOWS
    for m in np.unique(shorter):
        part = rows[shorter == m]
        # the row after each row's block
        heads = np.unique(block[shorter == m], return_index=True)[1]
        ends = np.repeat(np.append(heads[1:], len(part)), size[shorter == m][heads])
        words, n = part["word"].to_numpy(), part["n"].to_numpy()
        window = part["slot"].to_numpy() % MOST_WINDOWS
        width, windows_of = windows(int(m))
        long = part["word"].str.len().to_numpy() > m
        # padded with zeros on the far side, so that a longer word differs there
        ahead, back = np.zeros((2, len(part), m + 1), np.uint32)
        for of, letters in ((~long, m), (long, m + 1)):
            if of.any():
                codes = _codes(words[of].tolist())
                ahead[of, :letters], back[of, :letters] = codes, codes[:, ::-1]
        for left, right in _pairs(ends, max(1, BLOCK_CELLS // (int(m) + 1))):
            prefix = (ahead[left] == ahead[right]).argmin(axis=1)
            suffix = (back[left] == back[right]).argmin(axis=1)
            longer = long[left] | long[right]
            near = (prefix + suffix >= m + longer - 1) & ~(long[left] & long[right])
            near &= window[left] == np.minimum(prefix // width, windows_of - 1)
            if near.any():
                yield _best(words, n, left[near], right[near])


def _best(words: np.ndarray, n: np.ndarray, left: np.ndarray, right: np.ndarray) -> pd.DataFrame:
    """Of each word in the pairs: its number of near words, and the best of them."""
    row, other = np.concatenate([left, right]), np.concatenate([right, left])
    _, rank = np.unique(words[other], return_inverse=True)
    order = np.lexsort((rank, -n[other], row))
    row, other = row[order], other[order]
    first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    return pd.DataFrame({"word": words[row[first]], "n": n[row[first]],
                         "n_near": np.diff(np.concatenate([first, [len(row)]])),
                         "near": words[other[first]], "near_n": n[other[first]]})


def _near(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Near words of a task, whose rows come sorted by window, then block: whole blocks at a
    time, as many as have about ``ROWS`` rows."""
    held: list[pd.DataFrame] = []
    n = 0
    for frame in frames:
        block, slot = frame["block"].to_numpy(), frame["slot"].to_numpy()
        inner = np.flatnonzero((block[:-1] != block[1:]) | (slot[:-1] != slot[1:]))
        n += len(frame)
        if len(inner) and n >= ROWS:
            last = inner[-1] + 1
            yield from _near_in_blocks(pd.concat([*held, frame.iloc[:last]]))
            held, frame = [], frame.iloc[last:]
            n = len(frame)
        if len(frame):
            held.append(frame)
    if held:
        yield from _near_in_blocks(pd.concat(held))


def near_words(words: DataFrame) -> DataFrame:
    """``word, n, n_near, near, near_n``: every word with its near words' number and best."""
    dealt = words.select("word", "n").mapInPandas(_deal, BLOCKS)
    found = dealt.repartition("block").sortWithinPartitions("slot", "block").mapInPandas(_near, NEAR)
    alone = words.select("word", "n", F.lit(0).cast("bigint").alias("n_near"), F.lit(None).cast("string").alias("near"),
                         F.lit(None).cast("bigint").alias("near_n"))
    best = F.struct((-F.col("near_n")).alias("less"), "near")
    return found.unionByName(alone).groupBy("word").agg(
        F.max("n").alias("n"), F.sum("n_near").alias("n_near"),
        F.min(F.when(F.col("near").isNotNull(), best)).alias("best")).select(
        "word", "n", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))


def _roots(forms: DataFrame, chain: int) -> DataFrame:
    """``word, root``: the ends of chains of at most ``chain`` forms, by pointer doubling."""
    at = materialize(forms, "spelling-forms")
    reach = 1
    while reach < chain:
        ends = at.select(F.col("word").alias("root"), F.col("root").alias("end"))
        at = materialize(at.join(ends, "root", "left").select("word", F.coalesce("end", "root").alias("root")),
                         "spelling-roots")
        reach *= 2
    return at


def group_variants(words: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of a table ``word, n``."""
    # an integer quotient, since ten times a count may pass a long
    near = near_words(materialize(words, "spelling-words"))
    is_form = F.expr(f"near_n div {FORM_TIMES}") >= F.col("n")
    known = materialize(near.select(
        "word", F.when(is_form, F.col("near")).alias("form"), "n", "n_near",
        F.when(is_form, F.col("near_n")).alias("form_n")), "spelling-near")
    most = known.agg(F.max("n")).first()[0] or 0
    chain = len(str(most)) - 1        # tenfold a step
    roots = _roots(known.where("form IS NOT NULL").select("word", F.col("form").alias("root")), chain)
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
