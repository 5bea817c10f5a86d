"""Byte-level BPE encoding and decoding.

Method: ranked merges are folded over the byte arrays of distinct words, with the rank map
as a constant that every task holds; decoding concatenates the binary pieces of the ids.
One narrow stage without a shuffle: a task cuts its texts into pre-tokens, folds the merges
once for each distinct word it meets, and joins the ids of the words text by text.

The fold is a Python function inside the tasks. The same fold as Spark higher-order
functions over a literal map gave the same ids but took 177 microseconds a word (README).

A task keeps the ids of at most two generations of ``WORDS_KEPT`` distinct words, which bounds
its memory and changes no result; nothing stays in the Python worker after it. The rank map
(some 50,000 pieces, a fixed vocabulary that does not grow with the data) is broadcast.

Nulls, ties and odd rows: a null text is the empty text, which has no tokens and decodes
to the empty string; a null id stays null; every input row gives one output row, repeated
rows included; other columns of the input are ignored. Ranks are unique, and of equal pairs
the leftmost merges first. A word of any length is merged whole, in n log n steps.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkgate.llm.common import id_text, map_rows, slices

#: Distinct words in a generation of the words of which a task keeps the ids.
WORDS_KEPT = 100_000
#: Up to so many bytes, looking through all pairs in each step beats a heap.
SHORT_WORD = 48


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file with lines of base64 piece and rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a word: fold the leftmost pair of the lowest rank until no pair has a rank."""
    if (whole := ranks.get(word)) is not None:
        return [whole]
    if len(word) > SHORT_WORD:
        return _merge_long(word, ranks)
    cuts = list(range(len(word) + 1))   # piece i is word[cuts[i]:cuts[i + 1]]
    none = len(ranks)
    of = [ranks.get(word[i:i + 2], none) for i in range(len(word) - 1)]
    while of and (low := min(of)) < none:
        i = of.index(low)
        del cuts[i + 1], of[i]
        if i:
            of[i - 1] = ranks.get(word[cuts[i - 1]:cuts[i + 1]], none)
        if i < len(of):
            of[i] = ranks.get(word[cuts[i]:cuts[i + 2]], none)
    return [ranks[word[a:b]] for a, b in zip(cuts, cuts[1:])]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges with a heap of pairs and a linked list of pieces."""
    n = len(word)
    end, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    live = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1)
            if (r := ranks.get(word[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = after[i]
        if not live[i] or j >= n or end[j] != stop:
            continue   # one of the pieces has been joined to another since
        live[j], end[i], after[i] = False, stop, after[j]
        if after[i] < n:
            before[after[i]] = i
            k = end[after[i]]
            if (r := ranks.get(word[i:k])) is not None:
                heapq.heappush(heap, (r, i, k))
        if before[i] >= 0 and (r := ranks.get(word[before[i]:stop])) is not None:
            heapq.heappush(heap, (r, before[i], stop))
    return [ranks[word[i:end[i]]] for i in range(n) if live[i]]


class _Ids(dict):
    """Ids of words as little-endian unsigned 32-bit integers, made when first asked for.

    When full, the words become the old generation, from which those in use come back.
    """

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks, self.old = ranks, {}

    def __missing__(self, word: str) -> bytes:
        if (ids := self.old.get(word)) is None:
            ids = np.array(merge(word.encode(), self.ranks), "<u4").tobytes()
        if len(self) >= WORDS_KEPT:
            self.old = dict(self)
            self.clear()
        self[word] = ids
        return ids


def _encoder(held, pattern: str) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import regex
        words_of = regex.compile(pattern).findall
        ids_of = _Ids(held.value).__getitem__
        for frame in slices(frames, "text"):
            out = [b"".join(map(ids_of, words_of(text))) for text in frame["text"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"].to_numpy(), "n_tokens": [len(x) // 4 for x in out],
                                "ids": out})
    return run


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids``: the token ids of every whole text.

    ``ids`` is binary, a little-endian unsigned 32-bit integer for each token.
    """
    held = docs.sparkSession.sparkContext.broadcast(ranks)
    return map_rows(id_text(docs, id_col, text_col),
                    _encoder(held, pattern),
                    "doc_id bigint, n_tokens bigint, ids binary")


def decode(coded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded``: the pieces of the ids, concatenated."""
    pieces_of = coded.sparkSession.sparkContext.broadcast({r: p for p, r in ranks.items()})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        piece = pieces_of.value.__getitem__
        for frame in slices(frames, "ids"):
            yield frame.assign(decoded=[
                b"".join(map(piece, np.frombuffer(x, "<u4").tolist())) for x in frame["ids"]])
    return map_rows(coded, run, "doc_id bigint, n_tokens bigint, ids binary, decoded binary")


def digests(decoded: DataFrame) -> DataFrame:
    """The contract's columns: counts and SHA-256 digests of ids and decoded bytes."""
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))
