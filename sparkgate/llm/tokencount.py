"""Unigram token counts by dynamic programming that words with a common prefix share.

Method: the distinct pre-tokens of a task's texts are inserted in a trie; the forward
(Viterbi) scores of a unigram model are computed once for each trie node, so a shared prefix
is scored once, and the terminal nodes store the token counts. A text's count is the sum over
its pre-tokens. The walk goes through the words in byte order, in which the path of the trie
to a word is the stack of scores of the word before it, cut to their common prefix.

The model: pieces are those of a ranked vocabulary. A piece's cost is fixed by its rank
(Zipf's law: log2(rank + 2), in thousandths, rounded), a stated formula that nothing trains.
The best segmentation of a word has the lowest cost and, among those, the fewest tokens.
Every single byte is a piece, so every text has a segmentation.

A worker keeps the counts of at most two generations of ``WORDS_KEPT`` words; the vocabulary
is fixed and does not grow with the data, so it is broadcast. There is no shuffle.

Nulls, ties and odd rows: a null text is empty and has no tokens; a null id stays null; every
input row gives one output row, repeated rows included; other columns are ignored; words of
any length are scored whole, in time proportional to their length.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from sparkgate.llm.common import id_text, map_rows, slices

WORDS_KEPT = 200_000
#: Texts whose words are inserted in one trie.
BATCH_CHARS = 4_000_000


def costs(ranks: dict[bytes, int]) -> dict[bytes, int]:
    """Unigram costs of the pieces of a ranked vocabulary."""
    return {p: round(1000 * math.log2(r + 2)) for p, r in ranks.items()}


def endings(cost: dict[bytes, int]) -> set[bytes]:
    """All endings of pieces: the search back from a byte stops where no piece ends so."""
    return {p[i:] for p in cost for i in range(len(p))}


class Forward:
    """Forward scores along one path of the trie of words."""

    def __init__(self, cost: dict[bytes, int]):
        self.cost = cost
        self.endings = endings(cost)
        self.word = b""
        self.score, self.tokens = [0], [0]

    def count(self, word: bytes) -> int:
        """Tokens of ``word``; scores of the prefix shared with the last word are reused."""
        last, n = self.word, len(word)
        shared = 0
        most = min(n, len(last))
        if last[:most] == word[:most]:
            shared = most
        else:
            while last[shared] == word[shared]:
                shared += 1
        score, tokens = self.score, self.tokens
        del score[shared + 1:], tokens[shared + 1:]
        cost, ends = self.cost, self.endings
        for end in range(shared + 1, n + 1):
            best = few = None
            start = end - 1
            while start >= 0 and (piece := word[start:end]) in ends:
                if (c := cost.get(piece)) is not None:
                    c += score[start]
                    if best is None or c < best or (c == best and tokens[start] + 1 < few):
                        best, few = c, tokens[start] + 1
                start -= 1
            score.append(best)
            tokens.append(few)
        self.word = word
        return tokens[n]


def count_words(words: Iterable[str], forward: Forward) -> dict[str, int]:
    """Token counts of distinct words, in the order of the trie's walk."""
    return {w.decode(): forward.count(w) for w in sorted(w.encode() for w in words)}


#: Scores and counts that a Python worker has for a vocabulary; the tasks it runs share them.
_KEPT: dict[int, tuple[Forward, dict[str, int], dict[str, int]]] = {}


def _counter(held, key: int, pattern: str) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import regex
        from sparkgate.llm import tokencount
        words_of = regex.compile(pattern).findall
        if key not in tokencount._KEPT:
            tokencount._KEPT.clear()
            tokencount._KEPT[key] = (tokencount.Forward(held.value), {}, {})
        forward, known, old = tokencount._KEPT[key]
        for frame in slices(frames, "text", tokencount.BATCH_CHARS):
            found = [words_of(t) for t in frame["text"]]
            words = set().union(*found)
            if len(known) + len(words) > tokencount.WORDS_KEPT:
                known, old = {}, known
            new = words.difference(known)
            known |= {w: old[w] for w in new if w in old}
            known |= count_words([w for w in new if w not in old], forward)
            tokencount._KEPT[key] = (forward, known, old)
            yield pd.DataFrame({
                "doc_id": frame["doc_id"].to_numpy(),
                "n_pretokens": np.array([len(f) for f in found], np.int64),
                "n_tokens": np.array([sum(map(known.__getitem__, f)) for f in found], np.int64)})
    return run


def count_tokens(docs: DataFrame, cost: dict[bytes, int], pattern: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, n_pretokens, n_tokens``: counts of pre-tokens and of unigram tokens."""
    held = docs.sparkSession.sparkContext.broadcast(cost)
    return map_rows(
        id_text(docs, id_col, text_col), _counter(held, hash(frozenset(cost.items())), pattern),
        "doc_id bigint, n_pretokens bigint, n_tokens bigint")
