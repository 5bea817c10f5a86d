"""Removal of repeated byte strings by a distributed suffix merge sort.

A byte goes if a string of ``LENGTH`` (100) bytes that covers it also starts earlier: in a row
of smaller id, or earlier in the same row. Strings are judged on the input, and overlaps count.

Method: common-prefix-aware distributed merge sort. Tasks sort the suffixes of their texts and
send them as front-coded runs (length of the prefix shared with the suffix before, then the
rest); receivers combine the runs with a loser tree that carries common-prefix lengths and so
never compares a known prefix again. The merged order comes with the common prefixes of
neighbours, from which equal strings are read off. Two things keep the exchange small:

* Only suffixes at anchors are sorted. An anchor is the place of the smallest hash of ``K``
  bytes within some string of ``LENGTH`` bytes; it depends on the string alone, so equal
  strings have anchors at the same place. A suffix travels with the bytes before it. Equal
  strings then are suffixes with equal bytes after and before the anchor: for each distance d
  from the start of the string to the anchor, the common prefixes of the merged order give the
  classes of ``LENGTH - d`` bytes after, refined by the d bytes before.
* Only anchors whose ``K`` bytes occur elsewhere are sent at all; a first exchange of hashes
  finds them. It may name too many (equal hashes), never too few: the result is exact.

What is sent is compressed by column in the tasks.

Scale: a task sends each hash once, and of suffixes with equal bytes all around only the
earliest (the others repeat it and are settled on the spot). So a text in a third of all rows
is sent at most once by each task. Should the suffixes of one ``K``-byte string with different
surroundings still exceed ``HOT``, they are dealt out by whole strings instead, each sent once
by a task. The numbers of buckets follow the input. Receivers get buckets by hash, which
spreads evenly and needs no sample for splitters. The tables of candidates and spans are
broadcast only below ``BROADCAST_BYTES`` (measured) and joined by shuffle beyond.

Nulls, ties and odd rows: a null text is empty; a null id comes before all others; of rows
with the same id, the one whose text has the smaller digest counts as earlier, and of wholly
equal rows one does; texts shorter than ``LENGTH`` bytes lose nothing; every input row gives
one output row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkgate.llm.common import short_batches
from sparkgate.session import materialize

LENGTH = 100
#: Bytes of an anchor; a string of LENGTH bytes has PLACES places for it.
K = 48
PLACES = LENGTH - K + 1
BEFORE = PLACES - 1
#: Occurrences of an anchor's bytes from which its strings are dealt out one by one.
HOT = 100_000
#: Bytes of text for each bucket of hashes, and candidates for each bucket of suffixes.
HASH_BUCKET_BYTES = 16_000_000
SUFFIX_BUCKET = 60_000
#: Suffixes in a run; a task with more makes several runs.
RUN = 200_000
#: Text of which anchors are found at once (places fit in 24 bits).
PART = 1 << 23
BROADCAST_BYTES = 8_000_000

#: Stands for a null id.
NO_ID = -(1 << 63)

_LOW = np.uint64(0xFFFFFF)
_BYTES = np.random.default_rng(2024).integers(0, 2**64, 256, dtype=np.uint64)
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F,
                               0x165667B19E3779F9, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashes(text: bytes, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes that start at each place, by doubling."""
    power, done, out, turn = _BYTES[np.frombuffer(text, np.uint8)], 0, None, 0
    width = 1
    while True:   # ``power`` covers ``width`` bytes, ``out`` the first ``done``
        if size & width:
            n = len(text) - done - width + 1
            out = power[:n] if out is None else out[:n] * _ODD[5] + power[done:done + n]
            done += width
        if done == size:
            return _mix(out)
        n = len(power) - width
        power = power[:n] * _ODD[turn % 5] + power[width:]
        width, turn = 2 * width, turn + 1


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors of a text, and the hashes of the bytes there."""
    if len(text) < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    places, found = [], []
    for start in range(0, len(text) - LENGTH + 1, PART):
        part = text[start:start + PART + LENGTH - 1]
        h = hashes(part, K)
        low = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64)   # of equal hashes the first
        width = 1
        while 2 * width <= PLACES:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < PLACES:
            low = np.minimum(low[:width - PLACES], low[PLACES - width:])
        at = (low & _LOW).astype(np.int64)
        at = at[np.flatnonzero(np.diff(at, prepend=-1))]
        places.append(at + start)
        found.append(h[at])
    at, h = np.concatenate(places), np.concatenate(found)
    _, first = np.unique(at, return_index=True)
    return at[first], h[first]


def _packed(values: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(values).tobytes(), 1)


def _unpacked(column: pd.Series, kind) -> list[np.ndarray]:
    return [np.frombuffer(zstandard.decompress(x), kind) if x else np.zeros(0, kind) for x in column]


# --- first exchange: which anchors occur elsewhere -------------------------------------------

HASHES = "bucket int, known boolean, hash binary, n binary, id binary, copy binary, place binary"
#: Bytes of a hash that are sent; the bucket tells more of it.
SENT = 6


def _hash_rows(n_buckets: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """One row of hashes for each bucket, and one of places known to repeat."""
        all_h, all_at, ids, copies, sizes = [], [], [], [], []
        for frame in frames:
            for i, c, text in zip(frame["id"], frame["copy"], frame["text"]):
                at, h = anchors(text)
                all_h.append(h)
                all_at.append(at)
                ids.append(i)
                copies.append(c)
                sizes.append(len(at))
        if not sum(sizes):
            return
        h, at = np.concatenate(all_h), np.concatenate(all_at).astype(np.uint32)
        id_, copy = np.repeat(np.array(ids, np.int64), sizes), np.repeat(np.array(copies, np.int32), sizes)
        _, first, of, n = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
        again = n[of] > 1          # twice in this task: known to repeat
        sent = np.zeros(len(h), bool)
        sent[first] = True
        bucket = (h % np.uint64(n_buckets)).astype(np.int64)
        for known, which in ((False, sent), (True, again)):
            rows = np.flatnonzero(which)
            rows = rows[np.argsort(bucket[rows], kind="stable")]
            cut = np.flatnonzero(np.diff(bucket[rows])) + 1
            for part in np.split(rows, cut):
                if len(part):
                    yield pd.DataFrame({
                        "bucket": [int(bucket[part[0]])], "known": [known],
                        "hash": [(h[part] // np.uint64(n_buckets)).view(np.uint8).reshape(-1, 8)[:, :SENT].tobytes()],
                        "n": [_packed(n[of[part]].astype(np.uint32))],
                        "id": [_packed(np.diff(id_[part], prepend=0))], "copy": [_packed(copy[part])],
                        "place": [_packed(np.diff(at[part].astype(np.int64), prepend=0))]})
    return run


def _candidates(rows: pd.DataFrame, limit: int) -> pd.DataFrame:
    """The places of a bucket whose hash occurs elsewhere, one in a row; hot ones are odd."""
    first, known = rows[~rows["known"]], rows[rows["known"]]

    def hashes_of(some: pd.DataFrame) -> np.ndarray:
        short = np.frombuffer(b"".join(some["hash"]), np.uint8).reshape(-1, SENT)
        out = np.zeros((len(short), 8), np.uint8)
        out[:, :SENT] = short
        return out.view(np.uint64).ravel()

    def joined(some: pd.DataFrame, name: str, kind, step: bool = False) -> np.ndarray:
        parts = _unpacked(some[name], kind)
        return np.concatenate([np.zeros(0, kind), *((np.cumsum(p) for p in parts) if step else parts)])
    n = joined(first, "n", np.uint32)
    distinct, of = np.unique(hashes_of(first), return_inverse=True)
    tasks = np.bincount(of, minlength=len(distinct))
    total = np.bincount(of, weights=n, minlength=len(distinct))
    mine = (tasks[of] > 1) & (n == 1)           # those with n > 1 come as known
    here = np.searchsorted(distinct, hashes_of(known))
    hot = np.concatenate([total[of[mine]] > limit, total[here] > limit])
    pick = lambda name, kind, step: np.concatenate([
        joined(first, name, kind, step)[mine], joined(known, name, kind, step)])
    return pd.DataFrame({"id": pick("id", np.int64, True), "copy": pick("copy", np.int32, False),
                         "place": pick("place", np.int64, True) * 2 + hot})


# --- second exchange: front-coded runs of suffixes -------------------------------------------

RUNS = ("bucket int, lcp binary, tails binary, before binary, n_before binary, n_after binary, "
        "id binary, copy binary, place binary, spans binary")
#: A span as one number: its start, then its length, which is below 256.
SPAN = 256


def front_coded(rows: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Sorted rows of bytes as shared-prefix lengths and the remaining bytes."""
    differ = rows[1:] != rows[:-1]
    lcp = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1]) if len(rows) > 1 else np.zeros(0, int)
    lcp = np.concatenate([[0], lcp]).astype(np.uint8)
    return lcp, rows[np.arange(rows.shape[1]) >= lcp[:, None]].tobytes()


def decoded(lcp: np.ndarray, tails: bytes) -> list[bytes]:
    out, at, last = [], 0, b""
    for n in lcp.tolist():
        end = at + LENGTH - n
        last = last[:n] + tails[at:end]
        out.append(last)
        at = end
    return out


def _covered(place: np.ndarray, n_before: np.ndarray, n_after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All strings through an anchor: whether there are any, and the bytes they cover."""
    least = np.maximum(0, LENGTH - n_after)
    return least <= n_before, np.stack([place - n_before, place - least + LENGTH], 1)


def _coded(spans: np.ndarray) -> np.ndarray:
    return spans[:, 0] * SPAN + spans[:, 1] - spans[:, 0]


def _run_rows(n_buckets: int):
    def one_run(mats: list[np.ndarray], meta: list[tuple], windows: bool) -> Iterator[dict]:
        mat = np.concatenate(mats)
        id_, copy, place, n_before, n_after = (np.concatenate(x) for x in zip(*meta))
        order = np.lexsort((place, copy, id_))
        # bytes after the anchor, then those before from near to far
        turned = np.concatenate([mat[:, BEFORE:], mat[:, :BEFORE][:, ::-1]], 1)[order]
        id_, copy, place, n_before, n_after = (x[order] for x in (id_, copy, place, n_before, n_after))
        order = np.argsort(np.ascontiguousarray(turned).view(f"S{LENGTH + BEFORE}").ravel(), kind="stable")
        turned = turned[order]
        id_, copy, place, n_before, n_after = (x[order] for x in (id_, copy, place, n_before, n_after))
        same = np.concatenate([[False], (turned[1:] == turned[:-1]).all(axis=1)
                               & (n_before[1:] == n_before[:-1]) & (n_after[1:] == n_after[:-1])])
        any_, cover = _covered(place, n_before, n_after)
        settled = same & any_
        spans = np.stack([id_[settled], copy[settled].astype(np.int64), _coded(cover[settled])], 1)
        keep = np.flatnonzero(~same & any_)
        turned, id_, copy, place, n_before, n_after = (x[keep] for x in (turned, id_, copy, place, n_before, n_after))
        size = LENGTH if windows else K
        h = np.zeros(len(keep), np.uint64)
        for i in range(size):
            h = h * _ODD[0] + _BYTES[turned[:, i]]
        bucket = (_mix(h) % np.uint64(n_buckets)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        for part in np.split(by, np.flatnonzero(np.diff(bucket[by])) + 1):
            if len(part):
                lcp, tails = front_coded(turned[part, :LENGTH])
                yield {"bucket": int(bucket[part[0]]) + (n_buckets if windows else 0), "lcp": _packed(lcp),
                       "tails": zstandard.compress(tails, 1), "before": _packed(turned[part, LENGTH:]),
                       "n_before": _packed(n_before[part].astype(np.uint8)),
                       "n_after": _packed(n_after[part].astype(np.uint8)), "id": _packed(id_[part]),
                       "copy": _packed(copy[part]), "place": _packed(place[part]), "spans": b""}
        if len(spans):
            yield {"bucket": int(spans[0, 0] % n_buckets), "spans": _packed(spans)} | {
                k: b"" for k in ("lcp", "tails", "before", "n_before", "n_after", "id", "copy", "place")}

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kinds: dict[bool, tuple[list, list]] = {False: ([], []), True: ([], [])}
        size = {False: 0, True: 0}

        def add(windows: bool, i: int, c: int, text: bytes, at: np.ndarray) -> Iterator[pd.DataFrame]:
            for lo in range(0, len(at), RUN):
                some = at[lo:lo + RUN]
                mats, meta = kinds[windows]
                padded = np.frombuffer(b"\0" * BEFORE + text + b"\0" * LENGTH, np.uint8)
                mats.append(np.lib.stride_tricks.sliding_window_view(padded, BEFORE + LENGTH)[some])
                before = np.zeros(len(some), np.int64) if windows else np.minimum(some, BEFORE)
                if windows:
                    mats[-1][:, :BEFORE] = 0
                meta.append((np.full(len(some), i, np.int64), np.full(len(some), c, np.int32), some, before,
                             np.minimum(len(text) - some, LENGTH)))
                size[windows] += len(some)
                if size[windows] >= RUN:
                    yield from flush(windows)

        def flush(windows: bool) -> Iterator[pd.DataFrame]:
            mats, meta = kinds[windows]
            for row in one_run(mats, meta, windows) if mats else ():
                yield pd.DataFrame({k: [v] for k, v in row.items()})
            kinds[windows], size[windows] = ([], []), 0
        for frame in frames:
            for i, c, text, places in zip(frame["id"], frame["copy"], frame["text"], frame["places"]):
                value = np.unique(np.asarray(places, np.int64))
                at, hot = value >> 1, (value & 1).astype(bool)
                yield from add(False, i, c, text, at[~hot])
                if hot.any():   # every string through a hot anchor, as a suffix of its own
                    starts = np.unique((at[hot][:, None] - np.arange(PLACES)).ravel())
                    yield from add(True, i, c, text, starts[(starts >= 0) & (starts <= len(text) - LENGTH)])
        for windows in (False, True):
            yield from flush(windows)
    return run


def shared(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes are known to be equal."""
    x, y = a[known:], b[known:]
    if x == y:
        return len(a)
    differ = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
    return len(a) - (differ.bit_length() + 7) // 8


def merge(runs: list[tuple[np.ndarray, list[bytes]]]) -> tuple[list[int], list[int]]:
    """The runs, given as shared-prefix lengths and suffixes, merged by a loser tree.

    Returns the runs in the order in which their heads come out, and the common prefix of each
    with the one before. A node keeps the run that lost there with the common prefix of its
    head and the winner it lost to. Of two heads, that with the longer common prefix with the
    last suffix out is smaller, without looking at a byte; only if they are equally long are
    bytes compared, from there on.
    """
    n = 1
    while n < len(runs):
        n *= 2
    heads = [suffixes[0] if suffixes else None for _, suffixes in runs] + [None] * (n - len(runs))
    lengths = [lcp.tolist() for lcp, _ in runs]
    at = [0] * n
    common = [0] * n           # of a run's head with the last suffix that came out above it
    loser = [0] * n

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser of two runs."""
        if heads[a] is None or heads[b] is None:
            return (b, a) if heads[a] is None else (a, b)
        if common[a] != common[b]:
            return (a, b) if common[a] > common[b] else (b, a)
        h = shared(heads[a], heads[b], common[a])
        if h < LENGTH and heads[a][h] > heads[b][h] or h == LENGTH and a > b:
            a, b = b, a
        common[b] = h
        return a, b
    first = list(range(n))
    node = n // 2
    while node >= 1:           # the first tournament, level by level
        winners = []
        for i in range(node):
            w, loser[node + i] = play(first[2 * i], first[2 * i + 1])
            winners.append(w)
        first, node = winners, node // 2
    top = first[0]
    order, lcps = [], []
    while heads[top] is not None:
        order.append(top)
        lcps.append(common[top])
        at[top] += 1
        i = at[top]
        if i < len(runs[top][1]):
            heads[top], common[top] = runs[top][1][i], lengths[top][i]
        else:
            heads[top] = None
        node = (n + top) // 2
        while node >= 1:
            top, loser[node] = play(top, loser[node])
            node //= 2
    return order, lcps


def _repeats(rows: pd.DataFrame) -> pd.DataFrame:
    """The spans of a bucket's suffixes that repeat earlier strings."""
    out = [x.reshape(-1, 3) for x in _unpacked(rows["spans"], np.int64)]
    rows = rows[rows["lcp"].str.len() > 0]
    if len(rows):
        array = lambda name, kind: _unpacked(rows[name], kind)
        runs = [(lcp, decoded(lcp, zstandard.decompress(tails)))
                for lcp, tails in zip(array("lcp", np.uint8), rows["tails"])]
        turn, lcp = merge(runs)
        start = np.concatenate([[0], np.cumsum([len(s) for _, s in runs])[:-1]])
        turn = np.array(turn)
        # the i-th time that a run comes out, it is its i-th suffix
        nth = np.empty(len(turn), np.int64)
        nth[np.argsort(turn, kind="stable")] = np.concatenate([np.arange(len(s)) for _, s in runs])
        sorted_ = start[turn] + nth
        pick = lambda name, kind: np.concatenate(array(name, kind))[sorted_]
        id_, copy, place = pick("id", np.int64), pick("copy", np.int32), pick("place", np.int64)
        n_before, n_after = pick("n_before", np.uint8).astype(int), pick("n_after", np.uint8).astype(int)
        before = np.concatenate([x.reshape(-1, BEFORE) for x in array("before", np.uint8)])[sorted_]
        found, spans = equal_strings(np.array(lcp), before, n_before, n_after, id_, copy, place)
        out.append(np.stack([id_[found], copy[found].astype(np.int64), _coded(spans)], 1))
    every = np.concatenate(out)
    return pd.DataFrame({"id": every[:, 0], "copy": every[:, 1].astype(np.int32), "span": every[:, 2]})


def equal_strings(lcp: np.ndarray, before: np.ndarray, n_before: np.ndarray, n_after: np.ndarray, id_: np.ndarray,
                  copy: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which suffixes, in merged order, have a string through their anchor that an earlier
    suffix has too, and the bytes that these strings cover."""
    n = len(lcp)
    early = np.lexsort((place, copy, id_))     # from here on in the order of the input
    before, n_before, n_after = before[early], n_before[early], n_after[early]
    left = np.cumsum(lcp < K)[early]           # classes of the bytes before the anchor so far
    most, least = np.full(n, -1), np.full(n, LENGTH)
    for d in range(PLACES):
        if d:
            _, left = np.unique(left * 256 + before[:, d - 1], return_inverse=True)
        right = np.cumsum(lcp < LENGTH - d)[early]
        ok = np.flatnonzero((d <= n_before) & (LENGTH - d <= n_after))
        if not len(ok):
            continue
        _, first, of = np.unique(left[ok] * (n + 1) + right[ok], return_index=True, return_inverse=True)
        again = ok[first[of] != np.arange(len(ok))]
        most[again] = d
        least[again] = np.minimum(least[again], d)
    found = np.flatnonzero(most >= 0)
    spans = np.stack([place[early][found] - most[found], place[early][found] - least[found] + LENGTH], 1)
    return early[found], spans


# --- the whole --------------------------------------------------------------------------------

def _cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = []
        for text, parts in zip(frame["text"], frame["spans"]):
            removed = spans = 0
            kept = text
            if parts is not None and len(parts):
                coded = np.sort(np.asarray(parts, np.int64))   # by start, then length
                span = np.stack([coded // SPAN, coded // SPAN + coded % SPAN], 1)
                reach = np.maximum.accumulate(span[:, 1])
                new = np.concatenate([[True], span[1:, 0] > reach[:-1]])
                a, b = span[new, 0], reach[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(span) - 1]])]
                removed, spans = int((b - a).sum()), len(a)
                kept = b"".join(text[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(text)]))
            rows.append((len(text), removed, spans, kept))
        yield pd.DataFrame({"id": frame["id"].to_numpy(), "n_bytes": [r[0] for r in rows], "n_removed": [r[1] for r in rows],
                            "n_spans": [r[2] for r in rows], "kept": [r[3] for r in rows]})


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, copy, text`` with the text as bytes; ``id, copy`` names a row."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    if rows.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").take(1):
        own = Window.partitionBy("id").orderBy(F.md5("text"))
        return materialize(rows.withColumn("copy", (F.row_number().over(own) - 1).cast("int")), "suffix-keyed")
    return rows.withColumn("copy", F.lit(0))


def _with(rows: DataFrame, found: DataFrame, column: str, how: str) -> DataFrame:
    """``rows`` joined with a table that has a list of numbers for some of them."""
    size = found.agg(F.sum(8 * F.size(column) + 64).alias("n")).first().n or 0
    return rows.join(F.broadcast(found) if size <= BROADCAST_BYTES else found, ["id", "copy"], how)


def _by_row(found: DataFrame, column: str, name: str) -> DataFrame:
    return found.groupBy("id", "copy").agg(F.collect_list(column).alias(name))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` of every row; ``kept`` are the bytes left."""
    short_batches(docs.sparkSession)
    rows = _keyed(docs, id_col, text_col)
    size = rows.agg(F.sum(F.length("text")).alias("n")).first().n or 0
    first = rows.select("id", "copy", "text").mapInPandas(_hash_rows(1 + size // HASH_BUCKET_BYTES), HASHES)
    places = materialize(_by_row(first.groupBy("bucket").applyInPandas(
        lambda group: _candidates(group, hot), "id bigint, copy int, place bigint"), "place", "places"), "suffix-places")
    n = places.agg(F.sum(F.size("places")).alias("n")).first().n or 0
    runs = _with(rows.select("id", "copy", "text"), places, "places", "inner").mapInPandas(
        _run_rows(1 + int(n) // SUFFIX_BUCKET), RUNS)
    spans = materialize(_by_row(runs.groupBy("bucket").applyInPandas(
        _repeats, "id bigint, copy int, span bigint"), "span", "spans"), "suffix-spans")
    cut = _with(rows, spans, "spans", "left").select("id", "text", "spans").mapInPandas(
        _cut, "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
    return cut.select(F.nullif("id", F.lit(NO_ID)).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept")


def digests(kept: DataFrame) -> DataFrame:
    """The contract's columns."""
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
