"""Near-duplicate classes of documents by DartMinHash.

Method: a document is the weighted set of its five-word shingles (weight: occurrences). For
every element, hashed darts fall on the plane of weight and rank, one per unit of area, the
same for every document; a dart hits a document if its weight is below the element's there.
Each dart belongs to one of ``COORDINATES`` coordinates, and a document keeps the dart of the
earliest rank in each. Two documents agree in a coordinate with the probability of their
weighted Jaccard similarity. Only the ranks that fill all coordinates are thrown (about
k ln k + 3k darts a document, doubled where a coordinate stays empty), whatever its length.

Banded joining: documents that agree in all rows of a band meet in a bucket. A bucket tests
its members against its leader, then members against leaders of other classes in the bucket,
which joins most classes by few tests. Where a bucket still holds several classes, every pair
of its members in different classes is tested, unless one of two exact bounds rules a link out:
of u and v with leader l, at most min(|u & l|, |v & l|) + min(|u - l|, |v - l|) is common; and
they differ in at least as many elements as their parities (of the elements hashed to each of
``PARITIES`` places) differ in places. So no two similar documents of a bucket end in different
classes.
A test computes the exact weighted Jaccard similarity; links of at least ``SIMILAR`` join
classes (connected components by alternating large and small stars).

With 24 bands of 5 rows, two documents of similarity 0.8 meet with probability 0.9999.

Scale: documents with the same words are one node from the start, so copies cost a row each.
Leaders and star centres are found by grouped minima that combine before the shuffle and are
written as tables, so that the joins with them are plain ones, whose hot keys Spark can split.
The members left in several classes are dealt to blocks of about ``BLOCK``, and each pair of
blocks is a key of its own, so that no task gets all pairs of a large bucket. Their number can
grow with the square of a family of documents that are all nearly similar, and so must the tests.
Links, components and signatures stay in tables of the shared folder.

Nulls, ties and odd rows: a null text is empty; texts without words are copies of each other;
a text of fewer than five words is one shingle; upper and lower case and kinds of white space
don't count. A class's id is its smallest doc_id (null if it has none other); every input row
gives one output row, repeated rows included; an empty table gives no rows; other columns are
ignored by ``classes`` and kept by ``first_of_each``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType

from sparkgate.llm.common import map_rows, slices
from sparkgate.session import materialize

WORDS = 5
SIMILAR = 0.8
BANDS, ROWS = 24, 5
COORDINATES = BANDS * ROWS
#: Nodes of which the ids are broadcast to fetch their texts; beyond, a shuffle join does.
NODES_BROADCAST = 500_000
#: Elements and darts of documents whose signatures are made at once.
BATCH = 300_000
#: Rounds of leaders of other classes; pairs that they leave are tested afterwards.
LATER_ROUNDS = 2
#: Members of a bucket in a block, of which pairs are formed together.
BLOCK = 32
#: Places of which the parities bound how much two sets differ.
PARITIES = 2048

_SEED = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.uint64(0xD6E8FEB86659FD93)


def _times(n: int, odd: np.uint64) -> np.uint64:
    return np.uint64(n * int(odd) & 0xFFFFFFFFFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit hash (splitmix's finalizer)."""
    x = x + _SEED
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles, sorted, and how often each occurs."""
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    codes, distinct = pd.factorize(np.array(words, dtype=object))
    h = pd.util.hash_array(np.asarray(distinct, dtype=object), categorize=False)[codes]
    n = max(1, len(h) - WORDS + 1)
    out = np.full(n, np.uint64(min(len(h), WORDS)))
    for i in range(min(WORDS, len(h))):
        out = mix(out * _ODD + h[i:i + n])
    return np.unique(out, return_counts=True)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Signatures of non-empty weighted sets, a row for each.

    Sets of like size go together, in batches of ``BATCH`` elements and darts, which bounds
    the memory; a set's signature depends on it alone.
    """
    sig = np.zeros((len(sets), COORDINATES), np.uint64)
    sizes = np.array([len(e) for e, _ in sets])
    batch, cost = [], 0
    for i in np.argsort(sizes, kind="stable"):
        batch.append(i)
        cost += sizes[i] + 10 * COORDINATES
        if cost >= BATCH:
            sig[batch] = _signatures([sets[j] for j in batch])
            batch, cost = [], 0
    if batch:
        sig[batch] = _signatures([sets[j] for j in batch])
    return sig


def _signatures(sets: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    k = COORDINATES
    sig = np.zeros((len(sets), k), np.uint64)
    total = np.array([w.sum() for _, w in sets], float)
    most = (k * math.log(k) + 3 * k) / total
    todo = np.arange(len(sets))
    while len(todo):
        first, thrown = _throw([sets[i] for i in todo], most[todo])
        sig[todo] = thrown
        todo = todo[~np.isfinite(first).all(axis=1)]   # a coordinate is empty: more ranks
        most[todo] *= 2
    return sig


def _throw(sets: list[tuple[np.ndarray, np.ndarray]], most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Earliest rank and its dart for each set and coordinate, of ranks up to ``most``."""
    k = COORDINATES
    elements = np.concatenate([e for e, _ in sets])
    weights = np.concatenate([w for _, w in sets])
    owner = np.repeat(np.arange(len(sets)), [len(e) for e, _ in sets])
    first = np.full(len(sets) * k, np.inf)
    dart = np.zeros(len(sets) * k, np.uint64)
    low, width, band = 0.0, 1.0, 0
    while True:   # weight regions [0, 1), [1, 2), [2, 4), [4, 8) ...
        at = np.flatnonzero(weights > low)
        if not len(at):
            return first.reshape(-1, k), dart.reshape(-1, k)
        seed = mix(elements[at] + _times(band, _ODD))
        own, limit, top = owner[at], most[owner[at]], weights[at]
        rank = np.zeros(len(at))
        turn = 0
        while len(seed):
            h = mix(seed + _times(turn, _SEED))
            rank = rank - np.log(((h >> np.uint64(11)) + np.uint64(1)) * 2.0 ** -53) / width
            live = rank <= limit
            seed, own, limit, top, rank, h = (x[live] for x in (seed, own, limit, top, rank, h))
            place = mix(h)
            hit = low + width * ((place >> np.uint64(11)) * 2.0 ** -53) < top
            slot = own[hit] * k + (mix(place[hit]) % np.uint64(k)).astype(np.int64)
            r, d = rank[hit], h[hit]
            before = first[slot]
            np.minimum.at(first, slot, r)
            new = (first[slot] == r) & (r < before)
            dart[slot[new]] = d[new]
            turn += 1
        low, width, band = low + width, max(1.0, low + width), band + 1


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of each signature."""
    rows = sig.reshape(len(sig), BANDS, ROWS)
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), rows.shape[:2]).copy()
    for i in range(ROWS):
        keys = mix(keys * _ODD + rows[:, :, i])
    return keys.view(np.int64)


def similarity(a: bytes, b: bytes) -> float:
    """Weighted Jaccard similarity of two packed sets."""
    both, total = overlap(a, b), int(_unpack(a)[1].sum()) + int(_unpack(b)[1].sum())
    return both / (total - both) if total else 1.0


def overlap(a: bytes, b: bytes) -> int:
    """Weight that two packed sets have in common."""
    (ea, wa), (eb, wb) = _unpack(a), _unpack(b)
    _, i, j = np.intersect1d(ea, eb, assume_unique=True, return_indices=True)
    return int(np.minimum(wa[i], wb[j]).sum())


def _pack(elements: np.ndarray, weights: np.ndarray) -> bytes:
    """Elements, then the weights if any is above one."""
    n = np.array([len(elements)], "<u8").tobytes()
    return n + elements.astype("<u8").tobytes() + (weights.astype("<u4").tobytes() if (weights > 1).any() else b"")


def _unpack(x: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(x, "<u8", 1)[0])
    elements = np.frombuffer(x, "<u8", n, 8)
    return elements, (np.frombuffer(x, "<u4", n, 8 + 8 * n) if len(x) > 8 + 8 * n else np.ones(n, np.int64)).astype(np.int64)


def _words(text: str) -> list[str]:
    return text.lower().split()


def _digest(words: list[str]) -> bytes:
    return hashlib.md5(" ".join(words).encode("utf-8", "surrogatepass")).digest()


def _sketch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in slices(frames, "text", 2_000_000):
        words = [_words(t) for t in frame["text"]]
        full = [i for i, w in enumerate(words) if w]
        keys = band_keys(signatures([shingles(words[i]) for i in full])) if full else []
        bands: list = [[] for _ in words]
        for i, row in zip(full, keys):
            bands[i] = row
        yield pd.DataFrame({"doc_id": frame["doc_id"].to_numpy(), "node": [_digest(w) for w in words], "bands": bands})


def parities(elements: np.ndarray, weights: np.ndarray) -> bytes:
    """Bits of the parities of a set's elements (each occurrence is one) by their places."""
    each = np.repeat(elements, weights)
    turn = np.arange(len(each)) - np.repeat(np.cumsum(weights) - weights, weights)
    place = mix(mix(each) + turn.astype(np.uint64) * _ODD) % np.uint64(PARITIES)
    odd = np.bincount(place.astype(np.int64), minlength=PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The sets of the texts that have their node's words (ids may repeat)."""
    for frame in slices(frames, "text", 2_000_000):
        words = [(n, w) for n, t in zip(frame["node"], frame["text"]) if _digest(w := _words(t)) == n]
        sets = [shingles(w) for _, w in words]
        yield pd.DataFrame({"node": [n for n, _ in words], "packed": [_pack(*x) for x in sets],
                            "size": np.array([w.sum() for _, w in sets], np.int64), "odd": [parities(*x) for x in sets]})


@F.pandas_udf(LongType())
def _overlap(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([overlap(x, y) for x, y in zip(a, b)], dtype="int64")


def _similar(both: Column, total: Column) -> Column:
    return both / (total - both) >= SIMILAR


#: Called once for each row: the optimizer copies deterministic functions into filters.
_own_node = F.pandas_udf(lambda t: pd.Series([_digest(_words(x or "")) for x in t]), BinaryType()).asNondeterministic()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every linked node but the roots; the root is the smallest node of its
    component.

    ``links`` has ``u > v``. A round moves links toward smaller nodes (large star), then joins
    the smaller neighbours of each node (small star); it ends when every node hangs on a node
    that hangs on none.
    """
    edges = links
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "dart-low")
        large = materialize(both.join(low, "u").where("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v")), "dart-large")
        low = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "dart-low")
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "dart-links")
        ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("child")).union(edges.select("v", F.lit(0)))
        deep = ends.groupBy("x").agg(F.sum("child").alias("up"), F.min("child").alias("least")).where(
            "up > 1 OR up = 1 AND least = 0")
        if not deep.take(1):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, packed, size, odd`` of the asked nodes (``node, doc_id`` of one document each)."""
    wanted = nodes.select("node", F.col("doc_id").alias("_id"))
    if nodes.count() <= NODES_BROADCAST:
        wanted = F.broadcast(wanted)
    found = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["_id"])).select("node", "text")
    return found.mapInPandas(_sets, "node binary, packed binary, size bigint, odd binary").dropDuplicates(["node"])


def _pair(node: Column, doc_id: Column, other: Column, other_id: Column) -> list[Column]:
    """A pair in order, with a document of each node."""
    up = node > other
    return [F.when(up, node).otherwise(other).alias("u"), F.when(up, other).otherwise(node).alias("v"),
            F.when(up, doc_id).otherwise(other_id).alias("u_id"), F.when(up, other_id).otherwise(doc_id).alias("v_id")]


def _tested(pairs: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pairs ``u, v`` with their sizes ``u_size, v_size`` and what they have in ``both``;
    and the sets of their nodes."""
    pairs = materialize(pairs.dropDuplicates(["u", "v"]), "dart-pairs")
    asked = materialize(pairs.select(F.col("u").alias("node"), F.col("u_id").alias("doc_id")).union(
        pairs.select("v", "v_id")).dropDuplicates(["node"]), "dart-asked")
    sets = materialize(_texts(docs, asked), "dart-sets")
    a = sets.select(F.col("node").alias("u"), F.col("packed").alias("a"), F.col("size").alias("u_size"))
    b = sets.select(F.col("node").alias("v"), F.col("packed").alias("b"), F.col("size").alias("v_size"))
    met = pairs.select("u", "v").join(a, "u").join(b, "v")
    return materialize(met.select("u", "v", "u_size", "v_size", _overlap("a", "b").alias("both")), "dart-tested"), sets


def _links(tested: DataFrame) -> DataFrame:
    """The pairs ``u, v`` that are similar."""
    return tested.where(_similar(F.col("both"), F.col("u_size") + F.col("v_size"))).select("u", "v")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, node, root, class_id`` of every row: the digest of its words, the class as a
    digest and the class's smallest doc_id."""
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = materialize(map_rows(docs, _sketch, "doc_id bigint, node binary, bands array<bigint>"), "dart-rows")
    nodes = materialize(rows.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands")),
                        "dart-nodes")
    members = nodes.select("node", "doc_id", F.explode("bands").alias("bucket"))
    shared = materialize(members.groupBy("bucket").agg(
        F.min(F.struct("node", "doc_id")).alias("leader"), F.count("*").alias("n")).where("n > 1").drop("n"),
        "dart-leaders")
    members = materialize(members.join(shared, "bucket"), "dart-members")
    at = F.col("leader")
    pairs = members.where(F.col("node") != at["node"]).select(
        *_pair(F.col("node"), F.col("doc_id"), at["node"], at["doc_id"]))
    tested, sets = _tested(pairs, docs)
    roots = components(_links(tested))
    for turn in range(LATER_ROUNDS):
        found = _links(_tested(_across(members, roots, turn), docs)[0])
        if not found.take(1):
            break
        roots = _joined(roots, found)
    found = _links(_tested(_left(members, roots, tested, sets), docs)[0])
    if found.take(1):
        roots = _joined(roots, found)
    rooted = materialize(rows.select("doc_id", "node").join(roots, "node", "left").select(
        "doc_id", "node", F.coalesce("root", "node").alias("root")), "dart-rooted")
    smallest = materialize(rooted.groupBy("root").agg(F.min("doc_id").alias("class_id")), "dart-classes")
    return rooted.join(smallest, "root").select("doc_id", "node", "root", "class_id")


def _joined(roots: DataFrame, found: DataFrame) -> DataFrame:
    return components(roots.select(F.col("node").alias("u"), F.col("root").alias("v")).union(found))


def _placed(members: DataFrame, roots: DataFrame) -> DataFrame:
    return members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _across(members: DataFrame, roots: DataFrame, turn: int) -> DataFrame:
    """Pairs of members and leaders of another class in their bucket.

    The leaders are members of the bucket's first and last class, others in each turn.
    """
    placed = materialize(_placed(members, roots).select("bucket", "node", "doc_id", "root"), "dart-placed")
    one = F.struct("root", F.xxhash64("node", F.lit(turn)).alias("o"), "node", "doc_id")
    ends = materialize(placed.groupBy("bucket").agg(F.min(one).alias("low"), F.max(one).alias("high")).where(
        "low.root != high.root"), "dart-ends")
    met = placed.join(ends, "bucket")
    pairs = None
    for end in ("low", "high"):
        leader = F.col(end)
        some = met.where(F.col("root") != leader["root"]).select(
            *_pair(F.col("node"), F.col("doc_id"), leader["node"], leader["doc_id"]))
        pairs = some if pairs is None else pairs.union(some)
    return pairs


def _left(members: DataFrame, roots: DataFrame, tested: DataFrame, sets: DataFrame) -> DataFrame:
    """All pairs of members that share a bucket but no class and may be similar by what they
    have in common with the bucket's leader (which was tested with all) and by their parities."""
    placed = materialize(_placed(members, roots).select("bucket", "node", "doc_id", "leader.node", "root").toDF(
        "bucket", "node", "doc_id", "leader", "root").where("node != leader"), "dart-placed")
    mixed = placed.groupBy("bucket").agg(F.count("*").alias("n"), F.min("root").alias("low"),
                                         F.max("root").alias("high")).where("low != high")
    mixed = materialize(mixed.select("bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "dart-mixed")
    some = placed.join(mixed, "bucket").select(
        "*", F.greatest("node", "leader").alias("u"), F.least("node", "leader").alias("v"))
    some = materialize(some.join(tested.select("u", "v", "both"), ["u", "v"]).join(
        sets.select("node", "size", "odd"), "node").select(
        "bucket", "node", "doc_id", "root", "blocks", F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("block"),
        "size", "both", "odd"), "dart-left")
    row = F.struct("node", F.col("doc_id").cast("string").alias("doc_id"), "root", "size", "both", "odd")
    block = some.groupBy("bucket", "blocks", "block").agg(F.collect_list(row).alias("x"))
    part = lambda x: [F.col("x")[c].alias(f"{c}_{x}") for c in ("node", "doc_id", "root", "size", "both", "odd")]
    a = block.select("bucket", F.col("block").alias("i"), F.explode(F.expr("sequence(block, blocks - 1)")).alias("j"), *part("a"))
    b = block.select("bucket", F.explode(F.expr("sequence(0, block)")).alias("i"), F.col("block").alias("j"), *part("b"))
    met = a.join(b, ["bucket", "i", "j"]).drop("bucket").mapInPandas(
        _possible, "node binary, doc_id string, other binary, other_id string")
    return met.select(*_pair(F.col("node"), F.col("doc_id").cast("bigint"), F.col("other"), F.col("other_id").cast("bigint")))


def _possible(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs of members of two blocks (or of one) in different classes that no bound rules out."""
    for frame in frames:
        out: list[tuple] = []
        for r in frame.itertuples(index=False):
            root = pd.factorize(np.concatenate([r.root_a, r.root_b]))[0]
            n = len(r.node_a)
            size, other = np.asarray(r.size_a)[:, None], np.asarray(r.size_b)[None, :]
            both, also = np.asarray(r.both_a)[:, None], np.asarray(r.both_b)[None, :]
            most = np.minimum(both, also) + np.minimum(size - both, other - also)
            may = (most >= SIMILAR * (size + other - most) - 1e-6) & (root[:n, None] != root[None, n:])
            x, y = np.nonzero(np.triu(may) if r.i == r.j else may)
            odd = [np.frombuffer(b"".join(o), np.uint64).reshape(len(o), -1) for o in (r.odd_a, r.odd_b)]
            differ = np.bitwise_count(odd[0][x] ^ odd[1][y]).sum(axis=1, dtype=np.int64)
            total = size[x, 0] + other[0, y]
            near = (total - differ) >= SIMILAR * (total + differ) - 1e-6
            out += [(r.node_a[u], r.doc_id_a[u], r.node_b[v], r.doc_id_b[v]) for u, v in zip(x[near], y[near])]
        yield pd.DataFrame(out, columns=["node", "doc_id", "other", "other_id"])


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, whole, of the smallest doc_id in each class (one row of it)."""
    first = classes(docs, id_col, text_col).where(F.col("doc_id").eqNullSafe(F.col("class_id"))) \
        .select(F.col("doc_id").alias("_id"), F.col("node").alias("_node"), F.col("root").alias("_root"))
    first = materialize(first.dropDuplicates(["_id", "_root"]), "dart-first")
    row = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"),
                      docs[id_col].cast("bigint").alias("_own"), _own_node(docs[text_col]).alias("_digest"))
    kept = row.join(first, row["_own"].eqNullSafe(first["_id"]) & (row["_digest"] == first["_node"]))
    return kept.dropDuplicates(["_id", "_root"]).select("row.*")
