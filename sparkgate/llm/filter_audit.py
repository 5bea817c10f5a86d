"""Filter interaction audit: what each filter removes in every order of all five.

Each document gets a mask of the filters it fails. A mask decides the outcome of every step of
all 120 orders, so it is mapped to one wide integer (``packed``) whose 1,800 fields of 64 bits
hold, for each of the 600 steps, whether the document is removed there, whether it fails there
but was removed earlier, and whether it fails no other filter. These integers are summed per
part and unpacked: a field counts documents, of which there are fewer than 2**64, so no field
runs over into the next.

Documents of equal part, mask and labels have the same integer: Spark counts them first, with
partial sums in every task, so the big sums meet at most 128 rows of a part however many
documents it has. Filter E (an earlier copy anywhere) keeps, of each text, the rows of its
smallest id: one ``min_by`` over a digest of the text, with partial minima, so that a text in
a third of all rows sends one row a task. All rows less these originals fail E.

Nulls, ties and odd rows: a null text is the empty text (it fails A; 0 words and 0 characters
pass B and C). A null or empty language is the part ''. A null id has no labels, comes before
no other row and has no smaller id than its own, so it neither fails E nor makes others fail.
Rows repeated under one id count once each and fail E only by a smaller id. An id with several
labels is good, or toxic, if one of them says so; null labels say nothing. Other columns are
ignored. An empty table has no parts and gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, reduce
from itertools import permutations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkgate.llm.common import bound
from sparkgate.session import materialize

#: The filters; the bit of a filter in a mask is its place here.
FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
#: Bits of a field. A field counts documents of one part.
FIELD = 64
#: Fields of a step: removed here, failing but removed earlier, failing nothing else.
REMOVED, REDUNDANT, UNIQUE = range(3)
STEP_FIELDS = 3

WORD = r"[^\x20\x09-\x0D]+"
NO_CAPITALS = "[^A-Z]+"
SYMBOLS = "#$%&*|"

RESULT = ("part string, filter_order string, step int, kept long, removed long, redundant long, "
          "unique_fails long, good_lost long, toxic_lost long, shapley long")


@cache
def packed(mask: int) -> int:
    """The outcomes of one document with this mask: field 3 * (5 * order + step) + kind."""
    out = 0
    for o, order in enumerate(ORDERS):
        gone = False
        for s, letter in enumerate(order):
            bit = 1 << FILTERS.index(letter)
            at = STEP_FIELDS * (len(FILTERS) * o + s)
            if mask & bit:
                out |= 1 << FIELD * (at + (REDUNDANT if gone else REMOVED))
                gone = True
            if mask == bit:
                out |= 1 << FIELD * (at + UNIQUE)
    return out


def unpack(total: int) -> list[int]:
    """The fields of a sum of packed outcomes."""
    raw = total.to_bytes(FIELD // 8 * STEP_FIELDS * len(FILTERS) * len(ORDERS), "little")
    return [int.from_bytes(raw[i:i + FIELD // 8], "little") for i in range(0, len(raw), FIELD // 8)]


def audit_rows(part: str, n: int, total: int, good: int, toxic: int) -> list[tuple]:
    """The 600 rows of a part from its documents and its three sums (all, good, toxic)."""
    of, of_good, of_toxic = unpack(total), unpack(good), unpack(toxic)
    steps = [(order, s, letter, STEP_FIELDS * (len(FILTERS) * o + s))
             for o, order in enumerate(ORDERS) for s, letter in enumerate(order)]
    shapley = dict.fromkeys(FILTERS, 0)
    for _, _, letter, at in steps:
        shapley[letter] += of[at + REMOVED]
    out, kept = [], n
    for order, s, letter, at in steps:
        kept = (n if s == 0 else kept) - of[at + REMOVED]
        out.append((part, order, s + 1, kept, of[at + REMOVED], of[at + REDUNDANT], of[at + UNIQUE],
                    of_good[at + REMOVED], of_toxic[at + REMOVED], shapley[letter]))
    return out


def text_mask(text: Column) -> Column:
    """The bits of filters A to D for a text. Integers only: no rounding."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    of_words = bound(words, lambda w: F.when(F.size(w) < 200, 1).otherwise(0) + F.when(
        100 * F.size(F.array_distinct(w)).cast("bigint") < 50 * F.size(w).cast("bigint"), 2).otherwise(0))
    n = F.length(text).cast("bigint")
    capitals = F.length(F.regexp_replace(text, NO_CAPITALS, "")).cast("bigint")
    symbol = reduce(Column.__or__, [text.contains(c) for c in SYMBOLS])
    return (of_words + F.when(100 * capitals > 3 * n, 4).otherwise(0)
            + F.when(symbol, 8).otherwise(0)).cast("int")


def masks(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "lang") -> DataFrame:
    """``part, mask, good, toxic, n``: the documents of each kind, all five filters judged."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = materialize(docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("id"),
        F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"), text_mask(text).alias("mask"),
        # rows without an id go by their text, or a task would get them all
        F.when(F.col(f"`{id_col}`").isNull(), F.xxhash64(text)).otherwise(F.lit(0)).alias("apart")),
        "audit-rows")
    says = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)))
    known = labels.select(F.col("doc_id").cast("bigint").alias("id"), "quality", "toxic").groupBy("id").agg(
        says("quality").alias("good"), says("toxic").alias("toxic")).withColumn(
        "apart", F.when(F.col("id").isNull(), F.lit(1)).otherwise(F.lit(0)).cast("bigint"))
    no = F.lit(False)
    labelled = rows.join(known, ["id", "apart"], "left").select(
        "id", "apart", "digest", "part", "mask",
        F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"))
    cells = materialize(labelled.groupBy("id", "apart", "digest", "part", "mask", "good", "toxic").agg(
        F.count("*").alias("n")), "audit-cells")
    kind = ["part", "mask", "good", "toxic"]
    # of each text, the cells of its smallest id; several cells only if that id's rows differ
    of_id = cells.where("id IS NOT NULL").groupBy("id", "digest").agg(
        F.collect_set(F.struct(*kind, "n")).alias("c"))
    first = of_id.groupBy("digest").agg(F.min_by("c", "id").alias("c")).select(F.inline("c"))
    no_id = cells.where("id IS NULL")
    fine = first.unionByName(no_id.select(*first.columns)).groupBy(*kind).agg(F.sum("n").alias("fine"))
    every = cells.groupBy(*kind).agg(F.sum("n").alias("n"))
    split = every.join(fine, kind, "left").select(*kind, "n", F.coalesce("fine", F.lit(0)).alias("fine"))
    late = 1 << FILTERS.index("E")
    return split.select("part", "good", "toxic", F.inline(F.array(
        F.struct("mask", F.col("fine").alias("n")),
        F.struct((F.col("mask") + late).alias("mask"), (F.col("n") - F.col("fine")).alias("n"))))).where("n > 0")


def _sum_parts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Add up the packed integers of the parts of a task, which holds whole parts."""
    names = [f.split()[0] for f in RESULT.split(", ")]
    part, n, sums = None, 0, [0, 0, 0]
    for frame in frames:
        for row in frame.itertuples(index=False):
            if row.part != part:
                if part is not None:
                    yield pd.DataFrame(audit_rows(part, n, *sums), columns=names)
                part, n, sums = row.part, 0, [0, 0, 0]
            outcomes = int(row.n) * packed(int(row.mask))
            n += int(row.n)
            for i, counts in enumerate((True, row.good, row.toxic)):
                sums[i] += outcomes if counts else 0
    if part is not None:
        yield pd.DataFrame(audit_rows(part, n, *sums), columns=names)


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "lang") -> DataFrame:
    """One row per part, order of filters and step, zeros included."""
    kinds = masks(docs, labels, id_col, text_col, part_col)
    return kinds.repartition("part").sortWithinPartitions("part").mapInPandas(_sum_parts, RESULT)
