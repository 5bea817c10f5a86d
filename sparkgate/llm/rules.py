"""Quality rules as a bitmask ledger (DataFrame functions only).

``ledger`` evaluates every rule once over each whole text and stores the measurements and a
bitmask of the failed rules. Policies are masks over those bits, with a version each:
``apply_policy`` and ``ablate`` read the ledger and never the texts again.

Words are runs of characters other than space and tab to carriage return. Nulls, ties and
odd rows: a null text is the empty text (no words, it fails ``too_short``); a null id stays
null; every input row gives one ledger row, repeated rows included; other columns of the
input are ignored; an empty table gives an empty ledger, whose ablation counts are 0.
All work is per row, so long texts cost time in proportion and no row waits for another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkgate.llm.common import bound, id_text

SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"
#: Words in a window; a window found twice in a text makes its words repeated ones.
WINDOW = 5

#: The rules, by bit, as conditions on the measurements. Integers only: no rounding.
RULES: dict[str, str] = {
    "too_short": "n_words < 10",
    "repeated_windows": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "exclamations": "2 * n_exclamations > n_words",
    "repeated_lines": "n_dup_lines >= 3 AND 100 * n_dup_lines > 30 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 15 * n_words",
}
BIT = {name: 1 << i for i, name in enumerate(RULES)}


def mask(*rules: str) -> int:
    return sum(BIT[r] for r in rules)


#: Versioned policies: the rules that a document must not fail.
POLICIES: dict[str, int] = {
    "base": mask("too_short", "repeated_windows"),
    "v1": mask("too_short", "repeated_windows", "symbols", "repeated_lines"),
    "v2": mask(*RULES),
}


def _repeat_words(words: Column) -> Column:
    """Words inside windows that occur at least twice.

    Different hashes prove that all windows differ, which settles most texts. The others
    sort their windows by hash, then words, so equal hashes of different windows are told
    apart, and count the words that repeated windows cover.
    """
    starts = F.sequence(F.lit(0), F.size(words) - WINDOW)
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))

    def window(i: Column) -> Column:
        parts = [F.get(words, i + k) for k in range(WINDOW)]
        return F.struct(F.xxhash64(*parts).alias("h"), F.concat_ws(" ", *parts).alias("s"), i.alias("i"))

    def same(a: Column, b: Column) -> Column:
        return F.coalesce((a["h"] == b["h"]) & (a["s"] == b["s"]), F.lit(False))

    def repeated(z: Column) -> Column:
        found = F.filter(z, lambda x, j: same(x, F.get(z, j + 1)) | same(x, F.get(z, j - 1)))
        return F.sort_array(F.transform(found, lambda x: x["i"]))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, j: F.least(
            F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW))).cast("bigint"))
        return F.aggregate(steps, F.lit(0).cast("bigint"), lambda a, x: a + x)
    exact = bound(bound(F.sort_array(F.transform(starts, window)), repeated), covered)
    return F.when(F.size(words) <= WINDOW, F.lit(0).cast("bigint")).when(
        bound(hashes, lambda h: F.size(F.array_distinct(h)) == F.size(h)),
        F.lit(0).cast("bigint")).otherwise(exact)


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the measurements and ``failed``, the bitmask of failed rules."""
    text = F.col("text")
    lines = F.filter(F.split(text, "\n"), lambda s: F.btrim(s, F.lit(SPACES)) != "")
    of_words = bound(
        F.filter(F.split(text, SPACE), lambda w: w != ""),
        lambda w: F.struct(F.size(w).cast("bigint").alias("n_words"),
                           F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
                           _repeat_words(w).alias("n_repeat_words")))
    of_lines = bound(lines, lambda s: F.struct(
        F.size(s).cast("bigint").alias("n_lines"),
        (F.size(s) - F.size(F.array_distinct(s))).cast("bigint").alias("n_dup_lines")))
    measured = id_text(docs, id_col, text_col).select(
        "doc_id", of_words.alias("w"), of_lines.alias("l"),
        F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
        F.length(F.regexp_replace(text, "[^!]+", "")).cast("bigint").alias("n_exclamations"),
    ).select("doc_id", "w.*", "n_symbols", "n_exclamations", "l.*")
    bits = [F.when(F.expr(rule), F.lit(BIT[name])).otherwise(F.lit(0)) for name, rule in RULES.items()]
    failed = bits[0]
    for b in bits[1:]:
        failed = failed.bitwiseOR(b)
    return measured.withColumn("failed", failed.cast("bigint"))


def apply_policy(rows: DataFrame, policy: str | int = "v2") -> DataFrame:
    """The ledger with ``base_failed`` and ``kept`` by a policy's name or mask."""
    m = POLICIES[policy] if isinstance(policy, str) else policy
    hit = lambda by: F.col("failed").bitwiseAND(F.lit(by)) != 0
    return rows.withColumns({"base_failed": hit(POLICIES["base"]),
                             "kept": ~hit(m | POLICIES["base"])})


def ablate(rows: DataFrame, policy: str | int = "v2") -> DataFrame:
    """``rule, n_failed, n_only``: documents that fail each rule of a policy, and those that
    leaving out this one rule would let in. One pass of sums over the bitmasks."""
    m = POLICIES[policy] if isinstance(policy, str) else policy
    of = F.col("failed").bitwiseAND(F.lit(m))
    names = [r for r in RULES if BIT[r] & m]
    count = lambda c: F.coalesce(F.sum(c.cast("bigint")), F.lit(0).cast("bigint"))
    sums = rows.agg(F.array(*[F.struct(
        F.lit(r).alias("rule"),
        count(of.bitwiseAND(F.lit(BIT[r])) != 0).alias("n_failed"),
        count(of == BIT[r]).alias("n_only")) for r in names]).alias("a"))
    return sums.select(F.inline("a"))
