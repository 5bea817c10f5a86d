"""Quality classifier with hierarchical empirical Bayes over sites.

Method: a logistic model turns what a whole text looks like into evidence (a log odds). The
documents of a path of a host, and those of a host, give posteriors by grouped sums: a path
shrinks toward its host and a host toward all documents, the more the fewer documents it has,
with strengths estimated from the spread between groups. A document's log odds is its own
evidence plus what its path adds to the global prior; its own share in the path is left out.

``documents`` has no url: the registered query and the pipeline take its source for the host and
its language as a stand-in for the path, a hierarchy of source and language. ``classify`` takes
the names of real host and path columns.

Sums are combined before the shuffle, so a host with a third of all rows costs no more than
another. The path posteriors are broadcast only up to ``SITES_BROADCAST`` rows (they are
counted first) and joined by shuffle beyond that.

Labels: a document is bad if its quality is 0 or it is toxic. The classifier is fitted on at
most ``MAX_LABELLED`` labelled documents, those with the smallest hashed ids; everything else
covers all documents.

Nulls, ties and odd rows: a null text is empty; null hosts and paths are a host and path of
their own; labels with a null id, or with no known quality and toxicity, are left out, and a
document with several labels is bad if one says so; without both kinds of labels the evidence
is 0 and every document is kept; a probability of exactly one half is kept; every input row
gives one output row, repeated rows included; an empty table gives no rows. Only the three
result columns are added; input columns of these names are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkgate.llm.common import bound
from sparkgate.session import materialize

MAX_LABELLED = 8_000
#: Words that tell most about bad documents, by a test on the labelled ones.
TELLING_WORDS = 256
#: Documents that a telling word is in at least, and the tests (standard errors between the
#: shares of bad and good documents that have it) from which it tells something, and much.
MIN_DOCUMENTS = 6
TELLS, TELLS_MUCH = 4.0, 7.0
RIDGE = 1.0
SITES_BROADCAST = 100_000
NUMBERS = ("symbols", "exclamations", "bars", "capitals", "digits", "word_length", "long_words", "repeats",
           "lines_twice", "log_words", "few_words")


def _share(a: Column, b: Column) -> Column:
    return F.least(F.lit(3.0), a.cast("double") / F.greatest(b.cast("double"), F.lit(1.0)))


def _kept(text: Column, chars: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{chars}]+", ""))


def numbers(text: Column, words: list[list[str]]) -> Column:
    """The features of a whole text: the ``NUMBERS``, then for each list of telling words whether
    the text has one, and how many."""
    lines = F.filter(F.split(text, "\n"), lambda s: F.btrim(s) != "")
    twice = bound(lines, lambda s: _share(F.size(s) - F.size(F.array_distinct(s)), F.size(s)))
    tokens = F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda w: w != "")
    lists = [F.array(*[F.lit(w) for w in some]) for some in words if some]

    def of(w: Column) -> Column:
        n = F.size(w)
        return F.array(
            _share(_kept(text, "#*$%&<>"), n), _share(_kept(text, "!"), n), _share(_kept(text, "|"), n),
            _share(_kept(text, r"\p{Lu}"), F.length(text)), _share(_kept(text, "0-9"), F.length(text)),
            _share(F.length(F.array_join(w, "")), n * 10),
            _share(F.size(F.filter(w, lambda x: F.length(x) > 24)), n),
            _share(n - F.size(F.array_distinct(w)), n), twice, F.log1p(n.cast("double")) / 10,
            F.when(n < 10, 1.0).otherwise(0.0),
            *[f(F.size(F.array_intersect(w, some))) for some in lists for f in (
                lambda n: F.least(F.lit(1.0), n.cast("double")), lambda n: F.least(F.lit(6.0), n.cast("double")))])
    return bound(tokens, of)


@dataclass
class Classifier:
    """Weights of the features (the last is the constant), and the telling words."""

    weights: list[float]
    words: list[list[str]]

    def evidence(self, text: Column) -> Column:
        """Log odds that a text is good, from the text alone."""
        terms = F.zip_with(numbers(text, self.words), F.array(*[F.lit(w) for w in self.weights[:-1]]),
                           lambda x, w: x * w)
        z = F.aggregate(terms, F.lit(self.weights[-1]), lambda a, x: a + x)
        return F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))


def _text(docs: DataFrame, text_col: str) -> Column:
    return F.coalesce(docs[text_col], F.lit(""))


def fit(docs: DataFrame, labels: DataFrame, text_col: str = "text") -> Classifier:
    """The classifier from a bounded sample of the labelled documents."""
    bad = (F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False)))
    sample = labels.where(F.col("doc_id").isNotNull() & (F.col("quality").isNotNull() | F.col("toxic").isNotNull())) \
        .groupBy("doc_id").agg(F.max(bad.cast("int")).alias("bad")) \
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)
    known = materialize(docs.select("doc_id", _text(docs, text_col).alias("text")).join(
        F.broadcast(sample), "doc_id"), "quality-sample")
    n = {r.bad: r.n for r in known.groupBy("bad").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return Classifier([0.0] * (len(NUMBERS) + 1), [])
    words = F.array_distinct(F.filter(F.split(F.lower("text"), r"[^\p{L}]+"), lambda w: w != ""))
    by_word = known.select("bad", F.explode(words).alias("word")).groupBy("word").agg(
        F.sum("bad").alias("b"), F.sum(1 - F.col("bad")).alias("g")).where(F.col("b") + F.col("g") >= MIN_DOCUMENTS)
    rate = F.col("b") / n[1] - F.col("g") / n[0]
    spread = F.sqrt((F.col("b") + F.col("g")) / (n[0] + n[1]) * (1 / n[0] + 1 / n[1]))
    found = by_word.withColumn("test", rate / spread).where(F.col("test") > TELLS) \
        .orderBy(F.desc("test"), "word").limit(TELLING_WORDS).collect()
    telling = [[r.word for r in found if r.test > TELLS_MUCH], [r.word for r in found if r.test <= TELLS_MUCH]]
    rows = known.select("doc_id", "bad", numbers(F.col("text"), telling).alias("x")).collect()
    rows.sort(key=lambda r: (r.doc_id, r.bad, r.x))
    x = np.array([[*r.x, 1.0] for r in rows])
    return Classifier(_logistic(x, np.array([1.0 - r.bad for r in rows])), telling)


def _logistic(x: np.ndarray, y: np.ndarray) -> list[float]:
    """Ridge logistic regression by Newton's method; the constant isn't shrunk."""
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], RIDGE)
    ridge[-1] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve, x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return [float(v) for v in w]


def _strength(groups: DataFrame, total: str, n: str, expected: Column) -> float:
    """How many documents the prior of a group counts for: moments of a beta-binomial."""
    m = expected
    row = groups.agg(
        F.sum(F.col(n) * F.pow(F.col(total) / F.col(n) - m, F.lit(2))).alias("between"),
        F.sum(m * (1 - m)).alias("within"), F.sum(F.col(n) * m * (1 - m)).alias("all"),
        F.sum(n).alias("n")).first()
    if not row.n:
        return 1.0
    excess = max((row.between - row.within) / row.n, 1e-9)
    return float(min(max(row.all / row.n / excess - 1, 1.0), 1e5))


@dataclass
class Sites:
    """Path posteriors, as the pseudo-counts that a path's documents start from."""

    paths: DataFrame      # host, path, prior_good, prior_n: with its own documents in
    mean: float
    n_paths: int


def site_posteriors(scored: DataFrame) -> Sites:
    """From ``host, path, p`` of all documents."""
    paths = materialize(scored.groupBy("host", "path").agg(
        F.count("*").alias("n"), F.sum("p").alias("good")), "quality-paths")
    total = paths.agg(F.sum("n").alias("n"), F.sum("good").alias("good"), F.count("*").alias("k")).first()
    mean = (total.good + 1) / (total.n + 2) if total.n else 0.5
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("good").alias("host_good"))
    s = _strength(hosts, "host_good", "host_n", F.lit(mean))
    hosts = hosts.withColumn("host_post", (F.lit(s * mean) + F.col("host_good")) / (F.lit(s) + F.col("host_n"))) \
        .withColumnRenamed("host", "h")
    both = paths.join(hosts, paths["host"].eqNullSafe(hosts["h"]))
    t = _strength(both, "good", "n", F.col("host_post"))
    posterior = both.select("host", "path", (F.col("good") + t * F.col("host_post")).alias("prior_good"),
                            (F.col("n") + F.lit(t)).alias("prior_n"))
    return Sites(materialize(posterior, "quality-sites"), mean, total.k)


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def add_sites(scored: DataFrame, sites: Sites) -> DataFrame:
    """``quality_score`` and ``quality_kept`` for rows with ``host, path, evidence, p``."""
    paths = sites.paths.withColumnsRenamed({"host": "_host", "path": "_path"})
    if sites.n_paths <= SITES_BROADCAST:
        paths = F.broadcast(paths)
    joined = scored.join(paths, scored["host"].eqNullSafe(paths["_host"]) & scored["path"].eqNullSafe(paths["_path"]),
                         "left")
    # without the document itself; a lone document has its host's posterior
    rest = (F.col("prior_good") - F.col("p")) / (F.col("prior_n") - 1)
    rest = F.least(F.lit(1 - 1e-6), F.greatest(F.lit(1e-6), F.when(F.col("prior_n") > 1, rest).otherwise(
        F.lit(sites.mean))))
    mean = min(max(sites.mean, 1e-6), 1 - 1e-6)
    z = F.col("evidence") + _logit(rest) - F.lit(float(np.log(mean / (1 - mean))))
    return joined.withColumn("quality_score", F.round(1 / (1 + F.exp(-z)), 9)) \
        .withColumn("quality_kept", F.col("quality_score") >= 0.5).drop("_host", "_path", "prior_good", "prior_n")


def _score(docs: DataFrame, model: Classifier, host_col: str, path_col: str, text_col: str) -> dict[str, Column]:
    z = model.evidence(_text(docs, text_col))
    return {"host": docs[host_col].cast("string"), "path": docs[path_col].cast("string"), "evidence": z}


def _with_p(df: DataFrame) -> DataFrame:
    return df.withColumn("p", 1 / (1 + F.exp(-F.col("evidence"))))


def classify(docs: DataFrame, model: Classifier, host_col: str = "source", path_col: str = "lang",
             text_col: str = "text") -> DataFrame:
    """``doc_id, evidence, quality_score, quality_kept`` of every document."""
    parts = _score(docs, model, host_col, path_col, text_col)
    scored = materialize(_with_p(docs.select("doc_id", *[c.alias(k) for k, c in parts.items()])), "quality-scored")
    return add_sites(scored, site_posteriors(scored)).select(
        "doc_id", "evidence", "quality_score", "quality_kept")


def keep_good(docs: DataFrame, model: Classifier, host_col: str = "source", path_col: str = "lang",
              text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, whole. A pass for the sites, one for the rows."""
    parts = _score(docs, model, host_col, path_col, text_col)
    scored = _with_p(docs.select(*[c.alias(k) for k, c in parts.items()]))
    sites = site_posteriors(scored)
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    again = _with_p(docs.select(row, *[c.alias(k) for k, c in parts.items()]))
    return add_sites(again, sites).where("quality_kept").select("row.*")
