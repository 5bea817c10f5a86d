import math

import pytest
from pyspark.sql import functions as F

from sparkgate.llm import quality as Q
from tests.conftest import SF_MID

SCHEMA = "doc_id long, text string, source string, lang string, p string, evidence string"


def sigmoid(z):
    return 1 / (1 + math.exp(-z))


def brute(rows):
    """Scores from (host, path, evidence) by plain loops."""
    p = [sigmoid(z) for _, _, z in rows]
    n, good = {}, {}
    for (h, t, _), x in zip(rows, p):
        for k in ((h,), (h, t)):
            n[k] = n.get(k, 0) + 1
            good[k] = good.get(k, 0) + x
    mean = (sum(p) + 1) / (len(p) + 2)

    def strength(keys, expected):
        total = sum(n[k] for k in keys)
        between = sum(n[k] * (good[k] / n[k] - expected(k)) ** 2 for k in keys)
        within = sum(expected(k) * (1 - expected(k)) for k in keys)
        everything = sum(n[k] * expected(k) * (1 - expected(k)) for k in keys)
        return min(max(everything / total / max((between - within) / total, 1e-9) - 1, 1), 1e5)
    hosts, paths = [k for k in n if len(k) == 1], [k for k in n if len(k) == 2]
    s = strength(hosts, lambda k: mean)
    post = {k: (s * mean + good[k]) / (s + n[k]) for k in hosts}
    t = strength(paths, lambda k: post[k[:1]])
    out = []
    for (h, path, z), x in zip(rows, p):
        k = (h, path)
        rest = (good[k] + t * post[(h,)] - x) / (n[k] + t - 1) if n[k] + t > 1 else mean
        rest = min(max(rest, 1e-6), 1 - 1e-6)
        out.append(sigmoid(z + math.log(rest / (1 - rest)) - math.log(mean / (1 - mean))))
    return out


@pytest.mark.parametrize("limit", [100_000, 0])
def test_posteriors_against_plain_loops(spark, limit, monkeypatch):
    monkeypatch.setattr(Q, "SITES_BROADCAST", limit)
    rows = [("a", "x", 3.0)] * 40 + [("a", "y", -2.0)] * 15 + [("b", None, -3.0)] * 30 + [
        (None, "x", 0.5), ("c", "z", 0.3), ("c", "w", -0.2), ("b", "x", 4.0)]
    scored = Q._with_p(spark.createDataFrame(rows, "host string, path string, evidence double"))
    got = Q.add_sites(scored, Q.site_posteriors(scored)).collect()
    assert len(got) == len(rows)
    want = sorted(zip(map(str, rows), brute(rows)))
    for (key, score), r in zip(want, sorted(got, key=lambda r: (str((r.host, r.path, r.evidence)), r.quality_score))):
        assert key == str((r.host, r.path, r.evidence))
        assert r.quality_score == pytest.approx(score, abs=2e-9) and r.quality_kept == (r.quality_score >= 0.5)


def documents(spark):
    rows = [(i, "plain words in a good text that goes on for a while and number %d" % i, "a", "en") for i in range(60)]
    rows += [(100 + i, "*** $$$ ### &&& bad junk *** $$$ | | |", "b", "en") for i in range(60)]
    rows += [(None, None, None, None), (1, rows[1][1], "a", "en"), (300, "", "a", "en"),
             (301, "long words " * 40_000, "c", None)]
    return spark.createDataFrame([(*r, "p", "e") for r in rows], SCHEMA)


def test_fit_classify_and_keep(spark):
    docs = documents(spark)
    labels = spark.createDataFrame(
        [(i, 1, 0) for i in range(30)] + [(100 + i, 0, None) for i in range(30)] + [(None, 1, 1), (5, None, None)],
        "doc_id long, quality int, toxic int")
    model = Q.fit(docs, labels)
    got = Q.classify(docs, model).collect()
    assert len(got) == docs.count()
    verdict = {r.doc_id: r.quality_kept for r in got}
    assert all(verdict[i] for i in range(60)) and not any(verdict[100 + i] for i in range(60))
    kept = Q.keep_good(docs, model)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if r.quality_kept)


def test_without_labels_or_rows(spark):
    docs = documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = Q.fit(docs, none)
    assert Q.keep_good(docs, model).count() == docs.count()
    assert Q.classify(docs.limit(0), model).collect() == []
    assert Q.fit(docs.limit(0), none).words == []


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    model = Q.fit(docs, labels.where("doc_id % 2 = 0"))
    rows = Q.classify(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id").select(
        "quality_kept", (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic")).collect()
    clean = [r.quality_kept for r in rows if r.good and not r.toxic]
    junk = [r.quality_kept for r in rows if not r.good]
    assert sum(clean) > 0.97 * len(clean)
    assert sum(junk) < 0.25 * len(junk)
