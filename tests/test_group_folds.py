"""Balanced group folds (M11) for groups of one and of several labels."""

import random
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest

from sparkgate.operators import ml_split as SP


def _table(spark, groups):
    rows = [(g, c) for g, labels in groups.items() for c, n in labels.items() for _ in range(n)]
    random.Random(0).shuffle(rows)
    return spark.createDataFrame(rows, "gid string, person string")


def _folds(spark, groups, k):
    fold = defaultdict(set)
    for r in SP.group_folds(_table(spark, groups), "person", "gid", k).select("gid", "fold").distinct().collect():
        fold[r.gid].add(r.fold)
    assert all(len(f) == 1 for f in fold.values()) and fold.keys() == groups.keys()
    return {g: f.pop() for g, f in fold.items()}


def _spread(groups, fold, k):
    """Mean over the classes of the deviation of their shares over the folds."""
    n = defaultdict(lambda: np.zeros(k))
    for g, labels in groups.items():
        for c, m in labels.items():
            n[c][fold[g]] += m
    return np.mean([(v / v.sum()).std() for v in n.values()])


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_close_to_the_best_of_all_deals(spark, seed):
    rnd = random.Random(seed)
    groups = {f"g{i}": {c: rnd.randrange(1, 5) for c in rnd.sample("abc", rnd.randrange(2, 4))} for i in range(9)}
    got = _spread(groups, _folds(spark, groups, 2), 2)
    deals = [_spread(groups, dict(zip(groups, d)), 2) for d in product(range(2), repeat=9)]
    best, typical = min(deals), float(np.median(deals))
    assert got <= best + 0.35 * (typical - best) + 0.02


def test_mixed_groups_are_balanced_within_one_group(spark):
    rnd = random.Random(8)
    kinds = [{"a": 3, "b": 1}, {"a": 1, "b": 3}, {"a": 2, "b": 2, "c": 5}, {"c": 4, "a": 1}]
    groups = {f"g{i}": dict(rnd.choice(kinds)) for i in range(83)}
    groups |= {f"s{i}": {rnd.choice("abc"): rnd.randrange(1, 4)} for i in range(20)}
    k = 4
    fold = _folds(spark, groups, k)
    for c in "abc":
        n = Counter()
        for g, labels in groups.items():
            n[fold[g]] += labels.get(c, 0)
        assert max(n.values()) - min(n[f] for f in range(k)) <= 2 * 5
    alike = defaultdict(Counter)
    for g, labels in groups.items():
        if len(labels) > 1:
            alike[tuple(sorted(labels.items()))][fold[g]] += 1
    for n in alike.values():       # every k of equal groups: one in each fold
        assert min(n[f] for f in range(k)) >= sum(n.values()) // k


def test_too_many_vectors_are_dealt_by_hash(spark, monkeypatch):
    monkeypatch.setattr(SP, "MAX_VECTORS", 0)
    groups = {f"g{i}": {"a": 1 + i % 3, "b": 2} for i in range(31)}
    fold = _folds(spark, groups, 3)
    n = Counter(fold.values())
    assert max(n.values()) - min(n.values()) <= 3


def test_rows_without_a_group_have_no_fold(spark):
    df = spark.createDataFrame([(None, "a"), ("g", "a"), ("g", "b"), ("h", "b")], "gid string, person string")
    got = {(r.gid, r.person): r.fold for r in SP.group_folds(df, "person", "gid", 2).collect()}
    assert got[None, "a"] is None and got["g", "a"] == got["g", "b"] is not None
