"""Expectations in one pass over written tables (Q3, Q4), and how often queries write."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from sparkgate import session
from sparkgate.operators import clean as C
from sparkgate.operators import features as FE
from sparkgate.operators import ml_split as SP
from sparkgate.operators import observed as OB
from sparkgate.operators import ranking, selection, verify
from sparkgate.plans import catalog
from tests.conftest import SF_SMALL


@pytest.fixture()
def writes(monkeypatch):
    """Names of the tables that a query writes while it is built and run."""
    names, plain = [], session.materialize

    def counted(df, name):
        names.append(name)
        return plain(df, name)
    for module in (session, OB, C, FE, SP, ranking, selection, verify, catalog):
        if hasattr(module, "materialize"):
            monkeypatch.setattr(module, "materialize", counted)
    return names


def test_metrics_of_a_written_table(spark):
    df = spark.range(1_000, numPartitions=7).select("id", F.when(F.col("id") % 4 != 0, F.col("id")).alias("v"))
    out, got = OB.written(df, "observed-test", {"rows": OB.rows(), "nulls": OB.null_cells(["id", "v"])})
    assert got == {"rows": 1_000, "nulls": 250} and out.count() == 1_000
    assert OB.seen(df, {"big": F.count_if(F.col("v") > 900)}) == {"big": 75}
    empty, none = OB.written(df.where("id < 0"), "observed-empty", {"rows": OB.rows(), "bad": F.count_if(F.col("v") < 0)})
    assert none == {"rows": 0, "bad": 0} and empty.count() == 0
    rows = {r.check: (r.passed, r.observed) for r in OB.findings(spark, got).collect()}
    assert rows == {"rows": (False, 1_000), "nulls": (False, 250)}


def test_valid_transactions_are_checked_while_written(spark):
    raw = spark.createDataFrame([(None, "5", "2024-01-01", 0), ("a", "7", "2024-01-02", 1), ("a", "-7", "2024-01-02", 2)],
                                "customer_id string, amount string, timestamp string, src_ord long").withColumn(
        "category", F.lit("x"))
    valid, faults = C.written_transactions(raw)
    assert valid.count() == 2
    assert faults == {"tx_customer_id_not_null": valid.where("customer_id IS NULL").count(), "tx_amount_positive": 0,
                      "tx_timestamp_not_null": 0}


def test_expectations_write_each_table_once(spark, writes):
    rows = {r.check: r.passed for r in E.queries()["dq_expectations"](spark, SF_SMALL).collect()}
    assert len(rows) == 7 and all(rows.values())
    tables = [n for n in writes if not n.startswith("selection-")]
    assert sorted(tables) == ["customer-aggregate", "profiles-dedup", "transactions-valid"]


@pytest.mark.parametrize("name", ["dq_distribution", "dq_key_overlap", "legacy_row_join", "mode_platform_alpha",
                                  "distinct_counts"])
def test_counts_need_no_copy(spark, writes, name):
    assert E.queries()[name](spark, SF_SMALL).count() > 0 and writes == []


@pytest.mark.parametrize("name", ["stratified_holdout", "stratified_folds", "class_weights", "missing_classes"])
def test_ranking_reads_the_written_classes(spark, writes, name):
    """The customer table is computed once: its inputs are written once each."""
    E.queries()[name](spark, SF_SMALL).collect()
    assert writes.count("customer-classes") + writes.count("customers") == 1
    assert writes.count("profiles-dedup") == writes.count("transactions-valid") == 1


def test_decisions_scan_each_input_once(spark):
    """No branch of the decisions is planned twice: the samples are read by two gates and the
    attempts, the profiles once."""
    df = E.queries()["attempt_decisions"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= 7 and "Union" not in plan
