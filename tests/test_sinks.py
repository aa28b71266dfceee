import os

import pytest

from pyspark.sql import functions as F

from conftest import SF_SMALL, line

from clientele.sources import sinks
from clientele.sources.schema import TRANSACTION_COLUMNS
from clientele.sources.transactions import read_transactions_csv, transactions_from_tables


def test_csv_round_trip_and_bad_cells(spark, scratch):
    t = transactions_from_tables(spark, SF_SMALL)
    path = os.path.join(scratch, "txn_csv")
    sinks.write_csv(t, path)
    back = read_transactions_csv(spark, path)
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in t.schema]
    assert back.exceptAll(t).count() == 0 and t.exceptAll(back).count() == 0
    # unparsable cells become NULL instead of failing the job
    bad = os.path.join(scratch, "bad.csv")
    with open(bad, "w") as f:
        f.write(",".join(TRANSACTION_COLUMNS) + "\n")
        for cells in ({"transaction_date": "2024-13-45", "transaction_id": "abc", "customer_id": "7", "quantity": "NA",
                       "net_revenue": "12.5"},
                      {"transaction_date": "20240131", "transaction_id": "10.0", "customer_id": "9007199254740993"},
                      {"transaction_date": "2024/1/5", "transaction_id": "10.5", "sold_price_level": "4.0"}):
            f.write(",".join(cells.get(c, "") for c in TRANSACTION_COLUMNS) + "\n")
    r, s, u = read_transactions_csv(spark, bad).collect()
    assert r["transaction_date"] is None and r["transaction_id"] is None
    assert r["customer_id"] == 7 and r["quantity"] is None and float(r["net_revenue"]) == 12.5
    assert str(s["transaction_date"]) == "2024-01-31" and s["transaction_id"] == 10
    assert s["customer_id"] == 9007199254740993  # no digit lost
    assert str(u["transaction_date"]) == "2024-01-05" and u["transaction_id"] is None and u["sold_price_level"] == 4


def test_missing_column_is_an_error(spark, scratch):
    path = os.path.join(scratch, "short.csv")
    with open(path, "w") as f:
        f.write("transaction_date,transaction_id\n2024-01-01,1\n")
    with pytest.raises(ValueError, match="no column"):
        read_transactions_csv(spark, path)


def test_report_and_audience_export(spark, make_txn, scratch):
    df = spark.createDataFrame([(1, "MVC"), (2, "Mass"), (3, "MVC")], "customer_id long, segment string")
    sinks.write_report(df, os.path.join(scratch, "report"))
    assert spark.read.parquet(os.path.join(scratch, "report")).count() == 3
    out = os.path.join(scratch, "audiences")
    sinks.export_audiences(df, out)
    assert sorted(d for d in os.listdir(out) if d.startswith("segment=")) == \
        ["segment=MVC", "segment=Mass"]
    mvc = spark.read.option("header", True).csv(os.path.join(out, "segment=MVC"))
    assert sorted(int(r[0]) for r in mvc.collect()) == [1, 3]


def test_staged_transactions_avoid_customer_shuffle(spark, make_txn, scratch):
    from clientele.operators import features
    t = make_txn([line(customer_id=c, transaction_id=c) for c in range(20)])
    sinks.stage_transactions(t, os.path.join(scratch, "staged"), table="staged_txn_test",
                             buckets=4)
    staged = spark.table("staged_txn_test")
    assert staged.count() == 20
    plan = staged.groupBy("customer_id").agg(F.sum("net_revenue"))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan
    assert features.lrfmpv_base(staged).count() == 20


def test_intermediate_lrfmpv_table_feeds_churn_base(spark, scratch):
    """S4: the LRFMPV table written as a report is read back by a later job."""
    from clientele.operators import churn, features
    from clientele.plans.catalog import txn
    t = txn(spark, SF_SMALL)
    base = features.lrfmpv_base(t)
    path = os.path.join(scratch, "lrfmpv")
    sinks.write_report(base, path)
    direct = churn.customer_churn_base(base, t)
    via_file = churn.customer_churn_base(spark.read.parquet(path), t)
    assert direct.exceptAll(via_file).count() == 0 and via_file.exceptAll(direct).count() == 0


def test_export_of_one_segment_leaves_the_others(spark, scratch):
    first = spark.createDataFrame([(1, "MVC"), (2, "Mass"), (3, "MVC")], "customer_id long, segment string")
    out = os.path.join(scratch, "audiences")
    one = sinks.export_audiences(first, out)
    two = sinks.export_audiences(spark.createDataFrame([(9, "MVC")], first.schema), out)
    read = lambda: sorted((int(r["customer_id"]), r["segment"]) for r in spark.read.option("header", True).csv(out).collect())
    assert read() == [(2, "Mass"), (9, "MVC")]
    runs = {(r["run"], r["segment"]): r["customers"] for r in sinks.read_manifest(spark, out).collect()}
    assert runs == {(one, "MVC"): 2, (one, "Mass"): 1, (two, "MVC"): 1}
    sinks.export_audiences(spark.createDataFrame([(5, "New")], first.schema), out, replace_all=True)
    assert read() == [(5, "New")]


def test_rejected_cells_and_lines_are_reported(spark, scratch):
    from clientele.sources.transactions import csv_rejects, reject_counts
    bad = os.path.join(scratch, "bad.csv")
    with open(bad, "w") as f:
        f.write(",".join(TRANSACTION_COLUMNS) + "\n")
        for cells in ({"transaction_date": "2024-13-45", "transaction_id": "abc", "customer_id": "7", "quantity": "NA"},
                      {"transaction_date": "20240131", "transaction_id": "10.0", "category": "any text"},
                      {"transaction_date": "2024/1/5", "transaction_id": "10.5", "quantity": " "}):
            f.write(",".join(cells.get(c, "") for c in TRANSACTION_COLUMNS) + "\n")
        f.write("2024-01-01,5\n")
    rejects = csv_rejects(spark, bad).collect()
    cells = sorted((r["column"], r["value"]) for r in rejects if r["column"])
    assert cells == [("transaction_date", "2024-13-45"), ("transaction_id", "10.5"), ("transaction_id", "abc")]
    assert [r["value"] for r in rejects if r["column"] is None] == ["2024-01-01,5"]
    assert all(r["file"].endswith("bad.csv") for r in rejects)
    counts = {r["column"]: r["rejected"] for r in reject_counts(csv_rejects(spark, bad)).collect()}
    assert counts == {"transaction_date": 1, "transaction_id": 2, None: 1}
    assert read_transactions_csv(spark, bad).count() == 4


def test_changed_source_files_are_staged_anew(spark, scratch):
    from clientele.plans import catalog
    for t in ("lineitem", "orders", "part"):  # tables as folders: a nested file changes
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").limit(400).coalesce(1).write.parquet(f"{scratch}/{t}.parquet")
    before = catalog.txn(spark, scratch).count()
    old = catalog._staged(spark, scratch)[0]
    assert catalog._staged(spark, scratch)[0] == old
    spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").limit(7).coalesce(1).write.mode("append").parquet(f"{scratch}/lineitem.parquet")
    assert catalog.txn(spark, scratch).count() == before + 7
    assert not os.path.exists(old.removeprefix("file:"))


def test_staging_takes_more_tasks_for_more_input(spark):
    from clientele.plans import catalog
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    with catalog._tasks_for(spark, 1000 * catalog.SOURCE_BYTES):
        assert spark.conf.get(name) == "1000"
    assert spark.conf.get(name) == before
    with catalog._tasks_for(spark, 1):
        assert spark.conf.get(name) == before
