from conftest import line

from clientele.operators import cohort


def test_cohort_skipped_month_and_labels(spark, make_txn):
    rows = []
    # 8 customers start in January; 1 comes back in March (February skipped)
    for c in range(8):
        rows.append(line(customer_id=c, transaction_id=c, date="2024-01-15"))
    rows.append(line(customer_id=0, transaction_id=100, date="2024-03-02"))
    # a cancelled line does not count
    rows.append(line(customer_id=1, transaction_id=101, date="2024-02-02", status="Cancelled"))
    counts = cohort.cohort_counts(make_txn(rows))
    ret = {(str(r["cohort_month"]), r["cohort_index"]): r
           for r in cohort.cohort_retention(counts).collect()}
    assert set(ret) == {("2024-01-01", 0), ("2024-01-01", 2)}
    assert ret[("2024-01-01", 0)]["retention_rate"] == 1.0
    assert ret[("2024-01-01", 0)]["retention_label"] == "100%"
    assert ret[("2024-01-01", 2)]["retention_label"] == "12.5%"
    wide = cohort.cohort_matrix(cohort.cohort_retention(counts)).collect()[0].asDict()
    assert wide["0"] == 1.0 and wide["2"] == 0.125 and "1" not in wide


def test_percent_label_rounds_half_to_even(spark):
    from pyspark.sql import functions as F
    from clientele.functions.dates import pct_label_from_tenths, pct_tenths
    df = spark.createDataFrame([(1, 16), (3, 16), (1, 3), (2, 3), (0, 5)], "n long, d long")
    got = [r[0] for r in df.select(pct_label_from_tenths(pct_tenths(F.col("n"), F.col("d"))))
           .collect()]
    assert got == ["6.2%", "18.8%", "33.3%", "66.7%", "0%"]
