from __spark_entry__ import entry, oracle_sql, queries


def test_entry_runs(spark):
    df = entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["customer_id", "first_order", "last_order", "F", "M", "V", "L", "R", "P"]


def test_every_oracle_key_is_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_python_stages_work_from_any_directory(scratch):
    """Workers import the package shipped with addPyFile, not from the cwd."""
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = (
        "import sys; sys.path.insert(0, %r)\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled','false')"
        ".getOrCreate()\n"
        "import __spark_entry__ as E\n"
        "print('ROWS', E.queries()['bgnbd_score'](spark, '/root/testdata/sf0.001').count())\n"
    ) % root
    out = subprocess.run([sys.executable, "-c", script], cwd=scratch, capture_output=True,
                         text=True, timeout=600)
    assert "ROWS 150" in out.stdout, out.stderr[-2000:]
