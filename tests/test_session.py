"""Scores survive a second session in one process, and a = 1."""

import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from clientele.operators import btyd


def test_two_sessions_from_another_folder(tmp_path):
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from pyspark.sql import SparkSession\n"
        "import __spark_entry__ as E\n"
        "for _ in range(2):\n"
        "    s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "    n = E.queries()['bgnbd_score'](s, '/root/testdata/sf0.001').count()\n"
        "    s.stop()\n"
        "print('ROWS', n)\n") % str(__file__).rsplit("/tests/", 1)[0]
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "ROWS" in out.stdout, out.stderr[-2000:]


def test_expected_transactions_pass_through_a_equal_one(spark):
    df = spark.createDataFrame([(0, 0.0, 100.0), (3, 40.0, 90.0)], "x long, t_x double, t_cal double")

    def value(a):
        pr = btyd.BGNBDParams(r=0.243, alpha=4.414, a=a, b=2.426)
        e = btyd.expected_transactions_expr(pr, 30.0, F.col("x"), F.col("t_x"), F.col("t_cal"))
        return [r[0] for r in df.select(e).collect()]

    at = value(1.0)
    for a in (1.0 - 1e-9, 1.0 + 1e-9):
        assert value(a) == pytest.approx(at, rel=1e-6)
    assert value(1.001) == pytest.approx(at, rel=1e-2) and value(0.999) == pytest.approx(at, rel=1e-2)
