from pathlib import Path

import pytest

import __spark_entry__ as entry
import compare
from tidemill.plans import catalog

ROOT = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(ROOT).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return compare.connect(ROOT)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, con, name):
    assert not compare.compare(spark, con, ROOT, name).startswith("DIFFERENT")


def test_entry_and_conservation(spark):
    assert entry.entry(spark).count() > 0
    q = entry.queries()
    total = q["overall_corpus_summary"](spark, ROOT).first()
    by_post = q["high_signal_rate_by_post"](spark, ROOT).agg({"comments": "sum", "high_signal": "sum"}).first()
    assert total.comments == by_post["sum(comments)"] and q["social_signal_counters"](spark, ROOT).first().high_signal == by_post["sum(high_signal)"]
    assert set(entry.oracle_sql()) <= set(q)


def test_same_rows_whatever_the_partitions(spark):
    q = entry.queries()["queue_positions"]
    rows = []
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        rows.append(sorted(map(tuple, q(spark, ROOT).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert rows[0] == rows[1]
