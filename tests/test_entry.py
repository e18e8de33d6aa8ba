"""Driver contract: entry, query registry and the DuckDB oracle gate."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from baton.plans import catalog
from tests.conftest import SF001
from tools.check_oracle import canon, duck


def test_entry_runs_on_sf0001(spark):
    df = E.entry(spark)
    assert df.columns == ["l_orderkey", "l_linenumber", "quantity_x2"]
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    assert df.count() == li.count() == 6000
    assert df.groupBy().sum("quantity_x2").first()[0] == 2 * li.groupBy().sum("l_quantity").first()[0]


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(catalog.queries()) <= set(E.queries()) and set(catalog.oracle_sql()) <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, con, name):
    df = catalog.queries()[name](spark, SF001)
    rows, cols = df.collect(), df.columns
    cur = con.execute(catalog.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(cols) == sorted(dcols)
    assert len(rows) == len(drows)
    assert canon(cols, rows) == canon(dcols, drows)


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastExchange",
             "GlobalLimit", "CollectLimit", "Sample")


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_plans_have_no_cross_join_broadcast_or_cap(spark, name, monkeypatch):
    # the final frame's plan, and the plans of everything the query wrote on its way
    from pyspark.sql import DataFrameWriter

    from baton.plans import plan_text
    texts = []
    for kind in ("parquet", "text"):
        write = getattr(DataFrameWriter, kind)

        def recorded(self, *args, write=write, **kwargs):
            texts.append(plan_text(self._df, "simple"))
            return write(self, *args, **kwargs)

        monkeypatch.setattr(DataFrameWriter, kind, recorded)
    texts.append(plan_text(catalog.queries()[name](spark, "/root/testdata/sf0.001"), "simple"))
    # a diff broadcasts the digests that differ, after it has counted them
    allowed = {"BroadcastExchange"} if name.startswith("handover_diff") or name.startswith("handover_verify") else set()
    for text in texts:
        assert not [w for w in FORBIDDEN if w in text and w not in allowed], text


def test_entry_works_from_another_folder(tmp_path):
    import os
    import subprocess
    import sys
    script = os.path.join(os.path.dirname(__file__), "scripts", "foreign_cwd.py")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, script, "/root/testdata/sf0.001"], cwd=str(tmp_path),
                         env=env, capture_output=True, text=True, timeout=600)
    assert "FOREIGN-OK" in out.stdout, out.stderr[-3000:]
