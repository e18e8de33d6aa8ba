"""Run from outside the repository, as the driver does: the module is
loaded by path and executors have no copy of the package on their path."""

import importlib.util
import os
import sys

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    spec = importlib.util.spec_from_file_location("entry_under_test", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    assert mod.entry(spark).count() == 6000
    for name in ("rdd_pickle_handover", "rdd_handover", "snapshot_json_events", "rows_per_file"):
        assert mod.queries()[name](spark, sys.argv[1]).count() > 0, name
    print("FOREIGN-OK")
    spark.stop()


if __name__ == "__main__":
    main()
