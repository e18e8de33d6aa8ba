"""Run in its own process: frame_diff with a hot row, measured from the event log.

Left = lineitem keys plus as many copies of one row as lineitem has rows / 2
(a third of all left rows), spread over the input files; right = lineitem
keys.  Prints the shuffle records written by the diff and the most records
any reduce task read, both from Spark's event log.
"""

import glob
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from baton import frame_diff  # noqa: E402


def session(**conf):
    b = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false") \
        .config("spark.sql.shuffle.partitions", "8").config("spark.sql.adaptive.enabled", "false")
    for k, v in conf.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("OFF")
    return s


def main(sf_dir, work):
    spark = session()
    keys = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber")
    n = keys.count()
    hot = keys.orderBy("l_orderkey", "l_linenumber").limit(1)  # fixture only, not a query
    copies = hot.select("l_orderkey", "l_linenumber", F.explode(F.sequence(F.lit(1), F.lit(n // 2))).alias("c"))
    keys.unionByName(copies.drop("c")).repartition(8).write.parquet(f"{work}/left")
    keys.write.parquet(f"{work}/right")
    spark.stop()

    events = f"{work}/events"
    os.makedirs(events)
    spark = session(**{"spark.eventLog.enabled": "true", "spark.eventLog.dir": events})
    spark.sparkContext.setCheckpointDir(f"{work}/ckpt")
    left, right = spark.read.parquet(f"{work}/left"), spark.read.parquet(f"{work}/right")
    rows = left.count() + right.count()
    out = frame_diff(left, right).collect()
    spark.stop()

    written, read_max = 0, 0
    for path in glob.glob(f"{events}/**/events_*", recursive=True):
        with open(path, "rb") as fh:
            raw = fh.read()
        if path.endswith(".zstd"):
            import zstandard
            raw = zstandard.ZstdDecompressor().stream_reader(raw).read()
        for line in raw.decode("utf-8").splitlines():
            if line:
                e = json.loads(line)
                if e.get("Event") != "SparkListenerTaskEnd":
                    continue
                m = e.get("Task Metrics") or {}
                written += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Records Written", 0)
                read = m.get("Shuffle Read Metrics") or {}
                read_max = max(read_max, read.get("Total Records Read", 0))
    print(json.dumps({"input_rows": rows, "hot_copies": n // 2, "shuffle_records_written": written,
                      "max_records_read_by_one_task": read_max,
                      "diff": [[r[0], r[1], r["side"], r["n"]] for r in out]}))


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2])
