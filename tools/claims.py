"""Measure the reference's storage/read claims on the driver's orders table.

    python tools/claims.py [sf_dir]

Prints CSV vs Parquet size and full-read time, and the time of a one-year
read of a year-partitioned copy vs the whole copy.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from strata.plans.catalog import ORDERS_CSV_SCHEMA  # noqa: E402
from strata.session import local_session, scratch_path  # noqa: E402
from strata.sinks.files import write_csv, write_parquet  # noqa: E402
from strata.sources.files import read_csv, read_parquet, table  # noqa: E402
from strata.sources.fs import total_size  # noqa: E402


def _best(fn, n=3):
    out = []
    for _ in range(n):
        t = time.perf_counter()
        fn()
        out.append(time.perf_counter() - t)
    return min(out)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    o = table(spark, sf_dir, "orders")
    csv_dir, pq_dir, part_dir = (scratch_path(spark, x) for x in ("c", "p", "y"))
    write_csv(o, csv_dir)
    write_parquet(o, pq_dir)
    write_parquet(o.withColumn("o_year", F.year("o_orderdate")), part_dir, partition_by=["o_year"])
    size = {k: total_size(spark, p) for k, p in
            (("csv", csv_dir), ("parquet", pq_dir))}

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    t_csv = _best(lambda: noop(read_csv(spark, csv_dir, ORDERS_CSV_SCHEMA, multiline=False)))
    t_pq = _best(lambda: noop(read_parquet(spark, pq_dir)))
    t_all = _best(lambda: noop(read_parquet(spark, part_dir)))
    t_one = _best(lambda: noop(read_parquet(spark, part_dir).filter(F.col("o_year") == 1997)))
    print(f"rows {o.count()}  csv {size['csv'] / 1e6:.1f} MB  parquet {size['parquet'] / 1e6:.1f} MB "
          f"(x{size['csv'] / size['parquet']:.1f})")
    print(f"full read: csv {t_csv:.2f} s  parquet {t_pq:.2f} s (x{t_csv / t_pq:.1f})")
    print(f"partitioned: all years {t_all:.2f} s  one year {t_one:.2f} s (x{t_all / t_one:.1f})")
    spark.stop()


if __name__ == "__main__":
    main()
