"""Derive a k-times larger copy of the driver tables (keys shifted per copy), for scale trials.

    python tools/upscale.py <sf_dir> <k> <out_dir>

Each table is written as a folder of Parquet files (``<name>.parquet/part-*``),
which the queries read like the single-file originals.  Lookup tables
(nation, region) are copied unchanged; the text tables are copied as they are.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from strata.session import local_session  # noqa: E402
from strata.sources.files import table  # noqa: E402

# table -> {key column: key space it belongs to}
KEYS = {
    "customer": {"c_custkey": "cust"},
    "orders": {"o_orderkey": "order", "o_custkey": "cust"},
    "lineitem": {"l_orderkey": "order", "l_partkey": "part", "l_suppkey": "supp"},
    "part": {"p_partkey": "part"},
    "supplier": {"s_suppkey": "supp"},
    "events": {"event_id": "event", "user_id": "cust"},
}
SPACE_OF = {"cust": ("customer", "c_custkey"), "order": ("orders", "o_orderkey"),
            "part": ("part", "p_partkey"), "supp": ("supplier", "s_suppkey"),
            "event": ("events", "event_id")}


def main() -> None:
    sf_dir, k, out = sys.argv[1], int(sys.argv[2]), sys.argv[3]
    spark = local_session(8)
    span = {s: table(spark, sf_dir, t).agg(F.max(c)).first()[0] + 1 for s, (t, c) in SPACE_OF.items()}
    for name in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations"]:
        df = table(spark, sf_dir, name)
        if name in KEYS:
            # each row k times (a generator, not a join), keys shifted per copy
            df = df.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
            df = df.withColumns({c: F.col(c) + F.col("copy") * F.lit(span[s])
                                 for c, s in KEYS[name].items()}).drop("copy")
        n_files = max(1, k * 2) if name in KEYS else 1
        df.repartition(n_files).write.mode("overwrite").parquet(f"{out}/{name}.parquet")
        print(name, spark.read.parquet(f"{out}/{name}.parquet").count())
    spark.stop()


if __name__ == "__main__":
    main()
