"""Landing-zone benchmark: JOB-1 over real envelope files derived from the supplied tables.

``orders`` become posts (page = customer) and ``lineitem`` rows become their
comments, written by Spark as JSON-lines envelope files (SNK-1, batches of at
most about 100 records) in a fresh folder under the shared checkpoint root,
then loaded end to end (scan, parse, validate, dead letter, dedup, upsert).

    python tools/bench_landing.py [sf_dir]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from feedkiln import session  # noqa: E402
from feedkiln.functions import timefn as TF  # noqa: E402
from feedkiln.plans import jobs  # noqa: E402
from feedkiln.sources import landing  # noqa: E402
from feedkiln.sources.tables import table  # noqa: E402

RUN_TS = "2026-09-01 00:00:00"
# The order dates (1995-2001) predate the 2004 content-time floor (FIL-8), so
# the derived feed is shifted forward by this many years.
SHIFT_YEARS = 25


def land(spark, sf_dir: str, root: str) -> dict:
    shift = F.make_ym_interval(F.lit(SHIFT_YEARS), F.lit(0))
    o = table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate") + shift)
    li = table(spark, sf_dir, "lineitem").withColumn("l_shipdate", F.col("l_shipdate") + shift)
    posts = o.select(F.col("o_custkey").cast("string").alias("page"), F.lit("posts").alias("entity"),
                     F.to_date("o_orderdate").alias("day"), F.col("o_orderkey").alias("rid"),
                     F.struct(F.col("o_orderkey").cast("string").alias("id"),
                              TF.iso_utc(F.col("o_orderdate")).alias("created_time"),
                              F.col("o_orderpriority").alias("message"),
                              F.struct(F.struct(F.col("o_totalprice").cast("long").alias("total_count")).alias("summary"))
                              .alias("shares")).alias("rec"))
    comments = li.join(o.select("o_orderkey", "o_custkey"), li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").cast("string").alias("page"), F.lit("comments").alias("entity"),
        F.to_date("l_shipdate").alias("day"), F.col("l_orderkey").cast("string").alias("post"),
        F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("rid"),
        F.struct(F.concat_ws("_", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
                 TF.iso_utc(F.col("l_shipdate")).alias("created_time"),
                 F.concat_ws(" ", "l_returnflag", "l_linestatus", F.col("l_quantity").cast("string")).alias("message"),
                 F.struct(F.col("l_suppkey").cast("string").alias("id")).alias("from"),
                 F.struct(F.struct(F.col("l_quantity").cast("long").alias("total_count")).alias("summary"))
                 .alias("reaction_like")).alias("rec"))
    meta_run = TF.iso_utc(F.lit(RUN_TS).cast("timestamp"))
    n = {}
    for name, df, keys, meta in (
            ("posts", posts, ["page", "entity"], {"page_id": F.col("page"), "source_type": F.lit("posts")}),
            ("comments", comments, ["page", "entity", "post"],
             {"page_id": F.col("page"), "post_id": F.col("post"), "source_type": F.lit("comments")})):
        b = landing.batch_records(df, keys, "rid")
        env = landing.build_envelopes(b, keys, {**meta, "run_timestamp": meta_run}, F.col("rec"), F.col("rid"))
        landing.write_landing(env.withColumn("platform", F.lit("facebook")), root, ["platform", "entity"])
        n[name] = df.count()
    return n


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = session.get_session(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    root = session.scratch_path(spark, "bench-landing")
    t0 = time.time()
    n = land(spark, sf_dir, root)
    t1 = time.time()
    wh = jobs.Warehouse(spark, session.scratch_path(spark, "bench-warehouse"))
    rep = jobs.load_landing(spark, root, wh, "bench", RUN_TS, one_envelope_per="line")
    t2 = time.time()
    print(json.dumps({"sf": sf_dir, "records": n, "land_sec": round(t1 - t0, 2), "load_sec": round(t2 - t1, 2),
                      "records_per_sec": round(sum(n.values()) / (t2 - t1)), "counts": rep.counts}))


if __name__ == "__main__":
    main()
