"""SET-1/FIL-5 id scan, numeric rules, mojibake repair, composite ids, moderation and reprocess filters."""

import json

from pyspark.sql import functions as F

from feedkiln.functions import numeric as N
from feedkiln.functions import text as TX
from feedkiln.operators import canonical, incremental
from feedkiln.sources import landing


def test_post_ids_since(spark, landing_dir):
    def env(ts, ids):
        m = {"page_id": "p"} if ts is None else {"page_id": "p", "run_timestamp": ts}
        return json.dumps({"meta": m, "data": [{"id": i} for i in ids]})
    root = landing_dir({
        "f/p/posts/2024/01/01/a.json": env("2024-01-01T00:00:00", ["1", "2"]),      # before cutoff
        "f/p/posts/2024/01/02/b.json": env("2024-01-02T00:00:00+00:00", ["3", "2", "4"]),
        "f/p/posts/2024/01/03/c.json": env("2024-01-03T00:00:00Z", ["4", "5", "3"]),
        "f/p/posts/2024/01/03/d.json": env(None, ["9"]),                            # no run time: skipped
    })
    envs = landing.parse_envelopes(landing.scan_files(spark, root, "posts"))
    ex = spark.createDataFrame([("5",)], "post_id string")
    out = incremental.post_ids_since(envs, "2024-01-02 00:00:00", ex).orderBy("first_path", "first_pos")
    assert [r.post_id for r in out.collect()] == ["3", "2", "4"]


def test_numeric_rules(spark):
    df = spark.createDataFrame([(-1,), (5,), (3_000_000_000,), (None,)], "n long")
    r = df.select(N.clean_counter(F.col("n")).alias("c"), N.was_capped(F.col("n")).alias("w"),
                  N.missing_to_zero(F.col("n")).alias("z")).collect()
    assert [x.c for x in r] == [None, 5, 2147483647, None]
    assert [x.w for x in r] == [False, False, True, False] and r[3].z == 0


def test_mojibake_and_composite_ids(spark):
    df = spark.createDataFrame([("cafÃ©",), ("café",), ("plain",)], "t string")
    assert [r.f for r in df.select(TX.repair_latin1_mojibake(F.col("t")).alias("f")).collect()] == \
        ["café", "café", "plain"]
    ids = spark.createDataFrame([("123_456",), ("789",)], "c string")
    page, post = canonical.split_composite_id(F.col("c"))
    assert [(r.a, r.b) for r in ids.select(page.alias("a"), post.alias("b")).collect()] == [("123", "456"), (None, None)]


def test_moderation_and_reprocess(spark):
    df = spark.createDataFrame([(1, "published", "v1.0"), (2, "rejected", "v0.9"), (3, "heldForReview", None),
                                (4, None, "v1.0")], "id int, moderation_status string, cleaning_version string")
    assert sorted(r.id for r in incremental.exclude_moderated(df).collect()) == [1, 4]
    assert sorted(r.id for r in incremental.needs_reprocess(df, "v1.0").collect()) == [2, 3]
