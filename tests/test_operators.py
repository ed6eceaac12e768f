"""Merges, incremental state, windows, flags, scoring and reply trees (golden cases)."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from feedkiln import schemas
from feedkiln.functions import text as TX
from feedkiln.operators import checks, incremental, marts, merge, quality, scoring
from feedkiln.operators.dedup import latest_per_key, overlay

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


# ---------------------------------------------------------------- merges

def test_upsert_insert_update_idempotent(spark):
    tgt = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, s string, n int")
    src = spark.createDataFrame([(2, "B", None), (3, "c", 30)], "k int, s string, n int")
    once = merge.upsert(tgt, src, ["k"])
    assert rows(once, "k", "s", "n") == [(1, "a", 10), (2, "B", None), (3, "c", 30)]
    twice = merge.upsert(once, src, ["k"])
    assert rows(twice, "k", "s", "n") == rows(once, "k", "s", "n")
    empty = spark.createDataFrame([], "k int, s string, n int")
    assert rows(merge.upsert(tgt, empty, ["k"]), "k", "s", "n") == rows(tgt, "k", "s", "n")


def test_upsert_columns_and_insert_only(spark):
    tgt = spark.createDataFrame([(1, "a", 10)], "k int, s string, n int")
    src = spark.createDataFrame([(1, "A", 11), (2, "b", 20)], "k int, s string, n int")
    m = merge.upsert_columns(tgt, src, ["k"], ["n"], updated_at=F.lit("2024-01-01").cast("timestamp"))
    assert rows(m, "k", "s", "n") == [(1, "a", 11), (2, "b", 20)]
    ins = merge.merge_insert_only(tgt, src, ["k"])
    assert rows(ins, "k", "s", "n") == [(1, "a", 10), (2, "b", 20)]
    assert merge.insert_only(ins, src, ["k"]).count() == 0


def test_versioned_table(spark, tmp_path):
    schema = schemas.STATE
    vt = merge.VersionedTable(spark, str(tmp_path / "state"), schema)
    vt.create_if_missing()
    assert vt.current_version() == 0 and vt.read().count() == 0
    row = ("p", "x", T0, 1, 0, 0, 0, 0, 0, 0)
    src = spark.createDataFrame([row], schema)
    assert vt.upsert(src, ["page_id", "post_id"]) == 1
    assert vt.upsert(src, ["page_id", "post_id"]) == 1
    assert vt.read().count() == 1 and vt.current_version() == 2
    assert vt.upsert(spark.createDataFrame([], schema), ["page_id", "post_id"]) == 0


def test_high_water(spark):
    src = spark.createDataFrame([(1, T0), (2, T0 + dt.timedelta(hours=1))], "id int, ts timestamp")
    tgt = spark.createDataFrame([(1, T0)], "id int, ts timestamp")
    assert rows(merge.high_water_filter(src, tgt, "ts", "ts"), "id") == [(2,)]
    empty = spark.createDataFrame([], "id int, ts timestamp")
    assert merge.high_water_filter(src, empty, "ts", "ts").count() == 2


# ---------------------------------------------------------------- incremental

def test_change_detection_and_split(spark):
    cols = ["page_id", "post_id", "comment_count", *schemas.REACTION_COLUMNS]
    state = spark.createDataFrame([("p", "1", 1, 0, 0, 0, 0, 0, 0), ("p", "2", 0, 0, 0, 0, 0, 0, 0),
                                   ("p", "3", None, 5, 0, 0, 0, 0, 0)], ", ".join(f"{c} {'string' if c.endswith('id') else 'long'}" for c in cols))
    snap = spark.createDataFrame([("p", "1", 2, 0, 0, 0, 0, 0, 0), ("p", "2", 0, 0, 0, 0, 0, 0, 0),
                                  ("p", "3", 0, 5, 0, 0, 0, 0, 0), ("p", "4", 0, 0, 0, 0, 0, 0, 0)], state.schema)
    changed = incremental.changed_rows(snap, state, ["page_id", "post_id"])
    assert rows(changed, "post_id") == [("1",)]  # missing counter == 0 is no change
    new, known = incremental.split_new_known(snap, state, ["page_id", "post_id"])
    assert rows(new, "post_id") == [("4",)] and known.count() == 3
    assert incremental.changed_rows(state, state, ["page_id", "post_id"]).count() == 0


def test_snapshot_diff(spark):
    old = spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "k int, v int")
    new = spark.createDataFrame([(1, 1), (2, 9), (4, 4)], "k int, v int")
    d = incremental.snapshot_diff(old, new, ["k"], ["v"])
    assert rows(d, "k", "status") == [(1, "unchanged"), (2, "changed"), (3, "removed"), (4, "new")]


def test_window_and_since_bounds(spark):
    run = "2024-01-31 00:00:00"
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 24)), (2, dt.datetime(2024, 1, 23, 23, 59, 59)),
                                (3, None)], "id int, ts timestamp")
    assert rows(incremental.active_window(df, "ts", run, 7), "id") == [(1,)]
    assert incremental.active_window(df, "ts", run, None).count() == 3
    since = incremental.buffered_since(F.lit("2024-01-24 00:10:00").cast("timestamp"))
    assert rows(incremental.since_filter(df, "ts", since), "id") == [(1,)]
    assert incremental.since_filter(df, "ts", None).count() == 3


def test_state_migration(spark):
    raw = spark.createDataFrame([('{"last_loaded_at": "2024-01-01T00:00:00+00:00", "known_posts": {"p": '
                                  '{"a": "2023-12-01T00:00:00Z", "b": {"created_time": "2023-12-02T00:00:00Z",'
                                  ' "comment_count": 4, "reaction_like": 2}}}}',)], "state_json string")
    st = incremental.migrate_state_json(raw)
    got = {r.post_id: r for r in st.collect()}
    assert got["a"].comment_count == 0 and got["a"].created_time.year == 2023
    assert got["b"].comment_count == 4 and got["b"].reaction_like == 2 and got["b"].reaction_angry == 0


def test_first_seen_ids(spark):
    df = spark.createDataFrame([("x", 2, 1), ("y", 1, 2), ("x", 1, 3), ("z", 0, 4)], "id string, t int, n int")
    ex = spark.createDataFrame([("z",)], "id string")
    out = incremental.first_seen_ids(df, "id", ["t", "n"], ex)
    assert rows(out, "id", "first_t", "first_n") == [("x", 1, 3), ("y", 1, 2)]


def test_page_ids(spark):
    pages = spark.createDataFrame([("a",), ("b",), ("c",)], "page_id string")
    assert rows(incremental.page_subset(pages, "page_id", [" a", "", "b "]), "page_id") == [("a",), ("b",)]
    import pytest
    with pytest.raises(ValueError):
        incremental.page_subset(pages, "page_id", [" ", ""])


# ---------------------------------------------------------------- windows and flags

def test_spam_window_inclusive(spark):
    h24 = dt.timedelta(hours=24)
    data = [(1, "p", "same", T0), (2, "p", "same", T0 + h24),          # exactly 24 h: flagged
            (3, "q", "same", T0), (4, "q", "same", T0 + h24 + dt.timedelta(seconds=1)),  # 24 h + 1 s: not
            (5, "p", None, T0), (6, "p", None, T0)]                     # no text: never
    df = spark.createDataFrame(data, "id int, post string, text string, ts timestamp")
    out = dict(rows(quality.spam_suspected(df, "post", "text", "ts"), "id", "spam_suspected"))
    assert out == {1: True, 2: True, 3: False, 4: False, 5: False, 6: False}


def test_bot_threshold(spark):
    base = [(i, "a", T0 + dt.timedelta(seconds=i)) for i in range(51)]            # 51 in an hour
    base += [(100 + i, "b", T0 + dt.timedelta(seconds=i)) for i in range(50)]    # 50 in an hour
    df = spark.createDataFrame(base, "id int, author string, ts timestamp")
    out = quality.bot_suspected(df, ["author"], "ts", 3600, 50)
    flags = {r.author: r.bot_suspected for r in out.select("author", "bot_suspected").distinct().collect()}
    assert flags == {"a": True, "b": False}


def test_range_count_matches_bruteforce(spark):
    import random
    rnd = random.Random(7)
    data = [(i, rnd.choice("ab"), T0 + dt.timedelta(minutes=rnd.randint(0, 3000))) for i in range(300)]
    df = spark.createDataFrame(data, "id int, k string, ts timestamp")
    got = dict(rows(quality.range_count(df, ["k"], "ts", 7200, 1800, bucket_s=2000), "id", "range_count"))
    for i, k, t in data:
        want = sum(1 for _, k2, t2 in data if k2 == k and t - dt.timedelta(seconds=7200) <= t2 <= t + dt.timedelta(seconds=1800))
        assert got[i] == want


def test_text_flags(spark):
    texts = ["two words", "three words here", "https://x.example/a", "see https://x.example/a",
             "\U0001F600" * 4 + "a", "\U0001F600" * 5 + "a", "  spaced\n\ttext  here ", "", None,
             "\U0001F468‍\U0001F469"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    c = TX.clean_ws(F.col("t"))
    out = {r.i: r for r in df.select("i", c.alias("c"), TX.too_short(c).alias("short"), TX.url_only(c).alias("url"),
                                     TX.high_emoji_ratio(c).alias("emoji"),
                                     TX.flags_csv(quality.text_flags(c)).alias("flags")).collect()}
    assert out[0].short and not out[1].short
    assert out[2].url and not out[3].url
    assert not out[4].emoji and out[5].emoji      # 80 % is not > 80 %, 83 % is
    assert out[6].c == "spaced text here" and out[7].c is None and out[8].c is None
    assert out[9].emoji                            # joiner counts in neither side
    assert out[1].flags is None and out[0].flags == "too_short"


def test_cleaning_rules(spark):
    df = spark.createDataFrame([("a &amp;lt; b &quot;c&quot; &copy;",), ("éte​",), ("x" * 10001,),
                                ("<p>hi <b>there</b></p>",), ("RT @bob: hello 2:34 https://t.co/abc",)], "t string")
    r = df.select(TX.decode_basic_entities(F.col("t")).alias("basic"), TX.decode_entities(F.col("t")).alias("full"),
                  TX.clean_text(F.col("t")).alias("clean"), TX.was_truncated(F.col("t")).alias("trunc"),
                  TX.strip_markup(F.col("t")).alias("nomarkup"),
                  TX.clean_ws(TX.strip_tco_links(TX.strip_time_marks(TX.strip_retweet_prefix(F.col("t"))))).alias("social")
                  ).collect()
    assert r[0].basic == 'a &lt; b "c" &copy;' and r[0].full == 'a &lt; b "c" ©'
    assert r[1].clean == "éte"               # NFC and zero-width removed
    assert len(r[2].clean) == 10000 and r[2].trunc
    assert r[3].nomarkup == "hi there"
    assert r[4].social == "hello"


# ---------------------------------------------------------------- checks, scoring, marts

def test_data_tests(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "z")], "k int, v string")
    res = {r.test_name: r.failures for r in checks.suite(
        checks.unique_test(df, ["k"], "u"), checks.not_null_test(df, "v", "nn"),
        checks.accepted_values_test(df, "v", ["a", "b"], "av")).collect()}
    assert res == {"u": 1, "nn": 1, "av": 1}
    parent = spark.createDataFrame([(1,)], "k int")
    keep, orphans = checks.referential_split(df, parent, "k", "k")
    assert keep.count() == 3 and rows(orphans, "k") == [(2,)]


def test_reaction_flag_bounds(spark):
    df = spark.createDataFrame([(0, 0, 0), (1, 0, 5), (1, 0, 4), (21, 0, 100), (20, 0, 100)], "a int, s int, t int")
    out = [r.f for r in df.select(scoring.reaction_flag(F.col("a"), F.col("s"), F.col("t")).alias("f")).collect()]
    assert out == [False, False, True, True, False]


def test_scoring_contract_and_bookkeeping(spark):
    docs = spark.createDataFrame([(1, "great good day"), (2, "bad awful thing"), (3, "plain words only")],
                                 "id long, text string")
    calls = []

    def factory():
        base = scoring.LexiconScorer()

        def score(batch):
            calls.append(len(batch))
            return base(batch)
        return score

    s = scoring.score_batches(docs.coalesce(1), "id", "text", factory, batch_size=2)
    got = {r.id: (r.sentiment_label, r.confidence_score) for r in s.collect()}
    assert got[1][0] == "positive" and got[2][0] == "negative" and got[3] == ("neutral", 0.5)
    sql = {r.id: r.sentiment_label for r in scoring.lexicon_scores(docs, "id", "text").collect()}
    assert sql == {k: v[0] for k, v in got.items()}
    res = scoring.result_rows(s, "comment", "id", None, "2024-01-01 00:00:00")
    again = merge.insert_only(res, res, ["source_id", "source_type", "model_name"])
    assert again.count() == 0
    dist = {r.sentiment_label: r.share for r in scoring.label_distribution(s).collect()}
    assert abs(sum(dist.values()) - 1) < 1e-5  # shares are rounded to 6 places
    alert = scoring.negative_alert(s).collect()[0]
    assert not alert.alert and abs(alert.negative_share - 1 / 3) < 1e-6


def test_reply_depth(spark):
    nodes = spark.createDataFrame([("r", None), ("a", "r"), ("b", "a"), ("c", "b"), ("d", "gone"),
                                   ("x", "y"), ("y", "x")], "id string, parent string")
    out = {r.id: (r.root_id, r.depth, r.dangling) for r in marts.reply_depth(nodes, "id", "parent").collect()}
    assert out["r"] == ("r", 0, False) and out["a"] == ("r", 1, False)
    assert out["b"] == ("r", 2, False) and out["c"] == ("r", 3, False)
    assert out["d"] == ("d", 0, True)
    assert out["x"][0] is None and out["y"][1] is None     # a cycle never resolves
    # a hot root, a long chain, and a branch that hangs on a cycle
    rows_ = [("h", None)] + [(f"h{i}", "h") for i in range(300)] + [("n0", None)] + [(f"n{i}", f"n{i - 1}") for i in range(1, 70)]
    rows_ += [("p", "q"), ("q", "p"), ("t", "q")]
    out = {r.id: (r.root_id, r.depth) for r in marts.reply_depth(spark.createDataFrame(rows_, "id string, parent string"), "id", "parent").collect()}
    assert len(out) == len(rows_) and out["h7"] == ("h", 1) and out["n69"] == ("n0", 69) and out["t"] == (None, None)


def test_overlay_and_latest(spark):
    prev = spark.createDataFrame([(1, "old"), (2, "keep")], "k int, v string")
    new = spark.createDataFrame([(1, "new")], "k int, v string")
    assert rows(overlay(prev, new, ["k"]), "k", "v") == [(1, "new"), (2, "keep")]
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 2, "c")], "k int, t int, v string")
    assert rows(latest_per_key(df, ["k"], ["t", "v"]), "v") == [("c",)]


DAYS = "k long, t timestamp, v string"


def _day_files(path):
    return {str(p): p.stat().st_mtime_ns for p in (path / "data").rglob("*.parquet")}


def _many_days(spark, path):
    table = merge.DayTable(spark, str(path), spark.createDataFrame([], DAYS).schema, ["k"], "t")
    many = [(i, dt.datetime(2023, 1, 1) + dt.timedelta(days=i % 70), "a") for i in range(140)]
    assert table.upsert(spark.createDataFrame(many, DAYS)) == 140
    return table


def test_one_day_into_many_rewrites_one_day(spark, tmp_path):
    table = merge.DayTable(spark, str(tmp_path / "none"), spark.createDataFrame([], DAYS).schema, ["k"], "t")
    assert table.read().count() == 0
    table.create_if_missing()
    table.create_if_missing()
    assert (tmp_path / "none" / "data" / "_SUCCESS").exists() and table.read().count() == 0 and table.upsert(table.read()) == 0
    table = _many_days(spark, tmp_path / "t")
    before = _day_files(tmp_path / "t")
    day = dt.datetime(2023, 3, 5)
    load = spark.createDataFrame([(63, day, "b"), (1000, day, "new")], DAYS)
    table.upsert(load)
    after = _day_files(tmp_path / "t")
    assert {p.rsplit("/", 2)[1] for p in set(before) ^ set(after)} == {"_day=2023-03-05"}
    assert all(after[p] == before[p] for p in set(before) & set(after)) and len(before) >= 70
    got = {r.k: r.v for r in table.read().collect()}
    assert len(got) == 141 and got[63] == "b" and got[1000] == "new" and got[133] == "a"
    table.upsert(load)  # idempotent
    assert {r.k: r.v for r in table.read().collect()} == got
    # a key whose time is corrected leaves its old day; an emptied day goes
    table.upsert(spark.createDataFrame([(63, dt.datetime(2023, 3, 6), "c"), (133, dt.datetime(2023, 3, 6), "c"), (1000, None, "c")], DAYS))
    got = {r.k: (r.t, r.v) for r in table.read().collect()}
    assert len(got) == 141 and got[63] == (dt.datetime(2023, 3, 6), "c") and got[1000] == (None, "c")
    assert not (tmp_path / "t" / "data" / "_day=2023-03-05").exists()


def test_a_load_that_fails_while_days_are_put_in_place(spark, tmp_path, monkeypatch):
    import shutil
    table = _many_days(spark, tmp_path / "t")
    load = spark.createDataFrame([(63, dt.datetime(2023, 3, 5), "b"), (64, dt.datetime(2023, 3, 6), "b")], DAYS)

    def fails(self):  # between the removal of a day and the arrival of its new files
        shutil.rmtree(tmp_path / "t" / "data" / "_day=2023-03-05")
        raise OSError("executor lost")
    monkeypatch.setattr(merge.DayTable, "_put_in_place", fails)
    with pytest.raises(OSError):
        table.upsert(load)
    read = lambda: {r.k: r.v for r in merge.DayTable(spark, str(tmp_path / "t"), table.schema, ["k"], "t").read().collect()}
    assert len(read()) == 140 and read()[63] == read()[64] == "b" and read()[133] == "a"  # the load was committed
    monkeypatch.undo()
    table.upsert(spark.createDataFrame([(1, dt.datetime(2023, 1, 2), "z")], DAYS))  # the next load makes up for it
    assert len(read()) == 140 and read()[63] == read()[64] == "b" and read()[1] == "z"
    assert not (tmp_path / "t" / "pending").exists()
    # a load that fails before its commit leaves nothing
    monkeypatch.setattr(merge, "upsert", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        table.upsert(load.withColumn("v", F.lit("lost")))
    (tmp_path / "t" / "pending" / "rows").mkdir(parents=True, exist_ok=True)
    assert read()[63] == "b" and len(read()) == 140
    monkeypatch.undo()
    assert table.upsert(load) == 2 and read()[63] == "b"


def test_newest_row_wins_whatever_the_order_of_loads(spark, tmp_path):
    rows_ = [[(1, dt.datetime(2024, 1, 1), "v3")], [(1, dt.datetime(2024, 1, 1), "v1"), (2, dt.datetime(2024, 1, 1), "v1")], [(1, dt.datetime(2024, 1, 2), "v2")]]
    for i, order in enumerate(([0, 1, 2], [2, 1, 0], [1, 2, 0])):
        table = merge.DayTable(spark, str(tmp_path / f"t{i}"), spark.createDataFrame([], DAYS).schema, ["k"], "t")
        for j in order:
            table.upsert(spark.createDataFrame(rows_[j], DAYS), newest=["v"])
        assert sorted((r.k, r.v) for r in table.read().collect()) == [(1, "v3"), (2, "v1")]


def test_incremental_model_on_a_stored_table(spark, tmp_path):
    table = _many_days(spark, tmp_path / "t")
    source = spark.createDataFrame([(1, dt.datetime(2023, 2, 5), "old"), (2, dt.datetime(2024, 2, 2), "fresh")], DAYS)
    assert merge.load_incremental(table, source, "t", "t") == 1
    got = {r.k: r.v for r in table.read().collect()}
    assert got[2] == "fresh" and got[1] == "a" and len(got) == 140


def test_a_half_written_version_is_replaced(spark, tmp_path):
    vt = merge.VersionedTable(spark, str(tmp_path / "t"), spark.createDataFrame([], "k long").schema)
    vt.commit(spark.createDataFrame([(1,)], "k long"))
    broken = tmp_path / "t" / "v=1"
    broken.mkdir()
    (broken / "part-0.parquet").write_bytes(b"half")
    assert [r.k for r in vt.read().collect()] == [1]
    assert vt.commit(spark.createDataFrame([(2,)], "k long")) == 1
    assert [r.k for r in vt.read().collect()] == [2]


def test_platform_mappers(spark):
    from pyspark.sql import functions as F
    post = '{"id_str": "7", "created_at": "Wed Oct 10 20:19:24 +0000 2018", "full_text": "t", "user": {"id_str": "u"}, "favorite_count": 3}'
    note = '{"id": "c", "videoId": "v", "parentId": "p", "channelId": "ch", "textDisplay": "x", "publishedAt": "2020-01-02T03:04:05Z", "likeCount": 2}'
    df = spark.createDataFrame([(post, note)], "a string, b string").select(F.parse_json("a").alias("a"), F.parse_json("b").alias("b"))
    p = df.select(*marts.map_microblog_post(F.col("a"), F.lit("f"))).collect()[0]
    assert p.post_id == "twitter_7" and p.created_time == dt.datetime(2018, 10, 10, 20, 19, 24) and p.reaction_like == 3
    c = df.select(*marts.map_video_comment(F.col("b"), F.lit("f"))).collect()[0]
    assert c.comment_id == "youtube_c" and c.post_id == "youtube_v" and c.parent_comment_id == "youtube_p" and c.is_reply


def test_language_of_every_document(spark):
    from feedkiln.operators import language
    docs = spark.createDataFrame([(1, "the and the and", "en"), (2, "der und die und", "de"), (3, "the the", None), (4, "die und", None),
                                  (5, "123", None), (6, None, None)], "id int, text string, lang string")
    out = language.detect_languages(docs, docs.filter("id < 3"), "id", "text", "lang")
    assert rows(out, "id", "detected_language") == [(1, "en"), (2, "de"), (3, "en"), (4, "de"), (5, None), (6, None)]


def test_grams_of_documents_are_not_shuffled(spark):
    from feedkiln.operators import language
    docs = spark.createDataFrame([(1, "the and the and", "en"), (2, "der und die und", "de"), (3, "the the", None), (3, "die", None)],
                                 "id int, text string, lang string")
    profile, langs, floors = language.build_profile(docs, docs.filter("id < 3"), "id", "text", "lang")
    best = language.detect(language.doc_grams(docs, ["id"], "text"), profile, langs, floors, "id")
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [gram" in plan and plan.count("hashpartitioning(gram") == 1  # that of the profile's own sums
    out = language.detect_languages(docs, docs.filter("id < 3"), "id", "text", "lang")
    assert rows(out, "id", "detected_language") == [(1, "en"), (2, "de"), (3, "en"), (3, "en")]  # rows of one id are one text


def test_bounds_reach_the_scan(spark, tmp_path):
    spark.createDataFrame([(1, T0), (2, None)], "id int, ts timestamp").write.parquet(str(tmp_path / "e"))
    ev = spark.read.parquet(str(tmp_path / "e"))
    for df in (incremental.since_filter(ev, "ts", "2024-01-01 00:00:00"), incremental.active_window(ev, "ts", "2024-01-31 00:00:00", 30),
               merge.high_water_filter(ev, ev.filter("id = 9"), "ts", "ts").filter("ts > timestamp '2020-01-01'")):
        assert "GreaterThan" in df._jdf.queryExecution().executedPlan().toString()
    assert incremental.since_filter(ev, "ts", "1960-01-01 00:00:00").count() == 2  # an unknown time counts as the epoch
    assert incremental.active_window(ev, "ts", "2024-01-01 00:00:00", 0).count() <= 1 and incremental.active_window(ev, "ts", "x", None).count() == 2


def test_has_neighbour_matches_bruteforce(spark):
    import random
    rnd = random.Random(11)
    data = [(i, rnd.choice("abc"), T0 + dt.timedelta(seconds=rnd.randint(0, 40 * 3600))) for i in range(400)]
    data.append((999, "a", data[0][2] + dt.timedelta(hours=5)))
    df = spark.createDataFrame(data, "id int, k string, ts timestamp")
    got = dict(rows(quality.has_neighbour(df, ["k"], "ts", 3600, "nb"), "id", "nb"))
    w = dt.timedelta(seconds=3600)
    for i, k, t in data:
        want = any(j != i and k2 == k and abs(t2 - t) <= w for j, k2, t2 in data)
        assert got[i] == want, (i, k, t)


def test_incremental_model_and_page_dimension(spark):
    tgt = spark.createDataFrame([(1, "a", T0)], "k int, v string, ts timestamp")
    src = spark.createDataFrame([(1, "old", T0), (1, "b", T0 + dt.timedelta(hours=1)), (2, "c", T0 + dt.timedelta(hours=2))],
                                "k int, v string, ts timestamp")
    out = merge.incremental_model(tgt, src.filter(F.col("v") != "old"), ["k"], "ts", "ts")
    assert rows(out, "k", "v") == [(1, "b"), (2, "c")]
    posts = spark.createDataFrame([("facebook", "p", T0), ("facebook", "p", T0 + dt.timedelta(days=1))],
                                  "platform string, page_id string, ingested_at timestamp")
    old = marts.page_dimension(posts.limit(1))
    new = marts.page_dimension(spark.createDataFrame([("facebook", "p", T0 + dt.timedelta(days=3))], posts.schema))
    m = marts.merge_page_dimension(old, new).collect()[0]
    assert m.source_id == "facebook_p" and m.first_ingested_at == T0 and m.last_ingested_at == T0 + dt.timedelta(days=3)


def test_content_reconciliation_finds_lost_and_altered_rows(spark):
    schema = "page string, k long, v string, n long"
    first = [("a", 1, "x", 1), ("a", 2, None, 2), ("b", 3, "z", None), ("c", 4, "w", 4), ("d", 5, "u", 5)]
    df = lambda r: spark.createDataFrame(r, schema)
    lost = [r for r in first if r[1] != 4]
    altered = [("a", 1, "x", 1), ("a", 2, "", 2), ("b", 3, None, None), ("c", 4, "w", 4), ("d", 6, "u", 5)]
    got = {r.page: tuple(r)[1:] for r in checks.reconcile_content({"raw": df(first), "same": df(first[::-1]), "lost": df(lost), "altered": df(altered)},
                                                                  ["page"], ["k", "v", "n"]).collect()}
    assert got == {"a": (2, 2, 2, 2, False, False, True), "b": (1, 1, 1, 1, False, False, True), "c": (1, 1, 0, 1, False, True, False), "d": (1, 1, 1, 1, False, False, True)}
    assert rows(checks.differing_rows(df(first), df(altered), ["k"], ["v", "n"]), "k", "status") == [(2, "altered"), (3, "altered"), (5, "lost"), (6, "added")]


def test_several_null_tests_in_one_aggregate(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    got = {r.test_name: (r.failures, r.should_error) for r in checks.not_null_tests(df, {"a": "ta", "b": "tb"}).collect()}
    assert got == {"ta": (1, True), "tb": (2, True)}


def test_trailing_counts_with_an_author_of_a_third_of_all_rows(spark):
    import random
    r = random.Random(5)
    times = [T0 + dt.timedelta(seconds=r.choice([0, 1, 3599, 3600, 3601, 7200, 86399, 86400, 90000]) + r.randrange(3), microseconds=r.choice([0, 1, 999_999]))
             for _ in range(400)]
    data = [("hot", times[i % 150]) for i in range(150)] + [(f"u{i % 40}", t) for i, t in enumerate(times)] + [(None, T0), (None, T0), ("hot", T0), ("late", None)]
    df = spark.createDataFrame([(i, a, t) for i, (a, t) in enumerate(data)], "id long, author string, t timestamp").repartition(5)
    got = {x.id: x.trailing_count for x in quality.trailing_count(df, ["author"], "t").collect()}
    hour = dt.timedelta(hours=1)
    want = {i: sum(b == a and u is not None and t - hour <= u <= t for b, u in data) for i, (a, t) in enumerate(data) if t is not None}
    assert {i: got[i] for i in want} == want and len(got) == len(data)
    flagged = quality.bot_suspected(df.filter("author is not null and t is not null"), ["author"], "t", threshold=60).filter("bot_suspected")
    assert {x.author for x in flagged.collect()} == {a for i, (a, _) in enumerate(data) if i in want and want[i] > 60 and a}


def test_reply_trees_by_increments_equal_a_rebuild(spark):
    import random
    r = random.Random(8)
    nodes = [(f"n{i}", None if i % 9 == 0 else f"n{r.randrange(max(0, i - 12), i)}" if i % 13 else f"gone{i}") for i in range(120)]
    nodes += [(f"m{i}", f"m{i - 1}") for i in range(1, 20)] + [("m0", "n50"), ("x", "y"), ("y", "x"), ("z", "y"), ("gone26", None)]
    r.shuffle(nodes)
    schema = "id string, parent string"
    stored = spark.createDataFrame([], "id string, parent string, root_id string, depth long, dangling boolean")
    for k in range(3):
        batch = spark.createDataFrame(nodes[k::3] + nodes[:2], schema)
        told = marts.extend_replies(stored, batch, "id", "parent").checkpoint()
        stored = stored.join(told.select("id"), "id", "left_anti").select(*stored.columns).unionByName(told).checkpoint()
        seen = [n for j in range(k + 1) for n in nodes[j::3]] + [n for n in nodes[:2] if n not in [m for j in range(k + 1) for m in nodes[j::3]]]
        whole = marts.reply_depth(spark.createDataFrame(seen, schema), "id", "parent")
        assert rows(stored, "id", "dangling") == rows(whole, "id", "dangling")
        key = lambda x: (x.id, x.root_id or "", -1 if x.depth is None else x.depth)
        assert sorted(map(key, stored.collect())) == sorted(map(key, whole.collect()))
    assert stored.count() == len(nodes)


def test_thread_order_of_a_hot_post(spark):
    """One post holds most comments and so lies in several partitions; null keys, ties and repeated rows."""
    import random
    r = random.Random(31)
    data = [("hot" if i % 5 else f"p{i % 40}", T0 + dt.timedelta(minutes=r.randrange(300)), i) for i in range(1500)]
    data += [(None, T0, 5000), (None, None, 5001), ("hot", None, 5002), ("p0", T0, None), ("p0", T0, 6000), ("p0", T0, 6000)]
    df = spark.createDataFrame(data, "post string, t timestamp, id long").withColumn("_n", F.lit("x"))
    got = marts.thread_order(df, "post", "t", "id")
    assert got.columns == ["post", "t", "id", "_n", "thread_pos"]
    by_post = {}
    for p, t, i in data:
        by_post.setdefault(p, []).append((t is not None, t or T0, i is not None, i or 0))
    want = sorted((str(p), n, t if has else None, i if known else None)
                  for p, all_ in by_post.items() for n, (has, t, known, i) in enumerate(sorted(all_)))
    assert sorted((str(x["post"]), x["thread_pos"], x["t"], x["id"]) for x in got.collect()) == want
    assert marts.thread_order(df.limit(0), "post", "t", "id").count() == 0
