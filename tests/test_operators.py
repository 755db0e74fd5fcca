"""Properties of the distributed operators, also beyond the broadcast bound and with hot keys."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from laptrace.operators import athletes, impute, joins, labels, metrics, quantiles, races, ranking, reshape, scoring, splits
from laptrace.session import fresh_path
from laptrace.sources import tables


def hot_rows(n=3000, seed=1):
    """A third of the rows under one key, with repeated rows."""
    rnd = random.Random(seed)
    return [("hot" if i % 3 == 0 else f"k{rnd.randrange(50)}", float(rnd.randrange(200)), i) for i in range(n)]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_salted_join_equals_broadcast_join(spark):
    facts = spark.createDataFrame(hot_rows(), "k string, v double, i int")
    dim = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3)], "k string, d int")
    small = joins.lookup_join(facts, dim, ["k"])
    salted = joins.lookup_join(facts, dim, ["k"], max_rows=0)
    assert "Broadcast" in small._jdf.queryExecution().executedPlan().toString()
    assert rows(small) == rows(salted)
    assert salted.count() == 3000


def test_salts_spread_a_hot_key(spark):
    facts = spark.createDataFrame(hot_rows(), "k string, v double, i int").where("k = 'hot'")
    salts = facts.select(F.pmod(F.xxhash64(*facts.columns), F.lit(joins.SALTS)).alias("s")).groupBy("s").count().collect()
    assert len(salts) == joins.SALTS and max(r["count"] for r in salts) < 100


def test_best_marks_do_not_depend_on_the_join(spark, monkeypatch):
    raw = [(f"a{i % 4}", "100 Free", "LCM", f"2020-0{1 + i % 9}-01", f"{50 + i % 7}.00") for i in range(200)]
    raw += [("stranger", "100 Free", "LCM", "2020-01-01", "40.0"), ("a1", "4x100 Free Relay", "LCM", "2020-01-01", "1.0"),
            ("a1", "100 Free", None, "2020-01-01", "2.0")]
    facts = races.parse(spark.createDataFrame(raw, "name string, event_name string, course string, race_date string, time_text string"))
    born = spark.createDataFrame([(f"a{i}", f"200{i}-05-05") for i in range(4)], "name string, b string").select(
        "name", F.to_date("b").alias("born"))
    broadcast = rows(races.fastest(facts, born))
    monkeypatch.setattr(races, "fits_broadcast", lambda *_: False)
    assert rows(races.fastest(facts, born)) == broadcast
    assert {r[0] for r in broadcast} == {"a0", "a1", "a2", "a3"}
    assert min(r[4] for r in broadcast) == 50.0


@pytest.mark.parametrize("max_groups", [None, 100])
def test_exact_median(spark, max_groups):
    data = hot_rows(5000) + [("one", 7.0, 0), ("two", 1.0, 0), ("two", 2.0, 0), ("gap", None, 0)]
    df = spark.createDataFrame(data, "k string, v double, i int")
    found = {r["k"]: r["median"] for r in quantiles.exact_median(df, ["k"], "v", max_groups=max_groups).collect()}
    groups = {}
    for k, v, _ in data:
        if v is not None:
            groups.setdefault(k, []).append(v)
    assert found == {k: statistics.median(v) for k, v in groups.items()}


def test_ranks_are_complete_and_repeatable(spark):
    df = spark.createDataFrame([("big" if i % 3 else f"c{i % 5}", i) for i in range(4000)], "c string, i int")
    first = ranking.shuffled_rank(df, ["c"], "i", 42)
    again = ranking.shuffled_rank(df.repartition(3), ["c"], "i", 42)
    assert rows(first) == rows(again)
    for r in first.groupBy("c", "group_rows").agg(F.count("*").alias("n"), F.countDistinct("rank").alias("d"), F.max("rank").alias("m")).collect():
        assert r["n"] == r["d"] == r["m"] == r["group_rows"]


def test_split_is_stratified(spark):
    df = spark.createDataFrame([(i, "a" if i % 3 == 0 else "b" if i % 3 == 1 else f"r{i % 7}") for i in range(1000)], "i int, c string")
    done = splits.stratified(df, "i", "c")
    assert done.count() == 1000 and done.select("i").distinct().count() == 1000
    for r in done.groupBy("c").agg(F.count("*").alias("n"), F.sum((F.col("split") == "test").cast("int")).alias("t")).collect():
        assert r["t"] == int(r["n"] * 0.2)
    assert done.select("fold").distinct().count() == 5


def test_rare_classes_and_weights(spark):
    df = spark.createDataFrame([(i, "a" if i else "only") for i in range(10)], "i int, c string")
    assert splits.without_rare(df, "c").count() == 9
    weights = {r["c"]: r["class_weight"] for r in splits.class_weights(df, "c").collect()}
    assert weights == {"a": 10 / (2 * 9), "only": 5.0}


def best_frame(spark, data):
    return spark.createDataFrame(data, "name string, event string, course string, age int, time_seconds double")


def test_progression_fills_gaps_only(spark):
    best = best_frame(spark, [("x", "100mFree", "LCM", 22, 50.0), ("x", "100mFree", "LCM", 25, 52.0),
                              ("x", "100mFree", "LCM", 12, 70.0), ("y", "100mFree", "LCM", 19, 50.0)])
    out = {(r["name"], r["age"]): r["time_seconds"] for r in impute.progression(best).collect()}
    assert set(out) == {("x", a) for a in range(10, 19) if a != 12}
    assert out[("x", 10)] == 50.0 * 1.40 and out[("x", 18)] == 50.0
    jittered = {r["age"]: r["time_seconds"] for r in impute.progression(best, seed=1).collect()}
    assert all(abs(jittered[a] / out[("x", a)] - 1) <= 0.02 for a in jittered)


def test_baseline_and_median_fill(spark):
    vocabulary = reshape.vocabulary(best_frame(spark, [("x", "100mFree", "LCM", 12, 60.0)]))
    assert vocabulary.count() == 567
    fills = {r["feature"]: r["fill"] for r in impute.baseline(vocabulary).collect()}
    assert len(fills) == 566 and "100mFree_LCM_Age12_FastestTime" not in fills
    assert fills["100mFree_LCM_Age13_FastestTime"] == 48.0 * 1.20
    values = spark.createDataFrame([("f", "train", 1.0), ("f", "train", 3.0), ("f", "test", None), ("f", "test", 100.0)],
                                   "feature string, split string, value double")
    medians = impute.fit_medians(values.where("split = 'train'"))
    filled = impute.apply_medians(values, medians)
    assert filled.where("value is null").count() == 0
    assert medians.first()["median"] == 2.0  # the test rows have no part in it


def test_labels(spark):
    names = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("e",)], "name string")
    best = best_frame(spark, [("a", "50mFree", "LCM", 18, 23.9), ("b", "50mFree", "LCM", 18, 24.1),
                              ("c", "50mFly", "LCM", 12, 30.0), ("c", "50mBack", "LCM", 12, 30.0),
                              ("d", "1650mFree", "SCY", 15, 20.0)])
    out = {r["name"]: r["label"] for r in labels.from_marks(names, best).collect()}
    assert out == {"a": "50m_Freestyle", "b": "No_Olympic_Event", "c": "50m_Backstroke", "d": "No_Olympic_Event",
                   "e": "No_Olympic_Event"}
    pairs = spark.createDataFrame([("a", "Olympic_50m__Freestyle"), ("a", "Olympic_100m__Butterfly")], "name string, indicator string")
    chosen = {r["name"]: r["label"] for r in labels.label_athletes(names, best, pairs).collect()}
    assert chosen["a"] == "100m_Butterfly" and chosen["b"] == "No_Olympic_Event"
    assert {r["name"]: r["label"] for r in labels.label_athletes(names, best, pairs.limit(0)).collect()} == out


def test_wide_and_long_agree(spark):
    best = best_frame(spark, [("x", "100mFree", "LCM", 12, 60.0), ("x", "50mFly", "SCM", 22, 30.0), ("y", "50mFly", "SCM", 22, 31.0)])
    features = ["100mFree_LCM_Age12_FastestTime", "50mFly_SCM_Age22_FastestTime", "50mFly_SCM_Age23_FastestTime"]
    wide = reshape.widen(best, features)
    assert wide.columns == ["name", *features]
    back = reshape.lengthen(wide, "name", features).select("name", "event", "course", "age", "time_seconds")
    assert rows(back) == rows(best)
    youth_kept = reshape.drop_empty(wide, features)
    assert "50mFly_SCM_Age23_FastestTime" not in youth_kept.columns


def test_wide_rows_are_built_without_a_pivot(spark):
    """Same rows as a pivot, with repeated and missing times, a null name and a name without any of the features."""
    best = best_frame(spark, [("x", "100mFree", "LCM", 12, 60.0), ("x", "100mFree", "LCM", 12, 59.0), ("x", "100mFree", "LCM", 12, None),
                              ("y", "50mFly", "SCM", 22, None), (None, "50mFly", "SCM", 22, 31.0), (None, "100mFree", "LCM", 12, 61.0),
                              ("z", "200mFly", "SCM", 30, 140.0), ("x", None, "SCM", 22, 1.0)])
    features = ["50mFly_SCM_Age23_FastestTime", "50mFly_SCM_Age22_FastestTime", "100mFree_LCM_Age12_FastestTime"]
    wide = reshape.widen(best, features)
    want = reshape.add_feature(best).where(F.col("feature").isin(features)).groupBy("name").pivot("feature", features).agg(F.min("time_seconds"))
    assert wide.columns == want.columns and rows(wide) == rows(want) and wide.count() == 3
    assert "pivotfirst" not in wide._jdf.queryExecution().executedPlan().toString().lower()


def test_rename_keeps_the_first_of_colliding_columns(spark):
    wide = spark.createDataFrame([(1.0, 2.0, 3.0)], "100mFree_SCY_Age12_FastestTime double, 100Free_SCY_Age12_FastestTime double, x double")
    out = reshape.rename_standard(wide)
    assert out.columns == ["100Free_SCY_Age12_FastestTime", "x"] and out.first()[0] == 1.0


def test_metrics(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b")], "t string, p string")
    out = metrics.summary(metrics.confusion(df, "t", "p")).first()
    assert out["macro_f1"] == pytest.approx(2 / 3) and out["balanced_accuracy"] == 0.75


def test_alignment(spark):
    df = spark.createDataFrame([("a", [(2, 20.0), (0, 5.0)]), ("b", None), ("c", [(4, 1.0)]), ("d", [])],
                               "n string, given array<struct<position:int,value:double>>")
    out = {r["n"]: r["aligned"] for r in scoring.align(df, [9.0, 8.0, 7.0, 6.0, 0.0]).collect()}
    assert out == {"a": [5.0, 8.0, 20.0, 6.0, 0.0], "b": [9.0, 8.0, 7.0, 6.0, 0.0], "c": [9.0, 8.0, 7.0, 6.0, 1.0],
                   "d": [9.0, 8.0, 7.0, 6.0, 0.0]}


def test_unique_athletes_and_aliases(spark):
    raw = spark.createDataFrame([("x", None, 170.0), ("x", "1990", None), ("x", "1990-05-05", 180.0), ("y", "2001-01-01", None)],
                                "Swimmer_ID string, dob string, height_cm double")
    out = athletes.conform(raw)
    assert out.columns == ["Name", "Date_of_Birth", "Height_cm"]
    assert rows(athletes.unique(out)) == [("x", "1990-05-05", 180.0), ("y", "2001-01-01", None)]
    good, failed = athletes.split_failed(spark.createDataFrame([("a", None), ("b", "boom")], "name string, error string"))
    assert rows(good) == [("a",)] and failed.count() == 1


def test_pending_and_append(spark):
    names = spark.createDataFrame([("Ann",), ("ann",), ("Bob",), ("Bob",), (None,)], "name string")
    done = spark.createDataFrame([("ANN",)], "d string")
    assert rows(joins.pending(names, done, "name", "d", ignore_case=True)) == [("Bob",)]
    assert rows(joins.pending(names, done, "name", "d")) == [("Ann",), ("Bob",), ("ann",)]
    both = joins.append([names, spark.createDataFrame([(1,)], "n int")])
    assert both.columns == ["name", "n"] and both.count() == 6


@pytest.mark.parametrize("bounds", [{}, {"max_rows": 0}, {"max_rows": 0, "max_words": 0}])
def test_rows_of_done_keys_go(spark, bounds):
    """Broadcast, Bloom filter and salted join give the same rows."""
    data = [(f"Key{i % 700}", i) for i in range(3000)] + [(None, 1), (None, 1), ("Key3", 3), ("hot", 0)] + [("hot", 1)] * 900
    names = spark.createDataFrame(data, "name string, n int")
    done = spark.createDataFrame([(f"kEY{i}",) for i in range(3, 500, 7)] * 2 + [("HOT",), (None,)], "d string")
    gone = {f"key{i}" for i in range(3, 500, 7)} | {"hot"}
    for seen, left in ((done, [r for r in data if (r[0] or "").lower() not in gone]), (done.limit(0), data)):
        found = joins.without_done(names, seen, "name", "d", ignore_case=True, **bounds)
        assert found.columns == ["name", "n"]
        assert sorted(map(tuple, found.collect()), key=repr) == sorted(left, key=repr)
    assert joins.without_done(names.limit(0), done, "name", "d", **bounds).count() == 0


def test_bloom_filter_misses_nothing_and_doubts_little(spark):
    """With one key in a hundred done, at most three rows in a hundred are shuffled."""
    facts = spark.range(200_000).select(F.col("id").alias("k"))
    done = spark.range(0, 200_000, 100).select(F.col("id").alias("k"))
    flagged = joins.doubtful(facts, done, "k", 500, "maybe")
    known, doubted = flagged.agg(F.count_if(F.col("maybe") & (F.col("k") % 100 == 0)), F.count_if("maybe")).first()
    assert known == 2000 and doubted < 6000


@pytest.mark.parametrize("slices, slice_rows", [(2, 4), (3, 10), (16, 50), (128, 200_000)])
@pytest.mark.parametrize("max_groups", [None, 10])
def test_median_in_rounds(spark, slices, slice_rows, max_groups):
    rng = random.Random(slices)
    data = [("hot", rng.gauss(0, 1e3)) for _ in range(1500)] + [("ties", float(rng.randrange(3))) for _ in range(101)]
    data += [("even", float(2 ** i)) for i in range(60)] + [(None, -1.0), (None, 4.0), ("same", 5.0), ("same", 5.0)]
    data += [("gap", None), ("gap", float("nan")), ("far", 1.0), ("far", float("inf")), ("far", 2.0)]
    df = spark.createDataFrame(data, "g string, v double")
    found = {r.g: r.median for r in quantiles.exact_median(
        df, ["g"], "v", slices=slices, slice_rows=slice_rows, max_groups=max_groups).collect()}
    groups = {}
    for g, v in data:
        if v is not None and v == v:
            groups.setdefault(g, []).append(v)
    assert found == {g: statistics.median(v) for g, v in groups.items()}


def test_null_groups_stay(spark):
    from laptrace.operators.quantiles import exact_median
    from laptrace.operators.ranking import shuffled_rank

    df = spark.createDataFrame([(None, 1.0, 1), (None, 3.0, 2), ("a", 5.0, 3), ("a", None, 4)], "g string, v double, k int")
    for slices in (2, 128):
        rows = exact_median(df, ["g"], "v", slices=slices).collect()
        assert sorted(map(tuple, rows), key=repr) == [("a", 5.0), (None, 2.0)]
    ranked = shuffled_rank(df, ["g"], "k", 1).select("g", "rank", "group_rows").collect()
    assert sorted(map(tuple, ranked), key=repr) == [("a", 1, 2), ("a", 2, 2), (None, 1, 2), (None, 2, 2)]


def test_wide_rows_keep_every_mark(spark):
    from laptrace.operators import reshape

    rows = [("x", "200mDiving", "LCM", 47, 30.0), ("x", "50mFree", "SCY", 12, 25.0), ("y", "50mFree", "SCY", 12, 26.0)]
    best = spark.createDataFrame(rows, "name string, event string, course string, age int, time_seconds double")
    wide = reshape.wide_rows(best)
    assert wide.selectExpr("sum(size(times))").first()[0] == 3
    back = reshape.lengthen_rows(wide).select("name", "event", "course", "age", "time_seconds").collect()
    assert sorted(map(tuple, back)) == sorted(rows)
    assert "200mDiving_LCM_Age47_FastestTime" in reshape.all_features(best)
    with pytest.raises(ValueError):
        reshape.all_features(best, max_features=10)


def test_only_hot_keys_are_salted(spark):
    from laptrace.operators.joins import salted_join

    facts = spark.range(300).selectExpr("if(id < 200, 'hot', concat('k', id % 50)) as k", "id", "'same' as other")
    facts = facts.unionByName(spark.createDataFrame([(None, -1, "same")], facts.schema))
    dim = spark.createDataFrame([("hot", 1), *[(f"k{i}", i) for i in range(50)], ("unused", 0)], "k string, v int")
    for how in ("left", "inner"):
        plain = facts.join(dim, ["k"], how)
        for extra in ({}, {"salt_by": ["id"]}):
            found = salted_join(facts, dim, ["k"], how, 8, hot_rows=100, **extra)
            assert found.columns == plain.columns
            assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
    wide = spark.range(300).selectExpr("concat('k', id % 50) as k", "id", "concat('o', id) as other")
    plan = salted_join(wide, dim, ["k"], "left", 8, hot_rows=100, salt_by=["id"]).select("k", "v")
    assert "other" not in plan._jdf.queryExecution().optimizedPlan().toString()


def test_requests_keep_empty_answers(spark):
    from laptrace.operators import scoring

    vocabulary = spark.createDataFrame(
        [("50mFree", "LCM", 10), ("100mFree", "LCM", 10), ("50mFree", "LCM", 14), ("50mFree", "SCY", None), ("Odd", "LCM", 12),
         ("50mFree", None, 10)], "event string, course string, age int")
    requests = spark.createDataFrame([(1, "LCM", 10), (2, "LCM", 12), (3, "LCM", 99), (4, "SCY", 10), (5, "XXX", 10),
                                      (6, None, 10), (7, "LCM", None), (1, "LCM", 10)], "id int, course string, age int")
    found = scoring.answers(requests, vocabulary, ["50mFree", "100mFree"]).collect()
    got = sorted((r.id, tuple(r.offered), r.nearest_age, tuple(r.nearest)) for r in found)
    both = ("100mFree", "50mFree")
    assert got == [(1, both, 10, both), (1, both, 10, both), (2, (), 10, both), (3, (), 14, ("50mFree",)), (4, (), None, ()),
                   (5, (), None, ()), (6, (), None, ()), (7, (), None, ())]


def test_rows_without_link_are_of_the_pages_athlete(spark):
    from laptrace.operators import pages

    def line(person, event, time):
        return f"<tr><td>1</td><td>{person}</td><td>{event}</td><td>{time}</td></tr>"

    html = "<h1>Meet</h1><p>LCM</p><table>" + line('<a href="/swimmer/1">Alex Doe</a>', "50 Free", "25.10") + line(
        "Robin Roe", "50 Fly", "27.10") + line('<a href="/swimmer/2">X</a>', "50 Back", "28.10") + "</table>"
    frame = spark.createDataFrame([(1, "/a", html, "Page Person"), (2, "/b", html, None)],
                                  "page_id int, url string, html string, about string")
    found = pages.race_records(frame, page_athlete="about").orderBy("page_id", "row_pos").collect()
    assert [(r.page_id, r.athlete, r.from_page) for r in found] == [
        (1, "Alex Doe", 0), (1, "Page Person", 1), (1, "Page Person", 1), (2, "Alex Doe", 0), (2, None, 1), (2, None, 1)]
    assert "from_page" not in pages.race_records(frame).columns


def test_training_report(spark):
    from laptrace.operators import metrics

    searched = spark.createDataFrame([(0, "a=1, b=x", 0.25, 0), (1, "a=2, b=y", 0.5, 1)], "candidate int, params string, macro_f1 double, is_best int")
    part = spark.createDataFrame([("n", 3.0)], "metric string, value double")
    assert sorted(map(tuple, metrics.training_report(searched, part, part).collect())) == [
        ("holdout", "n", "3.0"), ("imputation", "n", "3.0"), ("parameters", "a", "2"), ("parameters", "b", "y"), ("search", "cv_macro_f1", "0.5")]


def test_a_million_features_without_a_list(spark):
    from laptrace.operators import scoring

    n = 1_000_000
    features = spark.range(n).select(F.concat(F.lit("f"), F.lpad(F.col("id").cast("string"), 7, "0")).alias("feature"),
                                     (F.col("id") % 10).cast("double").alias("fill")).repartition(5)
    coded = tables.materialise(scoring.dictionary(features), fresh_path(spark, "coded"))
    assert coded.count() == n
    assert coded.where(F.col("position") != F.substring("feature", 2, 7).cast("long")).isEmpty()
    long = spark.createDataFrame([("a", "f0000003", 5.0), ("a", "f0999999", 1.5), ("a", "f0000003", 4.5), ("a", "unknown", 9.0),
                                  ("b", "f0000001", None)], "name string, feature string, value double")
    rows = scoring.sparse_rows(long, coded, "name")
    assert [(r.name, [tuple(g) for g in r.given]) for r in rows.collect()] == [("a", [(3, 4.5), (999999, 1.5)])]
    sums = scoring.filled_sums(rows, scoring.defaults(coded), "name").first()
    assert (sums.n_given, sums.total) == (2, 4.5 * n + (4.5 - 3) + (1.5 - 9))
    assert scoring.filled_sums(rows, scoring.defaults(coded, fitted=False), "name").first().total == 6.0


def test_pages_are_built_where_they_are_read(spark, tmp_path):
    from laptrace.plans import views

    spark.sql("select id as o_orderkey, id + 1 as o_custkey, date '2024-07-27' as o_orderdate from range(60)").write.parquet(
        f"{tmp_path}/orders.parquet")
    pages = views.stored_pages(spark, str(tmp_path))
    assert pages.where("html like '%</html>'").count() == 60
    assert {f.split("/")[-2] for f in pages.inputFiles()} == {"orders.parquet"}


def test_reading_a_table_tunes_any_session(spark, tmp_path):
    from laptrace.plans import views

    spark.range(1).write.parquet(f"{tmp_path}/nation.parquet")
    other = spark.newSession()
    other.conf.unset("spark.sql.codegen.hugeMethodLimit")
    views.table(other, str(tmp_path), "nation")
    assert other.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
