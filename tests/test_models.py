"""Training, search, scoring, sources and incremental ingest on small data."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from laptrace.ml import forest, nodes, search, shared_search, store
from laptrace.session import fresh_path
from laptrace.sources import records, synthetic, tables
from laptrace.vocab import SEARCH_SPACE


@pytest.fixture(scope="module")
def train(spark):
    df = spark.range(300).select(
        F.col("id").alias("name"),
        array_to_vector(F.array((F.col("id") % 3).cast("double"), (F.col("id") % 7).cast("double"))).alias("features"),
        F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("id") % 3 + 1).cast("int")).alias("label"),
        (F.col("id") % 5).cast("int").alias("fold"), F.lit(1.0).alias("unit_weight"), F.lit(2.0).alias("class_weight"))
    return tables.materialise(df, fresh_path(spark, "train"))


def test_forest_saved_and_loaded(spark, train):
    model = forest.fit(train, forest.index_labels(train), numTrees=5, maxDepth=4, weightCol="class_weight")
    path = fresh_path(spark, "model")
    store.save(model, spark.createDataFrame([(0, "f")], "position int, feature string"), path,
               spark.createDataFrame([("m", 1.0)], "metric string, value double"))
    loaded, features = store.load(spark, path)
    scored = forest.score(loaded, train.select("name", "features", "label")).cache()
    assert scored.where("predicted_label <> label").count() == 0
    total = F.aggregate(vector_to_array("probability"), F.lit(0.0), lambda a, x: a + x)
    assert scored.where(F.abs(total - 1) > 1e-9).count() == 0
    assert scored.where("confidence < 0 or confidence > 1").count() == 0
    assert features.count() == 1 and store.read_report(spark, path).first()["value"] == 1.0


def test_scoring_by_nodes_is_what_the_model_says(spark):
    """Sparse rows with gaps, against the model on dense vectors, and against SQL over the exported nodes."""
    import duckdb

    rng = np.random.default_rng(5)
    n, width = 240, 12
    dense = rng.normal(size=(n, width)).round(2)
    dense[np.arange(n), np.arange(n) % 3] += 3
    gaps = rng.random((n, width)) < 0.4
    fills = [0.5 * p for p in range(width)]
    filled = np.where(gaps, fills, dense)
    rows = spark.createDataFrame([(f"r{i}", "abc"[i % 3], filled[i].tolist()) for i in range(n)],
                                 "name string, label string, x array<double>").select(
        "name", "label", array_to_vector("x").alias("features"))
    model = forest.fit(rows, forest.index_labels(rows), numTrees=15, maxDepth=9)
    path = fresh_path(spark, "model")
    features = spark.createDataFrame([(p, f"f{p}", f) for p, f in enumerate(fills)], "position int, feature string, fill double")
    store.save(model, features, path)
    values = [(f"r{i}", p, float(dense[i, p])) for i in range(n) for p in range(width) if not gaps[i, p]]
    given = tables.materialise(spark.createDataFrame(values, "name string, position int, value double"), fresh_path(spark, "v"))
    table = nodes.node_table(spark, path, features)
    assert table.groupBy("tree").count().count() == 15
    found = {r.name: r for r in nodes.score(rows.select("name"), given, table, forest.label_names(model)).collect()}
    want = {r.name: r for r in forest.score(model, rows).collect()}
    assert found.keys() == want.keys()
    for name, r in want.items():
        assert abs(found[name].confidence - r.confidence) < 1e-9
        assert found[name].predicted_label == r.predicted_label
    con = duckdb.connect()
    con.register("nodes", table.toPandas())
    con.register("given", given.toPandas())
    rows_sql = con.sql("""
        with recursive walk(name, tree, node) as (
          select distinct g.name, n.tree, 0 from given g cross join (select distinct tree from nodes) n
          union all
          select w.name, w.tree, case when coalesce(g.value, n.fill) <= n.cut then n."left" else n."right" end
          from walk w join nodes n on n.tree = w.tree and n.node = w.node and n.position is not null
          left join given g on g.name = w.name and g.position = n.position)
        select name, class, sum(share) / 15 as p from (
          select w.name, unnest(range(len(shares))) as class, unnest(shares) as share
          from walk w join nodes n on n.tree = w.tree and n.node = w.node where n.position is null) group by all""").fetchall()
    best = {}
    for name, c, p in rows_sql:
        best[name] = max(best.get(name, (0, 0)), (round(p, 9), -c))
    assert all(forest.label_names(model)[-c] == found[name].predicted_label and abs(p - found[name].confidence) < 1e-8
               for name, (p, c) in best.items())


def test_search_prefers_the_better_candidate(spark, train):
    candidates = [{"numTrees": 1, "maxDepth": 0, "weighted": False}, {"numTrees": 3, "maxDepth": 4, "weighted": True}]
    indexed = forest.index_labels(train).transform(train)
    found = search.results(spark, search.search(indexed, candidates, folds=5), candidates).orderBy("candidate").collect()
    assert found[1]["macro_f1"] > 0.9 > found[0]["macro_f1"] and found[1]["is_best"] == 1


def test_draws_are_distinct_and_seeded():
    first = search.draws()
    assert len(first) == 50 and len({tuple(d.items()) for d in first}) == 50
    assert first == search.draws() and set(first[0]) == set(SEARCH_SPACE)


def test_synthetic_table(spark):
    wide = synthetic.synthetic_wide(spark.range(500), "id")
    assert len(wide.columns) == 34 and wide.count() == 500
    share = wide.agg(F.avg(F.col(synthetic.TIME_COLUMNS[0]).isNull().cast("int")).alias("s"), F.avg("Height_cm").alias("h")).first()
    assert abs(share["s"] - 0.3) < 0.07 and abs(share["h"] - 175) < 2
    assert wide.exceptAll(synthetic.synthetic_wide(spark.range(500).repartition(7), "id")).count() == 0


def test_json_array_file(spark, tmp_path):
    path = tmp_path / "a.json"
    path.write_text('[{"name": "x", "dob": "1990", "paris_2024_races": ["a"]}, {"name": "y", "error": "no"}]')
    out = records.well_formed(records.read_json(spark, str(path), records.ATHLETE_SCHEMA, array_file=True))
    assert sorted((r["name"], r["error"]) for r in out.collect()) == [("x", None), ("y", "no")]


def test_ingest_reads_each_file_once(spark, tmp_path):
    from laptrace.streaming.ingest import ingest

    source, target, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    source.mkdir()
    (source / "1.json").write_text('{"Swimmer_ID": "a", "Event_Name": "50 Free", "Race_Date": "Apr 1, 2020", "Time_Seconds": 25.5}\n{"broken')
    ingest(spark, str(source), target, mark)
    (source / "2.json").write_text('{"Swimmer_ID": "b", "Event_Name": "50 Fly", "Race_Date": "2020-04-02", "Time_Seconds": 26.5}\n')
    ingest(spark, str(source), target, mark)
    out = sorted((r["name"], r["event"], str(r["race_day"]), r["time_seconds"]) for r in spark.read.parquet(target).collect())
    assert out == [("a", "50mFree", "2020-04-01", 25.5), ("b", "50mFly", "2020-04-02", 26.5)]


def rows_of(rng, n, classes=3, features=6):
    """Codes that tell the class apart only together with noise."""
    y = rng.integers(0, classes, n)
    codes = rng.integers(0, 20, (n, features)).astype(np.uint8)
    codes[:, 0] = y * 5 + rng.integers(0, 7, n)
    return codes, y


@pytest.mark.parametrize("least", [1, 3])
def test_best_splits_by_brute_force(least):
    rng = np.random.default_rng(least)
    codes, y = rows_of(rng, 40)
    weight = np.array([1.0, 2.5, 0.5])
    sizes = np.array([30, 17, 2, 9])
    rows = np.zeros((4, 30), np.int64)
    for k, n in enumerate(sizes):
        rows[k, :n] = rng.integers(0, 40, n)
    features = np.stack([rng.permutation(6)[:4] for _ in sizes])

    def squares(own):
        shares = np.bincount(y[own], minlength=3) * weight
        return (shares ** 2).sum() / shares.sum() if len(own) else 0.0

    gain, feature, cut = shared_search.best_splits(codes, y, weight, rows, sizes, features, least)
    for k, n in enumerate(sizes):
        own, best = rows[k, :n], -np.inf
        for f in features[k]:
            for c in np.unique(codes[own, f])[:-1]:
                left, right = own[codes[own, f] <= c], own[codes[own, f] > c]
                if min(len(left), len(right)) >= least:
                    best = max(best, squares(left) + squares(right) - squares(own))
        if best <= 1e-5 * weight[y[own]].sum():
            assert gain[k] == -np.inf
        else:
            left, right = own[codes[own, feature[k]] <= cut[k]], own[codes[own, feature[k]] > cut[k]]
            assert min(len(left), len(right)) >= least and feature[k] in features[k]
            assert abs(gain[k] - best) < 1e-4 and abs(squares(left) + squares(right) - squares(own) - best) < 1e-4


def grown_by_sorting(codes, y, weight, forest_, tree, seed):
    """One tree as ``grow`` makes it, by sorting every node's rows for all features the node may use."""
    n, width = codes.shape
    m, least = shared_search.subset_size(forest_["featureSubsetStrategy"], width), forest_["minInstancesPerNode"]
    rng = np.random.default_rng([seed, tree])
    bag = np.sort(rng.integers(0, n, n)) if forest_["bootstrap"] else np.arange(n)
    nodes, level = [[-1, 0, 0, len(bag)]], [(0, bag)]
    for _ in range(forest_["maxDepth"]):
        below = []
        for node, own in sorted(level, key=lambda f: -len(f[1])):
            if len(own) < max(2, 2 * least) or len(np.unique(y[own])) == 1:
                continue
            features = np.arange(width) if m == width else rng.permutation(width)[:m]
            gain, feature, cut = shared_search.best_splits(
                codes, y, weight, own[None, :], np.array([len(own)]), features[None, :], least)
            if gain[0] > -np.inf:
                goes = codes[own, feature[0]] <= cut[0]
                nodes[node][:3] = feature[0], cut[0], len(nodes)
                for side in (own[goes], own[~goes]):
                    below.append((len(nodes), side))
                    nodes.append([-1, 0, 0, len(side)])
        level = below
    return nodes


@pytest.mark.parametrize("steps", [0, 1 << 20])
@pytest.mark.parametrize("strategy,least,bootstrap,weights", [
    ("all", 1, True, [1.0, 2.5, 0.5]), ("all", 4, False, [1.0, 1.0, 1.0]), ("sqrt", 1, True, [1.0, 2.5, 0.5]),
    ("log2", 3, False, [1.0, 1.0, 1.0])])
def test_counted_trees_are_those_by_sorting(monkeypatch, steps, strategy, least, bootstrap, weights):
    """Features that tie, a feature of one value and codes that differ in number; with and without the table of steps."""
    monkeypatch.setattr(shared_search, "STEP_BYTES", steps)
    monkeypatch.setattr(shared_search, "COUNTED_ROWS", 6)
    codes, y = rows_of(np.random.default_rng(8), 400, features=9)
    codes[:, 3], codes[:, 4], codes[:, 5], codes[:, 6] = 7, codes[:, 0], codes[:, 0] // 3, np.arange(400) % 2
    forest_ = {"minInstancesPerNode": least, "featureSubsetStrategy": strategy, "bootstrap": bootstrap, "maxDepth": 12}
    made = shared_search.grow(codes, y, np.array(weights), forest_, [0, 1, 5], 42)
    for tree in made:
        found = list(map(list, zip(tree["feature"], tree["cut"], tree["below"], tree["rows"], strict=True)))
        assert found == grown_by_sorting(codes, y, np.array(weights), forest_, tree["tree"], 42)


@pytest.mark.parametrize("strategy", ["all", "sqrt"])
def test_few_features_are_sorted(monkeypatch, strategy):
    """Of the features a large node may use, only those are sorted whose counts say that they can hold the best split."""
    sorted_, given = shared_search.best_splits, []

    def spy(codes, y, weight, rows, size, features, least):
        given.append(rows.shape[1] * features.size)
        return sorted_(codes, y, weight, rows, size, features, least)

    monkeypatch.setattr(shared_search, "best_splits", spy)
    codes, y = rows_of(np.random.default_rng(9), 600, features=100)
    forest_ = {"minInstancesPerNode": 1, "featureSubsetStrategy": strategy, "bootstrap": True, "maxDepth": 2}
    made = shared_search.grow(codes, y, np.ones(3), forest_, [0, 1], 42)
    large = sum(r for t in made for r, f in zip(t["rows"], t["feature"], strict=True) if f >= 0 and r >= shared_search.COUNTED_ROWS)
    assert large > 1000 and sum(given) < 0.5 * large * shared_search.subset_size(strategy, 100)


@pytest.mark.parametrize("strategy", ["sqrt", "all"])
def test_smaller_forests_are_parts_of_larger_ones(strategy):
    codes, y = rows_of(np.random.default_rng(3), 120)
    forest_ = {"minInstancesPerNode": 1, "featureSubsetStrategy": strategy, "bootstrap": True, "numTrees": 6, "maxDepth": 30}
    weight = np.ones(3)
    large = shared_search.grow(codes, y, weight, forest_, list(range(6)), 42)
    again = shared_search.grow(codes, y, weight, forest_, [4], 42)[0]
    assert all(np.array_equal(large[4][k], again[k]) for k in again)

    def packed(trees):
        return [{"tree": t["tree"], "feature": np.asarray(t["feature"], "<i4").tobytes(), "cut": np.asarray(t["cut"], "<i2").tobytes(),
                 "below": np.asarray(t["below"], "<i4").tobytes(), "shares": np.asarray(t["shares"], "<f4").tobytes()} for t in trees]

    cut = shared_search.votes(codes, packed(large), [0, 2, 30])
    for depth in (0, 2):
        shallow = shared_search.grow(codes, y, weight, {**forest_, "maxDepth": depth}, list(range(6)), 42)
        assert np.array_equal(shared_search.votes(codes, packed(shallow), [30])[30], cut[depth])
    share = np.bincount(y, minlength=3) / 120
    assert np.allclose(cut[0][0].mean(axis=0), share, atol=0.15)
    assert (cut[30].sum(axis=1).argmax(axis=1) == y).mean() > 0.95
    assert np.allclose(cut[30].sum(axis=2), 1)


def test_shared_search(spark, train):
    """Each draw alone scores what it scores beside the others, and the better draws win."""
    indexed = forest.index_labels(train).transform(train)
    base = {"minInstancesPerNode": 1, "featureSubsetStrategy": "all", "weighted": True, "bootstrap": True}
    candidates = [base | {"numTrees": 100, "maxDepth": 5}, base | {"numTrees": 200, "maxDepth": 30},
                  base | {"numTrees": 100, "maxDepth": 0}, base | {"numTrees": 100, "maxDepth": 5, "bootstrap": False}]
    assert [f["numTrees"] for f in shared_search.forests(candidates)] == [200, 1]
    found = shared_search.search(indexed, candidates, 3, 5).orderBy("candidate").collect()
    assert [r["macro_f1"] for r in found] == [1.0, 1.0, found[2]["macro_f1"], 1.0] and found[2]["macro_f1"] < 0.5
    assert [r["is_best"] for r in found] == [1, 0, 0, 0]
    alone = shared_search.search(indexed, candidates[2:3], 3, 5).first()
    assert alone["macro_f1"] == found[2]["macro_f1"] and alone["params"] == found[2]["params"]


@pytest.mark.parametrize("n", [31, 400])
def test_cuts_are_quantiles_of_all_values(spark, n):
    rng = np.random.default_rng(5)
    x = np.stack([rng.normal(size=n).round(2), rng.integers(0, 3, n) / 2, np.full(n, 7.0)])
    rows = [(at, float(v)) for at in range(3) for v in x[at]]
    found = shared_search.quantile_cuts(spark.createDataFrame(rows, "at int, x double").repartition(3))
    for at in range(3):
        want = {np.sort(x[at])[-(-k * n // 32) - 1] for k in range(1, 32)}
        assert found[at].tolist() == sorted(want)


def test_search_counts_all_rows(spark, monkeypatch):
    """The cuts hold the quantiles of more than 10,000 rows, and every tree has all rows of the other folds, however few bytes fit."""
    monkeypatch.setattr(shared_search, "MEMORY_BYTES", 64)
    monkeypatch.setattr(shared_search, "SENT_BYTES", 0)
    n, folds = 12_000, 3
    data = spark.range(n, numPartitions=4).select(
        F.col("id").cast("string").alias("name"), (F.col("id") % folds).cast("int").alias("fold"),
        array_to_vector(F.array(F.col("id").cast("double"), (F.col("id") % 2).cast("double"))).alias("features"),
        F.pmod(F.floor(F.col("id") / 7), F.lit(3)).cast("double").alias("label_index"))
    cuts = shared_search.quantile_cuts(data.select(F.posexplode(vector_to_array("features")).alias("at", "x")))
    assert cuts[0].tolist() == [n * k / 32 - 1 for k in range(1, 32)]
    known = [{"minInstancesPerNode": 1, "featureSubsetStrategy": "all", "weighted": False, "bootstrap": False, "numTrees": 1, "maxDepth": 1},
             {"minInstancesPerNode": 1, "featureSubsetStrategy": "sqrt", "weighted": False, "bootstrap": False, "numTrees": 120, "maxDepth": 1}]
    rows = shared_search.coded(data)
    trees = shared_search.grown(rows, known, 3, folds).collect()
    assert sorted((t.fold, t.forest, t.tree) for t in trees) == sorted(
        (f, i, t) for f in range(folds) for i, k in enumerate(known) for t in range(k["numTrees"]))
    label = np.arange(n) // 7 % 3
    for t in trees:
        shares = np.frombuffer(t.shares, "<f4").reshape(-1, 3)
        of_fold = label[np.arange(n) % folds != t.fold]
        assert np.array_equal(shares[0], (np.bincount(of_fold, minlength=3) / len(of_fold)).astype(np.float32))


def test_registered_search_tries_every_draw(spark, monkeypatch):
    from laptrace.plans import model_queries

    data = spark.range(60).select(
        F.col("id").cast("string").alias("name"), F.lit("train").alias("split"), (F.col("id") % 5).cast("int").alias("fold"),
        array_to_vector(F.array((F.col("id") % 3).cast("double"), (F.col("id") % 7).cast("double"))).alias("features"),
        F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("id") % 3 + 1).cast("int")).alias("label"))
    matrix = tables.materialise(data, fresh_path(spark, "matrix"))
    monkeypatch.setattr(model_queries, "prepared", lambda *_: model_queries.T.Prepared(matrix, None, []))
    found = model_queries.search_forest(spark, "").collect()
    assert sorted(r["params"] for r in found) == sorted(shared_search.params_text(c) for c in search.draws())
    assert len(found) == 50 and sum(r["is_best"] for r in found) == 1
    assert max(r["macro_f1"] for r in found) == next(r["macro_f1"] for r in found if r["is_best"])
    for candidate in search.draws():
        forest.classifier(**{k: v for k, v in candidate.items() if k != "weighted"})._transfer_params_to_java()


def test_rejected_records_are_kept(spark, tmp_path):
    from laptrace.streaming.ingest import sort_out

    source = tmp_path / "in"
    source.mkdir()
    (source / "1.json").write_text('{"Swimmer_ID": "a", "Event_Name": "50 Free"}\n{"broken\n{"Swimmer_ID": "b"}\n')
    reasons = {"no event": F.col("Event_Name").isNull(), "never": F.lit(None).cast("boolean")}
    read = records.read_json(spark, str(source), records.RACE_SCHEMA)
    path = fresh_path(spark, "judged")
    records.write_judged(records.judged(read, reasons), path)
    stream, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    sort_out(spark, str(source), stream, mark, reasons)
    (source / "2.json").write_text('{"Swimmer_ID": "c", "Event_Name": "50 Fly"}\nnothing\n')
    sort_out(spark, str(source), stream, mark, reasons)
    for place, more in ((path, 0), (stream, 1)):
        good = records.read_judged(spark, place, records.RACE_SCHEMA, "good").collect()
        assert sorted(r.Swimmer_ID for r in good) == ["a", "c"][:1 + more]
        bad = records.read_judged(spark, place, records.RACE_SCHEMA, "rejected").collect()
        assert sorted(map(tuple, bad)) == sorted([("unreadable", '{"broken'), ("no event", '{"Swimmer_ID":"b"}')] + [("unreadable", "nothing")] * more)
