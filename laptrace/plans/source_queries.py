"""Reading and writing: every query writes to the shared folder and reads back."""

from __future__ import annotations

from pyspark.sql import functions as F

from laptrace.operators import athletes as A
from laptrace.operators import metrics, reshape, scoring, splits
from laptrace.plans import oracle as O
from laptrace.plans import views as V
from laptrace.plans.registry import query
from laptrace.session import fresh_path
from laptrace.sources import records, synthetic, tables
from laptrace.vocab import COURSES, YOUTH_AGES

RECORDS = """select name as "Swimmer_ID", race_date as "Race_Date", event_name as "Event_Name", course as "Course",
  time_seconds as "Time_Seconds", meet_name as "Meet_Name", meet_url as "Meet_URL" from races"""


def race_records(spark, sf_dir):
    return V.races(spark, sf_dir).select(
        F.col("name").alias("Swimmer_ID"), F.col("race_date").alias("Race_Date"),
        F.col("event_name").alias("Event_Name"), F.col("course").alias("Course"),
        F.col("time_seconds").alias("Time_Seconds"), F.col("meet_name").alias("Meet_Name"),
        F.col("meet_url").alias("Meet_URL"))


@query("io_json_roundtrip__a1", f"with {O.RACE_CTES} {RECORDS} where not ends_with(meet_name, '01')")
def read_records(spark, sf_dir):
    """Race records from JSON Lines of which some are cut off; only whole records are returned."""
    path = fresh_path(spark, "records")
    line = F.to_json(F.struct("*"))
    cut = F.when(F.col("Meet_Name").endswith("01"), F.substring(line, 1, 25)).otherwise(line)
    race_records(spark, sf_dir).select(cut.alias("value")).write.text(path)
    return records.well_formed(records.read_json(spark, path, records.RACE_SCHEMA))


@query("io_json_roundtrip__a2", f"""with {O.ATHLETES}
  select name, dob, height_cm, weight_kg, gender, race, array_to_string(paris_2024_races, '; ') as entered,
    cast(len(paris_2024_races) as integer) as n_entered
  from athletes_raw where s_suppkey % 17 <> 3""")
def read_athletes(spark, sf_dir):
    """Athlete records with a nested list; failed ones are set apart."""
    path = fresh_path(spark, "athletes")
    raw = V.athletes_raw(spark, sf_dir)
    failed = F.substring("name", -9, 9).cast("long") % 17 == 3
    blank = [F.when(~failed, F.col(c)).alias(c) for c in raw.columns if c != "name"]
    records.write_json(raw.select("name", *blank, F.when(failed, "no answer").alias("error")), path)
    good, _ = A.split_failed(records.well_formed(records.read_json(spark, path, records.ATHLETE_SCHEMA)))
    return good.select(
        "name", "dob", "height_cm", "weight_kg", "gender", "race",
        F.array_join("paris_2024_races", "; ").alias("entered"), F.size("paris_2024_races").alias("n_entered"))


@query("io_json_roundtrip__a1_rejects", f"""with {O.RACE_CTES},
  lines as (select case when ends_with(meet_name, '01') then 'unreadable' when ends_with(meet_name, '02') then 'no event' end as reason,
    name, event_name, meet_url from races)
  select case when reason is null then 'good' else 'rejected' end as status, coalesce(reason, '') as reason,
    case reason when 'unreadable' then '{{"Swimmer_ID":"Supplier#0' when 'no event' then name || '|' || meet_url
      else event_name end as shown, count(*) as n from lines group by all""")
def sorted_records(spark, sf_dir):
    """Race records, cut off or without an event in part, written to both sides in one pass; both sides read back."""
    path, sides = fresh_path(spark, "records"), fresh_path(spark, "sides")
    whole = race_records(spark, sf_dir).withColumn(
        "Event_Name", F.when(~F.col("Meet_Name").endswith("02"), F.col("Event_Name")))
    line = F.to_json(F.struct("*"))
    cut = F.when(F.col("Meet_Name").endswith("01"), F.substring(line, 1, 25)).otherwise(line)
    whole.select(cut.alias("value")).write.text(path)
    read = records.read_json(spark, path, records.RACE_SCHEMA)
    records.write_judged(records.judged(read, {"no event": F.col("Event_Name").isNull()}), sides)
    good = records.read_judged(spark, sides, records.RACE_SCHEMA, "good").select(
        F.lit("good").alias("status"), F.lit("").alias("reason"), F.col("Event_Name").alias("shown"))
    kept = F.concat_ws("|", F.get_json_object("raw", "$.Swimmer_ID"), F.get_json_object("raw", "$.Meet_URL"))
    bad = records.read_judged(spark, sides, records.RACE_SCHEMA, "rejected").select(
        F.lit("rejected").alias("status"), "reason",
        F.when(F.col("reason") == "no event", kept).otherwise(F.col("raw")).alias("shown"))
    return good.unionByName(bad).groupBy("status", "reason", "shown").agg(F.count(F.lit(1)).alias("n"))


@query("io_json_roundtrip__a2_rejects", f"""with {O.ATHLETES}
  select name, case when s_suppkey % 17 = 3 then 'rejected' else 'good' end as status,
    case when s_suppkey % 17 = 3 then 'no answer' else '' end as reason from athletes_raw""")
def sorted_athletes(spark, sf_dir):
    """Athlete records with their fate: those that failed are kept apart, with the error they came with."""
    path, sides = fresh_path(spark, "athletes"), fresh_path(spark, "sides")
    raw = V.athletes_raw(spark, sf_dir)
    failed = F.substring("name", -9, 9).cast("long") % 17 == 3
    blank = [F.when(~failed, F.col(c)).alias(c) for c in raw.columns if c != "name"]
    records.write_json(raw.select("name", *blank, F.when(failed, "no answer").alias("error")), path)
    read = records.read_json(spark, path, records.ATHLETE_SCHEMA)
    records.write_judged(records.judged(read, {"failed": F.col("error").isNotNull()}), sides)
    good = records.read_judged(spark, sides, records.ATHLETE_SCHEMA, "good").select(
        "name", F.lit("good").alias("status"), F.lit("").alias("reason"))
    bad = records.read_judged(spark, sides, records.ATHLETE_SCHEMA, "rejected").select(
        F.get_json_object("raw", "$.name").alias("name"), F.lit("rejected").alias("status"),
        F.get_json_object("raw", "$.error").alias("reason"))
    return good.unionByName(bad)


@query("io_json_roundtrip__a5", f"with {O.BEST_CTES} select * from best")
def write_records(spark, sf_dir):
    path = fresh_path(spark, "best")
    records.write_json(V.best_marks(spark, sf_dir), path)
    return spark.read.schema("name string, event string, course string, age int, time_seconds double").json(path)


# The structural columns, which exist even if nobody has a mark for them.
WIDE_FEATURES = sorted(
    f"{e}_{c}_Age{a}_FastestTime"
    for e in reshape.STRUCTURAL_EVENTS for c in COURSES for a in range(YOUTH_AGES[0], YOUTH_AGES[1] + 1))


def wide_sql(features: list[str], only_known: bool = False) -> str:
    """Wide table over the features; ``only_known`` leaves out athletes without any of them, as a pivot does."""
    cells = ", ".join(f"min(time_seconds) filter (where feature = '{f}') as \"{f}\"" for f in features)
    known = ", ".join(f"'{f}'" for f in features)
    where = f"where feature in ({known})" if only_known else ""
    return f"select name, {cells} from (select *, {O.feature()} as feature from best) {where} group by name"


def wide_schema(features: list[str]) -> str:
    return "name string, " + ", ".join(f"`{f}` double" for f in features)


TIMES_SQL = f"""string_agg({O.feature()} || '=' || printf('%.2f', time_seconds), ';' order by {O.feature()})"""


@query("io_csv_roundtrip__a3", f"with {O.BEST_CTES} select name, {O.feature()} as feature, time_seconds from best")
def read_wide(spark, sf_dir):
    """A wide file with every structural and observed column, read back; its cells as rows."""
    path = fresh_path(spark, "wide")
    best = V.stored_best_marks(spark, sf_dir)
    features = reshape.all_features(best)
    tables.write_csv(reshape.widen(best, features), path)
    back = tables.read_csv(spark, path, wide_schema(features))
    return reshape.lengthen(back, "name", features).select("name", "feature", "time_seconds")


ORDER_SPLIT = """
ranked as (
  select *, row_number() over (partition by o_orderpriority order by md5(o_orderkey || '|42'), o_orderkey) as r,
    count(*) over (partition by o_orderpriority) as n from orders
),
split_orders as (
  select o_orderkey, o_totalprice, o_orderpriority, case when r <= floor(n * 0.2) then 'test' else 'train' end as split,
    cast(r % 5 as integer) as fold from ranked
)"""


@query("io_csv_roundtrip__a4", f"with {ORDER_SPLIT} select o_orderkey, o_totalprice, o_orderpriority, fold from split_orders where split = 'train'")
def write_matrices(spark, sf_dir):
    """Train and test rows in folders of their own; the reader touches the training folder only."""
    path = fresh_path(spark, "matrices")
    orders = V.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    tables.write_split(splits.stratified(orders, "o_orderkey", "o_orderpriority"), path)
    return tables.read_split(spark, path, "train")


@query("io_csv_roundtrip__a4_both", f"with {ORDER_SPLIT} select o_orderkey, o_totalprice, o_orderpriority, fold, split from split_orders")
def write_both_matrices(spark, sf_dir):
    """Train and test rows as CSV with a header, a folder each, both read back under a declared schema."""
    path = fresh_path(spark, "matrices")
    orders = V.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    tables.write_csv(splits.stratified(orders, "o_orderkey", "o_orderpriority"), path, by=["split"])
    schema = "o_orderkey long, o_totalprice double, o_orderpriority string, fold int"
    read = {which: tables.read_csv(spark, f"{path}/split={which}", schema).withColumn("split", F.lit(which))
            for which in ("train", "test")}
    return read["train"].unionByName(read["test"])


@query("name_list__a6", "select c_name as name from customer where c_custkey % 10 <> 3")
def read_name_list(spark, sf_dir):
    """Lines with blanks around the names and some blank lines."""
    path = fresh_path(spark, "names")
    k = F.col("c_custkey")
    line = F.when(k % 10 == 3, "  \t").when(k % 2 == 0, F.concat(F.lit(" "), "c_name", F.lit("\t "))).otherwise(F.col("c_name"))
    V.table(spark, sf_dir, "customer").select(line.alias("value")).write.text(path)
    return records.read_names(spark, path)


@query("name_list__a7", "select distinct c_name as name from customer join orders on c_custkey = o_custkey")
def write_name_list(spark, sf_dir):
    path = fresh_path(spark, "names")
    orders = V.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")).distinct()
    named = V.table(spark, sf_dir, "customer").join(orders, "c_custkey", "left_semi")
    records.write_names(named, path, "c_name")
    return records.read_names(spark, path)


def labels_cells(spark, sf_dir):
    return metrics.confusion(V.table(spark, sf_dir, "labels"), "quality", "toxic")


SUMMARY = """
cells as (select quality as truth, toxic as prediction, count(*) as n from labels group by all),
classes as (select truth as class from cells union select prediction from cells),
scores as (
  select class,
    coalesce((select sum(n) from cells where truth = class and prediction = class), 0) as hits,
    coalesce((select sum(n) from cells where truth = class), 0) as support,
    coalesce((select sum(n) from cells where prediction = class), 0) as predicted
  from classes
),
summary as (
  select avg(hits * 2.0::double / (support + predicted)) as macro_f1,
    avg(case when support > 0 then hits::double / support end) as balanced_accuracy,
    sum(support)::double as n_rows, count(*)::double as n_classes from scores
)"""


@query("eval_metrics__a9", f"""with {SUMMARY}
  select metric, round(value, 9) as value from (
    unpivot summary on macro_f1, balanced_accuracy, n_rows, n_classes into name metric value value)""")
def write_report(spark, sf_dir):
    path = fresh_path(spark, "report")
    metrics.report(metrics.summary(labels_cells(spark, sf_dir))).write.json(path)
    back = spark.read.schema("metric string, value double").json(path)
    return back.select("metric", F.round("value", 9).alias("value"))


@query("score_align__a10", f"""with {O.BEST_CTES}
  select cast(row_number() over (order by feature) - 1 as integer) as position, feature, 999.0::double as fallback
  from (select distinct {O.feature()} as feature from best)""")
def write_feature_order(spark, sf_dir):
    """The vocabulary in training order, saved and read back."""
    best = reshape.add_feature(V.best_marks(spark, sf_dir))
    return tables.materialise(scoring.feature_table(best, reshape.MAX_FEATURES), fresh_path(spark, "features"))


def synthetic_sql() -> str:
    seed = 42

    def normal(salt: str, mean: float, spread: float) -> str:
        u = f"greatest({O.uniform('c_custkey', salt + '/u')}, 1e-9)"
        v = O.uniform("c_custkey", salt + "/v")
        return f"({mean}::double + {spread}::double * sqrt(-2.0::double * ln({u})) * cos(6.283185307179586::double * {v}))"

    cols = ["'Swimmer_' || c_custkey as \"Name\""]
    flags = {"Sex_encoded": 0.5, **{f"Ethnicity_{k}": v for k, v in synthetic.FLAG_SHARES.items()},
             **{i: synthetic.INDICATOR_SHARE for i in synthetic.INDICATORS}}
    for name, share in flags.items():
        cols.append(f"cast({O.uniform('c_custkey', f'{seed}/{name}')} < {share} as integer) as \"{name}\"")
    for name, (mean, spread) in synthetic.BODY.items():
        cols.append(f"round({normal(f'{seed}/{name}', mean, spread)}, 5) as \"{name}\"")
    for name in synthetic.TIME_COLUMNS:
        value = normal(f"{seed}/{name}", synthetic.TIME_MEAN, synthetic.TIME_SPREAD)
        cols.append(f"case when {O.uniform('c_custkey', f'{seed}/{name}/gap')} >= {synthetic.MISSING_SHARE} "
                    f"then round(abs({value}), 5) end as \"{name}\"")
    arms, edge = [], 0.0
    for name, share in synthetic.LABEL_SHARES.items():
        edge += share
        arms.append((f"{O.uniform('c_custkey', f'{seed}/label')} < {round(edge, 6)}", f"'{name}'"))
    cols.append(O.case_chain(arms, "'No_Olympic_Event'") + " as \"Target_Olympic_Event\"")
    return "select " + ",\n".join(cols) + " from customer"


@query("synthetic_wide__a11", synthetic_sql())
def synthetic_table(spark, sf_dir):
    """A synthetic athlete per customer."""
    wide = synthetic.synthetic_wide(V.table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey")
    rounded = [*synthetic.BODY, *synthetic.TIME_COLUMNS]
    return wide.withColumns({c: F.round(c, 5) for c in rounded})
