"""Labels, estimates for missing marks, splits, weights and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from laptrace.functions import events, marks
from laptrace.functions.lookups import by_age
from laptrace.operators import chain, impute, labels, metrics, races, reshape, scoring, splits
from laptrace.plans import oracle as O
from laptrace.plans import training as T
from laptrace.plans import views as V
from laptrace.plans.athlete_queries import BMI, SEX
from laptrace.plans.race_queries import VOCABULARY, grid
from laptrace.plans.registry import query
from laptrace.plans.source_queries import ORDER_SPLIT, SUMMARY, labels_cells
from laptrace.session import fresh_path
from laptrace.sources.tables import materialise
from laptrace.vocab import (
    ADVICE, BASELINE_BY_DISTANCE, BASELINE_FACTORS, BASELINE_SECONDS, LABEL_BY_EVENT,
    PROGRESSION_DEFAULT, PROGRESSION_FACTORS, THRESHOLDS, YOUTH_AGES,
)


def names_of(spark, sf_dir):
    return V.athletes(spark, sf_dir).select(F.col("Name").alias("name"))


# --- labels from marks ------------------------------------------------------------

THRESHOLD_SQL = " ".join(
    f"when '{label}' then coalesce({O.case({10 + i: v for i, v in enumerate(values)}, 'age')}, 999.0)"
    for label, values in THRESHOLDS.items())
THRESHOLD_SQL = f"cast((case candidate {THRESHOLD_SQL} else 999.0 end) as double)"

TOP = f"""
valid as (select *, {O.feature()} as feature from best where time_seconds > 0 and time_seconds < 999),
top as (
  select * exclude (r) from (
    select *, row_number() over (partition by name order by time_seconds, feature) as r from valid) where r = 1
),
judged as (select *, {O.case(LABEL_BY_EVENT, "event")} as candidate from top),
labelled as (
  select a.name, feature, time_seconds, candidate,
    case when candidate is not null and time_seconds <= {THRESHOLD_SQL} then candidate else 'No_Olympic_Event' end as label
  from athletes a left join judged j on j.name = a.name
)"""


@query("best_event_label__k1", f"with {O.BEST_CTES}, {TOP} select name, feature, time_seconds, candidate, label from labelled")
def label_from_marks(spark, sf_dir):
    """Event of the best mark where it meets the threshold for its age."""
    return labels.from_marks(names_of(spark, sf_dir), V.best_marks(spark, sf_dir)).select(
        "name", "feature", "time_seconds", "candidate", "label")


@query("best_event_label__c3", f"""with {O.RACE_CTES}
  select course, event, count(*) as n_valid from races where time_seconds > 0 and time_seconds < 999 group by all""")
def valid_marks(spark, sf_dir):
    return V.races(spark, sf_dir).where(marks.is_valid_mark(F.col("time_seconds"))).groupBy("course", "event").agg(
        F.count(F.lit(1)).alias("n_valid"))


@query("best_event_label__d6", f"""with {O.BEST_CTES},
  known as (select *, {O.case(LABEL_BY_EVENT, "event")} as candidate from best)
  select candidate, age, {THRESHOLD_SQL} as threshold, count(*) as n_marks,
    count(*) filter (where time_seconds <= {THRESHOLD_SQL}) as n_pass
  from known where candidate is not null group by all""")
def thresholds_met(spark, sf_dir):
    """Marks that meet the threshold of their event and age; open where the table has none."""
    known = V.best_marks(spark, sf_dir).withColumn("candidate", events.event_label(F.col("event")))
    judged = known.where("candidate is not null").withColumn("threshold", labels.threshold(F.col("candidate"), F.col("age")))
    return judged.groupBy("candidate", "age", "threshold").agg(
        F.count(F.lit(1)).alias("n_marks"),
        F.count(F.when(F.col("time_seconds") <= F.col("threshold"), 1)).alias("n_pass"))


@query("best_event_label__e8", f"with {O.BEST_CTES}, {TOP} select name, feature, time_seconds from top")
def best_feature(spark, sf_dir):
    """Smallest time over all features; ties go to the first in column order."""
    return labels.best_mark(V.best_marks(spark, sf_dir)).select("name", "feature", "time_seconds")


@query("best_event_label__i16", f"""with {O.RACE_CTES}
  select event, {O.case(LABEL_BY_EVENT, "event")} as label, count(*) as n from races group by all""")
def event_labels(spark, sf_dir):
    found = V.races(spark, sf_dir).groupBy("event").agg(F.count(F.lit(1)).alias("n"))
    return found.withColumn("label", events.event_label(F.col("event")))


@query("label_distribution__e4", f"with {O.BEST_CTES}, {TOP} select label, count(*) as n from labelled group by label")
def label_distribution(spark, sf_dir):
    labelled = labels.from_marks(names_of(spark, sf_dir), V.best_marks(spark, sf_dir))
    return labels.distribution(labelled).orderBy(F.desc("n"), "label")


@query("label_distribution__e5", f"""with {O.BEST_CTES}, {TOP}
  select count(distinct label) as n_classes, count(*) as n_rows from labelled""")
def label_classes(spark, sf_dir):
    labelled = labels.from_marks(names_of(spark, sf_dir), V.best_marks(spark, sf_dir))
    return labels.distribution(labelled).agg(F.count("label").alias("n_classes"), F.sum("n").alias("n_rows"))


ADVICE_SQL = O.case_chain([(f"contains(label, '{k}')", f"'{v}'") for k, v in ADVICE.items()], "null")


@query("score_report__i19", f"""with {O.BEST_CTES}, {TOP}
  select name, label, cast(label <> 'No_Olympic_Event' as integer) as has_event,
    case when label <> 'No_Olympic_Event' then {ADVICE_SQL} end as advice from labelled""")
def score_report(spark, sf_dir):
    """Advice line for each athlete's event, none without an event."""
    labelled = labels.from_marks(names_of(spark, sf_dir), V.best_marks(spark, sf_dir)).select("name", "label")
    return scoring.report(labelled, "label")


# --- estimates for missing marks -----------------------------------------------------

PROGRESSION = f"""
adult as (
  select name, event, course, min(time_seconds) as best_adult from best where age between 20 and 49 group by all
),
estimated as (
  select a.name, a.event, a.course, v.age, best_adult,
    best_adult * coalesce({O.case({10 + i: v for i, v in enumerate(PROGRESSION_FACTORS)}, "v.age")}, {PROGRESSION_DEFAULT}::double) as time_seconds
  from adult a join vocabulary v on v.event = a.event and v.course = a.course and v.age between 10 and 18
  left join best b on b.name = a.name and b.event = a.event and b.course = a.course and b.age = v.age
  where b.name is null
)"""


def estimated_marks(spark, sf_dir):
    best = V.stored_best_marks(spark, sf_dir)
    return impute.progression(best, reshape.vocabulary(best))


@query("progression_impute__k3", f"""with {O.BEST_CTES}, {VOCABULARY}, {PROGRESSION}
  select name, event, course, age, round(time_seconds, 6) as time_seconds from estimated""")
def progression_impute(spark, sf_dir):
    """Youth marks estimated from the athlete's own adult best."""
    return estimated_marks(spark, sf_dir).select(
        "name", "event", "course", "age", F.round("time_seconds", 6).alias("time_seconds"))


@query("progression_impute__d5", f"""with {O.BEST_CTES}, {VOCABULARY}, {PROGRESSION}
  select event, course, age, count(*) as n_filled from estimated group by all""")
def similar_events(spark, sf_dir):
    """Youth features met with an adult feature of the same event and course."""
    return estimated_marks(spark, sf_dir).groupBy("event", "course", "age").agg(F.count(F.lit(1)).alias("n_filled"))


@query("progression_impute__e13", f"with {O.BEST_CTES}, {VOCABULARY}, {PROGRESSION} select * from adult")
def adult_best(spark, sf_dir):
    return races.adult_best(V.best_marks(spark, sf_dir))


@query("progression_impute__i20", f"""with {O.BEST_CTES}
  select name, event, course, age, round(time_seconds * coalesce(
    {O.case({10 + i: v for i, v in enumerate(PROGRESSION_FACTORS)}, "age")}, {PROGRESSION_DEFAULT}::double), 6) as aged
  from best""")
def age_factors(spark, sf_dir):
    """Factor of the age of a mark, with its default outside of the table."""
    factor = by_age(PROGRESSION_FACTORS, F.col("age"), YOUTH_AGES[0], PROGRESSION_DEFAULT)
    return V.best_marks(spark, sf_dir).select(
        "name", "event", "course", "age", F.round(F.col("time_seconds") * factor, 6).alias("aged"))


BASELINE_SQL = f"""coalesce({O.case(BASELINE_SECONDS, "event")},
  {O.case(BASELINE_BY_DISTANCE, "cast(regexp_extract(event, '^([0-9]+)', 1) as integer)")}, 60.0::double)"""
BASELINE_FACTOR_SQL = f"coalesce({O.case({10 + i: v for i, v in enumerate(BASELINE_FACTORS)}, 'age')}, 1.20::double)"


SPLIT_NAMES = f"""
common as (select label from labelled group by label having count(*) >= 2),
ranked as (
  select name, label, row_number() over (partition by label order by md5(name || '|42'), name) as r,
    count(*) over (partition by label) as n from labelled where label in (select label from common)
),
assigned as (select name, label, case when r <= floor(n * 0.2) then 'test' else 'train' end as split,
  cast(r % 5 as integer) as fold from ranked)"""

# Marks with their split, features by split, and every value there is or that is estimated.
CHAIN = f"""
marked as (select b.*, split from best b join assigned using (name)),
kept as (
  select event, course, age, {O.feature()} as feature from (
    select event, course, age, count(*) filter (where split = 'train') as n_train from marked group by all
    union all select event, course, age, 0 from {grid("10, 19")}) group by all
  having sum(n_train) > 0 or age between 10 and 18
),
best_adults as (
  select name, split, event, course, min(time_seconds) as best_adult from marked where age between 20 and 49 group by all
),
known as (
  select m.name, m.split, k.feature, m.time_seconds as value, 0 as estimated
  from marked m join kept k on k.event = m.event and k.course = m.course and k.age = m.age
  union all
  select a.name, a.split, k.feature, best_adult * coalesce(
    {O.case({10 + i: v for i, v in enumerate(PROGRESSION_FACTORS)}, "k.age")}, {PROGRESSION_DEFAULT}::double), 1
  from best_adults a join kept k on k.event = a.event and k.course = a.course and k.age between 10 and 18
  left join marked m on m.name = a.name and m.event = a.event and m.course = a.course and m.age = k.age
  where m.name is null
)"""
BODY_CELLS = f"""
body_cells as (
  select name, split, feature, value, 0 as estimated from (
    select name, split, unnest(['Height_cm', 'Weight_kg', 'BMI', 'Sex_encoded']) as feature,
      unnest([height_cm, weight_kg, {BMI}, {SEX}]::double[]) as value
    from athletes join assigned using (name)) where value is not null
),
cells as (select * from known union all select * from body_cells)"""
FILLS = f"""
fills as (
  select coalesce(m.feature, k.feature) as feature, case when median is not null then 'median' else 'baseline' end as source,
    coalesce(median, {BASELINE_SQL} * {BASELINE_FACTOR_SQL}) as fill
  from (select feature, median(value) as median from cells where split = 'train' group by feature) m
  full join (select * from kept where age between 10 and 18) k on k.feature = m.feature
)"""


def imputation(spark, sf_dir):
    """The whole chain, fitted on the training athletes."""
    people, best = V.athletes(spark, sf_dir), V.stored_best_marks(spark, sf_dir)
    assigned = materialise(T.assign_splits(people, best), fresh_path(spark, "split"))
    return chain.fit(best, T.body_values(people), assigned)


@query("baseline_fill__k4", f"""with {O.BEST_CTES}, {TOP}, {SPLIT_NAMES}, {CHAIN}
  select feature, round({BASELINE_SQL} * {BASELINE_FACTOR_SQL}, 6) as fill from kept k
  where age between 10 and 18 and not exists (select 1 from known n where n.feature = k.feature and split = 'train')""")
def baseline_fill(spark, sf_dir):
    """Fill values of youth features for which no training athlete has a mark or an estimate."""
    return imputation(spark, sf_dir).fills.where("source = 'baseline'").select("feature", F.round("fill", 6).alias("fill"))


@query("imputation_chain__k5", f"""with {O.BEST_CTES}, {TOP}, {SPLIT_NAMES}, {CHAIN}, {BODY_CELLS}, {FILLS},
  counted as (select feature, split, count(*) filter (where estimated = 0) as n_own,
    count(*) filter (where estimated = 1) as n_estimated, sum(cast(round(value * 1000000) as bigint)) as known from cells group by feature, split),
  rows_of as (select split, count(*) as n_rows from assigned group by split)
  select feature, split, coalesce(n_own, 0) as n_own, coalesce(n_estimated, 0) as n_estimated,
    n_rows - coalesce(n_own, 0) - coalesce(n_estimated, 0) as n_filled, source, round(fill, 6) as fill,
    (coalesce(known, 0) + (n_rows - coalesce(n_own, 0) - coalesce(n_estimated, 0)) * cast(round(fill * 1000000) as bigint))
      / 1000000::double as total
  from fills cross join rows_of left join counted using (feature, split)""")
def imputation_chain(spark, sf_dir):
    """Every time and body column of both splits after imputation: where its cells come from, its fill and its sum."""
    return chain.profile(imputation(spark, sf_dir)).withColumn("fill", F.round("fill", 6))


@query("imputation_chain__k5_rows", f"""with {O.BEST_CTES}, {TOP}, {SPLIT_NAMES}, {CHAIN}, {BODY_CELLS}, {FILLS}
  select a.name, a.split, count(c.value) filter (where estimated = 0) as n_own,
    count(c.value) filter (where estimated = 1) as n_estimated, count(*) - count(c.value) as n_filled,
    sum(cast(round(coalesce(c.value, fill) * 1000000) as bigint)) / 1000000::double as total
  from assigned a cross join fills f left join cells c on c.name = a.name and c.feature = f.feature group by a.name, a.split""")
def imputed_rows(spark, sf_dir):
    """Every athlete's row after imputation: its own, estimated and filled cells and their sum."""
    return chain.filled_rows(imputation(spark, sf_dir))


@query("eval_metrics__a9_imputation", f"""with {O.BEST_CTES}, {TOP}, {SPLIT_NAMES}, {CHAIN}, {BODY_CELLS}, {FILLS},
  counted as (select f.feature, f.source, fill, r.split, n_rows,
      count(c.value) filter (where estimated = 0) as n_own, count(c.value) filter (where estimated = 1) as n_estimated
    from fills f cross join (select split, count(*) as n_rows from assigned group by split) r
    left join cells c on c.feature = f.feature and c.split = r.split group by all),
  totals as (select split, count(*) as n_features, sum(n_rows - n_own) as missing, sum(n_estimated) as estimated,
      sum(case when fill is null then n_rows - n_own - n_estimated else 0 end) as still,
      count(*) filter (where n_own = 0) as without, count(*) filter (where source = 'baseline') as baseline
    from counted group by split)
  select metric, value::double as value from (
    select 'missing_before_' || split as metric, missing as value from totals union all
    select 'estimated_' || split, estimated from totals union all select 'missing_after_' || split, still from totals union all
    select 'n_features', n_features from totals where split = 'train' union all
    select 'features_without_values', without from totals where split = 'train' union all
    select 'features_with_baseline', baseline from totals where split = 'train')""")
def imputation_report(spark, sf_dir):
    """Missing values before and after imputation, and features without values, observed while the profile is written."""
    return chain.write_profile(imputation(spark, sf_dir), fresh_path(spark, "profile"))


@query("baseline_fill__d6", f"""with {O.BEST_CTES}
  select event, {BASELINE_SQL} as baseline, count(*) as n_marks from best group by event""")
def baselines(spark, sf_dir):
    """Baseline of every event that occurs; unknown ones by distance, else the default."""
    found = V.best_marks(spark, sf_dir).groupBy("event").agg(F.count(F.lit(1)).alias("n_marks"))
    return found.withColumn("baseline", events.baseline_seconds(F.col("event")))


@query("baseline_fill__i21", f"""with {O.BEST_CTES}, {VOCABULARY},
  f as (select {O.feature()} as feature, {BASELINE_SQL} * {BASELINE_FACTOR_SQL} as fill
        from vocabulary where n_observed = 0 and age between 10 and 18)
  select feature, round(fill * (0.97::double + {O.uniform("feature", "42")} * 0.06::double), 6) as fill from f""")
def jittered_fill(spark, sf_dir):
    """Baselines of youth features nobody has a mark for, with the opt-in jitter of 3 %, drawn from a hash of the feature."""
    filled = impute.baseline(reshape.vocabulary(V.best_marks(spark, sf_dir)), seed=42)
    return filled.select("feature", F.round("fill", 6).alias("fill"))


@query("median_impute__e7", f"""with {O.BEST_CTES}, {TOP}, {SPLIT_NAMES}
  select {O.feature()} as feature, round(median(time_seconds), 6) as median
  from best join assigned using (name) where split = 'train' group by 1""")
def train_medians(spark, sf_dir):
    """Exact median of every feature over the training athletes."""
    best = V.stored_best_marks(spark, sf_dir)
    assigned = T.assign_splits(V.athletes(spark, sf_dir), best)
    train = reshape.add_feature(best).join(assigned.where("split = 'train'").select("name"), "name", "left_semi")
    return impute.fit_medians(train, value="time_seconds").select("feature", F.round("median", 6).alias("median"))


@query("median_impute__e7_orders", """
  select o_orderpriority, o_orderstatus, round(median(o_totalprice), 6) as median from orders group by all""")
def order_medians(spark, sf_dir):
    """Exact medians of a few very large groups."""
    from laptrace.operators.quantiles import exact_median

    found = exact_median(V.table(spark, sf_dir, "orders"), ["o_orderpriority", "o_orderstatus"], "o_totalprice")
    return found.withColumn("median", F.round("median", 6))


BODY = """
body as (
  select name, split, unnest(['height_cm', 'weight_kg', 'bmi']) as feature,
    unnest([height_cm, weight_kg, case when height_cm > 0 then weight_kg / pow(height_cm / 100, 2) end]) as value
  from athletes join assigned using (name)
),
fitted as (select feature, median(value) as median from body where split = 'train' group by feature)"""


@query("median_impute__k5", f"""with {O.BEST_CTES}, {TOP}, {SPLIT_NAMES}, {BODY}
  select name, split, feature, round(coalesce(value, median), 6) as value from body join fitted using (feature)""")
def median_impute(spark, sf_dir):
    """Body measures of both splits, gaps filled with the training median."""
    people = V.athletes(spark, sf_dir)
    assigned = T.assign_splits(people, V.stored_best_marks(spark, sf_dir))
    measures = {"height_cm": F.col("Height_cm"), "weight_kg": F.col("Weight_kg"),
                "bmi": F.when(F.col("Height_cm") > 0, F.col("Weight_kg") / F.pow(F.col("Height_cm") / 100, F.lit(2)))}
    long = people.select(F.col("Name").alias("name"), *[c.alias(n) for n, c in measures.items()]).unpivot(
        ["name"], list(measures), "feature", "value")
    values = long.join(assigned.select("name", "split"), "name")
    medians = impute.fit_medians(values.where("split = 'train'"), max_features=len(measures))
    return impute.apply_medians(values, medians, max_features=len(measures)).select("name", "split", "feature", F.round("value", 6).alias("value"))


# --- splits and weights ------------------------------------------------------------------


@query("stratified_split__f5", f"with {ORDER_SPLIT} select o_orderkey, o_orderpriority, split from split_orders")
def stratified_split(spark, sf_dir):
    """80/20 split of all orders within their priority."""
    orders = V.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return splits.stratified(orders, "o_orderkey", "o_orderpriority").drop("fold")


@query("stratified_split__f6", f"with {ORDER_SPLIT} select o_orderkey, fold from split_orders")
def stratified_folds(spark, sf_dir):
    orders = V.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return splits.stratified(orders, "o_orderkey", "o_orderpriority").select("o_orderkey", "fold")


@query("stratified_split__c7", """select o_orderkey, o_custkey from orders
  where o_custkey in (select o_custkey from orders group by o_custkey having count(*) >= 10)""")
def common_classes(spark, sf_dir):
    """Orders of customers with at least ten of them."""
    orders = V.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return splits.without_rare(orders, "o_custkey", 10)


@query("class_weights__k8", """select o_orderpriority, count(*) as class_rows,
  round((select count(*) from orders) / ((select count(distinct o_orderpriority) from orders) * count(*)), 9) as class_weight
  from orders group by o_orderpriority""")
def class_weights(spark, sf_dir):
    weights = splits.class_weights(V.table(spark, sf_dir, "orders"), "o_orderpriority")
    return weights.withColumn("class_weight", F.round("class_weight", 9))


# --- metrics ------------------------------------------------------------------------------

MULTI = """
predicted as (
  select substr(o_orderpriority, 1, 1) as truth,
    case when o_orderstatus = 'F' then substr(o_orderpriority, 1, 1) when o_orderstatus = 'O' then '1' else '6' end as prediction
  from orders
),
cells as (select truth, prediction, count(*) as n from predicted group by all),
classes as (select truth as class from cells union select prediction from cells),
scores as (
  select class, cast(coalesce((select sum(n) from cells where truth = class and prediction = class), 0) as bigint) as hits,
    cast(coalesce((select sum(n) from cells where truth = class), 0) as bigint) as support,
    cast(coalesce((select sum(n) from cells where prediction = class), 0) as bigint) as predicted
  from classes
)"""


def multi_class_cells(spark, sf_dir):
    truth = F.substring("o_orderpriority", 1, 1)
    prediction = F.when(F.col("o_orderstatus") == "F", truth).when(F.col("o_orderstatus") == "O", "1").otherwise("6")
    orders = V.table(spark, sf_dir, "orders").select(truth.alias("truth"), prediction.alias("prediction"))
    return metrics.confusion(orders, "truth", "prediction")


@query("eval_metrics__e11", f"""with {MULTI}
  select class, hits, support, predicted, round(hits * 2.0::double / (support + predicted), 9) as f1 from scores""")
def class_f1(spark, sf_dir):
    """F1 per class, one of which is never true."""
    scores = metrics.per_class(multi_class_cells(spark, sf_dir))
    return scores.select("class", "hits", "support", "predicted", F.round("f1", 9).alias("f1"))


@query("eval_metrics__e12", f"""with {MULTI}
  select round(avg(hits * 2.0::double / (support + predicted)), 9) as macro_f1,
    round(avg(case when support > 0 then hits::double / support end), 9) as balanced_accuracy from scores""")
def macro_scores(spark, sf_dir):
    summary = metrics.summary(multi_class_cells(spark, sf_dir))
    return summary.select(F.round("macro_f1", 9).alias("macro_f1"), F.round("balanced_accuracy", 9).alias("balanced_accuracy"))


@query("eval_metrics__k9", f"""with {SUMMARY}
  select round(macro_f1, 9) as macro_f1, round(balanced_accuracy, 9) as balanced_accuracy,
    cast(n_rows as bigint) as n_rows, cast(n_classes as bigint) as n_classes from summary""")
def holdout_scores(spark, sf_dir):
    """Quality flag as truth, toxic flag as prediction."""
    return metrics.summary(labels_cells(spark, sf_dir)).withColumns({
        "macro_f1": F.round("macro_f1", 9), "balanced_accuracy": F.round("balanced_accuracy", 9)})


# --- vectors ----------------------------------------------------------------------------------


@query("score_align__k10", f"""with {O.BEST_CTES},
  body as (
    select name, 'Height_cm' as feature, height_cm as value from athletes
    union all select name, 'Weight_kg', weight_kg from athletes union all select name, 'BMI', {BMI} from athletes
    union all select name, 'Sex_encoded', {SEX} from athletes),
  features as (select distinct {O.feature()} as feature from best union select unnest(['Height_cm', 'Weight_kg', 'BMI', 'Sex_encoded'])),
  given as (select name, {O.feature()} as feature, time_seconds as value from best
    union all select * from body where value is not null),
  cells as (
    select a.name, f.feature, g.value is not null as own,
      cast(coalesce(g.value, case when contains(f.feature, 'FastestTime') then 999.0 else 0.0 end) as double) as value
    from athletes a cross join features f left join given g on g.name = a.name and g.feature = f.feature)
  select name, cast(count(*) as integer) as n_features, cast(count(*) filter (where own) as integer) as n_given,
    md5(string_agg(printf('%.6f', value), ';' order by feature)) as vector_md5
  from cells group by name""")
def aligned_requests(spark, sf_dir):
    """Requests that give all times and body measures, as one dense array each in training order."""
    best = V.stored_best_marks(spark, sf_dir)
    people = V.athletes(spark, sf_dir)
    body = T.body_values(people)
    listed = reshape.add_feature(best).select("feature").unionByName(
        spark.createDataFrame([(f,) for f in T.BODY_FEATURES], "feature string"))
    features = materialise(scoring.feature_table(listed, T.MODEL_FEATURES), fresh_path(spark, "features"))
    fallbacks = [r["fallback"] for r in features.orderBy("position").collect()]
    given = scoring.given_values(T.mark_values(best).unionByName(body), features, "name")
    aligned = scoring.align(people.select(F.col("Name").alias("name")).join(given, "name", "left"), fallbacks)
    text = F.array_join(F.transform("aligned", lambda v: F.format_string("%.6f", v)), ";")
    return aligned.select("name", F.size("aligned").alias("n_features"),
                          F.coalesce(F.size("given"), F.lit(0)).alias("n_given"), F.md5(text).alias("vector_md5"))


@query("score_align__k10_sparse", f"""with {O.BEST_CTES}, {TOP}, {SPLIT_NAMES}, {CHAIN}, {BODY_CELLS}, {FILLS},
  coded as (select row_number() over (order by feature) - 1 as position, feature, fill,
    case when contains(feature, 'FastestTime') then 999.0::double else 0.0 end as fixed from fills),
  own as (select c.name, position, c.value from cells c join coded using (feature) where estimated = 0),
  texts as (select name, md5(string_agg(position || '=' || printf('%.6f', value), ';' order by position)) as given_md5 from own group by name)
  select a.name, count(o.value) as n_given, coalesce(any_value(given_md5), md5('')) as given_md5,
    sum(cast(round(coalesce(o.value, fill) * 1000000) as bigint)) / 1000000::double as total,
    sum(cast(round(coalesce(o.value, fixed) * 1000000) as bigint)) / 1000000::double as total_fixed
  from assigned a cross join coded f left join own o on o.name = a.name and o.position = f.position
  left join texts t on t.name = a.name group by a.name""")
def sparse_requests(spark, sf_dir):
    """Requests as dictionary-coded sparse rows, filled by fitted values and by the fixed ones."""
    made = imputation(spark, sf_dir)
    coded = materialise(scoring.dictionary(made.fills.select("feature", "fill")), fresh_path(spark, "dictionary"))
    given = scoring.sparse_rows(made.own, coded, "name")
    rows = materialise(made.assigned.select("name").join(given, "name", "left"), fresh_path(spark, "sparse"))
    text = F.array_join(F.transform("given", lambda g: F.concat(
        g["position"].cast("string"), F.lit("="), F.format_string("%.6f", g["value"]))), ";")
    fitted, fixed = (scoring.filled_sums(rows, scoring.defaults(coded, f), "name") for f in (True, False))
    return (rows.select("name", F.md5(F.coalesce(text, F.lit(""))).alias("given_md5"))
            .join(fitted, "name").join(fixed.select("name", F.col("total").alias("total_fixed")), "name"))
