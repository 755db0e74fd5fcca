"""Races: parsing, ages, best marks, vocabularies."""

from __future__ import annotations

from pyspark.sql import functions as F

from laptrace.functions import dates, events, marks
from laptrace.operators import races as R
from laptrace.operators import reshape, scoring
from laptrace.plans import oracle as O
from laptrace.plans import views as V
from laptrace.plans.registry import query
from laptrace.vocab import COURSES, SCORING_EVENTS


def day(col: str):
    return F.date_format(col, "yyyy-MM-dd")


@query("fastest_by_age__e1", f"with {O.BEST_CTES} select name, event, course, age, time_seconds from best")
def fastest_by_age(spark, sf_dir):
    """Best time per athlete, event, course and age."""
    return V.best_marks(spark, sf_dir)


@query("fastest_by_age__c1", f"""with {O.RACE_RAW}
  select event_name, count(*) as n from race_raw where {O.INDIVIDUAL} group by event_name""")
def individual_events(spark, sf_dir):
    return R.individual(V.race_raw(spark, sf_dir)).groupBy("event_name").agg(F.count(F.lit(1)).alias("n"))


@query("age_at_race__d1", f"""with {O.RACE_CTES}
  select r.name, r.event_name, cast(race_day as varchar) as race_day, cast(born as varchar) as born,
    {O.years("born", "race_day")} as age from races r left join athletes a on a.name = r.name""")
def races_with_age(spark, sf_dir):
    joined = R.with_age(V.races(spark, sf_dir), V.births(spark, sf_dir), V.births_measured(spark, sf_dir))
    return joined.select("name", "event_name", day("race_day").alias("race_day"), day("born").alias("born"), "age")


@query("age_at_race__i6", f"""
  select o_orderkey, {O.years("born", "o_orderdate")} as age
  from (select *, date '1975-01-01' + cast((o_custkey * 37) % 3650 as integer) as born from orders)""")
def completed_years(spark, sf_dir):
    """Age on the day of every order, for a birth date made from the customer key."""
    born = F.date_add(F.lit("1975-01-01").cast("date"), ((F.col("o_custkey") * 37) % 3650).cast("int"))
    return V.table(spark, sf_dir, "orders").select(
        "o_orderkey", dates.completed_years(born, F.to_date("o_orderdate")).alias("age"))


@query("ages_seen__e10", f"with {O.BEST_CTES} select distinct age from best order by age")
def ages_seen(spark, sf_dir):
    return V.best_marks(spark, sf_dir).select("age").distinct().orderBy("age")


@query("parse_dates__i1", f"""with {O.RACE_RAW}
  select race_date, cast({O.race_day("race_date")} as varchar) as race_day, count(*) as n from race_raw group by all""")
def parse_dates(spark, sf_dir):
    """Every date text with its day; equal texts are combined before they are parsed."""
    texts = V.race_raw(spark, sf_dir).groupBy("race_date").agg(F.count(F.lit(1)).alias("n"))
    return texts.select("race_date", F.date_format(dates.race_date(F.col("race_date")), "yyyy-MM-dd").alias("race_day"), "n")


@query("parse_times__i3", f"""with {O.RACE_RAW},
  texts as (select time_text from race_raw union all select '1:' || lpad(time_text, 8, '0') from race_raw
            union all select split_part(time_text, ':', 2) from race_raw union all select 'DQ' || time_text from race_raw)
  select time_text, count(*) as n, case
    when starts_with(time_text, 'DQ') then null
    when len(string_split(time_text, ':')) = 3 then cast(split_part(time_text, ':', 1) as integer) * 3600
      + cast(split_part(time_text, ':', 2) as integer) * 60 + cast(split_part(time_text, ':', 3) as double)
    when len(string_split(time_text, ':')) = 2 then {O.seconds("time_text")}
    else cast(time_text as double) end as seconds
  from texts group by time_text""")
def parse_times(spark, sf_dir):
    """Times with hours, minutes, seconds only, and marks that are no time."""
    raw = V.race_raw(spark, sf_dir).groupBy("time_text").agg(F.count(F.lit(1)).alias("n"))
    forms = F.array(
        F.col("time_text"), F.concat(F.lit("1:"), F.lpad("time_text", 8, "0")),
        F.substring_index("time_text", ":", -1), F.concat(F.lit("DQ"), "time_text"))
    texts = raw.select(F.explode(forms).alias("time_text"), "n").groupBy("time_text").agg(F.sum("n").alias("n"))
    return texts.withColumn("seconds", marks.seconds(F.col("time_text")))


@query("parse_times__i4", """
  select o_orderkey, case when o_orderkey % 4 = 3 then null
    when o_orderkey % 4 = 0 then cast(o_orderkey % 3 as double) * 60 + cast(o_orderkey % 60 || '.' || o_custkey % 100 as double)
    when o_orderkey % 4 = 1 then cast(o_orderkey % 60 || '.' || o_custkey % 100 as double)
    else 1.5 * 60 + cast(o_orderkey % 60 as double) end as seconds from orders""")
def entered_times(spark, sf_dir):
    """Times as a user types them; three parts are not accepted."""
    k = F.col("o_orderkey")
    sec = F.concat((k % 60).cast("string"), F.lit("."), (F.col("o_custkey") % 100).cast("string"))
    text = (
        F.when(k % 4 == 0, F.concat((k % 3).cast("string"), F.lit(":"), sec)).when(k % 4 == 1, sec)
        .when(k % 4 == 2, F.concat(F.lit("1.5:"), (k % 60).cast("string"))).otherwise(F.concat(F.lit("0:1:"), sec)))
    return V.table(spark, sf_dir, "orders").select("o_orderkey", marks.entered_seconds(text).alias("seconds"))


@query("normalise_events__i5", f"""with {O.RACE_RAW}
  select event_name, {O.event_key("event_name")} as event, count(*) as n from race_raw group by all""")
def normalise_events(spark, sf_dir):
    names = V.race_raw(spark, sf_dir).groupBy("event_name").agg(F.count(F.lit(1)).alias("n"))
    return names.withColumn("event", events.event_key(F.col("event_name")))


# --- vocabularies -----------------------------------------------------------------

def grid(ages: str) -> str:
    return (f"(select unnest({O.sql_list(reshape.STRUCTURAL_EVENTS)}) as event) e "
            f"cross join (select unnest({O.sql_list(COURSES)}) as course) c "
            f"cross join (select cast(unnest(range({ages})) as integer) as age) a")


VOCABULARY = f"""
seen as (select event, course, age, count(time_seconds) as n_observed from best group by all),
vocabulary as (
  select coalesce(s.event, g.event) as event, coalesce(s.course, g.course) as course, coalesce(s.age, g.age) as age,
    cast(coalesce(n_observed, 0) as bigint) as n_observed, cast(g.event is not null as integer) as structural
  from seen s full join (select * from {grid("10, 19")}) g
    on g.event = s.event and g.course = s.course and g.age = s.age
)"""


@query("feature_vocabulary__d8", f"""with {O.BEST_CTES}, {VOCABULARY}
  select event, course, age, n_observed, structural from vocabulary""")
def feature_vocabulary(spark, sf_dir):
    """Every structural combination and every observed one, with its number of marks."""
    return reshape.vocabulary(V.best_marks(spark, sf_dir)).drop("feature")


@query("feature_vocabulary__i14", f"""with {O.BEST_CTES}
  select {O.feature()} as feature, count(*) as n from best group by all""")
def feature_names(spark, sf_dir):
    return reshape.add_feature(V.best_marks(spark, sf_dir)).groupBy("feature").agg(F.count(F.lit(1)).alias("n"))


SPELLINGS = f"""
spelled as (
  select distinct case when course = 'SCM' then replace({O.feature()}, 'mFree_', 'mFreestyle_')
                       when course = 'SCY' then replace({O.feature()}, 'mFree_', 'Free_') else {O.feature()} end as feature
  from best
  union
  select distinct replace({O.feature()}, 'mFree_', 'Free_') from best where course = 'LCM'
)"""


@query("standardise_names__b3", f"""with {O.BEST_CTES}, {SPELLINGS}
  select regexp_replace(feature, 'm(Freestyle|Free|Backstroke|Breaststroke|Butterfly|IM)', '\\1', 'g') as standard,
    min(feature) as feature, count(*) as n_sources from spelled group by 1""")
def standardise_names(spark, sf_dir):
    """Mixed spellings of the observed features; where two collapse, the first in column order is kept."""
    feature = F.col("feature")
    named = reshape.add_feature(V.best_marks(spark, sf_dir)).select("course", "feature").distinct()
    plain = F.replace(feature, F.lit("mFree_"), F.lit("Free_"))
    spelled = F.when(F.col("course") == "SCM", F.array(F.replace(feature, F.lit("mFree_"), F.lit("mFreestyle_")))).when(
        F.col("course") == "SCY", F.array(plain)).otherwise(F.array(feature, plain))
    listed = named.select(F.explode(spelled).alias("feature")).distinct()
    return reshape.standard_names(listed.withColumn("ordinal", F.col("feature")))


@query("drop_empty_features__b4", f"""with {O.BEST_CTES}, {VOCABULARY}
  select event || '_' || course || '_Age' || age || '_FastestTime' as feature, n_observed from vocabulary
  where n_observed > 0 or regexp_matches('Age' || age || '_', 'Age1[0-8]')""")
def drop_empty_features(spark, sf_dir):
    """All features that have a value, and the youth features in any case."""
    return reshape.used_features(reshape.vocabulary(V.best_marks(spark, sf_dir))).select("feature", "n_observed")


@query("available_events__i22", f"""with {O.BEST_CTES}
  select distinct course, age, event, {O.feature()} as feature from best
  where event in ({", ".join(f"'{e}'" for e in SCORING_EVENTS)})""")
def available_events(spark, sf_dir):
    """Events a user of a given course and age can enter times for."""
    best = V.best_marks(spark, sf_dir)
    vocabulary = reshape.add_feature(best.select("event", "course", "age").distinct())
    return scoring.available(vocabulary, vocabulary)


REQUEST_COURSES = ["LCM", "SCM", "SCY", "OPEN"]


@query("available_events__i22_requests", f"""with {O.BEST_CTES},
  offered as (select course, age, list_sort(list(distinct event)) as events from best
    where event in ({", ".join(f"'{e}'" for e in SCORING_EVENTS)}) group by course, age),
  requests as (select c_custkey as request, {O.at(REQUEST_COURSES, "c_custkey % 4")} as course,
    case when c_custkey % 11 <> 0 then cast(5 + c_custkey % 35 as integer) end as age from customer),
  near as (
    select request, o.age as nearest_age, o.events, row_number() over (partition by request order by abs(o.age - r.age), o.age) as place
    from requests r join offered o on o.course = r.course where r.age is not null)
  select r.request, r.course, r.age, coalesce(array_to_string(o.events, ';'), '') as offered, n.nearest_age,
    coalesce(array_to_string(n.events, ';'), '') as nearest
  from requests r left join offered o on o.course = r.course and o.age = r.age left join near n on n.request = r.request and place = 1""")
def answered_requests(spark, sf_dir):
    """What every customer can enter times for, requests that nothing is offered for included."""
    k = F.col("c_custkey")
    requests = V.table(spark, sf_dir, "customer").select(
        k.alias("request"), V.pick(REQUEST_COURSES, k % 4).alias("course"),
        F.when(k % 11 != 0, 5 + k % 35).cast("int").alias("age"))
    vocabulary = V.stored_best_marks(spark, sf_dir).select("event", "course", "age").distinct()
    found = scoring.answers(requests, vocabulary)
    return found.select("request", "course", "age", F.array_join("offered", ";").alias("offered"), "nearest_age",
                        F.array_join("nearest", ";").alias("nearest"))
