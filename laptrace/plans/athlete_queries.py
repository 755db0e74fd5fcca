"""Athlete records: names, encodings, audits, skip lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from laptrace.functions import encoding, jsontext, names
from laptrace.operators import athletes as A
from laptrace.operators import joins, labels, reshape
from laptrace.plans import oracle as O
from laptrace.plans import views as V
from laptrace.plans.registry import query
from laptrace.plans.source_queries import TIMES_SQL, WIDE_FEATURES, wide_sql
from laptrace.vocab import GROUP_LABELS, PROGRAMME_EVENTS, REQUIRED_ATHLETE_FIELDS

# --- column names, encodings ----------------------------------------------------


@query("conform_athletes__b1", f"""with {O.ATHLETES}
  select name as "Name", dob as "Date_of_Birth", gender as "Sex", height_cm as "Height_cm",
    weight_kg as "Weight_kg", race as "Ethnicity", array_to_string(paris_2024_races, '; ') as entered,
    b as batch from athletes_raw cross join (values ('a'), ('b')) v(b)""")
def conform_athletes(spark, sf_dir):
    """Two batches under different column names end up under the same ones."""
    first = V.athletes_raw(spark, sf_dir)
    second = first.withColumnsRenamed({
        "name": "Swimmer_ID", "dob": "Date_of_Birth", "gender": "Sex", "height_cm": "Height_cm",
        "weight_kg": "Weight_kg", "race": "Ethnicity"})
    both = joins.append([A.conform(first).withColumn("batch", F.lit("a")), A.conform(second).withColumn("batch", F.lit("b"))])
    return both.withColumn("entered", F.array_join("paris_2024_races", "; ")).drop("paris_2024_races")


BMI = "case when height_cm > 0 then weight_kg / pow(height_cm / 100, 2) end"
SEX = "case lower(trim(gender)) when 'male' then 0 when 'm' then 0 when 'female' then 1 when 'f' then 1 end"


def flag_name(group: str) -> str:
    return "Ethnicity_" + group.title().replace(" ", "_")


FLAGS = ", ".join(
    f"cast(coalesce(replace(lower(race), ' ', '_'), '') = '{g.replace(' ', '_')}' as integer) as \"{flag_name(g)}\""
    for g in GROUP_LABELS)


@query("body_index__b7", f"with {O.ATHLETES} select name, round({BMI}, 9) as bmi from athletes")
def body_index(spark, sf_dir):
    raw = V.athletes_raw(spark, sf_dir)
    bmi = encoding.body_index(F.col("weight_kg"), F.col("height_cm"))
    return raw.select("name", F.round(bmi, 9).alias("bmi"))


@query("encode_demographics__b8", f"with {O.ATHLETES} select name, gender, {SEX} as sex_encoded from athletes")
def sex_codes(spark, sf_dir):
    return V.athletes_raw(spark, sf_dir).select(
        "name", "gender", encoding.sex_code(F.col("gender")).alias("sex_encoded"))


@query("encode_demographics__b9", f"with {O.ATHLETES} select name, race, {FLAGS} from athletes")
def group_flags(spark, sf_dir):
    raw = V.athletes_raw(spark, sf_dir)
    return raw.select("name", "race", *[
        c.alias(n) for n, c in encoding.one_hot(F.col("race"), GROUP_LABELS, "Ethnicity_").items()])


@query("encode_demographics__i18", f"""with {O.ATHLETES}
  select replace(lower(race), ' ', '_') as slug, count(*) as n from athletes group by all""")
def label_slugs(spark, sf_dir):
    return V.athletes_raw(spark, sf_dir).groupBy(
        encoding.label_slug(F.col("race")).alias("slug")).agg(F.count(F.lit(1)).alias("n"))


# --- wide form --------------------------------------------------------------------

INDICATOR_SQL = f"""
entries as (
  select r.name, p.event as programme_event from races r
  join (select unnest({O.sql_list(PROGRAMME_EVENTS)}) as event) p
    on r.course = 'LCM' and not contains(lower(event_name), 'relay')
    and r.event = regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(p.event, ' ', ''),
      'Freestyle$', 'Free'), 'Backstroke$', 'Back'), 'Breaststroke$', 'Breast'), 'Butterfly$', 'Fly')
),
pairs as (
  select distinct name, 'Olympic_' || replace(replace(programme_event, ' ', '_'), 'm', 'm_') as indicator from entries
)"""
INDICATORS = labels.indicator_columns()
INDICATOR_CELLS = ", ".join(
    f"coalesce(max(case when indicator = '{c}' then 1 else 0 end), 0) as \"{c}\"" for c in INDICATORS)


def encoded_athletes(spark, sf_dir):
    return A.encode(V.athletes(spark, sf_dir))


def times_columns():
    """How many times a row has, and all of them."""
    return [F.coalesce(F.size("times"), F.lit(0)).alias("n_times"), reshape.times_text(F.col("times")).alias("times")]


WIDE_SQL = f"wide as (select name, count(*) as n_times, {TIMES_SQL} as times from best group by name)"


@query("wide_features__b2", f"""with {O.BEST_CTES}, {INDICATOR_SQL}, {WIDE_SQL},
  flags as (select a.name, {INDICATOR_CELLS} from athletes a left join pairs p on p.name = a.name group by a.name)
  select a.name as "Name", {SEX} as "Sex_encoded", {FLAGS}, flags.* exclude (name),
    height_cm as "Height_cm", weight_kg as "Weight_kg", round({BMI}, 9) as "BMI",
    cast(coalesce(n_times, 0) as integer) as n_times, coalesce(times, '') as times
  from athletes a left join flags on flags.name = a.name left join wide on wide.name = a.name""")
def wide_features(spark, sf_dir):
    """The full wide table, a row per athlete in its fixed order, with every observed time."""
    people = encoded_athletes(spark, sf_dir)
    flags = labels.widen_indicators(people.select(F.col("Name").alias("name")), labels.entered(V.race_raw(spark, sf_dir)))
    wide = reshape.attach_wide(reshape.attach_wide(people, flags, "Name", "name"),
                               reshape.wide_rows(V.best_marks(spark, sf_dir)), "Name", "name")
    lead = ["Name", "Sex_encoded", *[flag_name(g) for g in GROUP_LABELS]]
    order = reshape.ordered_columns(wide.columns, lead, ["Height_cm", "Weight_kg", "BMI"])
    return wide.select(*order, *times_columns()).withColumn("BMI", F.round("BMI", 9))


@query("wide_features__b5", f"""with {O.BEST_CTES}
  {wide_sql(WIDE_FEATURES, only_known=True)}""")
def structural_columns(spark, sf_dir):
    """Columns of the vocabulary that nobody has a mark for exist and are null."""
    return reshape.widen(V.best_marks(spark, sf_dir), WIDE_FEATURES)


@query("wide_features__d2", f"""with {O.BEST_CTES}, {WIDE_SQL}
  select a.name, a.height_cm, cast(coalesce(n_times, 0) as integer) as n_times, coalesce(times, '') as times
  from athletes a left join wide on wide.name = a.name""")
def athletes_with_times(spark, sf_dir):
    """Athletes without any race stay."""
    people = V.athletes(spark, sf_dir).select(F.col("Name").alias("name"), F.col("Height_cm").alias("height_cm"))
    wide = reshape.attach_wide(people, reshape.wide_rows(V.best_marks(spark, sf_dir)), "name", "name")
    return wide.select("name", "height_cm", *times_columns())


@query("wide_features__e2", f"""with {O.BEST_CTES},
  cells as (select name, course, event, min(time_seconds) as t from best group by all)
  select name, course, cast(count(*) as integer) as n_events,
    string_agg(event || '=' || printf('%.2f', t), ';' order by event || '=') as events
  from cells group by name, course""")
def pivot_events(spark, sf_dir):
    """Best time of every event side by side, per athlete and course: one map for each."""
    best = V.best_marks(spark, sf_dir)
    cells = best.groupBy("name", "course", "event").agg(F.min("time_seconds").alias("t"))
    wide = cells.groupBy("name", "course").agg(F.map_from_entries(F.collect_list(F.struct("event", "t"))).alias("times"))
    return wide.select("name", "course", F.size("times").alias("n_events"), reshape.times_text(F.col("times")).alias("events"))


@query("unpivot_features__i13", f"""with {O.BEST_CTES}
  select name, {O.feature()} as feature, time_seconds, event, course, age from best""")
def unpivot_features(spark, sf_dir):
    return reshape.lengthen_rows(reshape.wide_rows(V.best_marks(spark, sf_dir)))


@query("missing_profile__b6", f"""with {O.BEST_CTES},
  seen as (select {O.feature()} as feature, count(time_seconds) as n from best group by all),
  fixed as (select unnest({O.sql_list(WIDE_FEATURES)}) as feature),
  counted as (
    select coalesce(s.feature, f.feature) as feature, coalesce(n, 0) as n_observed from seen s full join fixed f on s.feature = f.feature
    union all select 'height_cm', count(height_cm) from athletes union all select 'weight_kg', count(weight_kg) from athletes)
  select feature, n_observed, (select count(*) from athletes) - n_observed as n_missing from counted""")
def missing_profile(spark, sf_dir):
    """Values and gaps of every column of the wide table, from the long form."""
    people = V.athletes(spark, sf_dir).select("Height_cm", "Weight_kg").toDF("height_cm", "weight_kg")
    body = reshape.observed_counts(people, ["height_cm", "weight_kg"])
    return reshape.missing_profile(V.best_marks(spark, sf_dir), people.count()).unionByName(body)


@query("rf_train__b11", f"""with {O.BEST_CTES}, {WIDE_SQL},
  listed as (select {O.feature()} as feature from best union select unnest({O.sql_list(WIDE_FEATURES)}))
  select a.name as "Name", cast((select count(*) from listed) + 4 as integer) as n_features,
    cast(coalesce(n_times, 0) + (height_cm is not null)::int + (weight_kg is not null)::int + ({BMI} is not null)::int
      + (({SEX}) is not null)::int as integer) as n_present
  from athletes a left join wide on wide.name = a.name""")
def feature_columns(spark, sf_dir):
    """All columns but id, label sources and group flags are features."""
    best = V.stored_best_marks(spark, sf_dir)
    people = encoded_athletes(spark, sf_dir)
    left_out = {"Name", "Date_of_Birth", "Sex", "Ethnicity", "paris_2024_races", *[flag_name(g) for g in GROUP_LABELS]}
    body = [c for c in people.columns if c not in left_out]
    wide = reshape.attach_wide(people, reshape.wide_rows(best), "Name", "name")
    present = sum((F.col(c).isNotNull().cast("int") for c in body), F.coalesce(F.size("times"), F.lit(0)))
    return wide.select("Name", F.lit(len(reshape.all_features(best)) + len(body)).alias("n_features"),
                       present.alias("n_present"))


# --- indicators ---------------------------------------------------------------------


@query("event_indicators__b10", f"""with {O.RACE_CTES}, {INDICATOR_SQL}
  select a.name, {INDICATOR_CELLS} from athletes a left join pairs p on p.name = a.name group by a.name""")
def event_indicators(spark, sf_dir):
    people = V.athletes(spark, sf_dir).select(F.col("Name").alias("name"))
    return labels.widen_indicators(people, labels.entered(V.race_raw(spark, sf_dir)))


@query("event_indicators__c2", f"""with {O.RACE_CTES}, {INDICATOR_SQL}
  select name, programme_event, count(*) as n from entries group by all""")
def programme_entries(spark, sf_dir):
    """Long-course races in programme events."""
    found = labels.programme_entries(V.race_raw(spark, sf_dir))
    return found.groupBy("name", "programme_event").agg(F.count(F.lit(1)).alias("n"))


@query("event_indicators__d4", f"with {O.RACE_CTES}, {INDICATOR_SQL} select name, indicator from pairs")
def indicator_pairs(spark, sf_dir):
    """The match of race names against the programme, as an equi-join on the canonical event."""
    return labels.entered(V.race_raw(spark, sf_dir))


@query("event_indicators__e9", f"""with {O.RACE_CTES}, {INDICATOR_SQL}
  select cast(count(*) > 0 as integer) as any_set from pairs""")
def any_indicator(spark, sf_dir):
    return labels.entered(V.race_raw(spark, sf_dir)).agg(labels.any_indicator().cast("int").alias("any_set"))


@query("events_per_name__e3", f"""with {O.RACE_CTES}, {INDICATOR_SQL},
  counted as (select name, programme_event, count(*) as n from entries group by all)
  select name, string_agg(programme_event || ' x' || n, '; ' order by programme_event) as entries,
    cast(sum(n) as bigint) as n_entries from counted group by name""")
def events_per_name(spark, sf_dir):
    listed = labels.events_entered(V.race_raw(spark, sf_dir))
    text = F.transform("entries", lambda e: F.concat(e["programme_event"], F.lit(" x"), e["n"].cast("string")))
    return listed.select("name", F.array_join(text, "; ").alias("entries"), "n_entries")


@query("first_indicator_label__f3", f"""with {O.RACE_CTES}, {INDICATOR_SQL}
  select a.name, min(indicator) as indicator from athletes a left join pairs p on p.name = a.name group by a.name""")
def first_indicator(spark, sf_dir):
    people = V.athletes(spark, sf_dir).select(F.col("Name").alias("name"))
    return labels.from_indicators(people, labels.entered(V.race_raw(spark, sf_dir))).select("name", "indicator")


@query("first_indicator_label__i15", f"""with {O.RACE_CTES}, {INDICATOR_SQL}
  select distinct indicator, replace(replace(indicator, 'Olympic_', ''), '__', '_') as label from pairs""")
def indicator_labels(spark, sf_dir):
    from laptrace.functions.events import indicator_label

    found = labels.entered(V.race_raw(spark, sf_dir)).select("indicator").distinct()
    return found.withColumn("label", indicator_label(F.col("indicator")))


@query("first_indicator_label__k2", f"""with {O.RACE_CTES}, {INDICATOR_SQL}
  select a.name, coalesce(replace(replace(min(indicator), 'Olympic_', ''), '__', '_'), 'No_Olympic_Event') as label
  from athletes a left join pairs p on p.name = a.name group by a.name""")
def label_from_indicators(spark, sf_dir):
    people = V.athletes(spark, sf_dir).select(F.col("Name").alias("name"))
    return labels.from_indicators(people, labels.entered(V.race_raw(spark, sf_dir))).select("name", "label")


# --- names ----------------------------------------------------------------------------


@query("clean_names__c6", f"with {O.NAMES_RAW} select key, {O.valid_person(O.tidy('raw_name'))} as is_person from names_raw")
def valid_names(spark, sf_dir):
    tidy = names.collapse_spaces(F.col("raw_name"))
    return V.names_raw(spark, sf_dir).select("key", names.is_person_name(tidy).alias("is_person"))


@query("clean_names__i7", f"with {O.NAMES_RAW} select key, {O.tidy('raw_name')} as tidy from names_raw")
def tidy_names(spark, sf_dir):
    return V.names_raw(spark, sf_dir).select("key", names.collapse_spaces(F.col("raw_name")).alias("tidy"))


@query("clean_names__i8", f"with {O.NAMES_RAW} select key, {O.bare(O.tidy('raw_name'))} as bare from names_raw")
def names_without_country(spark, sf_dir):
    bare = names.without_country(names.collapse_spaces(F.col("raw_name")))
    return V.names_raw(spark, sf_dir).select("key", bare.alias("bare"))


CLEAN = f"""clean as (select key, case when {O.valid_person('tidy')} and {O.valid_person(O.bare('tidy'))}
  then {O.two_words(O.bare('tidy'))} end as name from (select key, {O.tidy('raw_name')} as tidy from names_raw))"""


@query("clean_names__i9", f"with {O.NAMES_RAW}, {CLEAN} select key, name from clean")
def clean_names(spark, sf_dir):
    """First and last name, null where the text is no single person."""
    return V.names_raw(spark, sf_dir).select("key", names.person_name(F.col("raw_name")).alias("name"))


@query("name_list__e6", f"with {O.NAMES_RAW}, {CLEAN} select distinct name from clean where name is not null")
def distinct_names(spark, sf_dir):
    found = V.names_raw(spark, sf_dir).select(names.person_name(F.col("raw_name")).alias("name"))
    return found.where("name is not null").distinct()


@query("name_list__g1", f"with {O.NAMES_RAW}, {CLEAN} select name, count(*) as n from clean where name is not null group by name order by name")
def sorted_names(spark, sf_dir):
    """Sorted by range over the tasks, after equal names are combined."""
    found = V.names_raw(spark, sf_dir).select(names.person_name(F.col("raw_name")).alias("name"))
    return found.where("name is not null").groupBy("name").agg(F.count(F.lit(1)).alias("n")).orderBy("name")


# --- skip lists, batches ------------------------------------------------------------------


@query("pending_names__d3", """select distinct c_name as name from customer
  where lower(c_name) not in (select lower(c_name) from customer join orders on o_custkey = c_custkey where o_orderstatus = 'F' and o_orderpriority = '1-URGENT')""")
def pending_names(spark, sf_dir):
    """Customers not yet seen; the seen names come in another case."""
    customers = V.table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("name"))
    urgent = V.table(spark, sf_dir, "orders").where("o_orderstatus = 'F' and o_orderpriority = '1-URGENT'")
    keys = urgent.select(F.col("o_custkey").alias("c_custkey")).distinct()
    done = customers.join(keys, "c_custkey", "left_semi").select(F.upper("name").alias("done"))
    return joins.pending(customers, done, "name", "done", ignore_case=True)


@query("pending_rows__d3", """select l_orderkey, l_linenumber, l_quantity from lineitem
  where l_orderkey not in (select o_orderkey from orders where o_orderstatus = 'P' and o_orderkey is not null)""")
def pending_rows(spark, sf_dir):
    """Whole rows of orders that are not done, by way of the Bloom filter, as if the done keys were too many to broadcast."""
    rows = V.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    done = V.table(spark, sf_dir, "orders").where("o_orderstatus = 'P'")
    return joins.without_done(rows, done, "l_orderkey", "o_orderkey", max_rows=0)


@query("pending_names__h2", """select o_custkey as c_custkey from orders where o_orderstatus = 'F'
  except select o_custkey from orders where o_orderstatus = 'P'""")
def set_difference(spark, sf_dir):
    """Keys of one set that the other lacks, exact match."""
    orders = V.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderstatus")
    return joins.pending(orders.where("o_orderstatus = 'F'"), orders.where("o_orderstatus = 'P'"), "c_custkey")


@query("append_batches__h1", f"""with {O.RACE_CTES}
  select name, event, time_seconds, case when course = 'LCM' then meet_name end as meet_name,
    case when course <> 'LCM' then course end as course from races""")
def append_batches(spark, sf_dir):
    """Two batches with different columns."""
    races = V.races(spark, sf_dir)
    first = races.where("course = 'LCM'").select("name", "event", "time_seconds", "meet_name")
    second = races.where("course <> 'LCM'").select("name", "course", "event", "time_seconds")
    return joins.append([first, second])


# --- JSON answers -----------------------------------------------------------------------------

ANSWERS = """
body as (
  select c_custkey as k, c_name as name, case when c_custkey % 3 <> 0 then '1997-03-17' end as dob,
    case when c_custkey % 4 <> 0 then 150 + c_custkey % 50 end as height_cm,
    case when c_custkey % 5 = 0 then '' else 'female' end as gender,
    case when c_custkey % 6 = 0 then 0 else 1 end as n_entered, c_custkey % 9 <> 3 as whole from customer
)"""
ANSWER_SCHEMA = "name string, dob string, height_cm double, gender string, paris_2024_races array<string>"


def parsed_answers(spark, sf_dir):
    parsed = V.entered_text(spark, sf_dir).withColumn("p", jsontext.json_object(F.col("answer"), ANSWER_SCHEMA))
    return parsed.select("key", "p.*")


@query("json_parse__i11", f"""with {ANSWERS}
  select k as key, case when whole then name end as name, case when whole then dob end as dob,
    cast(case when whole then height_cm end as double) as height_cm, case when whole then gender end as gender,
    cast(case when whole then n_entered end as integer) as n_entered from body""")
def json_answers(spark, sf_dir):
    """Fenced and bare answers parse; those cut off give nulls."""
    parsed = parsed_answers(spark, sf_dir)
    return parsed.select(
        "key", "name", "dob", "height_cm", "gender",
        F.when(F.col("paris_2024_races").isNotNull(), F.size("paris_2024_races")).alias("n_entered"))


@query("json_parse__i11_events", "select event_id, cast(json_extract(props, '$.k') as bigint) as k from events")
def json_events(spark, sf_dir):
    events = V.table(spark, sf_dir, "events")
    return events.select("event_id", jsontext.json_object(F.col("props"), "k bigint")["k"].alias("k"))


def gap(field: str, test: str) -> str:
    return f"case when not whole or {test} then '{field}' end"


@query("missing_fields__i12", f"""with {ANSWERS}
  select k as key, array_to_string(list_filter([{", ".join([
      gap("name", "name is null"), gap("dob", "dob is null"), gap("height_cm", "height_cm is null"), "'weight_kg'",
      gap("gender", "gender = ''"), "'race'", gap("paris_2024_races", "n_entered = 0")])}],
    lambda f: f is not null), ',') as missing from body""")
def missing_fields(spark, sf_dir):
    """Which required fields an answer lacks; weight and group label are never given."""
    parsed = parsed_answers(spark, sf_dir)
    return parsed.select("key", F.array_join(A.audit(parsed, REQUIRED_ATHLETE_FIELDS), ",").alias("missing"))
