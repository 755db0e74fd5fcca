"""Filter interaction audit: what each filter removes in every order, from counts of failure masks.

A document is reduced to one bit per filter it fails.  Counts per part and mask are all that the orders
need, so the recursive query that lists the orders works on at most 32 cells a part, whatever the corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laptrace.llm.tables import BLANKS, stored

LETTERS = "ABCDE"
BIT = {letter: 1 << k for k, letter in enumerate(LETTERS)}
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"
#: Prefixes of all orders of five letters, the empty one included.
PREFIXES = 1 + 5 + 20 + 60 + 120 + 120


def content_mask(text: Column) -> Column:
    """Bits of the filters that look at one text alone: A few words, B repetition, C capitals, D symbols."""
    words = F.array_remove(F.split(text, f"[{BLANKS}]+"), "")
    fails = {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 10 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }
    return sum((F.when(fail, BIT[k]).otherwise(0) for k, fail in fails.items()), F.lit(0))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, docs, good, toxic: documents by language and by the set of filters they fail.

    A null text is empty, a null language the part ''.  Filter E fails where a smaller doc_id anywhere has
    the same text (by SHA-256); rows that share an id are no copies of each other, rows with a null id copy
    nothing, are no original and have no labels.  Of several labels of an id the highest counts, a null label
    is none.  Repeated rows count each.  An empty table has no cells.  Only these columns are read.

    Texts are met once; what travels is an id and a digest.  The original of a text is joined by id and
    digest together, so a text with very many copies is no hot key.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    narrow = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                                F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part")).select(
        "doc_id", "part", content_mask(F.col("text")).alias("mask"),
        F.unhex(F.sha2("text", 256)).alias("digest")), "masks")
    known = narrow.filter("doc_id is not null")
    originals = known.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("original", F.lit(True))
    marks = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("toxic"))
    joined = (known.groupBy("doc_id", "digest", "part", "mask").agg(F.count("*").alias("n"))
              .join(originals, ["doc_id", "digest"], "left").join(marks, "doc_id", "left"))
    mask = F.col("mask") + F.when(F.col("original"), 0).otherwise(BIT["E"])
    none = F.lit(0)
    rows = joined.select("part", mask.alias("mask"), "n", F.coalesce("good", none).alias("good"),
                         F.coalesce("toxic", none).alias("toxic")).unionAll(
        narrow.filter("doc_id is null").select("part", "mask", F.lit(1), none, none))
    return rows.groupBy("part", "mask").agg(
        F.sum("n").alias("docs"), F.sum(F.col("n") * F.col("good")).alias("good"),
        F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def _total(of: str, where: str) -> str:
    """Sum over the cells ``c`` of the joined part."""
    return f"aggregate(filter(p.cells, c -> {where}), 0L, (a, c) -> a + c.{of})"


#: The empty prefix of every part; each level adds one unused letter to every prefix and counts, over the
#: mask cells of its part, what that filter does to what the applied ones left.
RECURSION = f"""
with recursive prefixes(part, filter_order, applied, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost) as (
    select part, '', 0, 0, 0L, 0L, 0L, 0L, 0L, 0L from {{parts}}
    union all
    select s.part, concat(s.filter_order, s.next.letter), s.applied | s.next.bit, s.step + 1,
           {_total("docs", "c.mask & (s.applied | s.next.bit) = 0")},
           {_total("docs", "c.mask & s.applied = 0 and c.mask & s.next.bit <> 0")},
           {_total("docs", "c.mask & s.applied <> 0 and c.mask & s.next.bit <> 0")},
           {_total("docs", "c.mask = s.next.bit")},
           {_total("good", "c.mask & s.applied = 0 and c.mask & s.next.bit <> 0")},
           {_total("toxic", "c.mask & s.applied = 0 and c.mask & s.next.bit <> 0")}
    from (select *, explode(filter(array({", ".join(f"named_struct('letter', '{k}', 'bit', {b})" for k, b in BIT.items())}),
                                   l -> applied & l.bit = 0)) as next from prefixes) s
    join {{parts}} p on p.part = s.part
)
select * from prefixes where step > 0
"""


def prefix_metrics(counted: DataFrame) -> DataFrame:
    """One row for every part and every prefix of an order, by one recursive query over the mask cells.

    The recursion ends with the fifth letter.  Spark's limit on its rows is raised, while it runs, to what
    the parts need.
    """
    spark = counted.sparkSession
    parts = stored(counted.groupBy("part").agg(
        F.collect_list(F.struct("mask", "docs", "good", "toxic")).alias("cells")), "parts")
    before = spark.conf.get(ROW_LIMIT)
    need = (parts.count() + 1) * PREFIXES
    if 0 <= int(before) < need:
        spark.conf.set(ROW_LIMIT, str(need))
    try:
        return stored(spark.sql(RECURSION, parts=parts), "prefixes")
    finally:
        spark.conf.set(ROW_LIMIT, before)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step; see :func:`cells` for what counts how.

    kept: left after this step; removed: fails this filter and is still there; redundant: fails it but went
    before; unique_fails: fails no other; good_lost, toxic_lost: of the removed; shapley: what the letter
    removes, over all 120 orders.  Orders with a common prefix share its row of the recursion.
    """
    steps = prefix_metrics(cells(docs, labels))
    orders = steps.filter(F.col("step") == len(LETTERS)).select("part", "filter_order")
    pieces = orders.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS))))).withColumn(
        "prefix", F.expr("substring(filter_order, 1, step)"))
    rows = pieces.join(steps.drop("step", "applied").withColumnRenamed("filter_order", "prefix"), ["part", "prefix"])
    rows = rows.withColumn("letter", F.expr("substring(filter_order, step, 1)"))
    shares = rows.groupBy("part", "letter").agg(F.sum("removed").alias("shapley"))
    return rows.join(shares, ["part", "letter"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost",
        "shapley")


def audit_sql() -> str:
    """The audit of ``documents`` and ``labels`` for DuckDB."""
    return r"""
with recursive texts as (
    select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), marks as (
    select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
    from labels group by doc_id
), failed as (
    select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
           (len(w) < 100)::int + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::int
           + 4 * (100 * len(regexp_extract_all(text, '[A-Z]')) > 10 * length(text))::int
           + 8 * regexp_matches(text, '[#$%&*|]')::int
           + 16 * coalesce(doc_id > min(doc_id) over (partition by text), false)::int as mask
    from texts left join marks using (doc_id)
), cells as (
    select part, mask, count(*) as docs, sum(good) as good, sum(toxic) as toxic from failed group by part, mask
), letters(letter, bit) as (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
prefixes(filter_order, applied, before, bit, step) as (
    select '', 0, 0, 0, 0
    union all
    select filter_order || letter, applied | l.bit, applied, l.bit, step + 1
    from prefixes p join letters l on p.applied & l.bit = 0
), steps as (
    select part, filter_order, step,
           sum(case when mask & applied = 0 then docs else 0 end) as kept,
           sum(case when mask & before = 0 and mask & bit <> 0 then docs else 0 end) as removed,
           sum(case when mask & before <> 0 and mask & bit <> 0 then docs else 0 end) as redundant,
           sum(case when mask = bit then docs else 0 end) as unique_fails,
           sum(case when mask & before = 0 and mask & bit <> 0 then good else 0 end) as good_lost,
           sum(case when mask & before = 0 and mask & bit <> 0 then toxic else 0 end) as toxic_lost
    from prefixes, cells where step > 0 group by part, filter_order, step
), pieces as (
    select o.part, o.filter_order, s.* exclude (part, filter_order), substr(o.filter_order, s.step, 1) as letter
    from steps o join steps s on o.part = s.part and o.step = 5 and starts_with(o.filter_order, s.filter_order)
)
select part, filter_order, step::int as step, kept::bigint as kept, removed::bigint as removed,
       redundant::bigint as redundant, unique_fails::bigint as unique_fails, good_lost::bigint as good_lost,
       toxic_lost::bigint as toxic_lost, (sum(removed) over (partition by part, letter))::bigint as shapley
from pieces
"""
