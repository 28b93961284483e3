"""Class balancing, splits and folds."""

from pyspark.sql import functions as F

from tabloom.operators import balance, split
from tabloom.plans.registry import query, table

BUCKET = "(concat('0x', substr(md5(o_orderkey::varchar), 1, 8))::bigint)"


def _labels(spark, sf):
    return table(spark, sf, "labels").select("doc_id", "quality")


def _events(spark, sf):
    return table(spark, sf, "events").select("event_id", "event_type", "value")


@query("""
with c as (select quality as label, count(*) as n from labels group by 1),
mi as (select label, n as k, (select max(n) from c) as t from c order by n, label desc limit 1),
small as (select l.doc_id, l.quality, k, t,
                 row_number() over (order by md5(l.doc_id::varchar), l.doc_id) as r
          from labels l, mi where l.quality = mi.label)
select doc_id, quality from labels where quality <> (select label from mi)
union all
select doc_id, quality
from (select doc_id, quality, unnest(range(t // k + (r <= t % k)::int)) as copy from small)
""")
def balance_oversample_exact(spark, sf):
    return balance.oversample_minority(
        _labels(spark, sf), "quality", mode="exact", key="doc_id"
    )


@query("""
with c as (select event_type as label, count(*) as n from events group by 1),
mi as (select label, n as k, floor((select max(n) from c) * 2.5)::bigint as t from c
       order by n, label desc limit 1),
small as (select e.event_id, e.event_type, e.value, k, t,
                 row_number() over (order by md5(e.event_id::varchar), e.event_id) as r
          from events e, mi where e.event_type = mi.label)
select event_id, event_type, value from events where event_type <> (select label from mi)
union all
select event_id, event_type, value
from (select *, unnest(range(t // k + (r <= t % k)::int)) as copy from small)
""")
def balance_oversample_many_classes(spark, sf):
    return balance.oversample_minority(
        _events(spark, sf), "event_type", ratio=2.5, mode="exact", key="event_id"
    )


@query("""
with c as (select quality as label, count(*) as n from labels group by 1),
ma as (select label, (select min(n) from c) as t from c order by n desc, label limit 1)
select doc_id, quality
from (select doc_id, quality,
             row_number() over (order by md5(doc_id::varchar), doc_id) as r
      from labels where quality = (select label from ma)), ma
where r <= t
union all
select doc_id, quality from labels where quality <> (select label from ma)
""")
def balance_undersample_exact(spark, sf):
    return balance.undersample_majority(
        _labels(spark, sf), "quality", mode="exact", key="doc_id"
    )


@query("""
with c as (select event_type as label, count(*) as n from events group by 1),
ma as (select label, floor((select min(n) from c) / 2.0)::bigint as t from c
       order by n desc, label limit 1)
select event_id, event_type, value
from (select event_id, event_type, value,
             row_number() over (order by md5(event_id::varchar), event_id) as r
      from events where event_type = (select label from ma)), ma
where r <= t
union all
select event_id, event_type, value from events where event_type <> (select label from ma)
""")
def balance_undersample_many_classes(spark, sf):
    return balance.undersample_majority(
        _events(spark, sf), "event_type", ratio=2.0, mode="exact", key="event_id"
    )


@query()
def balance_oversample_sample(spark, sf):
    return balance.oversample_minority(_labels(spark, sf), "quality")


@query()
def balance_undersample_sample(spark, sf):
    return balance.undersample_majority(_labels(spark, sf), "quality")


@query()
def sample_by_class(spark, sf):
    fractions = {"click": 0.5, "error": 1.0, "view": 0.1}
    return split.sample_classes(_events(spark, sf), "event_type", fractions)


@query("""
with f as (select unnest(['click', 'error', 'view']) as event_type,
                  unnest([0.5, 1.0, 0.1]) as fraction),
r as (select event_id, event_type, value,
             row_number() over (partition by event_type order by md5(event_id::varchar)) as place,
             count(*) over (partition by event_type) as n
      from events)
select event_id, event_type, value from r join f using (event_type)
where place <= floor(fraction * n + 0.5)
""")
def sample_by_class_exact(spark, sf):
    fractions = {"click": 0.5, "error": 1.0, "view": 0.1}
    return split.sample_classes_exact(_events(spark, sf), "event_type", fractions, "event_id", repeated=True)


@query("""
with f as (select ps as l_partkey, 0.25 as fraction from (select distinct l_partkey as ps from lineitem)
           where ps % 3 = 0),
r as (select l_orderkey, l_linenumber, l_partkey,
             row_number() over (partition by l_partkey
               order by md5(l_orderkey::varchar || chr(1) || l_linenumber::varchar)) as place,
             count(*) over (partition by l_partkey) as n
      from lineitem)
select l_orderkey, l_linenumber, l_partkey from r join f using (l_partkey)
where place <= floor(fraction * n + 0.5)
""")
def sample_many_classes_exact(spark, sf):
    """A quarter of the items of every third part."""
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    parts = items.filter("l_partkey % 3 = 0").select(F.col("l_partkey").alias("label")).distinct()
    shares = parts.withColumn("fraction", F.lit(0.25))
    # Some items have the order and line number of another one of their part.
    key = ["l_orderkey", "l_linenumber"]
    return split.sample_classes_exact(items, "l_partkey", shares, key, repeated=True)


def _orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice")


@query(f"select o_orderkey, o_totalprice from orders where {BUCKET} < 3435973837")
def split_hash_train(spark, sf):
    return split.hash_split(_orders(spark, sf), "o_orderkey", [0.8, 0.2])[0]


@query(f"select o_orderkey, o_totalprice from orders where {BUCKET} >= 3435973837")
def split_hash_test(spark, sf):
    return split.hash_split(_orders(spark, sf), "o_orderkey", [0.8, 0.2])[1]


# Which rows go where is Spark's draw; that every row is in one part only is not.
@query("select count(*) as n_rows, 0::bigint as in_both, 0::bigint as in_none from orders")
def split_random(spark, sf):
    orders = _orders(spark, sf)
    train, test = split.random_split(orders, [0.8, 0.2], 42)
    parts = train.select("o_orderkey", F.lit(1).alias("part")).unionByName(
        test.select("o_orderkey", F.lit(2).alias("part"))
    )
    placed = orders.select("o_orderkey", F.lit(0).alias("part")).unionByName(parts)
    per_row = placed.groupBy("o_orderkey").agg(F.count_if(F.col("part") > 0).alias("parts"))
    return per_row.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("parts") > 1).alias("in_both"),
        F.count_if(F.col("parts") == 0).alias("in_none"),
    )


@query(f"select ({BUCKET} % 3)::int as fold, count(*) as n from orders group by 1")
def cv_fold_sizes(spark, sf):
    return (
        table(spark, sf, "orders")
        .groupBy(split.hash_fold("o_orderkey", 3).alias("fold"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
