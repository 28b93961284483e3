"""Data-quality profiling. The tables have no missing values, so both sides inject some."""

from pyspark.sql import functions as F

from tabloom.operators import balance, profile, profile_states
from tabloom.plans.registry import query, table
from tabloom.workspace import stage


def _gappy_orders(spark, sf):
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
        F.when(key % 7 == 0, None).when(key % 11 == 0, float("nan")).otherwise(price).alias("price"),
        F.when(key % 5 != 0, F.col("o_custkey")).alias("customer"),
        F.when(key % 3 != 0, F.col("o_orderdate")).alias("order_date"),
    )


GAPPY = """
gappy as (
  select o_orderkey, o_orderstatus, nullif(o_orderpriority, '5-LOW') as priority,
         case when o_orderkey % 7 = 0 then null when o_orderkey % 11 = 0 then 'NaN'::double
              else o_totalprice end as price,
         case when o_orderkey % 5 <> 0 then o_custkey end as customer,
         case when o_orderkey % 3 <> 0 then o_orderdate end as order_date
  from orders)
"""


@query(f"""
with {GAPPY}
select count(*) filter (o_orderkey is null) as o_orderkey,
       count(*) filter (o_orderstatus is null) as o_orderstatus,
       count(*) filter (priority is null) as priority,
       count(*) filter (price is null or isnan(price)) as price,
       count(*) filter (customer is null) as customer,
       count(*) filter (order_date is null) as order_date
from gappy
""")
def profile_missing(spark, sf):
    return profile.missing(_gappy_orders(spark, sf))


@query(f"""
with {GAPPY}
select count(*) filter (o_orderkey is null) as o_orderkey,
       count(*) filter (o_orderstatus is null) as o_orderstatus,
       count(*) filter (priority is null) as priority,
       count(*) filter (price is null) as price,
       count(*) filter (customer is null) as customer,
       count(*) filter (order_date is null) as order_date
from gappy
""")
def profile_missing_null_only(spark, sf):
    return profile.missing(_gappy_orders(spark, sf), include_nan=False)


@query(f"""
with {GAPPY}, long as (
  select 'priority' as "column", count(*) filter (priority is null) as missing, count(*) as n
  from gappy
  union all
  select 'price', count(*) filter (price is null or isnan(price)), count(*) from gappy)
select "column", missing, round(missing * 100.0::double / n, 6) as pct from long
""")
def profile_missing_long(spark, sf):
    gaps = profile.missing_long(_gappy_orders(spark, sf).select("priority", "price"))
    return gaps.withColumn("pct", F.round("pct", 6))


def _number_sql(name, table_name):
    return f"""
select '{name}' as "column", count({name}) as count, round(avg({name}), 4) as mean,
       round(stddev_samp({name}), 4) as stddev, min({name})::double as min,
       max({name})::double as max, null::varchar as min_text, null::varchar as max_text
from {table_name}"""


def _text_sql(name, table_name):
    return f"""
select '{name}', count({name}), null::double, null::double, null::double, null::double,
       min({name}), max({name}) from {table_name}"""


@query(
    " union all ".join(
        [
            _number_sql(c, "lineitem")
            for c in ("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount")
        ]
        + [_text_sql(c, "lineitem") for c in ("l_returnflag", "l_linestatus")]
    )
)
def profile_statistics(spark, sf):
    items = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_returnflag",
        "l_linestatus",
        "l_shipdate",
    )
    return profile.statistics(items).withColumns(
        {"mean": F.round("mean", 4), "stddev": F.round("stddev", 4)}
    )


@query("""
select coalesce(sum(n - 1), 0)::bigint as duplicates
from (select count(*) as n from lineitem
      group by l_returnflag, l_linestatus, l_quantity, l_discount, l_tax)
""")
def profile_duplicates(spark, sf):
    return profile.duplicates(
        table(spark, sf, "lineitem"),
        ["l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_tax"],
    )


@query("""
select (count(*) - (select count(*) from (select distinct text from documents)))::bigint
       as duplicates
from documents
""")
def profile_duplicates_text(spark, sf):
    return profile.duplicates(table(spark, sf, "documents").select("text"))


@query("""
select (count(*) - (select count(*) from (select distinct * from events)))::bigint as duplicates
from events
""")
def profile_duplicates_rows(spark, sf):
    return profile.duplicates(table(spark, sf, "events"))


@query(f"""
with {GAPPY}
select 'o_orderstatus' as "column",
       count(distinct o_orderstatus) + max((o_orderstatus is null)::int) as distinct_values
from gappy
union all select 'priority', count(distinct priority) + max((priority is null)::int) from gappy
union all select 'customer', count(distinct customer) + max((customer is null)::int) from gappy
""")
def profile_cardinality(spark, sf):
    return profile.cardinality(
        _gappy_orders(spark, sf), ["o_orderstatus", "priority", "customer"]
    )


_REPORT_STATS = """
select 'statistics' as section, '{c}' as "column", unnest(['count','mean','stddev','min','max'])
       as metric,
       unnest([count({c})::double, round(avg({c}), 4), round(stddev_samp({c}), 4),
               min({c})::double, max({c})::double]) as value, null::varchar as text from gappy"""


@query(f"""
with {GAPPY.replace("'NaN'::double", "null")}
select 'table' as section, null::varchar as "column", 'total_rows' as metric,
       count(*)::double as value, null::varchar as text from gappy
union all select 'table', null, 'total_columns', 6.0::double, null
union all
select 'table', null, 'duplicates',
       (count(*) - (select count(*) from (select distinct * from gappy)))::double, null from gappy
union all
select 'missing_values', unnest(['o_orderkey', 'o_orderstatus', 'priority', 'price', 'customer',
                                 'order_date']), 'missing',
       unnest([count(*) filter (o_orderkey is null), count(*) filter (o_orderstatus is null),
               count(*) filter (priority is null), count(*) filter (price is null),
               count(*) filter (customer is null), count(*) filter (order_date is null)])::double,
       null from gappy
union all {_REPORT_STATS.format(c="o_orderkey")}
union all {_REPORT_STATS.format(c="price")}
union all {_REPORT_STATS.format(c="customer")}
union all select 'statistics', 'o_orderstatus', 'count', count(o_orderstatus), null from gappy
union all select 'statistics', 'o_orderstatus', 'min', null, min(o_orderstatus) from gappy
union all select 'statistics', 'o_orderstatus', 'max', null, max(o_orderstatus) from gappy
union all select 'statistics', 'priority', 'count', count(priority), null from gappy
union all select 'statistics', 'priority', 'min', null, min(priority) from gappy
union all select 'statistics', 'priority', 'max', null, max(priority) from gappy
union all
select 'cardinality', 'o_orderstatus', 'distinct_values',
       count(distinct o_orderstatus) + max((o_orderstatus is null)::int), null from gappy
union all
select 'cardinality', 'priority', 'distinct_values',
       count(distinct priority) + max((priority is null)::int), null from gappy
""")
def profile_report(spark, sf):
    orders = _gappy_orders(spark, sf)
    orders = orders.withColumn("price", F.nullif("price", F.lit(float("nan"))))
    report = profile.report(orders, ["o_orderstatus", "priority"])
    rounded = F.when(F.col("metric").isin("mean", "stddev"), F.round("value", 4))
    return report.withColumn("value", F.coalesce(rounded, F.col("value")))


@query("""
select event_type, count(*) as count,
       round(count(*) / (select count(*) from events)::double, 6) as share
from events group by event_type
""")
def class_distribution(spark, sf):
    shares = profile.class_distribution(table(spark, sf, "events"), "event_type")
    return shares.withColumn("share", F.round("share", 6))


@query("""
with c as (select event_type, count(*) as n from events group by 1)
select (select event_type from c order by n desc, event_type limit 1) as majority,
       max(n) as majority_count,
       (select event_type from c order by n, event_type desc limit 1) as minority,
       min(n) as minority_count, count(*) as classes
from c
""")
def class_majority_minority(spark, sf):
    return balance.class_extremes(table(spark, sf, "events"), "event_type")


def histogram_sql(source, columns, bins=50):
    """DuckDB form of the histogram of ``columns`` of ``source``."""
    parts = [
        f"""
select '{c}' as "column", least(floor((x - mn) / w), {bins - 1})::int as bin,
       round(mn + least(floor((x - mn) / w), {bins - 1}) * w, 4) as lower,
       round(mn + (least(floor((x - mn) / w), {bins - 1}) + 1) * w, 4) as upper,
       count(*) as count
from (select {c}::double as x from {source}),
     (select min({c})::double as mn, (max({c})::double - min({c})::double) / {bins} as w
      from {source})
group by all"""
        for c in columns
    ]
    return " union all ".join(parts)


def _rounded_ends(histogram):
    return histogram.withColumns({"lower": F.round("lower", 4), "upper": F.round("upper", 4)})


@query(histogram_sql("events", ["value"]))
def histogram_50(spark, sf):
    return _rounded_ends(profile.histogram(table(spark, sf, "events"), ["value"]))


@query(histogram_sql("lineitem", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))
def histogram_many_columns(spark, sf):
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return _rounded_ends(profile.histogram(table(spark, sf, "lineitem"), columns))


def _merged_sql(name, number):
    numbers = f"round(avg({name}), 4), round(stddev_samp({name}), 4), min({name})::double, max({name})::double, null::varchar, null::varchar"
    texts = f"null::double, null::double, null::double, null::double, min({name}), max({name})"
    return f"""
select '{name}', count(*), count(*) - count({name}), round((count(*) - count({name})) * 100.0::double / count(*), 6),
       count({name}), {numbers if number else texts} from items"""


MERGED = {"l_orderkey": 1, "l_quantity": 1, "l_discount": 1, "tax": 1, "l_returnflag": 0}


@query(f"""
with items as (select *, nullif(l_tax, 0.0::double) as tax from lineitem),
r("column", "rows", missing, pct, count, mean, stddev, min, max, min_text, max_text) as (
{" union all ".join(_merged_sql(c, n) for c, n in MERGED.items())})
select * from r
""")
def profile_merged(spark, sf):
    """States of three parts, stored apart and merged; the exact columns of the report."""
    items = table(spark, sf, "lineitem").withColumn("tax", F.nullif("l_tax", F.lit(0.0)))
    parts = [
        stage(profile_states.states(items.filter(F.col("l_orderkey") % 3 == i), list(MERGED)), "state")
        for i in range(3)
    ]
    two = stage(profile_states.merge(parts[0].union(parts[1])), "state")
    report = profile_states.report(profile_states.merge(two.union(parts[2]))).drop("distinct")
    return report.withColumns({c: F.round(c, 4) for c in ("mean", "stddev")}).withColumn(
        "pct", F.round("pct", 6)
    )


@query("""
select "column", true as close from (values ('l_orderkey'), ('l_quantity'), ('tax')) t("column")
""")
def profile_merged_sketches(spark, sf):
    """Distinct values and quantiles of merged sketches, held against the exact ones."""
    items = table(spark, sf, "lineitem").withColumn("tax", F.nullif("l_tax", F.lit(0.0)))
    names = ["l_orderkey", "l_quantity", "tax"]
    parts = [
        profile_states.states(items.filter(F.col("l_orderkey") % 3 == i), names) for i in range(3)
    ]
    merged = stage(profile_states.merge(parts[0].union(parts[1]).union(parts[2])), "state")
    exact = profile.cardinality(items, names)
    found = profile_states.report(merged).join(exact, "column")
    near = F.abs(F.col("distinct") / F.col("distinct_values") - 1) < 0.08
    # The rank of a value is its share of rows below and up to it; the wanted one is near or between.
    wanted = profile_states.quantiles(merged, [0.1, 0.5, 0.9])
    values = items.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in names
    ]))).filter("x is not null")
    ranks = values.groupBy("column", "x").agg(F.count(F.lit(1)).alias("n")).join(wanted, "column")
    ranks = ranks.groupBy("column", "probability").agg(
        (F.sum(F.when(F.col("x") < F.col("value"), F.col("n")).otherwise(0)) / F.sum("n")).alias("below"),
        (F.sum(F.when(F.col("x") <= F.col("value"), F.col("n")).otherwise(0)) / F.sum("n")).alias("upto"),
    )
    within = (F.col("below") - 0.04 <= F.col("probability")) & (F.col("probability") <= F.col("upto") + 0.04)
    ranked = ranks.groupBy("column").agg(F.bool_and(within).alias("ranked"))
    return found.join(ranked, "column").select("column", (near & F.col("ranked")).alias("close"))
