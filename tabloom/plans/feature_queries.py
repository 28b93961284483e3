"""Feature engineering and outliers. Rows are compared one by one, over whole tables."""

from pyspark.sql import functions as F

from tabloom.operators import features, outliers
from tabloom.plans.registry import query, table


def _items(spark, sf, *columns):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *columns)


def _interaction(spark, sf, left, right, operation):
    return features.interaction(_items(spark, sf, left, right), left, right, operation)


@query("""
select l_orderkey, l_linenumber, l_extendedprice, l_discount,
       l_extendedprice * l_discount as l_extendedprice_multiply_l_discount
from lineitem
""")
def feat_interact_multiply(spark, sf):
    return _interaction(spark, sf, "l_extendedprice", "l_discount", "multiply")


@query("""
select l_orderkey, l_linenumber, l_discount, l_tax, l_discount + l_tax as l_discount_add_l_tax
from lineitem
""")
def feat_interact_add(spark, sf):
    return _interaction(spark, sf, "l_discount", "l_tax", "add")


@query("""
select l_orderkey, l_linenumber, l_discount, l_tax,
       l_discount - l_tax as l_discount_subtract_l_tax
from lineitem
""")
def feat_interact_subtract(spark, sf):
    return _interaction(spark, sf, "l_discount", "l_tax", "subtract")


@query("""
select l_orderkey, l_linenumber, l_extendedprice, l_discount,
       case when l_discount <> 0 then l_extendedprice / l_discount else 0 end
       as l_extendedprice_divide_l_discount
from lineitem
""")
def feat_interact_divide(spark, sf):
    return _interaction(spark, sf, "l_extendedprice", "l_discount", "divide")


@query("""
with t as (select l_orderkey, l_linenumber,
                  case when l_linenumber <> 3 then l_extendedprice end as price,
                  nullif(l_tax, 0.02::double) as tax from lineitem)
select *, case when tax <> 0 then price / tax else 0 end as price_divide_tax from t
""")
def feat_interact_divide_gaps(spark, sf):
    items = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_linenumber") != 3, F.col("l_extendedprice")).alias("price"),
        F.nullif("l_tax", F.lit(0.02)).alias("tax"),
    )
    return features.interaction(items, "price", "tax", "divide")


@query("""
select l_orderkey, l_linenumber, l_quantity, l_quantity ** 2 as l_quantity_pow_2,
       l_quantity ** 3 as l_quantity_pow_3
from lineitem
""")
def feat_polynomial(spark, sf):
    return features.polynomial(_items(spark, sf, "l_quantity"), "l_quantity", 3)


@query("""
with q as (select quantile_disc(l_extendedprice, [0.2, 0.4, 0.6, 0.8]) as s from lineitem)
select l_orderkey, l_linenumber, l_extendedprice as price,
       ((l_extendedprice >= s[1])::int + (l_extendedprice >= s[2])::int
        + (l_extendedprice >= s[3])::int + (l_extendedprice >= s[4])::int)::double as price_binned
from lineitem, q
""")
def feat_bin_quantile(spark, sf):
    items = _items(spark, sf, F.col("l_extendedprice").alias("price"))
    return features.binned(items, "price", 5, "quantile", relative_error=0.0)


@query()
def feat_bin_quantile_approx(spark, sf):
    items = _items(spark, sf, "l_extendedprice")
    return features.binned(items, "l_extendedprice", 5, "quantile")


@query("""
with m as (select min(o_totalprice) as mn, (max(o_totalprice) - min(o_totalprice)) / 5 as w
           from orders)
select o_orderkey, o_totalprice,
       least(greatest(floor((o_totalprice - mn) / w), 0), 4)::double as o_totalprice_binned
from orders, m
""")
def feat_bin_equal_width(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return features.binned(orders, "o_totalprice", 5, "equal_width")


def _group_sql(source, key, group, value, functions, condition):
    sql = {
        "mean": "round(avg({v}), 4)",
        "sum": "round(sum({v}), 2)",
        "count": "count({v})",
        "max": "max({v})",
        "min": "min({v})",
    }
    learned = ", ".join(f"{sql[f].format(v=value)} as {group}_{value}_{f}" for f in functions)
    names = ", ".join(f"{group}_{value}_{f}" for f in functions)
    return f"""
with t as ({source}), g as (select {group} as gk, {learned} from t group by 1)
select {group}, {key}, {value}, {names} from t left join g on {condition}
"""


def _rounded(df, group, value):
    digits = {"mean": 4, "sum": 2}
    return df.withColumns(
        {
            f"{group}_{value}_{f}": F.round(f"{group}_{value}_{f}", d)
            for f, d in digits.items()
            if f"{group}_{value}_{f}" in df.columns
        }
    )


ITEMS = "select l_orderkey, l_linenumber, l_returnflag, l_extendedprice from lineitem"
GAPPY_ORDERS = """
select o_orderkey, nullif(o_orderpriority, '5-LOW') as priority, o_totalprice from orders"""


@query(
    _group_sql(
        ITEMS,
        "l_orderkey, l_linenumber",
        "l_returnflag",
        "l_extendedprice",
        ["mean", "sum", "count"],
        "l_returnflag = gk",
    )
)
def feat_group_agg(spark, sf):
    items = _items(spark, sf, "l_returnflag", "l_extendedprice")
    added = features.group_agg(items, "l_returnflag", "l_extendedprice")
    return _rounded(added, "l_returnflag", "l_extendedprice")


@query(
    _group_sql(
        ITEMS,
        "l_orderkey, l_linenumber",
        "l_returnflag",
        "l_extendedprice",
        ["max", "min", "count"],
        "l_returnflag = gk",
    )
)
def feat_group_agg_minmax(spark, sf):
    items = _items(spark, sf, "l_returnflag", "l_extendedprice")
    return features.group_agg(items, "l_returnflag", "l_extendedprice", ["max", "min", "count"])


@query(
    _group_sql(
        "select l_orderkey, l_linenumber, l_partkey, l_quantity from lineitem",
        "l_orderkey, l_linenumber",
        "l_partkey",
        "l_quantity",
        ["mean", "sum", "count", "max", "min"],
        "l_partkey = gk",
    )
)
def feat_group_agg_many_groups(spark, sf):
    items = _items(spark, sf, "l_partkey", "l_quantity")
    functions = ["mean", "sum", "count", "max", "min"]
    added = features.group_agg(items, "l_partkey", "l_quantity", functions)
    return _rounded(added, "l_partkey", "l_quantity")


def _orders_with_gaps(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
        "o_totalprice",
    )


@query(
    _group_sql(
        GAPPY_ORDERS,
        "o_orderkey",
        "priority",
        "o_totalprice",
        ["mean", "sum", "count"],
        "priority = gk",
    )
)
def feat_group_agg_nullkey(spark, sf):
    added = features.group_agg(_orders_with_gaps(spark, sf), "priority", "o_totalprice")
    return _rounded(added, "priority", "o_totalprice")


@query(
    _group_sql(
        GAPPY_ORDERS,
        "o_orderkey",
        "priority",
        "o_totalprice",
        ["mean", "sum", "count"],
        "priority is not distinct from gk",
    )
)
def feat_group_agg_nullsafe(spark, sf):
    added = features.group_agg(
        _orders_with_gaps(spark, sf), "priority", "o_totalprice", null_safe=True
    )
    return _rounded(added, "priority", "o_totalprice")


BOUNDS = """
b as (select quantile_disc(value, 0.25)::double as q1, quantile_disc(value, 0.75)::double as q3
      from events),
f as (select q1 - 1.5 * (q3 - q1) as lo, q3 + 1.5 * (q3 - q1) as hi from b)
"""


@query("""
with c as (
  select 'l_quantity' as "column", quantile_disc(l_quantity, 0.25)::double as q1,
         quantile_disc(l_quantity, 0.75)::double as q3 from lineitem
  union all
  select 'l_extendedprice', quantile_disc(l_extendedprice, 0.25)::double,
         quantile_disc(l_extendedprice, 0.75)::double from lineitem
  union all
  select 'l_orderkey', quantile_disc(l_orderkey, 0.25)::double,
         quantile_disc(l_orderkey, 0.75)::double from lineitem)
select "column", q1 - 1.5 * (q3 - q1) as lower, q3 + 1.5 * (q3 - q1) as upper from c
""")
def outlier_bounds(spark, sf):
    found = outliers.iqr_bounds(
        table(spark, sf, "lineitem"),
        ["l_quantity", "l_extendedprice", "l_orderkey"],
        relative_error=0.0,
    )
    return spark.createDataFrame(
        [(c, lo, hi) for c, (lo, hi) in found.items()],
        "column string, lower double, upper double",
    )


def _events(spark, sf):
    return table(spark, sf, "events").select("event_id", "value")


@query(f"""
with {BOUNDS}
select event_id, value, case when value < lo or value > hi then 1 else 0 end::int
       as value_is_outlier
from events, f
""")
def outlier_detect(spark, sf):
    return outliers.detect(_events(spark, sf), "value", relative_error=0.0)


@query(f"""
with {BOUNDS}
select event_id, value, case when value < lo then lo when value > hi then hi else value end
       as value_capped
from events, f
""")
def outlier_cap(spark, sf):
    return outliers.cap(_events(spark, sf), "value", relative_error=0.0)


@query(f"with {BOUNDS} select event_id, value from events, f where value between lo and hi")
def outlier_remove(spark, sf):
    return outliers.remove(_events(spark, sf), "value", relative_error=0.0)


@query("""
with b as (select quantile_disc(n_chars, 0.25)::double as q1,
                  quantile_disc(n_chars, 0.75)::double as q3 from documents)
select doc_id, n_chars,
       case when n_chars < q1 - 3 * (q3 - q1) or n_chars > q3 + 3 * (q3 - q1) then 1 else 0
       end::int as n_chars_is_outlier
from documents, b
""")
def outlier_detect_wide(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "n_chars")
    return outliers.detect(documents, "n_chars", multiplier=3.0, relative_error=0.0)


@query()
def outlier_detect_approx(spark, sf):
    return outliers.detect(_events(spark, sf), "value")
