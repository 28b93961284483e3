"""Scans and sinks."""

from pyspark.sql import functions as F

from tabloom.operators.split import top_n
from tabloom.plans.registry import query, table
from tabloom.sources import demo_features, load, load_csv, load_table
from tabloom.sources import table_shape as shape_of
from tabloom.sources.inference import inferred, load_csv_inferred
from tabloom.workspace import new_path

ORDERS_SCHEMA = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string"
)


def _order_summary(orders):
    return orders.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.count_distinct("o_orderpriority").alias("n_priorities"),
        F.min("o_custkey").cast("bigint").alias("min_cust"),
        F.max("o_orderkey").cast("bigint").alias("max_key"),
        F.round(F.sum("o_totalprice"), 2).alias("total"),
        F.max("o_orderdate").cast("date").alias("last_date"),
    )


ORDER_SUMMARY = """
select o_orderstatus, count(*) as n_orders, count(distinct o_orderpriority) as n_priorities,
       min(o_custkey) as min_cust, max(o_orderkey) as max_key,
       round(sum(o_totalprice), 2) as total, max(o_orderdate)::date as last_date
from orders group by o_orderstatus
"""


@query("select count(*) as n_rows, 5::int as n_columns from customer")
def table_shape(spark, sf):
    return shape_of(table(spark, sf, "customer"))


@query(ORDER_SUMMARY)
def src_csv_roundtrip(spark, sf):
    path = new_path(spark, "orders-csv")
    table(spark, sf, "orders").write.option("header", True).csv(path)
    return _order_summary(load_csv(spark, path, schema=ORDERS_SCHEMA))


@query(ORDER_SUMMARY)
def src_csv_inferred(spark, sf):
    path = new_path(spark, "orders-csv")
    table(spark, sf, "orders").write.option("header", True).csv(path)
    return _order_summary(load_csv(spark, path))


@query("""
with o as (select o_orderkey, o_totalprice, o_orderstatus, o_orderdate,
                  case when o_orderkey % 7 = 0 then '' || o_custkey else 'x' end as mixed from orders)
select 'o_orderkey' as "column", 'int' as type, count(*) as cells, 0::bigint as no_int,
       0::bigint as no_double, count(*) as no_timestamp from o
union all
select 'o_totalprice', 'double', count(*), count(*), 0, count(*) from o
union all
select 'o_orderstatus', 'string', count(*), count(*), count(*), count(*) from o
union all
select 'o_orderdate', 'timestamp', count(*), count(*), count(*), 0 from o
union all
select 'mixed', 'string', count(*), count(*) filter (mixed = 'x'), count(*) filter (mixed = 'x'),
       count(*) from o
""")
def src_csv_types_counted(spark, sf):
    """Types of CSV columns from one aggregation, with the cells that are no value of a type."""
    path = new_path(spark, "orders-csv")
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        "o_totalprice",
        "o_orderstatus",
        "o_orderdate",
        F.when(F.col("o_orderkey") % 7 == 0, F.col("o_custkey").cast("string")).otherwise("x").alias("mixed"),
    )
    orders.write.option("header", True).csv(path)
    found = inferred(load_csv(spark, path, infer=False))
    return found.select(
        "column",
        "type",
        "cells",
        *[F.col("misfits")[k].alias(f"no_{k}") for k in ("int", "double", "timestamp")],
    )


@query(ORDER_SUMMARY)
def src_csv_typed(spark, sf):
    path = new_path(spark, "orders-csv")
    table(spark, sf, "orders").write.option("header", True).csv(path)
    return _order_summary(load_csv_inferred(spark, path)[0])


@query(ORDER_SUMMARY)
def src_json_roundtrip(spark, sf):
    path = new_path(spark, "orders-json")
    table(spark, sf, "orders").write.json(path)
    return _order_summary(load(spark, "json", path, ORDERS_SCHEMA))


@query(ORDER_SUMMARY)
def src_orc_roundtrip(spark, sf):
    path = new_path(spark, "orders-orc")
    table(spark, sf, "orders").write.orc(path)
    return _order_summary(load(spark, "orc", path))


@query(ORDER_SUMMARY)
def src_parquet(spark, sf):
    return _order_summary(load(spark, "parquet", f"{sf}/orders.parquet"))


@query("""
select c_mktsegment, count(*) as n, round(sum(c_acctbal), 2) as balance
from customer group by c_mktsegment
""")
def src_catalog_table(spark, sf):
    table(spark, sf, "customer").createOrReplaceTempView("tabloom_customer")
    return (
        load_table(spark, "tabloom_customer")
        .groupBy("c_mktsegment")
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance"))
    )


# The drawn numbers cannot be repeated elsewhere; what follows from the ids and holds for
# every draw can: the categories, and that the label agrees with the two features.
@query("""
select (o_orderkey % 3)::varchar as category, count(*) as n, 0::bigint as wrong_labels,
       0::bigint as out_of_range
from orders group by 1
""")
def src_synthetic(spark, sf):
    drawn = demo_features(table(spark, sf, "orders"), "o_orderkey")
    above = (F.col("feature1") + F.col("feature2") > 80).cast("int")
    return drawn.groupBy("category").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("label") != above).alias("wrong_labels"),
        F.count_if(~F.col("feature3").between(0, 100)).alias("out_of_range"),
    )


@query("select o_orderkey, o_totalprice from orders order by o_orderkey limit 100")
def limit_ordered(spark, sf):
    return top_n(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 100)
