"""Imputation, indexing, encoding, assembling, scaling; vectors are compared slot by slot."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabloom.operators.preprocessing import PipelineBuilder, preprocessing_pipeline
from tabloom.plans.registry import query, table

KEY = ["l_orderkey", "l_linenumber"]

SOURCE = """
t as (select l_orderkey, l_linenumber, l_quantity, nullif(l_tax, 0.0::double) as tax,
             l_returnflag from lineitem)
"""


def _items(spark, sf):
    return table(spark, sf, "lineitem").select(
        *KEY, "l_quantity", F.nullif("l_tax", F.lit(0.0)).alias("tax"), "l_returnflag"
    )


def _slots(df, column, size, digits=6):
    values = vector_to_array(column)
    return df.select(*KEY, *[F.round(values[i], digits).alias(f"f{i}") for i in range(size)])


def _imputed(spark, sf, strategy, relative_error=0.001):
    items = _items(spark, sf).drop("l_quantity", "l_returnflag")
    pipeline = PipelineBuilder().add_imputer(["tax"], strategy, relative_error).build()
    filled = pipeline.fit(items).transform(items)
    return filled.withColumn("tax_imputed", F.round("tax_imputed", 6))


def _impute_sql(fill):
    return f"""
with {SOURCE}, m as ({fill})
select l_orderkey, l_linenumber, tax, round(coalesce(tax, fill), 6) as tax_imputed from t, m
"""


@query(_impute_sql("select avg(tax) as fill from t"))
def prep_impute_mean(spark, sf):
    return _imputed(spark, sf, "mean")


@query(_impute_sql("select quantile_disc(tax, 0.5) as fill from t"))
def prep_impute_median(spark, sf):
    return _imputed(spark, sf, "median", relative_error=0)


@query(
    _impute_sql(
        "select tax as fill from t where tax is not null group by 1 order by count(*) desc, 1 limit 1"
    )
)
def prep_impute_mode(spark, sf):
    return _imputed(spark, sf, "mode")


@query()
def prep_impute_median_approx(spark, sf):
    return _imputed(spark, sf, "median")


INDEXED = """
i as (select v, (row_number() over (order by count(*) desc, v) - 1)::double as idx
      from (select o_orderpriority as v from orders) group by v)
"""


@query(f"""
with {INDEXED}
select o_orderkey, o_orderpriority, idx as o_orderpriority_indexed
from orders join i on o_orderpriority = v
""")
def prep_string_index(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return PipelineBuilder().add_string_indexer(["o_orderpriority"]).build().fit(orders).transform(
        orders
    )


@query("""
with t as (select o_orderkey, nullif(o_orderpriority, '5-LOW') as priority from orders),
i as (select priority as v, (row_number() over (order by count(*) desc, priority) - 1)::double
             as idx from t where priority is not null group by 1)
select o_orderkey, priority, coalesce(idx, (select count(*) from i)::double) as priority_indexed
from t left join i on priority = v
""")
def prep_string_index_gaps(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority")
    )
    return PipelineBuilder().add_string_indexer(["priority"]).build().fit(orders).transform(orders)


ONE_HOT = """
r as (select l_returnflag as v, row_number() over (order by count(*) desc, l_returnflag) - 1 as i
      from lineitem group by 1)
"""


@query(f"""
with {ONE_HOT}
select l_orderkey, l_linenumber, (i = 0)::int::double as f0, (i = 1)::int::double as f1,
       (i = 2)::int::double as f2, 0.0::double as f3
from lineitem join r on l_returnflag = v
""")
def prep_one_hot(spark, sf):
    items = _items(spark, sf).select(*KEY, "l_returnflag")
    builder = PipelineBuilder().add_string_indexer(["l_returnflag"])
    pipeline = builder.add_one_hot_encoder(["l_returnflag"]).build()
    return _slots(pipeline.fit(items).transform(items), "l_returnflag_encoded", 4)


@query("""
select l_orderkey, l_linenumber, l_quantity as f0, l_extendedprice as f1, l_discount as f2
from lineitem
""")
def prep_assemble(spark, sf):
    columns = ["l_quantity", "l_extendedprice", "l_discount"]
    items = table(spark, sf, "lineitem").select(*KEY, *columns)
    assembled = PipelineBuilder().add_vector_assembler(columns).build().fit(items).transform(items)
    values = vector_to_array("features")
    return assembled.select(*KEY, *[values[i].alias(f"f{i}") for i in range(3)])


@query("""
select l_orderkey, l_linenumber,
       round((l_quantity - avg(l_quantity) over ()) / stddev_samp(l_quantity) over (), 6) as f0,
       round((l_discount - avg(l_discount) over ()) / stddev_samp(l_discount) over (), 6) as f1
from lineitem
""")
def prep_standard_scale(spark, sf):
    items = table(spark, sf, "lineitem").select(*KEY, "l_quantity", "l_discount")
    builder = PipelineBuilder().add_vector_assembler(["l_quantity", "l_discount"])
    pipeline = builder.add_standard_scaler().build()
    return _slots(pipeline.fit(items).transform(items), "scaled_features", 2)


@query("""
select l_orderkey, l_linenumber,
       round((l_quantity - min(l_quantity) over ())
             / (max(l_quantity) over () - min(l_quantity) over ()), 6) as f0,
       round((l_discount - min(l_discount) over ())
             / (max(l_discount) over () - min(l_discount) over ()), 6) as f1
from lineitem
""")
def prep_minmax_scale(spark, sf):
    items = table(spark, sf, "lineitem").select(*KEY, "l_quantity", "l_discount")
    builder = PipelineBuilder().add_vector_assembler(["l_quantity", "l_discount"])
    pipeline = builder.add_minmax_scaler().build()
    return _slots(pipeline.fit(items).transform(items), "scaled_features", 2)


FILLED = f"""
{SOURCE}, {ONE_HOT},
x as (select l_orderkey, l_linenumber, l_quantity as q,
             coalesce(tax, (select avg(tax) from t)) as tx,
             (i = 0)::int::double as c0, (i = 1)::int::double as c1, (i = 2)::int::double as c2
      from t join r on l_returnflag = v)
"""


def _scaled(column, alias):
    return f"round(({column} - avg({column}) over ()) / stddev_samp({column}) over (), 6) as {alias}"


@query(f"""
with {FILLED}
select l_orderkey, l_linenumber, {_scaled("q", "f0")}, {_scaled("tx", "f1")},
       {_scaled("c0", "f2")}, {_scaled("c1", "f3")}, {_scaled("c2", "f4")}, 0.0::double as f5
from x
""")
def prep_chain_numeric_first(spark, sf):
    items = _items(spark, sf)
    pipeline = preprocessing_pipeline(["l_quantity", "tax"], ["l_returnflag"])
    return _slots(pipeline.fit(items).transform(items), "scaled_features", 6)


@query(f"""
with {FILLED}
select l_orderkey, l_linenumber, {_scaled("c0", "f0")}, {_scaled("c1", "f1")},
       {_scaled("c2", "f2")}, {_scaled("q", "f3")}, {_scaled("tx", "f4")}
from x
""")
def prep_chain_category_first(spark, sf):
    items = _items(spark, sf)
    pipeline = preprocessing_pipeline(
        ["l_quantity", "tax"],
        ["l_returnflag"],
        categorical_first=True,
        encoder_invalid="error",
        assembler_invalid="error",
        assembled="assembled_features",
        scaled="features",
    )
    return _slots(pipeline.fit(items).transform(items), "features", 5)


@query(f"""
with {SOURCE}, {ONE_HOT},
x as (select l_orderkey, l_linenumber, l_quantity as q,
             coalesce(tax, (select quantile_disc(tax, 0.5) from t)) as tx,
             (i = 0)::int::double as c0, (i = 1)::int::double as c1, (i = 2)::int::double as c2
      from t join r on l_returnflag = v)
select l_orderkey, l_linenumber,
       round((q - min(q) over ()) / (max(q) over () - min(q) over ()), 6) as f0,
       round((tx - min(tx) over ()) / (max(tx) over () - min(tx) over ()), 6) as f1,
       c0 as f2, c1 as f3, c2 as f4, 0.5::double as f5
from x
""")
def prep_chain_minmax_median(spark, sf):
    items = _items(spark, sf)
    pipeline = preprocessing_pipeline(
        ["l_quantity", "tax"], ["l_returnflag"], "median", "minmax", relative_error=0
    )
    return _slots(pipeline.fit(items).transform(items), "scaled_features", 6)


@query("""
with i as (select l_partkey as v,
                  (row_number() over (order by count(*) desc, l_partkey::varchar) - 1)::double as idx
           from lineitem group by 1)
select l_orderkey, l_linenumber, idx as l_partkey_indexed from lineitem join i on l_partkey = v
""")
def prep_string_index_table(spark, sf):
    """Many labels, numbered and kept as a table."""
    items = table(spark, sf, "lineitem").select(*KEY, "l_partkey")
    model = PipelineBuilder().add_string_indexer(["l_partkey"], as_table=True).build().fit(items)
    return model.transform(items).select(*KEY, "l_partkey_indexed")


@query(f"""
with {ONE_HOT}
select l_orderkey, l_linenumber, (i = 0)::int::double as f0, (i = 1)::int::double as f1,
       (i = 2)::int::double as f2, 0.0::double as f3
from lineitem join r on l_returnflag = v
""")
def prep_one_hot_table(spark, sf):
    items = _items(spark, sf).select(*KEY, "l_returnflag")
    builder = PipelineBuilder().add_string_indexer(["l_returnflag"], as_table=True)
    pipeline = builder.add_one_hot_encoder(["l_returnflag"], as_table=True).build()
    return _slots(pipeline.fit(items).transform(items), "l_returnflag_encoded", 4)
