"""Types of text columns, found and counted in one aggregation.

Spark's own inference reads all files once before they are loaded and tells only the outcome. Here
the same pass counts, for every column and type, the cells that are no value of it, so that one bad
cell in a billion is seen as such and not as a column of strings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.functions import quoted
from tabloom.sources.readers import load_csv

# Types from narrow to wide, and the form that a cell has to have besides being castable.
NUMBERS = {
    "int": r"^[+-]?[0-9]+$",
    "bigint": r"^[+-]?[0-9]+$",
    "decimal(38,0)": r"^[+-]?[0-9]+$",
    "double": r"^([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|NaN|-?Inf)$",
}
TIMES = {
    "date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    "timestamp": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9:.]+(Z|[+-][0-9:]+)?)?$",
}
OTHERS = {"boolean": r"^(?i)(true|false)$"}
LATTICE = (NUMBERS, TIMES, OTHERS)


def _fits(cell: Column, kind: str, form: str) -> Column:
    named = F.regexp_replace(cell, "Inf$", "Infinity") if kind == "double" else cell
    return cell.rlike(form) & named.try_cast(kind).isNotNull()


def inferred(df: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """``place, column, type, cells, misfits`` of a table of strings.

    ``type`` is the narrowest that all non-empty cells are values of, but for a share of at most
    ``tolerance``; numbers widen to double, dates to timestamps, all else to strings. ``misfits``
    maps each type to the number of cells that are no value of it. A column without cells is a
    string.
    """
    kinds = [(kind, form) for chain in LATTICE for kind, form in chain.items()]
    aggregates = []
    for i, name in enumerate(df.columns):
        cell = quoted(name)
        aggregates.append(F.count(cell).alias(f"n{i}"))
        for j, (kind, form) in enumerate(kinds):
            aggregates.append(F.count_if(cell.isNotNull() & ~_fits(cell, kind, form)).alias(f"c{i}_{j}"))
    rows = []
    for i, name in enumerate(df.columns):
        cells = F.col(f"n{i}")
        allowed = F.floor(cells * tolerance)
        choice = F.lit("string")
        for j, (kind, _) in reversed(list(enumerate(kinds))):
            choice = F.when(F.col(f"c{i}_{j}") <= allowed, kind).otherwise(choice)
        misfits = F.create_map(
            *[x for j, (kind, _) in enumerate(kinds) for x in (F.lit(kind), F.col(f"c{i}_{j}"))]
        )
        rows.append(
            F.struct(
                F.lit(i).alias("place"),
                F.lit(name).alias("column"),
                F.when(cells > 0, choice).otherwise("string").alias("type"),
                cells.alias("cells"),
                misfits.alias("misfits"),
            )
        )
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def schema_of(found: DataFrame) -> str:
    """The schema that ``inferred`` tells, for a reader."""
    rows = found.orderBy("place").collect()
    return ", ".join(f"`{r['column'].replace('`', '``')}` {r['type']}" for r in rows)


def load_csv_inferred(
    spark: SparkSession, path: str | Sequence[str], tolerance: float = 0.0, **options: object
) -> tuple[DataFrame, DataFrame]:
    """CSV with inferred types, and the table of ``inferred``. Cells that do not fit are NULL."""
    path = path if isinstance(path, str) else list(path)
    texts = load_csv(spark, path, infer=False, **options)
    found = inferred(texts, tolerance)
    kept = spark.createDataFrame(found.collect(), found.schema)
    return load_csv(spark, path, schema=schema_of(kept), **options), kept
