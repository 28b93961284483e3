"""Profiles that merge, and types that are inferred with counts."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tabloom.operators import profile, profile_states
from tabloom.sources import load_csv
from tabloom.sources.inference import inferred, load_csv_inferred, schema_of


@pytest.fixture(scope="module")
def items(spark):
    rng = random.Random(3)
    rows = []
    for i in range(4000):
        x = rng.choice([None, rng.gauss(1e8, 2), rng.gauss(1e8, 2)])
        rows.append((i, x, rng.choice(["a", "b", "", None, f"t{rng.randrange(900)}"]), rng.random() < 0.5, [i % 5], i % 7))
    shape = "`id.x` long, x double, `s s` string, b boolean, l array<int>, seven int"
    return spark.createDataFrame(rows, shape).repartition(5)


def test_merged_states_are_those_of_the_whole(items):
    parts = [profile_states.states(items.filter(F.col("seven") % 3 == i)) for i in range(3)]
    empty = profile_states.states(items.filter("false"))
    merged = profile_states.merge(parts[0].union(parts[1]).union(parts[2]).union(empty))
    merged = profile_states.merge(merged)
    found = {r["column"]: r for r in profile_states.report(merged).collect()}
    whole = {r["column"]: r for r in profile_states.report(profile_states.states(items)).collect()}
    assert list(found) == items.columns
    exact = {r["column"]: r for r in profile.statistics(items.withColumnsRenamed({"id.x": "id_x", "s s": "s_s"})).collect()}
    distinct = {c: items.select(f"`{c}`").distinct().count() for c in items.columns}
    missing = profile.missing(items).first()
    for name, r in found.items():
        assert (r["rows"], r["missing"]) == (4000, missing[name])
        assert abs(r["distinct"] / distinct[name] - 1) < 0.08
        for key in ("count", "min", "max", "min_text", "max_text"):
            assert r[key] == whole[name][key]
        if r["mean"] is not None:
            assert r["mean"] == pytest.approx(whole[name]["mean"], rel=1e-12)
            assert r["stddev"] == pytest.approx(whole[name]["stddev"], rel=1e-9)
        same = exact.get(name.replace(".", "_").replace(" ", "_"))
        if same is not None:
            for key in ("count", "min", "max", "min_text", "max_text"):
                assert r[key] == same[key]
            assert same["stddev"] is None or r["stddev"] == pytest.approx(same["stddev"], rel=1e-9)


def test_quantiles_of_merged_states(items):
    parts = [profile_states.states(items.filter(F.col("seven") % 2 == i), ["id.x", "x", "s s"]) for i in range(2)]
    merged = profile_states.merge(parts[0].union(parts[1]))
    found = profile_states.quantiles(merged, [0.0, 0.25, 0.5, 1.0]).collect()
    assert {r["column"] for r in found} == {"id.x", "x"}
    for r in found:
        if r["column"] == "id.x":
            assert abs(r["value"] / 3999 - r["probability"]) < 0.04
    # Infinities are values, NaN is missing; a column of nothing has no quantiles.
    spark = items.sparkSession
    odd = spark.createDataFrame([(math.inf, None), (math.nan, None), (1.0, None)], "x double, n double")
    state = profile_states.states(odd)
    rows = {r["column"]: r for r in profile_states.report(state).collect()}
    assert rows["x"]["missing"] == 1 and rows["n"]["count"] == 0 and rows["n"]["mean"] is None
    assert {(r["column"], r["value"]) for r in profile_states.quantiles(state, [1.0]).collect()} == {("x", math.inf)}
    nothing = profile_states.report(profile_states.states(items.filter("false"))).collect()
    assert all(r["rows"] == 0 and r["pct"] is None and r["distinct"] == 0 for r in nothing)


CELLS = {
    "int": ["1", "-2", "+3", "2147483647"],
    "bigint": ["1", "2147483648", "-9"],
    "decimal(38,0)": ["1", "92233720368547758080"],
    "double": ["1", "1.5", "-2e3", ".5", "7.", "NaN"],
    "date": ["2024-01-31", "1999-12-01"],
    "timestamp": ["2024-01-31", "2024-01-31 10:00:00", "2024-01-31T10:00:00.123"],
    "boolean": ["true", "False"],
    "string": ["1", "2024-01-31", "x"],
}


def test_types_are_those_of_spark(spark, tmp_path):
    names = list(CELLS)
    rows = [tuple(CELLS[n][i % len(CELLS[n])] if i % 4 else None for n in names) for i in range(40)]
    texts = spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names))
    texts.write.option("header", True).csv(str(tmp_path / "cells"))
    df, found = load_csv_inferred(spark, str(tmp_path / "cells"))
    assert {r["column"]: r["type"] for r in found.collect()} == {n: n for n in names}
    theirs = load_csv(spark, str(tmp_path / "cells"))
    same = [n for n in names if n != "decimal(38,0)"]  # there, the digits that were met
    assert [df.schema[n].dataType for n in same] == [theirs.schema[n].dataType for n in same]
    assert sorted(map(str, df.select(*[f"`{n}`" for n in same]).collect())) == sorted(
        map(str, theirs.select(*[f"`{n}`" for n in same]).collect())
    )
    counts = {r["column"]: r for r in found.collect()}
    assert counts["string"]["cells"] == 30
    assert counts["string"]["misfits"]["int"] + sum(r[-1] == "1" for r in rows) == 30
    assert counts["double"]["misfits"] == counts["double"]["misfits"] | {"double": 0}


def test_types_with_tolerance(spark):
    rows = [(str(i), None, "no" if i == 7 else str(i), "2024-02-30" if i == 3 else "2024-02-01") for i in range(100)]
    df = spark.createDataFrame(rows, "`a.b` string, none string, bad string, day string")
    assert schema_of(inferred(df)) == "`a.b` int, `none` string, `bad` string, `day` string"
    found = inferred(df, tolerance=0.01)
    assert schema_of(found) == "`a.b` int, `none` string, `bad` int, `day` date"
    by_name = {r["column"]: r for r in found.collect()}
    assert by_name["bad"]["misfits"]["int"] == 1 and by_name["day"]["misfits"]["date"] == 1
    assert by_name["none"]["cells"] == 0
    assert schema_of(inferred(df.filter("false"))) == "`a.b` string, `none` string, `bad` string, `day` string"
