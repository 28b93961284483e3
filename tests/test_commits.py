"""Tables of commits, the run log, versions of models, and a stream scored into a table."""

from multiprocessing.pool import ThreadPool

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tabloom.operators.features import GroupAggFeatures
from tabloom.sources import commits, runlog
from tabloom.sources.persistence import current_version, load_model, save_model, versions
from tabloom.streaming import open_stream, read_scored, score_to_table

SHAPE = "writer int, x int"


def rows(spark, writer, n=3):
    return spark.createDataFrame([(writer, k) for k in range(n)], SHAPE).coalesce(1)


def held(spark, path):
    return sorted(tuple(r) for r in commits.read(spark, path, SHAPE).collect())


def test_commits_of_many_writers(spark, tmp_path):
    path = str(tmp_path / "table")
    assert held(spark, path) == [] and not commits.is_table(spark, path)
    with ThreadPool(16) as pool:
        done = pool.map(lambda w: commits.commit(rows(spark, w), path, f"w{w}"), range(50))
        assert all(done)
        # Tried again, all at once: nothing is added.
        assert not any(pool.map(lambda w: commits.commit(rows(spark, w), path, f"w{w}"), range(50)))
    expected = sorted((w, k) for w in range(50) for k in range(3))
    assert held(spark, path) == expected


def test_writers_of_one_name(spark, tmp_path):
    path = str(tmp_path / "table")
    with ThreadPool(8) as pool:
        done = pool.map(lambda w: commits.commit(rows(spark, w), path, "one"), range(8))
    assert sum(done) >= 1
    found = held(spark, path)
    assert len(found) == 3 and len({w for w, _ in found}) == 1


def test_writer_that_is_stopped_leaves_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    commits.commit(rows(spark, 1), path, "a")
    with monkeypatch.context() as patch:
        patch.setattr(commits._Store, "put", lambda *_, **__: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            commits.commit(rows(spark, 2), path, "b")
    broken = rows(spark, 3).withColumn("x", F.raise_error(F.lit("stopped")).cast("int"))
    with pytest.raises(Exception, match="stopped"):
        commits.commit(broken, path, "c")
    assert held(spark, path) == [(1, k) for k in range(3)]
    assert commits.commit(rows(spark, 2), path, "b") and len(held(spark, path)) == 6
    assert commits.vacuum(spark, path) and len(held(spark, path)) == 6
    for name in ("", "a/b", "compact-1", ".x"):
        if name:
            with pytest.raises(ValueError):
                commits.commit(rows(spark, 1), path, name)


def test_compaction_keeps_rows_and_names(spark, tmp_path):
    path = str(tmp_path / "table")
    for w in range(6):
        commits.commit(rows(spark, w), path, f"w{w}")
    expected = held(spark, path)
    assert commits.compact(spark, path, SHAPE) and held(spark, path) == expected
    assert len(commits.folders(spark, path)) == 1 and not commits.compact(spark, path, SHAPE)
    assert not commits.commit(rows(spark, 2), path, "w2")
    commits.commit(rows(spark, 9), path, "w9")
    assert commits.compact(spark, path, SHAPE, files=2)
    expected = sorted([*expected, *[(9, k) for k in range(3)]])
    assert held(spark, path) == expected
    commits.vacuum(spark, path)
    assert held(spark, path) == expected and not commits.commit(rows(spark, 2), path, "w2")
    # Of two compactions of the same commits, one wins.
    commits.commit(rows(spark, 10), path, "w10")
    with ThreadPool(4) as pool:
        pool.map(lambda _: commits.compact(spark, path, SHAPE), range(4))
    assert held(spark, path) == sorted([*expected, *[(10, k) for k in range(3)]])


def test_run_log_by_run_id(spark, tmp_path):
    path = str(tmp_path / "log")
    entries = [runlog.entries(spark, f"run {i}", {"p": i}, {"r2": i / 50}, run_id=f"id{i}") for i in range(50)]
    with ThreadPool(10) as pool:
        pool.map(lambda i: runlog.append(entries[i], path, f"id{i}"), [*range(50), *range(50)])
    log = runlog.read(spark, path)
    assert log.count() == 100 and runlog.best(log, "r2").first()["run_name"] == "run 49"
    assert runlog.compact(spark, path) and runlog.read(spark, path).count() == 100
    assert not runlog.append(entries[3], path, "id3") and runlog.append(entries[3], path)
    # A log of plain files, as it was written before.
    old = str(tmp_path / "old")
    entries[0].write.parquet(old)
    assert runlog.read(spark, old).count() == 2


def fitted(spark, slope, n=50):
    data = spark.range(n).select(F.col("id").cast("double").alias("x"), (F.col("id") * slope).alias("label"))
    stages = [VectorAssembler(inputCols=["x"], outputCol="features"), LinearRegression(solver="normal")]
    return Pipeline(stages=stages).fit(data)


def slope_of(model):
    return round(float(model.stages[-1].coefficients[0]), 6)


def test_versions_of_a_model(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "model")
    saved = [save_model(fitted(spark, s), path) for s in (1, 2)]
    assert slope_of(load_model(path)) == 2 and current_version(path) == saved[1]
    assert slope_of(load_model(path, saved[0])) == 1 and versions(path) == saved
    # Stopped after each of its steps, saving leaves a model that loads.
    for step in ("put_text", "delete"):
        with monkeypatch.context() as patch:
            patch.setattr(commits, step, lambda *_: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                save_model(fitted(spark, 3), path, keep=1)
        assert slope_of(load_model(path)) == (2 if step == "put_text" else 3)
    save_model(fitted(spark, 4), path, keep=2)
    assert slope_of(load_model(path)) == 4 and len(versions(path)) == 2
    # A model saved without versions is loaded, and replaced.
    plain = str(tmp_path / "plain")
    fitted(spark, 5).save(plain)
    assert slope_of(load_model(plain)) == 5 and current_version(plain) is None
    save_model(fitted(spark, 6), plain)
    assert slope_of(load_model(plain)) == 6
    with pytest.raises(Exception):
        PipelineModel.load(plain)


def test_loaded_model_outlives_new_versions(spark, tmp_path):
    items = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0)], "g string, v double")
    stage = GroupAggFeatures(groupCol="g", valueCol="v", functions=["mean"])
    path = str(tmp_path / "model")
    save_model(Pipeline(stages=[stage]).fit(items), path)
    loaded = load_model(path)
    expected = sorted(loaded.transform(items).collect())
    save_model(loaded, path)
    assert sorted(loaded.transform(items).collect()) == expected
    assert sorted(load_model(path).transform(items).collect()) == expected


def test_stream_into_a_table_survives_replays(spark, tmp_path, monkeypatch):
    source, path, model, log = (str(tmp_path / n) for n in ("in", "out", "model", "log"))
    checkpoint = str(tmp_path / "progress")
    save_model(fitted(spark, 2), model)
    shape = "id long, x double, label double"

    def add(first, slope):
        data = spark.range(first, first + 40).select("id", F.col("id").cast("double").alias("x"))
        data.withColumn("label", F.col("x") * slope).coalesce(2).write.mode("append").parquet(source)

    def run():
        stream = open_stream(spark, source, shape, maxFilesPerTrigger=1)
        query = score_to_table(
            stream, model, path, checkpoint, ["id", "x"], task="regression", run_log=log, experiment="live"
        )
        query.awaitTermination()

    def scored():
        found = read_scored(spark, path, "id long, x double, prediction double, model_version string")
        return {r.id: r for r in found.collect()}, found.count()

    add(0, 2.0)
    append, calls = runlog.append, []

    def stops(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("stopped after the commit")
        return append(*args)

    with monkeypatch.context() as patch:
        patch.setattr(runlog, "append", stops)
        with pytest.raises(Exception, match="stopped after the commit"):
            run()
    assert scored()[1] == 40  # both batches are committed, the second is not known to be done
    second = save_model(fitted(spark, 3), model)
    add(40, 3.0)
    run()
    run()
    rows, n = scored()
    assert n == len(rows) == 80
    assert all(round(r.prediction, 6) == r.x * (2 if i < 40 else 3) for i, r in rows.items())
    assert {r.model_version for i, r in rows.items() if i >= 40} == {second}
    logged = runlog.compare(runlog.read(spark, log), ["rmse", "rows"]).collect()
    assert len(logged) == 4 and sum(r["rows"] for r in logged) == 80
    assert all(r["rmse"] < 1e-6 and r["experiment"] == "live" for r in logged)
    with pytest.raises(ValueError):
        score_to_table(spark.range(3), model, path, checkpoint)
    with pytest.raises(ValueError):
        score_to_table(open_stream(spark, source, shape), model, path, checkpoint, task="other")


def test_batches_without_labels_are_not_logged(spark, tmp_path):
    source, path, model, log = (str(tmp_path / n) for n in ("in", "out", "model", "log"))
    save_model(fitted(spark, 2), model)
    data = spark.range(5).select(F.col("id").cast("double").alias("x"), F.lit(None).cast("double").alias("label"))
    data.write.parquet(source)
    stream = open_stream(spark, source, data.schema)
    score_to_table(stream, model, path, str(tmp_path / "c"), ["x"], task="regression", run_log=log).awaitTermination()
    assert read_scored(spark, path, "x double").count() == 5 and not commits.is_table(spark, log)
