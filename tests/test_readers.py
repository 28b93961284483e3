"""Formats with connectors of their own get the name, the path and the options as they are given."""

from pyspark.sql.datasource import DataSource, DataSourceReader

from tabloom.sources import load


def test_format_path_and_options_arrive(spark):
    class Told(DataSourceReader):
        def __init__(self, options):
            self.options = options

        def read(self, partition):
            yield from self.options.items()

    class Probe(DataSource):
        """A format that gives back what it was told."""

        @classmethod
        def name(cls):
            return "probe"

        def schema(self):
            return "key string, value string"

        def reader(self, schema):
            return Told(dict(self.options))

    spark.dataSource.register(Probe)
    found = load(spark, "probe", "s3a://bucket/table", versionAsOf=3, mergeSchema="true")
    told = {r.key.lower(): r.value for r in found.collect()}
    assert told["path"] == "s3a://bucket/table"
    assert told["versionasof"] == "3" and told["mergeschema"] == "true"
    shaped = load(spark, "probe", "abfss://c@a.dfs.core.windows.net/t", schema="key string, value string")
    assert {r.value for r in shaped.collect()} == {"abfss://c@a.dfs.core.windows.net/t"}
