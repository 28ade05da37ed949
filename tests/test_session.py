"""Session defaults and the scratch folder."""

import types

from lakeshelf.session import scratch_path


def test_scratch_lies_in_the_folder_the_session_names(spark):
    first, second = scratch_path(spark, "a"), scratch_path(spark, "a")
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir") + "/")


def test_one_rule_for_any_master(monkeypatch):
    """The named folder, else the warehouse; neither the master nor a machine-local folder plays a part."""
    monkeypatch.setattr("lakeshelf.session.make_temporary", lambda spark, folder: None)
    values = {"spark.sql.warehouse.dir": "hdfs:///warehouse"}
    cluster = types.SimpleNamespace(conf=types.SimpleNamespace(get=lambda key, *default: values.get(key, *default)))
    assert scratch_path(cluster, "a").startswith("hdfs:///warehouse/lakeshelf-")
    values["spark.checkpoint.dir"] = "hdfs:///shared/"
    assert scratch_path(cluster, "a").startswith("hdfs:///shared/lakeshelf-")


def test_defaults(spark):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
