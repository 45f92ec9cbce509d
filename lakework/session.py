"""Session factory."""

import os

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Streaming state larger than the heap lives on local disk and is
    # snapshotted to the checkpoint folder.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def s3a_options(endpoint=None, path_style=True, ssl=True, **extra):
    """Connector settings as session options; keys come from the environment only.

    ``extra`` adds further ``fs.s3a`` settings, with ``_`` standing for ``.``.
    """
    options = {
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
    }
    if endpoint:
        options["spark.hadoop.fs.s3a.endpoint"] = endpoint
    for variable, setting in (
        ("AWS_ACCESS_KEY_ID", "access.key"),
        ("AWS_SECRET_ACCESS_KEY", "secret.key"),
        ("AWS_SESSION_TOKEN", "session.token"),
    ):
        if os.environ.get(variable):
            options[f"spark.hadoop.fs.s3a.{setting}"] = os.environ[variable]
    for name, value in extra.items():
        options[f"spark.hadoop.fs.s3a.{name.replace('_', '.')}"] = str(value)
    return options


def lake_session(app_name="lakework", master=None, options=None):
    """A session with UTC times, adaptive execution and per-partition overwrite.

    ``master`` and memory settings are left to spark-submit unless given.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**DEFAULTS, **(options or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
