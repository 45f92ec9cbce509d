"""Working folders that every executor can see."""

import functools
import tempfile
import uuid


@functools.cache
def _local_root(application_id):
    return tempfile.mkdtemp(prefix="lakework-")


def scratch_root(spark):
    """The cluster's shared folder, read from ``spark.checkpoint.dir``.

    Only a local master, where all tasks run on this machine, may fall back to
    a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_root(spark.sparkContext.applicationId)


def scratch_path(spark, name):
    """A path below the shared folder that no other run uses."""
    return f"{scratch_root(spark)}/lakework/{name}-{uuid.uuid4().hex}"
