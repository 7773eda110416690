"""Where the library may write scratch data (replay files, example targets).

On a cluster that is the shared folder named by ``spark.checkpoint.dir``;
a machine-local temporary folder would be invisible to other executors.
Only when the session has none (local tests) is a local one created and
registered as the checkpoint directory.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's shared checkpoint directory, set up locally only when unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    conf = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="streamload-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unused sub-folder of the shared directory for one run."""
    base = shared_dir(spark).rstrip("/")
    path = f"{base}/streamload/{name}-{uuid.uuid4().hex[:12]}"
    if path.startswith("file:"):
        os.makedirs(path[len("file:"):], exist_ok=True)
    elif "://" not in path:
        os.makedirs(path, exist_ok=True)
    return path
