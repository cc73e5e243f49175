"""Spark session helpers.

Jobs never build their own session: they take the caller's. These helpers
are for tests, the bench and command-line use, and for the one piece of
session state the library needs: a reliable checkpoint directory.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Local session with the settings the jobs assume (UTC, AQE, no UI)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("condoledger")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory, setting one only if unset.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder and is
    read from the session. Only a local-mode session (tests, bench) without
    one gets a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder of the cluster"
        )
    path = tempfile.mkdtemp(prefix="condoledger-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path
