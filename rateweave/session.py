"""Session helpers: the recommended configuration and the shared folder.

Queries never configure the session they are handed.  ``build_session`` is
for the CLI, the bench and the tests; on a cluster the operator's own
session (with the same settings) is used instead.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime re-planning is what keeps these plans healthy at scale: AQE
# coalesces small shuffle partitions, turns a shuffle join into a broadcast
# one once the real (filtered) size is known, and splits a partition that a
# hot key has blown up (skew join) into advisory-size pieces.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = "local[*]",
    shuffle_partitions: int = 8,
    app_name: str = "rateweave",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the recommended settings.

    With a ``master`` (tests, the bench, local runs) every setting is applied.
    With ``master=None`` the session is the one the launcher (``spark-submit``)
    configured; only runtime SQL settings it left unset are filled in, and
    partition counts stay the launcher's (see ``sizing_conf``).
    """
    if master is None:
        spark = SparkSession.builder.appName(app_name).getOrCreate()
        for key, value in {**RECOMMENDED_CONF, **(extra or {})}.items():
            if key.startswith("spark.sql.") and spark.conf.get(key, None) is None:
                spark.conf.set(key, value)
        return spark
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = {**RECOMMENDED_CONF, "spark.sql.shuffle.partitions": str(shuffle_partitions)}
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can see, taken from ``spark.checkpoint.dir``.

    A one-process local session without the setting gets a scratch folder of
    its own, removed when it ends; any other session without it is an error,
    because a machine-local folder would lose data with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no local context
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if sc is None or not re.fullmatch(r"local(\[[^,\]]*(,[^\]]*)?\])?", sc.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="rateweave-shared-"))
    remove_at_end(spark, sc.getCheckpointDir())
    return sc.getCheckpointDir()


def remove_at_end(spark: SparkSession, folder: str) -> None:
    """Make ``folder`` and have the driver's file system delete it when the application ends."""
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session: the server's owner cleans up
        return
    target = sc._jvm.org.apache.hadoop.fs.Path(folder)
    files = target.getFileSystem(sc._jsc.hadoopConfiguration())
    files.mkdirs(target)
    files.deleteOnExit(target)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, never-used location under the shared folder, removed when the application ends."""
    folder = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    remove_at_end(spark, folder)
    return f"{folder}/{name}"


def sizing_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Partition sizing for an input of ``input_bytes`` on ``total_cores`` task slots.

    Scans split files into ``target_partition_bytes`` pieces; shuffles start
    from enough partitions that no reducer holds more than about that much
    (assuming a shuffle no larger than the input), in whole waves of the
    slots, and adaptive execution coalesces what turns out smaller.
    """
    pieces = max(1, -(-input_bytes // target_partition_bytes))
    waves = max(1, -(-pieces // max(1, total_cores)))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(waves * max(1, total_cores)),
        "spark.sql.shuffle.partitions": str(waves * max(1, total_cores)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
    }
