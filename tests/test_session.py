from __future__ import annotations

from rateweave.session import fresh_path, shared_dir, sizing_conf


def test_shared_dir_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == (named or spark.sparkContext.getCheckpointDir())
    a, b = fresh_path(spark, "x"), fresh_path(spark, "x")
    assert a != b and a.startswith(shared_dir(spark).rstrip("/"))


def test_sizing_for_100_tb_on_8000_slots():
    conf = sizing_conf(100 << 40, 8000)
    partitions = int(conf["spark.sql.shuffle.partitions"])
    assert partitions % 8000 == 0
    assert (100 << 40) / partitions <= 256 << 20
    assert conf["spark.sql.files.maxPartitionBytes"] == str(256 << 20)


def test_launcher_session_keeps_its_partition_count(spark):
    from rateweave.session import build_session

    before = spark.conf.get("spark.sql.shuffle.partitions")
    same = build_session(None)
    assert same.conf.get("spark.sql.shuffle.partitions") == before
    assert same.conf.get("spark.sql.adaptive.enabled") == "true"


def test_only_a_one_process_session_makes_its_own_folder():
    import pytest

    from rateweave.session import shared_dir

    class Stub:
        class conf:
            get = staticmethod(lambda key, default=None: None)

        class sparkContext:
            getCheckpointDir = staticmethod(lambda: None)

    for master in ("yarn", "spark://h:7077", "local-cluster[3,2,1024]", "k8s://x"):
        Stub.sparkContext.master = master
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_dir(Stub)


def test_scratch_folders_go_with_the_application(tmp_path):
    import os
    import subprocess
    import sys
    import time

    code = (
        "from rateweave.session import build_session, fresh_path\n"
        f"s = build_session('local[1]', extra={{'spark.checkpoint.dir': '{tmp_path}/shared'}})\n"
        "p = fresh_path(s, 'x'); s.range(3).write.parquet(p); print('AT', p, s.read.parquet(p).count()); s.stop()"
    )
    out = subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(os.path.dirname(__file__)), capture_output=True, text=True)
    path = out.stdout.split("AT ")[1].split()[0]
    assert out.stdout.strip().endswith(" 3")
    for _ in range(100):  # the JVM ends a little after Python
        if not os.path.exists(os.path.dirname(path)):
            return
        time.sleep(0.1)
    raise AssertionError(f"{path} is still there")
