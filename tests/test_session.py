import pytest

from retail_lakehouse.session import ensure_checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, conf):
        self.master = master
        self._conf = _Conf(conf)
        self.dir = None

    def getCheckpointDir(self):
        return self.dir

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, d):
        self.dir = d


class _Session:
    def __init__(self, master, conf=None):
        self.sparkContext = _Context(master, conf or {})


def test_cluster_without_shared_checkpoint_folder_fails():
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Session("yarn"))


def test_cluster_uses_the_configured_folder():
    assert ensure_checkpoint_dir(_Session("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})) \
        == "hdfs:///shared/ckpt"


def test_local_mode_creates_its_own_folder(spark):
    assert ensure_checkpoint_dir(spark)


def test_ensure_layers_creates_each_schema_once(spark):
    from retail_lakehouse.sources.landing import ensure_layers
    ensure_layers(spark, "rl_test_bronze", "rl_test_silver")
    ensure_layers(spark, "rl_test_bronze")  # idempotent
    assert spark.catalog.databaseExists("rl_test_bronze")
    assert spark.catalog.databaseExists("rl_test_silver")


def test_initial_shuffle_partitions_follow_the_input_size():
    from retail_lakehouse.session import initial_shuffle_partitions
    mb = 1024 * 1024
    assert initial_shuffle_partitions(10 * mb, 8) == 8                 # small input: the parallelism
    assert initial_shuffle_partitions(100 * 1024 * 1024 * mb, 8) == 409_600  # 100 TB: 256 MB each as well
    assert initial_shuffle_partitions(1024 * 1024 * mb, 8) == 4096      # 1 TB: 256 MB each


class _RuntimeConf:
    def __init__(self):
        self.values = {}

    def set(self, k, v):
        self.values[k] = v

    def get(self, k, default=None):
        return self.values.get(k, default)


class _SizedContext(_Context):
    defaultParallelism = 16

    def getConf(self):
        conf = self._conf

        class _C:
            def contains(self, key):
                return key in conf.values
        return _C()


class _SizedSession:
    def __init__(self, conf=None):
        self.sparkContext = _SizedContext("yarn", conf or {})
        self.conf = _RuntimeConf()


def test_shuffle_partitions_are_sized_only_when_not_chosen():
    from retail_lakehouse.session import size_shuffle_partitions
    s = _SizedSession()
    assert size_shuffle_partitions(s, 1024 ** 4) == 4096
    assert s.conf.values["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "4096"
    chosen = _SizedSession({"spark.sql.shuffle.partitions": "2000"})
    assert size_shuffle_partitions(chosen, 1024 ** 4) is None and not chosen.conf.values


def test_sessions_with_an_explicit_count_are_left_alone(spark):
    from retail_lakehouse.session import size_shuffle_partitions
    assert size_shuffle_partitions(spark, 10 ** 12) is None


def test_a_count_chosen_at_run_time_is_kept_and_ours_is_resized():
    from retail_lakehouse.session import size_shuffle_partitions
    s = _SizedSession()
    s.conf.set("spark.sql.shuffle.partitions", "64")
    assert size_shuffle_partitions(s, 1024 ** 4) is None
    s = _SizedSession()
    s.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "300")
    assert size_shuffle_partitions(s, 1024 ** 4) is None
    s = _SizedSession()
    assert size_shuffle_partitions(s, 1024 ** 4) == 4096
    assert size_shuffle_partitions(s, 2 * 1024 ** 4) == 8192  # our own earlier choice is updated


def test_purge_removes_only_old_materialized_tables(spark):
    import os
    import time

    from retail_lakehouse.session import ensure_checkpoint_dir, materialize, purge_materialized
    old = materialize(spark.range(3), "purge-old")
    new = materialize(spark.range(4), "purge-new")
    old_dir = old.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:")
    new_dir = new.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:")
    week_ago = time.time() - 7 * 24 * 3600
    os.utime(old_dir, (week_ago, week_ago))
    assert purge_materialized(spark, older_than_seconds=24 * 3600) >= 1
    assert not os.path.exists(old_dir) and os.path.exists(new_dir)
    assert new.count() == 4
    assert ensure_checkpoint_dir(spark)


def test_input_bytes_measures_files_and_skips_unmeasurable_paths(spark):
    from retail_lakehouse.session import input_bytes
    sf = "/root/testdata/sf0.001"
    import os
    if not os.path.isdir(sf):
        return
    size = os.path.getsize(f"{sf}/nation.parquet")
    assert input_bytes(spark, [f"{sf}/nation.parquet"]) == size
    assert input_bytes(spark, [f"{sf}/nation.parquet", f"{sf}/no-such-table.parquet", f"{sf}/*.parquet"]) == size

def test_the_submitters_shuffle_partitions_stand():
    """A session built without a master keeps the submitted count."""
    import subprocess
    import sys
    import os
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "from retail_lakehouse.session import build_session as b; s = b(); print('N', s.conf.get('spark.sql.shuffle.partitions'))"
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": "--master local[1] --conf spark.sql.shuffle.partitions=2000 pyspark-shell", "PYTHONPATH": root}
    out = subprocess.run([sys.executable, "-c", code], env=env, cwd=root, capture_output=True, text=True, timeout=300)
    assert "N 2000" in out.stdout, out.stderr[-500:]


def test_own_tables_are_dropped_when_asked(spark):
    from retail_lakehouse.session import drop_materialized, materialize
    t = materialize(spark.range(10), "t")
    assert t.count() == 10
    folder = t.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    import os
    assert os.path.isdir(folder)
    assert drop_materialized(spark) >= 1 and not os.path.exists(folder)


def test_shuffles_of_columns_follow_the_input_and_leave_chosen_sizes():
    from retail_lakehouse.session import TASK_BYTES, size_shuffles_of_columns
    s = _SizedSession()
    assert size_shuffles_of_columns(s, 1024 ** 3) == 128  # 16 (the parallelism) before
    assert {k: s.conf.values[k] for k in TASK_BYTES} == {k: str(size) for k, (size, _) in TASK_BYTES.items()}
    assert size_shuffles_of_columns(s, 6 * 1024 ** 3) == 768
    key = "spark.sql.files.maxPartitionBytes"
    launched = _SizedSession({key: "1g"})
    size_shuffles_of_columns(launched, 1024 ** 3)
    assert key not in launched.conf.values
    s = _SizedSession()
    s.conf.set(key, "64m")
    size_shuffles_of_columns(s, 1024 ** 3)
    assert s.conf.values[key] == "64m"
