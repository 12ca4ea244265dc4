"""Scratch locations: the session's checkpoint folder, set only when unset."""

from stratum.session import checkpoint_dir, scratch_path


class _Conf:
    def __init__(self, values):
        self.values = dict(values)

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, current=None, conf=None):
        self.current = current
        self.conf = _Conf(conf or {})
        self.set_calls = []

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, d):
        self.set_calls.append(d)
        self.current = f"file:{d}/uuid"

    def getConf(self):
        return self.conf


class _Session:
    def __init__(self, sc, conf=None):
        self._sc = sc
        self.conf = _Conf(conf or {})

    @property
    def sparkContext(self):
        if self._sc is None:
            raise RuntimeError("no context (Spark Connect)")
        return self._sc


def test_existing_checkpoint_dir_is_used_as_is():
    sc = _Context(current="hdfs://nn/ckpt/abc/")
    assert checkpoint_dir(_Session(sc)) == "hdfs://nn/ckpt/abc"
    assert sc.set_calls == []


def test_configured_dir_is_read_not_applied():
    sc = _Context(conf={"spark.checkpoint.dir": "s3a://bucket/ckpt"})
    assert checkpoint_dir(_Session(sc)) == "s3a://bucket/ckpt"
    assert sc.set_calls == []  # the caller's session stays as it is


def test_unset_dir_gets_a_local_one_only_then():
    sc = _Context()
    got = checkpoint_dir(_Session(sc, conf={"spark.master": "local[4]"}))
    assert len(sc.set_calls) == 1 and "stratum-checkpoints-" in sc.set_calls[0]
    assert got.endswith("/uuid")


def test_unset_dir_on_a_cluster_is_an_error():
    import pytest

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(_Session(_Context(), conf={"spark.master": "yarn"}))


def test_connect_session_reads_conf():
    s = _Session(None, conf={"spark.checkpoint.dir": "abfss://c@a/ckpt/"})
    assert checkpoint_dir(s) == "abfss://c@a/ckpt"


def test_scratch_paths_are_unique_and_below_checkpoint_dir(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    base = spark.sparkContext.getCheckpointDir().rstrip("/")
    assert a != b and a.startswith(base + "/stratum/x-")


def test_drop_scratch_takes_only_its_own_folders(spark):
    import pytest

    from stratum.session import drop_scratch

    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    drop_scratch(spark, path)
    with pytest.raises(Exception):
        spark.read.parquet(path)
    with pytest.raises(ValueError):
        drop_scratch(spark, "/tmp/elsewhere")
