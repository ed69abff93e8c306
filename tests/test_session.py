from billow.session import ensure_checkpoint_dir, scale_settings, scratch_path


def test_scale_settings_bounds():
    small = scale_settings(10 ** 9, 8)
    big = scale_settings(100 * 10 ** 12, 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 16          # two waves of 8 slots
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 10 ** 12 // (256 << 20) + 1  # follows the input
    assert int(scale_settings(100 * 10 ** 12, 8000, 65536)["spark.sql.shuffle.partitions"]) == 65536
    assert big["spark.sql.files.maxPartitionBytes"] == str(256 << 20)


def test_scratch_under_session_checkpoint_dir(spark):
    root = ensure_checkpoint_dir(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root.rstrip("/")) and a.endswith("/x")
    assert spark.sparkContext._jsc.sc().getCheckpointDir().isDefined() or spark.conf.get(
        "spark.checkpoint.dir", None)


def test_checkpoint_dir_chosen_only_when_unset(tmp_path):
    """A session without spark.checkpoint.dir gets one under its warehouse folder."""
    import os
    import subprocess
    import sys
    conf = tmp_path / "conf"
    conf.mkdir()                      # empty Spark conf folder: no cluster defaults
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "assert s.conf.get('spark.checkpoint.dir', None) is None\n"
        "from billow.session import ensure_checkpoint_dir, scratch_path\n"
        "root = ensure_checkpoint_dir(s)\n"
        "assert 'spark-warehouse/_billow_checkpoints' in root, root\n"
        "assert scratch_path(s, 'x').startswith(root)\n"
        "print('CHECKPOINT_OK')\n" % repo)
    env = dict(os.environ, SPARK_CONF_DIR=str(conf))
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300,
                         cwd=str(tmp_path), env=env)
    assert "CHECKPOINT_OK" in out.stdout, out.stderr[-3000:]
