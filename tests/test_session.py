"""Scale helpers: shuffle sizing from input bytes, paths by their file system."""

from __future__ import annotations

import pytest

from vulnsift.session import input_bytes, path_exists, sized_shuffles

KEYS = ("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_each_run_is_sized_by_its_own_input(spark):
    before = [spark.conf.get(k, None) for k in KEYS]
    floor = spark.sparkContext.defaultParallelism
    for nbytes, wanted in ((10, floor), (100 * 1024**4, 409_600), (1, floor)):  # 100 TiB / 256 MiB
        with sized_shuffles(spark, nbytes) as n:
            assert n == wanted and spark.conf.get(KEYS[0]) == str(wanted)
        assert [spark.conf.get(k, None) for k in KEYS] == before


def test_settings_return_after_a_failure(spark):
    before = [spark.conf.get(k, None) for k in KEYS]
    with pytest.raises(RuntimeError), sized_shuffles(spark, 1 << 40):
        raise RuntimeError
    assert [spark.conf.get(k, None) for k in KEYS] == before


def test_input_bytes(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"x" * 1000)
    (tmp_path / "b").write_bytes(b"y" * 24)
    assert input_bytes(spark, str(tmp_path), str(tmp_path / "missing")) == 1024


def test_paths_are_looked_up_on_their_file_system(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"x")
    for path in (f"{tmp_path}/a", f"file:{tmp_path}/a", f"file://{tmp_path}/a"):
        assert path_exists(spark, path)
        assert not path_exists(spark, path + "b")
