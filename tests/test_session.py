"""Settings and the shared folder."""

from types import SimpleNamespace

import pytest

import __spark_entry__ as entry_point
from airhour.session import ensure_checkpoint_dir, prepare, scratch_path, shared_folder


def test_queries_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    query = entry_point.queries()["previous_hour_scan"]
    first = sorted(map(tuple, query(spark, "/root/testdata/sf0.001").collect()))
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert first == sorted(map(tuple, query(prepare(spark), "/root/testdata/sf0.001").collect()))


def test_scratch_paths_are_new_and_in_the_shared_folder(spark):
    ensure_checkpoint_dir(spark)
    paths = {scratch_path(spark, "t") for _ in range(3)}
    assert len(paths) == 3 and all(p.startswith(shared_folder(spark)) for p in paths)
    assert spark.sparkContext.getCheckpointDir()


def session(conf=None, context_folder=None, master="yarn"):
    """A stand-in with only what the lookup reads."""
    folders = [context_folder]
    context = SimpleNamespace(
        master=master, getCheckpointDir=lambda: folders[-1], setCheckpointDir=lambda f: folders.append(f)
    )
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: conf or default), sparkContext=context)


def test_order_of_folders():
    assert shared_folder(session("/shared/a/", "/shared/b")) == "/shared/a"
    assert shared_folder(session(None, "/shared/b")) == "/shared/b"


def test_a_cluster_never_gets_a_local_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session())


def test_a_local_session_gets_one_folder():
    local = session(master="local[2]")
    assert shared_folder(local) == shared_folder(local)
