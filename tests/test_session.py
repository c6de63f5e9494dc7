"""Scratch folders belong to the thread that made them."""

import threading

import pytest

from gridcube import session as S


def test_cleanup_leaves_other_threads_alone(spark):
    S.cleanup(spark)
    made, ready, done = {}, threading.Event(), threading.Event()

    def other():
        made["other"] = S.materialize(spark.range(5), "other")
        ready.set()
        done.wait(60)
        made["gone"] = S.cleanup(spark)

    t = threading.Thread(target=other)
    t.start()
    assert ready.wait(60)
    mine = S.materialize(spark.range(3), "mine")
    kept = S.materialize(spark.range(4), "kept")
    assert S.cleanup(spark, keep=[kept]) == 1
    assert made["other"].count() == 5 and kept.count() == 4
    with pytest.raises(Exception):
        mine.count()
    done.set()
    t.join()
    assert made["gone"] == 1
    with pytest.raises(Exception):
        spark.read.parquet(*made["other"].inputFiles()).count()
    assert S.release(kept) == 1 and S.cleanup(spark) == 0


def test_release_finds_a_result_of_another_thread(spark):
    made = []
    t = threading.Thread(target=lambda: made.append(S.materialize(spark.range(5), "far")))
    t.start()
    t.join()
    assert made[0].count() == 5 and S.release(made[0]) == 1 and S.release(spark.range(1)) == 0


def test_partitioned_tables_and_the_warning(spark, monkeypatch):
    df = S.materialize(spark.range(6).selectExpr("id", "cast(id % 2 as int) as p"), "parts", partition_by=["p"])
    assert {f.split("/p=")[1][0] for f in df.inputFiles()} == {"0", "1"}

    class Elsewhere:
        class sparkContext:
            master = "spark://far:7077"

        class conf:
            @staticmethod
            def get(key, default=None):
                return None if key == "spark.checkpoint.dir" else "/warehouse"
    with pytest.warns(UserWarning, match="spark.checkpoint.dir"):
        assert S.checkpoint_dir(Elsewhere) == "/warehouse/_intermediate"
