"""Incremental landing lands every file exactly once; the user dimension kept
from batches equals a full build."""

import pytest

from orrery.plans.silver import silver_ratings
from orrery.plans.star import dim_user_rows
from orrery.session import unique_name, work_root
from orrery.sources.catalog import Catalog
from orrery.sources.files import write_text_csv
from orrery.streaming import UserMaintenance, land_new_files


def test_second_run_lands_only_new_files(spark):
    root = work_root(spark, unique_name("test-stream"))
    cols = ["a", "b"]
    write_text_csv(spark.createDataFrame([("1", "x"), ("2", None)], "a string, b string"),
                   f"{root}/in/f1")
    assert land_new_files(spark, f"{root}/in/*/part-*", cols, f"{root}/out", f"{root}/ck") == 2
    assert land_new_files(spark, f"{root}/in/*/part-*", cols, f"{root}/out", f"{root}/ck") == 0
    write_text_csv(spark.createDataFrame([("3", " y ")], "a string, b string"), f"{root}/in/f2")
    assert land_new_files(spark, f"{root}/in/*/part-*", cols, f"{root}/out", f"{root}/ck") == 1
    rows = sorted((r.a, r.b) for r in spark.read.parquet(f"{root}/out").collect())
    assert rows == [("1", "x"), ("2", None), ("3", " y ")]


def _upkeep(spark, root, merge_after=64):
    items = spark.createDataFrame([(1,), (2,), (3,)], "item_id int")
    return UserMaintenance(Catalog(spark, f"{root}/catalog").create(), items, "s", merge_after)


def _raw(spark, rows):
    return spark.createDataFrame(rows, "user_id string, item_id string, rating string")


def _users(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_batches_give_the_full_build(spark):
    """Random batches with repeated pairs, sentinels, orphans and nulls, merged
    in between, against one build over everything so far."""
    import random

    rnd = random.Random(3)
    root = work_root(spark, unique_name("test-upkeep"))
    upkeep, everything = _upkeep(spark, root, merge_after=3), []
    for number in range(5):
        rows = [(rnd.choice([None, "1", "2", "3", " 4 ", "x"]), rnd.choice(["1", "2", "3", "9", None]),
                 rnd.choice(["-1", "-1", "5", "7", None, "10"])) for _ in range(12)]
        everything += rows
        assert upkeep.apply(_raw(spark, rows), number)
        fact = silver_ratings(_raw(spark, everything), upkeep.items)
        want = _users(dim_user_rows(fact))
        assert _users(upkeep.dim_user()) == want
        assert not upkeep.apply(_raw(spark, rows), number)  # comes again
        assert _users(upkeep.dim_user()) == want
    first, last = upkeep._numbers(upkeep.catalog.version("user_increments"))
    assert last - first + 1 < 3


def test_failed_and_repeated_batches_change_nothing(spark, monkeypatch):
    root = work_root(spark, unique_name("test-upkeep"))
    upkeep = _upkeep(spark, root)
    upkeep.apply(_raw(spark, [("1", "1", "5"), ("1", "2", "-1")]), 0)
    before = _users(upkeep.dim_user())
    assert before == [(1, 2, 5.0)]
    second = [("1", "2", "8"), ("2", "1", "-1")]
    with monkeypatch.context() as m:  # both increments are written, the manifest is not
        def stop(*_):
            raise RuntimeError("lost")
        m.setattr(upkeep, "_commit", stop)
        with pytest.raises(RuntimeError):
            upkeep.apply(_raw(spark, second), 1)
    assert _users(upkeep.dim_user()) == before
    assert upkeep.apply(_raw(spark, second), 1)
    after = [(1, 2, 6.5), (2, 1, None)]
    assert _users(upkeep.dim_user()) == after
    # Another checkpoint starts at 0 again: what is known leaves no increment.
    upkeep.source = "other"
    assert upkeep.apply(_raw(spark, second + [("1", "1", "2")]), 0)
    assert _users(upkeep.dim_user()) == after
    assert upkeep.apply(_raw(spark, []), 1)  # an empty batch
    assert _users(upkeep.dim_user()) == after
