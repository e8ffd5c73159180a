"""Exact top products against all pairs."""

from pathlib import Path

import numpy as np
import pytest

from orrery.operators.products import top_products
from orrery.session import work_root


def factors(spark, values, first=0):
    return spark.createDataFrame([(first + i, [float(x) for x in row])
                                  for i, row in enumerate(values)],
                                 "id int, features array<float>")


def plain(users, items, n):
    u, v = (np.asarray(x, dtype=np.float32).astype(np.float64) for x in (users, items))
    out = {}
    for i, row in enumerate(u @ v.T):
        order = sorted(range(len(v)), key=lambda j: (-round(row[j], 9), j))[:n]
        out[i] = [(j, row[j]) for j in order]
    return out


@pytest.mark.parametrize("chunk, block, step", [(500_000, 64, 1024), (90, 16, 7), (1, 1, 50)])
def test_lists_are_those_of_all_pairs(spark, chunk, block, step):
    rng = np.random.default_rng(chunk)
    m = 250 if chunk > 1 else 6
    items = rng.normal(0, 1, (m, 12)) * rng.pareto(2, (m, 1)) * np.geomspace(2, 0.05, 12)
    items[5] = items[3]  # ties go to the smaller id
    users = rng.normal(0.3, 1, (60, 12)) * np.geomspace(2, 0.05, 12)
    users[0] = 0  # all products equal
    users[1] = -users[2]
    got = top_products(factors(spark, users), factors(spark, items), 9, chunk=chunk,
                       block=block, head=4, step=step).collect()
    want = plain(users, items, 9)
    assert len(got) == 60
    for r in got:
        assert r.ids == [j for j, _ in want[r.id]]
        assert np.allclose(r.scores, [x for _, x in want[r.id]], atol=1e-9)


def test_search_leaves_products_out(spark):
    rng = np.random.default_rng(2)
    items = rng.normal(0, 1, (5000, 20)) * rng.pareto(1.5, (5000, 1)) * np.geomspace(1, 0.02, 20)
    users = rng.normal(0, 1, (200, 20))
    got = top_products(factors(spark, users), factors(spark, items), 10).collect()
    want = plain(users, items, 10)
    assert all(r.ids == [j for j, _ in want[r.id]] for r in got)
    assert sum(r.work for r in got) < 0.4 * 200 * 5000


def test_few_items_and_none(spark):
    users = factors(spark, [[1.0, 2.0], [0.0, 0.0]])
    got = {r.id: (r.ids, r.scores) for r in
           top_products(users, factors(spark, [[1.0, 0.0], [0.0, 1.0]]), 5).collect()}
    assert got == {0: ([1, 0], [2.0, 1.0]), 1: ([0, 1], [0.0, 0.0])}
    none = top_products(users, factors(spark, [[1.0, 0.0]]).limit(0), 5).collect()
    assert [r.ids for r in none] == [[], []]
    assert top_products(users.limit(0), users, 5).count() == 0


@pytest.mark.parametrize("chunk, block, step", [(500_000, 1024, 512), (300, 64, 40)])
def test_flat_factors_and_all_pairs(spark, chunk, block, step):
    """Where no few axes carry the length, products in single precision come
    first; ``every`` multiplies out all pairs."""
    rng = np.random.default_rng(chunk)
    items, users = rng.normal(0, 1, (900, 30)), rng.normal(0, 1, (90, 30))
    items[700] = items[11]
    items[1] = items[0] * (1 + 1e-7)  # apart by less than a rounding
    want = plain(users, items, 20)
    one, two = (top_products(factors(spark, users), factors(spark, items), 20, chunk=chunk,
                             block=block, step=step, every=every).collect()
                for every in (False, True))
    for r in one:
        assert r.ids == [j for j, _ in want[r.id]]
    for r in two:
        assert r.work == 900
        assert np.allclose(r.scores, [x for _, x in want[r.id]], rtol=1e-4, atol=1e-4)
    assert len(one) == len(two) == 90


def test_items_beside_whole_groups(spark):
    """Products are compared by groups of items first; the best ones lie among
    the items left over, and ties and negative products within groups."""
    rng = np.random.default_rng(7)
    items, users = rng.normal(0, 1, (75, 30)), rng.normal(0, 1, (40, 30))
    items[[40, 41, 64]] = items[3]
    items[70:] *= 5
    users[0] = -items.sum(axis=0)
    want = plain(users, items, 40)
    for every in (False, True):
        got = top_products(factors(spark, users), factors(spark, items), 40, block=70, step=16,
                           every=every).collect()
        for r in got:
            assert np.allclose(r.scores, [x for _, x in want[r.id]], rtol=1e-4, atol=1e-4)
            assert every or r.ids == [j for j, _ in want[r.id]]


@pytest.mark.parametrize("every", [False, True])
def test_states_of_earlier_chunks_are_deleted(spark, every):
    """The disk holds the last state and those users that were done before,
    each once, however many chunks there are; the rows can be read again."""
    rng = np.random.default_rng(11)
    items = rng.normal(0, 1, (400, 8)) * np.geomspace(3, 0.01, 400)[:, None]
    items[0] = 100  # who has a positive product with it is soon done
    users = np.abs(rng.normal(0, 1, (64, 8))) * np.where(np.arange(64) % 2, 1, -1)[:, None]
    scratch = Path(work_root(spark, "scratch").removeprefix("file:"))
    before = set(scratch.glob("products-*"))
    found = top_products(factors(spark, users), factors(spark, items), 3, chunk=40, every=every)
    root, = set(scratch.glob("products-*")) - before
    assert [p.name for p in root.glob("state-*")] == ["state-8"]
    done = [spark.read.parquet(str(p)).count() for p in root.glob("done-*")]
    assert sum(done) == 0 if every else 0 < sum(done) <= 64
    want = plain(users, items, 3)
    for _ in range(2):
        got = found.collect()
        assert sorted(r.id for r in got) == list(range(64))
        for r in got:
            assert np.allclose(r.scores, [x for _, x in want[r.id]], rtol=1e-4, atol=1e-4)
