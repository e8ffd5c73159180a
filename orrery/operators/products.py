"""Exact top products: for every row of one factor table the rows of another
with the greatest inner product, without all pairs.

Item factors are taken in the order of their norm, largest first, in chunks
of at most CHUNK rows (a bounded broadcast) and blocks of BLOCK rows within a
chunk. A user who holds n products needs no further block once |user| times
the block's greatest norm is below the least of them (Cauchy-Schwarz). Within
a block the axes are turned so that the first of them carry all but TAIL of
the items' squared length: the product over these plus the product of what is left of
both norms bounds the whole product. Where few pairs may reach the user's
least product only they are multiplied out, else the items of any such pair;
where it takes most axes to carry the length, whole products in single
precision come first. Products within their rounding of the least one are
taken again in double precision; of GROUP items the greatest product is
compared first, as few reach it. Users never move between tasks;
between chunks only those that are still open are written and read again.
What a chunk started from is deleted once its users are written, so the disk
holds two states of the open users at most, however many chunks there are.

The products are those of the factors in double precision; equal ones go to
the smaller item id. Bounds leave room for rounding, so no item is missed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.operators.numbering import global_row_number
from orrery.session import unique_name, work_root
from orrery.sources.commitlog import delete

CHUNK = 200_000
BLOCK = 1024
TAIL = 0.12
#: Users that one vectorised step handles.
STEP = 512
#: Items whose greatest product is compared first.
GROUP = 32
_FOUND = ["id", "ids", "scores", "work"]
_STATE = ("id int, norm double, features array<float>, ids array<int>, scores array<double>, "
          "work bigint")


def _axes(items: DataFrame, rank: int):
    """An orthogonal basis in which the items' length lies in the first axes,
    and how many carry all but TAIL of its square: the eigenvectors of the sum
    of their outer products (rank x rank sums)."""
    import numpy as np

    sums = [F.sum(F.col("features")[i].cast("double") * F.col("features")[j].cast("double"))
            for i in range(rank) for j in range(i + 1)]
    row = items.agg(*[s.alias(f"s{k}") for k, s in enumerate(sums)]).first()
    gram = np.zeros((rank, rank))
    gram[np.tril_indices(rank)] = [x or 0.0 for x in row]
    gram += np.tril(gram, -1).T
    energy, axes = np.linalg.eigh(gram)
    left = np.cumsum(np.maximum(energy, 0))  # of the axes from the last on
    tail = np.count_nonzero(left <= TAIL * left[-1])
    return axes[:, ::-1], max(1, rank - tail)


def _search(shared, n: int, head: int | None, block: int, step: int) -> Callable:
    """One chunk of items against batches of users (``head``: None for all
    products). The function holds all it needs, so that executors need not
    have this package."""
    import numpy as np
    import pyarrow as pa

    group = GROUP  # held by the function

    def lists(part):
        """The lists of a batch (ids, scores) as matrices, filled up with nothing."""
        ids = np.full((part.num_rows, n), np.iinfo(np.int32).max, dtype=np.int64)
        scores = np.full((part.num_rows, n), -np.inf)
        held = part["ids"].value_lengths().to_numpy(zero_copy_only=False)
        there = np.arange(n) < held[:, None]
        ids[there] = part["ids"].flatten().to_numpy(zero_copy_only=False)
        scores[there] = part["scores"].flatten().to_numpy(zero_copy_only=False)
        return ids, scores

    def merge(ids, scores, row, new, value) -> None:
        """Enter products ``value`` of items ``new`` into the lists of users
        ``row``: by product, then by id."""
        who, own = np.unique(row, return_inverse=True)
        own = np.concatenate([np.repeat(np.arange(len(who)), n), own])
        value = np.concatenate([scores[who].ravel(), value])
        new = np.concatenate([ids[who].ravel(), new])
        order = np.lexsort((new, -value, own))
        first = np.searchsorted(own[order], np.arange(len(who)))
        best = order[first[:, None] + np.arange(n)]
        scores[who], ids[who] = value[best], new[best]

    def reached(product, least):
        """(user, item) of the products (items x users) that reach the user's
        ``least``. Few do, so the greatest of GROUP items is compared first."""
        whole = len(product) // group * group
        grouped = product[:whole].reshape(-1, group, product.shape[1])
        g, r = np.nonzero(grouped.max(axis=1) >= least)
        k, j = np.nonzero(grouped[g, :, r] >= least[r][:, None])
        c, rest = np.nonzero(product[whole:] >= least)
        return np.concatenate([r[k], rest]), np.concatenate([g[k] * group + j, c + whole])

    def bounded(item_id, item) -> Callable:
        """Search of one chunk that leaves out whatever the bounds exclude."""
        rank = item.shape[1]
        few = 2 * head <= rank  # few axes tell which items may matter
        span = block if few else 2 * block
        norm = np.sqrt((item ** 2).sum(axis=1))
        rest = np.sqrt((item[:, head:] ** 2).sum(axis=1))
        single = item.astype(np.float32)
        # What a product in single precision may be off, per unit of both norms.
        off = 4 * (rank + 4) * 2.0 ** -24

        def found(user, ids, scores, work):
            """Update ids and scores (users x n, best first) in place."""
            length = np.sqrt((user ** 2).sum(axis=1))
            left = np.sqrt((user[:, head:] ** 2).sum(axis=1))
            room = 1e-9 * (1 + length)
            narrow = user.astype(np.float32)
            hits, many = [], 0

            def enter():
                nonlocal many
                if many:
                    r, c = (np.concatenate(x) for x in zip(*hits))
                    value = np.einsum("ij,ij->i", user[r], item[c])
                    keep = value >= scores[r, -1]
                    merge(ids, scores, r[keep], item_id[c[keep]], value[keep])
                hits.clear()
                many = 0

            for a in range(0, len(item), span):
                own = slice(a, a + span)
                most = norm[own].max()
                rows = np.flatnonzero(length * most + room * (1 + most) >= scores[:, -1])
                if not len(rows):
                    break  # later blocks have smaller norms
                cols = None
                if few:
                    part = user[rows, :head] @ item[own, :head].T
                    may = part + np.outer(left[rows], rest[own]) >= (
                        scores[rows, -1] - room[rows] * (1 + most))[:, None]
                    if 8 * np.count_nonzero(may) < may.size:  # one by one
                        r, c = np.nonzero(may)
                        work[rows] += np.bincount(r, minlength=len(rows))
                        hits.append((rows[r], c + a))
                        many += len(r)
                    else:
                        cols = np.flatnonzero(may.any(axis=0))
                else:
                    cols = np.arange(min(span, len(item) - a))
                if cols is not None:
                    work[rows] += len(cols)
                    picked = single[own] if len(cols) == len(single[own]) else single[own][cols]
                    product = picked @ (narrow if len(rows) == len(narrow) else narrow[rows]).T
                    wide = off * length[rows] * most + room[rows] * (1 + most)
                    cut = scores[rows, -1]
                    if len(cols) > n and np.isneginf(cut).any():
                        cut = np.maximum(cut, np.partition(product, -n, axis=0)[-n] - wide)
                    # Rounded down, so that the comparison in single precision keeps all.
                    least = np.nextafter((cut - wide).astype(np.float32), np.float32(-np.inf))
                    r, c = reached(product, least)
                    hits.append((rows[r], cols[c] + a))
                    many += len(r)
                if many >= len(user) * n or np.isneginf(scores[rows, -1]).any():
                    enter()  # shorter lists of open products would bound nothing
            enter()
        return found

    def everything(item_id, item) -> Callable:
        """All products of one chunk in single precision, without bounds."""
        item = item.astype(np.float32)

        def found(user, ids, scores, work):
            user = user.astype(np.float32)
            hits, many = [], 0
            for a in range(0, len(item), block):
                product = item[a:a + block] @ user.T
                work += len(product)
                least = scores[:, -1].astype(np.float32)
                short = np.isneginf(least).any()
                if len(product) > n and short:
                    least = np.maximum(least, np.partition(product, -n, axis=0)[-n])
                r, c = reached(product, least)
                hits.append((r, item_id[a + c], product[c, r].astype(np.float64)))
                many += len(r)
                if short or many >= len(user) * n or a + block >= len(item):
                    merge(ids, scores, *(np.concatenate(x) for x in zip(*hits)))
                    hits, many = [], 0
        return found

    def run(batches: Iterator) -> Iterator:
        item_id, item, axes = shared.value
        item = item.astype(np.float64) @ axes
        found = (everything if head is None else bounded)(item_id, item)
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                user = part["features"].flatten().to_numpy(zero_copy_only=False) \
                    .astype(np.float64).reshape(part.num_rows, len(axes)) @ axes
                ids, scores = lists(part)
                work = part["work"].to_numpy(zero_copy_only=False).copy()
                if len(item):
                    found(user, ids, scores, work)
                kept = np.isfinite(scores)
                ends = np.concatenate([[0], np.cumsum(kept.sum(axis=1))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part["id"], part["norm"], part["features"],
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(
                         ids[kept].astype(np.int32))),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(scores[kept])),
                     pa.array(work)],
                    names=["id", "norm", "features", "ids", "scores", "work"])
    return run


def top_products(users: DataFrame, items: DataFrame, n: int,
                 chunk: int = CHUNK, block: int = BLOCK, head: int | None = None,
                 step: int = STEP, every: bool = False) -> DataFrame:
    """(id, ids, scores, work) of ``users`` (id, features) against ``items``
    (id, features): up to ``n`` items by product descending, then item id;
    ``work`` counts the products that were multiplied out; ``head`` sets the
    number of first axes. ``every`` multiplies out all pairs, in single
    precision and without bounds: what the search is held against."""
    import numpy as np

    spark = users.sparkSession
    first = items.select(F.size("features").alias("k")).first()
    length = F.sqrt(F.aggregate("features", F.lit(0.0),
                                lambda total, x: total + x.cast("double") * x))
    state = users.select(
        F.col("id").cast("int").alias("id"), length.alias("norm"), "features",
        F.array().cast("array<int>").alias("ids"), F.array().cast("array<double>").alias("scores"),
        F.lit(0).cast("long").alias("work"))
    if first is None:
        return state.select(*_FOUND)
    root = work_root(spark, "scratch", unique_name("products"))

    def keep(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{root}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{root}/{name}")

    axes, carrying = (np.eye(first["k"]), None) if every else _axes(items, first["k"])
    if head is not None and not every:
        carrying = min(head, first["k"])
    ordered = keep(global_row_number(
        items.select(F.col("id").cast("int").alias("id"), length.alias("norm"), "features")
        .withColumn("_down", -F.col("norm")), ["_down", "id"], "place").drop("_down"), "items")
    chunks = ordered.withColumn("chunk", F.floor((F.col("place") - 1) / chunk).cast("int"))
    last = chunks.agg(F.max("chunk")).first()[0]
    done = []
    for c in range(last + 1):
        own = chunks.filter(F.col("chunk") == c).orderBy("place").toArrow()
        item = own["features"].combine_chunks().flatten().to_numpy(zero_copy_only=False) \
            .astype(np.float32).reshape(len(own), len(axes))
        shared = spark.sparkContext.broadcast(
            (own["id"].to_numpy().astype(np.int64), item, axes))
        state = state.mapInArrow(_search(shared, n, carrying, block, step), _STATE)
        if c == last:
            break
        state = keep(state, f"state-{c}")
        shared.destroy()
        if c:
            delete(spark, f"{root}/state-{c - 1}")
        if every:
            continue
        # Whoever holds n products above the next chunk's bound is done.
        after = chunks.filter(F.col("chunk") == c + 1).agg(F.max("norm")).first()[0]
        open_ = (F.size("ids") < n) | (
            F.col("norm") * after * (1 + 1e-9) + 1e-9 >= F.element_at("scores", -1))
        if not state.filter(~open_).isEmpty():
            done.append(keep(state.filter(~open_).select(*_FOUND), f"done-{c}"))
            state = state.filter(open_)
    state = state.select(*_FOUND)
    for frame in done:
        state = state.unionByName(frame)
    return state
