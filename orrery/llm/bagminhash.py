"""MinHash near-duplicates: BagMinHash over five-word shingle multisets.

A text is the multiset of its lower-cased five-word shingles (a text of one
to four words: one shingle of them all), similarity is the weighted Jaccard
index (sum of minima over sum of maxima of the counts).

*Signatures.* Weights are discretised to the integers, in dyadic blocks
(0,1], (1,2], (2,4], (4,8]...; every (shingle, block) owns a Poisson process
of points whose rate is the block's width. Blocks below a shingle's count
are taken whole; in the block that holds the count each point carries a level
(its binary splits) and only levels up to the count are taken. A point falls
on one signature component; a component keeps its earliest point, so two
texts agree on it with probability equal to their weighted Jaccard index.
Points are made in time order and only until they come after every
component's best: a few per shingle.

*Bands.* ROWS components form a band, texts with an equal band share a bucket.

*Links.* Equal multisets are one node from the start, so groups of copies
never meet as pairs. In each bucket all nodes are compared with its hub only,
the node that shares most (a star). Where the others are of several classes
afterwards, members of different classes are compared in blocks of BLOCK
nodes, and a link is kept for each two classes; a large bucket is many block
pairs, each a group of its own. So each two nodes of a bucket are compared or
in one class already, and no group is expanded into pairs of rows. Every
comparison is the exact multiset overlap. Classes are the connected
components of the links.

Defined results: a text without words (null, empty, blank) is in no group;
repeated rows and null ids are documents like others and share a class by
their text; long texts are processed whole; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import chunks, code_points, mix, passing, scratch, ship, written
from orrery.llm.graph import components
from orrery.llm.hashing import BASE, GOLD, Powers, stretch_hashes, words

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 42
ROWS = 6
#: Nodes of a block: what is left of a bucket is compared block by block.
BLOCK = 256

_U = np.uint64
_TIME = _U(32)
_NEVER = _U(0x7F800000) << _TIME


def word_hashes(points: np.ndarray, starts: np.ndarray,
                powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words, in order, and each text's first word (one
    more entry: the number of words)."""
    begin, end = words(points)
    return stretch_hashes(points, begin, end, powers), np.searchsorted(begin, starts)


def shingle_bags(texts: list[str], powers: Powers
                 ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, 48-bit shingle hash, count) of all texts' multisets, ordered by
    text and hash. At most 65,536 texts."""
    points, starts = code_points([t.lower() for t in texts])
    hashed, first = word_hashes(points, starts, powers)
    n_words = np.diff(first)
    keys = []
    if len(hashed) >= SHINGLE:
        rolled = np.zeros(len(hashed) - SHINGLE + 1, dtype=np.uint64)
        for k in range(SHINGLE):
            rolled += hashed[k:len(hashed) - SHINGLE + 1 + k] * _U(BASE * (2 * k + 1) & (1 << 64) - 1)
        text = np.repeat(np.arange(len(texts)), n_words)[:len(rolled)]
        inside = np.arange(len(rolled)) + SHINGLE <= first[text + 1]
        keys.append((text[inside].astype(np.uint64) << _U(48)) | (mix(rolled[inside]) >> _U(16)))
    short = np.flatnonzero((n_words > 0) & (n_words < SHINGLE))
    if len(short):
        whole = np.zeros(len(short), dtype=np.uint64)
        for k in range(SHINGLE - 1):
            has = n_words[short] > k
            whole[has] = mix(whole[has] + hashed[first[short][has] + k] + _U(k))
        keys.append((short.astype(np.uint64) << _U(48)) | (mix(whole) >> _U(16)))
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    unique, count = np.unique(np.concatenate(keys), return_counts=True)
    return (unique >> _U(48)).astype(np.int64), unique & _U((1 << 48) - 1), count


def signatures(text: np.ndarray, shingle: np.ndarray, count: np.ndarray, n: int,
               m: int) -> np.ndarray:
    """BagMinHash signatures (n x m 32-bit point ids) of the multisets."""
    blocks = np.ceil(np.log2(np.maximum(count, 1))).astype(np.int64) + 1
    own = np.repeat(np.arange(len(count)), blocks)
    level = np.arange(len(own)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    doc, weight = text[own], count[own]
    low = np.where(level > 0, np.int64(1) << np.maximum(level - 1, 0), 0)
    width = np.maximum(low, 1)
    seed = mix(shingle[own] + level.astype(np.uint64) * _U(0xD6E8FEB86659FD93))
    at = np.zeros(len(own), dtype=np.float64)
    best = np.full(n * m, _NEVER, dtype=np.uint64)
    step, turn = 1, 0
    while len(doc):
        turns = np.arange(turn, turn + step, dtype=np.uint64)
        draw = mix(seed[:, None] + (turns * GOLD)[None, :])
        ident = draw & _U(0xFFFFFFFF)
        wait = -np.log(((draw >> _U(32)).astype(np.float64) + 0.5) / 2.0 ** 32)
        when = at[:, None] + np.cumsum(wait / width[:, None], axis=1)
        more = mix(draw ^ GOLD)
        part = (more >> _U(32)) * _U(m) >> _U(32)
        mark = low[:, None] + 1 + ((more & _U(0xFFFFFFFF)) * width.astype(np.uint64)[:, None]
                                   >> _U(32)).astype(np.int64)
        value = (when.astype(np.float32).view(np.uint32).astype(np.uint64) << _TIME) | ident
        cell = doc[:, None] * m + part.astype(np.int64)
        taken = mark <= weight[:, None]
        np.minimum.at(best, cell[taken], value[taken])
        at = when[:, -1]
        turn += step
        # Later points of a process cannot win once they come after the worst
        # component of its text.
        live = np.unique(doc)
        worst = np.zeros(n, dtype=np.float32)
        worst[live] = (best.reshape(n, m)[live].max(axis=1) >> _TIME).astype(np.uint32) \
            .view(np.float32)
        go = at.astype(np.float32) <= worst[doc]
        doc, weight, low, width, seed, at = (x[go] for x in (doc, weight, low, width, seed, at))
        step = 1 if turn < 4 else 4 if turn < 20 else 16
    return (best & _U(0xFFFFFFFF)).astype(np.uint32).reshape(n, m)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band, different between bands."""
    part = signature.reshape(len(signature), bands, rows).astype(np.uint64)
    key = np.repeat(np.arange(bands, dtype=np.uint64)[None, :], len(signature), axis=0)
    for k in range(rows):
        key = mix(key * GOLD + part[:, :, k] + _U(1))
    return key.view(np.int64)


def _node_ids(text: np.ndarray, shingle: np.ndarray, count: np.ndarray, n: int) -> list:
    """128-bit ids of the multisets; None for an empty one."""
    sums = []
    for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
        total = np.zeros(n, dtype=np.uint64)
        np.add.at(total, text, mix(shingle ^ _U(salt)) * (count.astype(np.uint64) * _U(2) + _U(1)))
        sums.append(total)
    raw = np.stack(sums, axis=1).astype(">u8").tobytes()
    some = np.bincount(text, minlength=n) > 0
    return [raw[16 * i:16 * i + 16] if some[i] else None for i in range(n)]


def _texts(column: pa.Array) -> list[str]:
    return ["" if t is None else t for t in column.to_pylist()]


def _sign(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            texts = _texts(batch["text"])
            for a, b in chunks(texts):
                n = b - a
                bag = shingle_bags(texts[a:b], powers)
                keys = band_keys(signatures(*bag, n, bands * rows), bands, rows)
                node = _node_ids(*bag, n)
                blank = np.array([x is None for x in node])
                yield pa.RecordBatch.from_arrays([
                    batch["doc_id"].slice(a, n), batch["text_hash"].slice(a, n),
                    pa.array(node, pa.binary()),
                    pa.ListArray.from_arrays(
                        pa.array(np.concatenate([[0], np.cumsum(np.where(blank, 0, bands))]),
                                 pa.int32()),
                        pa.array(keys[~blank].ravel(), pa.int64()))],
                    names=["doc_id", "text_hash", "node", "bands"])
    return run


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, bag): sorted 48-bit hashes (6 bytes each), then 4-byte counts."""
    powers = Powers()
    for batch in batches:
        texts = _texts(batch["text"])
        for a, b in chunks(texts):
            text, shingle, count = shingle_bags(texts[a:b], powers)
            cut = np.searchsorted(text, np.arange(b - a + 1))
            six = np.ascontiguousarray(shingle).view(np.uint8).reshape(-1, 8)[:, :6]
            four = np.minimum(count, 2 ** 32 - 1).astype("<u4")
            yield pa.RecordBatch.from_arrays(
                [batch["node"].slice(a, b - a),
                 pa.array([six[i:j].tobytes() + four[i:j].tobytes()
                           for i, j in zip(cut[:-1], cut[1:])], pa.binary())],
                names=["node", "bag"])


def _unpack(bag: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(bag) // 10
    wide = np.zeros((n, 8), dtype=np.uint8)
    wide[:, :6] = np.frombuffer(bag, dtype=np.uint8, count=6 * n).reshape(n, 6)
    return wide.view("<u8").ravel(), np.frombuffer(bag, dtype="<u4", offset=6 * n).astype(np.int64)


def overlap(a: bytes, b: bytes) -> float:
    """Weighted Jaccard index of two packed multisets."""
    (x, p), (y, q) = _unpack(a), _unpack(b)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    both = int(np.minimum(p[i], q[j]).sum())
    return both / max(1, int(p.sum()) + int(q.sum()) - both)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        score = [overlap(a.as_py(), b.as_py()) for a, b in zip(batch["bag_u"], batch["bag_v"])]
        yield pa.RecordBatch.from_arrays([batch["u"], batch["v"], pa.array(score, pa.float64())],
                                         names=["u", "v", "similarity"])


def overlaps(bags: list[bytes]) -> np.ndarray:
    """Weighted Jaccard indices of all pairs of a few packed multisets."""
    own, keys, often_held = [], [], []
    for i, bag in enumerate(bags):
        shingle, count = _unpack(bag)
        if len(count) and count.max() > 1 << 16:  # a copy's number has 16 bits here
            often_held.append(i)
            shingle, count = shingle[:0], count[:0]
        copy = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        keys.append(np.repeat(shingle, count) | (copy.astype(np.uint64) << _U(48)))
        own.append(np.full(len(keys[-1]), i))
    size = np.array([len(k) for k in keys], dtype=np.float64)
    which, own = np.concatenate(keys), np.concatenate(own)
    _, column, often = np.unique(which, return_inverse=True, return_counts=True)
    shared = often[column] > 1
    column, own = column[shared], own[shared]
    both = np.zeros((len(bags), len(bags)))
    if len(column):
        _, column = np.unique(column, return_inverse=True)
        order = np.argsort(column, kind="stable")
        column, own = column[order], own[order]
        for low in range(0, int(column[-1]) + 1, 4096):
            a, b = np.searchsorted(column, [low, low + 4096])
            has = np.zeros((len(bags), 4096), dtype=np.float32)
            has[own[a:b], column[a:b] - low] = 1
            both += has @ has.T
    out = both / np.maximum(size[:, None] + size[None, :] - both, 1)
    for i in often_held:
        out[i] = out[:, i] = [overlap(bags[i], bag) for bag in bags]
    return out


def _compare(threshold: float):
    """The members of two blocks of a bucket: one link for each two classes
    that have similar members there."""
    def run(key: tuple, members: pa.Table) -> pa.Table:
        i, j = key[1].as_py(), key[2].as_py()
        block = members["block"].to_numpy()
        node, label = members["node"].to_pylist(), members["label"].to_pylist()
        score = overlaps(members["bag"].to_pylist())
        _, kind = np.unique(np.array(label, dtype=object), return_inverse=True)
        apart = kind[:, None] < kind[None, :]
        if i != j:
            apart &= block[:, None] != block[None, :]
        x, y = np.nonzero(apart & (score >= threshold))
        _, first = np.unique(kind[x] * (len(node) + 1) + kind[y], return_index=True)
        x, y = x[first], y[first]
        return pa.table({"u": pa.array([node[k] for k in x], pa.binary()),
                         "v": pa.array([node[k] for k in y], pa.binary()),
                         "similarity": pa.array(score[x, y], pa.float64())})
    return run


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS,
                    rows: int = ROWS) -> tuple[DataFrame, DataFrame]:
    """(members, links) of ``docs`` (doc_id, text).

    ``members``: doc_id, text_hash, node, class (null: no words) per row;
    ``links``: u, v, similarity, the verified pairs of nodes."""
    spark = docs.sparkSession
    ship(spark)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    signed = written(keyed.mapInArrow(
        _sign(bands, rows),
        f"doc_id {id_type}, text_hash bigint, node binary, bands array<bigint>"), "signed")
    nodes = signed.filter("node is not null").groupBy("node").agg(
        F.first("bands").alias("bands"), F.min(F.struct("doc_id", "text_hash")).alias("doc"))
    pairs = nodes.select("node", F.explode("bands").alias("bucket"))
    full = pairs.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = written(pairs.join(full, "bucket").select("bucket", "node", "n"), "buckets")

    # The packed multisets of all nodes that share a bucket.
    wanted = shared.select("node").distinct().join(nodes, "node").select(
        "node", F.col("doc.doc_id").alias("id"), F.col("doc.text_hash").alias("hash"))
    held = keyed.join(wanted, F.col("doc_id").eqNullSafe(F.col("id"))
                      & (F.col("text_hash") == F.col("hash"))).select("node", "text")
    bags = written(held.mapInArrow(_bags, "node binary, bag binary")
                   .groupBy("node").agg(F.first("bag").alias("bag")), "bags")
    links = _link(shared, bags, threshold)
    labels = components(links)
    members = signed.select("doc_id", "text_hash", "node").join(labels, "node", "left") \
        .select("doc_id", "text_hash", "node", F.coalesce("label", "node").alias("class"))
    return members, links


def _link(shared: DataFrame, bags: DataFrame, threshold: float) -> DataFrame:
    """Verified links (u, v, similarity) that join all similar nodes of each
    bucket of ``shared`` (bucket, node, n) into one class."""
    # Stars: the hub of a bucket is the node that shares most buckets most
    # widely, the middle of its group.
    weight = shared.groupBy("node").agg(F.sum("n").alias("weight"))
    hubs = written(shared.join(weight, "node").groupBy("bucket").agg(
        F.max(F.struct("weight", "node")).alias("top"))
        .select("bucket", F.col("top.node").alias("hub")), "hubs")
    others = shared.select("bucket", "node").join(hubs, "bucket").filter("node != hub")
    bag_u = bags.select(F.col("node").alias("u"), F.col("bag").alias("bag_u"))
    bag_v = bags.select(F.col("node").alias("v"), F.col("bag").alias("bag_v"))
    asked = others.select(F.col("hub").alias("u"), F.col("node").alias("v")).distinct()
    stars = written(asked.join(bag_u, "u").join(bag_v, "v").mapInArrow(
        _verify, "u binary, v binary, similarity double")
        .filter(F.col("similarity") >= threshold), "stars_verified")

    # The rest: buckets whose other members are still of several classes. Two
    # members of the hub's class need no comparison, so blocks of them meet
    # only blocks of other members.
    labels = components(stars)
    left = others.join(labels, "node", "left").join(
        labels.select(F.col("node").alias("hub"), F.col("label").alias("hub_label")),
        "hub", "left").select(
        "bucket", "node", F.coalesce("label", "node").alias("label"),
        (F.coalesce("label", "node") != F.coalesce("hub_label", "hub")).alias("apart"))
    mixed = left.groupBy("bucket").agg(
        F.min("label").alias("lo"), F.max("label").alias("hi"),
        F.ceil(F.count_if("apart") / BLOCK).cast("int").alias("a"),
        F.ceil(F.count_if(~F.col("apart")) / BLOCK).cast("int").alias("b")) \
        .filter("lo != hi").select("bucket", "a", "b")
    spread = F.xxhash64("node")
    placed = left.join(mixed, "bucket").select(
        "bucket", "node", "label",
        F.when(F.col("apart"), F.pmod(spread, F.col("a")))
        .otherwise(F.col("a") + F.pmod(spread, F.greatest("b", F.lit(1)))).cast("int")
        .alias("block"),
        F.explode(F.sequence(F.lit(0), F.when(F.col("apart"), F.col("a") + F.col("b") - 1)
                             .otherwise(F.col("a") - 1))).alias("other"))
    groups = placed.select("bucket", F.least("block", "other").alias("i"),
                           F.greatest("block", "other").alias("j"), "block", "node", "label") \
        .join(bags, "node")
    rest = written(groups.groupBy("bucket", "i", "j").applyInArrow(
        _compare(threshold), "u binary, v binary, similarity double"), "rest_verified")
    return stars.unionByName(rest)


def classes(docs: DataFrame, **params) -> DataFrame:
    """doc_id, class_id (least doc_id of the class, nulls last) and class_size
    (rows) per row. A text without words is a class of its own."""
    members, _ = near_duplicates(docs.select("doc_id", "text"), **params)
    # A written table, not an aggregate, stands on the small side of the join:
    # so adaptive execution can split the rows of a large class.
    sizes = written(members.filter("class is not null").groupBy("class").agg(
        F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size")), "sizes")
    return members.join(sizes, "class", "left").select(
        "doc_id",
        F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
        .alias("class_id"),
        F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"))


def deduplicate(docs: DataFrame, **params) -> DataFrame:
    """One row of each class, that with the least (doc_id, text hash), nulls
    last; exactly one of rows repeated in full. Rows without words all stay.
    Columns as given."""
    spark = docs.sparkSession
    with passing(spark):  # the marks are all that is read afterwards
        members, _ = near_duplicates(docs.select("doc_id", "text"), **params)
        known = members.filter("class is not null").groupBy("class", "doc_id", "text_hash").agg(
            F.count(F.lit(1)).alias("n"))
        least = written(known.groupBy("class").agg(F.min(F.struct(
            F.col("doc_id").isNull().alias("null"), "doc_id", "text_hash")).alias("least")),
            "least")
        stays = F.col("doc_id").eqNullSafe(F.col("least.doc_id")) \
            & (F.col("text_hash") == F.col("least.text_hash"))
        # Only rows that go, and rows that stay but are there several times,
        # are looked up.
        marks = written(known.join(least, "class").filter(~stays | (F.col("n") > 1)).select(
            F.col("doc_id").alias("mark_id"), F.col("text_hash").alias("mark_hash"),
            stays.alias("stays")), "marks", scratch(spark, "marks"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"))
    marked = rows.join(marks, F.col("id").eqNullSafe(F.col("mark_id"))
                       & (F.col("hash") == F.col("mark_hash")), "left")
    once = marked.filter(F.col("stays").isNull()).select("row.*")
    repeated = marked.filter("stays").groupBy("id", "hash").agg(F.first("row").alias("row"))
    return once.unionByName(repeated.select("row.*"))
