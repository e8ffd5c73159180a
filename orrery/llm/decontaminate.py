"""Benchmark decontamination: q-gram lemma filter and banded alignment.

Benchmark texts and documents are compared as lower-cased code points, any
white space counting as a space. A benchmark text longer than SEGMENT is cut
into overlapping segments, and any text longer than PASSAGE also into passages
of PASSAGE characters, one every STRIDE characters and one at the end. A
segment or passage of m characters matches a region of a document if at most
k = floor(EDIT_RATE * m) edits turn one into the other. So every verbatim quote
of PASSAGE + STRIDE - 1 characters holds a whole passage and is found, wherever
it starts.

*Filter.* Such a region shares at least t = m + 1 - q (k + 1) q-grams with
the segment (the q-gram lemma; q is at most Q, and so small that t >= 1), and
their diagonals (document position minus
segment position) lie within k + 1 neighbours. Hits are counted in bands of
2 (k + 1) diagonals that overlap by half, so one band holds them all; bands
with t hits or more are kept. Nothing that matches is lost.

*Verification.* Kept bands are aligned exactly (free ends in the document)
within the band's diagonals and k more on each side.

The benchmark's index is broadcast in blocks of at most BLOCK_CHARS
characters; a larger benchmark takes one pass over the documents per block.
Documents are never shuffled: each row is judged where it is.

Defined results: a null or empty document matches nothing; a benchmark text
that is null or shorter than MIN_CHARS is no evidence and is left out; of
equal best matches of one (row, item) the leftmost is told, and a passage only
if no segment of the item matches; repeated rows are judged one by one; long
texts are processed whole, in memory that follows their length even where one
character repeats (time follows length times equal q-grams of the benchmark).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.llm.common import chunks, code_points, ship

Q = 8
EDIT_RATE = 0.1
SEGMENT = 200
PASSAGE = 60
STRIDE = 20
MIN_CHARS = 24
BLOCK_CHARS = 8 << 20
#: Hits that are expanded at once (about 100 bytes each).
SLICE_HITS = 1 << 20

_FILTER_BITS = 22
_BASE_INT = 0x9E3779B97F4A7C15


def normal(text: str) -> str:
    low = text.lower()
    if len(low) != len(text):  # keep one code point for one
        low = "".join(c if len(d := c.lower()) != 1 else d for c in text)
    return low


def _points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    points, starts = code_points([normal(t) for t in texts])
    blank = (points >= 9) & (points <= 13)
    return np.where(blank, np.uint32(32), points), starts


def grams(points: np.ndarray, q: int) -> np.ndarray:
    """Hashes of all q-grams, by position; built from halves."""
    if len(points) < q:
        return np.zeros(0, dtype=np.uint64)

    def rolled(n: int) -> np.ndarray:
        if n == 1:
            return points.astype(np.uint64)
        left = rolled(n // 2)
        right = left if n % 2 == 0 else rolled(n - n // 2)
        ahead = right[n // 2:]
        return left[:len(ahead)] * np.uint64(pow(_BASE_INT, n - n // 2, 1 << 64)) + ahead

    return rolled(q) * np.uint64(_BASE_INT)


def _cuts(length: int, size: int, stride: int) -> list[int]:
    """Starts of pieces of ``size``, the last one at the end."""
    return [*range(0, max(length - size, 0), stride), max(length - size, 0)]


class _Grams:
    """The q-grams of some segments, for one q: where each occurs."""

    def __init__(self, q: int, own: np.ndarray, segments: list[np.ndarray]) -> None:
        self.q = q
        found = [grams(segments[s], q) for s in own]
        gram = np.concatenate(found)
        order = np.argsort(gram, kind="stable")
        self.seg = np.repeat(own.astype(np.int32), [len(f) for f in found])[order]
        self.off = np.concatenate([np.arange(len(f), dtype=np.int32) for f in found])[order]
        self.gram, first, self.count = np.unique(gram[order], return_index=True,
                                                 return_counts=True)
        self.first = first.astype(np.int64)
        self.bits = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self.bits[self.gram >> np.uint64(64 - _FILTER_BITS)] = True


class Index:
    """Segments and passages of benchmark texts and their q-grams. Without
    ``passage`` there are segments only."""

    def __init__(self, items: list[tuple], q: int = Q, rate: float = EDIT_RATE,
                 segment: int = SEGMENT, min_chars: int = MIN_CHARS,
                 passage: int | None = None, stride: int = STRIDE) -> None:
        self.items, self.segments, part = [], [], []
        for item, text in items:
            points = _points([text or ""])[0][:-1]
            if len(points) < max(min_chars, 1):
                continue
            cuts = [(at, segment) for at in _cuts(len(points), segment, segment // 2)]
            if passage and len(points) > passage:
                cuts += [(at, passage) for at in _cuts(len(points), passage, stride)]
            for at, size in cuts:
                self.items.append(item)
                self.segments.append(points[at:at + size])
                part.append(size != segment)
        self.part = np.array(part, dtype=bool)
        self.length = np.array([len(s) for s in self.segments], dtype=np.int64)
        self.edits = np.array([int(n * rate) for n in self.length], dtype=np.int64)
        # The lemma needs t >= 1: a short segment may take a smaller q for it.
        size = np.clip(self.length // (self.edits + 1), 1, q)
        self.needed = np.maximum(self.length + 1 - size * (self.edits + 1), 1)
        self.grams = [_Grams(int(n), np.flatnonzero(size == n), self.segments)
                      for n in np.unique(size)]

    def bands(self, points: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(segment, band) pairs with enough hits; a band's first diagonal is
        band * (edits + 1) - longest segment, from the start of ``points``."""
        found = [self._bands_of(g, points) for g in self.grams]
        return (np.concatenate([np.zeros(0, np.int64), *(f[0] for f in found)]),
                np.concatenate([np.zeros(0, np.int64), *(f[1] for f in found)]))

    def _bands_of(self, known: _Grams, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashed = grams(points, known.q)
        at = np.flatnonzero(known.bits[(hashed >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        if not len(at):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        which = np.minimum(np.searchsorted(known.gram, hashed[at]), len(known.gram) - 1)
        same = known.gram[which] == hashed[at]
        at, which = at[same], which[same]
        count = known.count[which]
        ends = np.cumsum(count)
        span = np.int64(len(points) + 2 * int(self.length.max()) + 2)
        keys = hits = np.zeros(0, dtype=np.int64)
        # A repeated q-gram has very many hits: they are counted in slices.
        for low in range(0, int(ends[-1]) if len(ends) else 0, SLICE_HITS):
            hit = np.arange(low, min(low + SLICE_HITS, int(ends[-1])))
            own = np.searchsorted(ends, hit, side="right")
            post = hit - (ends - count)[own] + known.first[which][own]
            seg = known.seg[post].astype(np.int64)
            diagonal = at[own] - known.off[post] + int(self.length.max())
            key, n = np.unique(seg * span + diagonal // (self.edits[seg] + 1),
                               return_counts=True)
            if low:
                key, index = np.unique(np.concatenate([keys, key]), return_inverse=True)
                n = np.bincount(index, np.concatenate([hits, n]), len(key)).astype(np.int64)
            keys, hits = key, n
        if not len(keys):
            return keys, hits
        # Band b has its own hits and those of the next half.
        follows = np.searchsorted(keys, keys + 1)
        follows[follows == len(keys)] = 0
        after = np.where(keys[follows] == keys + 1, hits[follows], 0)
        alone = ~np.isin(keys - 1, keys, assume_unique=True) & (keys % span > 0)
        keys, hits = (np.concatenate([keys, keys[alone] - 1]),
                      np.concatenate([hits + after, hits[alone]]))
        enough = hits >= self.needed[keys // span]
        return keys[enough] // span, keys[enough] % span

    def verify(self, points: np.ndarray, starts: np.ndarray, seg: np.ndarray,
               band: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(text, segment, edits, end in the text) of bands that match."""
        found = []
        order = np.argsort(self.length[seg], kind="stable")  # like lengths together
        seg, band = seg[order], band[order]
        for part in range(0, len(seg), 1024):
            found += self._align(points, starts, seg[part:part + 1024], band[part:part + 1024])
        return found

    def _align(self, points, starts, seg, band) -> list[tuple[int, int, int, int]]:
        m, k = self.length[seg], self.edits[seg]
        rows, width = int(m.max()), int(4 * k.max() + 2)
        # Costs stay under rows + width; a longer segment than usual takes wider numbers.
        small = np.int16 if rows + width < 1 << 13 else np.int32
        low = band * (k + 1) - int(self.length.max()) - k  # first diagonal
        # A band lies in the text that holds the middle of its region; other
        # texts and the separators match no character.
        middle = np.clip(low + 2 * k + m // 2, 0, len(points) - 1)
        text = np.searchsorted(starts, middle, side="right") - 1
        begin, end = starts[text], starts[text + 1] - 1
        # One column per band: each step runs over all of them at once.
        i = np.arange(width + rows)[:, None] + low[None, :]
        region = np.where((i >= begin) & (i < end), points[np.clip(i, 0, len(points) - 1)],
                          np.uint32(0xFFFFFFFF))
        pattern = np.full((rows, len(seg)), 0xFFFFFFFE, dtype=np.uint32)
        for x, own in enumerate(seg):
            pattern[:m[x], x] = self.segments[own]
        column = np.arange(width, dtype=small)[:, None]
        far = np.iinfo(small).max // 2
        shifts = [1 << x for x in range((width - 1).bit_length())]
        cost = np.zeros((width + 1, len(seg)), dtype=small)
        cost[width] = far
        last = np.full((width, len(seg)), far, dtype=small)
        for j in range(rows):
            step = cost[:width] + (region[j:j + width] != pattern[j])
            np.minimum(step, cost[1:] + small(1), out=step)
            step -= column
            for ahead in shifts:  # the running minimum, in doubling steps
                np.minimum(step[ahead:], step[:-ahead], out=step[ahead:])
            step += column
            cost[:width] = step
            done = m == j + 1
            if done.any():
                last[:, done] = step[:, done]
        i = column + (low + m)[None, :]
        last = np.where((i > begin) & (i <= end), last, far)
        best = last.argmin(axis=0)
        edits = last[best, np.arange(len(seg))]
        return [(int(text[x]), int(seg[x]), int(edits[x]),
                 int(low[x] + best[x] + m[x] - begin[x])) for x in np.flatnonzero(edits <= k)]

    def search(self, texts: list[str]) -> Iterator[list[tuple]]:
        """Per text: (item, edits, end), the best of each item, by position."""
        for a, b in chunks(texts):
            points, starts = _points(texts[a:b])
            best: list[dict] = [{} for _ in range(b - a)]
            for text, seg, edits, end in self.verify(points, starts, *self.bands(points, starts)):
                item, own = self.items[seg], (bool(self.part[seg]), edits, end)
                best[text][item] = min(best[text].get(item, own), own)
            for own in best:
                yield sorted(((i, *x[1:]) for i, x in own.items()), key=lambda x: (x[2], x[1]))


def _blocks(benchmark: DataFrame, limit: int) -> Iterator[list[tuple]]:
    block, size = [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        if block and size + len(row.text or "") > limit:
            yield block
            block, size = [], 0
        block.append((row.item_id, row.text))
        size += len(row.text or "")
    if block:
        yield block


def find_matches(docs: DataFrame, benchmark: DataFrame, text: str = "text",
                 block_chars: int = BLOCK_CHARS, passage: int | None = PASSAGE,
                 **params) -> DataFrame:
    """(row: the input row, matches: array of (item_id, edits, end))."""
    spark = docs.sparkSession
    ship(spark)
    item = benchmark.schema["item_id"].dataType
    schema = T.StructType([
        T.StructField("row", docs.schema),
        T.StructField("matches", T.ArrayType(T.StructType([
            T.StructField("item_id", item), T.StructField("edits", T.IntegerType()),
            T.StructField("end", T.LongType())])))])
    at = docs.columns.index(text)
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                      F.lit(None).cast(schema["matches"].dataType).alias("matches"))
    for block in _blocks(benchmark, block_chars):
        index = spark.sparkContext.broadcast(Index(block, passage=passage, **params))

        def run(batches, index=index):
            for batch in batches:
                texts = [t or "" for t in batch["row"].field(at).to_pylist()]
                before = batch["matches"].to_pylist()
                found = [[*(p or ()), *({"item_id": i, "edits": e, "end": z} for i, e, z in own)]
                         for p, own in zip(before, index.value.search(texts))]
                yield pa.RecordBatch.from_arrays(
                    [batch["row"], pa.array(found, batch.schema.field("matches").type)],
                    names=["row", "matches"])

        out = out.mapInArrow(run, schema)
    return out.select("row", F.coalesce("matches", F.array().cast(schema["matches"].dataType))
                      .alias("matches"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """The documents without a match; columns as given."""
    return find_matches(docs, benchmark, **params).filter(F.size("matches") == 0).select("row.*")
