"""Collocations: phrases counted by double-array tries.

*Words.* One pass cuts the texts, counts the words of each language exactly
and writes the texts' words as 64-bit hashes of (language, word), in short
rows that end with a piece: what readers hold of them at once is bounded. All
words of the corpus are then checked to have different hashes, else the pass
is repeated with another salt: from here a hash is the word.

*Candidates.* A phrase is frequent only if the phrases it holds are. Pairs of
frequent words are counted into BUCKETS buckets by hash, then triples whose
two pairs lie in frequent buckets; bitmaps of the frequent words' and buckets'
bits are broadcast (8 MB each at any corpus size). A bucket's sum bounds the
counts of its phrases from above, so what is left out cannot be frequent. The
phrases in frequent buckets are the candidates; the longest at each text
position, with how often it is found there, are summed, written and dealt by
their first two words to blocks of about BLOCK.

*Counting.* A block's candidates, which are what its rows begin with, become a
double-array trie over words. The states of all rows advance at once, a level
at a time, and each adds its occurrences to the accepting states that it
passes. A block is one task's work: no trie is broadcast, and the hashes are
read once however many blocks there are.

*Score.* The parts' counts are joined to each phrase. Products are decimals of
38 digits, exact for counts below 10^16; a greater count fails.

Defined results: null texts are empty; a null language is ``und``; repeated
rows count each time; phrases never cross a piece's end; a text is handled
whole; an empty table gives no rows; other columns are not read. Equal scores
and counts go by the phrase's bytes.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.llm.common import chunks, mix, scratch, ship, written

UNKNOWN = "und"
MAX_WORDS = 3
MIN_COUNT = 10
TOP = 2000
COVERED_PERCENT = 50
BUCKETS = 1 << 26
#: Phrases of a block: its trie, while it is built, takes about 400 bytes for each.
BLOCK = 1 << 17
#: Entries that a task holds before it passes its counts on, and rows of one batch.
HELD = 1 << 19
PASSED = 1 << 16
#: Words of a written row.
ROW_WORDS = 1024
#: Words that one vectorised step handles.
STEP_WORDS = 1 << 18

_U = np.uint64
_GOLD = _U(0x9E3779B97F4A7C15)
_MASK = _U(BUCKETS - 1)
_PIECES = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n\n\n\n\n\n\n\n\n ")
#: Columns that name a phrase; 0 where it has no further word.
PHRASE = [f"h{k}" for k in range(1, MAX_WORDS + 1)]


def tokens(texts: list[str]) -> list[bytes]:
    """The words of all texts; a line end stands between pieces and after each
    text. No word is or holds one."""
    joined = "\n".join(texts).encode("utf-8", "surrogatepass").lower().translate(_PIECES)
    return [w for w in (joined + b"\n").replace(b"\n", b" \n ").split(b" ") if w]


# -- words ------------------------------------------------------------------

def word_hash(lang: str, word: bytes, salt: int) -> int:
    """Never 0, which stands for the end of a piece."""
    return xxhash.xxh3_64_intdigest(word, xxhash.xxh3_64_intdigest(lang.encode(), salt)) or 1


class _Words:
    """A task's words of one language: a number, hash and count for each."""

    def __init__(self) -> None:
        self.number: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.number[b"\n"]
        self.hash = np.zeros(1, dtype=_U)
        self.n = np.zeros(1, dtype=np.int64)

    def add(self, texts: list[str], lang: str, salt: int) -> np.ndarray:
        """Count the words; their hashes in order, 0 between pieces."""
        found = tokens(texts)
        at = np.fromiter(map(self.number.__getitem__, found), np.int64, len(found))
        if len(self.number) > len(self.hash):
            fresh = len(self.number) - len(self.hash)
            names = list(islice(reversed(self.number), fresh))[::-1]
            self.hash = np.concatenate([self.hash, np.fromiter(
                (word_hash(lang, w, salt) for w in names), _U, len(names))])
        n = np.bincount(at, minlength=len(self.hash))
        n[:len(self.n)] += self.n
        self.n = n
        return self.hash[at]


_ENCODED = ("lang string, word string, h bigint, n bigint, words array<bigint>")


def short_rows(h: np.ndarray) -> np.ndarray:
    """Bounds of rows of ROW_WORDS hashes, each up to the end of its last
    piece; the last hash is such an end."""
    ends = np.flatnonzero(h == 0) + 1
    at = np.searchsorted(ends, np.arange(ROW_WORDS, len(h), ROW_WORDS))
    return np.unique(np.concatenate([[0], ends[at], [len(h)]]))


def _encode(salt: int):
    def counted(held: dict[str, _Words]) -> Iterator[pa.RecordBatch]:
        for lang, own in held.items():
            left = islice(own.number, 1, None)
            for a in range(1, len(own.hash), PASSED):
                names = list(islice(left, PASSED))
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(names), pa.string()),
                    pa.array(names, pa.binary()).cast(pa.string()),
                    pa.array(own.hash[a:a + PASSED].view(np.int64)), pa.array(own.n[a:a + PASSED]),
                    pa.nulls(len(names), pa.list_(pa.int64()))],
                    names=["lang", "word", "h", "n", "words"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: defaultdict[str, _Words] = defaultdict(_Words)
        for batch in batches:
            texts = [t or "" for t in batch["text"].to_pylist()]
            langs = [UNKNOWN if x is None else x for x in batch["lang"].to_pylist()]
            for a, b in chunks(texts):
                own = defaultdict(list)
                for lang, text in zip(langs[a:b], texts[a:b]):
                    own[lang].append(text)
                for lang, some in own.items():
                    h = held[lang].add(some, lang, salt)
                    cuts = short_rows(h)
                    k = len(cuts) - 1
                    yield pa.RecordBatch.from_arrays([
                        pa.nulls(k, pa.string()), pa.nulls(k, pa.string()),
                        pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(cuts, pa.int32()),
                                                 pa.array(h.view(np.int64)))],
                        names=["lang", "word", "h", "n", "words"])
            if sum(len(x.number) for x in held.values()) > HELD:
                yield from counted(held)
                held.clear()
        yield from counted(held)
    return run


def encode(docs: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    """(words, steps): lang, word, h and n of every word, and the written
    hashes of the texts' pieces, in rows of about ROW_WORDS of a language."""
    spark = docs.sparkSession
    salt = 0
    while True:
        path = f"{root}/encoded-{salt}"
        docs.select("lang", "text").mapInArrow(_encode(salt), _ENCODED) \
            .write.option("compression", "zstd").parquet(path)
        both = spark.read.schema(_ENCODED).parquet(path)
        words = written(both.filter("word is not null").groupBy("lang", "word", "h")
                        .agg(F.sum("n").alias("n")), "words", f"{root}/words-{salt}")
        if words.groupBy("h").count().filter("count > 1").isEmpty():
            return words, both.filter("words is not null").select("words")
        salt += 1


def _sequences(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The rows' hashes, many rows at once: all end with a piece."""
    words = batch["words"]
    ends = np.cumsum(words.value_lengths().to_numpy(zero_copy_only=False))
    h = words.flatten().to_numpy(zero_copy_only=False).view(_U)
    a = 0
    while a < len(h):
        b = ends[max(np.searchsorted(ends, a + STEP_WORDS, "right") - 1,
                     np.searchsorted(ends, a, "right"))]
        yield h[a:b]
        a = b


# -- candidates -------------------------------------------------------------

def bitmap(buckets: DataFrame) -> np.ndarray:
    """The numbers ``bucket`` below BUCKETS as bits."""
    place = F.col("bucket").cast("long") + 1  # these functions count from one
    rows = buckets.groupBy("k").agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).toArrow()
    out = np.zeros(BUCKETS // 8, dtype=np.uint8)
    for k, bits in zip(rows["k"].to_pylist(), rows["bits"].to_pylist()):
        out[k * 4096:k * 4096 + len(bits)] = np.frombuffer(bits, np.uint8)
    return out


def _by_bitmap(bucket: Column) -> list[Column]:
    """A bucket and the number of the bitmap piece that holds it."""
    return [bucket.alias("bucket"), F.shiftright(bucket, 15).cast("int").alias("k")]


def _has(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    bucket = h & _MASK
    return (bits[bucket >> _U(3)] >> (bucket & _U(7)).astype(np.uint8)) & 1 == 1


class Grams:
    """Places of a step where a phrase may be frequent. ``maps`` are the
    bitmaps so far: words, pairs, triples. ``hits[m]`` marks the places whose
    phrase of m + 1 words passes, ``safe`` those whose next longer phrase holds
    only such, and ``hash`` is that phrase's hash."""

    def __init__(self, h: np.ndarray, maps: list[np.ndarray]) -> None:
        self.hits = [_has(maps[0], h) & (h != 0)]
        self.hash = h
        for m in range(1, MAX_WORDS):
            self.safe = np.zeros(len(h), dtype=bool)
            self.safe[:-1] = self.hits[-1][:-1] & self.hits[-1][1:]
            tail = np.zeros(len(h), dtype=_U)
            tail[:-m] = h[m:]
            self.hash = mix(self.hash * _GOLD + tail)
            if m >= len(maps):
                break
            self.hits.append(self.safe & _has(maps[m], self.hash))


def _count_buckets(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            bucket, own = np.unique(np.concatenate([x[0] for x in held]), return_inverse=True)
            return bucket, np.bincount(own, np.concatenate([x[1] for x in held])) \
                .astype(np.int64)

        def rows() -> Iterator[pa.RecordBatch]:
            bucket, n = merged()
            for a in range(0, len(n), PASSED):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[a:a + PASSED].astype(np.int32)),
                     pa.array(n[a:a + PASSED])], names=["bucket", "n"])

        for batch in batches:
            for h in _sequences(batch):
                grams = Grams(h, shared.value)
                got = np.unique(grams.hash[grams.safe] & _MASK, return_counts=True)
                held.append(got)
                size += len(got[0])
                if size > 2 * HELD:
                    held = [merged()]
                    size = len(held[0][0])
                    if size > HELD:
                        yield from rows()
                        held, size = [], 0
        if held:
            yield from rows()
    return run


def _places(shared):
    """The longest candidate at each place of a step, exactly (numbered by what
    it begins with and its last word), and at how many places it is that."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h in _sequences(batch):
                hits = Grams(h, shared.value).hits
                names, word = np.unique(h, return_inverse=True)
                code = word
                for m in range(1, MAX_WORDS):
                    place = np.flatnonzero(hits[m])
                    if not len(place):
                        break
                    _, first, own = np.unique(code[place] * len(names) + word[place + m],
                                              return_index=True, return_inverse=True)
                    code = np.zeros(len(h), dtype=np.int64)
                    code[place] = own
                    ends = own if m + 1 == MAX_WORDS else own[~hits[m + 1][place]]
                    n = np.bincount(ends, minlength=len(first))
                    at = place[first[n > 0]]
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array((h[at + k] if k <= m else np.zeros(len(at), _U))
                                    .view(np.int64)) for k in range(MAX_WORDS)),
                         pa.array(n[n > 0])], names=[*PHRASE, "n"])
    return run


# -- trie -------------------------------------------------------------------

class Trie:
    """A double array over phrases (rows of word hashes, 0 after the last
    word). A word is two digits of its number, so that a state has few
    children close together: the child of state s by digit d is base[s] + d
    if check there is s. The root is state 0."""

    ARRAYS = ("base", "check", "accepts", "words", "number")

    def __init__(self, phrases: np.ndarray) -> None:
        words, index, often = np.unique(phrases, return_inverse=True, return_counts=True)
        # Frequent words get small numbers: their digits differ less.
        order = np.argsort(-often, kind="stable")
        order = order[words[order] != 0]
        number = np.full(len(words), -1, dtype=np.int32)
        number[order] = np.arange(len(order))
        self.words, self.number = words, number
        self._prepare()
        paths = number[index.reshape(phrases.shape)]
        del index, often, order
        self._build(np.stack([np.where(paths < 0, -1, x) for x in self._digits(paths)], axis=2)
                    .reshape(len(paths), -1))

    def _prepare(self) -> None:
        self.bits = max(1, (len(self.words).bit_length() + 1) // 2)
        self.names = np.zeros(len(self.words) + 1, dtype=_U)
        self.names[self.number] = self.words

    @classmethod
    def from_bytes(cls, arrays: dict[str, bytes]) -> Trie:
        out = cls.__new__(cls)
        for name, kind in zip(cls.ARRAYS, (np.int32, np.int32, bool, _U, np.int32)):
            setattr(out, name, np.frombuffer(arrays[name], kind))
        out._prepare()
        return out

    def _digits(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return number >> self.bits, number & ((1 << self.bits) - 1)

    def _build(self, paths: np.ndarray) -> None:
        # Nodes level by level, each with its parent node and digit.
        span = 1 << self.bits
        node = np.zeros(len(paths), dtype=np.int64)
        parents, digits, total = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], 1
        for level in range(paths.shape[1]):
            here = paths[:, level] >= 0
            code, own = np.unique(node[here] * span + paths[here, level], return_inverse=True)
            parents.append(code // span)
            digits.append(code % span)
            node[here] = own + total
            total += len(code)
        parent, digit = np.concatenate(parents), np.concatenate(digits)
        children = np.bincount(parent[1:], minlength=total)
        start = np.cumsum(children) - children
        kids = np.argsort(parent[1:], kind="stable") + 1
        used = np.zeros(2 * total + 4 * span, dtype=bool)
        used[0] = True
        base = np.zeros(total, dtype=np.int64)
        rng = np.random.default_rng(total)
        # Wide nodes first, while the table is empty; of equal ones many at a
        # time try random places, and the first to claim a slot keeps it.
        for width in np.unique(children[children > 0])[::-1].tolist():
            open_ = np.flatnonzero(children == width)
            poor = 0
            while len(open_):
                turn = open_[:max(1, len(used) // (16 * width))]
                place = rng.integers(1, len(used) - span, len(turn))
                slot = digit[kids[start[turn][:, None] + np.arange(width)]] + place[:, None]
                free = np.flatnonzero(~used[slot].any(axis=1))
                flat = slot[free].ravel()
                first = np.zeros(len(flat), dtype=bool)
                first[np.unique(flat, return_index=True)[1]] = True
                won = free[first.reshape(-1, width).all(axis=1)]
                used[slot[won]] = True
                base[turn[won]] = place[won]
                left = np.ones(len(open_), dtype=bool)
                left[won] = False
                open_ = open_[left]
                poor += 8 * len(won) < len(turn)
                if poor > 16:  # crowded: more room
                    used = np.concatenate([used, np.zeros(len(used) // 4, dtype=bool)])
                    poor = 0
        state = base[parent] + digit
        state[0] = 0
        self.base = np.zeros(len(used), dtype=np.int32)
        self.base[state] = base
        self.check = np.full(len(used), -1, dtype=np.int32)
        self.check[state[1:]] = state[parent[1:]]
        self.accepts = np.zeros(len(used), dtype=bool)
        self.accepts[state[node]] = True

    def numbers(self, h: np.ndarray) -> np.ndarray:
        """The words' numbers, -1 for words of no phrase."""
        at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        return np.where(self.words[at] == h, self.number[at], -1)

    def step(self, state: np.ndarray, number: np.ndarray) -> np.ndarray:
        """The next states after a word; -1 where there is none."""
        for digit in self._digits(number):
            to = np.where(state >= 0, self.base[state] + digit, 0)
            state = np.where((number >= 0) & (state >= 0) & (self.check[to] == state), to, -1)
        return state

    def phrases(self, state: np.ndarray) -> np.ndarray:
        """The word hashes that lead to each state, a row for each."""
        out = np.zeros((len(state), MAX_WORDS), dtype=_U)
        state = state.copy()
        while (state > 0).any():
            deep = np.flatnonzero(state > 0)
            low = state[deep]
            high = self.check[low]
            above = self.check[high]
            number = (high - self.base[above] << self.bits) + (low - self.base[high])
            out[deep] = np.column_stack([self.names[number], out[deep][:, :-1]])
            state[deep] = above
        return out


def count_block(places: pa.Table, min_count: int) -> pa.Table:
    """The phrases that a block's ``places`` (h1, h2, ..., n) begin with, of
    two words or more, and their sums of n, if ``min_count`` or more."""
    rows = np.column_stack([places[c].to_numpy() for c in PHRASE]).view(_U)
    n = places["n"].to_numpy()
    trie = Trie(np.concatenate([np.where(np.arange(MAX_WORDS) < k, rows, _U(0))
                                for k in range(2, MAX_WORDS + 1)]))
    total = np.zeros(len(trie.check), dtype=np.int64)
    state = np.zeros(len(rows), dtype=np.int32)
    for level in range(MAX_WORDS):
        state = trie.step(state, trie.numbers(rows[:, level]))
        here = np.flatnonzero(state >= 0)
        here = here[trie.accepts[state[here]]]
        np.add.at(total, state[here], n[here])
    often = np.flatnonzero(total >= min_count)
    found = trie.phrases(often)
    return pa.table({**{c: pa.array(found[:, k].view(np.int64)) for k, c in enumerate(PHRASE)},
                     "n": pa.array(total[often])})


def counts(docs: DataFrame, min_count: int = MIN_COUNT, block: int = BLOCK
           ) -> tuple[DataFrame, DataFrame]:
    """(words, phrases) of ``docs`` (lang, text): lang, word, h and n of all
    words, and h1, h2, ... and n of all phrases of at least ``min_count``
    occurrences, words too. Counts are exact."""
    spark = docs.sparkSession
    ship(spark)
    sc = spark.sparkContext
    root = scratch(spark, "phrases")
    words, steps = encode(docs, root)
    often = words.filter(F.col("n") >= min_count)
    maps = [bitmap(often.select(*_by_bitmap(F.col("h").bitwiseAND(BUCKETS - 1))))]
    for _ in range(1, MAX_WORDS):
        shared = sc.broadcast(maps)
        # Dealt by pieces of the bitmap, so that its bits need no further shuffle.
        sums = steps.mapInArrow(_count_buckets(shared), "bucket int, n bigint") \
            .select(*_by_bitmap(F.col("bucket")), "n").repartition("k") \
            .groupBy("k", "bucket").agg(F.sum("n").alias("n"))
        maps = maps + [bitmap(sums.filter(F.col("n") >= min_count))]
        shared.unpersist()
    shared = sc.broadcast(maps)
    schema = ", ".join([*(f"{c} bigint" for c in PHRASE), "n bigint"])
    places = written(steps.mapInArrow(_places(shared), schema).groupBy(*PHRASE)
                     .agg(F.sum("n").alias("n")), "places", f"{root}/places")
    shared.unpersist()
    blocks = max(1, -(-places.count() // block))
    # What a phrase of two words begins is in one block with it.
    counted = places.withColumn(
        "block", F.pmod(F.xxhash64(*PHRASE[:2]), F.lit(blocks)).cast("int")) \
        .groupBy("block").applyInArrow(lambda rows: count_block(rows, min_count), schema)
    out = often.select(F.col("h").alias("h1"), *[F.lit(0).cast("long").alias(c)
                                                 for c in PHRASE[1:]], "n")
    out = out.unionByName(written(counted, "counts", f"{root}/counts"))
    return words, out


# -- scores -----------------------------------------------------------------

def _slice(first: int, length: int) -> Column:
    """The phrase's words from number ``first`` on, as a phrase."""
    return F.struct(*[(F.col(PHRASE[first + k]) if k < length else F.lit(0).cast("long"))
                      .alias(PHRASE[k]) for k in range(MAX_WORDS)])


def scored(phrases: DataFrame) -> DataFrame:
    """(h1, h2, ..., n_words, a, l, r, score) of the phrases of two words or
    more in ``phrases`` (of ``counts``): the cut of least score, then least k."""
    every = phrases.select(*PHRASE, F.col("n").alias("a"),
                           sum((F.col(c) != 0).cast("int") for c in PHRASE).alias("n_words"))
    cuts = []
    for n in range(2, MAX_WORDS + 1):
        cuts.append(F.when(F.col("n_words") == n, F.array(*[
            F.struct(F.lit(k).alias("k"), _slice(0, k).alias("left"),
                     _slice(k, n - k).alias("right")) for k in range(1, n)])))
    cut = every.filter("n_words > 1").select(*PHRASE, "n_words", "a",
                                             F.inline(F.coalesce(*cuts)))
    part = phrases.select(F.struct(*PHRASE).alias("part"), "n")
    for side, name in (("left", "l"), ("right", "r")):
        cut = cut.join(part.withColumnRenamed("n", name), F.col(side) == F.col("part")) \
            .drop("part", side)
    a, l, r = (F.col(c).cast("decimal(16,0)") for c in "alr")
    score = F.call_function("div", F.lit(1000000).cast("decimal(7,0)") * (a * a), l * r)
    least = F.min(F.struct(score.alias("score"), "k", "l", "r"))
    return cut.groupBy(*PHRASE, "n_words", "a").agg(least.alias("cut")) \
        .select(*PHRASE, "n_words", "a", "cut.l", "cut.r", "cut.score")


def uncovered(every: DataFrame, percent: int) -> DataFrame:
    """``every`` (of ``scored``) without the phrases of which one longer
    phrase holds ``percent`` of the occurrences or more."""
    inner = [F.when(F.col("n_words") == n, F.array(*[
        _slice(i, m) for m in range(2, n) for i in range(n - m + 1)]))
        for n in range(3, MAX_WORDS + 1)]
    within = every.filter("n_words > 2").select("a", F.explode(F.coalesce(*inner)).alias("part")) \
        .groupBy("part").agg(F.max("a").alias("within"))
    return every.join(within, F.struct(*PHRASE) == F.col("part"), "left").filter(
        F.col("within").isNull() | (F.lit(100) * F.col("within") < percent * F.col("a"))) \
        .drop("part", "within")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP,
                 covered_percent: int = COVERED_PERCENT, block: int = BLOCK) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each
    language of ``docs`` (lang, text) by score, count and phrase, without those
    that ``covered_percent`` of one longer frequent phrase covers."""
    words, phrases = counts(docs, min_count, block)
    n = words.groupBy("lang").agg(F.sum("n").alias("n"))
    left = uncovered(scored(phrases), covered_percent)
    names = words.select(F.col("h").alias("_h"), "lang", "word")
    left = left.join(names, F.col("h1") == F.col("_h")).drop("_h") \
        .withColumnRenamed("word", "word1")
    # Ties with the last place stay until the phrases' bytes are there.
    order = [F.desc("score"), F.desc("a")]
    left = left.withColumn("rank", F.rank().over(Window.partitionBy("lang").orderBy(*order))) \
        .filter(F.col("rank") <= top)
    for k, c in enumerate(PHRASE[1:], 2):
        left = left.join(names.drop("lang"), F.col(c) == F.col("_h"), "left").drop("_h") \
            .withColumnRenamed("word", f"word{k}")
    phrase = F.concat_ws(" ", *[f"word{k + 1}" for k in range(MAX_WORDS)])
    place = Window.partitionBy("lang").orderBy(*order, "phrase")
    return left.withColumn("phrase", phrase) \
        .withColumn("rank", F.row_number().over(place).cast("long")) \
        .filter(F.col("rank") <= top).join(n, "lang") \
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
