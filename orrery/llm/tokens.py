"""Token ids as ORC files.

Documents are range-partitioned and sorted by id, so file order is id order
and each file covers a span of ids. A row holds the file number, the row's
position in the file, the document id, the number of ids and the ids; ORC
stores all of them run-length encoded in stripes, with a row index and a
Bloom filter on the document id: a lookup skips files and stripes by their
statistics, and a scan reads stripes in parallel.

Encoding uses the given tokenizer file through its library. A text is cut at
white space, and before punctuation that ends a word (the tokenizer cuts there
too, which is probed; another tokenizer gets whole texts). Each different
piece is encoded once per worker and found again by its 64-bit hash. Texts
that hold an added token of the tokenizer go whole. The ids are those of
encoding the whole text.

Defined results: a null or empty text has the end id alone; rows with equal
ids keep the order of their texts' hashes; null ids come first; long texts
are processed whole; an empty table gives readable, empty files.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.llm.common import chunks, code_points, scratch, ship, short_batches
from orrery.llm.hashing import Powers, stretch_hashes, words
from orrery.llm.prefix import running_start

END_ID = 2
#: Characters per step: the more, the fewer different words a character.
STEP_CHARS = 1 << 19
#: Pieces that go to the tokenizer at once: its answers take far more memory
#: than the ids in them.
STEP_PIECES = 1 << 12
#: Different words a worker remembers (about 35 bytes each), and ids a word on
#: average; others are encoded again when they come again.
REMEMBERED = 1_000_000
REMEMBERED_IDS = 8
ORC_OPTIONS = {
    "compression": "zstd", "orc.create.index": "true", "orc.row.index.stride": "1000",
    "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01",
    "orc.stripe.size": str(64 << 20),
}


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """The place of a public tokenizer file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


#: Letters that end a piece in any Unicode version: Latin, but for the one
#: whose lower case ends in a mark.
_LATIN = np.array([chr(c).isalpha() and chr(c).lower()[-1].isalpha()
                   for c in range(0x250)] + [False])
#: Their lower cases, where these are one letter.
_LOWER = np.array([ord(x) if len(x := chr(c).lower()) == 1 else c for c in range(0x250)],
                  dtype=np.uint32)


class Encoder:
    """Ids of texts, word by word, with a memory of words: their hashes,
    sorted, and their ids in one buffer.

    ``by_word`` holds for tokenizers that drop white space before splitting;
    others encode whole texts."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.powers = Powers()
        self.known = np.zeros(0, dtype=np.uint64)
        self.begin = np.zeros(0, dtype=np.int32)
        self.length = np.zeros(0, dtype=np.int32)
        self.ids = np.zeros(0, dtype=np.int32)
        pieces = ["Ab", "ab", "a.b", "...", "'s"]
        self.by_word = all(
            sum((self._plain([p])[0] for p in text.split()), []) == self._plain([text])[0]
            for text in (" ".join(pieces), "\n".join(pieces), "  \t".join(pieces))) and all(
            self._plain([f"ab{t}"])[0] == self._plain(["ab"])[0] + self._plain([t])[0]
            for t in (".", "...", "***", "'", "-"))
        capitals, small = self._plain(["HELLO The Word", "hello the word"])
        self.lowers = capitals == small
        # Added tokens, each after a stretch of it that has no case.
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = [(max(("".join(g) for same, g in groupby(
            t, lambda c: c.lower() == c.upper()) if same), key=len, default=""), t.lower())
            for t in added]

    def goes_whole(self, text: str) -> bool:
        """Whether a text holds an added token in any case, or the zero that
        ends a text among others: such texts are not cut."""
        return not self.by_word or "\0" in text or any(
            part in text and token in text.lower() for part, token in self.added)

    def _plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for a in range(0, len(texts), STEP_PIECES)
                for e in self.tokenizer.encode_batch_fast(texts[a:a + STEP_PIECES],
                                                          add_special_tokens=False)]

    def _pieces(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words, cut once more before a tail of ASCII punctuation that
        follows a letter."""
        begin, end = words(points)
        where = np.arange(len(points))
        letter = _LATIN[np.minimum(points, 0x250)]
        last = np.maximum.accumulate(np.where(letter, where, -1))[end - 1]
        odd = np.concatenate([[0], np.cumsum(
            ~letter & ((points > 127) | ((points >= 48) & (points <= 57))))])
        cut = np.flatnonzero((last >= begin) & (last < end - 1) & (odd[end] == odd[last + 1]))
        return (np.insert(begin, cut + 1, last[cut] + 1), np.insert(end, cut, last[cut] + 1))

    def _learn(self, hashes: np.ndarray, pieces: list[str]) -> tuple[np.ndarray, np.ndarray,
                                                                     np.ndarray]:
        """Encode new pieces (sorted hashes), remember them while there is
        room, and return where their ids are in the given buffer."""
        every = self._plain(pieces)
        length = np.array([len(x) for x in every], dtype=np.int64)
        fresh = np.array([t for x in every for t in x], dtype=np.int32)
        buffer = np.concatenate([self.ids, fresh])
        begin = len(self.ids) + np.cumsum(length) - length
        if len(self.known) + len(pieces) <= REMEMBERED \
                and len(buffer) <= REMEMBERED * REMEMBERED_IDS:
            at = np.searchsorted(self.known, hashes)
            self.known = np.insert(self.known, at, hashes)
            self.begin = np.insert(self.begin, at, begin)
            self.length = np.insert(self.length, at, length)
            self.ids = buffer
        return begin, length, buffer

    def encode(self, texts: list[str], end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids in one array, and where each text begins (and the
        last ends)."""
        whole = [i for i, t in enumerate(texts) if self.goes_whole(t)]
        own = dict(zip(whole, self._plain([texts[i] for i in whole])))
        ids, starts = self._by_pieces(["" if i in own else t for i, t in enumerate(texts)])
        if own:
            every = [np.array(own[i], dtype=np.int32) if i in own else ids[a:b]
                     for i, (a, b) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist()))]
            ids = np.concatenate(every)
            starts = np.concatenate([[0], np.cumsum([len(x) for x in every])]).astype(np.int64)
        if end_id is not None:
            ids = np.insert(ids, starts[1:], end_id)
            starts = starts + np.arange(len(starts))
        return ids.astype(np.int32, copy=False), starts

    def _by_pieces(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        points, starts = code_points(texts)
        if self.lowers:  # only to know a piece again: new ones go to the tokenizer as they are
            points = np.where(points < 0x250, _LOWER[np.minimum(points, 0x24F)], points)
        first, last = self._pieces(points)
        hashes, example, index = np.unique(
            stretch_hashes(points, first, last, self.powers), return_index=True,
            return_inverse=True)
        at = np.searchsorted(self.known, hashes)
        hit = at < len(self.known)
        hit[hit] = self.known[at[hit]] == hashes[hit]
        begin, length = np.zeros((2, len(hashes)), dtype=np.int64)
        begin[hit], length[hit] = self.begin[at[hit]], self.length[at[hit]]
        buffer = self.ids
        if not hit.all():
            new = example[~hit]
            joined = "\0".join(texts)
            begin[~hit], length[~hit], buffer = self._learn(
                hashes[~hit], [joined[a:b] for a, b in zip(first[new].tolist(),
                                                           last[new].tolist())])
        size = length[index]
        ends = np.concatenate([[0], np.cumsum(size)])
        out = buffer[np.arange(ends[-1]) + np.repeat(begin[index] - ends[:-1], size)]
        return out, ends[np.searchsorted(first, starts)]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The process's encoder of a file. Python workers are reused between
    tasks, and with them the words they remember."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _encode(path: str, end_id: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, part, at = encoder(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = [t or "" for t in batch["text"].to_pylist()]
            for a, b in chunks(texts, STEP_CHARS):
                ids, starts = known.encode(texts[a:b], end_id)
                n = b - a
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, part), pa.int32()),
                    pa.array(np.arange(at, at + n), pa.int64()),
                    batch["doc_id"].slice(a, n),
                    pa.array(np.diff(starts), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids))],
                    names=["part", "at", "doc_id", "n_tokens", "ids"])
                at += n
    return run


def _schema(id_type: str) -> str:
    return f"part int, at bigint, doc_id {id_type}, n_tokens bigint, ids array<int>"


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = END_ID) -> None:
    """Encode ``docs`` (doc_id, text) into ORC files at ``path``, in ascending
    order of (doc_id, text hash)."""
    ship(docs.sparkSession)
    short_batches(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    docs.select("doc_id", "text", F.xxhash64("text").alias("hash")) \
        .repartitionByRange("doc_id", "hash").sortWithinPartitions("doc_id", "hash") \
        .select("doc_id", "text").mapInArrow(_encode(tokenizer, end_id), _schema(id_type)) \
        .write.options(**ORC_OPTIONS).orc(path)


def read_tokens(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """part, at, doc_id, n_tokens, ids; filters on doc_id skip stripes."""
    short_batches(spark)
    return spark.read.schema(_schema(id_type)).orc(path)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch["ids"]
        cut = ids.offsets.to_numpy().astype(np.int64)
        raw = ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
        crc = [zlib.crc32(raw[i:j].tobytes()) for i, j in zip(cut[:-1], cut[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch["part"], batch["at"], batch["doc_id"], pa.array(np.diff(cut), pa.int64()),
             pa.array(crc, pa.int64())],
            names=["part", "at", "doc_id", "n_tokens", "ids_crc32"])


def digests(stored: DataFrame) -> DataFrame:
    """doc_id, start (ids before the row, in file order), n_tokens and the
    CRC-32 of its ids as little-endian 32-bit integers, from the files."""
    id_type = stored.schema["doc_id"].dataType.simpleString()
    read = stored.select("part", "at", "doc_id", "ids").mapInArrow(
        _digest, f"part int, at bigint, doc_id {id_type}, n_tokens bigint, ids_crc32 bigint")
    return running_start(read, "part", "at", "n_tokens") \
        .select("doc_id", "start", "n_tokens", "ids_crc32")


def tokenize(docs: DataFrame, tokenizer: str, end_id: int | None = END_ID,
             path: str | None = None) -> DataFrame:
    """Write ``docs`` (doc_id, text) and return the digests read back."""
    spark = docs.sparkSession
    path = path or scratch(spark, "tokens")
    write_tokens(docs, path, tokenizer, end_id)
    return digests(read_tokens(spark, path, docs.schema["doc_id"].dataType.simpleString()))
