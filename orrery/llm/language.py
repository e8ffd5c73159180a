"""Language identification with bit-sliced Bloom filters of letter n-grams.

*Learning.* Every letter n-gram (letters lower-cased, anything else a word
edge) of the labelled texts is counted per language, summed within a task
first. A language contains an n-gram that makes up MIN_SHARE of its n-grams
and at least RATIO of the n-gram's share in any language. So a language has
at most 1 / MIN_SHARE n-grams per order: that bounds what reaches the driver.

*Filter.* A slot holds one bit per language, however many there are; an n-gram sets its languages'
bits in HASHES slots, and the conjunction of those slots is the set of all
languages that contain it, with false positives.

*Decision.* Per text and language the set bits are counted over all n-grams
and corrected for the filter's false positive rate f: (count - n f)/(1 - f).
The greatest corrected count decides; the score is its share of n.

Defined results: a null text or one without a letter is ``und`` with score 0;
equal counts go to the language with more labelled rows, then by code point;
a text whose n-grams are all unknown gets that first language with score 0;
without any labelled text all are ``und``; null labels teach nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import chunks, code_points, mix, ship

ORDERS = (3,)
MIN_SHARE = 1e-5
RATIO = 0.1
HASHES = 3
SLOTS_PER_GRAM = 16
UNKNOWN = "und"
#: Entries of counts that a task holds before it passes them on.
HELD = 1 << 20

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def grams(texts: list[str], orders: tuple = ORDERS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the letter n-grams and the text of each, in text order."""
    points, starts = code_points([t.lower() for t in texts])
    code = np.where(_letters()[points], points, 0).astype(np.uint64)
    keep = code != 0
    keep[1:] |= code[:-1] != 0  # one word edge after each word
    at = np.flatnonzero(keep)
    s = np.concatenate([np.zeros(1, np.uint64), code[at], np.zeros(max(orders), np.uint64)])
    text = np.searchsorted(starts, at, side="right") - 1
    letter = np.flatnonzero(s[1:len(at) + 1])
    found, own = [], []
    for n in orders:
        # From the point before a letter, over n points, the middle ones letters.
        here = letter
        for k in range(2, n - 1):
            here = here[s[here + k] != 0]
        rolled = np.full(len(here), np.uint64(n), dtype=np.uint64)
        for k in range(n):
            rolled = rolled * np.uint64(0x100000001B3) + s[here + k]
        found.append(mix(rolled))
        own.append(text[here])
    if len(orders) == 1:
        return found[0], own[0]
    h, t = np.concatenate(found), np.concatenate(own)
    order = np.argsort(t, kind="stable")
    return h[order], t[order]


def _count(orders: tuple):
    def merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
        gram = np.concatenate([p[0] for p in parts])
        unique, own = np.unique(gram, return_inverse=True)
        return unique, np.bincount(own, np.concatenate([p[1] for p in parts]),
                                   len(unique)).astype(np.int64)

    def rows(held: dict) -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            gram, n = merged(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(gram), pa.string()), pa.array(gram.view(np.int64)),
                 pa.array(n)], names=["lang", "gram", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        size = 0
        for batch in batches:
            texts = [t or "" for t in batch["text"].to_pylist()]
            langs = batch["lang"].to_pylist()
            for a, b in chunks(texts):
                gram, text = grams(texts[a:b], orders)
                names, index = np.unique(np.array(langs[a:b], dtype=object).astype(str),
                                         return_inverse=True)
                for k, name in enumerate(names):
                    got = np.unique(gram[index[text] == k], return_counts=True)
                    held.setdefault(str(name), []).append(got)
                    size += len(got[0])
            if size > HELD:
                held = {k: [merged(v)] for k, v in held.items()}
                size = sum(len(v[0][0]) for v in held.values())
                if size > HELD // 2:
                    yield from rows(held)
                    held, size = {}, 0
        yield from rows(held)
    return run


class Filter:
    """Slots of language bits, from (gram, language number) pairs."""

    def __init__(self, languages: list[str], gram: np.ndarray, language: np.ndarray,
                 hashes: int = HASHES, per_gram: int = SLOTS_PER_GRAM) -> None:
        self.languages, self.hashes = languages, hashes
        most = int(np.bincount(language, minlength=1).max()) if len(language) else 1
        self.log = max(10, int(np.ceil(np.log2(max(1, most * per_gram)))))
        # A slot has one word per 64 languages.
        self.slots = np.zeros((-(-len(languages) // 64), 1 << self.log), dtype=np.uint64)
        bit = np.uint64(1) << (language % 64).astype(np.uint64)
        for k in range(hashes):
            np.bitwise_or.at(self.slots, (language // 64, self._slot(gram, k)), bit)
        self.rate = np.array([float(self._bits(self.slots, i).mean()) ** hashes
                              for i in range(len(languages))])

    def _slot(self, gram: np.ndarray, k: int) -> np.ndarray:
        turned = gram * np.uint64(0x9E3779B97F4A7C15 + 2 * 0x632BE59BD9B4E019 * k & (1 << 64) - 1)
        return (turned >> np.uint64(64 - self.log)).astype(np.int64)

    @staticmethod
    def _bits(words: np.ndarray, language: int) -> np.ndarray:
        return (words[language // 64] >> np.uint64(language % 64)) & np.uint64(1)

    def counts(self, gram: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Corrected counts (texts x languages) and n-grams per text."""
        bits = self.slots[:, self._slot(gram, 0)]
        for k in range(1, self.hashes):
            bits &= self.slots[:, self._slot(gram, k)]
        cut = np.searchsorted(text, np.arange(n + 1))
        total = np.diff(cut)
        out = np.zeros((n, len(self.languages)))
        for i in range(len(self.languages)):
            running = np.concatenate([[0], np.cumsum(self._bits(bits, i))])
            out[:, i] = running[cut[1:]] - running[cut[:-1]]
        return np.maximum((out - total[:, None] * self.rate) / (1 - self.rate), 0), total


def learn(labelled: DataFrame, orders: tuple = ORDERS, min_share: float = MIN_SHARE,
          ratio: float = RATIO) -> Filter:
    """A filter from ``labelled`` (text, lang)."""
    ship(labelled.sparkSession)
    known = labelled.filter("lang is not null and text is not null")
    rows = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()
    languages = [r.lang for r in rows]
    counts = known.select("text", "lang").mapInArrow(
        _count(orders), "lang string, gram bigint, n bigint") \
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    total = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    share = counts.join(F.broadcast(total), "lang").select(
        "lang", "gram", (F.col("n") / F.col("total")).alias("share")) \
        .filter(F.col("share") >= min_share)
    top = share.groupBy("gram").agg(F.collect_list(F.struct("lang", "share")).alias("in"),
                                    F.max("share").alias("most"))
    # At most 1 / min_share n-grams of each language.
    chosen = top.select("gram", F.explode("in").alias("x"), "most") \
        .filter(F.col("x.share") >= ratio * F.col("most")) \
        .select("gram", F.col("x.lang").alias("lang")).toPandas()
    number = {name: i for i, name in enumerate(languages)}
    return Filter(languages, chosen["gram"].to_numpy(np.int64).view(np.uint64),
                  chosen["lang"].map(number).to_numpy(np.int64))


def predict(docs: DataFrame, model: Filter, orders: tuple = ORDERS) -> DataFrame:
    """(row: the other columns, lang_pred, score) of ``docs`` (row, text)."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filt = shared.value
        for batch in batches:
            texts = [t or "" for t in batch["text"].to_pylist()]
            names: list[str] = []
            scores: list[float] = []
            for a, b in chunks(texts):
                gram, text = grams(texts[a:b], orders)
                if not filt.languages:
                    names += [UNKNOWN] * (b - a)
                    scores += [0.0] * (b - a)
                    continue
                count, total = filt.counts(gram, text, b - a)
                best = count.argmax(axis=1)
                top = count[np.arange(b - a), best] / np.maximum(total, 1)
                names += [filt.languages[i] if t else UNKNOWN for i, t in zip(best, total)]
                scores += np.clip(top, 0.0, 1.0).tolist()
            yield pa.RecordBatch.from_arrays(
                [batch["row"], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["row", "lang_pred", "score"])

    row = docs.schema["row"].dataType.simpleString()
    return docs.select("row", "text").mapInArrow(
        run, f"row {row}, lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning: CRC-32 of its id, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
