"""Runs of periodic words, by frequency splitting and a scan of lags.

A run is a stretch of words with smallest period q and at least
max(MIN_LENGTH, EXPONENT * q) words that no neighbour extends.

*Splitting.* In a run every word comes back at least EXPONENT times, so a
word that occurs less often within its segment belongs to no run and splits
the segment. The parts are counted again until none changes; what is shorter
than MIN_LENGTH goes. Most prose is gone after this.

*Lags.* The surviving segments stand in one array, longest first, each ended
by a word of its own. Of the multiples of q, a run of period q holds EXPONENT
in a row: only these anchors are compared for lag q, N / q of them, so that
all lags take N log N steps. Anchors that agree are checked by the hash of the
stretch between them; then the words around them are compared in full, which
gives the exact ends. A stretch inside a run that is already known has that
run's period as its smallest and is left out.

Defined results: a null or empty text has no words and no run; repeated rows
have equal results; a text is handled whole, whatever its length (about 200
bytes of a task's memory for each of its words); among runs of equal exponent
the earlier, then that of smaller period, is the greatest; other columns of
any name pass through within ``row``; an empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import WORD_GAP, chunks, let, mix, ship
from orrery.llm.hashing import Powers

MIN_LENGTH = 6
EXPONENT = 4
#: Counting passes over one step's words after which segments go to the scan
#: as they are: the scan finds the same runs in them, only later.
MAX_ROUNDS = 200

_POWERS = Powers()

Run = tuple[int, int, int]  # start, length, period


def segments(word: np.ndarray, own: np.ndarray, exponent: int = EXPONENT,
             min_length: int = MIN_LENGTH) -> list[tuple[int, int]]:
    """Ranges [a, b) of ``word`` in which every word occurs often enough.
    ``own`` numbers the texts in ascending order; no range crosses them."""
    at, part = np.arange(len(word)), own
    values = int(word.max()) + 1 if len(word) else 1
    done: list[tuple[int, int]] = []
    for _ in range(MAX_ROUNDS):
        if not len(at):
            return done
        _, index, n = np.unique(part * values + word[at], return_inverse=True,
                                return_counts=True)
        often = n[index] >= exponent
        before = np.bincount(part)[part]
        at, part, before = at[often], part[often], before[often]
        new = np.ones(len(at), dtype=bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (part[1:] != part[:-1])
        part = np.cumsum(new) - 1
        size = np.bincount(part) if len(part) else np.zeros(0, np.int64)
        first = np.flatnonzero(new)
        stable = size == before[first]
        for k in np.flatnonzero(stable & (size >= min_length)).tolist():
            done.append((int(at[first[k]]), int(at[first[k]] + size[k])))
        again = (~stable & (size >= min_length))[part] if len(part) else part.astype(bool)
        at = at[again]
        part = np.unique(part[again], return_inverse=True)[1]
    cut = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
    return done + [(int(at[a]), int(at[b - 1]) + 1) for a, b in zip(cut[:-1], cut[1:])]


def lag_scan(word: np.ndarray, parts: list[tuple[int, int]], exponent: int = EXPONENT,
             min_length: int = MIN_LENGTH) -> list[Run]:
    """All runs within the ranges ``parts`` of ``word``, places in ``word``."""
    if not parts:
        return []
    parts = sorted(parts, key=lambda p: (p[0] - p[1], p[0]))
    size = np.array([b - a for a, b in parts])
    s = np.concatenate([np.append(word[a:b], -1 - k) for k, (a, b) in enumerate(parts)])
    origin = np.concatenate([np.arange(a, b + 1) for a, b in parts])
    ends = np.cumsum(size + 1)
    up, down = _POWERS.upto(len(s) + 1)
    total = np.zeros(len(s) + 1, dtype=np.uint64)
    np.cumsum(mix(s.astype(np.uint64)) * up[:len(s)], out=total[1:])
    known = np.zeros(len(s), dtype=np.int64)  # the furthest end of a known run over a place
    found: list[Run] = []
    for q in range(1, int(size[0]) // exponent + 1):
        least = max(min_length, exponent * q)
        if size[0] < least:
            break
        upto = ends[np.searchsorted(-size, -least, side="right") - 1]
        x = s[:upto:q]
        same = x[1:] == x[:-1]
        row = len(same) - (exponent - 2)
        if row <= 0:
            continue
        agree = same[:row].copy()
        for k in range(1, exponent - 1):
            agree &= same[k:row + k]
        k = np.flatnonzero(agree)
        if not len(k):
            continue
        # Between the first and the last of the anchors the period holds.
        a, span = k * q, (exponent - 1) * q
        open_ = known[a] < a + span
        k, a = k[open_], a[open_]
        b, c, d = a + q, a + span - q, a + span
        hit = (total[c] - total[a]) * down[a] == (total[d] - total[b]) * down[b]
        k = k[hit]
        if not len(k):
            continue
        cut = np.flatnonzero(np.diff(k, prepend=-2, append=-2) != 1)
        for i, j in zip(cut[:-1].tolist(), cut[1:].tolist()):
            lo = max(0, (int(k[i]) - 1) * q)
            hi = min(len(s) - q, (int(k[j - 1]) + exponent - 1) * q)
            equal = s[lo:hi] == s[lo + q:hi + q]
            edge = np.flatnonzero(np.diff(equal.astype(np.int8), prepend=0, append=0))
            for u, v in zip((edge[0::2] + lo).tolist(), (edge[1::2] + lo).tolist()):
                end = v + q
                if end - u >= least and known[u] < end:
                    known[u:end] = np.maximum(known[u:end], end)
                    found.append((int(origin[u]), end - u, q))
    return found


def best(runs: list[Run]) -> Run | None:
    """The run of greatest length / period, compared exactly; ties to the
    smallest start, then period."""
    top = None
    for run in sorted(runs, key=lambda r: (r[0], r[2])):
        if top is None or run[1] * top[2] > top[1] * run[2]:
            top = run
    return top


def find(texts: list[str]) -> list[tuple[list[Run], str]]:
    """Runs of each text, by start and period, and the text without what
    repeats: a run keeps its first period."""
    number: defaultdict[bytes, int] = defaultdict(count().__next__)
    words = [t.encode("utf-8", "surrogatepass").split() for t in texts]  # ASCII white space
    n = np.array([len(w) for w in words], dtype=np.int64)
    start = np.concatenate([[0], np.cumsum(n)])
    word = np.fromiter((number[x] for w in words for x in w), np.int64, int(start[-1]))
    parts = segments(word, np.repeat(np.arange(len(texts)), n))
    runs: dict[int, list[Run]] = defaultdict(list)
    for at, length, period in lag_scan(word, parts):
        text = int(np.searchsorted(start, at, side="right")) - 1
        runs[text].append((at - int(start[text]), length, period))
    out = []
    for i, w in enumerate(words):
        own = sorted(runs.get(i, ()), key=lambda r: (r[0], r[2]))
        if own:
            keep = np.ones(len(w), dtype=bool)
            for at, length, period in own:
                keep[at + period:at + length] = False
            w = [w[j] for j in np.flatnonzero(keep).tolist()]
        out.append((own, b" ".join(w).decode("utf-8", "surrogatepass")))
    return out


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_RUN_SQL = "struct<start:bigint,length:bigint,period:bigint>"


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def struct(run: Run | None) -> dict | None:
        return None if run is None else {"start": run[0], "length": run[1], "period": run[2]}

    for batch in batches:
        texts = [t or "" for t in batch["text"].to_pylist()]
        for a, b in chunks(texts):
            got = find(texts[a:b])
            yield pa.RecordBatch.from_arrays([
                batch["row"].slice(a, b - a),
                pa.array([[struct(r) for r in runs] for runs, _ in got], pa.list_(_RUN)),
                pa.array([struct(best(runs)) for runs, _ in got], _RUN),
                pa.array([text for _, text in got], pa.string())],
                names=["row", "runs", "best", "collapsed"])


def detect(docs: DataFrame) -> DataFrame:
    """(row, runs, best, collapsed) of ``docs`` (row, text): the other
    columns, all runs by start and period, the one of greatest exponent (null
    without a run), and the words left when every run keeps its first period,
    joined by one space."""
    ship(docs.sparkSession)
    row = docs.schema["row"].dataType.simpleString()
    return docs.select("row", "text").mapInArrow(
        _batches, f"row {row}, runs array<{_RUN_SQL}>, best {_RUN_SQL}, collapsed string")


def repeated_tail(text: Column, key: Column) -> Column:
    """``text`` for the query: of one in ten keys, the words from a place on
    are replaced by repeats of a stretch there. A null key changes nothing."""
    h = F.crc32(key.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def repeat(words: Column) -> Column:
        n = F.size(words)
        first = (g % n).cast("int")
        return let(F.struct(first.alias("a"), (1 + F.floor((n - first) / (3 + g % 8)))
                            .cast("int").alias("p")), lambda v: F.array_join(F.transform(
                                F.sequence(F.lit(0), n - 1),
                                lambda i: F.get(words, F.when(i < v["a"], i).otherwise(
                                    v["a"] + (i - v["a"]) % v["p"]))), " "))

    words = F.filter(F.split(text, WORD_GAP), lambda w: w != "")
    return F.when((h % 10 == 0) & text.rlike(r"[^\x20\x09-\x0D]"), let(words, repeat)) \
        .otherwise(text)
