"""Periodic runs, phrase tries and pairwise quality against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orrery.llm import periods, phrases, preference, queries


# -- periodic runs ----------------------------------------------------------

def plain_runs(w):
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def random_words(rng):
    size, out = rng.choice([1, 2, 3, 5, 50]), []
    for _ in range(rng.randint(0, 8)):
        out += [str(rng.randrange(size)) for _ in range(rng.randint(1, 12))] * rng.randint(1, 9)
        out = out[:len(out) - rng.randint(0, 3)]
    return out


def test_runs_are_those_of_brute_force():
    rng = random.Random(5)
    texts = [random_words(rng) for _ in range(1500)]
    got = [x for a in range(0, 1500, 250)
           for x in periods.find([" ".join(w) for w in texts[a:a + 250]])]
    for w, (runs, collapsed) in zip(texts, got):
        assert runs == plain_runs(w)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        assert collapsed == " ".join(x for i, x in enumerate(w) if i not in gone)
    assert sum(len(runs) for runs, _ in got) > 1000


def test_runs_of_fixed_texts():
    one = "a b a b a b a b c"
    assert periods.find([one])[0] == ([(0, 8, 2)], "a b c")
    assert periods.find(["x x x x x"])[0][0] == []  # five words are too short
    assert periods.find(["x x " * 6])[0][0] == [(0, 6, 1)]  # no word gap within
    # Nested: a run of period 1 within one of period 8.
    nested = ("x " * 6 + "y z ") * 4
    assert periods.find([nested])[0][0] == plain_runs(nested.split())
    # Rare words split again and again.
    assert periods.find([" ".join(f"r{i} s s s t" for i in range(50))])[0][0] == []


def test_one_long_periodic_text():
    w = [f"w{i}" for i in range(5000)] * 5
    assert periods.find([" ".join(w)])[0][0] == [(0, 25000, 5000)]


def test_best_run_is_exact():
    big = 10 ** 15
    runs = [(5, big + 1, 3), (0, big, 3), (9, 2 * big + 2, 6)]
    assert periods.best(runs) == (5, big + 1, 3)
    assert periods.best([]) is None


def test_runs_edges(spark):
    frame = spark.createDataFrame(
        [(1, None, "x"), (2, "", "x"), (3, "a " * 9, "x"), (3, "a " * 9, "x"), (None, "b", "x")],
        "doc_id long, text string, best string")
    rows = frame.select(F.struct("doc_id", "best").alias("row"), "text")
    got = {(r.row.doc_id, len(r.runs), r.best and tuple(r.best), r.collapsed)
           for r in periods.detect(rows).collect()}
    assert got == {(1, 0, None, ""), (2, 0, None, ""), (3, 1, (0, 9, 1), "a"),
                   (None, 0, None, "b")}
    assert periods.detect(rows).count() == 5
    assert periods.detect(rows.limit(0)).count() == 0


def test_run_query_against_plain_version(spark, sf_small):
    docs = {r.doc_id: r.text for r in
            spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    planted = 0
    for r in queries.op13_periodic_runs(spark, sf_small).collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", docs[r.doc_id] or "")
        h = zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
            planted += 1
        runs = plain_runs(w)
        assert r.n_runs == len(runs)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        assert r.collapsed_sha256 == hashlib.sha256(kept.encode()).hexdigest()
        if runs:
            s, n, q = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]))
            assert (r.start, r.length, r.period, r.exponent_milli) == (s, n, q, 1000 * n // q)
    assert planted > 5


# -- phrases ----------------------------------------------------------------

def plain_phrases(rows, least, top, percent):
    every = {}
    for lang, text in rows:
        own = every.setdefault("und" if lang is None else lang, Counter())
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            w = re.findall(r"[^\x20\x09]+", piece)
            for n in (1, 2, 3):
                own.update(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, f in every.items():
        total = sum(n for p, n in f.items() if len(p) == 1)
        found = []
        for p, a in f.items():
            if len(p) < 2 or a < least:
                continue
            score, _, l, r = min((10 ** 6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]])
                                 for k in range(1, len(p)))
            if len(p) == 2 and any(100 * f[q] >= percent * a for q in f
                                   if len(q) == 3 and f[q] >= least and p in (q[:2], q[1:])):
                continue
            found.append((score, a, " ".join(p), l, r))
        found.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, i + 1, p, a, l, r, total, score)
                for i, (score, a, p, l, r) in enumerate(found[:top])]
    return sorted(out)


def phrase_rows(seed, n):
    rng = random.Random(seed)
    words = ["the", "THE", "of", "new", "york", "city", "É", "é", "a b", "中", "x" * 300]
    rows = [(rng.choice(["en", "fr", None, "und"]),
             "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", ". ", "\n", "  "])
                     for _ in range(rng.randint(0, 40)))) for _ in range(n)]
    return rows + [("en", None), ("en", ""), ("xx", "..."), ("en", "new york city " * 50)] \
        + rows[:1] * 3


@pytest.mark.parametrize("least, top, block", [(10, 2000, 1_000_000), (3, 7, 20)])
def test_phrases_are_those_of_brute_force(spark, least, top, block):
    rows = phrase_rows(least, 120)
    frame = spark.createDataFrame([(l, t, 1) for l, t in rows], "lang string, text string, n int")
    got = phrases.collocations(frame.repartition(5), least, top, 50, block).collect()
    assert sorted(tuple(r) for r in got) == plain_phrases(rows, least, top, 50)
    assert len(got) > 10


def test_phrases_of_no_rows(spark):
    frame = spark.createDataFrame([], "lang string, text string")
    assert phrases.collocations(frame).collect() == []


def test_trie_holds_its_phrases_alone():
    rng = np.random.default_rng(3)
    words = rng.integers(1, 1 << 63, 700).astype(np.uint64)
    rows = np.unique(words[rng.integers(0, 700, (20_000, 3)) ** 2 % 700], axis=0)
    rows[::5, 2] = 0
    rows = np.unique(rows, axis=0)
    built = phrases.Trie(rows)
    trie = phrases.Trie.from_bytes({n: getattr(built, n).tobytes() for n in phrases.Trie.ARRAYS})

    def end(phrase):
        state = np.zeros(len(phrase), dtype=np.int32)
        for k in range(3):
            there = phrase[:, k] != 0
            state = np.where(there, trie.step(state, trie.numbers(phrase[:, k])), state)
        return state

    state = end(rows)
    assert (state > 0).all() and trie.accepts[state].all()
    assert len(np.unique(state)) == len(rows) == trie.accepts.sum()
    assert (trie.phrases(state) == rows).all()
    known = {tuple(r) for r in rows.tolist()}
    other = words[rng.integers(0, 700, (20_000, 3))]
    hit = end(other)
    hit = (hit > 0) & trie.accepts[np.maximum(hit, 0)]
    assert hit.tolist() == [tuple(r) in known for r in other.tolist()]
    assert (trie.step(np.zeros(1, np.int32), trie.numbers(np.array([5], np.uint64))) == -1).all()


def test_words_are_written_in_short_rows(spark):
    """Readers hold a batch of rows at once, whatever the texts' size; only a
    piece without an end makes a longer row."""
    text = "one two three four. " * 5000
    frame = spark.createDataFrame([("en", text), ("en", "w " * 3000), ("fr", text), (None, None)],
                                  "lang string, text string").coalesce(1)
    phrases.ship(spark)
    words, steps = phrases.encode(frame, phrases.scratch(spark, "test-phrases"))
    sizes = sorted(r[0] for r in steps.select(F.size("words")).collect())
    assert sum(sizes) == 2 * 25_001 + 3002
    assert sizes[-1] <= 3001 + phrases.ROW_WORDS + 5
    assert sizes[-2] <= phrases.ROW_WORDS + 5
    assert all(r.words[-1] == 0 for r in steps.collect())
    assert {(r.lang, r.word): r.n for r in words.collect()}["en", "two"] == 5000


def test_rows_of_a_batch_make_steps():
    rows = [[1] * 9 + [0], [2, 0], [3] * (phrases.STEP_WORDS + 7) + [0], [0], [4, 5, 0]]
    batch = pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int64()))], names=["words"])
    steps = [h.tolist() for h in phrases._sequences(batch.slice(1))]
    assert steps == [rows[1], rows[2], rows[3] + rows[4]]
    assert list(phrases._sequences(batch.slice(0, 0))) == []


def test_block_counts_what_its_places_begin_with():
    """Each place counts for all phrases on its way through the trie."""
    rng = np.random.default_rng(5)
    rows = np.unique(rng.integers(1, 40, (4000, 3)), axis=0)
    rows[::3, 2] = 0
    rows = np.unique(rows, axis=0)
    n = rng.integers(1, 1 << 40, len(rows))
    want = Counter()
    for row, times in zip(rows.tolist(), n.tolist()):
        want[row[0], row[1], 0] += times
        if row[2]:
            want[tuple(row)] += times
    least = sorted(want.values())[len(want) // 2]
    got = phrases.count_block(pa.table({"h1": rows[:, 0], "h2": rows[:, 1], "h3": rows[:, 2],
                                        "n": n}), least)
    assert {(r["h1"], r["h2"], r["h3"]): r["n"] for r in got.to_pylist()} == {
        p: x for p, x in want.items() if x >= least}
    assert got.num_rows > 100


def test_bitmap_holds_its_numbers_alone(spark):
    rng = np.random.default_rng(1)
    numbers = np.unique(np.append(rng.integers(0, phrases.BUCKETS, 5000),
                                  [0, 1, 32767, 32768, phrases.BUCKETS - 1]))
    frame = spark.createDataFrame([(int(x),) for x in numbers], "b long") \
        .select(*phrases._by_bitmap(F.col("b")))
    bits = phrases.bitmap(frame)
    assert np.flatnonzero(np.unpackbits(bits, bitorder="little")).tolist() == numbers.tolist()


# -- pairwise quality -------------------------------------------------------

def quality_rows(n):
    rng = random.Random(2)
    docs, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        word = "".join(rng.choice("abcdefghij") for _ in range(5))
        text = " ".join(word[:rng.randint(2, 5)] for _ in range(60)) if good else \
            "!! ".join(word.upper() for _ in range(60))
        docs.append((i, text))
        labels.append((i, int(good)))
    return docs, labels


def test_ranking_learns_preferences(spark):
    docs, labels = quality_rows(300)
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    labels_frame = spark.createDataFrame(labels + [(None, 1), (5, None), (6, 7), (7, labels[7][1])],
                                         "doc_id long, quality int")
    model = preference.learn(docs.filter("doc_id < 200"), labels_frame.filter(
        "doc_id < 200 or doc_id is null"))
    got = preference.rank(docs.select(F.struct("doc_id").alias("row"), "text"), model).collect()
    truth = dict(labels)
    held = [r for r in got if r.row.doc_id >= 200]
    assert len(held) == 100
    assert sum(r.predicted == truth[r.row.doc_id] for r in held) >= 98
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)


def test_threshold_is_the_quantile_of_the_labels():
    rng = np.random.default_rng(4)
    good, bad = rng.normal(1, 1, (600, 3)), rng.normal(0, 1, (200, 3))
    model = preference.fit(good, bad, 0.75)
    above = (model.score(np.concatenate([good, bad])) >= 0.5).mean()
    assert abs(above - 0.75) < 0.01
    # The weights point along the preference.
    assert model.score(good).mean() > 0.6 > 0.5 > model.score(bad).mean()


@pytest.mark.parametrize("side", [20_000, 40, 7])
def test_ranking_takes_every_labelled_row(spark, side, monkeypatch):
    """One label is rare: with small groups each of its rows is in several."""
    monkeypatch.setattr(preference, "FEW", 20)
    monkeypatch.setattr(preference, "RANGES", 8)
    rng = np.random.default_rng(side)
    x = [rng.normal(0.4 * (k % 9 > 0), 1, 3) for k in range(300)]
    rows = spark.createDataFrame([(int(k % 9 > 0), k * 7919 % 101, v.tolist())
                                  for k, v in enumerate(x)],
                                 "quality int, place bigint, x array<double>")
    dealt = preference._dealt(rows, {0: 34, 1: 266}, side).collect()
    groups = -(-266 // side)
    assert {r.g for r in dealt if r.quality == 0} == {r.g for r in dealt if r.quality} == set(
        range(groups))
    assert sorted(r["at"] for r in dealt if r.quality) == list(range(35, 301))
    assert {r["at"] for r in dealt if not r.quality} == set(range(1, 35))
    # The threshold is that of all rows, however they are counted.
    s = np.round([v[0] for v in x], 1)
    weight = {0: 0.3 / 34, 1: 0.7 / 266}
    strengths = spark.createDataFrame([(int(k % 9 > 0), float(v)) for k, v in enumerate(s)],
                                      "quality int, s double")
    for target in (0.0, 0.2, 0.5, 0.999, 1.0):
        order = sorted((float(v), -int(k % 9 > 0)) for k, v in enumerate(s))
        below = np.cumsum([weight[-q] for _, q in order])
        k = min(int(np.searchsorted(below, target - 1e-12)), 298)
        assert preference._threshold(strengths, weight, target - 1e-12) == pytest.approx(
            (order[k][0] + order[k + 1][0]) / 2)


def test_ranking_of_groups_is_that_of_all_rows(spark):
    """Rows past any bound teach too: weights and threshold of small groups
    are near those of one, and every row's pairs are counted."""
    docs, labels = quality_rows(400)
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    rows = docs.select(F.struct("doc_id").alias("row"), "text")
    whole, dealt = (preference.learn(docs, labels, side) for side in (20_000, 30))
    got = [[r.score for r in preference.rank(rows, m).orderBy("row").collect()]
           for m in (whole, dealt)]
    assert np.abs(np.subtract(*got)).mean() < 0.05


def test_quality_edges(spark):
    docs, labels = quality_rows(60)
    docs = spark.createDataFrame([*docs, (None, None), (1000, ""), (1000, ""), (1001, "\U0001f600"),
                                  (1002, "word " * 300_000)], "doc_id long, text string") \
        .select("*", F.lit(1).alias("score"), F.lit(2).alias("x"))
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    rows = docs.select(F.struct("doc_id", "score", "x").alias("row"), "text")
    model = preference.learn(docs, labels)
    got = preference.rank(rows, model).collect()
    assert len(got) == 65 and len({r.score for r in got if r.row.doc_id == 1000}) == 1
    empty = [r.score for r in got if r.row.doc_id is None] + \
        [r.score for r in got if r.row.doc_id == 1000]
    assert len(set(empty)) == 1
    assert preference.rank(rows.limit(0), model).count() == 0
    for none in (labels.limit(0), labels.filter("quality = 1")):
        plain = preference.learn(docs, none)
        assert {r.score for r in preference.rank(rows.limit(5), plain).collect()} == {0.5}


def test_quality_query_on_held_out_rows(spark):
    path = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{path}/labels.parquet").select("doc_id", "quality")
    got = queries.op12_pairwise_quality(spark, path)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    held = got.filter("held_out").join(labels, "doc_id").collect()
    assert len(held) > 80
    assert sum(r.predicted == r.quality for r in held) >= 0.95 * len(held)
