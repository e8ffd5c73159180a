"""The pipeline's stages against plain versions, each on what its predecessor
kept, and the files of the last one."""

import collections
import re
import unicodedata
import zlib

import numpy as np
import pytest
import regex

import corpus_pipeline
from orrery.llm import decontaminate as D
from orrery.llm import quality, tokens
from orrery.llm.common import scratch, table

from test_brute_force import brute_classes

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def kept(spark):
    """The documents before the first stage and after each stage."""
    docs = table(spark, SF, "documents")
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        path = scratch(spark, f"test-{name}")
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs.collect())
    return out


def boilerplate(line):
    """Whether the first phrase of whole words is a quarter of the line."""
    found = [(m.start(1), len(b)) for b in quality.BOILERPLATE for m in [regex.search(
        r"(?<![\p{L}\p{N}])(" + b + r")(?![\p{L}\p{N}])", line, regex.I)] if m]
    return bool(found) and min(found)[1] >= quality.MIN_BOILERPLATE_SHARE * len(line)


def line_fails(line):
    letters = "".join(c for c in line if unicodedata.category(c)[0] == "L")
    symbols = sum(line.count(s) for s in quality.SYMBOLS)
    return bool(WORD.search(line)) and (
        not regex.search(r"[.!?…。！？؟۔।॥](?:[ \xa0\u202f]?[\"'\p{Pi}\p{Pf}\p{Pe}])*[\x20\x09-\x0D]*\Z", line)
        or line.count("|") >= quality.MIN_BARS
        or len(letters) >= quality.MIN_SHOUT and letters.upper() == letters != letters.lower()
        or symbols > quality.MAX_SYMBOL_SHARE * len(line)
        or boilerplate(line))


def test_quality_stage(kept):
    before, after = kept[0], {r.doc_id: r for r in kept[1]}
    for r in before:
        words = WORD.findall(r.text)
        windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
        often = collections.Counter(windows)
        covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 5)}
        lines = r.text.split("\n")
        good = "\n".join(x for x in lines if not line_fails(x))
        size, left = (sum(map(len, WORD.findall(t))) for t in (r.text, good))
        stays = not (len(words) < 10 or 100 * len(covered) > 20 * len(words)) \
            and size - left <= quality.MAX_LOST * size
        assert (r.doc_id in after) == stays, r.doc_id
        if stays:
            got = after[r.doc_id]
            assert got.text == good and got.n_chars == len(good)
            assert (got.lang, got.source) == (r.lang, r.source)


def test_near_duplicate_stage(kept):
    rows = sorted(kept[1], key=lambda r: r.doc_id)
    top = brute_classes([r.text for r in rows])
    first = [r for i, r in enumerate(rows) if top[i] == i]
    assert sorted(kept[2]) == sorted(first)


def test_decontamination_stage(spark, kept):
    items = [r.text for r in table(spark, SF, "benchmark").collect()]
    clean = {r.doc_id for r in kept[3]}
    assert set(kept[3]) <= set(kept[2])
    index = D.Index(list(enumerate(items)))
    for r in kept[2]:
        whole = any(D.normal(b) in D.normal(r.text) for b in items)
        near = bool(next(index.search([r.text])))
        assert not (whole and r.doc_id in clean)
        assert near == (r.doc_id not in clean)
        if not near:  # no long common stretch either
            assert not any(D.normal(b)[k:k + 80] in D.normal(r.text)
                           for b in items for k in range(0, max(1, len(b) - 80), 40))


def test_mix_stage(kept):
    copies = collections.Counter(r.doc_id for r in kept[4])
    assert set(kept[4]) <= set(kept[3])
    size, taken = collections.Counter(), collections.Counter()
    for r in kept[3]:
        n = len(WORD.findall(r.text))
        size[r.source] += n
        taken[r.source] += n * copies[r.doc_id]
        assert copies[r.doc_id] <= 2
    for source, words in taken.items():
        assert words <= 2 * size[source]


def test_token_stage(kept):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokens.vocabulary())
    expected, at = collections.Counter(), 0
    for r in sorted(kept[4], key=lambda r: r.doc_id):
        ids = np.array(plain.encode(r.text, add_special_tokens=False).ids + [2], "<u4")
        expected[r.doc_id, at, len(ids), zlib.crc32(ids.tobytes())] += 1
        at += len(ids)
    assert collections.Counter(map(tuple, kept[5])) == expected


def test_files_skip_by_document(spark):
    """The ORC files hold an index and Bloom filters, and a lookup is pushed
    down to them."""
    from pyarrow import orc

    docs = table(spark, SF, "documents").select("doc_id", "text")
    path = scratch(spark, "test-orc")
    tokens.write_tokens(docs, path, tokens.vocabulary())
    stored = tokens.read_tokens(spark, path)
    found = stored.filter("doc_id = 17")
    assert "EqualTo(doc_id,17)" in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 1
    files = [r.f for r in stored.selectExpr("_metadata.file_path as f").distinct().collect()]
    spans = []
    for name in files:
        data = orc.ORCFile(name.removeprefix("file://").removeprefix("file:"))
        assert data.compression == "ZSTD" and data.nstripes >= 1
        ids = data.read(columns=["doc_id"])["doc_id"].to_pylist()
        assert ids == sorted(ids)
        spans.append((ids[0], ids[-1]))
    spans.sort()
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    raw = open(files[0].removeprefix("file://").removeprefix("file:"), "rb").read()
    assert len(raw) < 4 * stored.selectExpr("sum(n_tokens) as n").first().n


def test_near_duplicate_stage_keeps_no_scratch(spark, tmp_path):
    """Of the tables written on the way only the marks stay, which the result
    reads."""
    from pathlib import Path
    from urllib.parse import urlparse

    from orrery.llm import bagminhash
    from orrery.session import work_root

    folder = Path(urlparse(work_root(spark, "llm")).path)
    before = set(folder.iterdir()) if folder.exists() else set()
    text = "the quick brown fox jumps over the lazy dog near the old stone bridge at noon"
    docs = spark.createDataFrame(
        [(i, t) for i, t in enumerate([text, text, text + " today", "other words here", None])],
        "doc_id long, text string")
    kept = bagminhash.deduplicate(docs)
    left = sorted(p.name.rsplit("-", 1)[0] for p in set(folder.iterdir()) - before)
    assert left == ["marks"]
    kept.write.parquet(str(tmp_path / "kept"))
    assert spark.read.parquet(str(tmp_path / "kept")).filter("doc_id in (0, 3, 4)").count() == 3
    assert kept.filter("doc_id = 1").count() == 0
