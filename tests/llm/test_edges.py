"""Nulls, empty and very long texts, ties, repeated rows, empty tables and
clashing column names, for every operator and pipeline stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from orrery.llm import (bagminhash, decontaminate, language, licenses, mixing, pii, quality,
                        sharding, tokens, urls)

CLASHES = ["row", "size", "copies", "class", "node", "start", "part", "at", "hash", "quality",
           "matches", "stays", "kept", "rate", "target", "id", "count", "bucket", "group", "key"]
GOOD = "Here is a plain sentence of more than ten words, that no rule can fault at all."
LONG = " ".join(f"w{i % 977}x{i}" for i in range(120_000)) + "."
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ROWS = [
    (1, GOOD, "en", "a", len(GOOD)), (1, GOOD, "en", "a", len(GOOD)),
    (2, GOOD, None, None, None), (None, None, None, None, None), (3, "", "en", "a", 0),
    (None, GOOD.replace("plain", "simple"), "en", "b", 5), (4, " \n\t ", None, "b", 4),
    (5, LONG, "en", "b", len(LONG)), (6, "a\0b \ud83d\ude00 é", "fr", "", 7),
    (None, None, None, None, None),
]


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame([(i, None if t is None else t.encode(
        "utf-16", "surrogatepass").decode("utf-16"), *r) for i, t, *r in ROWS], DOCS)
    return frame.select("*", *[F.lit(f"x-{c}").alias(c) for c in CLASHES])


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def bench_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(1, "a benchmark text that stands in no document here"), (2, None),
                           (None, "")], "item_id long, text string") \
        .write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_keep_columns_and_take_empty_tables(spark, docs, empty, bench_dir, name, stage):
    for frame, rows in ((docs, True), (empty, False)):
        out = stage(spark, frame, bench_dir)
        assert (out.count() > 0) == rows
        if name == "token_files":
            assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
        else:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
            assert all(r["row"] == "x-row" and r["size"] == "x-size" for r in out.collect())


def test_quality(docs):
    got = quality.judge(docs).select("row.doc_id", "row.text", "quality.*").collect()
    assert len(got) == len(ROWS)
    for r in got:
        if r.text is None or not r.text.strip():
            assert (r.n_words, r.word_chars, r.kept, r.base_failed) == (0, 0, False, True)
    assert sum(r.kept for r in got if r.text and r.text.startswith("Here")) == 4


CLEAN = [
    "هل تعرف كم عدد الكتب التي قرأها الناس في هذه المدينة خلال العام الماضي؟",
    "یہ ایک سادہ جملہ ہے جس میں دس سے زیادہ الفاظ ہیں اور کوئی غلطی نہیں ہے۔",
    "यह एक सरल वाक्य है जिसमें दस से अधिक शब्द हैं और कोई गलती नहीं है।",
    "Gestern sagte sie ihm am Telefon noch einmal: „Wir sehen uns morgen früh am alten Bahnhof.“",
    "Il lui a répondu hier au téléphone : « Nous nous verrons demain matin à la gare. »",
    "The thread moreover shows that nobody had asked for it before the meeting began.",
    "Children who read more books do better at school than those who read none at all.",
    "She wrote that the privacy policy of the firm had been changed twice within a single year "
    "and nobody was told.",
]
NOISE = ["Click here to read more.", "Alle Rechte vorbehalten.", "Tous Droits RÉSERVÉS.",
         "Leer más.", "Please enable JavaScript to view it.", "Home | About | Contact.",
         "a line without an end"]


def test_quality_of_scripts_and_phrases(spark):
    """Clean sentences of many scripts stay whole; boilerplate lines go."""
    rows = list(enumerate(CLEAN)) + [(100 + k, f"{GOOD}\n{x}\n{GOOD} Yes.")
                                     for k, x in enumerate(NOISE)]
    got = {r.doc_id: r for r in quality.judge(
        spark.createDataFrame(rows, "doc_id int, text string"))
        .select("row.doc_id", "quality.*").collect()}
    for k, text in enumerate(CLEAN):
        assert got[k].kept and got[k].lost_chars == 0 and got[k].clean_text == text, text
    for k, noise in enumerate(NOISE):
        assert got[100 + k].clean_text == f"{GOOD}\n{GOOD} Yes.", noise


def test_near_duplicates(docs, spark, bench_dir):
    got = bagminhash.classes(docs).collect()
    assert len(got) == len(ROWS)
    good = [r for r in got if r.class_size == 3]
    assert len(good) == 3 and {r.class_id for r in good} == {1}
    assert all(r.class_size == 1 for r in got if r not in good)
    left = bagminhash.deduplicate(docs).collect()
    # Rows without words all stay; of the three equal texts one row stays.
    assert len(left) == len(ROWS) - 2
    assert [r.doc_id for r in left if r.text == GOOD] == [1]


def test_decontamination(docs, spark):
    bench = spark.createDataFrame([(7, GOOD.upper()), (8, None), (9, "short")],
                                  "item_id long, text string")
    got = decontaminate.find_matches(docs, bench).select("row.text", "matches").collect()
    assert len(got) == len(ROWS)
    for r in got:
        expected = r.text is not None and r.text.startswith("Here")
        assert [m.item_id for m in r.matches] == ([7] if expected else [])
    none = decontaminate.find_matches(docs, bench.limit(0)).select("matches").collect()
    assert all(r.matches == [] for r in none)


def test_mixing(docs):
    got = mixing.sample(docs).select("row.doc_id", "source", "size", "source_size", "target",
                                     "copies").collect()
    assert len(got) == len(ROWS)
    assert {r.source for r in got} == {"a", "b", "", None}
    for r in got:
        assert 0 <= r.copies <= 2 and r.target <= 2 * r.source_size


def test_tokens(docs, spark):
    got = tokens.tokenize(docs.select("doc_id", "text"), tokens.vocabulary()).collect()
    assert len(got) == len(ROWS)
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.doc_id is None for r in ordered] == [True] * 3 + [False] * 7
    at = 0
    for r in ordered:
        assert r.start == at and r.n_tokens >= 1
        at += r.n_tokens


def test_language(docs, empty):
    model = language.learn(docs.select("text", "lang"))
    assert set(model.languages) == {"en", "fr"}
    rows = docs.select(F.struct("doc_id").alias("row"), "text")
    got = language.predict(rows, model).select("row.doc_id", "lang_pred", "score").collect()
    assert len(got) == len(ROWS)
    assert sum(r.lang_pred == "und" and r.score == 0 for r in got) == 4
    nothing = language.learn(empty.select("text", "lang"))
    assert {r.lang_pred for r in language.predict(rows, nothing).collect()} == {"und"}


def test_pii(docs, empty):
    got = pii.find(docs).collect()
    assert len(got) == len(ROWS) and all(r.n_email == 0 for r in got)
    assert pii.find(empty).count() == 0


def test_licenses(docs, empty):
    assert licenses.scan(docs).count() == 0 and licenses.scan(empty).count() == 0


def test_sharding(docs, empty):
    slots = sharding.fill(["a", "b", "c"], 101)
    got = sharding.assign(docs, slots, spare="text").select("row.doc_id", "row.text", "shard")
    got = got.collect()
    assert len(got) == len(ROWS)
    assert len({r.shard for r in got if r.doc_id == 1}) == 1
    assert sharding.assign(empty, slots).count() == 0


def test_urls(spark):
    rows = [(1, None), (2, ""), (3, "no scheme"), (4, "HTTP://WWW.Example.COM/en/x?y#z"),
            (5, "a://b://c/d"), (6, "http://example.com"), (None, "x://" + "a." * 50_000 + "net/es/")]
    pages = spark.createDataFrame(rows, "page_id long, url string").select(
        "*", F.lit(1).alias("host"), F.lit(2).alias("row"), F.lit(3).alias("found"))
    rules = [urls.Rule("allow", "com"), urls.Rule("block", "net", "/es/")]
    got = {r.page_id: r for r in urls.judge(pages, rules).select(
        "row.page_id", "host", "path", "rule", "verdict").collect()}
    assert [got[i].host for i in (1, 2, 3, 5)] == ["", "", "", "b:"]
    assert (got[4].host, got[4].path, got[4].rule) == ("www.example.com", "/en/x", "com/")
    assert (got[6].path, got[6].rule, got[6].verdict) == ("", None, "allow")
    assert got[None].verdict == "block"
    assert urls.judge(pages.limit(0), rules).count() == 0
