"""Files by header name, paths on other file systems, exact landing counts,
racing publishers."""

from pathlib import Path

import pytest

from orrery.plans.warehouse import Warehouse
from orrery.session import unique_name, work_root
from orrery.sources import files
from orrery.sources.catalog import Catalog, PublishError, run_validated_job
from orrery.streaming import land_new_files


def test_columns_come_by_header_name(spark, tmp_path):
    (tmp_path / "r.csv").write_text("item_id,user_id,rating,note\n7,1,5,x\n8,2,,y\n")
    path = str(tmp_path / "r.csv")
    rows = files.read_text_csv(spark, path, ["user_id", "item_id", "rating"]).collect()
    assert [tuple(r) for r in rows] == [("1", "7", "5"), ("2", "8", None)]
    with pytest.raises(ValueError, match="no column kind"):
        files.read_text_csv(spark, path, ["user_id", "kind"])


def test_files_with_different_headers_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    (tmp_path / "b.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_text_csv(spark, str(tmp_path), ["a", "b"]).collect()


def test_raw_ingest_keeps_everything(spark, tmp_path):
    (tmp_path / "in.csv").write_text("b,a,more\n1,x,z\n2,y\n3,w,v,u\n")
    target = work_root(spark, unique_name("test-raw"))
    assert files.raw_ingest(spark, str(tmp_path / "in.csv"), ["a", "b"], target) == 3
    rows = {r.b: r for r in spark.read.parquet(target).collect()}
    assert rows["1"].a == "x" and rows["1"].more == "z" and rows["1"].malformed_line is None
    assert rows["2"].malformed_line == "2,y" and rows["3"].malformed_line == "3,w,v,u"
    assert all(r.source_file.endswith("in.csv") for r in rows.values())


def test_path_exists_on_the_default_file_system(spark, tmp_path):
    """A path without a scheme belongs to the default file system, here a
    view mounted on a scratch folder, not to the driver's disk."""
    from pyspark.sql import SparkSession

    store = tmp_path / "store"
    store.mkdir()
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    conf.set("fs.viewfs.mounttable.orrerytest.link./lake", f"file://{store}")
    conf.set("fs.defaultFS", "viewfs://orrerytest")
    try:
        session = SparkSession.builder.getOrCreate().newSession()
        cat = Catalog(session, "/lake/cat").create()
        rejects = session.createDataFrame([("j", "t", "r", "{}")] * 5, "job_name string, "
                                          "target_table string, error_reason string, "
                                          "payload string")
        assert not files.path_exists(session, "/lake/cat/reject_records")
        assert cat.append_rejects(rejects.limit(0)) == 0
        assert not files.path_exists(session, "/lake/cat/reject_records")
        assert cat.append_rejects(rejects) == 5
        assert files.path_exists(session, "/lake/cat/reject_records")
        assert cat.rejects().count() == 5
    finally:
        conf.set("fs.defaultFS", before or "file:///")


def test_landing_counts_more_batches_than_progress_keeps(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for i in range(110):
        (source / f"f{i:03d}.csv").write_text(f"b,a,c\n{i},x,z\n")
    root = work_root(spark, unique_name("test-batches"))
    landed = land_new_files(spark, str(source), ["a", "b"], f"{root}/out", f"{root}/ck", 1)
    out = spark.read.parquet(f"{root}/out")
    assert landed == out.count() == 110
    assert {(r.a, r.extra) for r in out.select("a", "extra").distinct().collect()} == {
        ("x", '{"c":"z"}')}


def test_two_publishers_that_both_find_the_number_free(spark):
    root = work_root(spark, unique_name("test-race"))
    first, second = Catalog(spark, root).create(), Catalog(spark, root)
    staged = second.stage({"t": spark.createDataFrame([(2,)], "x int")})
    put = second._put

    def late(seq, tables):
        # The other publisher wrote between this one's reading and its write.
        second._put = put
        first.publish({"t": spark.createDataFrame([(1,)], "x int")})
        return put(seq, tables)

    second._put = late
    with pytest.raises(PublishError, match="'t'"):
        second.commit(staged)
    reader = Catalog(spark, root)
    assert reader.state()[0] == 1 and [r.x for r in reader.read("t").collect()] == [1]
    assert second.state()[1] == reader.state()[1]


def test_racing_publishers_lose_nothing(spark):
    import os
    from concurrent.futures import ThreadPoolExecutor

    root = work_root(spark, unique_name("test-race"))
    Catalog(spark, root).create()

    def publish(k):
        return Catalog(spark, root).publish({f"t{k}": spark.createDataFrame([(k,)], "x int")})

    with ThreadPoolExecutor(20) as pool:
        assert all(pool.map(publish, range(20)))
    # Equal times change nothing: a number has one file.
    found = list(Path(root.removeprefix("file:"), "_manifests").rglob("manifest.json"))
    assert len(found) == 21
    for path in found:
        os.utime(path, (1, 1))
    reader = Catalog(spark, root)
    seq, tables = reader.state()
    assert seq == 20 and set(tables) == {f"t{k}" for k in range(20)}
    assert [reader.read(f"t{k}").first().x for k in range(20)] == list(range(20))


def test_compaction_keeps_the_newest_and_stale_writers_start_again(spark):
    root = work_root(spark, unique_name("test-compact"))
    cat = Catalog(spark, root).create()
    for k in range(5):
        cat.publish({"t": spark.createDataFrame([(k,)], "x int")})
    assert cat.compact(keep=2) == 4  # numbers 0 to 3
    reader = Catalog(spark, root)
    assert reader.state()[0] == 5 and reader.read("t").first().x == 4
    # A writer that has slept since number 0 finds number 1 free again.
    slow = Catalog(spark, root)
    staged = slow.stage({"u": spark.createDataFrame([(9,)], "x int")})
    state, calls = slow.state, []

    def old(refresh=False):
        calls.append(refresh)
        return (0, {}) if len(calls) == 1 else state(refresh)

    slow.state = old
    import orrery.sources.catalog as module

    keep, module.KEEP_MANIFESTS = module.KEEP_MANIFESTS, 2
    try:
        slow.commit(staged)
    finally:
        module.KEEP_MANIFESTS = keep
    seq, tables = Catalog(spark, root).state()
    assert seq == 6 and set(tables) == {"t", "u"}


def test_only_one_writer_creates_a_file(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from orrery.sources.commitlog import put_if_absent

    conf = spark.sparkContext._jsc.hadoopConfiguration()
    store = tmp_path / "mounted"
    store.mkdir()
    conf.set("fs.viewfs.mounttable.orreryput.link./lake", f"file://{store}")
    for path in (f"{tmp_path}/a/b/one", "viewfs://orreryput/lake/c/one"):
        with ThreadPoolExecutor(12) as pool:
            won = list(pool.map(lambda k: put_if_absent(spark, path, f"é{k}\n" * 1000)
                                if k == 0 or path.startswith("/") else None, range(12)))
        assert sum(bool(x) for x in won) == 1
        assert not put_if_absent(spark, path, "later")
        text = spark.read.text(path).collect()
        assert len(text) == 1000 and text[0].value == f"é{won.index(True)}"
    assert sorted(p.name for p in store.rglob("*") if not p.name.endswith(".crc")) == ["c", "one"]


def test_retried_job_logs_each_reject_once(spark):
    from orrery.operators.quality import NotNull, validate
    from orrery.sources.catalog import run_validated_job

    cat = Catalog(spark, work_root(spark, unique_name("test-retry"))).create()
    flagged = validate(spark.createDataFrame([(1, "a"), (None, "b"), (None, "c")],
                                             "k int, v string"), [NotNull(("k",))])
    with pytest.raises(PublishError):
        run_validated_job(cat, flagged, "job/one", "t", ["k", "v"], run_id="run 1",
                          fail_before_swap=True)
    assert cat.rejects().count() == 2  # they stay logged
    run_validated_job(cat, flagged, "job/one", "t", ["k", "v"], run_id="run 1")
    rows = cat.rejects().collect()
    assert sorted(r.payload for r in rows) == ['{"v":"b"}', '{"v":"c"}']
    assert {r.run_id for r in rows} == {"run 1"} and cat.rows("t") == 1
    run_validated_job(cat, flagged, "job/one", "t", ["k", "v"], run_id="run 2")
    run_validated_job(cat, flagged, "job/two", "t", ["k", "v"], run_id="run 2")
    assert cat.rejects().count() == 6


def test_pipeline_over_own_files_and_names(spark, tmp_path):
    (tmp_path / "items.csv").write_text(
        "name,id,tags,kind,units,score,members,extra\n"
        "One,1,\"a, b\",TV,12.0,7.5,20000,e\nTwo,2.0,b,,Unknown,8.5,30000,e\n")
    (tmp_path / "ratings.csv").write_text(
        "rating,id,user_id\n8,1,1\n-1,2,1\n9,2,2\n7,3,2\n")
    wh = Warehouse(spark, None, work_root(spark, unique_name("test-own")),
                   items_path=str(tmp_path / "items.csv"),
                   ratings_path=str(tmp_path / "ratings.csv"), header={"item_id": "id"})
    wh.run()
    g = wh.gold_tables()
    assert sorted((r.item_id, r.units, r.is_open) for r in g.dim_item.collect()) == [
        (1, 12, False), (2, None, True)]
    assert sorted((r.user_id, r.item_id, r.rating) for r in g.fact.collect()) == [
        (1, 1, 8), (1, 2, None), (2, 2, 9)]
    recos = g.recommendations.collect()
    assert {(r.user_id, r.item_id) for r in recos} == {(1, 2), (2, 1)}
    assert all(r.generated_at is not None for r in recos)


def test_missing_input_fails(spark, tmp_path):
    wh = Warehouse(spark, None, work_root(spark, unique_name("test-none")),
                   items_path=str(tmp_path / "no.csv"), ratings_path=str(tmp_path / "no.csv"))
    with pytest.raises(FileNotFoundError):
        wh.bronze()


def test_landed_csv_is_compressed_and_reads_back(spark):
    path = work_root(spark, "test", unique_name("csv"))
    rows = [(" a ", None, '"x,\ny"'), ("", "  ", "1")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    files.write_text_csv(df.filter("c = '1'"), path)
    names = [r.path for r in spark.read.format("binaryFile").load(path).select("path").collect()]
    assert names and all(n.endswith(".csv.gz") for n in names)
    assert [tuple(r) for r in files.read_text_csv(spark, path, ["c", "b"]).collect()] == [
        ("1", "  ")]


def test_clustered_rows_move_without_added_texts(spark):
    """The range exchange comes before payload and status are added."""
    catalog = Catalog(spark, work_root(spark, "test", unique_name("c"))).create()
    plans = []
    flagged = spark.range(100).selectExpr("id", "if(id % 10 = 0, 'bad', null) as error_reason")
    listed = flagged.repartitionByRange

    class Watched:
        def __getattr__(self, name):
            return getattr(flagged, name)

        def repartitionByRange(self, *keys):
            plans.append(keys)
            return listed(*keys)

    counts = run_validated_job(catalog, Watched(), "job", "t", ["id"], sort_by=["id"],
                               clustered=True)
    assert counts == {"written": 90, "rejected": 10} and plans == [("id",)]
    assert catalog.rejects().count() == 10
