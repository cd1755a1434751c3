import csv as pycsv
import datetime as dt
import io
import os
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyloom.catalog import QUERIES
from tallyloom.catalog import io as io_queries
from tallyloom.contracts import ordered
from tallyloom.operators.groups import dedupe_first
from tallyloom.sources import csv, files, records, tables


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_positional(spark, tmp_path):
    path = put(tmp_path / "a.csv", 'x,y,z,w\n007,"Doe, ""J""",2024-01-05,extra,more\n8,NA,\n')
    layout = ordered("id string, name string, day date")
    got = csv.read_positional(spark, path, layout)
    assert rows(got) == [("007", 'Doe, "J"', dt.date(2024, 1, 5)), ("8", None, None)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        csv.read_positional(spark, path, ordered("id string, name int")).collect()


def test_named(spark, tmp_path):
    path = put(tmp_path / "a.csv", "B,A,C\n2,x,True\n-1,y,0\n")
    got = csv.read_named(spark, path, ordered("A string, B bigint, C boolean"), {"A": "a"})
    assert got.columns == ["a", "B", "C"] and rows(got) == [("x", 2, True), ("y", -1, False)]
    with pytest.raises(ValueError, match="Gone"):
        csv.read_named(spark, path, ordered("Gone string"))


def test_files_with_another_header_raise(spark, tmp_path):
    put(tmp_path / "in" / "a.csv", "A,B\n1,2\n")
    put(tmp_path / "in" / "b.csv", "B,A\n2,1\n")
    with pytest.raises(Exception, match="header"):
        csv.read_named(spark, str(tmp_path / "in"), ordered("A string, B string")).collect()


def test_quoted_line_breaks(spark, tmp_path):
    path = put(tmp_path / "a.csv", 'a,b\n1,"two\nlines"\n2,x\n')
    got = csv.read_named(spark, path, ordered("a int, b string"), multiline=True)
    assert rows(got) == [(1, "two\nlines"), (2, "x")]


def test_file_order_over_many_splits(spark, tmp_path):
    """The first row per key is the first in the file, however the file is split."""
    lines = [f"{n},{n % 7}" for n in range(3000)]
    path = put(tmp_path / "big.csv", "n,k\n" + "\n".join(lines) + "\n")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = csv.read_named(spark, path, ordered("n int, k int"), keep_order=True)
        assert df.rdd.getNumPartitions() > 3
        assert rows(dedupe_first(df, ["k"], csv.FILE_ORDER), "k", "n") == [(k, k) for k in range(7)]
        ordered_rows = [r["n"] for r in df.orderBy(*csv.FILE_ORDER).collect()]
        assert ordered_rows == list(range(3000))
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)


def test_preamble(spark, tmp_path):
    head = "title\n\nnote, with comma\nCODE,X,RATE\n"
    put(tmp_path / "fees" / "one.csv", head + 'A1,"x, y",1.5,extra\nA2,,\n')
    put(tmp_path / "fees" / "two.csv", head + "B1,x,2.5\r\n")
    got = csv.read_preamble(spark, str(tmp_path / "fees"), 3, 3, {0: "code", 2: "rate"}, ordered("code string, rate double"))
    assert rows(got) == [("A1", 1.5), ("A2", None), ("B1", 2.5)]
    kept = csv.read_preamble(spark, str(tmp_path / "fees"), 3, 3, {0: "code"}, ordered("code string"), keep_order=True)
    assert [r["code"] for r in kept.orderBy(*csv.FILE_ORDER).collect()] == ["A1", "A2", "B1"]
    with pytest.raises(Exception, match="preamble"):
        csv.read_preamble(spark, str(tmp_path / "fees"), 30, 3, {0: "code"}, ordered("code string")).collect()


def test_preamble_beyond_the_first_split(spark, tmp_path):
    """A preamble of many lines crosses several small splits."""
    body = [f"C{n},x,{n}.5" for n in range(50)]
    put(tmp_path / "fees" / "one.csv", "\n".join([*["a line of the preamble"] * 40, "CODE,X,RATE", *body]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        got = csv.read_preamble(spark, str(tmp_path / "fees"), 40, 3, {0: "code", 2: "rate"}, ordered("code string, rate double"))
        assert spark.read.text(str(tmp_path / "fees")).rdd.getNumPartitions() > 3
        assert rows(got) == sorted((f"C{n}", n + 0.5) for n in range(50))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.fixture
def small_splits(spark):
    def cut(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield cut
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def random_records(seed, n):
    rnd = random.Random(seed)
    pieces = ['"', '""', "\n", "\n\n", "\r\n", ",", "a", "bc", " ", "é"]
    return [[str(i), "".join(rnd.choices(pieces, k=rnd.randrange(9))), rnd.choice(["x", "y z", ""])] for i in range(n)]


def csv_text(records):
    out = io.StringIO(newline="")
    pycsv.writer(out, lineterminator="\n").writerows(records)
    return out.getvalue()


@pytest.mark.parametrize("size,chunk", [(40, 3), (97, 50), (100_000, 7), (100_000, 100_000)])
def test_records_cross_splits_and_chunks(spark, tmp_path, small_splits, size, chunk):
    """Records with line breaks, quotes and carriage returns are whole, however the files are cut."""
    small_splits(size)
    wanted = {}
    for name in "ab":
        some = [["k", "text", "tail"], *random_records(name, 60)]
        path = put(tmp_path / "in" / f"{name}.csv", "")
        with open(path, "w", newline="") as file:
            file.write(csv_text(some))
        wanted[name] = some
    found = records.records(spark, str(tmp_path / "in"), chunk=chunk)
    if size == 40:
        assert spark.read.text(str(tmp_path / "in")).rdd.getNumPartitions() > 16
    for name, some in wanted.items():
        mine = found.where(F.col("_file").endswith(f"{name}.csv")).orderBy("_number").collect()
        assert [next(pycsv.reader(io.StringIO(r.record, newline=""))) for r in mine] == some
        assert [r._number for r in mine] == [csv_text(some[:k]).count("\n") for k in range(len(some))]
    read = csv.read_by_header(spark, str(tmp_path / "in"), ordered("k int, text string"), chunk=chunk)
    missing = set(csv.MISSING)
    kept = lambda t: None if t.strip(" ") == "" or t in missing else t
    got = rows(read)
    assert sorted(k for k, _ in got) == sorted(int(r[0]) for some in wanted.values() for r in some[1:])
    texts = sorted((int(r[0]), kept(r[1])) for some in wanted.values() for r in some[1:] if "\r" not in r[1] and r[1] == r[1].strip(" ") and kept(r[1]))
    assert set(texts) <= set(got)


def test_an_unclosed_quote_raises(spark, tmp_path):
    path = put(tmp_path / "a.csv", 'a,b\n1,"open\n' + "2,x\n" * 5000)
    with pytest.raises(Exception, match="never closed"):
        records.records(spark, path, chunk=1000).collect()


def test_preamble_with_quotes_and_line_breaks_below(spark, tmp_path, small_splits):
    head = 'a 5" pipe\n"open\nCODE,X,RATE\n'
    put(tmp_path / "fees" / "one.csv", head + 'A1,"x\n, ""y""",1.5,extra\nA2,,\n')
    put(tmp_path / "fees" / "two.csv", head + '"B\n1",x,2.5\r\n')
    for size in (10, 100_000):
        small_splits(size)
        got = csv.read_preamble(
            spark, str(tmp_path / "fees"), 2, 3, {0: "code", 2: "rate", 1: "x"}, ordered("code string, rate double, x string"), multiline=True
        )
        assert rows(got) == [("A1", 1.5, 'x\n, "y"'), ("A2", None, None), ("B\n1", 2.5, "x")]
    with pytest.raises(Exception, match="preamble"):
        csv.read_preamble(spark, str(tmp_path / "fees"), 30, 3, {0: "code"}, ordered("code string"), multiline=True).collect()


def test_each_file_by_its_own_header(spark, tmp_path):
    root = tmp_path / "in"
    put(root / "a.csv", 'A,B\n1,"2\n2"\n')
    put(root / "b.csv", "B,Extra,A\n3,x,4\n")
    put(root / "c.csv", "B,A,A\r\nN/A,5,6\r\n")
    layout = ordered("A int, B string")
    assert rows(csv.read_by_header(spark, str(root), layout, {"A": "a"})) == [(1, "2\n2"), (4, "3"), (5, None)]
    kept = csv.read_by_header(spark, str(root), layout, keep_order=True)
    assert [r["A"] for r in kept.orderBy(*csv.FILE_ORDER).collect()] == [1, 4, 5]
    put(root / "d.csv", "B,C\n1,2\n")
    with pytest.raises(Exception, match=r"not found in \S*d.csv: A"):
        csv.read_by_header(spark, str(root), layout).collect()
    put(root / "d.csv", "B,C,A\n1,2\n")
    with pytest.raises(Exception, match="too short: 1,2"):
        csv.read_by_header(spark, str(root), layout).collect()


def test_file_choice(spark, tmp_path, frame):
    for name in ["b/(02) Feb 2023 Dashboard.csv", "b/(11) Nov 2023 Dashboard.csv", "a/(01) Jan 2024 Dashboard.csv", "a/~lock.csv", "a/.hidden.csv", "skip.csv"]:
        put(tmp_path / name, "x")
    skip = f"file:{tmp_path}/skip.csv"
    seen = files.discover_files(spark, str(tmp_path), exclude=[skip])
    names = [p.rsplit("/", 1)[1].replace("%20", " ") for (p,) in [(r["path"],) for r in seen.collect()]]
    assert names == ["(01) Jan 2024 Dashboard.csv", "(02) Feb 2023 Dashboard.csv", "(11) Nov 2023 Dashboard.csv"]
    listed = frame(
        "path string, modified int",
        ("/d/(02) 2023 Dashboard a.x", 5), ("/d/(11) 2023 Dashboard a.x", 1), ("/d/2024 Dashboard.x", 9), ("/d/(09) 2020 Dashboard.x", 2), ("/d/other.x", 3),
    )
    latest = files.latest_per_group(listed, r"(\d{4}) Dashboard", r"\((\d+)\)", 2023)
    assert rows(latest, "path") == [("/d/(11) 2023 Dashboard a.x",), ("/d/2024 Dashboard.x",)]
    assert rows(files.latest_file(listed, "Dashboard"), "path") == [("/d/2024 Dashboard.x",)]
    assert files.latest_file(listed, "nothing").count() == 0
    assert rows(files.last_n_files(listed, 2), "path") == [("/d/2024 Dashboard.x",), ("/d/other.x",)]
    assert files.last_n_files(listed, 2, backfill=True).count() == 5
    attrs = files.with_file_attrs(listed, "path", r"\((\d+)\) (\d{4})", ["m", "y"])
    assert rows(attrs.where("modified in (3, 5)"), "m", "y") == [("02", "2023"), (None, None)]


def test_upsert(frame):
    target = frame("k int, v string", (1, "a"), (2, "b"))
    batch = frame("k int, v string, f int", (2, "b1", 1), (2, "b2", 2), (3, "c", 1))
    once = tables.upsert(target, batch, "k", ["f"])
    assert rows(once) == [(1, "a"), (2, "b2"), (3, "c")]
    assert rows(tables.upsert(once, batch, "k", ["f"])) == rows(once)


def test_append_and_snapshot(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    layout = ordered("k bigint, v string")
    tables.write_snapshot(frame("k int, v string, extra int", (1, "a", 0)), path, layout)
    more = frame("k bigint, v string", (1, "again"), (2, "b"))
    tables.append_new(more, path, "k")
    tables.append_new(more, path, "k")
    assert rows(tables.read_table(spark, path)) == [(1, "a"), (2, "b")]
    assert tables.read_table(spark, path, ["v"]).columns == ["v"]
    tables.write_snapshot(frame("k int, v string", (9, "z")), path, layout)
    assert rows(tables.read_table(spark, path)) == [(9, "z")]


def test_ingest_log(spark, frame):
    when = dt.datetime(2024, 5, 1)
    meta, sources = spark.createDataFrame([], tables.META), spark.createDataFrame([], tables.SOURCES_META)
    listed = frame("path string, modified timestamp_ntz", ("/a", dt.datetime(2024, 1, 1)))
    meta, sources = tables.log_ingest(meta, sources, "daily", listed, dt.datetime(2024, 1, 2))
    meta, sources = tables.log_ingest(meta, sources, "daily", listed.withColumn("modified", F.lit("2024-02-01").cast("timestamp_ntz")), when)
    assert rows(meta) == [("daily", when)] and rows(sources) == [("/a", dt.datetime(2024, 2, 1))]
    assert tables.log_ingest(meta, sources, "weekly", None, when)[0].count() == 2


def bucket_files(path):
    return {p.parent.name: {f.name for f in p.parent.glob("*.parquet")} for p in path.glob("key_bucket=*/*.parquet")}


def test_upsert_rewrites_touched_buckets_only(spark, frame, tmp_path):
    path = tmp_path / "t"
    tables.write_buckets(frame("k int, v string", *[(i, "old") for i in range(200)], (None, "none")), str(path), "k", 8)
    before = bucket_files(path)
    updates = frame("v string, k int, n int", ("new", 7, 1), ("newer", 7, 2), ("added", None, 1))
    tables.upsert_buckets(updates, str(path), "k", ["n"], 8)
    after = bucket_files(path)
    touched = {r[0] for r in spark.read.parquet(str(path)).where("k = 7 or k is null").select("key_bucket").distinct().collect()}
    assert {name for name in before if before[name] != after[name]} == {f"key_bucket={b}" for b in touched}
    assert len(touched) < len(before)
    wanted = [(i, "newer" if i == 7 else "old") for i in range(200)] + [(None, "added")]
    assert rows(tables.read_buckets(spark, str(path)), "k", "v") == sorted(wanted, key=repr)
    tables.upsert_buckets(updates.where("false"), str(path), "k", ["n"], 8)
    assert bucket_files(path) == after


@pytest.mark.parametrize("stop", ["staging", "switch", "removal"])
def test_upsert_can_be_run_again_after_a_stop(spark, frame, tmp_path, monkeypatch, stop):
    """Stopped while staging, before or amid the switch, or before the staged folders go."""
    path, staged = tmp_path / "t", tmp_path / "t.staged"
    tables.write_buckets(frame("k int, v string", *[(i, "old") for i in range(40)]), str(path), "k", 4)
    updates = frame("k int, v string, n int", *[(i, "new", 1) for i in range(0, 60, 3)])
    wanted = sorted([(i, "new" if i % 3 == 0 else "old") for i in range(40)] + [(i, "new") for i in range(42, 60, 3)], key=repr)
    real, removed = tables.finish_upsert, tables._remove

    def stopped(*args):
        if staged.exists():
            raise InterruptedError
        real(*args)

    with monkeypatch.context() as m:
        if stop == "removal":
            m.setattr(tables, "_remove", lambda spark, p: stopped() if staged.exists() else None)
        else:
            m.setattr(tables, "finish_upsert", stopped)
        with pytest.raises(InterruptedError):
            tables.upsert_buckets(updates, str(path), "k", ["n"], 4)
    if stop == "staging":
        (staged / "_SUCCESS").unlink()
    if stop == "switch":
        removed(spark, str(next(path.glob("key_bucket=*"))))
    spark.catalog.refreshByPath(str(path))
    tables.upsert_buckets(updates, str(path), "k", ["n"], 4)
    assert rows(tables.read_buckets(spark, str(path)), "k", "v") == wanted
    assert not staged.exists()


def test_preamble_files_grow_in_number_not_in_size(spark, frame, tmp_path, monkeypatch):
    """More text makes more files, even where all ids are the same or leave the same remainder."""
    monkeypatch.setattr(io_queries, "FILE_BYTES", 1000, raising=False)
    made = [(8 * (n % 2), f'line "{n}",\nand {"x" * 80}', "en") for n in range(100)]
    frame("doc_id bigint, text string, lang string", *made, (None, "no id", "en")).write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["csv_preamble_quoted"](spark, str(tmp_path))
    assert rows(got, "doc_id", "text", "lang") == sorted(made, key=repr)
    sizes = [os.path.getsize(f.removeprefix("file://")) for f in got.inputFiles()]
    assert len(sizes) >= 10 and max(sizes) < 2000
