"""Raw CSV files, date shards."""

from datetime import datetime

import pytest
from pyspark.sql.types import StringType, StructField, StructType

from tradewind.sources.raw import load_bronze, raw_table, read_csv, read_csv_in_blocks, verify_bronze
from tradewind.sources.shards import group_shards, read_shards, shard_summary
from tradewind.sources.tables import Warehouse

SCHEMA = StructType([StructField(c, StringType()) for c in "abc"])


def test_csv_text(spark, tmp_path):
    p = tmp_path / "x.csv"
    p.write_bytes('﻿x,y,z\n1,"a, b","say ""hi"""\n2,"two\nlines",\n3\n4,"",007\n'.encode())
    got = sorted(tuple(r) for r in read_csv(spark, str(p), SCHEMA).collect())
    assert got == [("1", "a, b", 'say "hi"'), ("2", "two\nlines", None), ("3", None, None), ("4", None, "007")]
    assert read_csv(spark, str(p), SCHEMA).columns == ["a", "b", "c"]


def test_csv_folder_of_files(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"part{i}.csv").write_text(f"a;b;c\n{i};x;y\n")
    assert read_csv(spark, str(tmp_path), SCHEMA, delimiter=";", multiline=False).count() == 3


def test_bronze_counts(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), {"bronze": "cnt_bronze"})
    f = tmp_path / "my sellers.csv"
    f.write_text("a,b,c,d\ns1,1,x,y\ns2,2,x,y\n")
    files = {"sellers": "my sellers.csv"}
    load_bronze(wh, str(tmp_path), files, ["sellers"])
    assert wh.read("bronze.sellers").count() == 2
    f.write_text("a,b,c,d\ns1,1,x,y\n")
    with pytest.raises(ValueError, match="sellers"):
        verify_bronze(wh, {"sellers": 1})
    assert load_bronze(wh, str(tmp_path), files, ["sellers"]) == {"sellers": 1}
    assert raw_table(spark, str(tmp_path), "sellers", files).count() == 1


def test_shards(spark, tmp_path):
    for day, n in (("20240101", 3), ("20240102", 5)):
        spark.range(n).repartition(2).write.parquet(str(tmp_path / f"sales_{day}"))
    spark.range(9).write.parquet(str(tmp_path / "sales_extra"))
    shards = read_shards(spark, str(tmp_path), "sales")
    assert {r._shard: r["count"] for r in shards.groupBy("_shard").count().collect()} == {"20240101": 3, "20240102": 5}
    s = shard_summary(shards).first()
    size = sum(f.stat().st_size for d in ("20240101", "20240102") for f in (tmp_path / f"sales_{d}").glob("*.parquet"))
    assert (s.shard_min, s.shard_max, s.shard_count, s.row_count, s.bytes) == ("20240101", "20240102", 2, 8, size)
    listing = spark.createDataFrame([("sales_20240101", 3, 10), ("sales_20240102", 5, 20), ("other", 1, 1)], "table_name string, row_count bigint, size_bytes bigint")
    assert sorted(tuple(r) for r in group_shards(listing).collect()) == [
        ("other", False, None, None, 0, 1, 1), ("sales_", True, "20240101", "20240102", 2, 8, 30)]


def test_csv_in_blocks_equals_spark_reader(spark, tmp_path):
    """Random quoted text in small blocks, so that records cross blocks, against Spark's reader."""
    import csv
    import random

    rng = random.Random(3)
    words = ["x", "two words", 'a "quote"', "comma, here", "line\nbreak", "\n\n", "", '"', "é ", "end\n", 'mixed\n"both", ok', "z" * 400]
    for name, ending in (("a.csv", "\n"), ("b.csv", "\n")):
        with open(tmp_path / name, "w", encoding="utf-8", newline="") as f:
            w = csv.writer(f, lineterminator=ending)
            w.writerow(["h1", "h2", "h3"])
            for i in range(1500):
                w.writerow([f"{name}{i}", "".join(rng.choices(words, k=3)), rng.choice(words)])
            f.write("short row\n")
            f.write(f'last,"{"long" + chr(10) * 3000}",end')
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    want = sorted(map(tuple, read_csv(spark, str(tmp_path), SCHEMA).collect()), key=str)
    spark.conf.set(key, "3000")
    try:
        df = read_csv_in_blocks(spark, str(tmp_path), SCHEMA)
        blocks = spark.read.text(str(tmp_path)).select("_metadata.file_block_start").distinct().count()
        got = sorted(map(tuple, df.collect()), key=str)
    finally:
        spark.conf.set(key, before)
    assert blocks > 50 and len(want) == 3004
    assert df.columns == ["a", "b", "c"]
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    assert len(got) == len(want) and not wrong, wrong[:3]


def test_csv_in_blocks_windows_line_ends(spark, tmp_path):
    (tmp_path / "w.csv").write_bytes(b'x,y,z\r\n1,"a",b\r\n\r\n2,,\r\n')
    assert sorted(map(tuple, read_csv_in_blocks(spark, str(tmp_path / "w.csv"), SCHEMA).collect())) == [("1", "a", "b"), ("2", None, None)]


def test_csv_in_blocks_with_stray_quotes(spark, tmp_path):
    """Random fields in and out of quotes, text behind closing quotes, both line ends, headers of several lines."""
    import random

    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(k) for k in keys]
    for seed in range(6):
        rng, folder, end = random.Random(seed), tmp_path / str(seed), ("\n", "\r\n")[seed % 2]
        folder.mkdir()

        def field():
            body = "".join(rng.choice(["a", "é", ",", '"', end, "x", " "]) for _ in range(rng.randint(0, 8)))
            if (kind := rng.random()) < 0.5:
                return '"' + body.replace('"', '""') + '"'
            body = body.replace(",", "").replace(end, "")
            return '"' + body.replace('"', "") + '"g' + body if kind < 0.6 else ("z" if body.startswith('"') else "") + body

        for f in range(2):
            rows = [("a,b,c", f'\ufeff"a","b{end}x",c')[f]] + [",".join(field() for _ in range(rng.randint(2, 3))) for _ in range(60)]
            (folder / f"{f}.csv").write_bytes((end.join(rows) + end * f).encode())
        want = sorted(map(str, read_csv(spark, str(folder), SCHEMA).collect()))
        try:
            for size in ("64", "200", "1m"):
                spark.conf.set(keys[0], size)
                spark.conf.set(keys[1], "1")
                assert sorted(map(str, read_csv_in_blocks(spark, str(folder), SCHEMA).collect())) == want
        finally:
            for k, v in zip(keys, before):
                spark.conf.set(k, v)


def test_csv_in_blocks_keeps_rows_behind_a_stray_quote(spark, tmp_path):
    (tmp_path / "q.csv").write_text('a,b,c\n1,5" pipe,x\n2,y,z\n3,"u\nv",w\n4,"""q",w\n')
    got = sorted(map(tuple, read_csv_in_blocks(spark, str(tmp_path / "q.csv"), SCHEMA).collect()))
    assert got == [("1", '5" pipe', "x"), ("2", "y", "z"), ("3", "u\nv", "w"), ("4", '"q', "w")]


def test_csv_in_blocks_refuses_an_open_quote(spark, tmp_path):
    (tmp_path / "o.csv").write_text('a,b,c\n1,"open,x\n2,y,z\n')
    with pytest.raises(Exception, match="ends inside a quoted field"):
        read_csv_in_blocks(spark, str(tmp_path / "o.csv"), SCHEMA).collect()


def test_items_are_numbered_within_their_orders(spark, tmp_path):
    """Lines that are equal in every column, and a third of all lines in one order, still get numbers of their own."""
    from tradewind.sources.bindings import TABLES, order_items

    line = lambda order, part, n, price: (order, part, part % 5, n, 1.0, price, 0.0, 0.05, "N", "O", datetime(2024, 1, 1 + part % 28))
    rows = [line(i // 4, i % 9, i % 3, float(i % 2)) for i in range(800)] + [line(7, 3, 1, 2.0)] * 5 + [line(999, i % 30, i % 7, 1.0) for i in range(400)]
    spark.createDataFrame(rows, TABLES["lineitem"].replace("timestamp_ntz", "timestamp")).selectExpr(
        "* EXCEPT (l_shipdate)", "cast(l_shipdate AS timestamp_ntz) AS l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {}
    for r in order_items(spark, str(tmp_path)).collect():
        got.setdefault(r.order_id, []).append((r.order_item_id, r.product_id, r.price))
    lines = {}
    for r in sorted(rows, key=lambda r: (r[0], r[3], r[1], r[2], r[10], r[5], r[7])):
        lines.setdefault(str(r[0]), []).append((len(lines.get(str(r[0]), [])) + 1, str(r[1]), r[5]))
    assert {o: sorted(v) for o, v in got.items()} == lines


def test_csv_in_chunks_of_a_block(spark, tmp_path, monkeypatch):
    """Chunks of four lines in blocks of several sizes give what Spark's reader gives; nothing is sorted or held by whole blocks."""
    with open(tmp_path / "c.csv", "w", encoding="utf-8", newline="") as f:
        f.write('a,b,"head\nof three\nlines"\n')
        for i in range(400):
            f.write(f'{i},"x ""{i}""' + "\n" * (i % 11) + f'",y{i}\n' + ("z" * (i % 7) + "\n") * (i % 3))
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    want = sorted(map(str, read_csv(spark, str(tmp_path), SCHEMA).collect()))
    monkeypatch.setattr("tradewind.sources.raw.CHUNK_BITS", 2)
    try:
        for size in ("700", "1m"):
            spark.conf.set(key, size)
            df = read_csv_in_blocks(spark, str(tmp_path), SCHEMA)
            assert sorted(map(str, df.collect())) == want
    finally:
        spark.conf.set(key, before)
    windows = [line for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window [" in line and "swap" in line]
    assert windows and all("chunk" in line for line in windows)


def shuffled_bytes(spark):
    """Bytes of each shuffle file there is."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f.getName(): f.length() for f in map(files.apply, range(files.size())) if f.getName().startswith("shuffle_")}


@pytest.mark.parametrize("quote", ['"', ""])
def test_csv_in_blocks_shuffles_no_lines(spark, tmp_path, quote):
    """Lines are cut into records where they are read, also where no line of a block has a quote; only parts of records that lie in two
    blocks are shuffled, and a few rows about chunks."""
    import random

    rng, path = random.Random(5), tmp_path / "r.csv"
    with open(path, "w") as f:
        f.write("a,b,c\n")
        for i in range(20_000):
            f.write(f'{quote}{i}{quote},{quote}{rng.randbytes(40).hex()}{quote},"{"x" + chr(10) * (i % 1000 == 7)}"\n')
    key = "spark.sql.files.maxPartitionBytes"
    size, value, before = path.stat().st_size, spark.conf.get(key), shuffled_bytes(spark)
    spark.conf.set(key, str(size // 6))
    try:
        read_csv_in_blocks(spark, str(path), SCHEMA).write.format("noop").mode("overwrite").save()
        shuffled = sum(n for name, n in shuffled_bytes(spark).items() if name not in before)
        assert shuffled < size / 20
        assert read_csv_in_blocks(spark, str(path), SCHEMA).distinct().count() == 20_000
    finally:
        spark.conf.set(key, value)


def test_csv_in_blocks_keeps_bytes_that_are_no_text(spark, tmp_path):
    (tmp_path / "b.csv").write_bytes(b'a,b,c\r\n1,"\xff\r\n\xfe",x\r\n2,\xff,\r\n')
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    want = sorted(map(str, read_csv(spark, str(tmp_path), SCHEMA).collect()))
    try:
        for size in ("8", "1m"):
            spark.conf.set(key, size)
            assert sorted(map(str, read_csv_in_blocks(spark, str(tmp_path), SCHEMA).collect())) == want
    finally:
        spark.conf.set(key, before)


def test_bronze_load_keeps_small_files(spark):
    """The files that are loaded are written compressed."""
    import os

    import __spark_entry__ as entry
    from tradewind.session import working_folder

    top = f"{working_folder(spark)}/files"
    before = set(os.listdir(top)) if os.path.isdir(top) else set()
    assert entry.queries()["bronze_load"](spark, "/root/testdata/sf0.001").count() == 9
    folder, = set(os.listdir(top)) - before
    names = [f for _, _, files in os.walk(f"{top}/{folder}") for f in files if f.startswith("part-")]
    assert len(names) >= 9 and all(f.endswith(".csv.gz") for f in names)
