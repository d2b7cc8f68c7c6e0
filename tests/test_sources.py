import os
import tempfile

from pyspark.sql import functions as F

from conftest import rows
from taxaspark.sources import io as IO
from taxaspark.sources import schemas as SC


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_read_delimited_quotes_newlines_na(spark):
    d = tempfile.mkdtemp(prefix="taxaspark-io-")
    _write(f"{d}/a.csv", 'Species\n"Tinyus, minor"\n"Say ""hi"""\n"two\nlines"\nNA\n\n')
    df = IO.read_delimited(spark, f"{d}/a.csv", SC.MICROFUNGI)
    assert sorted(r[0] for r in df.collect() if r[0] is not None) == ["Say \"hi\"", "Tinyus, minor", "two\nlines"]
    assert df.filter(F.col("Species").isNull()).count() == 1


def test_blank_kept_as_text_and_tsv(spark):
    d = tempfile.mkdtemp(prefix="taxaspark-io-")
    _write(f"{d}/b.tsv", "ScientificName\tScientificNameAuthorship\tTaxonId\nA b\t\t1\nC d\tL.\t2\n")
    base = IO.read_tsv(spark, f"{d}/b.tsv", SC.PORTAL_CHECKLIST, blank_as_null=False)
    assert rows(base) == [("A b", "", 1), ("C d", "L.", 2)]
    assert rows(IO.read_tsv(spark, f"{d}/b.tsv", SC.PORTAL_CHECKLIST)) == [("A b", None, 1), ("C d", "L.", 2)]


def test_read_tree_and_like(spark):
    d = tempfile.mkdtemp(prefix="taxaspark-io-")
    _write(f"{d}/us/x/occ.csv", "id,locality\n1,a\n")
    _write(f"{d}/ca/occ.csv", "id,locality\n2,b\n")
    _write(f"{d}/ca/readme.txt", "not data\n")
    t = IO.read_tree(spark, d, "*.csv", schema="id long, locality string")
    got = sorted((r.id, r.locality, os.path.basename(os.path.dirname(r.source_file))) for r in t.collect())
    assert got == [(1, "a", "x"), (2, "b", "ca")]
    like = IO.read_like(spark, f"{d}/ca/occ.csv", t.select("id", "locality"))
    assert like.schema == t.select("id", "locality").schema


def test_stage_and_list_writers(spark):
    d = tempfile.mkdtemp(prefix="taxaspark-io-")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    IO.write_stage(df, f"{d}/stage", partition_by=["k"])
    assert rows(spark.read.parquet(f"{d}/stage"), "k", "v") == [("a", 1), ("b", 2)]
    IO.write_list(df, f"{d}/list")
    assert rows(IO.read_delimited(spark, f"{d}/list", "k string, v int")) == [("a", 1), ("b", 2)]
    assert IO.snake("Subphylum name") == "Subphylum_name" and IO.snake("NAME.OF.FUNGUS") == "NAME_OF_FUNGUS"


def test_base_flavour_keeps_blanks_and_reads_na_as_missing(spark):
    d = tempfile.mkdtemp(prefix="taxaspark-io-")
    _write(f"{d}/c.csv", 'k,name,n\n1,NA,5\n2,,NA\n3,x,\n4,"",7\n')
    got = IO.read_delimited(spark, f"{d}/c.csv", "k int, name string, n int", blank_as_null=False)
    assert rows(got) == [(1, None, 5), (2, "", None), (3, "x", None), (4, "", 7)]
    assert rows(IO.read_tree(spark, d, "*.csv", schema="k int, name string, n int", origin_col=None), "k", "name")[0] == (1, None)


def test_one_tsv_file_is_read_by_several_tasks(spark):
    d = tempfile.mkdtemp(prefix="taxaspark-io-")
    _write(f"{d}/big.tsv", "id\ttext\n" + "".join(f"{i}\trow {i} {'x' * 80}\n" for i in range(30_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        t = IO.read_tsv(spark, f"{d}/big.tsv", "id long, text string")
        assert t.rdd.getNumPartitions() > 4
        assert t.count() == 30_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def _small_splits(spark, size):
    """Splits of ``size`` bytes while in the block."""
    import contextlib

    @contextlib.contextmanager
    def held():
        keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
        before = [spark.conf.get(k) for k in keys]
        for k in keys:
            spark.conf.set(k, str(size))
        try:
            yield
        finally:
            for k, v in zip(keys, before, strict=True):
                spark.conf.set(k, v)

    return held()


def test_columns_are_bound_by_name(spark):
    d = tempfile.mkdtemp(prefix="taxaspark-io-")
    _write(f"{d}/a/1 one.csv", "country,county,n\nUSA,Kent,1\n")
    _write(f"{d}/a/2[x].csv", "county,country,n\nYork,Canada,2\n")
    _write(f"{d}/b/3.csv", "N,extra,county\n3,e,Kerry\n")
    _write(f"{d}/b/4.csv", "county,country,county,n\nCork,Ireland,again,4\n")
    _write(f"{d}/b/5.csv", "")
    _write(f"{d}/b/6.csv", "﻿n,county\r\n6,Mayo\r\n")
    _write(f"{d}/b/7.csv", "only,header\n")
    want = [("USA", "Kent", 1), ("Canada", "York", 2), (None, "Kerry", 3), ("Ireland", "Cork", 4), (None, "Mayo", 6)]
    schema = "country string, county string, n int"
    got = IO.read_tree(spark, d, schema=schema, ordered=True).orderBy(IO.ORDER)
    assert got.columns == ["country", "county", "n", "source_file", IO.ORDER]
    assert [tuple(r)[:3] for r in got.collect()] == want
    assert [os.path.basename(r["source_file"]) for r in got.collect()] == ["1%20one.csv", "2%5Bx%5D.csv", "3.csv", "4.csv", "6.csv"]
    free = IO.read_tree(spark, d, origin_col=None)
    assert free.columns == ["country", "county", "n", "extra", "county...3", "only", "header"]
    assert rows(free, "county", "n", "extra", "`county...3`") == sorted(
        [("Kent", "1", None, None), ("York", "2", None, None), ("Kerry", "3", "e", None), ("Cork", "4", None, "again"), ("Mayo", "6", None, None)],
        key=lambda t: tuple((x is not None, x) for x in t))
    like = IO.read_like(spark, f"{d}/b/3.csv", spark.createDataFrame([], schema))
    assert like.columns == ["county", "n", "extra"] and [tuple(r) for r in like.collect()] == [("Kerry", 3, "e")]
    assert IO.read_delimited(spark, [f"{d}/b/3.csv", f"{d}/a/2\\[x\\].csv"], schema, missing="fail").count() == 2
    import pytest
    with pytest.raises(ValueError):
        IO.read_delimited(spark, f"{d}/b/3.csv", schema, missing="fail")
    none = IO.read_delimited(spark, f"{d}/b/5.csv", schema, ordered=True)
    assert none.count() == 0 and none.columns == ["country", "county", "n", IO.ORDER]
    # blanks stay text, by name too
    _write(f"{d}/c/1.csv", "n,county\n,NA\nNA,\n")
    assert rows(IO.read_tree(spark, f"{d}/c", schema=schema, origin_col=None, blank_as_null=False), "county", "n") == [(None, None), ("", None)]


def test_records_in_file_order_whatever_the_splits(spark):
    d = tempfile.mkdtemp(prefix="taxaspark-io-")
    for name, low in (("b", 0), ("a", 2000)):
        _write(f"{d}/{name}.csv", "id,note\n" + "".join(f"{i},{'n' * (i % 50)}\n" for i in range(low, low + 2000)))
    for size in (700, 9000, 1 << 20):
        with _small_splits(spark, size):
            listed = IO.read_delimited(spark, [f"{d}/b.csv", f"{d}/a.csv"], "id int", ordered=True)
            assert [r["id"] for r in listed.repartition(7).orderBy(IO.ORDER).collect()] == list(range(4000))
            tree = IO.read_tree(spark, d, schema="id int", origin_col=None, ordered=True)
            assert [r["id"] for r in tree.repartition(5).orderBy(IO.ORDER).collect()] == [*range(2000, 4000), *range(2000)]


def _random_table(rng, n):
    parts = ["a", "b c", "", '"', '""', ",", "\n", "\r\n", "\t", "é", "x" * 30, "NA", " ", "\n\n", ',"', '",']
    return [(i, "".join(rng.choices(parts, k=rng.randrange(0, 6))), rng.choice(["plain", "two\nlines", None, "q\"q"])) for i in range(n)]


def test_line_breaks_in_quotes_over_many_splits(spark):
    import csv
    import random
    for seed, size in ((1, 90), (2, 150), (3, 400), (4, 1000)):
        rng = random.Random(seed)
        table = _random_table(rng, 120)
        d = tempfile.mkdtemp(prefix="taxaspark-io-")
        with open(f"{d}/t.csv", "w", encoding="utf-8", newline="") as f:
            end = rng.choice(["\n", "\r\n"])
            w = csv.writer(f, lineterminator=end, quoting=rng.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]))
            w.writerow(["id", "head" if seed % 2 else "he,\nad", "note"])
            w.writerows(table)
        names = ["id", "head" if seed % 2 else "he,\nad", "note"]
        whole = spark.read.csv(f"{d}/t.csv", header=True, multiLine=True, escape='"', nullValue="NA").collect()
        with _small_splits(spark, size):
            assert spark.read.text(f"{d}/t.csv").rdd.getNumPartitions() > 2
            got = IO.read_delimited(spark, f"{d}/t.csv", ordered=True)
            assert got.columns == [*names, IO.ORDER]
            got = got.orderBy(IO.ORDER).collect()
        if end == "\r\n":  # Spark's own reader leaves the carriage return in the last field
            whole = [(*r[:2], (r[2] or "").removesuffix("\r") or None) for r in whole]
            got = [(*r[:2], r[2] or None) for r in got]
        assert [tuple(r)[:3] for r in got] == [tuple(r) for r in whole]
        assert [int(r[0]) for r in got] == list(range(120))


def test_a_field_longer_than_many_splits_and_stray_quotes(spark):
    d = tempfile.mkdtemp(prefix="taxaspark-io-")
    long = "line of a long field\n" * 500
    _write(f"{d}/t.tsv", f'id\ttext\tsize\n1\t"{long}"\t5" pipe\n2\tx "y" z\t"a ""b"""\n3\t"{long}end"\t\n4\ta\tb\n')
    with _small_splits(spark, 600):
        got = IO.read_tsv(spark, f"{d}/t.tsv", "id int, text string, size string", ordered=True).orderBy(IO.ORDER).collect()
    assert [tuple(r)[:3] for r in got] == [(1, long, '5" pipe'), (2, 'x "y" z', 'a "b"'), (3, long + "end", None), (4, "a", "b")]


def test_order_carries_only_what_tells_the_files_apart(spark, tmp_path):
    from taxaspark.sources.delimited import _own_part
    for i in (0, 1, 2):
        (tmp_path / f"part-{i}-a-long-name-that-all-files-share.csv").write_text("id,x\n" + "".join(f"{10 * i + j},a\n" for j in range(10)))
    got = IO.read_delimited(spark, str(tmp_path), "id int, x string", ordered=True)
    assert [r["id"] for r in got.repartition(5).orderBy(IO.ORDER).collect()] == list(range(30))
    assert {r["file"] for r in got.select(f"{IO.ORDER}.file").collect()} == {"0", "1", "2"}
    for paths in (["/a/p-1.csv", "/a/p-10.csv", "/a/p-2.csv"], ["/a/1/x", "/a/2/x"], ["/only"], ["/a", "/a/b", "/a.b"], []):
        start, length = _own_part(paths)
        short = [p[start:start + length] for p in paths]
        assert len(set(short)) == len(paths) and sorted(range(len(paths)), key=paths.__getitem__) == sorted(range(len(paths)), key=short.__getitem__)


def test_headers_are_found_without_a_sort_of_all_lines(spark, tmp_path, monkeypatch):
    from taxaspark.sources import delimited as D
    (tmp_path / "a.csv").write_text('\n\nid,x\n1,"b\nc"\n')
    (tmp_path / "b.csv").write_text("id,x\n2,d\n")
    kind, plans = type(spark.range(1)), []
    collect = kind.collect
    monkeypatch.setattr(kind, "collect", lambda self: plans.append(self._jdf.queryExecution().executedPlan().toString()) or collect(self))
    found = D.catalogue(spark, [D.Source(str(tmp_path), 0)], ",")
    assert [(f.header, f.breaks) for f in found] == [(("id", "x"), True), (("id", "x"), False)]
    assert "ObjectHashAggregate" in plans[0] and "SortAggregate" not in plans[0]


def test_downloads_are_sorted_in_ranges_of_bounded_size(spark, tmp_path, monkeypatch):
    import datetime

    from taxaspark.catalog import composites as C
    prios = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
    spark.createDataFrame(
        [(k, k % 40, "OFP"[k % 3], 10.0 * k, datetime.datetime(1995, 1 + k % 12, 1), prios[k % 5]) for k in range(5000)],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
    ).write.parquet(f"{tmp_path}/orders.parquet")
    monkeypatch.setattr(C, "RANGE_ROWS", 500)
    ca, us = C._downloads(spark, str(tmp_path))
    assert (len(ca.inputFiles()), len(us.inputFiles())) == (12, 16)
    got = C.portal_records_in_file_order(spark, str(tmp_path))
    assert rows(got) == rows(C.portal_records(spark, str(tmp_path)).select(*got.columns)) and got.count() == 5000
