import datetime
import json
import os
import pathlib

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lakework.catalogue.files import write_dictionaries
from lakework.functions.dictionary import dictionary_rows, dictionary_sizes
from lakework.layers import Lake
from lakework.scratch import scratch_path, scratch_root
from lakework.session import s3a_options
from lakework.sinks.display import preview, schema_rows
from lakework.sinks.files import land_json, replace_table, write_csv, write_partitioned, write_report
from lakework.sources.csv import csv_header_groups, plain_files, read_csv, read_csv_by_name
from lakework.sources.files import list_files, with_provenance
from lakework.sources.json import read_dictionary, read_json
from lakework.sources.tables import read_partition


def data_files(path):
    return [p for p in pathlib.Path(path).rglob("part-*") if not p.name.endswith(".crc")]


def test_csv_variants(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('n,v\n1,x\n2,"y, z"\n')
    assert read_csv(spark, str(path)).dtypes == [("n", "string"), ("v", "string")]
    assert read_csv(spark, str(path), infer=True).collect() == [(1, "x"), (2, "y, z")]
    assert read_csv(spark, str(path), header=False).columns == ["_c0", "_c1"]
    assert read_csv(spark, str(path), schema="v string, n double").collect() == [("x", 1.0), ("y, z", 2.0)]
    assert read_csv(spark, str(path), schema="v int").collect() == [(None,), (None,)]
    with pytest.raises(AnalysisException):
        read_csv(spark, str(path), schema="missing int")


def test_schema_without_header_goes_by_position(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1,x\n")
    assert read_csv(spark, str(tmp_path / "a.csv"), schema="a int, b string", header=False).collect() == [(1, "x")]


def test_csv_encoding(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes("v\ncafé\n".encode("latin-1"))
    assert read_csv(spark, str(path), encoding="ISO-8859-1").first().v == "café"


def test_csv_union_goes_by_name(spark, tmp_path):
    (tmp_path / "sub dir").mkdir()
    (tmp_path / "one.csv").write_text("n,p,v\n1,2,3\n")
    (tmp_path / "sub dir" / "two + more.csv").write_text("v,n\n30,10\n")
    (tmp_path / "three.csv").write_text("n,p,v\n4,5,6\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "only_header.csv").write_text("n,extra\n")
    (tmp_path / "note.txt").write_text("x,y\n")
    groups = csv_header_groups(spark, str(tmp_path))
    assert {h: len(files) for h, files in groups.items()} == {"n,extra": 1, "n,p,v": 2, "v,n": 1}
    out = read_csv_by_name(spark, str(tmp_path)).select("n", "p", "v", "extra")
    assert sorted(out.collect(), key=str) == [
        ("1", "2", "3", None), ("10", None, "30", None), ("4", "5", "6", None)
    ]


def test_header_of_a_file_read_in_many_splits(spark, conf, tmp_path):
    conf("spark.sql.files.maxPartitionBytes", "4096b")
    conf("spark.sql.files.minPartitionNum", "16")
    (tmp_path / "big.csv").write_text("n,v\n" + "\n".join(f"{i},{i * 2}" for i in range(20_000)) + "\n")
    (tmp_path / "small.csv").write_text("v,n\n1,2\n")
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    assert sorted(csv_header_groups(spark, str(tmp_path))) == ["n,v", "v,n"]
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before
    out = read_csv_by_name(spark, str(tmp_path))
    assert out.count() == 20_001
    assert out.where("cast(v as int) != 2 * cast(n as int)").collect() == [("2", "1")]


def test_no_csv_files_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_csv_by_name(spark, str(tmp_path))


def test_pretty_json_needs_multiline(spark, tmp_path):
    dictionary = {"btcusd": ["kraken", "bisq"], "btcbrl": [], "btcchf": ["kraken"]}
    (tmp_path / "pairs.json").write_text(json.dumps(dictionary, indent=4))
    assert read_json(spark, str(tmp_path)).columns == ["_corrupt_record"]
    wide = read_json(spark, str(tmp_path), multiline=True)
    assert wide.first().btcusd == ["kraken", "bisq"]
    entries = read_dictionary(spark, str(tmp_path))
    assert sorted(dictionary_sizes(entries, "entries").collect()) == [
        ("btcbrl", 0), ("btcchf", 1), ("btcusd", 2)
    ]
    assert sorted(dictionary_rows(entries, "entries").collect(), key=str) == [
        ("btcbrl", None), ("btcchf", "kraken"), ("btcusd", "bisq"), ("btcusd", "kraken")
    ]


def test_dictionary_documents_are_bounded_under_a_hot_key(spark, tmp_path):
    rows = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"),
        F.col("id").cast("string").alias("v"),
    )
    write_dictionaries(rows, str(tmp_path / "d"), "k", "v", rows_per_document=50)
    documents = [json.loads(p.read_text()) for p in data_files(tmp_path / "d")]
    assert len(documents) >= 20
    assert max(sum(map(len, d["entries"].values())) for d in documents) <= 50
    assert sum(len(d["entries"].get("hot", [])) for d in documents) == 334


def test_price_type_does_not_depend_on_the_file(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"p": 1}\n')
    (tmp_path / "b.json").write_text('{"p": 1.5}\n')
    assert read_json(spark, str(tmp_path / "a.json")).dtypes == [("p", "bigint")]
    assert sorted(read_json(spark, str(tmp_path), "p double").collect()) == [(1.0,), (1.5,)]


def test_stray_files_are_left_alone(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"p": 1}\n')
    (tmp_path / "a.csv").write_text("p\n7\n")
    assert read_json(spark, str(tmp_path), "p int").collect() == [(1,)]


def test_provenance_and_listing(spark, tmp_path):
    for name in ("kraken", "bisq"):
        (tmp_path / f"{name}.json").write_text('{"p": 1}\n')
        os.utime(tmp_path / f"{name}.json", (1699164000, 1699164000))
    rows = with_provenance(read_json(spark, str(tmp_path), "p int"), "json")
    assert sorted(r.source_key for r in rows.collect()) == ["bisq", "kraken"]
    assert rows.first().datetime == datetime.datetime(2023, 11, 5, 6, 0)
    files = list_files(spark, str(tmp_path), "*.json")
    assert sorted(r.file_name for r in files.collect()) == ["bisq.json", "kraken.json"]
    assert files.first().bytes == 9


def test_partition_overwrite_replaces_only_what_is_given(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    write_partitioned(first, path, "k")
    write_partitioned(first.where("k = 'a'").withColumn("v", F.lit(2)), path, "k")
    write_partitioned(first.where("k = 'a'").withColumn("v", F.lit(2)), path, "k")
    assert sorted(spark.read.parquet(path).select("k", "v").collect()) == [("a", 2), ("b", 1)]


def test_hot_partition_is_written_by_many_tasks(spark, conf, tmp_path):
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "40000b")
    rows = spark.range(0, 60_000, 1, 8).select(
        "id", F.sha2(F.col("id").cast("string"), 256).alias("text"),
        F.when(F.col("id") % 3 == 0, F.col("id") % 7).otherwise(99).alias("k"),
    )
    write_partitioned(rows, str(tmp_path / "t"), "k")
    assert len(data_files(tmp_path / "t" / "k=99")) > 3
    assert spark.read.parquet(str(tmp_path / "t")).count() == 60_000


def test_partition_filter_prunes_folders(spark, tmp_path, plan):
    rows = spark.createDataFrame([("ABR", 1.0), ("JFK", 2.0)], "ORIGIN string, d double")
    write_partitioned(rows, str(tmp_path / "t"), "ORIGIN")
    one = read_partition(spark, str(tmp_path / "t"), ORIGIN="ABR")
    assert one.select("ORIGIN", "d").collect() == [("ABR", 1.0)]
    assert "PartitionFilters: [isnotnull(ORIGIN" in plan(one) and "= ABR" in plan(one)
    assert "ORIGIN" not in spark.read.parquet(str(tmp_path / "t" / "ORIGIN=ABR")).columns


def test_landing_twice_keeps_one_set_per_key(spark, tmp_path):
    path = str(tmp_path / "raw")
    land_json(spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int"), path, "k")
    land_json(spark.createDataFrame([("b", 2)], "k string, v int"), path, "k")
    assert sorted(read_json(spark, path, "k string, v int").select("k", "v").collect()) == [
        ("a", 1), ("b", 2)
    ]


def test_csv_folder_is_not_overwritten_by_default(spark, tmp_path):
    df = spark.range(3)
    write_csv(df, str(tmp_path / "out"))
    with pytest.raises(AnalysisException):
        write_csv(df, str(tmp_path / "out"))
    assert read_csv(spark, str(tmp_path / "out"), header=False).columns == ["_c0"]


def test_csv_export_per_key(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    write_partitioned(df, str(tmp_path / "out"), "k", fmt="csv", header=True)
    assert (tmp_path / "out" / "k=a").is_dir()
    assert sorted(read_csv(spark, str(tmp_path / "out")).collect()) == [("1", "a"), ("2", "b")]


def test_report_is_one_file_in_order(spark, tmp_path):
    path = str(tmp_path / "report")
    df = spark.createDataFrame([("b, c", 2), ("a", 2), ("z", 9), ("q", 1)], "title string, n int")
    for _ in range(2):
        write_report(df, path, [F.desc("n"), F.asc("title")], 3)
    files = data_files(path)
    assert len(files) == 1
    assert files[0].read_text().splitlines() == ["title,n", "z,9", "a,2", '"b, c",2']


def test_empty_frame_does_not_replace_a_table(spark, tmp_path):
    path = str(tmp_path / "gold")
    replace_table(spark.range(2), path)
    with pytest.raises(ValueError):
        replace_table(spark.range(0), path)
    assert spark.read.parquet(path).count() == 2


def test_schema_rows_and_preview(spark):
    df = spark.createDataFrame([(1, (2.0, "x"))], "a int, result struct<p:double,q:string>")
    assert schema_rows(df).collect()[0] == (0, "a", "int", True)
    assert [r.name for r in schema_rows(df, "result").collect()] == ["p", "q"]
    assert preview(spark.range(50)).count() == 20


def test_layer_paths():
    lake = Lake("/lake/")
    assert lake.raw("x") == "/lake/raw/x" and lake.gold("y") == "/lake/gold/y"
    with pytest.raises(ValueError):
        lake.path("bronze", "x")


def test_scratch_comes_from_the_session(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_scratch_is_refused_on_a_cluster_without_a_shared_folder():
    class Conf:
        def get(self, name, default):
            return default

    class Cluster:
        conf = Conf()
        sparkContext = type("Context", (), {"master": "yarn", "applicationId": "a"})()

    with pytest.raises(RuntimeError):
        scratch_root(Cluster())


def test_object_store_options_take_keys_from_the_environment(monkeypatch):
    monkeypatch.setenv("AWS_ACCESS_KEY_ID", "id")
    monkeypatch.setenv("AWS_SECRET_ACCESS_KEY", "secret")
    monkeypatch.delenv("AWS_SESSION_TOKEN", raising=False)
    options = s3a_options("http://store:9000", ssl=False, proxy_port=9000)
    assert options["spark.hadoop.fs.s3a.access.key"] == "id"
    assert options["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert options["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert options["spark.hadoop.fs.s3a.proxy.port"] == "9000"
    assert "spark.hadoop.fs.s3a.session.token" not in options


def test_csv_text_survives(spark, tmp_path):
    texts = ['say "hi", you', "a\nb", " blanks ", "back\\slash", "", None, "a,b", "''", '"']
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    write_csv(df, str(tmp_path / "out"), header=True)
    rows = read_csv(spark, str(tmp_path / "out"), schema="i int, t string").orderBy("i").collect()
    # CSV has one form for both: an empty text reads back as NULL.
    assert [r.t for r in rows] == [t or None for t in texts]


def test_keys_in_folder_names_stay_text(spark, tmp_path):
    df = spark.createDataFrame([("007", 1)], "k string, v int")
    write_partitioned(df, str(tmp_path / "p"), "k")
    assert read_partition(spark, str(tmp_path / "p"), k="007").collect() == [(1, "007")]
    write_partitioned(df, str(tmp_path / "c"), "k", fmt="csv", header=True)
    assert read_csv(spark, str(tmp_path / "c")).collect() == [("1", "007")]


def test_large_plain_csv_files_are_split_and_others_are_not(spark, tmp_path, conf):
    """Each file is looked through; a value with a line break keeps its file in one task."""
    rows = [f'{i},"text {i}, ""quoted""",{i / 2}' for i in range(3000)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "plain.csv").write_text("n,note,x\n" + "\n".join(rows) + "\n")
    (tmp_path / "in" / "broken.csv").write_text("n,note,x\n" + "\n".join(rows) + '\n3000,"two\nlines",1.0\n')
    (tmp_path / "in" / "small.csv").write_text('n,note,x\n3001,"a\nb",2.0\n')
    path = str(tmp_path / "in")
    assert read_csv(spark, path).rdd.getNumPartitions() <= 3
    whole = sorted(map(tuple, read_csv(spark, path).collect()))
    conf("spark.sql.files.maxPartitionBytes", "16k")
    plain, rest = plain_files(spark, path)
    assert [f.rsplit("/", 1)[1] for f in plain] == ["plain.csv"] and len(rest) == 2
    split = read_csv(spark, path)
    assert split.rdd.getNumPartitions() > 5
    assert sorted(map(tuple, split.collect())) == whole and len(whole) == 6002
    typed = read_csv(spark, path, schema="x double, n int, note string")
    assert typed.where("n >= 3000").orderBy("n").collect() == [(1.0, 3000, "two\nlines"), (2.0, 3001, "a\nb")]
    assert read_csv(spark, path, infer=True).count() == 6002
    assert read_csv(spark, f"{path}/pl*.csv", header=False).count() == 3001
    assert read_csv(spark, path, multiLine=False).count() > 6002


def test_split_csv_keeps_folder_columns(spark, tmp_path, conf):
    conf("spark.sql.files.maxPartitionBytes", "4k")
    rows = spark.range(2000).selectExpr("id", "concat('0', id % 2) as k", "'a,b' as note")
    write_partitioned(rows, str(tmp_path / "t"), "k", fmt="csv", header=True)
    found = read_csv(spark, str(tmp_path / "t"), schema="id long, k string, note string")
    assert found.groupBy("k").count().orderBy("k").collect() == [("00", 1000), ("01", 1000)]
    assert found.rdd.getNumPartitions() > 2 and found.first()["note"] == "a,b"
