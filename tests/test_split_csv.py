"""Records of several lines, split anywhere, against the reader that takes a file whole."""

import random

import pytest
from pyspark.sql import functions as F

from marketmill.contracts import DAMAGED
from marketmill.sources.raw_files import read_csv
from marketmill.sources.split_csv import read_split_csv

HEADER = "review_id,order_id,score,title,message"


def field(r):
    text = "".join(r.choice(["a", "é", "😀", " ", ",", '""', "\n", "\r\n", "word", "1"]) for _ in range(r.randint(0, 12)))
    return f'"{text}"' if r.random() < 0.5 or set(text) & set(',"\n\r') else text


def extract(seed, rows=60, end="\n"):
    r = random.Random(seed)
    lines = [f"r{k},o{k}," + ",".join(field(r) for _ in range(3)) for k in range(rows)]
    return HEADER + end + end.join(lines) + end


@pytest.fixture
def small_splits(spark):
    key, merge = "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)

    def set_to(size):
        spark.conf.set(key, str(size))
        spark.conf.set(merge, "false")  # which would make one partition of a few bytes each

    yield set_to
    spark.conf.set(key, before)
    spark.conf.set(merge, "true")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def both(spark, path):
    columns = read_csv(spark, path).columns
    split = read_split_csv(spark, path, columns, DAMAGED, "_from")
    return split, rows(split.drop("_from")), rows(read_csv(spark, path, True, DAMAGED))


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [7, 64, 1 << 20])
def test_any_split_equals_the_whole_read(spark, tmp_path, small_splits, end, size):
    path = tmp_path / "reviews.csv"
    path.write_bytes(extract(size, end=end).encode())
    small_splits(size)
    split, got, want = both(spark, str(path))
    assert got == want and len(got) == 60
    lines = spark.read.option("lineSep", "\n").text(str(path))
    if size == 64:  # one file, and its lines and records lie in many tasks
        assert lines.rdd.getNumPartitions() > 20
        assert split.select(F.spark_partition_id()).distinct().count() > 2


def test_a_break_at_every_split_boundary(spark, tmp_path, small_splits):
    """Each record is 32 bytes long, and its quoted break is at the end of its first 16."""
    path = tmp_path / "one.csv"
    line = lambda k: f'{k:05d},b,"xxxxxx\n{k:05d}yyyyyyyyy"\n'
    path.write_text("a,b,c" + " " * 26 + "\n" + "".join(line(k) for k in range(200)))
    assert len(line(1)) == 32
    small_splits(16)
    _, got, want = both(spark, str(path))
    assert got == want and len(got) == 200


def test_one_record_over_many_splits(spark, tmp_path, small_splits):
    path = tmp_path / "long.csv"
    path.write_text("a,b\n1,x\n2,\"" + "\n\n line, \"\"quoted\"\"" * 50 + "\"\n3,y\n\n4,z")
    small_splits(32)
    _, got, want = both(spark, str(path))
    assert got == want and len(got) == 4


def test_damage_is_marked_and_stays_where_it_is(spark, tmp_path, small_splits):
    path = tmp_path / "bad.csv"
    path.write_text('a,b\n1,x\n2\n3,"p\nq",r\n4,y\n')
    small_splits(8)
    _, got, want = both(spark, str(path))
    assert got == want and sum(r[2] is not None for r in got) == 2
    path.write_text('a,b\n1,x\n2,"never closed\n3,y\n4,z\n')
    got = rows(read_split_csv(spark, str(path), ["a", "b"], DAMAGED, "_from").drop("_from"))
    assert ("3", "y", None) in got and ("4", "z", None) in got and len(got) == 4


def test_part_files_each_with_a_header(spark, tmp_path, small_splits):
    folder = tmp_path / "parts.csv"
    folder.mkdir()
    for k in range(3):
        (folder / f"part-{k}.csv").write_bytes(extract(k, 20).encode())
    small_splits(50)
    split, got, want = both(spark, str(folder))
    assert got == want and len(got) == 60
    assert split.select("_from").distinct().count() == 3
    (folder / "part-9.csv").write_text("review_id,score,order_id,title,message\nr,1,o,t,m\n")
    split = read_split_csv(spark, str(folder), HEADER.split(","), DAMAGED, "_from")
    assert split.where(F.col(DAMAGED).isNotNull()).count() == 1  # a header of other columns


def test_empty_files(spark, tmp_path):
    path = tmp_path / "none.csv"
    path.write_text(HEADER + "\n")
    assert both(spark, str(path))[1] == []
