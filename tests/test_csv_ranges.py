"""Reading quoted line breaks by byte ranges, against Spark's one-task reader."""

import random

import pytest
from pyspark.sql import functions as F

from parcelwise.schemas import RAW_TABLES
from parcelwise.sources import csv_ranges, files

SPEC = RAW_TABLES["order_reviews"]
HEADER = ",".join(SPEC.columns)


@pytest.fixture
def tiny_ranges(spark):
    """Many byte ranges for a small file."""

    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield use
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def serial(spark, path):
    return files._serial_reader(spark, SPEC).csv(path)


def same(spark, path):
    found, expected = files.read_text_csv(spark, path, SPEC), serial(spark, path)
    assert found.columns == expected.columns
    a, b = (sorted(map(tuple, rows.collect()), key=str) for rows in (found, expected))
    assert a == b
    return a


def whole_files(spark, path):
    return csv_ranges.records(spark, path, lambda rows: files._stored(rows, "ranges"))[1]


def field(pick):
    kind = pick.randrange(6)
    plain = "".join(pick.choice("abc é") for _ in range(pick.randrange(8)))
    if kind < 2:
        return plain
    inner = "".join(pick.choice(['""', "\n", "\r\n", ",", "x", "ü ", "\n\n", "NA"]) for _ in range(pick.randrange(12)))
    return f'"{inner}"'


def written(path, rows, end="\n", last=True):
    text = end.join([HEADER, *[",".join(r) for r in rows]]) + (end if last else "")
    path.write_bytes(text.encode())
    return str(path)


@pytest.mark.parametrize("size", [90, 400, 4000])
def test_random_files(spark, tmp_path, tiny_ranges, size):
    tiny_ranges(size)
    for seed in range(2):
        pick = random.Random(seed)
        rows = [[f"r{k}", *[field(pick) for _ in range(len(SPEC.columns) - 1)]] for k in range(25)]
        path = written(tmp_path / f"{seed}.csv", rows, last=seed != 1)
        assert files.read_text_csv(spark, path, SPEC).rdd.getNumPartitions() > 1 or size == 4000
        assert whole_files(spark, path) == []
        assert len(same(spark, path)) == 25


def test_line_ends_of_two_characters(spark, tmp_path, tiny_ranges):
    tiny_ranges(200)
    rows = [[f"r{k}", "o", "5", '"a ""b"""', f'"one\r\ntwo {k}\r\n"', "x", "y"] for k in range(30)]
    found = same(spark, written(tmp_path / "crlf.csv", rows, "\r\n"))
    assert ("r7", "o", "5", 'a "b"', "one\ntwo 7\n", "x", "y") in found


def test_a_record_over_many_ranges(spark, tmp_path, tiny_ranges):
    tiny_ranges(64)
    long = "\n".join(f"line {k}" for k in range(120))
    rows = [["r1", "o", "1", "", f'"{long}"', "x", ""], ["r2", "o", "1", '"\n\n\n"', "", "", ""], ["r3", "o", "1", "", f'"{long}"', "", "z"]]
    found = same(spark, written(tmp_path / "long.csv", rows))
    assert {r[0] for r in found} == {"r1", "r2", "r3"} and found[0][4] == long


@pytest.mark.parametrize("odd", ['5" wide', '"a"b', 'x""y', '"open'])
def test_quotes_out_of_place_are_read_whole(spark, tmp_path, tiny_ranges, odd):
    tiny_ranges(64)
    rows = [[f"r{k}", "o", "5", "t", '"m\nn"', "x", "y"] for k in range(20)]
    rows.insert(9, ["odd", "o", "5", odd, "m", "x", "y"])
    bad, good = written(tmp_path / "bad.csv", rows), written(tmp_path / "good.csv", rows[:9])
    assert [p.rsplit("/", 1)[1] for p in whole_files(spark, [bad, good])] == ["bad.csv"]
    if odd != '"open':  # the one-task reader tears its rows apart
        assert len(same(spark, [bad, good])) == 30


def test_pieces_that_are_too_long_are_read_whole(spark, tmp_path, tiny_ranges):
    tiny_ranges(2_000_000)
    spark.conf.set("spark.sql.files.openCostInBytes", "2000000")  # else a small file is cut into a range for each core
    rows = [["r1", "o", "1", "", '"' + "\n".join(["x" * 100] * 30_000) + '"', "x", ""], ["r2", "o", "1", "", "", "", ""]]
    path = written(tmp_path / "huge.csv", rows)
    assert len(whole_files(spark, path)) == 1
    assert [r[0] for r in same(spark, path)] == ["r1", "r2"]


def test_empty_files_and_lines(spark, tmp_path, tiny_ranges):
    tiny_ranges(64)
    (tmp_path / "header.csv").write_text(HEADER + "\n")
    (tmp_path / "nothing.csv").write_text("")
    body = "r1,o,5,,,,\n\n\nr2,o,5,,,,\n\n"
    (tmp_path / "lines.csv").write_text(f"{HEADER}\n{body}")
    assert [r[0] for r in same(spark, str(tmp_path))] == ["r1", "r2"]


def test_torn_rows_abort(spark, tmp_path):
    path = written(tmp_path / "torn.csv", [["r1", "o", "5", "", "", "", ""], ["r2", "o"]])
    with pytest.raises(Exception, match="MALFORMED"):
        files.read_text_csv(spark, path, SPEC).collect()


def test_bytes_that_are_no_text(spark, tmp_path, tiny_ranges):
    tiny_ranges(64)
    path = tmp_path / "bytes.csv"
    path.write_bytes(HEADER.encode() + b'\nr1,o,5,caf\xe9,"a\nb\xff",x,y\n')
    assert same(spark, str(path))[0][3] == "caf�"


def test_one_file_is_read_by_many_tasks(spark, tmp_path, tiny_ranges):
    rows = [[f"r{k}", "o", "5", "", f'"first\nsecond, ""{k}"""', "x", "y"] for k in range(40_000)]
    path = written(tmp_path / "many.csv", rows)
    tiny_ranges(100_000)
    found = files.read_text_csv(spark, path, SPEC)
    tasks = found.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    assert len(tasks) >= 10 and max(r["count"] for r in tasks) < 10_000
    assert sum(r["count"] for r in tasks) == 40_000
    assert found.where("review_comment_message not like 'first\nsecond, \"%\"'").isEmpty()
