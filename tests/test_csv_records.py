"""CSV records over split borders against Spark's own whole-file reader."""

import random

import pytest

from ordermill.sources.csv_records import open_after, read_records

CELLS = ["1", "", "abc", "a b", '"q"', '"a,b"', '"line\nbreak"', '"two\n\nbreaks, and ""quotes"""', '""', '5" pipe', ' "x"',
         '"open ""\n"" twice"', '"' + "long\n" * 30 + '"', '"end\n",2', "é中", '"tail"rest', '"\n"']


def _file(path, seed, cells, rows=60, header="id,name,note", end="\n"):
    rnd = random.Random(seed)
    lines = [header] + [",".join(rnd.choice(cells) for _ in range(3)) for _ in range(rows)]
    lines += rnd.choice([[], ["", ""], [" ", "7,8"]])
    with open(path, "w", newline="") as f:
        f.write(end.join(lines) + rnd.choice(["", end]))


@pytest.fixture()
def small_splits(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda size: [spark.conf.set(k, v) for k, v in zip(kept, (str(size), "0"))]
    for k, v in kept.items():
        spark.conf.set(k, v)


def _whole(spark, path):
    df = (spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path))
    return df.columns, sorted(map(str, map(tuple, df.collect())))


@pytest.mark.parametrize("seed", range(6))
def test_same_rows_as_one_task_reads(spark, tmp, small_splits, seed):
    cells = CELLS if seed % 3 else CELLS[:6]
    _file(f"{tmp}/a.csv", seed, cells, end="\r\n" if seed == 4 else "\n")
    _file(f"{tmp}/b.csv", seed + 100, cells)
    want = _whole(spark, f"{tmp}/*.csv")
    for size in (23, 64, 400, 1 << 20):
        small_splits(size)
        got = read_records(spark, f"{tmp}/*.csv")
        assert (got.columns[:-1], sorted(str(tuple(r)[:-1]) for r in got.collect())) == want
        assert size > 400 or got.rdd.getNumPartitions() > 4
        first = [r["id"] for r in read_records(spark, f"{tmp}/a.csv").orderBy("_pos").collect()]
        assert first == [r["id"] for r in spark.read.option("header", True).option("escape", '"')
                         .option("multiLine", True).csv(f"{tmp}/a.csv").collect()]


def test_header_over_a_border_and_only_a_header(spark, tmp, small_splits):
    with open(f"{tmp}/h.csv", "w") as f:
        f.write('id,"long\nname","n ""o""\nte"\n1,2,"x\ny"\n')
    with open(f"{tmp}/e.csv", "w") as f:
        f.write("id,name\n")
    for size in (5, 9, 1000):
        small_splits(size)
        got = read_records(spark, f"{tmp}/h.csv")
        assert got.columns[:3] == ["id", "long\nname", 'n "o"\nte'] and [tuple(r)[:3] for r in got.collect()] == [("1", "2", "x\ny")]
        assert read_records(spark, f"{tmp}/e.csv").count() == 0


def test_open_after():
    assert [open_after(x, False) for x in ['a,"b', 'a,"b"', '"a""', '"a"""', 'a"b', '"a"b,"', 'a,"b",c,"d']] == [
        True, False, True, False, False, True, True]
    assert [open_after(x, True) for x in ["", 'a"', 'a""', '",b', '","', 'x",y,"z"']] == [True, False, True, False, True, False]
