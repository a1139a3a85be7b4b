"""Records of CSV files whose quoted fields may hold line breaks, read in splits.

The text source cuts a large file into splits of whole lines.  Whether a line
begins a record depends on whether a quoted field is open before it, and so on
all text before the split.  One pass asks every split for both cases: from
either state, the state it ends in, and whether it was ever outside quotes.
These two answers a split (a row each) are chained in file order, which gives
every split its true first state.  Then the splits cut their lines into
records on their own; a record that goes over a border is put together from
the pieces of the splits it touches.

Lines without a quote change nothing, so the first pass sends only lines with
quotes to Python.  When no field is open at the end of any line, every line is
a record and Spark's line-wise CSV reader does the rest.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.schemas import all_strings

OPTIONS = {"mode": "PERMISSIVE", "escape": '"'}


def open_after(line: str, inside: bool) -> bool:
    """Whether a quoted field is open at the end of a line (comma separated,
    quotes doubled inside quotes) that begins inside one or not."""
    at = 0
    while True:
        if inside:
            at = line.find('"', at)
            while at >= 0 and line.startswith('"', at + 1):
                at = line.find('"', at + 2)
            if at < 0:
                return True
            at = line.find(",", at + 1)                      # what follows a closing quote belongs to the field
            if at < 0:
                return False
            at += 1
        if line.startswith('"', at):
            at += 1
        else:
            at = line.find(',"', at)
            if at < 0:
                return False
            at += 2
        inside = True


def _lines(spark: SparkSession, path) -> DataFrame:
    return spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"))


def _answers(batches):
    """Per split: the state after it and whether it was ever outside, from outside (0) and inside (1)."""
    split = None

    def answer():
        return pa.RecordBatch.from_arrays([pa.array([c]) for c in (*split, *state, outside, multi)],
                                          names=["file", "block", "after0", "after1", "outside1", "multi"])
    for b in batches:
        for file, block, line in zip(*(b.column(c).to_pylist() for c in ("file", "block", "value"))):
            if (file, block) != split:
                if split is not None:
                    yield answer()
                split, state, outside, multi = (file, block), [False, True], False, False
            state = [open_after(line, s) for s in state]
            outside |= not state[1]
            multi |= state[0] or not line.strip()
    if split is not None:
        yield answer()


def _first_states(answers: list) -> tuple[dict, set]:
    """Splits that begin inside a field -> the split where that record begins; splits that end inside one."""
    begins, ends, state, last_file, owner = {}, set(), False, None, None
    for file, block, after0, after1, outside1, _ in sorted(answers):
        if file != last_file:
            state, last_file, owner = False, file, None
        if state:
            begins[file, block] = owner
        if not state or outside1:
            owner = block
        state = after1 if state else after0
        if state:
            ends.add((file, block))
    return begins, ends


RECORD = "file string, block long, row long, value string"
PIECE = "file string, owner long, block long, row long, value string"


def _cut(begins, borders_only):
    """Records that lie whole in their split; or, of the others, the pieces
    (the row of a piece of the header is -1)."""
    names = ["file", "owner", "block", "row", "value"] if borders_only else ["file", "block", "row", "value"]
    types = [pa.string()] + [pa.int64()] * (len(names) - 2) + [pa.string()]

    def run(batches):
        split, held, out = None, [], []
        inside, owner, header = False, None, False

        def close(ended):
            """The held lines are a record, or a piece of one that begins in ``owner``."""
            nonlocal header
            text = "\n".join(line for _, line in held)
            if not held or not text and ended and owner == split[1]:
                held.clear()                                 # an empty line is no record
                return
            if owner == split[1] and ended:
                if not borders_only and not header:
                    out.append((*split, held[0][0], text))
            elif borders_only:
                out.append((split[0], owner, split[1], -1 if header else held[0][0], text))
            header = False
            held.clear()

        def batch():
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
            out.clear()
            return made
        for b in batches:
            for file, block, row, line in zip(*(b.column(c).to_pylist() for c in ("file", "block", "row", "value"))):
                if (file, block) != split:
                    close(False)
                    split, inside = (file, block), (file, block) in begins
                    owner, header = begins.get(split, block), block == 0
                held.append((row, line))
                inside = open_after(line, inside)
                if not inside:
                    close(True)
                    owner = block
            if out:
                yield batch()
        close(False)
        if out:
            yield batch()
    return run


def read_records(spark: SparkSession, path) -> DataFrame:
    """The columns of the header, as text, and ``_pos``: file, split and line a
    record begins in.  Files of one path share one header."""
    reader = spark.read.option("header", True).option("inferSchema", False).options(**OPTIONS)
    names = reader.option("multiLine", True).csv(path).columns
    lines = _lines(spark, path)
    telling = F.contains("value", F.lit('"')) | (F.col("value").rlike(r"^\s+$"))
    answers = [tuple(r) for r in lines.where(telling).mapInArrow(
        _answers, "file string, block long, after0 boolean, after1 boolean, outside1 boolean, multi boolean").collect()]
    if not any(a[-1] for a in answers):
        rows = reader.option("multiLine", False).schema(all_strings(names)).csv(path)
        return rows.select(*names, F.struct(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row")).alias("_pos"))
    begins, ends = _first_states(answers)
    if begins.keys() | ends:
        # splits without a telling line pass an open record on: ask for all splits
        every = lines.select("file", "block").distinct().collect()
        known = {a[:2] for a in answers}
        answers += [(f, b, False, True, False, False) for f, b in every if (f, b) not in known]
        begins, ends = _first_states(answers)
    records = lines.mapInArrow(_cut(begins, False), RECORD)
    borders = sorted(begins.keys() | ends)
    if borders:
        wanted = F.broadcast(spark.createDataFrame(borders, "file string, block long"))     # at most a row per split
        pieces = lines.join(wanted, ["file", "block"], "left_semi").select("value", "file", "block", "row")
        pieces = pieces.mapInArrow(_cut(begins, True), PIECE).groupBy("file", "owner").agg(
            F.array_sort(F.collect_list(F.struct("block", "row", "value"))).alias("p"))
        records = records.unionByName(pieces.where("not (owner = 0 and p[0].row < 0)").select(
            "file", F.col("owner").alias("block"), F.expr("p[0].row").alias("row"),
            F.expr("array_join(transform(p, x -> x.value), '\n')").alias("value")))
    quoted = [n.replace("`", "``") for n in names]
    parsed = F.from_csv("value", ", ".join(f"`{n}` string" for n in quoted), OPTIONS).alias("r")
    return records.select(parsed, F.struct("file", "block", "row").alias("_pos")).select("r.*", "_pos")
