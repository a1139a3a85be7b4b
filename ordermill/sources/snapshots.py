"""Snapshot tables: parquet folders whose every version stays whole.

A table is a root folder with

    data/<partition>/_commit=<n>-<id>/     rows, never changed once written
    index/<partition>/_commit=<n>-<id>/    a 64-bit digest of each row's key, sorted
    _snapshots/<n>.json                    a version: declaration and list of live folders

A writer adds folders under a commit name of its own and then creates the next
version file by one rename that fails when another writer was first.  Until
then no reader knows the folders, so a reader sees the old table or the new
one, a run lost at any step leaves the old one, and a version that is being
read stays as it is until ``expire`` removes it.

The declaration (columns, NOT NULL marks, keys, partition column) is stored
with the table: every writer is held to it, whatever it knows itself.

An upsert finds the partitions that hold one of its keys by joining its key
digests with the index, reads only those and the ones it adds rows to, and
replaces only them.  A digest that two keys share costs a partition read in vain.

A stream appends its micro-batches under its run's name and batch number, which
the version file notes: a replayed batch is known and adds nothing, even when its
files have been merged with others since.  Appends that meet another writer try
again on the new version.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ordermill.operators.dedup import dedup, duplicate_keys
from ordermill.operators.upsert import upsert
from ordermill.sources.files import delete_folder, enforce_not_null, file_system, partition_folder, table_exists


class ConcurrentWrite(RuntimeError):
    """Another writer created the version first; nothing of this write is seen."""


def key_digest(keys: list[str]) -> Column:
    """64-bit digest of a key; null when a part of it is."""
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return F.when(whole, F.xxhash64(*keys))


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # -- versions -----------------------------------------------------------------
    def versions(self) -> list[int]:
        fs, folder = file_system(self.spark, f"{self.path}/_snapshots")
        if not fs.exists(folder):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def exists(self) -> bool:
        return bool(self.versions())

    def snapshot(self, version: int | None = None) -> dict:
        """version, schema, keys, partition_by, folders of a version (the last one)."""
        version = self.versions()[-1] if version is None else version
        fs, file = file_system(self.spark, f"{self.path}/_snapshots/{version:020d}.json")
        stream = fs.open(file)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        state = json.loads(text)
        return state | {"schema": StructType.fromJson(state["schema"])}

    def _commit(self, state: dict) -> None:
        """Make ``state`` the next version, or fail when there is one already."""
        jvm, gateway = self.spark.sparkContext._jvm, self.spark.sparkContext._gateway
        folder = f"{self.path}/_snapshots"
        fs, draft = file_system(self.spark, f"{folder}/draft-{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps(state | {"schema": state["schema"].jsonValue()}).encode()))
        finally:
            out.close()
        final = jvm.org.apache.hadoop.fs.Path(f"{folder}/{state['version']:020d}.json")
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            draft.toUri() if draft.toUri().getScheme() else fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        try:                                                 # without the overwrite option
            context.rename(draft, final, gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0))
        except Exception as e:
            fs.delete(draft, False)
            if fs.exists(final):
                raise ConcurrentWrite(f"{self.path} has a version {state['version']} already") from e
            raise

    # -- declaration -------------------------------------------------------------------
    def create(self, schema: StructType, keys: list[str] = (), partition_by: list[str] = ()) -> bool:
        """Declare the table, empty.  False when it is there already."""
        if self.exists():
            return False
        missing = {*keys, *partition_by} - set(schema.names)
        if missing:
            raise ValueError(f"no such columns: {sorted(missing)}")
        self._commit({"version": 0, "schema": schema, "keys": list(keys), "partition_by": list(partition_by), "folders": []})
        return True

    def evolve(self, schema: StructType) -> None:
        """Add columns: those there stay as they are, new ones may be null (old rows have none)."""
        state = self.snapshot()
        old = {f.name: f for f in state["schema"].fields}
        new = {f.name: f for f in schema.fields}
        for name, field in old.items():
            if name not in new or (new[name].dataType, new[name].nullable) != (field.dataType, field.nullable):
                raise ValueError(f"column {name} of {self.path} must stay as it is")
        added = [f for f in schema.fields if f.name not in old]
        if any(not f.nullable for f in added):
            raise ValueError("an added column must be nullable")
        self._commit(state | {"version": state["version"] + 1, "schema": StructType([*state["schema"].fields, *added])})

    def _declared(self, df: DataFrame, state: dict) -> DataFrame:
        """``df`` as the declaration has it; other columns or types that do not
        fit are an error, a null in a NOT NULL column fails the job."""
        schema = state["schema"]
        if set(df.columns) != set(schema.names):
            raise ValueError(f"{self.path} has the columns {schema.names}, its new rows {df.columns}")
        for f in schema.fields:
            given = df.schema[f.name].dataType
            if given != f.dataType and given.simpleString() != "void":
                raise ValueError(f"column {f.name} of {self.path} is {f.dataType.simpleString()}, not {given.simpleString()}")
        return enforce_not_null(df, schema)

    # -- reading -----------------------------------------------------------------------
    def _scan(self, kind: str, schema: StructType, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        base = f"{self.path}/{kind}"
        stored = StructType([*schema.fields, StructField("_commit", StringType())])
        return self.spark.read.schema(stored).option("basePath", base).parquet(
            *[f"{base}/{f}" for f in folders]).select(*schema.names)

    def read(self, version: int | None = None) -> DataFrame:
        state = self.snapshot(version)
        return self._scan("data", state["schema"], state["folders"])

    def _index(self, state: dict, folders: list[str]) -> DataFrame:
        parts = [state["schema"][c] for c in state["partition_by"]]
        return self._scan("index", StructType([StructField("digest", LongType()), *parts]), folders)

    # -- writing -----------------------------------------------------------------------
    def _write(self, df: DataFrame, state: dict, tag: str) -> list[str]:
        """Write rows and their key index under the commit's name; its folders."""
        parts = state["partition_by"]
        rows = df.hint("rebalance", *parts) if parts else df
        rows.withColumn("_commit", F.lit(tag)).write.mode("append").partitionBy(*parts, "_commit").parquet(f"{self.path}/data")
        folders = self._folders(tag, parts)
        if state["keys"]:
            digests = (self._scan("data", state["schema"], folders)
                       .select(key_digest(state["keys"]).alias("digest"), *parts, F.lit(tag).alias("_commit")))
            (digests.sortWithinPartitions(*parts, "digest").write.mode("append")
             .partitionBy(*parts, "_commit").parquet(f"{self.path}/index"))
        return folders

    def _folders(self, tag: str, parts: list[str], kind: str = "data") -> list[str]:
        fs, pattern = file_system(self.spark, f"{self.path}/{kind}/{'*/' * len(parts)}_commit={tag}")
        found = fs.globStatus(pattern) or []
        depth = len(parts) + 1
        return sorted("/".join(f.getPath().toString().split("/")[-depth:]) for f in found)

    def _next(self, state: dict) -> str:
        return f"{state['version'] + 1:08d}-{uuid.uuid4().hex[:12]}"

    def overwrite(self, df: DataFrame, schema: StructType | None = None) -> int:
        """Replace all rows, and the declared columns where a ``schema`` is given."""
        state = self.snapshot()
        if schema is not None:
            state = state | {"schema": schema}
        folders = self._write(self._declared(df, state), state, self._next(state))
        return self._switch(state, folders)

    def append(self, df: DataFrame, batch: tuple[str, int] | None = None, folders_at_most: int | None = None) -> int:
        """Add rows.  ``batch`` (run, number): a batch of the run that is not newer
        than its last one adds nothing.  ``folders_at_most``: partitions that come
        to hold more folders than this are merged afterwards."""
        state = self.snapshot()
        if batch and state.get("batches", {}).get(batch[0], -1) >= batch[1]:
            return state["version"]
        folders = self._write(self._declared(df, state), state, self._next(state))
        while True:
            more = {"batches": state.get("batches", {}) | {batch[0]: batch[1]}} if batch else {}
            try:
                version = self._switch(state | more, state["folders"] + folders)
                break
            except ConcurrentWrite:                          # rows are only added: they fit the newer version as well
                state = self.snapshot()
        return version if folders_at_most is None else self.compact(folders_at_most)

    def compact(self, folders_at_most: int) -> int:
        """Merge the folders of partitions that hold more than so many into one."""
        state = self.snapshot()
        of_partition = {}
        for f in state["folders"]:
            of_partition.setdefault(f.rpartition("/")[0], []).append(f)
        crowded = [f for fs in of_partition.values() if len(fs) > folders_at_most for f in fs]
        if not crowded:
            return state["version"]
        try:
            return self._replace(state, crowded, self._scan("data", state["schema"], crowded))
        except ConcurrentWrite:
            return self.snapshot()["version"]                # the next batch tries again

    def _replace(self, state: dict, old: list[str], rows: DataFrame, **more) -> int:
        """Put ``rows`` in the place of the folders ``old``."""
        folders = self._write(rows, state, self._next(state))
        return self._switch(state | more, [f for f in state["folders"] if f not in set(old)] + folders)

    def _switch(self, state: dict, folders: list[str]) -> int:
        self._commit(state | {"version": state["version"] + 1, "folders": sorted(folders)})
        return state["version"] + 1

    def touched(self, source: DataFrame, state: dict) -> list[str]:
        """Live folders of the partitions that hold a key of ``source`` or receive its rows."""
        parts = state["partition_by"]
        if not parts:
            return list(state["folders"])
        wanted = source.na.drop(subset=state["keys"]).select(key_digest(state["keys"]).alias("digest")).distinct()
        held = self._index(state, state["folders"]).join(wanted, "digest", "left_semi").select(*parts)
        values = held.union(source.select(*parts)).distinct().collect()      # metadata: a row per partition
        prefixes = {partition_folder(self.spark, parts, v) for v in values}
        return [f for f in state["folders"] if f.rpartition("/")[0] in prefixes]

    def upsert(self, source: DataFrame) -> int:
        """MERGE by the declared keys: matched rows are replaced (wherever they
        are), new ones inserted.  A key that the source holds more than once is
        an error; null keys match nothing.  The source is evaluated once."""
        state = self.snapshot()
        keys, tag = state["keys"], self._next(state)
        if not keys:
            raise ValueError(f"{self.path} has no keys")
        staging = f"{self.path}/_staging/{tag}"
        self._declared(source, state).write.parquet(staging)
        source = self.spark.read.schema(state["schema"]).parquet(staging)
        twice = duplicate_keys(source.na.drop(subset=keys).select(*keys), keys).limit(1).collect()
        if twice:
            delete_folder(self.spark, staging)
            raise ValueError(f"key {tuple(twice[0][:-1])} occurs more than once in the rows for {self.path}")
        touched = self.touched(source, state)
        merged = upsert(self._scan("data", state["schema"], touched), source, keys)
        folders = self._write(merged, state, tag)
        version = self._switch(state, [f for f in state["folders"] if f not in set(touched)] + folders)
        delete_folder(self.spark, staging)
        return version

    def insert_new(self, source: DataFrame) -> int:
        """MERGE ... WHEN NOT MATCHED INSERT: the rows whose key is not there yet;
        the keys are compared by rows of the partitions whose index has a digest of theirs."""
        state = self.snapshot()
        tag = self._next(state)
        staging = f"{self.path}/_staging/{tag}"
        self._declared(source, state).write.parquet(staging)
        source = self.spark.read.schema(state["schema"]).parquet(staging)
        held = self._scan("data", state["schema"], self.touched(source, state)).select(*state["keys"]).distinct()
        folders = self._write(source.join(held, state["keys"], "left_anti").select(*state["schema"].names), state, tag)
        version = self._switch(state, state["folders"] + folders)
        delete_folder(self.spark, staging)
        return version

    # -- checks and upkeep ------------------------------------------------------------
    def _repeated(self, state: dict, before: set) -> tuple[DataFrame, list[str]]:
        """(key digests that occur more than once and are in a folder not in
        ``before``, live folders of the partitions that hold them)."""
        parts = state["partition_by"]
        new = self._index(state, [f for f in state["folders"] if f not in before]).select("digest").distinct()
        every = self._index(state, state["folders"]).join(new, "digest", "left_semi")
        twice = every.groupBy("digest").count().where("count > 1").select("digest")
        if not parts:
            return twice, list(state["folders"])
        held = every.join(twice, "digest", "left_semi").select(*parts).distinct().collect()   # metadata
        prefixes = {partition_folder(self.spark, parts, v) for v in held}
        return twice, [f for f in state["folders"] if f.rpartition("/")[0] in prefixes]

    def duplicates_since(self, version: int) -> DataFrame:
        """Keys that occur more than once and came (again) after ``version``, with
        their count: the digests of the new folders meet the index, and only
        partitions with a repeated digest are read."""
        state = self.snapshot()
        return self._repeated_keys(state, *self._repeated(state, set(self.snapshot(version)["folders"])))

    def _repeated_keys(self, state: dict, twice: DataFrame, folders: list[str]) -> DataFrame:
        rows = self._scan("data", state["schema"], folders).na.drop(subset=state["keys"])
        rows = rows.withColumn("digest", key_digest(state["keys"])).join(twice, "digest", "left_semi")
        return duplicate_keys(rows.select(*state["keys"]), state["keys"])

    def reconcile(self, order: list[str]) -> dict:
        """Of every key keep the row that is first by ``order``.  A run looks for
        keys among the folders added since the last one only, and reads and rewrites
        only the partitions that hold a repeated key."""
        state = self.snapshot()
        keys = state["keys"]
        twice, folders = self._repeated(state, set(state.get("reconciled", [])))
        # partitions without a later copy are read, to find the first one, and stay as they are
        repeated = self._repeated_keys(state, twice, folders)
        before = repeated.count()
        if before:
            rows = self._scan("data", state["schema"], folders)
            copies = rows.join(repeated.select(*keys), keys, "left_semi")
            rest = [c for c in state["schema"].names if c not in (*keys, *order)]
            kept = dedup(copies.select(*state["schema"].names), keys, order, keep="first", tie_break=rest)
            parts, one = state["partition_by"], F.lit(1)
            if parts:
                count = copies.select(*parts, one.alias("n")).unionByName(kept.select(*parts, (-one).alias("n")))
                losing = count.groupBy(*parts).agg(F.sum("n").alias("n")).where("n > 0").select(*parts).collect()   # metadata
                prefixes = {partition_folder(self.spark, parts, v) for v in losing}
                folders = [f for f in folders if f.rpartition("/")[0] in prefixes]
                wanted = self.spark.createDataFrame(losing, copies.select(*parts).schema)
                same = reduce(lambda a, b: a & b, [kept[c].eqNullSafe(wanted[c]) for c in parts])
                kept = kept.join(F.broadcast(wanted), same, "left_semi")
            others = self._scan("data", state["schema"], folders).join(repeated.select(*keys), keys, "left_anti")
            self._replace(state, folders, others.select(*state["schema"].names).unionByName(kept))
            state = self.snapshot()
        after = self._repeated_keys(state, *self._repeated(state, set(state.get("reconciled", [])))).count()
        self._switch(state | {"reconciled": state["folders"]}, state["folders"])
        return {"duplicate_keys_before": before, "duplicate_keys_after": after}

    def expire(self, keep: int = 2) -> list[str]:
        """Forget all but the last ``keep`` versions and remove the folders that
        none of those has.  A writer at work keeps its folders: its commit number
        is above the oldest version that is kept."""
        versions = self.versions()
        kept, gone = versions[-keep:], versions[:-keep]
        parts = self.snapshot()["partition_by"]
        live = {f for v in kept for f in self.snapshot(v)["folders"]}
        for v in gone:
            delete_folder(self.spark, f"{self.path}/_snapshots/{v:020d}.json")
        removed = []
        fs, staging = file_system(self.spark, f"{self.path}/_staging")
        for lost in fs.listStatus(staging) if fs.exists(staging) else ():    # of runs that ended before their switch
            if int(lost.getPath().getName().partition("-")[0]) <= kept[0]:
                fs.delete(lost.getPath(), True)
        for kind in ("data", "index"):
            for folder in self._folders("*", parts, kind):
                number = int(folder.rpartition("_commit=")[2].partition("-")[0])
                if folder not in live and number <= kept[0]:
                    delete_folder(self.spark, f"{self.path}/{kind}/{folder}")
                    removed.append(f"{kind}/{folder}")
        return removed


def is_snapshot_table(spark: SparkSession, path: str) -> bool:
    return table_exists(spark, f"{path.rstrip('/')}/_snapshots")
