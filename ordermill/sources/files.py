"""File sources and table sinks.

Tables are parquet folders.  Writes that replace data they also read (an
upsert) first write their result whole to a pending folder beside the table,
then replace only the partitions they touch (dynamic partition overwrite) and
remove partitions that end up empty.  A job lost during the replacement is
finished from the pending folder by the next write to the table.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ordermill.operators.dedup import duplicate_keys
from ordermill.operators.upsert import upsert
from ordermill.sources.csv_records import read_records


# --- sources -----------------------------------------------------------------

def read_csv_strings(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Header CSV with every field as text (no inference), plus ``_pos``, the
    row's place in the input: (file, block offset, row id), which orders rows
    as they stand in their files.

    ``columns`` are found by their header names; a missing one is an error.
    Quoting follows RFC 4180 (doubled quotes, line breaks inside quotes), and a
    file is read by as many tasks as it has splits (see csv_records).  Files of
    one path share one header."""
    df = read_records(spark, path)
    if columns is None:
        return df
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}")
    return df.select(*columns, "_pos")


# --- file system helpers (Hadoop FileSystem of the session) ------------------------

def file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def table_exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """The table at ``path``, or None when it does not exist yet.  With its
    declared ``schema`` a table without any file reads as no rows; without
    one it counts as not there."""
    if not table_exists(spark, path):
        return None
    stored = _snapshots(spark, path)
    if stored is not None:
        table = stored.read()
        return table if schema is None else table.select(*schema.names)
    if schema is not None:
        return spark.read.schema(schema).parquet(path).select(*schema.names)
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise


def read_declared(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table at ``path`` in its declared schema; no rows when it is missing."""
    table = read_table(spark, path, schema)
    return spark.createDataFrame([], schema) if table is None else table


def enforce_not_null(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` in the declared columns and types; a null in a column declared
    NOT NULL fails the job that writes it."""
    def checked(f):
        c = F.col(f.name).cast(f.dataType)
        if not f.nullable:
            c = F.coalesce(c, F.raise_error(F.lit(f"null in NOT NULL column {f.name}")).cast(f.dataType))
        return c.alias(f.name)
    return df.select(*[checked(f) for f in schema.fields])


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def partition_folder(spark: SparkSession, columns: list[str], values) -> str:
    """Folder of a partition below its table, named as the writer names it."""
    names = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return "/".join(names.getPartitionPathString(c, None if v is None else str(v)) for c, v in zip(columns, values))


def _snapshots(spark: SparkSession, path: str):
    """The snapshot table at ``path``, or None for plain parquet folders."""
    from ordermill.sources.snapshots import SnapshotTable
    table = SnapshotTable(spark, path)
    return table if table.exists() else None


# --- sinks ---------------------------------------------------------------------------

def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                mode: str = "overwrite", replace: str = "static") -> None:
    """Write a table.  ``replace``: 'static' (an overwrite replaces the whole
    table) or 'dynamic' (only the partitions present in ``df``)."""
    if partition_by:
        # Rebalance on the partition columns: rows of one partition value land
        # in few files, and AQE splits a value too big for one task.
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode(mode).option("partitionOverwriteMode", replace)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def pending_folder(path: str) -> str:
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_pending_{name}"


def finish_replacement(spark: SparkSession, path: str, partition_by: list[str]) -> bool:
    """Carry out a replacement whose result lies whole in the pending folder
    (``rows``, and the touched partitions in ``touched``); doing it twice gives
    the same table.  A result that is not whole is thrown away: the table was
    not touched yet.  True when one was finished."""
    pending = pending_folder(path)
    whole = table_exists(spark, f"{pending}/rows/_SUCCESS")
    if whole:
        rows = spark.read.parquet(f"{pending}/rows")
        write_table(rows, path, partition_by, replace="dynamic" if partition_by else "static")
        if partition_by:
            left = rows.select(*partition_by).distinct()
            touched = spark.read.parquet(f"{pending}/touched")
            for gone in touched.exceptAll(left).collect():  # metadata: the emptied partitions
                delete_folder(spark, f"{path.rstrip('/')}/{partition_folder(spark, partition_by, gone)}")
    delete_folder(spark, pending)
    return whole


def upsert_table(spark: SparkSession, source: DataFrame, path: str, keys: list[str],
                 partition_by: str | None = None) -> None:
    """MERGE source INTO the table at ``path`` ON keys: matched rows are
    replaced (all columns), new rows inserted.  A key that the source holds
    more than once is an error, as in a MERGE; null keys match nothing.

    The source is evaluated once, into the pending folder.  Partitioned
    tables rewrite only the touched partitions: those that receive source
    rows and those that hold a matched row (a row that moves to another
    partition leaves no stale copy).  Partitions left empty are removed.  The
    touched-partition list is metadata (one value per partition), the only
    thing collected to the driver.
    """
    stored = _snapshots(spark, path)
    if stored is not None:
        stored.upsert(source)
        return
    parts = [partition_by] if partition_by else []
    finish_replacement(spark, path, parts)
    pending = pending_folder(path)
    source.write.parquet(f"{pending}/source")
    source = spark.read.schema(source.schema).parquet(f"{pending}/source")
    named = source.na.drop(subset=keys).select(*keys)
    twice = duplicate_keys(named, keys).limit(1).collect()
    if twice:
        delete_folder(spark, pending)
        raise ValueError(f"key {tuple(twice[0][:-1])} occurs more than once in the rows for {path}")
    stored = read_table(spark, path)
    if stored is None:
        write_table(source, path, parts)
        delete_folder(spark, pending)
        return
    if set(stored.columns) != set(source.columns):
        delete_folder(spark, pending)
        raise ValueError(f"{path} has the columns {stored.columns}, its new rows {source.columns}")
    # the types of the new rows: a partition column is not guessed from folder names
    target = read_table(spark, path, source.schema)
    if partition_by:
        matched = target.join(named, keys, "left_semi").select(partition_by)
        touched = source.select(partition_by).union(matched).distinct()
        touched.write.parquet(f"{pending}/touched")
        values = [r[0] for r in spark.read.parquet(f"{pending}/touched").collect()]
        known = [v for v in values if v is not None]
        target = target.where(F.col(partition_by).isin(known)
                              | (F.col(partition_by).isNull() & F.lit(len(known) < len(values))))
    upsert(target, source, keys).write.parquet(f"{pending}/rows")
    finish_replacement(spark, path, parts)


def insert_new(spark: SparkSession, source: DataFrame, path: str, keys: list[str]) -> None:
    """MERGE ... WHEN NOT MATCHED INSERT: append the source rows whose key is
    not in the table yet (appending never rewrites what is read).  The source
    is evaluated once, into a pending folder."""
    stored = _snapshots(spark, path)
    if stored is not None:
        stored.insert_new(source)
        return
    pending = f"{pending_folder(path)}_new"
    delete_folder(spark, pending)
    source.write.parquet(pending)
    source = spark.read.schema(source.schema).parquet(pending)
    target = read_table(spark, path, source.schema)
    new = source if target is None else source.join(target.select(*keys).distinct(), keys, "left_anti")
    write_table(new.select(*source.columns), path, mode="append")
    delete_folder(spark, pending)


def create_tables(spark: SparkSession, root: str, tables: dict, snapshot_keys: dict | None = None) -> list[str]:
    """Create the missing tables of ``tables`` (by name, see schemas.RAW_TABLES)
    under ``root``, empty; returns their names.  Those named in ``snapshot_keys``
    (name: its keys) become snapshot tables, which store their declaration and
    hold every writer to it.  The others are plain folders: writers hold them to
    the declared schema with ``enforce_not_null``, readers read them in it."""
    from ordermill.sources.snapshots import SnapshotTable
    missing = [n for n in tables if not table_exists(spark, f"{root}/{n}")]
    for name in missing:
        if name in (snapshot_keys or {}):
            schema, parts = tables[name]
            SnapshotTable(spark, f"{root}/{name}").create(schema, snapshot_keys[name], parts)
            continue
        fs, p = file_system(spark, f"{root}/{name}")
        fs.mkdirs(p)
    return missing


def materialize(df: DataFrame, kind: str, name: str, root: str | None = None,
                layer: str | None = None, default_layer: str = "processed",
                keys: list[str] | None = None, partition_by: str | None = None) -> DataFrame:
    """Store a model as a view, a table or an incremental table.

    ``layer`` names the namespace (raw / processed / reporting); when it is
    not given the default target layer is used.
    """
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df
    path = f"{root.rstrip('/')}/{(layer or default_layer).strip()}/{name}"
    if kind == "table":
        write_table(df, path, [partition_by] if partition_by else None)
    elif kind == "incremental":
        if not keys:
            raise ValueError("an incremental table needs its keys")
        upsert_table(spark, df, path, keys, partition_by)
    else:
        raise ValueError(f"unknown materialization {kind}")
    return read_declared(spark, path, df.schema)
