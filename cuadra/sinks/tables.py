"""Write modes of governed tables.

Transaction tables (period-partitioned) are written with dynamic partition
overwrite: only the partitions present in the batch are replaced.  A table that
declares ``partition_groups`` keeps many partitions in one folder, as the driver holds
every folder of a table; its replace still is by partition.

Reference tables (keyed catalogues) are versioned: every load writes a new
folder ``<path>/v=<n>`` and readers take the highest complete version
(``_SUCCESS`` present).  This is the backup of the reference tables, and it
avoids overwriting a path the same plan is reading.

Upserts are joins on the primary key: both sides shuffle on the key once (or
the batch is broadcast when proven small); no row is collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cuadra.operators.joins import dealt
from cuadra.session import materialize
from cuadra.specs import ColumnSpec, TableSpec

VERSION = "v"
#: Folder column of partitions that share folders.
GROUP = "_group"


# ------------------------------------------------------------ storage

def _entries(path: str) -> list[tuple[str, bool]]:
    """(name, is a folder) of what lies in ``path``, on the file system that
    Spark itself would write the path to."""
    spark = SparkSession.getActiveSession()
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    return [(x.getPath().getName(), x.isDirectory()) for x in fs.listStatus(folder)]


def exists(path: str) -> bool:
    """True when a table folder holds data (a partition folder or a file;
    dynamic partition overwrite leaves no ``_SUCCESS`` at the root)."""
    return any(not name.startswith(("_", ".")) for name, _ in _entries(path))


def versions(path: str) -> list[int]:
    """Complete versions of a reference table, ascending."""
    found = [name for name, folder in _entries(path) if folder and name.startswith(f"{VERSION}=")]
    return sorted(int(name.split("=", 1)[1]) for name in found
                  if ("_SUCCESS", False) in _entries(f"{path}/{name}"))


def tracking_columns(spec: TableSpec) -> list[tuple[str, str]]:
    """(name, type) of the change-tracking columns a spec declares."""
    out = []
    for c in spec.columns:
        if c.track_old:
            out.append((f"{c.name}_old", c.dtype))
        if c.track_at:
            out.append((f"{c.name}_changed_at", "timestamp_ntz"))
        if c.track_by:
            out.append((f"{c.name}_changed_by", "string"))
    return out


def stored_schema(spec: TableSpec) -> str:
    cols = [(c.name, c.dtype) for c in spec.columns] + tracking_columns(spec)
    return ", ".join(f"`{n}` {t}" for n, t in cols)


def _stored(spark: SparkSession, spec: TableSpec, path: str) -> DataFrame:
    """A partitioned table with the columns of its folders."""
    return spark.read.schema(stored_schema(spec)).parquet(path)


def read_table(spark: SparkSession, spec: TableSpec, path: str, version: int | None = None) -> DataFrame:
    """A governed table, always with its declared schema (partition values
    such as '001' or '2018-01-01' must stay strings)."""
    if spec.partition_cols:
        return _stored(spark, spec, path).drop(GROUP)
    if version is None:
        found = versions(path)
        if not found:
            return spark.createDataFrame([], stored_schema(spec))
        version = found[-1]
    return spark.read.schema(stored_schema(spec)).parquet(f"{path}/{VERSION}={version}")


def _with_tracking(df: DataFrame, spec: TableSpec) -> DataFrame:
    missing = {n: F.lit(None).cast(t) for n, t in tracking_columns(spec) if n not in df.columns}
    return df.withColumns(missing) if missing else df


def _ordered(df: DataFrame, spec: TableSpec) -> DataFrame:
    cols = [c.name for c in spec.columns] + [n for n, _ in tracking_columns(spec)]
    return _with_tracking(df, spec).select(*cols)


def _folder_columns(spec: TableSpec) -> tuple[str, ...]:
    return (*spec.partition_cols[:-1], GROUP) if spec.partition_groups else spec.partition_cols


def _files(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Output files.  A small table that declares ``num_partitions`` gets that many
    files a folder.  Otherwise rows are rebalanced (by the folders' columns, if
    any): AQE makes one file of what is small and splits what holds a large share of the
    rows, from the sizes it measures at run time."""
    n, folders = spec.num_partitions, _folder_columns(spec)
    if n is None or spec.rebalance:
        return df.hint("rebalance", *folders)
    if not folders:
        return df.repartition(n)
    if n == 1:
        return df.repartition(*folders)
    # each of the n tasks writes one file a folder
    return df.repartition(n, *(spec.pk or spec.names))


def partition_replace(df: DataFrame, spec: TableSpec, path: str) -> DataFrame:
    """Write a batch of a transaction table, replacing only the partitions
    present in the batch; returns the table re-read."""
    batch = _ordered(df, spec)
    if spec.partition_groups:
        batch = batch.withColumn(GROUP, F.pmod(F.xxhash64(spec.partition_cols[-1]), F.lit(spec.partition_groups)).cast("int"))
        if exists(path):
            batch = _with_neighbours(materialize(batch), spec, path)
    (_files(batch, spec).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*_folder_columns(spec)).parquet(path))
    return read_table(df.sparkSession, spec, path)


def _with_neighbours(batch: DataFrame, spec: TableSpec, path: str) -> DataFrame:
    """The batch and the stored rows of other partitions in its folders, cut off from the
    path that is overwritten."""
    def of(columns: Sequence[str], how: str, rows: DataFrame) -> DataFrame:
        keys = batch.select(*[F.col(c).alias(f"_k_{c}") for c in columns]).distinct()
        return rows.join(dealt(keys), reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in columns]), how)
    kept = of(spec.partition_cols, "left_anti", of(_folder_columns(spec), "left_semi", _stored(batch.sparkSession, spec, path)))
    return materialize(batch.unionByName(kept.select(*batch.columns)))


def save_version(df: DataFrame, spec: TableSpec, path: str) -> int:
    """Write a reference table as a new complete version; returns it."""
    found = versions(path)
    n = (found[-1] + 1) if found else 1
    _files(_ordered(df, spec), spec).write.mode("overwrite").parquet(f"{path}/{VERSION}={n}")
    return n


def drop_versions(path: str, keep: int) -> None:
    """Delete the complete versions of a table before its last ``keep``."""
    spark = SparkSession.getActiveSession()
    for n in versions(path)[:-keep]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{VERSION}={n}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def version_counts(spark: SparkSession, spec: TableSpec, path: str) -> DataFrame:
    """Row count of every complete version (one small job per version)."""
    parts = [read_table(spark, spec, path, v).agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(v).alias("version"), "n_rows") for v in versions(path)]
    return reduce(lambda a, b: a.unionByName(b), parts)


# ------------------------------------------------------------ upserts

def _changed(new: Column, old: Column) -> Column:
    return ~new.eqNullSafe(old)


def single_keys(source: DataFrame, spec: TableSpec) -> DataFrame:
    """``source``, failing at run time if a key of the table occurs twice in it
    (a merge would multiply the target's rows)."""
    pk = spec.pk
    rest = [c for c in source.columns if c not in pk]
    grouped = source.groupBy(*pk).agg(F.count(F.lit(1)).alias("_n"),
                                      *[F.first(c).alias(c) for c in rest])
    key = F.concat_ws("|", *[F.col(k).cast("string") for k in pk])
    message = F.concat(F.lit(f"{spec.name}: repeated source key "), key)
    return grouped.withColumn("_ok", F.when(F.col("_n") > 1, F.raise_error(message).cast("boolean"))
                              .otherwise(F.lit(True))).where("_ok").select(*source.columns)


def _merge(target: DataFrame, source: DataFrame, spec: TableSpec, mapped: Sequence[str],
           how: str, changed_at: str, changed_by: str) -> DataFrame:
    """Core of the keyed write modes.  ``how``: full (upsert), left (update
    matched keys only).  Mapped columns take the source value where the key
    is in the source; other columns keep the target value.  Change tracking
    records old value, time and process where a tracked value changes."""
    pk = spec.pk
    source = single_keys(source, spec)
    t = _with_tracking(target, spec).select(
        *pk, *[F.col(c).alias(f"_t_{c}") for c in _ordered(target, spec).columns if c not in pk])
    s = source.select(*pk, *[F.col(c).alias(f"_s_{c}") for c in mapped if c not in pk],
                      F.lit(True).alias("_in_source"))
    if how == "left":
        joined = t.join(s, pk, "left").withColumn("_in_target", F.lit(True))
    else:
        t = t.withColumn("_in_target", F.lit(True))
        joined = t.join(s, pk, "full_outer")
    in_src = F.coalesce(F.col("_in_source"), F.lit(False))
    in_tgt = F.coalesce(F.col("_in_target"), F.lit(False))
    out: dict[str, Column] = {}
    for c in spec.columns:
        if c.name in pk:
            continue
        old = F.col(f"_t_{c.name}")
        if c.name in mapped:
            new = F.when(in_src, F.col(f"_s_{c.name}")).otherwise(old)
        elif c.default is not None:
            new = F.when(in_tgt, old).otherwise(F.expr(c.default))
        else:
            new = old
        new = new.try_cast(c.dtype)
        out[c.name] = new
        change = in_tgt & in_src & _changed(new, old) if c.name in mapped else F.lit(False)
        if c.track_old:
            out[f"{c.name}_old"] = F.when(change, old).otherwise(F.col(f"_t_{c.name}_old"))
        if c.track_at:
            out[f"{c.name}_changed_at"] = F.when(change, F.lit(changed_at).cast("timestamp_ntz")) \
                .otherwise(F.col(f"_t_{c.name}_changed_at"))
        if c.track_by:
            out[f"{c.name}_changed_by"] = F.when(change, F.lit(changed_by)) \
                .otherwise(F.col(f"_t_{c.name}_changed_by"))
    cols = [c.name for c in spec.columns] + [n for n, _ in tracking_columns(spec)]
    return joined.select(*pk, *[out[c].alias(c) for c in cols if c not in pk])


def upsert_full(target: DataFrame, source: DataFrame, spec: TableSpec, mapped: Sequence[str],
                changed_at: str, changed_by: str) -> DataFrame:
    """Full load of a reference table: new keys inserted, mapped columns of
    existing keys updated, keys missing from the source kept."""
    return _merge(target, source, spec, mapped, "full", changed_at, changed_by)


def selective_update(target: DataFrame, source: DataFrame, spec: TableSpec, mapped: Sequence[str],
                     changed_at: str, changed_by: str) -> tuple[DataFrame, DataFrame]:
    """Change only the mapped columns, only for keys present in the target.

    Returns (table after update, source keys not in the target)."""
    updated = _merge(target, source, spec, mapped, "left", changed_at, changed_by)
    unmatched = source.select(*spec.pk).join(target.select(*spec.pk), spec.pk, "left_anti")
    return updated, unmatched


def update_only(target: DataFrame, source: DataFrame, spec: TableSpec, mapped: Sequence[str],
                changed_at: str, changed_by: str) -> DataFrame:
    """Update existing keys; source keys not in the target are ignored."""
    return _merge(target, source, spec, mapped, "left", changed_at, changed_by)


def insert_only(target: DataFrame, source: DataFrame, spec: TableSpec,
                mapping: Mapping[str, str] | None = None) -> DataFrame:
    """Append the source keys that are new; existing keys are not touched.

    ``mapping``: table column -> source column, as in the other modes; a column
    that the source lacks takes its declared default, or null."""
    named = {v: k for k, v in (mapping or {}).items()}
    source = single_keys(source.select(*[F.col(c).alias(named.get(c, c)) for c in source.columns]), spec)
    new = source.join(target.select(*spec.pk), spec.pk, "left_anti")
    absent = {c.name: F.expr(c.default if c.default is not None else "NULL").try_cast(c.dtype)
              for c in spec.columns if c.name not in new.columns}
    new = new.withColumns(absent) if absent else new
    return _ordered(target, spec).unionByName(_ordered(new, spec))


def change_trace(before: DataFrame, after: DataFrame, spec: TableSpec, changed_at: str,
                 changed_by: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Every changed cell as a row: pk, column_name, old_value, new_value,
    changed_at, changed_by (values as strings).  Inserted keys have a null
    old value; deleted keys are not traced (loads never delete)."""
    pk = spec.pk
    cols = [c for c in (columns or [c.name for c in spec.columns]) if c not in pk]
    b = before.select(*pk, *[F.col(c).cast("string").alias(f"_b_{c}") for c in cols])
    a = after.select(*pk, *[F.col(c).cast("string").alias(f"_a_{c}") for c in cols])
    joined = a.join(dealt(b), pk, "left")
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_b_{c}").alias("old_value"),
                               F.col(f"_a_{c}").alias("new_value")) for c in cols])
    return (joined.select(*pk, F.inline(cells))
            .where(_changed(F.col("new_value"), F.col("old_value")))
            .select(*pk, "column_name", "old_value", "new_value",
                    F.lit(changed_at).cast("timestamp_ntz").alias("changed_at"),
                    F.lit(changed_by).alias("changed_by")))


# ------------------------------------------------------------ history

#: Column name of the event that a key was inserted.
INSERTED = ""


def history_events(before: DataFrame, after: DataFrame, spec: TableSpec, changed_at: str,
                   changed_by: str) -> DataFrame:
    """What a load changed, as rows to append: the changed cells (``change_trace``) and
    one row with column name '' for each new key."""
    inserted = after.select(*spec.pk).join(dealt(before.select(*spec.pk)), spec.pk, "left_anti").select(
        *spec.pk, F.lit(INSERTED).alias("column_name"), F.lit(None).cast("string").alias("old_value"),
        F.lit(None).cast("string").alias("new_value"), F.lit(changed_at).cast("timestamp_ntz").alias("changed_at"),
        F.lit(changed_by).alias("changed_by"))
    return change_trace(before, after, spec, changed_at, changed_by).unionByName(inserted)


def append_history(before: DataFrame, after: DataFrame, spec: TableSpec, path: str, changed_at: str, changed_by: str) -> None:
    """Append a load's events.  ``load`` numbers the loads, so that of two loads with the
    same time the later one counts; a load that changed nothing leaves no rows."""
    events = history_events(before, after, spec, changed_at, changed_by)
    number = 1 + max((int(n.split("=", 1)[1]) for n, folder in _entries(path) if folder and n.startswith("load=")), default=0)
    events.hint("rebalance").write.mode("overwrite").parquet(f"{path}/load={number}")


def read_history(spark: SparkSession, spec: TableSpec, path: str) -> DataFrame:
    """All events of a table: primary key, column_name, old_value, new_value, changed_at,
    changed_by, load."""
    keys = ", ".join(f"`{c.name}` {c.dtype}" for c in spec.columns if c.pk)
    schema = f"{keys}, column_name string, old_value string, new_value string, changed_at timestamp_ntz, changed_by string, load int"
    if not _entries(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def intervals(history: DataFrame, spec: TableSpec) -> DataFrame:
    """Each value with the time it was valid: primary key, column_name, value, valid_from
    (inclusive), valid_to (exclusive, null: still valid).  A value replaced at the time it
    was set was never valid."""
    order = Window.partitionBy(*spec.pk, "column_name").orderBy("changed_at", "load")
    return (history.where(F.col("column_name") != INSERTED)
            .select(*spec.pk, "column_name", F.col("new_value").alias("value"), F.col("changed_at").alias("valid_from"),
                    F.lead("changed_at").over(order).alias("valid_to"))
            .where(F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from"))))


def as_of(history: DataFrame, spec: TableSpec, at: str | Column) -> DataFrame:
    """The table as it was at ``at``: every key inserted by then with the latest value of
    each column.  One aggregation over the events by key, combined before its shuffle."""
    at = F.lit(at).cast("timestamp_ntz") if isinstance(at, str) else at
    rest = [c for c in spec.columns if not c.pk]
    order = F.struct("changed_at", "load")
    latest = [F.max(F.when(F.col("column_name") == c.name, F.struct(order.alias("at"), F.col("new_value").alias("value"))))
              .alias(f"_v{i}") for i, c in enumerate(rest)]
    rows = history.where(F.col("changed_at") <= at).groupBy(*spec.pk).agg(
        F.max(F.col("column_name") == INSERTED).alias("_inserted"), *latest).where("_inserted")
    return rows.select(*spec.pk, *[F.col(f"_v{i}.value").try_cast(c.dtype).alias(c.name) for i, c in enumerate(rest)])


# ------------------------------------------------------------ rule results

def append_quality(summary: DataFrame, details: DataFrame, path: str, table: str, run_id: str) -> None:
    """Keep rule results and violating rows of a load (both appended, partitioned by
    table; the run id tells loads apart).  A violating row is kept by its key columns as
    JSON, so tables with different keys share one log."""
    tag = [F.lit(table).alias("table_name"), F.lit(run_id).alias("run_id")]
    key = [c for c in details.columns if c != "rule_id"]
    for rows, name in ((summary, "dq_results"),
                       (details.select("rule_id", F.to_json(F.struct(*key)).alias("row_key")), "dq_details")):
        rows.select(*tag, *rows.columns).hint("rebalance").write.mode("append").partitionBy("table_name").parquet(f"{path.rstrip('/')}/{name}")


QUALITY_SCHEMAS = {
    "dq_results": "run_id string, rule_id string, rule_type string, column_name string, error_code int, external_code string, "
                  "severity string, n_rows long, n_bad long, passed boolean, table_name string",
    "dq_details": "run_id string, rule_id string, row_key string, table_name string",
}


def read_quality(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The log ``dq_results`` or ``dq_details`` of ``append_quality``."""
    folder = f"{path.rstrip('/')}/{name}"
    return spark.read.schema(QUALITY_SCHEMAS[name]).parquet(folder) if _entries(folder) else spark.createDataFrame([], QUALITY_SCHEMAS[name])


__all__ = ["ColumnSpec", "append_history", "append_quality", "as_of", "change_trace", "history_events", "insert_only", "intervals",
           "partition_replace", "read_history", "read_quality", "read_table", "save_version", "selective_update", "update_only",
           "upsert_full", "version_counts", "versions"]
