"""Date-versioned layouts: which read setting applies to each file.

A raw extract may change layout over time; each setting is valid for files
dated in [start, end].  Choosing the setting is a range join between the
files (one row per file, data-sized) and the settings (a handful of rows
declared in code, so broadcasting them is bounded by the declaration).
A file matching no setting, or more than one, is an error to report.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cuadra.specs import RawSpec


def settings_frame(spark: SparkSession, raw: RawSpec) -> DataFrame:
    rows = [(raw.name, i, s.start, s.end, s.sep, ";".join(n for n, _ in s.columns),
             None if s.header_fields is None else ";".join(s.header_fields))
            for i, s in enumerate(raw.settings)]
    return spark.createDataFrame(
        rows, "raw_name string, setting_id int, valid_from string, valid_to string, sep string, "
              "columns string, header string")


def settings_as_of(files: DataFrame, settings: DataFrame, period_col: str = "periodo_mes",
                   keys: list[str] | None = None, name_col: str | None = None) -> DataFrame:
    """Attach the valid setting to every file.

    ``files`` has a period column ('yyyy-MM-dd') and file keys; ``name_col``
    (optional) names the file column that must equal the setting's
    ``raw_name``.  Output: file keys, period, setting_id (the single valid
    one, else null), n_settings (0: no layout, >1: overlapping layouts)."""
    keys = keys or [c for c in files.columns if c != period_col]
    cond = F.col(period_col).between(F.col("valid_from"), F.col("valid_to"))
    if name_col:
        cond = cond & (F.col(name_col) == F.col("raw_name"))
    layouts = settings.select("raw_name", "setting_id", "valid_from", "valid_to")
    matched = files.join(F.broadcast(layouts), cond, "left")
    return (matched.groupBy(period_col, *keys)
            .agg(F.count("setting_id").alias("n_settings"), F.min("setting_id").alias("_first"))
            .select(period_col, *keys,
                    F.when(F.col("n_settings") == 1, F.col("_first")).alias("setting_id"),
                    "n_settings"))
