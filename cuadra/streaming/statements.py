"""Incremental ingest of statement extracts as they land.

Banks deliver one file per statement and month; a file stream over the
landing folder picks up new files, and every micro-batch runs the same
operators as the batch job (header records, header drop, typed split,
unify).

A table partition (period, bank) holds all four statements of the bank, and
one stream carries one statement kind, so the sink merges: it keeps the
touched partitions' rows of the other kinds, adds the micro-batch, cuts the
lineage with ``checkpoint()`` (nothing is read from a path being
overwritten) and replaces those partitions.  Replaying a micro-batch after
a failure gives the same partitions: exactly-once without a transactional
sink.

Files are read whole (``binaryFile``): statement files are bounded by their
row-count rule, and the header travels with its lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cuadra.operators import analytics as A
from cuadra.sinks import tables as SK
from cuadra.sources import text as TX
from cuadra.specs import RawSpec, TableSpec


# Columns of Spark's binaryFile source (a stream needs them declared).
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def parse_statements(files: DataFrame, template: str, raw: RawSpec, origin: str) -> DataFrame:
    """Whole-file rows of one statement kind -> rows of the unified fact; each file is
    parsed by the layout of its date."""
    lines = TX.file_lines(files, template, raw.settings[0].encoding)
    cut = TX.by_layout(TX.drop_header(lines).where(F.length(TX.LINE) > 0), raw, TX.file_period())
    data = TX.typed(cut.where(F.col(TX.REASON).isNull()), raw, keep=["YYYY", "MM", "Cod_Banco"])
    shaped = data.select(TX.file_period().alias("periodo_mes"), F.col("Cod_Banco").alias("ins_id"),
                         *[c for c in data.columns if c == "planCuenta_id" or "_Monto" in c])
    amounts = [c for c in shaped.columns if "_Monto" in c]
    if len(amounts) == 4:
        return A.statement_branch(shaped, origin, components=amounts)
    return A.statement_branch(shaped, origin, total=amounts[0])


def merge_into_partitions(batch: DataFrame, table: TableSpec, path: str, kind_col: str) -> None:
    """Replace the batch's partitions, keeping their rows of other kinds."""
    spark = batch.sparkSession
    parts = list(table.partition_cols)
    merged = batch
    if SK.exists(path):
        touched = batch.select(*parts).distinct()
        kinds = batch.select(*parts, kind_col).distinct()
        keep = (SK.read_table(spark, table, path).join(touched, parts, "left_semi")
                .join(kinds, [*parts, kind_col], "left_anti"))
        merged = keep.unionByName(batch.select(*keep.columns))
    SK.partition_replace(merged.checkpoint(), table, path)


def start_statement_stream(spark: SparkSession, landing: str, raw: RawSpec, origin: str,
                           table: TableSpec, table_path: str, checkpoint: str | None = None,
                           available_now: bool = False, max_files: int = 1000) -> StreamingQuery:
    """Stream one statement kind from ``landing`` into the statement table.

    Without ``checkpoint`` the stream's progress is kept beside the table, one folder a
    kind, so a restart goes on where it stopped.  Streams of several kinds replace the same
    partitions: run them one after the other (``available_now``), not at once."""
    template = f"{landing.rstrip('/')}/{raw.template}"
    folder, name_glob = TX.listing(template)
    files = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
             .option("recursiveFileLookup", "true").option("pathGlobFilter", name_glob)
             .option("maxFilesPerTrigger", max_files).load(folder))
    fact = parse_statements(files, template, raw, origin)

    def write(batch: DataFrame, epoch: int) -> None:
        merge_into_partitions(batch, table, table_path, "eerr_origen")

    writer = (fact.writeStream.foreachBatch(write)
              .option("checkpointLocation", checkpoint or f"{table_path.rstrip('/')}_progress/{origin}"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
