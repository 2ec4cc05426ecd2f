"""Incremental ledger ingestion with Structured Streaming.

The reference runs its build once a day over the whole bronze folder. With a
stream of file names the same staging -> conversion -> mapping runs only over
newly landed ledger files, which are read by the batch reader (by column name,
so files may differ in the order and number of their columns); ``trigger(availableNow=True)`` processes what has
arrived and stops, which is the daily batch expressed incrementally. The
stream checkpoint (under the shared ``spark.checkpoint.dir``) records which
files were processed; each micro-batch overwrites only its own ``batch_id``
partition, so a replayed batch after a failure does not duplicate postings.
Marts are then rebuilt from the accumulated mapped table.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from ledgerspark.operators import convert, marts, staging
from ledgerspark.operators.joins import proven_small
from ledgerspark.session import scratch_path
from ledgerspark.sources.bronze import GL_COLUMNS, blank_to_null, read_csv_files

#: Files of one micro-batch at most; their names pass through the driver.
FILES_PER_BATCH = 10_000


def start_ledger_stream(spark: SparkSession, landing_dir: str, fx: DataFrame, projects: DataFrame,
                        cost_centres: DataFrame, out_dir: str, checkpoint: str | None = None,
                        available_now: bool = True, files_per_batch: int = FILES_PER_BATCH) -> StreamingQuery:
    """Stream new GL CSV files from ``landing_dir`` into ``out_dir/mapped`` (parquet, by batch)."""
    # Names of landed files only: Spark reads no content for columns that aren't used.
    stream = (spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
              .option("maxFilesPerTrigger", files_per_batch).load(landing_dir).select("path", "length"))
    fx_t = staging.stage_fx(fx, lenient=True)
    target = os.path.join(out_dir, "mapped")
    # The rate and dimension tables are static for the stream: decide once whether
    # each is broadcast (bounded size checks), not again in every micro-batch.
    fx_small = proven_small(convert._rates_with_base(fx_t, convert.REPORTING_CURRENCY), convert.FX_BROADCAST_ROWS)
    dims_small = (proven_small(projects, convert.DIM_BROADCAST_ROWS),
                  proven_small(cost_centres, convert.DIM_BROADCAST_ROWS))

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        files = sorted(r.path for r in batch.where("length > 0").select("path").collect())
        gl = staging.stage_gl(blank_to_null(read_csv_files(spark, files, GL_COLUMNS)), lenient=True)
        mapped = convert.map_dimensions(convert.fx_convert(gl, fx_t, broadcast=fx_small), projects, cost_centres,
                                        broadcast=dims_small)
        (mapped.withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(target))

    w = (stream.writeStream.foreachBatch(per_batch)
         .option("checkpointLocation", checkpoint or scratch_path(spark, "ledger_stream_ckpt")))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def marts_from_stream_output(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    """The marts over everything ingested so far."""
    m = spark.read.parquet(os.path.join(out_dir, "mapped")).drop("batch_id")
    pnl = marts.pnl_summary(m)
    return {"mart_pnl_summary": pnl, "mart_revenue_trends": marts.revenue_trends(m),
            "mart_cost_analysis": marts.cost_analysis(m), "mart_variance_analysis": marts.variance_analysis(pnl)}
