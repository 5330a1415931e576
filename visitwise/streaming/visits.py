"""Visit facts as a stream-static join (see package doc)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from visitwise.plans.prepare import prepare_visits
from visitwise.plans.route import visit_facts
from visitwise.schemas import VISITS


def visit_facts_stream(spark: SparkSession, landing_dir: str, clients: DataFrame,
                       year: int, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming visit facts: new visit files (parquet, visit schema) joined
    with the static prepared clients."""
    r = spark.readStream.schema(VISITS)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    visits = prepare_visits(r.parquet(landing_dir), year)
    return visit_facts(visits, clients)


def start_visit_facts(spark: SparkSession, landing_dir: str, clients: DataFrame, year: int,
                      out_path: str, checkpoint: str) -> StreamingQuery:
    """Process every file that has landed and stop (``availableNow``);
    append the facts as parquet partitioned by visit date.

    ``checkpoint`` is a fixed folder on shared storage: the same one in every
    run, since it holds which files have been processed."""
    facts = visit_facts_stream(spark, landing_dir, clients, year)
    return (facts.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint).partitionBy("FECHAS_VISITA")
            .trigger(availableNow=True).start(out_path))
