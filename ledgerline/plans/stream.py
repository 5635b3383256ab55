"""Files as a stream: each micro-batch of new files is one batch of the project.

The source remembers in its checkpoint which files it has handed out, and the number of a micro-batch is its
batch id.  Every stage replaces its batch, so a micro-batch that failed and comes again leaves what one run
leaves; the ledgers that only grow lose the rows of the failed attempt first.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import Project
from .runs import Run

#: Ledgers to which a stage appends on every run.
GROWING = ("mapping_runs", "cleaning_runs", "normalization_runs")
_FILES = "path string, modificationTime timestamp, length bigint, content binary"  # only paths are read
MOST_FILES = 1_000  # of a source in one micro-batch: their names are all that the driver sees


def batch_name(number: int) -> str:
    return f"stream-{number:012d}"


def run_batch(spark: SparkSession, project: Project, now: str, number: int, files: dict[str, list[str]]) -> Run:
    """All stages of one micro-batch, whose files are given for each source."""
    run = Run(spark, project, now, batch_name(number), files)
    for ledger in GROWING:
        if run.store.exists(ledger):
            run.store.purge(ledger, run.batch_id)
    run.to_facts()
    run.post_model()
    return run


def start(
    spark: SparkSession, project: Project, checkpoint: str, clock: Callable[[], str], most_files: int = MOST_FILES,
    until_caught_up: bool = False,
) -> StreamingQuery:
    """Watch the folders of all sources; ``clock`` gives the time of a run as ISO text.

    With ``until_caught_up`` the query ends when it has taken the files that are there.
    """
    new = [
        spark.readStream.format("binaryFile").schema(_FILES).option("maxFilesPerTrigger", most_files).load(project.path(source.path))
        .select(F.lit(name).alias("source"), "path")
        for name, source in project.sources.items()
    ]

    def take(found: DataFrame, number: int) -> None:
        files: dict[str, list[str]] = {name: [] for name in project.sources}
        for row in found.collect():
            files[row.source].append(row.path)
        run_batch(spark, project, clock(), number, files)

    writer = reduce(DataFrame.unionByName, new).writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if until_caught_up else writer).start()
