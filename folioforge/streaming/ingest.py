"""Incremental ingestion with Structured Streaming: the batch operators over micro-batches, state in versioned tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.operators import deltas, publication
from folioforge.operators.versions import fold_assets, outcomes_of
from folioforge.sources.buckets import BucketStore
from folioforge.sources.scratch import kept

OBSERVATION = "work_id string, seq long, pos long, kind string, checksum string, lineage_date date, work_date date"


def file_stream(spark: SparkSession, folder: str, schema: str = OBSERVATION, max_files: int = 100) -> DataFrame:
    """New files of a folder of observations, once each."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).json(folder)


STATE = "work_id string, state string, checksum string, lineage_date date, work_date date, barrier date, seq long, pos long"


class StateTable:
    """The fold's state in hash buckets of works, and outcomes by batch. A batch reads and writes only the buckets of its own works.

    Each batch is a version of the state and is skipped if it is there already. Nothing expires: late observations are
    judged by their dates, and a work's state, or its deletion barrier, lasts. Choose the number of buckets by the
    works that are expected; it stays for the table's life.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark, self.root, self.store = spark, root, BucketStore(spark, f"{root}/state", buckets)

    def read(self) -> DataFrame | None:
        return None if self.store.version() is None else self.store.read("state", STATE)

    def outcomes(self) -> DataFrame:
        return self.spark.read.option("recursiveFileLookup", "true").parquet(f"{self.root}/outcomes")

    def apply(self, batch: DataFrame, batch_id: int, after: Callable[[DataFrame, DataFrame], None] | None = None) -> None:
        """Fold a micro-batch into the state. A batch that was applied before is a no-op, so a replay after a failure is safe."""
        now, version = self.store.version(), f"batch-{batch_id:012d}"
        if now is not None and now >= version:
            return
        batch = kept(batch.dropDuplicates(["work_id", "seq", "pos"]))
        touched = self.store.touched(batch)
        folded, _ = fold_assets(batch, self.store.read("state", STATE, touched))
        where = f"{self.root}/outcomes/{version}"
        outcomes_of(folded).write.mode("overwrite").parquet(where)
        then = None if after is None else lambda: after(self.store.read("state", STATE, version=version), self.spark.read.parquet(where))
        self.store.commit({"state": (folded.drop("outcomes"), touched)}, version, before_pointer=then)


def run_once(stream: DataFrame, state: StateTable, checkpoint: str, after: Callable[[DataFrame, DataFrame], None] | None = None) -> None:
    """Apply all that has arrived and stop; the checkpoint remembers which files were read."""
    query = stream.writeStream.foreachBatch(lambda batch, batch_id: state.apply(batch, batch_id, after)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def late_outcomes(outcomes: DataFrame) -> DataFrame:
    """Late observations by outcome: counted, never silently lost."""
    return outcomes.where("outcome IN ('STALE', 'BLOCKED', 'ALREADY_DELETED')").groupBy("kind", "outcome").agg(F.count("*").alias("n"))


def gated(check: Callable[[DataFrame], bool], publish: Callable[[DataFrame], None]) -> Callable[[DataFrame, DataFrame], None]:
    """An `after` step that publishes a batch's state only if its check passes; a failing batch stops the stream before its pointer moves."""

    def after(state: DataFrame, outcomes: DataFrame) -> None:
        if not check(state):
            raise ValueError("a quality gate failed; the batch is not published")
        publish(state)

    return after


def refresh_after(old_new: Callable[[DataFrame], tuple[dict, dict]], marts: list[str], store: Callable[[str, DataFrame], None], read: Callable[[str], DataFrame]) -> Callable[[DataFrame, DataFrame], None]:
    """An `after` step that recomputes the rows of marts that a batch touches."""

    def after(state: DataFrame, outcomes: DataFrame) -> None:
        changed = outcomes.where("outcome IN ('INSERTED', 'REPLACED', 'DELETED')").select("work_id").distinct()
        old, new = old_new(state)
        for mart in marts:
            scope = publication.refresh_scope(old, new, changed, mart)
            store(mart, publication.refresh_mart(read(mart), new, scope, mart))

    return after


def deltas_after(old_new: Callable[[DataFrame, DataFrame], tuple[dict, dict, DataFrame]], load: Callable[[], tuple[dict, dict]], store: Callable[[dict, dict], None]) -> Callable[[DataFrame, DataFrame], None]:
    """An `after` step that keeps marts up by what a batch's works contributed before and contribute now.

    old_new(changed, state) gives the changed works' tables before and after, and all works' states; load and store handle
    the marts and the author counts behind them.
    """

    def after(state: DataFrame, outcomes: DataFrame) -> None:
        changed = outcomes.where("outcome IN ('INSERTED', 'REPLACED', 'DELETED')").select("work_id").distinct()
        store(*deltas.refresh(*load(), *old_new(changed, state)))

    return after
