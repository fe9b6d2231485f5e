"""One change-feed table and its folders, as a single handle.

``<root>/silver`` is the streaming sink (month-partitioned Parquet), with its
checkpoint, invalidation sidecar, history and state snapshots as siblings, so no
batch job ever writes inside the sink directory.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from . import schemas
from .operators import audit, layout, maintenance, mutations, snapshot, state
from .sources import tables
from .streaming import ingest as streaming
from .streaming import sized


@dataclass
class ChangeTable:
    spark: SparkSession
    root: str
    exact_decimal: bool = False
    spec: schemas.TableSpec | None = None  # the captured table (default: accounts)
    target_file_bytes: int | None = None  # a sink with file-size control (None: the plain file sink)

    def __post_init__(self):
        if self.spec is None:
            self.spec = schemas.ACCOUNTS_EXACT if self.exact_decimal else schemas.ACCOUNTS

    @property
    def silver_path(self) -> str:
        return self.root.rstrip("/") + "/silver"

    @property
    def backfill_path(self) -> str:
        """Batch backfills go to a sibling table (never into the streaming sink)."""
        return self.root.rstrip("/") + "/silver_backfill"

    # --- ingest ---------------------------------------------------------------
    def start_ingest(self, source: DataFrame, mode: str = "stream", **kwargs) -> StreamingQuery:
        if self.target_file_bytes:
            return sized.start_sized_ingest(source, self.silver_path, mode=mode, target_bytes=self.target_file_bytes, spec=self.spec, **kwargs)
        return streaming.start_ingest(source, self.silver_path, mode=mode, spec=self.spec, **kwargs)

    def ingest_available(self, source: DataFrame, **kwargs) -> StreamingQuery:
        if self.target_file_bytes:
            query = self.start_ingest(source, mode="once", **kwargs)
            query.awaitTermination()
            return query
        return streaming.ingest_available(source, self.silver_path, spec=self.spec, **kwargs)

    def backfill(self, feed: DataFrame) -> int:
        return streaming.ingest_batch(feed, self.backfill_path, spec=self.spec)

    # --- reads ----------------------------------------------------------------
    @property
    def schema(self):
        return self.spec.silver()

    def silver(self) -> DataFrame:
        """Every change ever ingested (stream sink ∪ backfills)."""
        return self._stream().unionByName(self._backfills())

    def _stream(self) -> DataFrame:
        return tables.read_silver(self.spark, self.silver_path, self.schema)

    def _backfills(self) -> DataFrame:
        return tables.read_silver(self.spark, self.backfill_path, self.schema)

    def visible(self) -> DataFrame:
        """Rows that runs have not hidden; read from the layout as far as there is one (:meth:`arrange`)."""
        return layout.visible_rows(self.spark, self._stream(), self.silver_path, self._backfills())

    def gold(self) -> DataFrame:
        """Current state. Ranks all of silver, skipping the join with the kept keys: compaction
        never invalidates a key's newest change, and an invalidated row can never become
        one later (winners only move to newer rows), so the result equals gold over the
        visible rows (tested) without paying the join on every read."""
        return state.current_state(self.silver(), key=self.spec.key)

    def register_views(self, silver_view: str = schemas.SILVER_VIEW, gold_view: str = schemas.GOLD_VIEW) -> None:
        """``silver_view`` shows the visible rows; ``gold_view`` is the current state over all of
        silver (same answer, see :meth:`gold`)."""
        all_rows = silver_view + "_all"
        state.register_views(self.spark, self.silver(), all_rows, gold_view, key=self.spec.key)
        self.visible().createOrReplaceTempView(silver_view)

    # --- maintenance ------------------------------------------------------------
    def compact(self) -> dict:
        return maintenance.compact(self.spark, self._stream(), self.silver_path, key=self.spec.key, more=self._backfills())

    def pack(self) -> dict:
        """Merge the small files of a sink with file-size control."""
        return sized.pack(self.spark, self.silver_path, self.target_file_bytes or sized.TARGET_BYTES, self.schema)

    def arrange(self, buckets: int | None = None) -> dict:
        """Store the rows that runs have kept in buckets, so that raw reads shuffle no silver."""
        return layout.arrange(self.spark, self._stream(), self.silver_path, buckets, self._backfills())

    def history(self, n: int = 5) -> DataFrame:
        return maintenance.recent_history(self.spark, self.silver_path, n)

    def counts(self) -> DataFrame:
        """Rows that readers see (compaction and backfills included) and keys in gold."""
        there = any(tables.silver_exists(self.spark, p) for p in (self.silver_path, self.backfill_path))
        return audit.health_counts(self.visible() if there else None, self.gold() if there else None)

    def preview(self, n: int = 100) -> DataFrame:
        """The newest visible rows, with the number of visible rows."""
        return audit.preview(self.visible(), n)

    # --- incremental state --------------------------------------------------------
    def snapshot(self) -> dict:
        return snapshot.write_snapshot(self.spark, self.silver_path, self.schema, key=self.spec.key)

    def gold_incremental(self) -> DataFrame:
        """From the newest snapshot of the stream sink, what arrived since, and all backfills."""
        return snapshot.current_state_incremental(
            self.spark, self.silver_path, self.schema, key=self.spec.key, more=self._backfills())

    def current(self) -> DataFrame:
        """Gold the cheapest exact way: without a snapshot this is the full read."""
        return self.gold_incremental()

    # --- mutation batches ---------------------------------------------------------
    def judge_mutations(self, requests: DataFrame, **scan) -> DataFrame:
        """Every request of a batch with its verdict against the current state."""
        return mutations.judge_mutations(requests, self.current(), key=self.spec.key, **scan)

    def judged_events(self, requests: DataFrame, base_lsn: int, at, **scan) -> tuple[DataFrame, DataFrame]:
        """(verdicts, feed records of the accepted requests), both from one judgement.

        The verdicts are written once, so changes that arrive in between can't make the published
        events disagree with them.
        """
        from .session import new_work_path
        from .sources import feed as feeds

        path = new_work_path(self.spark, "judged")
        self.judge_mutations(requests, **scan).write.parquet(path)
        judged = self.spark.read.parquet(path)
        applied = judged.where(judged["reason"].isNull())
        return judged, feeds.envelope_records(mutations.mutation_changes(applied, base_lsn, at, key=self.spec.key))

    def mutation_events(self, requests: DataFrame, base_lsn: int, at, **scan) -> DataFrame:
        """Feed records (change envelopes) for the accepted requests of a batch."""
        from .sources import feed as feeds

        applied = mutations.apply_mutations(requests, self.current(), key=self.spec.key, **scan)
        return feeds.envelope_records(mutations.mutation_changes(applied, base_lsn, at, key=self.spec.key))
