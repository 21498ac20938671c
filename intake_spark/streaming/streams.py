"""State that a night leaves for the next, as streams: intake with a registry of seen companies, attempts per company, and CRM updates.

Each micro-batch writes under a name from its number, so that a replayed one replaces itself and nothing is counted twice.
"""

from __future__ import annotations

from bisect import insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, GroupedData, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import MapState, StatefulProcessor, StatefulProcessorHandle

from ..operators import crm as H
from ..operators import selection as S
from ..sources.buckets import Buckets
from ..sources.tables import existing, staged
from .registry import BUCKET_ROWS, Registry


def stream_intake(rows: DataFrame, out: str, checkpoint: str, excluded: DataFrame, scope: S.Scope, cap: int, bucket_rows: int = BUCKET_ROWS) -> StreamingQuery:
    """Rows as they arrive (batch, order_key and company fields) to the candidates that one job over all rows of a batch, in the order of arrival, would select.

    Cap and rank of a batch go on over its micro-batches: what has been selected of it so far lies in `batches`, a line a batch. Candidates' domains, and
    for those without one batch and name, lie in a registry; a domain that it holds resurfaces and is not written. Micro-batch n writes
    candidates/epoch=n and version n + 1 of both, from version n; when it runs again it replaces just these.
    """
    registry = Registry(f"{out}/registry", bucket_rows)
    named = F.concat(F.col("batch"), F.lit("\n"), F.col("_key"))  # no domain holds a line break

    def each(df: DataFrame, epoch: int) -> None:
        spark = df.sparkSession
        keyed = S.clean_rows(df).select("batch", "domain", S.row_key().alias("_key"))
        asked = keyed.select(F.coalesce("domain", named).alias("key")).distinct()
        known = staged(registry.known(asked, epoch), "known")
        parts = F.split("key", "\n", 2)
        seen = known.filter(~F.contains("key", F.lit("\n"))).select(F.col("key").alias("domain"))
        again = known.filter(F.contains("key", F.lit("\n"))).select(parts[0].alias("batch"), parts[1].alias("key"))
        had = existing(spark, f"{out}/batches/version={epoch}") if epoch else None
        had = spark.createDataFrame([], "batch string, pending bigint, ranked bigint") if had is None else had
        found = S.select_candidates(df, seen, excluded, scope, cap, earlier=S.Earlier(had, again))
        found.write.mode("overwrite").parquet(f"{out}/candidates/epoch={epoch}")
        written = spark.read.schema(found.schema).parquet(f"{out}/candidates/epoch={epoch}")
        new = written.groupBy("batch").agg(F.count_if(F.col("status") == "pending").alias("pending"), F.count("*").alias("ranked"))
        both = had.unionByName(new).groupBy("batch").agg(F.sum("pending").alias("pending"), F.sum("ranked").alias("ranked"))
        both.coalesce(1).write.mode("overwrite").parquet(f"{out}/batches/version={epoch + 1}")
        keys = written.withColumn("_key", S.row_key()).select(F.coalesce("domain", named).alias("key")).distinct()
        registry.register(staged(keys, "keys"), epoch)

    return rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


ATTEMPTS = "attempts bigint, state string"
SETTLED = ("done", "given_up")
#: Groups that companies are dealt into for their state: what a call of Python costs is shared by those of a group. It is part of a stream's checkpoint.
ATTEMPT_GROUPS = 4096
#: Events that a task holds before the shuffle.
EVENTS_HELD = 1 << 17


class Attempts(StatefulProcessor):
    """Attempts of a group of companies, a map entry each: open ones are kept as long as it takes, what is settled (done or given up) for ttl_ms after its
    last event, if given. Each use of an entry is a message to the JVM, so without a time to live one map holds both, a group without entries is asked once,
    and what stays as it was is not written.
    """

    def __init__(self, max_attempts: int, ttl_ms: int | None):
        self.max_attempts, self.ttl_ms = max_attempts, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getMapState("open", "key string", ATTEMPTS)
        self.settled = self.open if self.ttl_ms is None else handle.getMapState("settled", "key string", ATTEMPTS, self.ttl_ms)

    def _states(self) -> list[MapState]:
        both = (self.open,) if self.settled is self.open else (self.open, self.settled)
        return [state for state in both if state.exists()]

    def _had(self, key: str, states: list[MapState]) -> tuple[int, str] | None:
        for state in states:
            if state.containsKey((key,)):  # a value that is not there would be logged
                return tuple(state.getValue((key,)))
        return None

    def _keep(self, key: str, had: tuple[int, str] | None, now: tuple[int, str]) -> None:
        if self.settled is self.open or now[1] not in SETTLED:
            if now != had:
                self.open.updateValue((key,), now)
            return
        if had and had[1] not in SETTLED:
            self.open.removeKey((key,))
        self.settled.updateValue((key,), now)  # also as it was: the time to live begins anew

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:  # noqa: N802, N803
        self._keep(initialState.key, self._had(initialState.key, self._states()), (initialState.attempts, initialState.state))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        first: dict[str, list[tuple[int, bool]]] = {}
        for row in rows:
            kept, event = first.setdefault(row.key, []), (row.order_key, row.ok)
            if len(kept) < self.max_attempts or event < kept[-1]:
                insort(kept, event)
                del kept[self.max_attempts :]
        states = self._states()
        for company, events in first.items():
            had = self._had(company, states)
            attempts, now = had or (0, "pending")
            for _, ok in events:
                if now in SETTLED:
                    break
                attempts += 1
                now = "done" if ok else "given_up" if attempts >= self.max_attempts else "error"
            self._keep(company, had, (attempts, now))
            yield Row(key=company, attempts=attempts, state=now)

    def close(self) -> None:
        pass


def _first_events(frames: Iterator[pd.DataFrame], max_attempts: int) -> Iterator[pd.DataFrame]:
    """The first events of each company among those that are held; they are handed on when that leaves too few out."""
    def cut(held: list[pd.DataFrame]) -> pd.DataFrame:
        return pd.concat(held).sort_values(["order_key", "ok"]).groupby("key", sort=False).head(max_attempts)

    held, size = [], 0
    for frame in frames:
        held.append(cut([frame]))
        size += len(held[-1])
        if size > EVENTS_HELD:
            held = [cut(held)]
            size = len(held[0])
        if size > EVENTS_HELD // 2 and len(held) == 1:
            yield held[0]
            held, size = [], 0
    if held:
        yield cut(held)


def stream_attempts(events: DataFrame, max_attempts: int = 2, ttl_ms: int | None = None, initial: DataFrame | None = None) -> DataFrame:
    """events (key, order_key, ok) to one row per key and micro-batch: attempts, and state done, error or given_up. A done company stays done, or for ttl_ms.

    initial: (key, attempts, state) of companies before the stream's first event. No more than the first max_attempts events of a company and micro-batch can
    matter (of one order key, what failed comes first; rows without one come last), so tasks leave out others before the shuffle, and then a task holds that
    many of each company of a group, however many events a company has. State lies in RocksDB, which the session's streams use from now on. With ttl_ms,
    a stream that is to end when all is read needs spark.sql.streaming.noDataMicroBatches.enabled set to false; time passes between its runs.
    """
    spark = events.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")

    def dealt(df: DataFrame) -> GroupedData:
        return df.withColumn("_group", F.pmod(F.xxhash64("key"), F.lit(ATTEMPT_GROUPS)).cast("int")).groupBy("_group")

    key, last = F.col("key").cast("string").alias("key"), F.lit((1 << 63) - 1)
    whole = events.filter("key IS NOT NULL").select(key, F.coalesce(F.col("order_key").cast("long"), last).alias("order_key"), F.coalesce("ok", F.lit(False)).alias("ok"))
    return dealt(whole.mapInPandas(lambda frames: _first_events(frames, max_attempts), whole.schema)).transformWithState(
        Attempts(max_attempts, ttl_ms), f"key string, {ATTEMPTS}", "Update", "None" if ttl_ms is None else "ProcessingTime",
        dealt(initial.filter("key IS NOT NULL").select(key, F.col("attempts").cast("long"), "state")) if initial is not None else None,
    )


def _records(snapshots: str, schema: T.StructType) -> Buckets:
    return Buckets(f"{snapshots}/records", "id", schema)


def _hosts(snapshots: str) -> Buckets:
    return Buckets(f"{snapshots}/hosts", "host", T.StructType([T.StructField("host", T.StringType()), T.StructField("id", T.StringType())]))


def create_snapshot(crm: DataFrame, snapshots: str, buckets: int = 256) -> None:
    """Version 0 of a CRM: its records in buckets by id, and an index of them by host."""
    _records(snapshots, crm.schema).create(crm, buckets)
    _hosts(snapshots).create(H.crm_hosts(crm).select("host", "id"), buckets)


def stream_upsert(props: DataFrame, snapshots: str, checkpoint: str) -> StreamingQuery:
    """Properties (key, props) as they arrive into the CRM below `snapshots` (create_snapshot): micro-batch n makes version n + 1 of version n.

    The index by host says which records a micro-batch is about; it reads the buckets that hold those, and writes the buckets in which a record changes or
    a new one belongs. The others are what they were, file by file.
    """
    def each(df: DataFrame, epoch: int) -> None:
        spark, hosts = df.sparkSession, _hosts(snapshots)
        records = _records(snapshots, _schema(spark, snapshots))
        of = records.entries(spark, epoch)[0].of
        keys = staged(df.filter("props IS NOT NULL").select(F.col("key").alias("host")).distinct(), "hosts")
        asked = hosts.read(spark, epoch, hosts.hit(keys, of)).join(keys, "host", "left_semi")
        ids = staged(asked.select("id").distinct(), "ids")
        near = records.read(spark, epoch, records.hit(ids, of)).join(ids, "id", "left_semi")
        plan = staged(H.plan_actions(df, near).filter("action IN ('created', 'updated')"), "plan")
        changed = F.when(F.col("action") == "created", H.new_id("key")).otherwise(F.col("id"))
        touched = records.hit(plan.select(changed.alias("id")), of)
        records.replace(H.merge_crm(records.read(spark, epoch, touched), plan), epoch + 1, touched)
        created = H.crm_hosts(plan.filter("action = 'created'").select(H.new_id("key").alias("id"), F.col("changes")["domain"].alias("domain"), F.col("changes")["website"].alias("website")))
        hosts.append(created.select("host", "id"), epoch + 1)

    return props.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _schema(spark: SparkSession, snapshots: str) -> T.StructType:
    return T.StructType([f for f in spark.read.parquet(f"{snapshots}/records/data/version=0").schema if f.name != "bucket"])


def latest_snapshot(spark: SparkSession, snapshots: str) -> DataFrame:
    newest = spark.read.parquet(f"{snapshots}/records/manifest").agg(F.max("version")).first()[0]
    return _records(snapshots, _schema(spark, snapshots)).read(spark, newest)
