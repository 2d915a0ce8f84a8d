"""Structured Streaming forms of the replay, of discovery and of run health. Each agrees with its batch form."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues
from pyspark.sql.types import StructType

from ..operators import discovery as steps
from ..sources.tables import forget, kept
from ..sources.versions import Versions


#: What a replay stream needs of its session: state that is read and written by entry.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
_REPLAYED = "key long, state string, ts timestamp, ord long, n_reviews long, n_updates long, future_ts timestamp, future_ord long, late boolean, kind string, version long"
_MICRO = 1_000_000
#: No time, or no position.
_NONE = int(np.iinfo(np.int64).min)
_KINDS = {"current": 1, "future": 2, "repealed": 3, "review": 4}
_DECISIVE = ("made", "gone", "created", "waits", "done")
#: An event that waits, and what is known of a key.
_EVENT = np.dtype([("key", "<i8"), ("ts", "<i8"), ("ord", "<i8"), ("kind", "u1")])
_SUM = np.dtype([("key", "<i8"), *[(f"{n}_{x}", "<i8") for n in _DECISIVE for x in ("ts", "ord")], ("n_reviews", "<i8"), ("n_updates", "<i8"), ("version", "<i8")])


class _Replay(StatefulProcessor):
    """State of one shard of keys: each key's decisive events so far, and the events that wait for the watermark by time bucket.

    What a micro-batch brings for a bucket is one entry; it is written once, and removed when a timer at the end of the bucket
    applies it, so a key with many waiting events costs what its events cost. Events behind what is applied of their key already
    go to the side output. State is read and written once for the keys of a shard, whose events are applied together.
    """

    def __init__(self, bucket: int):
        self.bucket = bucket

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getValueState("sums", "body binary")
        self.waiting = handle.getMapState("waiting", "bucket long, n long", "body binary")

    def _known(self) -> np.ndarray:
        return np.frombuffer(self.sums.get()[0], _SUM) if self.sums.exists() else np.empty(0, _SUM)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803  names of the API
        known = self._known()
        buckets: dict[int, list[np.ndarray]] = {}
        for f in rows:
            e = np.empty(len(f), _EVENT)
            e["key"], e["ts"], e["ord"], e["kind"] = f["key"], f["micros"], f["ord"], f["kind"].map(_KINDS).fillna(0)
            late = np.zeros(len(e), dtype=bool)
            if len(known):
                own = known[np.minimum(np.searchsorted(known["key"], e["key"]), len(known) - 1)]
                late = (own["key"] == e["key"]) & ~_after(e["ts"], e["ord"], own["done_ts"], own["done_ord"])
            if late.any():
                yield _rows(e["key"][late], ts=e["ts"][late], ord=e["ord"][late], late=True, kind=f["kind"].to_numpy()[late])
                e = e[~late]
            of = e["ts"] // _MICRO // self.bucket
            for b in np.unique(of).tolist():
                buckets.setdefault(b, []).append(e[of == b])
        for b, events in buckets.items():
            n = 0
            while self.waiting.containsKey((b, n)):  # one entry for each batch that the bucket has waited through
                n += 1
            self.waiting.updateValue((b, n), (np.concatenate(events).tobytes(),))
            self.handle.registerTimer((b + 1) * self.bucket * 1000)

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803  names of the API
        mark = expiredTimerInfo.getExpiryTimeInMs() // 1000
        entries = [k for k in map(tuple, self.waiting.keys()) if (k[0] + 1) * self.bucket <= mark]
        if not entries:
            return
        e = np.concatenate([np.frombuffer(self.waiting.getValue(k)[0], _EVENT) for k in entries])
        for k in entries:
            self.waiting.removeKey(k)
        s, touched = _applied(self._known(), e[np.lexsort((e["kind"], e["ord"], e["ts"], e["key"]))])
        self.sums.update((s.tobytes(),))
        s = s[touched]
        made, gone, created, waits, _ = ((s[f"{n}_ts"], s[f"{n}_ord"]) for n in _DECISIVE)
        public, future, repealed = _after(*made, *gone), _after(*waits, *gone), gone[0] != _NONE
        ts, order = (np.select([public, future], [m, w], g) for m, w, g in zip(made, waits, gone, strict=True))
        state = np.select([public, future, repealed], ["current", "future_effective", "repealed"], "unknown").astype(object)
        pending = public & _after(*waits, *created)
        future_ts, future_ord = (np.where(pending, w, _NONE) for w in waits)
        yield _rows(s["key"], state=state, ts=ts, ord=order, n_reviews=s["n_reviews"], n_updates=s["n_updates"], future_ts=future_ts, future_ord=future_ord, late=False, version=s["version"])

    def close(self) -> None:
        pass


def _after(ts: np.ndarray, order: np.ndarray, other_ts: np.ndarray, other_order: np.ndarray) -> np.ndarray:
    """Whether an event is later than another one; where there is no other one every event is, and where there is none it isn't."""
    return (ts > other_ts) | ((ts == other_ts) & (order > other_order))


def _applied(known: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What is known of all keys after events, which come in order within each key, and the places of the events' keys in it."""
    fresh = np.zeros(len(new := np.setdiff1d(e["key"], known["key"])), _SUM)
    fresh["key"] = new
    for n in _DECISIVE:
        fresh[f"{n}_ts"] = fresh[f"{n}_ord"] = _NONE
    s = np.concatenate([known, fresh])
    s = s[np.argsort(s["key"])]
    own = np.searchsorted(s["key"], e["key"])

    def put(name: str, at: np.ndarray) -> None:
        """Of several events of a key the last one stays."""
        s[f"{name}_ts"][own[at]], s[f"{name}_ord"][own[at]] = e["ts"][at], e["ord"][at]

    makes, waits, repeals, reviews = (np.flatnonzero(e["kind"] == code) for code in _KINDS.values())
    put("made", makes)
    put("waits", waits)
    put("gone", repeals)
    s["created_ts"][own[repeals]] = s["created_ord"][own[repeals]] = _NONE
    last = np.full(len(s), -1)
    last[own[repeals]] = repeals
    first = makes[(makes > last[own[makes]]) & (s["created_ts"][own[makes]] == _NONE)]
    put("created", first[::-1])
    ends = np.flatnonzero(np.r_[own[1:] != own[:-1], True])
    put("done", ends[_after(e["ts"][ends], e["ord"][ends], s["done_ts"][own[ends]], s["done_ord"][own[ends]])])
    s["n_reviews"] += np.bincount(own[reviews], minlength=len(s))
    s["n_updates"] += np.bincount(own[makes], minlength=len(s))
    s["version"][own[ends]] += 1
    return s, own[ends]


def _rows(key: np.ndarray, **values) -> pd.DataFrame:
    columns = {}
    for name in (column.split()[0] for column in _REPLAYED.split(", ")):
        v = values.get(name, key if name == "key" else None)
        if isinstance(v, np.ndarray) and name in ("ts", "future_ts"):
            v = pd.Series(v.view("datetime64[us]")).dt.tz_localize("UTC")  # no time is its NaT
        elif isinstance(v, np.ndarray) and v.dtype.kind == "i":
            v = pd.arrays.IntegerArray(v.copy(), v == _NONE)
        columns[name] = v
    return pd.DataFrame(columns)


def replay_stream(events: DataFrame, key: str, ts: str, order: str, kind: Column, lateness: str, bucket: int = 3600, shards: int = 1024) -> DataFrame:
    """key, state, ts, ord, n_reviews, n_updates, future_ts, future_ord, late, kind, version: the replay of events as a stream.

    A row tells the state of a key after all of its events before a time bucket (of `bucket` seconds) are applied in order of
    time and position; of a key's rows the one of the highest version holds. Events wait until the watermark has passed their
    bucket, so those that come out of order within `lateness` are applied in order. An event behind what is applied comes out
    as a row of its own with late = true, its time, position and kind; it changes no state. close_stream() makes the last
    events come due. Rows without a key or time are left out; at equal times one without a position comes first. Keys are dealt
    to `shards` by their hash, and state is kept for a shard; a stream keeps their number for its life. The session must use
    STATE_STORE.
    """
    rows = events.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).withWatermark(ts, lateness)
    # the time goes on as a number: rows behind the watermark must reach the processor, which puts them out as late
    position = F.coalesce(F.col(order).cast("long"), F.lit(_NONE))
    rows = rows.select(F.col(key).cast("long").alias("key"), F.unix_micros(F.col(ts).cast("timestamp")).alias("micros"), position.alias("ord"), kind.alias("kind"))
    return rows.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards))).groupBy("shard").transformWithStateInPandas(_Replay(bucket), _REPLAYED, "append", "eventTime").where("key <> -1")


def close_stream(schema: StructType, spark: SparkSession, key: str, ts: str) -> DataFrame:
    """One row of key -1 in the year 9000: as a stream's last file it moves the watermark past all events before."""
    values = [F.lit(-1).cast(f.dataType).alias(f.name) if f.name == key else F.lit("9000-01-01").cast(f.dataType).alias(f.name) if f.name == ts else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    return spark.range(1).select(*values)


def latest_states(replayed: DataFrame) -> DataFrame:
    """The last state of each key of a replay stream's output."""
    rows = replayed.where("NOT late")
    return rows.groupBy("key").agg(F.max_by(F.struct(*[c for c in rows.columns if c != "key"]), "version").alias("r")).select("key", "r.*")


def discovery(links: DataFrame, source: str, url: str, ts: str, lateness: str = "30 days") -> DataFrame:
    """Links whose url was not seen within the watermark."""
    return links.withWatermark(ts, lateness).dropDuplicatesWithinWatermark([source, url])


def discovery_batches(stream: DataFrame, state: Versions, checkpoint: str):
    """Discovery over a stream of links: each micro-batch is one step on the last version of the state, applied once."""

    def apply(links: DataFrame, batch: int) -> None:
        if not links.isEmpty():
            state.publish(lambda now: steps.step(now, links), batch)

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def discover(index: DataFrame, links: DataFrame, source: str, url: str, pending: str = "needs_review") -> DataFrame:
    """The batch step: action is baseline (a source's first run), new, retry or known.

    index: (source, url, classification) of earlier runs.
    """
    sources = index.select(source).distinct().withColumn("_old", F.lit(True))
    seen = index.select(url, F.col("classification").alias("_was")).dropDuplicates([url])
    out = links.dropDuplicates([url]).join(sources, source, "left").join(seen, url, "left")
    action = F.when(F.col("_was") == pending, "retry").when(F.col("_was").isNotNull(), "known").when(F.col("_old").isNull(), "baseline").otherwise("new")
    return out.withColumn("action", action).drop("_old", "_was")


def never_observed(configured: DataFrame, observed: DataFrame, source: str) -> DataFrame:
    return configured.join(observed.select(source).distinct(), source, "left_anti")


def health_stream(runs: DataFrame, ts: str, status: Column, lateness: str = "1 day") -> DataFrame:
    """day, seen: statuses of each day, final when the watermark has passed it."""
    return runs.withWatermark(ts, lateness).groupBy(F.window(ts, "1 day")).agg(F.collect_set(status).alias("seen")).select(F.to_date("window.start").alias("day"), F.sort_array("seen").alias("seen"))


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Drive a stream over what is there into a Parquet table and read that."""
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def upsert_batches(stream: DataFrame, model: Versions, log: Versions, key: str, order: str, merge: Callable[[DataFrame, DataFrame], DataFrame], checkpoint: str):
    """Keep a read model up to date with a stream of projections: one version for each micro-batch, and a log of the changes.

    merge(model, rows) gives the whole next model with action, before and after, as readmodel.upsert does; of a key's rows in a
    batch the last by `order` counts. A batch that comes again finds its id in the pointers and changes nothing. The log goes
    live first: a batch that breaks between the two finds its log there when it comes again, and only the model is made. An
    empty batch changes nothing. Each version is read back and its number of keys compared before it goes live.
    """

    def apply(rows: DataFrame, batch: int) -> None:
        if rows.isEmpty() or batch <= model.batch:
            return
        last = rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), order).alias("_r")).select("_r.*")
        merged = kept(merge(model.read(), last))
        try:
            noted = merged.where("action <> 'keep'").withColumn("batch", F.lit(batch).cast("long"))
            log.publish(lambda old: old.unionByName(noted.select(*log.schema.fieldNames())), batch)
            n = merged.count()
            model.publish(lambda _: merged, batch, lambda written, _: written.count() == n == written.select(key).distinct().count())
        finally:
            forget(merged)

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def file_stream(spark, path: str, schema, per_trigger: int | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    df = reader.parquet(path)
    return df.select(*columns) if columns else df
