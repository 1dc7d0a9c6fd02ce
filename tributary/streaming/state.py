"""Keyed state with timers: subscriptions, fetch schedule and deliveries as streams.

A key's state lives in the state store of the task that owns its hash, so a batch
touches the keys it names and the timers that run out, whatever the size of the
whole.  What changes comes out as rows; nothing is rewritten per batch.  Times are
event times: timers run out when the watermark passes them.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from tributary.functions import text
from tributary.operators import schedule

#: Seconds before a failed push goes out again, and failures allowed.
RETRY_WAIT, MAX_RETRIES = 30, 5

_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _keyed(rows, key, processor, schema, times, initial=None):
    """``rows`` through ``processor``, one state per ``key``."""
    # Timers and maps of a key need the store on disk.
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", _PROVIDER)
    start = None if initial is None else initial.groupBy(key)
    return rows.groupBy(key).transformWithState(processor, schema, "Append", times, start)


class _Subscriptions(StatefulProcessor):
    """Per URL a map from channel to river, and the event that set it."""

    def init(self, handle):
        value = "river_id long, seq long, at long, live boolean"
        self.channels = handle.getMapState("channels", "channel_id long", value)

    def handleInitialState(self, key, initialState, timerValues):
        for row in initialState if isinstance(initialState, list) else [initialState]:
            # Older than any event.
            self.channels.updateValue((row.channel_id,), (row.river_id, -(2**63), 0, True))

    def handleInputRows(self, key, rows, timerValues):
        latest = {}
        for row in rows:
            known = latest.get(row.channel_id)
            if known is None or (row.seq, row.at) > (known.seq, known.at):
                latest[row.channel_id] = row
        for channel, row in latest.items():
            name = (channel,)
            held = self.channels.getValue(name) if self.channels.containsKey(name) else None
            if held is not None and (held[1], held[2]) >= (row.seq, row.at):
                continue
            live = row.op == "add"
            self.channels.updateValue(name, (row.river_id, row.seq, row.at, live))
            before = held is not None and held[3]
            if live != before or (live and held[0] != row.river_id):
                river = row.river_id if live else held[0]
                yield Row(url=key[0], channel_id=channel, river_id=river, deleted=not live)

    def close(self):
        pass


def subscriptions(changes, current):
    """STR-5, SET-7: changes (url, channel_id, river_id, deleted) of the subscriptions.

    ``changes`` is a stream of ``events.subscription_changes``, ``current`` the table
    (url, river_id, channel_id) before the first batch.  The last event of an entry wins,
    also over later batches; events that change nothing give no rows.
    """
    flat = changes.select(
        "url", "channel_id", "river_id", "op",
        F.col("seq.seq").cast("bigint").alias("seq"), F.col("seq.at").cast("bigint").alias("at"),
    )
    schema = "url string, channel_id bigint, river_id bigint, deleted boolean"
    return _keyed(flat, "url", _Subscriptions(), schema, "None", current)


_JOB = (
    "url string, next_fetch_time bigint, last_fetch_time bigint,"
    " last_fetch_etag string, last_fetch_modified string"
)


class _Schedule(StatefulProcessor):
    """Per URL its fetch state; a timer for the time it is due."""

    def init(self, handle):
        self.handle = handle
        self.state = handle.getValueState(
            "fetch", "seq long, due long, last long, etag string, modified string, submitted boolean"
        )

    def _expect(self, row, seq):
        # Each call asks the store by a message of its own; ``get`` gives None for no state.
        held = self.state.get()
        if held is not None:
            if held[0] >= seq:
                return
            if not held[5]:
                self.handle.deleteTimer(self._after(held[1]))
        fields = (seq, row.next_fetch_time, row.last_fetch_time, row.last_fetch_etag)
        self.state.update((*fields, row.last_fetch_modified, False))
        self.handle.registerTimer(self._after(row.next_fetch_time))

    @staticmethod
    def _after(due):
        # FLT-2 wants the clock past the due second, not at it.
        return due * 1000 + 500

    def handleInitialState(self, key, initialState, timerValues):
        for row in initialState if isinstance(initialState, list) else [initialState]:
            self._expect(row, -(2**63))

    def handleInputRows(self, key, rows, timerValues):
        last = max(rows, key=lambda r: r.seq)
        self._expect(last, last.seq)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        held = self.state.get()
        if held is None:
            return
        seq, due, last, etag, modified, submitted = held
        if submitted:
            return
        self.state.update((seq, due, last, etag, modified, True))
        yield Row(
            url=key[0], next_fetch_time=due, last_fetch_time=last,
            last_fetch_etag=etag, last_fetch_modified=modified,
        )

    def close(self):
        pass


def _not_outdone(responses):
    """``responses`` without those that, among the rows of an Arrow batch, another one of
    their URL is not behind in ``seq`` nor in time: only the last one is heard, and
    whichever of two is late by the clock, the earlier one is too."""

    def left(batches):
        for batch in batches:
            seq, time = batch.column("seq"), batch.column("last_fetch_time")
            whole = pc.and_(pc.is_valid(seq), pc.is_valid(time)).to_numpy(zero_copy_only=False)
            url = pc.dictionary_encode(batch.column("url"), null_encoding="encode").indices
            url, seq, time = (
                pc.fill_null(x, 0).to_numpy(zero_copy_only=False)[whole] for x in (url, seq, time)
            )
            order = np.lexsort((~time, ~seq, url))
            url, time = url[order], time[order]
            top = pd.Series(time).groupby(url).cummax().to_numpy()
            keep = np.ones(len(order), bool)
            keep[1:] = (url[1:] != url[:-1]) | (time[1:] > top[:-1])
            rows = np.flatnonzero(whole)[order][keep]
            rows = np.sort(np.concatenate([rows, np.flatnonzero(~whole)]))
            yield batch.take(pa.array(rows))

    return responses.mapInArrow(left, responses.schema)


def fetch_jobs(responses, current, interval=schedule.FETCH_INTERVAL):
    """STR-6/7, FLT-2/4, PRJ-5: a job for each URL when it is due, by a timer.

    ``responses`` is a stream of fetch responses, its clock their ``last_fetch_time``;
    ``current`` is the fetch state before it.  A URL for which a job went out has no other
    one until a response comes, which sets the next time; a response that is older
    than the last one changes nothing.
    """
    last = F.col("last_fetch_time")
    heard = responses.select("url", "seq", last, "last_fetch_etag", "last_fetch_modified")
    timed = _not_outdone(heard).select(
        "url", "seq", last, "last_fetch_etag", "last_fetch_modified",
        schedule.next_fetch_time(F.col("url"), last, interval).alias("next_fetch_time"),
        F.timestamp_seconds(last).alias("event_time"),
    ).withWatermark("event_time", "0 seconds")
    start = current.select(
        "url", "next_fetch_time", "last_fetch_time", "last_fetch_etag", "last_fetch_modified"
    )
    jobs = _keyed(timed, "url", _Schedule(), _JOB, "EventTime", start)
    return jobs.select(
        "url",
        text.plain_ampersands(F.col("url")).alias("fetch_url"),
        "next_fetch_time",
        "last_fetch_time",
        "last_fetch_etag",
        "last_fetch_modified",
        F.lit(False).alias("use_cache"),
        schedule.fetch_mode().alias("mode"),
    )


class _Deliveries(StatefulProcessor):
    """Per message the number of failures, and a timer for the next attempt."""

    def __init__(self, wait, most):
        self.wait, self.most = wait, most

    def init(self, handle):
        self.handle = handle
        self.state = handle.getValueState("delivery", "failures long, timer long")

    def _row(self, key, kind, attempt):
        return Row(message_id=key[0], kind=kind, attempt=attempt)

    def _after(self, failures, at):
        return failures, at + self.wait * 1000

    def _keep(self, held, now):
        """The state ``now`` in place of ``held``, either None for a settled message."""
        if now == held:
            return
        if held is not None:
            self.handle.deleteTimer(held[1])
        if now is None:
            self.state.clear()
        else:
            self.handle.registerTimer(now[1])
            self.state.update(now)

    def handleInputRows(self, key, rows, timerValues):
        # Each call asks the store by a message of its own: once per key and batch.
        held = now = self.state.get()
        for row in sorted(rows, key=lambda r: (r.status is not None, r.attempt or 0)):
            at = int(row.at_ms)
            if row.status is None:
                if now is None:
                    now = self._after(0, at)
                    yield self._row(key, "sent", 1)
                continue
            # Answers to a message that is settled, or was never sent, are not heard.
            if now is None:
                continue
            failures = now[0] + 1
            if row.status == 200:
                kind = "delivered"
            else:
                kind = "given up" if failures > self.most else None
            now = None if kind else self._after(failures, at)
            if kind:
                yield self._row(key, kind, failures)
        self._keep(held, now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        held = self.state.get()
        if held is None:
            return
        failures, timer = held
        if timer != expiredTimerInfo.getExpiryTimeInMs():
            return
        # No answer is tried again, without end (Q-24); the clock goes on from here.
        failures, timer = self._after(failures, timer)
        self.handle.registerTimer(timer)
        self.state.update((failures, timer))
        yield self._row(key, "sent", failures + 1)

    def close(self):
        pass


def deliveries(messages, wait=RETRY_WAIT, most=MAX_RETRIES):
    """STR-11, FLT-18: what to send and what is settled (message_id, kind, attempt).

    ``messages`` is a stream of (message_id, attempt, status, at): messages to send
    (status NULL) and the answers to them.  A message goes out at once and again ``wait``
    seconds after a failure or without an answer; an answer of 200 settles it as
    delivered, more than ``most`` failures as given up.  Settled messages leave the state.
    """
    timed = messages.select(
        "message_id", "attempt", "status", (F.unix_millis("at")).alias("at_ms"), "at"
    ).withWatermark("at", "0 seconds")
    schema = "message_id bigint, kind string, attempt bigint"
    return _keyed(timed, "message_id", _Deliveries(wait, most), schema, "EventTime")


class _Names(StatefulProcessor):
    """Per screen name its user id, and the events that wait for it, one a channel."""

    def init(self, handle):
        self.known = handle.getValueState("known", "user_id string")
        self.waiting = handle.getMapState("waiting", "channel_id long", "river_id long, op string, seq long, at long")

    def handleInputRows(self, key, rows, timerValues):
        rows = list(rows)
        found = [r.user_id for r in rows if r.user_id is not None]
        if found and not self.known.exists():
            # Of several ids that come at once the smallest; the known id stays.
            self.known.update((min(found),))
            for (channel,), (river, op, seq, at) in self.waiting.iterator():
                yield self._row(min(found), channel, river, op, seq, at)
            self.waiting.clear()
        held = self.known.get()[0] if self.known.exists() else None
        for row in (r for r in rows if r.user_id is None):
            if held is not None:
                yield self._row(held, row.channel_id, row.river_id, row.op, row.seq, row.at)
                continue
            name = (row.channel_id,)
            last = self.waiting.getValue(name) if self.waiting.containsKey(name) else None
            if last is None or (last[2], last[3]) < (row.seq, row.at):
                self.waiting.updateValue(name, (row.river_id, row.op, row.seq, row.at))

    @staticmethod
    def _row(user_id, channel, river, op, seq, at):
        return Row(type="follow", term=user_id, channel_id=channel, river_id=river, op=op, seq=seq, at=at)

    def close(self):
        pass


def follows_by_id(changes, user_ids):
    """JOIN-14 live: changes of follow terms with the user's id in place of the name.

    ``changes`` is a stream of ``events.predicate_changes``, ``user_ids`` one of captured
    (screen_name, user_id).  Events whose name has no id yet wait in the state, the last
    of each channel, until one is captured; none is dropped.
    """
    none = F.lit(None).cast("bigint")
    named = changes.where(F.col("type") == "follow").select(
        F.col("term").alias("name"), F.lit(None).cast("string").alias("user_id"), "channel_id", "river_id", "op",
        F.col("seq.seq").cast("bigint").alias("seq"), F.col("seq.at").cast("bigint").alias("at"),
    )
    captured = user_ids.where("user_id is not null").select(
        F.col("screen_name").alias("name"), F.col("user_id").cast("string").alias("user_id"),
        none.alias("channel_id"), none.alias("river_id"), F.lit(None).cast("string").alias("op"),
        none.alias("seq"), none.alias("at"),
    )
    schema = (
        "type string, term string, channel_id bigint, river_id bigint, op string, seq bigint, at bigint"
    )
    rows = _keyed(named.unionByName(captured), "name", _Names(), schema, "None")
    return rows.withColumn("seq", F.struct("seq", "at")).drop("at")
