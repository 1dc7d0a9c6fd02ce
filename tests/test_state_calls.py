"""Keyed state asks its store once per key and batch."""

from pyspark.sql import Row

from tributary.streaming import state


class Held:
    """A value and timers that count the messages."""

    def __init__(self):
        self.value, self.timers, self.asked = None, set(), 0

    def getValueState(self, name, schema):
        return self

    def exists(self):
        self.asked += 1
        return self.value is not None

    def get(self):
        self.asked += 1
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


def answer(attempt, status, at):
    return Row(attempt=attempt, status=status, at_ms=at)


def test_deliveries_ask_once():
    job, held = state._Deliveries(30, 2), Held()
    job.init(held)
    rows = [answer(1, 500, 2000), answer(0, None, 1000), answer(2, 500, 5000)]
    assert [r.kind for r in job.handleInputRows((7,), iter(rows), None)] == ["sent"]
    assert (held.asked, held.value, held.timers) == (1, (2, 35000), {35000})
    rows = [answer(3, 200, 6000), answer(4, 500, 7000)]
    got = [(r.kind, r.attempt) for r in job.handleInputRows((7,), iter(rows), None)]
    assert got == [("delivered", 3)]
    assert (held.asked, held.value, held.timers) == (2, None, set())


def test_schedule_asks_once():
    job, held = state._Schedule(), Held()
    job.init(held)

    def response(seq, due):
        return Row(seq=seq, next_fetch_time=due, last_fetch_time=1, last_fetch_etag="e", last_fetch_modified="m")

    for seq, due in ((1, 10), (2, 20), (1, 30)):
        list(job.handleInputRows(("u",), iter([response(seq, due)]), None))
    assert (held.asked, held.value[:2], held.timers) == (3, (2, 20), {20500})
    held.asked = 0
    assert [r.next_fetch_time for r in job.handleExpiredTimer(("u",), None, None)] == [20]
    assert list(job.handleExpiredTimer(("u",), None, None)) == [] and held.asked == 2


def test_outdone_responses_do_not_reach_the_state(spark):
    schema = "url string, seq long, last_fetch_time long, last_fetch_etag string, last_fetch_modified string"
    rows = [(f"u{k % 5}", k, 10 * k, None, None) for k in range(2000)]
    # A late one with a high number, a tie, and rows without number, time or URL.
    odd = [("u0", 9999, 5, "late", None), ("u1", 1996, 7, "tie", None), ("u2", None, 3, None, None)]
    odd += [("u3", 5, None, None, None), (None, 1, 1, None, None), (None, 2, 2, None, None)]
    made = spark.createDataFrame(rows + odd, schema).coalesce(1)
    got = sorted((r.url or "", r.seq or -1, r.last_fetch_time or -1) for r in state._not_outdone(made).collect())
    last = [(f"u{k % 5}", k, 10 * k) for k in range(1995, 2000)]
    assert got == sorted(last + [("u0", 9999, 5), ("u2", -1, 3), ("u3", 5, -1), ("", 2, 2)])
