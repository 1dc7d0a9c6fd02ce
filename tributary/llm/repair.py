"""Conversation structure repair: the cheapest edits that restore the order of turns.

A conversation is repaired when its role initials read ``(s?(ua)+)?``.  Each row is
kept (0), given the role user or assistant (1) or deleted (2); empty rows of user or
assistant are inserted (5); a truncated row that stays costs 5 more; blank and
repeated rows must go.  Of the cheapest lists of edits the ASCII-least one counts.

Nodes are (rows read, last initial written), arcs are edits with integer costs.  The
auction algorithm grows a path from the source: with ``p`` the prices, it extends
to the neighbour of least ``cost + p``, or, where that exceeds the node's own price,
raises the price to it and contracts the path by one node.  Prices stay feasible
(``p(i) <= cost(ij) + p(j)``), so once the path ends the source's price is its
distance, and arcs on cheapest paths are tight.  The path is traced from node to
node by the least letter whose arc is tight after its head was priced, too.

A lattice covers ``SEGMENT`` rows; the four prices at its first row close the lattice
before it.  Each row is one letter of a code (initial and fault) by then: rows are
sorted by range, so a conversation of any size is split, and what meets per
conversation is a text as long as its list of edits.  Only ``repaired`` moves texts:
it merges them with the edits, one row at a time, in the order of each conversation.

Cases: null roles and texts count as one blank; a null turn comes first; a null
conversation is one of its own.  Rows of one turn are read by role and digest.
Empty texts are blank.  Rows that repeat are collapsed to a number before they move.
Empty tables give no rows.  Other columns are not looked at.
"""

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from tributary.llm import tables
from tributary.operators import scale

#: What counts as a blank, what ends a text, costs of edits.
BLANKS, STOPS = " \t\n\x0b\x0c\r", ".!?"
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

#: Rows that one lattice covers.
SEGMENT = 8

#: States: nothing written yet, or the initial written last.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_INITIALS = {"s": _SYSTEM, "u": _USER, "a": _ASSISTANT}
_FAULTS = ("", "truncated", "blank", "duplicate")
_FINE, _CUT, _BLANK, _TWICE = range(4)
#: The state that must follow each state, and what is left to pay after the last row.
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
_LAST = (0, 2 * INSERT, INSERT, 0)
_LEGAL = {(_SYSTEM, _USER), (_USER, _ASSISTANT), (_ASSISTANT, _USER)}


def _code(initial, fault):
    """One letter for a row's initial (a state, or _START for any other) and fault."""
    return chr(ord("A") + initial * len(_FAULTS) + fault)


def _parts(code):
    return divmod(ord(code) - ord("A"), len(_FAULTS))


def _edits(initial, fault, state):
    """(letter, cost, rows read, state after it) of each edit, by letter."""
    needed = _NEXT[state]
    made = [("D", DELETE, 1, state), ("I", INSERT, 0, needed)]
    if fault in (_BLANK, _TWICE):
        return made
    extra = TRUNCATED if fault == _CUT else 0
    if initial == needed or (initial, state) == (_SYSTEM, _START):
        made.append(("K", extra, 1, initial))
    made.append(("R", REROLE + extra, 1, needed))
    return made


_ARCS = {
    _code(i, f): [_edits(i, f, state) for state in range(4)]
    for i in range(4)
    for f in range(len(_FAULTS))
}


class Lattice:
    """Some rows, and what is to pay from each state behind them."""

    def __init__(self, codes, ends):
        self.codes, self.ends = codes, ends
        self.prices = [min(ends)] * (4 * len(codes) + 4)
        self.prices.append(0)
        self.last = len(self.prices) - 1

    def arcs(self, node):
        row, state = divmod(node, 4)
        if row == len(self.codes):
            return [("", self.ends[state], self.last)]
        return [
            (letter, cost, 4 * (row + step) + to)
            for letter, cost, step, to in _ARCS[self.codes[row]][state]
        ]

    def settle(self, source):
        """Auction from ``source``: its price becomes the distance to the end."""
        path, prices = [source], self.prices
        while path[-1] != self.last:
            node = path[-1]
            least, head = min((cost + prices[to], to) for _, cost, to in self.arcs(node))
            if prices[node] < least:
                prices[node] = least
                if len(path) > 1:
                    path.pop()
            else:
                path.append(head)
        return prices[source]

    def trace(self, node):
        """The least letters on tight arcs from ``node``, and the state they end in."""
        self.settle(node)
        made = []
        while node < self.last - 4:
            for letter, cost, to in self.arcs(node):
                if self.prices[node] == cost + self.prices[to] == cost + self.settle(to):
                    made.append(letter)
                    node = to
                    break
        return "".join(made), node % 4


def solve(codes):
    """(cost, audit) of the rows that ``codes`` stands for."""
    places = range(0, len(codes), SEGMENT)
    ends = [_LAST]
    for at in reversed(places):
        lattice = Lattice(codes[at : at + SEGMENT], ends[-1])
        ends.append([lattice.settle(state) for state in range(4)])
    cost, audit, state = ends.pop()[_START], [], _START
    for at in places:
        letters, state = Lattice(codes[at : at + SEGMENT], ends.pop()).trace(state)
        audit.append(letters)
    return cost, "".join(audit) + "I" * (_LAST[state] // INSERT)


@lru_cache(20_000)
def _solved(codes):
    return solve(codes)


def illegal(codes):
    """Neighbours whose initials may not follow each other."""
    initials = [_parts(c)[0] for c in codes]
    return sum(pair not in _LEGAL for pair in zip(initials, initials[1:]))


def damaged(rows):
    """``rows`` damaged by a hash of conversation and turn; ``n`` tells the copies.

    Of 20 remainders 0 drops the row (``n`` 0), 1 empties its text, 2 removes its
    stops, 3 doubles it and 4 makes its role user.
    """
    blank = F.lit(" ")
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), blank),
        F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), blank),
    )
    text, role = F.coalesce("text", blank), F.coalesce("role", blank)
    hit = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key) % 20).alias("d"))
    return hit.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.when(F.col("d") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("d") == 1, "")
        .when(F.col("d") == 2, F.translate("text", STOPS, ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.when(F.col("d") == 0, 0).when(F.col("d") == 3, 2).otherwise(1).alias("n"),
    )


def _rows(rows):
    """The columns used, nulls replaced, each row with its digest and number."""
    blank = F.lit(" ")
    number = F.col("n").cast("bigint") if "n" in rows.columns else F.lit(1).cast("bigint")
    rows = rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), blank).alias("role"),
        F.coalesce(F.col("text").cast("string"), blank).alias("text"),
        number.alias("n"),
    )
    conv = F.coalesce(F.col("conv_id").cast("string"), blank)
    content = F.concat_ws(":", conv, F.char_length("role").cast("string"), "role", "text")
    return rows.withColumn("digest", F.unhex(F.md5(content)))


_ORDER = ["conv_id", "turn", "role", "digest"]


def judged(rows):
    """Distinct rows without their texts: initial, first fault and number.

    ``n`` counts the equal rows of a turn; all but the first of them are repeats.
    """
    held = _rows(rows)
    bare = F.rtrim("text", F.lit(BLANKS))
    fault = F.when(bare == "", _BLANK).when(~F.right(bare, F.lit(1)).isin(*STOPS), _CUT).otherwise(_FINE)
    first, initial = F.left("role", F.lit(1)), F.lit(_START)
    for letter, state in _INITIALS.items():
        initial = F.when(first == letter, state).otherwise(initial)
    light = held.select(*_ORDER, initial.alias("initial"), fault.alias("fault"), "n")
    once = light.groupBy(*_ORDER, "initial", "fault").agg(F.sum("n").alias("n"))
    once = tables.written(once, "repair-rows")
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn", "role")
    earliest = once.where("n > 0").groupBy("digest").agg(
        F.min(place).alias("first"), F.count(F.lit(1)).alias("turns")
    )
    # Content of a single turn, which nearly all is, needs no partner.
    again = earliest.where("turns > 1").select("digest", "first")
    placed = scale.skew_join(once, tables.written(again, "repair-repeats"), "digest", "left")
    later = F.col("first").isNotNull() & (place != F.col("first")) & (F.col("fault") != _BLANK)
    return placed.select(
        *_ORDER, "initial", F.when(later, _TWICE).otherwise(F.col("fault")).alias("fault"), "n"
    )


def _packed(rows):
    """(conv_id, part, k, codes): runs of sorted rows as one letter a row."""
    names = ["conv_id", "part", "k", "codes"]

    def pack(batches):
        part, k, conv, held, size = TaskContext.get().partitionId(), 0, None, [], 0

        def run():
            return pa.RecordBatch.from_arrays(
                [pa.array([conv], pa.int64()), pa.array([part], pa.int32()), pa.array([k], pa.int64()),
                 pa.array(["".join(held)], pa.string())], names,
            )

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "initial", "fault", "n"))
            for new, initial, fault, n in zip(*columns):
                if held and (new != conv or size >= 1 << 20):
                    yield run()
                    k, held, size = k + 1, [], 0
                conv = new
                again = _BLANK if fault == _BLANK else _TWICE
                held.append(_code(initial, fault) + _code(initial, again) * (n - 1))
                size += n
        if held:
            yield run()

    return rows.mapInArrow(pack, "conv_id bigint, part int, k bigint, codes string")


def _solutions(codes):
    """(conv_id, illegal, cost, audit) of (conv_id, codes)."""

    def work(batches):
        for batch in batches:
            made = [
                (illegal(c), *(_solved(c) if len(c) < 1000 else solve(c)))
                for c in batch.column("codes").to_pylist()
            ]
            kinds = [pa.int64(), pa.int64(), pa.string()]
            columns = [pa.array([m[i] for m in made], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), *columns], ["conv_id", "illegal", "cost", "audit"]
            )

    return codes.mapInArrow(work, "conv_id bigint, illegal bigint, cost bigint, audit string")


def audits(rows):
    """Per conversation: gaps, faults, cost and letters of the edits.

    ``rows`` has conv_id, turn, role, text and maybe ``n``, how often the row is
    there; a conversation of which no row is there has zeros and no edits.
    """
    rows = tables.written(judged(rows), "repair-judged")
    there = rows.where("n > 0")
    repeats = F.when(F.col("fault") == _BLANK, 0).otherwise(F.col("n") - 1)
    zero = F.lit(0).cast("bigint")
    turns = F.when(F.col("n") > 0, F.col("turn"))

    def total(condition, number):
        return F.sum(F.when((F.col("n") > 0) & condition, number).otherwise(zero))

    fault = F.col("fault")
    counted = rows.groupBy("conv_id").agg(
        F.coalesce(F.max(turns) - F.min(turns) + 1 - F.count_distinct(turns), zero).alias("gaps"),
        total(fault == _BLANK, F.col("n")).alias("blank"),
        total(F.lit(True), repeats + (fault == _TWICE).cast("bigint")).alias("duplicate"),
        total(fault == _CUT, F.lit(1)).cast("bigint").alias("truncated"),
    )
    order = [F.col(c).asc_nulls_first() for c in _ORDER]
    runs = _packed(there.repartitionByRange(*order).sortWithinPartitions(*order))
    # One row a run, together as long as the text of edits that comes out.
    joined = F.array_sort(F.collect_list(F.struct("part", "k", "codes")))
    codes = runs.groupBy("conv_id").agg(
        F.array_join(F.transform(joined, lambda r: r.codes), "").alias("codes")
    )
    solved = _solutions(codes).withColumnRenamed("conv_id", "c")
    return counted.join(solved, F.col("conv_id").eqNullSafe(F.col("c")), "left").select(
        "conv_id", "gaps", "blank", "duplicate", "truncated",
        F.coalesce("illegal", zero).alias("illegal"),
        F.coalesce("cost", zero).alias("cost"),
        F.coalesce("audit", F.lit("")).alias("audit"),
    )


class _Writer:
    """Rows of repaired conversations, as their rows come by."""

    def __init__(self):
        self.made = []

    def open(self, conv, audit):
        self.conv, self.audit, self.at, self.place, self.state = conv, audit, 0, 0, _START

    def _write(self, edit, role, text):
        self.made.append((self.conv, self.place, edit, role, text))
        self.place += 1
        self.state = _INITIALS[role[0]]

    def _needed(self):
        return "user" if _NEXT[self.state] == _USER else "assistant"

    def inserts(self):
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            self._write("I", self._needed(), "")

    def row(self, role, text, n):
        for _ in range(n):
            self.inserts()
            edit = self.audit[self.at]
            self.at += 1
            if edit != "D":
                self._write(edit, self._needed() if edit == "R" else role, text)

    def batch(self):
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
        names = ["conv_id", "position", "edit", "role", "text"]
        columns = zip(*self.made) if self.made else [[]] * len(names)
        self.made = []
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)


_REPAIRED = "conv_id bigint, position bigint, edit string, role string, text string"


def repaired(rows, edits):
    """Repaired rows (conv_id, position, edit, role, text), each conversation's
    rows in order within one task.

    ``edits`` is the result of ``audits`` on the same ``rows``.
    """
    rows = _rows(rows).where("n > 0").select("conv_id", F.lit(True).alias("row"), "turn", "role", "digest", "text", "n")
    first = edits.select("conv_id", F.lit(False).alias("row"), F.col("audit").alias("text"))
    both = rows.unionByName(first, allowMissingColumns=True)
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "row", "turn", "role", "digest")]

    def write(batches):
        writer, opened = _Writer(), False
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "row", "role", "text", "n"))
            for conv, row, role, text, n in zip(*columns):
                if row:
                    writer.row(role, text, n)
                else:
                    if opened:
                        writer.inserts()
                    writer.open(conv, text)
                    opened = True
            yield writer.batch()
        if opened:
            writer.inserts()
            yield writer.batch()

    return both.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(write, _REPAIRED)


def digests(rows):
    """(conv_id, sha) of ``repaired`` rows, by a hash that reads them one by one."""

    def work(batches):
        names = ["conv_id", "sha"]
        opened, conv, state = False, None, None
        for batch in batches:
            done = []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "position", "role", "text"))
            for new, position, role, text in zip(*columns):
                if position == 0:
                    if opened:
                        done.append((conv, state.hexdigest()))
                    opened, conv, state = True, new, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string())], names
            )
        if opened:
            yield pa.RecordBatch.from_arrays(
                [pa.array([conv], pa.int64()), pa.array([state.hexdigest()], pa.string())], names
            )

    return rows.mapInArrow(work, "conv_id bigint, sha string")
