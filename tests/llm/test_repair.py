"""Conversation repair against a plain dynamic programme and the SQL."""

import hashlib
import random
import zlib

import duckdb
import pytest

from check import canonical
from tributary.llm import oracle, queries, repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string, audit string, n string"
SPACE = " \t\n\x0b\x0c\r"


def damage(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        d = zlib.crc32(key.encode()) % 20
        if d == 1:
            text = ""
        if d == 2:
            text = "".join(c for c in text if c not in ".!?")
        if d == 4:
            role = "user"
        yield from [(conv, turn, role, text)] * {0: 0, 3: 2}.get(d, 1)


def plain(rows):
    """What one conversation's damaged rows must give."""
    def digest(conv, role, text):
        return hashlib.md5(f"{' ' if conv is None else conv}:{len(role)}:{role}:{text}".encode()).digest()

    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], digest(r[0], *r[2:])))
    faults, seen = [], set()
    for _, _, role, text in rows:
        bare = text.rstrip(SPACE)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else ""
        faults.append(fault or ("" if bare[-1] in ".!?" else "truncated"))
        seen.add((role, text))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    firsts = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:]))
    # Best (cost, audit, written) by last initial written.
    best = {"": (0, "", ())}

    def insert():
        for _ in range(3):
            for state, (cost, audit, out) in list(best.items()):
                to = "a" if state == "u" else "u"
                new = (cost + 5, audit + "I", (*out, f"{'user' if to == 'u' else 'assistant'}:"))
                best[to] = min(best.get(to, new), new)

    for (_, _, role, text), fault in zip(rows, faults):
        insert()
        after = {}
        for state, (cost, audit, out) in best.items():
            moves = [("D", 2, state, out)]
            if fault not in ("blank", "duplicate"):
                more, first = 5 * (fault == "truncated"), role[:1]
                if (state, first) in {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}:
                    moves.append(("K", more, first, (*out, f"{role}:{text}")))
                for name in ("user", "assistant"):
                    if state + name[0] in ("u", "su", "ua", "au"):
                        moves.append(("R", 1 + more, name[0], (*out, f"{name}:{text}")))
            for letter, more, to, written in moves:
                new = (cost + more, audit + letter, written)
                after[to] = min(after.get(to, new), new)
        best = after
    insert()
    cost, audit, out = min(best[s] for s in ("", "a") if s in best)
    sha = hashlib.sha256("\n".join(out).encode()).hexdigest()
    return gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha


def fixture():
    rnd = random.Random(11)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "User", "uncle", None]
    texts = ["Fine.", "Cut", "", " \n", "Why?", "Why? \t", "é!\n漢", None, "a\xa0", "No. " * 2000]
    rows = []
    for conv in [*range(150), None]:
        for turn in range(rnd.choice([1, 2, 4, 9, 30])):
            number = rnd.choice([turn, turn, turn, turn + 3, None, -turn])
            rows.append((conv, number, rnd.choice(roles), rnd.choice(texts) if rnd.random() < 0.5 else f"{turn}."))
    rows += [(500, 1, "user", "The same.")] * 40 + [(501, t, "user", "Again.") for t in range(60)]
    return rows


NAMES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("conversations"))
    rows = [(*r, "x", "y") for r in fixture()]
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(f"{folder}/conversations.parquet")
    return folder


def test_query_equals_the_plain_programme(spark, stored):
    by_conv = {r[0]: [] for r in fixture()}
    for row in damage(fixture()):
        by_conv[row[0]].append(row)
    found = queries.op11_conversation_repair(spark, stored).collect()
    assert len(found) == len(by_conv)
    for row in found:
        assert tuple(row[n] for n in NAMES) == plain(by_conv[row.conv_id]), row.conv_id


def test_query_equals_sql(spark, stored):
    duck = duckdb.connect()
    duck.sql(f"create view conversations as select * from '{stored}/conversations.parquet/*.parquet'")
    sql = oracle.statements()["op11_conversation_repair"]
    found = queries.op11_conversation_repair(spark, stored).toPandas()
    assert canonical(found) == canonical(duck.sql(sql).df())


def test_prices_converge_to_distances():
    rnd = random.Random(12)
    letters = [repair._code(i, f) for i in range(4) for f in range(4)]
    for _ in range(300):
        codes = "".join(rnd.choice(letters) for _ in range(rnd.randint(1, 6)))
        ends = [rnd.randint(0, 9) for _ in range(4)]
        lattice = repair.Lattice(codes, ends)
        nodes = range(lattice.last)
        far = [0 if n == lattice.last else 10**6 for n in range(lattice.last + 1)]
        for _ in range(len(far)):
            far = [min(c + far[to] for _, c, to in lattice.arcs(n)) for n in nodes] + [0]
        for node in rnd.sample(nodes, 4):
            assert lattice.settle(node) == far[node]
        # Feasible throughout: no arc is cheaper than the difference of prices.
        prices = lattice.prices
        assert all(prices[n] <= c + prices[to] for n in nodes for _, c, to in lattice.arcs(n))


def test_rows_and_their_order(spark):
    rows = [(1, 0, "user", "A."), (1, 1, "user", "B."), (1, 2, "assistant", "C"), (2, None, "assistant", "D.")]
    rows = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    edits = repair.audits(rows)
    assert {r.conv_id: (r.cost, r.audit) for r in edits.collect()} == {1: (3, "KRD"), 2: (2, "D")}
    made = repair.repaired(rows, edits).collect()
    assert [tuple(r) for r in made] == [(1, 0, "K", "user", "A."), (1, 1, "R", "assistant", "B.")]


def test_empty_table_and_long_conversation(spark):
    schema = "conv_id bigint, turn bigint, role string, text string"
    none = spark.createDataFrame([], schema)
    edits = repair.audits(none)
    assert edits.isEmpty() and repair.digests(repair.repaired(none, edits)).isEmpty()
    long = spark.range(30_000).selectExpr(
        "7L as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "concat(id, '.') as text"
    )
    row = repair.audits(long).first()
    assert (row.cost, row.audit) == (0, "K" * 30_000)
    assert repair.repaired(long, repair.audits(long)).count() == 30_000
