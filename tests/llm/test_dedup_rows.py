"""Rows of near-duplicate search where many texts are alike, but too little for a link."""

import random

from tributary.llm import dedup, tables


def test_pairs_that_are_too_little_alike_are_no_rows(spark, monkeypatch):
    rnd = random.Random(11)
    passage = " ".join(f"p{i}" for i in range(80))
    rows = []
    # All pairs have about 0.65 in common; each tenth text has a near copy.
    for k in range(400):
        own = [f"x{rnd.randrange(10**9)}" for _ in range(20)]
        rows.append((k, f"{passage} {' '.join(own)}"))
        if k % 10 == 0:
            rows.append((1000 + k, f"{passage} {' '.join(own[:18])} y{k} z{k}"))
    held = []

    def written(df, name, write=tables.written):
        made = write(df, name)
        held.append((name, made.count()))
        return made

    monkeypatch.setattr(tables, "written", written)
    made = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in dedup.near_duplicates(made).collect()}
    assert got == {k: k % 1000 for k, _ in rows}
    assert any(name == "dedup-candidates" for name, _ in held)
    # A row per node and tree at most; the pairs are 96,580.
    assert all(n <= dedup.TREES * len(rows) for _, n in held), held


def test_links_of_crowded_blocks(spark, monkeypatch):
    rnd = random.Random(5)
    passage = [f"p{i}" for i in range(80)]
    rows = []
    # Chains: neighbours are near copies, the ends of a chain are not.
    for c in range(6):
        own = [f"x{c}y{rnd.randrange(10**9)}" for _ in range(120)]
        for k in range(10):
            rows.append((100 * c + k, " ".join(passage + own[5 * k : 5 * k + 20])))
    made = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    whole = {r.doc_id: r.component_id for r in dedup.near_duplicates(made).collect()}
    assert whole == {k: k // 100 * 100 for k, _ in rows}

    # The last step alone, all nodes apart, its regions in one block and in many.
    texts = tables.documents(made)
    features = tables.written(dedup.features(texts), "features")
    nodes = features.selectExpr("doc_id as id", "set_hash", "signature")
    trees, apart = dedup.forest(nodes), nodes.selectExpr("id", "id as component")
    for crowd in (dedup.CROWD, 7):
        monkeypatch.setattr(dedup, "CROWD", crowd)
        rest = tables.written(dedup._undecided(trees, nodes, apart), "rest")
        links = tables.written(dedup._links(rest, nodes, texts, 75), "links")
        named = {r.id: r.component for r in dedup.components(links).collect()}
        assert named == {k: c for k, c in whole.items() if k != c}
