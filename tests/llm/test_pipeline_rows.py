"""Rows of the pipeline are told apart without writing their texts once more."""

import corpus_pipeline
from tributary.llm import tables


def test_stored_rows_are_not_written_again(spark, monkeypatch):
    texts = [" ".join(f"{s}{i}" for i in range(40)) for s in "abc"]
    rows = [(k, texts[k % 3]) for k in range(30)] + [(4, texts[0]), (4, texts[0]), (None, texts[1])]
    made = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    stored = tables.written(made, "stored")
    names = []

    def written(df, name, write=tables.written):
        names.append(name)
        return write(df, name)

    monkeypatch.setattr(tables, "written", written)
    got = corpus_pipeline.near_duplicates(spark, stored, None)
    kept = [(0, texts[0]), (1, texts[1]), (2, texts[2]), (None, texts[1])]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, kept))
    assert "pipeline-rows" not in names
    # Rows that share a place in a file are told apart by number all the same.
    twice = stored.crossJoin(spark.range(2)).select("doc_id", "text")
    numbers = [r.n for r in corpus_pipeline.numbered(spark, twice, "n").collect()]
    assert len(set(numbers)) == 2 * len(rows) == len(numbers)
    assert "pipeline-rows" in names
    # An empty table has no files to number.
    assert corpus_pipeline.numbered(spark, tables.written(made.limit(0), "none"), "n").isEmpty()
