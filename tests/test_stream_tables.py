"""Tables as streams, be they one file or a folder of files."""

import shutil

import pytest

from tributary.checks import streams
from tributary.streaming import jobs


@pytest.mark.parametrize("folder", [True, False])
def test_a_table_is_one_file_or_a_folder(spark, tmp_path, folder):
    made, tables, out = (str(tmp_path / n) for n in ("made", "tables", "out"))
    rows = [(k, f"text {k}", "en", f"src{k % 3}", 6, f"h{k}") for k in range(9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, h string")
    docs.repartition(3 if folder else 1).write.parquet(made)
    (tmp_path / "tables" / ("documents.parquet" if folder else "")).mkdir(parents=True)
    for k, part in enumerate(sorted((tmp_path / "made").glob("part-*"))):
        place = f"documents.parquet/{part.name}" if folder else "documents.parquet"
        shutil.copy(part, f"{tables}/{place}")
        assert folder or k == 0
    drops = streams._stream(spark, tables, "fx_drops", "documents")
    query = drops.select("id").writeStream.format("parquet").option("path", out)
    jobs.finish(query.option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start())
    assert sorted(r.id for r in spark.read.schema("id bigint").parquet(out).collect()) == list(range(9))
