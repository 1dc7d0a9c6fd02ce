"""The query's counts against the spans it lists."""

import hashlib
from collections import Counter

from tributary.llm import pii, queries


def test_counts_are_those_of_the_spans(spark, tmp_path):
    texts = ["no data", None, "a@b.co", "a@b.co c@d.fr e@f.de", "10.0.0.1 then 10.0.0.2",
             "4111 1111 1111 1111 a@b.co", "+1 (454) 555-9913, 10.0.0.1 +49 30 1234567",
             "to DE89 3704 0044 0532 0130 00"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op5_personal_data(spark, str(tmp_path)).collect()
    assert len(found) == len(texts)
    for row in found:
        spans = [s for s in row.spans.split(",") if s.split(":")[0] in pii.BASE]
        counted = Counter(s.split(":")[0] for s in spans)
        assert [row[f"n_{kind}"] for kind in pii.BASE] == [counted[kind] for kind in pii.BASE]
        assert row.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
    assert sorted((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in found) == [
        (0, 0, 0, 0, 0), (1, 0, 0, 0, 0), (2, 1, 0, 0, 0), (3, 3, 0, 0, 0), (4, 0, 2, 0, 0),
        (5, 1, 0, 1, 0), (6, 0, 1, 0, 2), (7, 0, 0, 0, 0),
    ]
