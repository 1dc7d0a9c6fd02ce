"""The query of the encoder against the tokenizers library; words made to collide."""

import hashlib

import numpy as np
import pyarrow as pa
import public_tokenizers
from tokenizers import Tokenizer

from tributary.llm import bpe, queries, words

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def thue_morse(n, a, b):
    return "".join(b if bin(k).count("1") % 2 else a for k in range(n))


def test_query_equals_the_library(spark, tmp_path, monkeypatch):
    texts = [thue_morse(2048, "a", "b"), thue_morse(2048, "b", "a"), None, "", "<|endoftext|> Fine\n\n x", "é漢 ퟿"]
    texts += ["A sentence, and 12 more.\n" * 60_000 + "<|endoftext|>" + " end" * 300_000, "y" * 5000]
    rows = [(k % 7, t, "x") for k, t in enumerate(texts)]
    folder = f"{tmp_path}/documents.parquet"
    spark.createDataFrame(rows, "doc_id int, text string, ids string").repartition(2).write.parquet(folder)
    theirs, wanted = Tokenizer.from_file(VOCABULARY), []
    for k, text, _ in rows:
        ids = theirs.encode(text or "", add_special_tokens=False).ids
        decoded = theirs.decode(ids, skip_special_tokens=False)
        shas = (hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), decoded))
        wanted.append((k, len(ids), *shas))
    found = queries.op3_bpe(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, found.collect())) == sorted(wanted)


def test_cuts_do_not_show(monkeypatch):
    own = bpe.Codec(VOCABULARY)
    text = "It's 1, 2 and  3.\n\n So\tit\nis, isn't it? x  y . z\r\n" * 20
    whole = own.encode([text])
    for cut in (1, 7, 50):
        monkeypatch.setattr(bpe, "CUT", cut)
        assert own.encode([text]) == whole


def test_long_words_keep_apart():
    pair = pa.array([thue_morse(4096, "a", "b"), thue_morse(4096, "b", "a"), thue_morse(4096, "A", "b") + "   \n"])
    hashes, _ = words.word_hashes(*words.utf8(pair))
    assert hashes[0] != hashes[1] and hashes[0] == hashes[2]
    assert len(np.unique(hashes)) == 2
