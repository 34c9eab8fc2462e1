import numpy as np
import pytest
from revstrata.llm import token_scan as T


def test_scan_stitches_blocks(spark, tmp_path):
    files = {"a.bin": [1, 2, 9, 9, 3, 4, 5, 6, 7, 8, 9, 1], "b.bin": [9], "c.bin": [], "d.bin": [1] * 11}
    for name, tokens in files.items():
        (tmp_path / name).write_bytes(np.array(tokens, dtype="<u2").tobytes())
    table = spark.createDataFrame([(n,) for n in files], "file string")
    for block in (1, 2, 3, 100):
        got = sorted((r.file, r.ordinal, r.start, r.n_tokens) for r in T.scan(table, str(tmp_path), separator=9, block_tokens=block).collect())
        assert got == [("a.bin", 0, 0, 2), ("a.bin", 1, 3, 0), ("a.bin", 2, 4, 6), ("a.bin", 3, 11, 1), ("b.bin", 0, 0, 0), ("d.bin", 0, 0, 11)]
    (tmp_path / "odd.bin").write_bytes(b"abc")
    with pytest.raises(Exception, match="inside a token"):
        T.scan(spark.createDataFrame([("odd.bin",)], "file string"), str(tmp_path)).collect()


def test_counts_against_the_tokenizer(odd, none):
    e = T.encoder(T.VOCABULARY)
    want = sorted(((r.doc_id, len(e.encode_ordinary(r.text or ""))) for r in odd.collect()), key=str)
    assert sorted(((r.doc_id, r.n_tokens) for r in T.count_tokens(odd, block_tokens=100).collect()), key=str) == want
    assert T.count_tokens(none).isEmpty()
