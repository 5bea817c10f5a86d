from sparkgate.llm import bpe, common


def test_large_ids_survive_beside_null_ids(spark):
    big = 2**60 + 1
    docs = spark.createDataFrame([(big, "a b"), (None, "c")], "doc_id long, text string")
    ranks = {bytes([i]): i for i in range(256)}
    coded = bpe.decode(bpe.encode(docs, ranks, r"\S+|\s+"), ranks)
    assert dict(coded.dtypes)["doc_id"] == "bigint"
    assert {r.doc_id: bytes(r.decoded) for r in coded.collect()} == {big: b"a b", None: b"c"}


def test_slices_keep_every_row():
    import pandas as pd
    frame = pd.DataFrame({"t": ["x" * n for n in (0, 5, 9, 1, 30, 0, 2)]})
    for size in (1, 7, 1000):
        parts = list(common.slices(iter([frame, frame.iloc[:0]]), "t", size))
        assert pd.concat(parts)["t"].tolist() == frame["t"].tolist()
        assert all(len(p) == 1 or p["t"].str.len().iloc[1:].sum() <= size for p in parts)
