"""The helpers that the operators share."""

import pyarrow as pa

from tracewright.llm import _common


def test_without_ids_by_broadcast_and_by_bitmap(spark, monkeypatch):
    docs = spark.createDataFrame([(k if k % 7 else None, f"t{k}") for k in range(500)], "doc_id long, text string")
    gone = spark.createDataFrame([(k,) for k in range(0, 600, 3)], "__id long")
    want = sorted(f"t{k}" for k in range(500) if not k % 7 or k % 3)
    assert sorted(r.text for r in _common.without_ids(docs, gone).collect()) == want
    monkeypatch.setattr(_common, "BROADCAST_IDS", 10)
    monkeypatch.setattr(_common, "BITS", 1 << 16)
    got = _common.without_ids(docs, gone)
    assert got.columns == docs.columns and sorted(r.text for r in got.collect()) == want


def test_sliced_keeps_all_rows_within_the_bound():
    texts = ["x" * n for n in (0, 5, 300, 2, 2, 2, 1000, 1)] + [None]
    b = pa.RecordBatch.from_arrays([pa.array(range(9)), pa.array(texts)], ["k", "t"])
    got = list(_common.sliced([b, b.slice(0, 0)], 1, 300))
    assert [t for s in got for t in s.column(1).to_pylist()] == texts
    assert all(s.num_rows == 1 or sum(len(t or "") for t in s.column(1).to_pylist()) <= 300 for s in got)


def test_kept_frees_what_another_operator_held():
    assert _common.kept(("a",), lambda: [1]) is _common.kept(("a",), lambda: [2])
    _common.kept(("b",), list)
    assert _common.kept(("a",), lambda: [3]) == [3]
