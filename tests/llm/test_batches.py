import pyarrow as pa

from gridcube.llm.batches import small


def test_slices_are_bounded_and_whole():
    text = ["a" * n for n in (5, 0, 3, 40, 1, 1, 9)] + [None]
    b = pa.RecordBatch.from_pydict({"i": list(range(8)), "t": pa.array(text, pa.string()), "l": pa.array([[1] * n for n in range(7)] + [None])})
    for column, size in ((1, lambda s: sum(len(x or "") for x in s.column(1).to_pylist())), (2, lambda s: sum(len(x or []) for x in s.column(2).to_pylist()))):
        got = list(small([b], column, 10))
        assert pa.Table.from_batches(got).to_pydict() == b.to_pydict()
        assert all(size(s) <= 10 or s.num_rows == 1 for s in got)
    assert list(small([b.slice(0, 0)], 1)) == []
