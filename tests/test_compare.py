"""The comparison of query results with SQL results."""

from checks.compare import row_differences


def test_a_doubled_row_is_a_difference():
    assert row_differences(["a", "a", "b"], ["a", "b"]) == (["a"], [])
    assert row_differences(["a", "b"], ["a", "b", "b"]) == ([], ["b"])
    assert row_differences(["b", "a"], ["a", "b"]) == ([], [])


def test_order_counts_where_it_is_promised():
    assert row_differences(["a", "b", "c"], ["a", "b", "c"], in_order=True) == ([], [])
    assert row_differences(["a", "c", "b"], ["a", "b", "c"], in_order=True) == (["c", "b"], ["b", "c"])
