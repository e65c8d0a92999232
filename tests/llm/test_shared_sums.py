import tracemalloc

import numpy as np

from claimloom.llm import shared


def test_row_sums_are_a_matrix_product():
    rnd = np.random.default_rng(1)
    sizes = np.concatenate([rnd.integers(1, 9, 5000), [1, 63, 64, 65, 5000, 130, 1], rnd.integers(1, 200, 50)])
    firsts = np.cumsum(sizes) - sizes
    rows, weights = rnd.integers(0, 70, sizes.sum()), rnd.random(sizes.sum())
    table = rnd.standard_normal((70, 11))
    want = np.array([weights[a : a + n] @ table[rows[a : a + n]] for a, n in zip(firsts, sizes, strict=True)])
    assert np.allclose(shared.row_sums(table, rows, weights, firsts), want)
    single = shared.row_sums(table.astype(np.float32), rows, weights.astype(np.float32), firsts)
    assert single.dtype == np.float32 and np.allclose(single, want, rtol=1e-4, atol=1e-3)
    none = np.zeros(0, np.int64)
    assert shared.row_sums(table, none, np.zeros(0), none).shape == (0, 11)


def test_sums_are_added_in_the_order_of_numpy():
    """To the last digit, whatever the lengths beside them."""
    rnd = np.random.default_rng(2)
    for kind in (np.float32, np.float64):
        for sizes in (rnd.permutation(np.arange(1, 400)), np.array([5000, 1, 129, 130, 20000, 2, 128]), np.full(300, 9)):
            firsts, n = np.cumsum(sizes) - sizes, sizes.sum()
            table, rows, weights = rnd.standard_normal((70, 11)).astype(kind), rnd.integers(0, 70, n), rnd.random(n).astype(np.float32)
            lines = np.ascontiguousarray((table[rows] * weights[:, None]).T)
            assert np.array_equal(shared.row_sums(table, rows, weights, firsts), np.add.reduceat(lines, firsts, axis=1).T)


def test_long_rows_are_summed_in_little_space():
    rnd = np.random.default_rng(3)
    table, rows = rnd.standard_normal((500, 80)).astype(np.float32), rnd.integers(0, 500, 400_000)
    weights, firsts = rnd.random(len(rows)).astype(np.float32), np.array([0, 200_000, 200_001])
    tracemalloc.start()
    try:
        sums = shared.row_sums(table, rows, weights, firsts)
        assert tracemalloc.get_traced_memory()[1] < 16 << 20  # all products at once would be 64 MB for each long row
    finally:
        tracemalloc.stop()
    want = np.array([weights[a:b].astype(np.float64) @ table[rows[a:b]] for a, b in ((0, 200_000), (200_000, 200_001), (200_001, 400_000))])
    assert np.allclose(sums, want, rtol=1e-4, atol=1e-2)
