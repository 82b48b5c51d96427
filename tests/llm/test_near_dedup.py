import numpy as np
import pytest

from millrace.llm import near_dedup
from millrace.llm.components import components
from tests.llm.odd import LOW, ROWS, empty, frame, prose, words


def shingles(text, n=5):
    w = words((text or "").translate(LOW))
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute(rows, percent):
    """(n_shingles, component_id, kept) of each row; rows of one id are one node, rows without id stand alone."""
    sets, up = [shingles(t) for _, t in rows], {i: i for i, _ in rows}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, (i, _) in enumerate(rows):
        for b, (j, _) in enumerate(rows[:a]):
            shared = len(sets[a] & sets[b])
            if sets[a] and i is not None and j is not None and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                low, high = sorted((root(i), root(j)))
                up[high] = low
    return sorted(((i, len(s), root(i), i is None or root(i) == i) for (i, _), s in zip(rows, sets)), key=repr)


def edited(base, k, every):
    w = base.split()
    for p in range(k % every, len(w), every):
        w[p] = f"edit{k}x{p}"
    return " ".join(w)


FAMILIES = ROWS + [(100 + k, edited(prose(50, 150), k, 60 + k % 7 * 20)) for k in range(40)] + [(200 + k, edited(prose(60, 90), k, 9 + k % 11)) for k in range(30)]


@pytest.mark.parametrize("members", [512, 5])
def test_equals_brute_force(spark, members):
    """With 5 members a family, the large-family way is taken."""
    for percent in (85, 60):
        got = near_dedup.near_duplicates(frame(spark, FAMILIES, 5), percent, family_members=members).collect()
        assert sorted((tuple(r) for r in got), key=repr) == brute(FAMILIES, percent)


def test_one_row_of_each_group_stays(spark):
    kept = near_dedup.representatives(frame(spark, FAMILIES + [(None, prose(4, 80))]), 80)
    assert kept.columns == frame(spark).columns
    got = kept.collect()
    ids = sorted(r.doc_id for r in got if r.doc_id is not None)
    assert ids == sorted({i for i, _, c, _ in brute(FAMILIES, 80) if i is not None and i == c})
    assert {r.text for r in got if r.doc_id is None} == {prose(4, 80), None} and sum(r.doc_id is None for r in got) == 2


def test_empty_table(spark):
    assert near_dedup.near_duplicates(empty(spark)).collect() == []
    assert near_dedup.representatives(empty(spark)).collect() == []


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(5)
    for n in (1, 3, 40, 900):
        value = rng.integers(0, 2**63, n).astype(np.uint64)
        sketch = near_dedup.fast_sketch(value, np.zeros(n, np.int64), 1)
        assert (sketch != np.uint64(2**64 - 1)).all()
    a, b, c = (rng.integers(0, 2**63, 300).astype(np.uint64) for _ in range(3))
    pair = [near_dedup.fast_sketch(np.concatenate([a, x]), np.zeros(600, np.int64), 1)[0] for x in (b, c)]
    assert abs((pair[0] == pair[1]).mean() - 1 / 3) < 0.15
    none = near_dedup.fast_sketch(np.zeros(0, np.uint64), np.zeros(0, np.int64), 2)
    assert (none == np.uint64(2**64 - 1)).all()


def test_components(spark):
    chain = [(i, i + 1) for i in range(50)] + [(100, 60), (70, 60), (80, 80), (5, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, 60: 60, 70: 60, 100: 60}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_rows_of_one_id_share_a_component(spark):
    """An id whose texts have nothing to do with each other joins what each of them reaches."""
    x, y, z, lone = prose(31, 60), prose(32, 60), prose(33, 60), prose(34, 40)
    rows = [(1, x), (2, y), (10, x), (10, y), (20, z), (21, z), (21, y), (30, lone), (30, lone), (31, prose(35, 40))]
    got = {(r.doc_id, r.component_id) for r in near_dedup.near_duplicates(frame(spark, rows)).collect()}
    assert got == {(1, 1), (2, 1), (10, 1), (20, 1), (21, 1), (30, 30), (31, 31)}
