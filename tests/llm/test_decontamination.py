import pyarrow as pa
import pytest

from millrace.llm import decontamination
from tests.llm.odd import ROWS, empty, frame, prose
from tests.llm.test_near_dedup import shingles

ITEMS = [
    (1, prose(1, 30)),
    (2, prose(70, 40)),
    (3, prose(71, 16)),
    (4, None),
    (5, ""),
    (6, "ONE two"),
    (7, prose(72, 300)),
    (None, prose(73, 20)),
    (2, prose(74, 25)),
]
w70, w72 = prose(70, 40).split(), prose(72, 300).split()
HELD = ROWS + [
    (50, prose(80, 4000) + " " + prose(70, 40).upper() + " " + prose(81, 4000)),
    (51, " ".join(w70[:20]) + " , " + prose(82, 900) + " , " + " ".join(w70[16:])),  # in two places
    (52, " ".join(w70[:25])),  # too little
    (53, " ".join(w72[:250])),
    (54, prose(73, 20) + " " + prose(74, 25)),
    (55, " ".join(w72[:230])),
]


def brute(rows, items, percent=80):
    out = set()
    for d, t in rows:
        for i, x in items:
            a, b = shingles(t), shingles(x)
            if b and 100 * len(a & b) >= percent * len(b):
                out.add((d, i, len(a & b), len(b)))
    return out


def found(df):
    return {tuple(r) for r in df.select(decontamination.given_id(), decontamination.given_id("item"), "n_shared", "n_item").collect()}


@pytest.mark.parametrize("block", [50_000, 2])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontamination, "BLOCK_ITEMS", block)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = brute(HELD, ITEMS)
    assert found(decontamination.contaminated(frame(spark, HELD), items)) == want
    assert {(50, 2), (51, 2), (53, 7), (54, 2), (54, None), (1, 1)} <= {w[:2] for w in want} and (52, 2) not in {w[:2] for w in want}
    clean = decontamination.uncontaminated(frame(spark, HELD), items)
    assert clean.columns == frame(spark).columns
    assert sorted((r.text for r in clean.collect()), key=repr) == sorted((t for d, t in HELD if not brute([(d, t)], ITEMS)), key=repr)


def test_empty_sides(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontamination.contaminated(empty(spark), items).collect() == []
    assert decontamination.contaminated(frame(spark), items.limit(0)).collect() == []
    assert decontamination.uncontaminated(frame(spark), items.limit(0)).count() == len(ROWS)


def test_sketch_is_certain_for_small_items():
    """Whichever fifth of an item is missing, one sketched shingle stays."""
    ids = pa.array([0]).to_numpy()
    for n in (5, 9, 20, 60):
        items = decontamination.Items(ids, pa.array([prose(90 + n, n + 4)]), 5, 80)
        assert len(items.probe) >= min(n, n - -(-80 * n // 100) + 1)
