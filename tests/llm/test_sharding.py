import hashlib
import random
import zlib
from itertools import groupby

import pytest

from millrace.llm import sharding
from tests.llm.odd import ROWS, empty, frame, prose


def brute(rows, shards):
    """Places of the rows by trying every capacity."""
    coded = sorted((hashlib.sha256((t or "").encode()).hexdigest(), i is None, i or 0, (t or "").encode()) for i, t in rows)
    groups = [[r for r in g] for _, g in groupby(coded, key=lambda r: r[0])]
    sizes = [sum(len(r[3]) + 1 for r in g) for g in groups]

    def packed(capacity):
        out, held = [[]], 0
        for k, size in enumerate(sizes):
            if size > capacity:
                return None
            if held + size > capacity:
                out.append([])
                held = 0
            out[-1].append(k)
            held += size
        return out if len(out) <= shards else None

    sums = sorted({sum(sizes[a:b]) for a in range(len(sizes)) for b in range(a + 1, len(sizes) + 1)})
    best = next((p for c in sums if (p := packed(c))), [])
    out = []
    for shard, members in enumerate(best):
        inside = [r for k in members for r in groups[k]]
        out += [(None if none else i, len(t) + 1, zlib.crc32(t), shard, slot) for slot, (_, none, i, t) in enumerate(inside)]
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("shards", [1, 2, 8])
def test_equals_brute_force(spark, shards):
    assert got(sharding.assigned(frame(spark), shards)) == brute(ROWS, shards)


@pytest.mark.parametrize("seed", range(3))
def test_copies_and_uneven_sizes(spark, seed):
    draw = random.Random(seed)
    texts = [prose(k, draw.choice([0, 1, 5, 60])) for k in range(60)]
    rows = [(draw.randrange(400), draw.choice(texts)) for _ in range(250)] + [(1000 + k, texts[7]) for k in range(120)] + [(5, texts[7])] * 30
    assert got(sharding.assigned(frame(spark, rows), 8)) == brute(rows, 8)


@pytest.mark.parametrize("seed", range(4))
def test_capacity_with_few_cells(spark, seed):
    draw = random.Random(seed)
    sizes = [draw.choice([1, 2, 9, 1000]) * draw.randrange(1, 50) for _ in range(3000)]
    ends, total = [], 0
    for s in sizes:
        total += s
        ends.append(total)

    def cuts(capacity, shards):
        at, out = 0, []
        for _ in range(shards):
            at = max([e for e in ends if e <= at + capacity], default=at)
            out.append(at)
        return out

    for shards in (2, 5):
        capacity, found = sharding.smallest_capacity(spark.createDataFrame([(e,) for e in ends], "end long"), total, shards, 1)
        assert cuts(capacity, shards) == found and found[-1] == total
        assert cuts(capacity - 1, shards)[-1] < total


def test_a_hot_text_spans_partitions(spark):
    rows = [(k, "same words") for k in range(4000)] + [(5000 + k, prose(k, 3)) for k in range(800)]
    sums = sharding.running_sums(frame(spark, rows))
    assert sums.where(sums.size == 11).count() == 4000
    chunks = spark.read.parquet(sums.inputFiles()[0].rsplit("/", 1)[0]).where("size = 11").select("chunk").distinct().count()
    assert chunks > 3


def test_empty_table(spark):
    assert got(sharding.assigned(empty(spark))) == []


def test_number_of_shards(spark):
    with pytest.raises(ValueError):
        sharding.assigned(frame(spark), 0)


def test_written_files_keep_rows_and_order(spark, tmp_path):
    docs = frame(spark)
    cuts = sharding.write_shards(docs, str(tmp_path / "shards"), 4)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(map(repr, back.select("row.*").collect())) == sorted(map(repr, docs.collect()))
    want = {(r[0], r[2]): r[3] for r in brute(ROWS, 4)}
    for r in back.collect():
        assert want[r.row.doc_id, zlib.crc32((r.row.text or "").encode())] == r.part_of
    assert cuts.capacity >= max(len((t or "").encode()) for _, t in ROWS)
    for part in (tmp_path / "shards").glob("part_of=*"):
        seen = [hashlib.sha256((r.row.text or "").encode()).hexdigest() for f in sorted(part.glob("*.parquet")) for r in spark.read.parquet(str(f)).collect()]
        assert seen == sorted(seen)
