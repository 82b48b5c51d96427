import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import lm_scoring as lm
from millrace.llm.common import crc_fold, text_buffers
from tests.llm.odd import LOW, ROWS, empty, frame, prose, words


def brute_base(rows, held):
    count, n = Counter(), 0
    for i, t in rows:
        if not held(i):
            count.update([*words((t or "").translate(LOW)), None])
    n, v = sum(count.values()), len(count)
    out = []
    for i, t in rows:
        tokens = [*words((t or "").translate(LOW)), None]
        out.append((i, len(tokens), sum(count[x] > 0 for x in tokens), n, round(sum(math.log10((count[x] + 0.5) / (n + 0.5 * (v + 1))) for x in tokens), 6)))
    return sorted(set(out), key=repr)


@pytest.mark.parametrize("held", [2, 3])
def test_base_equals_brute_force(spark, held):
    """Rows without doc_id are in training here."""
    out = lm.unigram(frame(spark), F.coalesce(F.col("doc_id") % 4 != held, F.lit(True)))
    got = out.select(lm.given_id(), "n_tokens", "n_known", "train_tokens", F.round("base_score", 6)).distinct().collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_base(ROWS, lambda i: i is not None and i % 4 == held)


def test_base_without_training(spark):
    out = lm.unigram(frame(spark), F.lit(False)).collect()
    assert {(r.train_tokens, r.n_known, abs(round(r.base_score, 6))) for r in out} == {(0, 0, 0.0)}
    assert lm.unigram(empty(spark), F.lit(True)).collect() == []


@pytest.fixture(scope="module")
def trained(spark):
    docs = spark.createDataFrame([(i, prose(i, 150, 40)) for i in range(300)], "doc_id long, text string").repartition(6)
    return docs, lm.fit(docs, F.col("doc_id") % 5 != 1)


def bits(mixer, texts):
    return mixer.score(*text_buffers(pa.array(texts)))


def test_probabilities_of_the_next_symbol_sum_to_one(trained):
    """All one-byte continuations and the end share the probability of the text so far."""
    _, mixer = trained
    tree = mixer.tree
    context = "w" + "abc12 wx3 "
    data = np.frombuffer(context.encode(), np.uint8)
    s = lm.Symbols(tree, data, np.array([0, len(data)]))
    total, seen = 0.0, set()
    for leaf in range(lm.LEAVES):
        s.leaf[-1] = leaf
        _, node, bit, x, gate = mixer.inputs(s, len(s.leaf) - 1, len(s.leaf))
        place = mixer._places(node, mixer.mixed(x, gate, mixer.weights))
        total += 2.0 ** -lm._costs(mixer.map.reshape(-1))[2 * place + bit].sum()
        seen.add(leaf)
    assert abs(total - 1) < 1e-3
    rare = tree.leaf == tree.escape
    assert abs((2.0 ** -tree.cost[rare]).sum() - 1) < 1e-9


def test_model_beats_a_flat_code_and_knows_its_language(trained):
    _, mixer = trained
    unseen = [prose(10_000 + i, 150, 40) for i in range(20)]
    per_byte = bits(mixer, unseen).sum() / sum(map(len, unseen))
    shuffled = ["".join(sorted(t)) for t in unseen]
    assert per_byte < 2.5 < bits(mixer, shuffled).sum() / sum(map(len, shuffled))


def test_score_does_not_depend_on_neighbours(trained):
    _, mixer = trained
    texts = [prose(1, 20), "", prose(2, 3000), "é漢", None, prose(3, 40), "x" * 9000]
    together = bits(mixer, texts)
    alone = [bits(mixer, [t])[0] for t in texts]
    assert np.allclose(together, alone, rtol=1e-4)
    assert (together > 0).all()


def test_long_texts_are_learned_from(trained):
    _, mixer = trained
    block = "zq" * 2000
    assert bits(mixer, [block * 4])[0] < 3 * bits(mixer, [block])[0]


def test_tables_do_not_depend_on_partitions(spark, trained):
    docs, mixer = trained
    again = lm.fit(docs.repartition(2), F.col("doc_id") % 5 != 1)
    assert (again.tables == mixer.tables).all() and (again.tree.size == mixer.tree.size).all()


def test_contexts_of_two_three_and_five_symbols_and_the_word(trained):
    """What lies beyond a context does not change its row; what lies in it does. No row sees the text before."""
    _, mixer = trained
    last = lambda text: [x[-1] for x in lm.Symbols(mixer.tree, *text_buffers(pa.array(["tail", text]))).slots]
    same = [[x == y for x, y in zip(last("a abcde"), last(t), strict=True)] for t in ("a bbcde", "a accde", "a abdde", "a abcda", "b abcde")]
    assert len(last("")) == 4 and [s[:3] for s in same] == [[True, True, False], [True, True, False], [True, False, False], [False] * 3, [True] * 3]
    assert [s[3] for s in same] == [False, False, False, False, True]
    assert last("ab") == [x[-1] for x in lm.Symbols(mixer.tree, *text_buffers(pa.array(["ab"]))).slots]


def test_gate_tells_whether_the_longest_context_is_known(trained):
    _, mixer = trained
    s = lm.Symbols(mixer.tree, *text_buffers(pa.array([prose(1, 50) + "zqxjkvzqxj"])))
    _, node, _, x, gate = mixer.inputs(s, 0, len(s.leaf))
    assert mixer.weights.shape == (4, 2 * lm.LEAVES) and (gate == 2 * node + (x[2] == 0)).all() and set(gate % 2) == {0, 1}


def test_weights_learn_inside_a_long_text(trained, monkeypatch):
    _, mixer = trained
    text = prose(77, 4000)
    with_steps = bits(mixer, [text])[0]
    monkeypatch.setattr(lm, "RATE", 0.0)
    assert len(text) > 2 * lm.BLOCK and bits(mixer, [text])[0] != with_steps


def test_every_training_text_is_counted_however_few(spark):
    texts = ["ababab", "cdcdcd", "efefef"]
    mixer = lm.fit(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), F.lit(True))
    for text in texts:
        s = lm.Symbols(mixer.tree, *text_buffers(pa.array([text])))
        assert all(mixer.tables[k].reshape(lm.SLOTS, -1)[s.slots[k]].any(axis=1).all() for k in range(lm.CONTEXTS))


def test_weights_and_map_are_learned_from_long_texts_too(spark):
    rows = [(i, prose(i, 30_000)) for i in range(4)]
    assert min(len(t) for _, t in rows) > 100_000
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    mixer, again = lm.fit(docs, F.lit(True)), lm.fit(docs.repartition(3), F.lit(True))
    start = lm.Mixer(mixer.tree, mixer.tables)
    assert (mixer.weights != start.weights).any() and (mixer.map != start.map).any()
    # Partitions learn apart from each other, so the mean depends on them a little; the texts' scores hardly do.
    one, two = (bits(m, [prose(90, 300)])[0] for m in (mixer, again))
    assert abs(one - two) < 0.01 * one


def test_learning_equals_a_plain_loop(trained, monkeypatch):
    """Weights move after every step, by the slopes of its decisions over their faded curvature."""
    _, mixer = trained
    monkeypatch.setattr(lm, "STEP_SYMBOLS", 90)
    s = lm.Symbols(mixer.tree, *text_buffers(pa.array([prose(500 + i, 30) for i in range(3)])))
    own = lm.Mixer(mixer.tree, mixer.tables)
    got = own.learn(s)
    weights, curves = np.full((lm.CONTEXTS, lm.GATES), 0.4), np.zeros((lm.CONTEXTS, lm.GATES))
    used, n = np.zeros((lm.CONTEXTS, lm.GATES)), np.zeros(lm.GATES)
    for a in range(0, len(s.leaf), 90):
        slope, curve = np.zeros((lm.CONTEXTS, lm.GATES)), np.zeros((lm.CONTEXTS, lm.GATES))
        for i in range(a, min(a + 90, len(s.leaf))):
            path = slice(mixer.tree.start[s.leaf[i]], mixer.tree.start[s.leaf[i]] + mixer.tree.size[s.leaf[i]])
            for node, bit in zip(mixer.tree.node[path].tolist(), mixer.tree.bit[path].tolist(), strict=True):
                x = np.array([mixer.tables[k][int(s.slots[k][i]) * lm.LEAVES + node] / lm.SCALE for k in range(lm.CONTEXTS)])
                gate = 2 * node + int(x[lm.LONGEST] == 0)
                p = 1 / (1 + math.exp(-min(max(float(x @ weights[:, gate]), -12), 12)))
                used[:, gate] += weights[:, gate]
                n[gate] += 1
                slope[:, gate] += (bit - p) * x
                curve[:, gate] += p * (1 - p) * abs(x).sum() * abs(x)
        curves = lm.FADING * curves + curve
        weights += lm.LEARNING * slope / (curves + lm.DAMP)
    assert np.allclose(own.weights, weights, atol=1e-4)
    assert np.allclose(got[: used.size].reshape(used.shape), used, rtol=1e-3, atol=1e-3)
    assert np.array_equal(got[used.size : used.size + lm.GATES], n)
    assert got[used.size + lm.GATES :].sum() == n.sum()


def test_score_equals_a_plain_loop(trained):
    _, mixer = trained
    for text in ("wab1 waa2 wcc33", prose(7, 20), "", "\u00e9 ?\t\tx"):
        s = lm.Symbols(mixer.tree, *text_buffers(pa.array([text])))
        total = float(s.costs(0, len(s.leaf)).sum())
        for i, leaf in enumerate(s.leaf.tolist()):
            for j in range(int(mixer.tree.size[leaf])):
                node, bit = (int(v[mixer.tree.start[leaf] + j]) for v in (mixer.tree.node, mixer.tree.bit))
                at = [int(s.slots[k][i]) * lm.LEAVES + node for k in range(lm.CONTEXTS)]
                unknown = int(mixer.tables[lm.LONGEST][at[lm.LONGEST]] == 0)
                odds = sum(float(mixer.tables[k][at[k]]) / lm.SCALE * float(mixer.weights[k, 2 * node + unknown]) for k in range(lm.CONTEXTS))
                odds = int(np.rint(odds * lm.UNIT))
                most = lm.CELLS * 2**lm.CELL_BITS // 2
                p = mixer.map[node, (min(max(odds, -most), most - 1) + most) >> lm.CELL_BITS]
                p = min(max(p, 1e-6), 1 - 1e-6)
                total -= math.log2(p if bit else 1 - p)
        assert bits(mixer, [text])[0] == pytest.approx(total, rel=1e-3)


def plain_bits(mixer, text):
    """Cost of a text whose weights and map learn after each block, decision by decision."""
    s = lm.Symbols(mixer.tree, *text_buffers(pa.array([text])))
    weights, seen, rare, total = mixer.weights.astype(float), np.zeros((lm.LEAVES, lm.CELLS, 2)), Counter(), 0.0
    most = lm.CELLS * 2**lm.CELL_BITS // 2
    for a in range(0, len(s.leaf), lm.BLOCK):
        slope, n, met = np.zeros((lm.CONTEXTS, lm.GATES)), np.zeros(lm.GATES), []
        escaped = [int(s.code[i]) for i in range(a, min(a + lm.BLOCK, len(s.leaf))) if s.leaf[i] == mixer.tree.escape]
        for c in escaped:
            total -= math.log2((lm.MAP_PRIOR * 2.0 ** -mixer.tree.cost[c] + rare[c]) / (lm.MAP_PRIOR + rare.total()))
        rare.update(escaped)
        for i in range(a, min(a + lm.BLOCK, len(s.leaf))):
            path = slice(mixer.tree.start[s.leaf[i]], mixer.tree.start[s.leaf[i]] + mixer.tree.size[s.leaf[i]])
            for node, bit in zip(mixer.tree.node[path].tolist(), mixer.tree.bit[path].tolist(), strict=True):
                x = np.array([mixer.tables[k][int(s.slots[k][i]) * lm.LEAVES + node] / lm.SCALE for k in range(lm.CONTEXTS)])
                gate = 2 * node + int(x[lm.LONGEST] == 0)
                odds = float(x @ weights[:, gate])
                cell = (min(max(int(np.rint(odds * lm.UNIT)), -most), most - 1) + most) >> lm.CELL_BITS
                zero, one = seen[node, cell]
                p = (lm.MAP_PRIOR * mixer.map[node, cell] + one) / (lm.MAP_PRIOR + zero + one)
                total -= math.log2(min(max(p if bit else 1 - p, 1e-6), 1 - 1e-6))
                slope[:, gate] += (bit - 1 / (1 + math.exp(-min(max(odds, -12), 12)))) * x
                n[gate] += 1
                met.append((node, cell, bit))
        weights += lm.RATE * slope / (1 + n / 32)
        for place in met:
            seen[place] += 1
    return total


def test_texts_of_every_length_learn_while_they_are_scored(trained, monkeypatch):
    """Far below 4,096 symbols, and together with texts that end earlier or later."""
    _, mixer = trained
    texts = [prose(700, 100), "x", prose(701, 40), prose(702, 330), "", prose(703, 60) + "zq" * 200]
    got = bits(mixer, texts)
    assert max(map(len, texts)) < 4096 and np.allclose(got, [plain_bits(mixer, t) for t in texts], rtol=1e-3)
    monkeypatch.setattr(lm, "RATE", 0.0)
    longer = np.array([len(t) >= lm.BLOCK for t in texts])
    assert ((abs(bits(mixer, texts) - got) > 1e-6) == longer).all()


def test_a_lane_that_is_through_takes_the_next_text(trained, monkeypatch):
    """One long text beside twelve short ones: no more blocks are walked than the long one has, and scores stay the plain ones."""
    _, mixer = trained
    texts = [prose(800, 500)[: 12 * lm.BLOCK - 1], *(prose(801 + i, 100)[: 2 * lm.BLOCK - 1] for i in range(12))]
    blocks, walk = [], lm.Mixer.inputs_at
    monkeypatch.setattr(lm, "LANES", 4)
    monkeypatch.setattr(lm.Mixer, "inputs_at", lambda *a: (blocks.append(1), walk(*a))[1])
    got = bits(mixer, texts)
    assert [-(-(len(t) + 1) // lm.BLOCK) for t in texts] == [12, *[2] * 12] and len(blocks) == 12
    assert np.allclose(got, [plain_bits(mixer, t) for t in texts], rtol=1e-3)


def test_tables_travel_compressed(trained):
    _, mixer = trained
    packed = lm._Packed(mixer.tables)
    assert (packed.tables() == mixer.tables).all() and len(packed.data) < mixer.tables.size / 2


def test_odd_rows_and_no_training(spark, trained):
    docs, mixer = trained
    out = lm.scored(frame(spark), mixer).collect()
    assert len(out) == len(ROWS) and all(r.bits > 0 for r in out)
    assert lm.scored(empty(spark), mixer).collect() == []
    blank = lm.fit(docs, F.lit(False))
    assert all(b > 0 for b in bits(blank, ["abc", "", None]))


def test_query_columns(spark):
    out = lm.query(spark, "/root/testdata/sf0.001")
    rows = out.collect()
    assert len(rows) == 200 and {r.doc_id for r in rows} == set(range(200))
    held = {r.id for r in spark.range(200).where(crc_fold(F.col("id"), 5) == 1).collect()}
    assert all(r.score < 0 and r.base_score < 0 and r.held_out == (r.doc_id in held) for r in rows)
