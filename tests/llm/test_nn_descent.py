import numpy as np
import pytest

from offerlens.llm import nn_descent
from offerlens.llm.queries import QUERIES


def brute(rows):
    ok = [(i, v is not None and l is not None and len(v) > 0 and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0)) for i, (_, v, l) in enumerate(rows)]
    good = [i for i, x in ok if x]
    links, parent = {i: 0 for i, _ in ok}, list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    unit = {i: np.array(rows[i][1], np.float32).astype(np.float64) for i in good}
    unit = {i: u / np.sqrt(u @ u) for i, u in unit.items()}
    for a in good:
        for b in good:
            if a < b and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.98:
                links[a] += 1
                links[b] += 1
                parent[find(a)] = find(b)
    low = {}
    for i, _ in ok:
        if rows[i][0] is not None:
            low[find(i)] = min(low.get(find(i), rows[i][0]), rows[i][0])
    return [(rows[i][0], links[i], low.get(find(i)), rows[i][0] is not None and low.get(find(i)) == rows[i][0]) for i, _ in ok]


def corpus():
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=16).tolist(), int(rng.integers(0, 3))) for i in range(200)]
    centre = rng.normal(size=16)
    rows += [(1000 + i, (centre + rng.normal(size=16) * 0.05).tolist(), 1) for i in range(90)]  # a dense group
    rows += [(2000 + i, rows[i][1], rows[i][2]) for i in range(0, 40)]  # copies
    rows += [(2100 + i, rows[5][1], rows[5][2]) for i in range(30)]
    rows += [(2200 + i, (np.array(rows[i][1]) * 1.01 + 0.02).tolist(), rows[i][2]) for i in range(40, 60)]
    rows += [(2300 + i, rows[i][1], (rows[i][2] + 1) % 3) for i in range(10)]
    bad = [None, [], [0.0] * 16, [float("nan")] * 16, [1.0, None] * 8, [float("inf")] + [1.0] * 15, [1.0, 2.0]]
    rows += [(3000 + i, v, 1) for i, v in enumerate(bad)] + [(3100, rows[0][1], None), (None, rows[7][1], rows[7][2]), (3200, rows[8][1], rows[8][2]), (3200, rows[8][1], rows[8][2])]
    rng.shuffle(rows)
    return [(None if r[0] is None else int(r[0]), r[1], r[2]) for r in rows]


@pytest.mark.parametrize("block", [512, 20])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(nn_descent, "BLOCK", block)
    rows = corpus()
    table = spark.createDataFrame([(*r, 1, 2.0) for r in rows], "vec_id long, embedding array<float>, label int, node int, cosine double")
    got = nn_descent.near_duplicates(table).collect()
    want = brute(rows)
    assert all(r.recall == 1 for r in got)
    assert sorted(map(str, ((r.vec_id, r.n_links, r.component_id, r.kept) for r in got))) == sorted(map(str, want))


def test_given_table_has_no_links(spark):
    got = QUERIES["op5_nn_descent"](spark, "/root/testdata/sf0.001").toPandas()
    assert len(got) == 500 and got.kept.all()


def test_empty_table(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert nn_descent.near_duplicates(empty).collect() == []


def test_lost_pairs_show_beside_a_dense_group(spark, monkeypatch):
    dense = [(1000, 1000, 7)] * 100
    assert nn_descent.node_recall(dense + [(1, 0, None)]) == 0.5 and nn_descent.node_recall(dense) == 1 == nn_descent.node_recall([])
    assert nn_descent.tables_for(10) == nn_descent.TABLES and nn_descent.tables_for(1 << 20) > nn_descent.tables_for(1 << 12) > nn_descent.TABLES
    monkeypatch.setattr(nn_descent, "ROUNDS", 2)
    monkeypatch.setattr(nn_descent, "node_recall", lambda audited: 0.5)
    table = spark.createDataFrame([(r[0], r[1], r[2]) for r in corpus()], "vec_id long, embedding array<float>, label int")
    with pytest.raises(RuntimeError, match="recall"):
        nn_descent.near_duplicates(table)
