"""Near vectors against the cosines of all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from spotweave.llm import embeddings


def brute(rows, least=0.95):
    """id to set of (n_links, component_id, kept) of its rows."""
    good = [(i, k) for k, (i, v) in enumerate(rows) if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    n = dict.fromkeys(range(len(rows)), 0)
    for a, (i, p) in enumerate(good):
        for j, q in good[a + 1 :]:
            x, y = (np.array(rows[z][1], float) / np.abs(rows[z][1]).max() for z in (p, q))  # else squares overflow
            if len(x) == len(y) and x / np.linalg.norm(x) @ (y / np.linalg.norm(y)) >= least:
                n[p] += 1
                n[q] += 1
                r, s = root(i), root(j)
                parent[max(r, s)] = min(r, s)
    return sorted(((i, n[k], None if i is None else root(i), i is None or root(i) == i) for k, (i, _) in enumerate(rows)), key=str)


def made(kind):
    rng = np.random.default_rng(8)
    size = 24
    scale = np.exp(-np.arange(size) / 4) if kind == "steep" else np.ones(size)
    turn = np.linalg.qr(rng.normal(size=(size, size)))[0]
    base = (rng.normal(size=(150, size)) * scale) @ turn
    rows = list(base) + [base[k % 20] + rng.normal(size=size) * rng.choice([0.02, 0.06, 0.08]) * np.linalg.norm(base[k % 20]) / 2 for k in range(150)]
    rows += [base[3], base[3] * 2.5, base[3], -base[3], base[4] * 1e200, base[5] * 1e-200]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rows)]
    v = rows[0][1]
    rows += [(900, None), (901, []), (902, [0.0] * size), (903, [None, *v[1:]]), (904, [float("nan"), *v[1:]]), (905, [float("inf"), *v[1:]]), (None, v), (None, None)]
    rows += [(906, v[:5]), (907, v[:5]), (908, [-0.0, 1.0]), (909, [0.0, 1.0]), (910, v), (910, v), (911, rows[7][1]), (911, rows[9][1]), (911, None)]
    return rows


@pytest.mark.parametrize("kind", ["flat", "steep"])
@pytest.mark.parametrize("tile", [16, 1024])
def test_near_vectors_against_all_pairs(spark, monkeypatch, kind, tile):
    monkeypatch.setattr(embeddings, "TILE", tile)
    rows = made(kind)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"id": F.lit(1), "v": F.lit("x"), "kept": F.lit(2), "n_links": F.lit(3)})
    found = embeddings.near_vectors(spark, table.repartition(3)).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows)
    assert 20 < len({r.component_id for r in found}) < len(rows) - 100


def test_single_precision_and_other_names(spark):
    rows = [(i, [float(np.float32(x)) for x in v[:8]]) for i, v in made("flat")[:200]]
    table = spark.createDataFrame(rows, "k long, f array<float>")
    found = embeddings.near_vectors(spark, table, 0.8, "k", "f").collect()
    assert sorted(map(tuple, found), key=str) == brute(rows, 0.8)


def test_tiles_stop_early():
    """Far fewer products than dimensions for pairs that are far apart, and none of the near ones lost."""
    rng = np.random.default_rng(9)
    x = embeddings.unit(rng.normal(size=(400, 128)))
    y = embeddings.unit(x + rng.normal(size=x.shape) * 0.02)
    turn = np.linalg.eigh(x.T @ x)[1][:, ::-1]
    row, col = embeddings.tile_links(embeddings.Side(x, turn), embeddings.Side(y, turn), slice(0, 400), slice(0, 400), 0.95)
    want = np.nonzero(x @ y.T >= 0.95)
    assert sorted(zip(row, col)) == sorted(zip(*want)) and len(row) == 400


def test_no_vectors(spark):
    assert embeddings.near_vectors(spark, spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    only = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, embeddings.near_vectors(spark, only).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]
    with pytest.raises(ValueError):
        embeddings.near_vectors(spark, only, 0)
