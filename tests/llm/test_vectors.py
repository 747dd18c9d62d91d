"""Vector links and top scores against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from postlake.llm.embedding_links import embedding_links, encode, estimates, rotation
from postlake.llm.queries import QUERIES
from postlake.llm.top_scores import inner_products, top_scores

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "vec_id bigint, embedding array<double>, label int, node string, bucket int"


def loop_links(rows, threshold=0.93):
    """``{place: (links, component)}`` over ``(vec_id, vector, label)``."""
    fine = [
        i for i, (_, v, label) in enumerate(rows)
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    unit = {i: np.array(rows[i][1], float) / np.linalg.norm(np.array(rows[i][1], float)) for i in fine}
    links, group = {i: 0 for i in range(len(rows))}, {i: i for i in range(len(rows))}
    for a in fine:
        for b in fine:
            if b < a and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold:
                links[a] += 1
                links[b] += 1
                old, new = group[a], group[b]
                group = {k: new if g == old else g for k, g in group.items()}
    least = {}
    for i, g in group.items():
        if rows[i][0] is not None:
            least[g] = min(least.get(g, rows[i][0]), rows[i][0])
    return [(rows[i][0], links[i], least.get(group[i])) for i in range(len(rows))]


def order(rows):
    return sorted(rows, key=repr)


def test_link_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = QUERIES["op7_embedding_links"](spark, FOLDER).collect()
    want = loop_links(rows)
    assert order((r.vec_id, r.n_links, r.component_id) for r in got) == order(want)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_links_of_awkward_vectors(spark, monkeypatch):
    monkeypatch.setattr("postlake.llm.embedding_links._BUCKET_ROWS", 8)
    draw = np.random.default_rng(1)
    base = draw.standard_normal(8)
    close = [(100 + i, (base + 0.1 * draw.standard_normal(8)).tolist(), 1) for i in range(60)]
    odd = [
        (1, None, 1), (2, [], 1), (3, [0.0] * 8, 1), (4, [float("nan")] * 8, 1), (5, [float("inf")] * 8, 1),
        (6, [None, *base.tolist()[1:]], 1), (7, base.tolist(), None), (8, base.tolist(), 2), (9, (base * 1e200).tolist(), 2),
        (10, (base * 1e-200).tolist(), 2), (11, base.tolist()[:5], 2), (12, [*base.tolist(), 0.0], 2), (None, base.tolist(), 2),
        (8, base.tolist(), 2), (None, (-base).tolist(), 2),
    ]
    rows = close + odd + [(200 + i, base.tolist(), 3) for i in range(40)]
    got = embedding_links(spark.createDataFrame([(*r, "n", 0) for r in rows], SCHEMA)).collect()
    tame = [(i, [x / 1e200 for x in v] if i == 9 else [x * 1e200 for x in v] if i == 10 else v, k) for i, v, k in rows]
    assert order((r.vec_id, r.n_links, r.component_id) for r in got) == order(loop_links(tame))
    empty = spark.createDataFrame([], SCHEMA)
    assert embedding_links(empty).collect() == [] and top_scores(empty, F.col("vec_id") == 1).collect() == []


def test_recall_at_the_threshold(spark):
    """Pairs just above the threshold, which the masks and bounds miss most easily."""
    draw = np.random.default_rng(2)
    rows = []
    for k in range(400):
        v, w = draw.standard_normal((2, 64))
        v /= np.linalg.norm(v)
        w -= (w @ v) * v
        w /= np.linalg.norm(w)
        rows += [(2 * k, v.tolist(), 1, "", 0), (2 * k + 1, (0.935 * v + math.sqrt(1 - 0.935**2) * w).tolist(), 1, "", 0)]
    got = embedding_links(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sum(r.n_links for r in got) >= 0.99 * 800


def test_estimates_are_unbiased_and_bounded():
    draw = np.random.default_rng(3)
    a, b = draw.standard_normal((2, 300, 64))
    b += 0.8 * a
    a, b = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (a, b))
    codes, factors = encode(a)
    guess, width = estimates(codes, factors, b)
    error = guess - a @ b.T
    assert abs(error.mean()) < 0.005 and (np.abs(error) <= width[:, None]).mean() > 0.999
    assert np.allclose(rotation(64, 256).T @ rotation(64, 256), np.eye(64))


def loop_top(rows, k, asks, factor=1024):
    whole = [
        (i, [math.floor(factor * x) for x in v])
        for i, v in rows
        if v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, v in whole:
        if q is None or not asks(q):
            continue
        in_longs = lambda s: min(max(s, -(1 << 63)), (1 << 63) - 1)
        products = [(sum(x * y for x, y in zip(v, w, strict=True)), i) for i, w in whole if i != q and len(w) == len(v)]
        scored = [(-in_longs(s), i) for s, i in products]
        scored.sort(key=lambda x: (x[0], x[1] is None, x[1] or 0))
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return out


def test_top_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = [tuple(r) for r in QUERIES["op10_top_scores"](spark, FOLDER).collect()]
    assert sorted(got) == sorted(loop_top(rows, 10, lambda q: q % 100 == 0))


@pytest.mark.parametrize("slices", [1, 2, 3])
def test_top_scores_of_awkward_vectors(spark, monkeypatch, slices):
    monkeypatch.setattr("postlake.llm.top_scores.CELL_ROWS", 40)
    monkeypatch.setattr("postlake.llm.top_scores.QUERY_ROWS", 4)
    monkeypatch.setattr("postlake.llm.top_scores._AT_ONCE", 16)
    draw = np.random.default_rng(4)
    rows = [(i, v.tolist()) for i, v in enumerate(draw.integers(-2, 3, (120, 5)) / 1024)]  # many ties
    rows += [(200 + i, (-np.abs(draw.standard_normal(3)) - 5 * (i % 2)).tolist()) for i in range(6)]
    rows += [(300, [1.5]), (301, [-2.5]), (302, [-1e12]), (303, [1e6]), (400, None), (401, []), (402, [float("nan")] * 5)]
    rows += [(403, [None] * 5), (None, [0.01] * 5)]
    frame = spark.createDataFrame([(i, v, 1, "n", 0) for i, v in rows], SCHEMA)
    asks = lambda q: q % 10 == 0 or q > 199
    got = top_scores(frame, (F.col("vec_id") % 10 == 0) | (F.col("vec_id") > 199), 4, slices)
    assert order(tuple(r) for r in got.collect()) == order(loop_top(rows, 4, asks))


@pytest.mark.parametrize("size, slices", [(1e6, 2), (1e9, 1), (1e15, 3), (1e20, 2), (1e30, 3)])
def test_large_components_take_part(spark, monkeypatch, size, slices):
    """Large vectors among ordinary ones lead and end lists, cancel out, leave the longs on both sides and tie."""
    monkeypatch.setattr("postlake.llm.top_scores.CELL_ROWS", 20)
    draw = np.random.default_rng(11)
    rows = [(i, v.tolist()) for i, v in enumerate(draw.standard_normal((60, 4)))]
    rows += [(60, [size, 0.0, 0.0, 0.0]), (61, [-size, 0.0, 0.0, 1.0]), (62, [size, -size, 1.0, 0.0])]
    rows += [(63, [size, size, size, -size]), (64, [0.0, 0.0, 0.0, size]), (65, [0.0, 0.0, 0.0, 0.0])]
    rows += [(70 + i, [-size] * 4) for i in range(6)] + [(80 + i, [size] * 4) for i in range(6)]
    frame = spark.createDataFrame([(i, v, 1, "n", 0) for i, v in rows], SCHEMA)
    rows = [(i, [x for x in v]) for i, v in frame.select("vec_id", "embedding").collect()]
    got = top_scores(frame, F.col("vec_id") % 5 == 0, 8, slices)
    assert order(tuple(r) for r in got.collect()) == order(loop_top(rows, 8, lambda q: q % 5 == 0))


def test_large_products_stay_exact():
    a = np.array([[1 << 31, 3]], np.int64)
    assert inner_products(a, a).tolist() == [[(1 << 62) + 9]]
