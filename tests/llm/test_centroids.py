"""Centroids against a plain version over all distances, and the filter's bound."""

import hashlib
import math

import numpy as np
import pytest

from playbill.llm import centroids, queries


def plain(rows, k=8, rounds=10, seed=3, dims=64):
    kept = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    mark = lambda i: hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()
    centres = [v for _, v in sorted(kept, key=lambda r: (r[0] is None, mark(r[0])))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        parts = [[] for _ in centres]
        for _, v in kept:
            parts[nearest(v)[1]].append(v)
        centres = [[sum(x) // len(p) for x in zip(*p)] if p else c for p, c in zip(parts, centres)]
    return sorted((-1 if i is None else i, n, d) for i, (d, n) in ((i, nearest(v)) for i, v in kept)), centres


def got(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, i, 7) for i, v in rows], "vec_id long, embedding array<double>, cluster long, k int")
    out, centres = centroids.cluster_vectors(df.repartition(3), **kw)
    pairs = sorted((-1 if r["vec_id"] is None else r["vec_id"], r["cluster"], r["distance"]) for r in out.collect())
    return pairs, [r["centroid"] for r in centres.orderBy("cluster").collect()], centres


def test_odd_rows_ties_and_repeats(spark):
    rng = np.random.default_rng(0)
    rows = [(i, list(map(float, rng.normal(size=64) * (1 + i % 3)))) for i in range(60)]
    rows += [(100 + i, rows[i % 2][1]) for i in range(30)] + [(5, rows[5][1]), (None, rows[7][1])]
    rows += [(200, None), (201, []), (202, [1.0] * 63), (203, [1.0] * 65), (204, [float("nan")] * 64), (205, [None] + [0.0] * 63), (206, [math.inf] * 64)]
    pairs, centres, table = got(spark, rows)
    wanted, by_hand = plain(rows)
    assert pairs == wanted and centres == by_hand
    assert sum(r["n"] for r in table.collect()) == len(wanted)
    assert sum(r["inertia"] for r in table.collect()) == sum(d for _, _, d in wanted)


def test_few_equal_and_no_vectors(spark):
    same = [(i, [0.5] * 64) for i in range(12)]
    pairs, centres, _ = got(spark, same)
    assert pairs == [(i, 0, 0) for i in range(12)] and centres == [[512] * 64] * 8
    pairs, centres, _ = got(spark, same[:3])
    assert len(centres) == 3 and pairs == [(i, 0, 0) for i in range(3)]
    pairs, centres, table = got(spark, [(1, None), (2, [])])
    assert pairs == [] and centres == [] and table.columns == ["cluster", "centroid", "n", "inertia"]


def test_too_long_a_component(spark):
    with pytest.raises(Exception, match="63 bits"):
        got(spark, [(1, [1e9] + [0.0] * 63)])


def test_bound_never_exceeds_distance_and_spares_work():
    rng = np.random.default_rng(1)
    far = np.repeat(rng.integers(-4000, 4000, (8, 64)), 500, 0)
    whole = far + rng.integers(-300, 300, far.shape)
    centred = whole - whole.mean(0)
    axes = np.linalg.eigh(centred.T @ centred)[1][:, ::-1][:, :16]
    turn = centroids.Rotation(whole.mean(0), axes)
    centres = whole[::500]
    best, least, tried = centroids.nearest(whole, turn.sketch(whole), centres, turn.sketch(centres))
    full = ((whole[:, None] - centres[None]) ** 2).sum(2)
    assert (best == full.argmin(1)).all() and (least == full.min(1)).all()
    assert tried < 1.1 * len(whole)


def test_query_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    out = queries.op11_rotated_centroids(spark, str(tmp_path))
    assert out.count() == 0 and out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
