import numpy as np
import pytest

from stormledger.llm import permutation

SCHEMA = "vec_id long, embedding array<float>, score int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)


def brute_force(rows, queries, k):
    good = {i: np.array(v, "f4").astype(float) for i, v in rows if v is not None and None not in v and np.isfinite(v).all() and any(v)}
    out = set()
    for q in queries:
        if q in good:
            near = [(-permutation.exact_cosines(good[q], good[i][None])[0], i) for i in good if i != q and len(good[i]) == len(good[q])]
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(near)[:k])}
    return out


def test_small_tables_are_exact(spark):
    """Copies, ties, odd vectors, and fewer candidates than asked for."""
    rng = np.random.default_rng(4)
    base = rng.normal(size=(6, 8)).round(2).tolist()
    rows = [(i, base[i % 6]) for i in range(30)] + [
        (50, base[0]), (50, base[0]), (60, None), (61, [0.0] * 8), (62, [float("nan")] * 8), (63, [None, *[1.0] * 7]),
        (64, [1.0, 2.0]), (65, [2.0, 4.0]), (66, [float("inf"), 1.0]), (100, [-x for x in base[1]]), (None, base[2]),
    ]
    vectors = table(spark, rows)
    ids = [0, 7, 50, 61, 62, 64, 100]
    got = permutation.nearest(vectors.where(vectors.vec_id.isin(ids)), vectors, 5).collect()
    exact = brute_force([r for r in rows if r[0] is not None], ids, 5)
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == sorted(x[:3] for x in exact)
    assert sorted(r.score for r in got) == sorted(x[3] for x in exact)


def test_empty_table(spark):
    assert permutation.nearest(table(spark, []), table(spark, []), 5).count() == 0


@pytest.mark.parametrize("blocks", [4096, 16])
def test_recall(spark, monkeypatch, blocks):
    monkeypatch.setattr(permutation, "FILE_BLOCK", blocks)
    monkeypatch.setattr(permutation, "QUERY_BLOCK", blocks)
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    assert permutation.measure_recall(vectors.where("vec_id % 50 = 0"), vectors, 5) >= 0.9


def test_footrule():
    q, e = np.array([3, 1, 0]), np.array([[3, 1, 0], [1, 3, 0], [2, 4, 5]])
    assert permutation.footrule(q, e).tolist() == [0, 2, 12]
