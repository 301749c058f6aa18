import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import neighbours


def _exact(rows, queries, top=5):
    """{query: [(vec, score)]} by comparing with every row, in double precision."""
    rows = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v
            and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))]
    out = {}
    for i, v in rows:
        if queries(i):
            all_of = sorted({(-float(v @ w / np.sqrt(v @ v) / np.sqrt(w @ w)), j) for j, w in rows if j != i and len(w) == len(v)})
            out[i] = all_of[:top]
    return out


def _found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((-r["score"], r["vec_id"]))
    return out


@pytest.mark.parametrize("sf, shard_rows", [("sf0.01", None), ("sf0.1", 400)])
def test_recall_and_scores(spark, monkeypatch, sf, shard_rows):
    if shard_rows:  # several shards
        plain = neighbours.nearest
        monkeypatch.setattr(neighbours, "nearest", lambda rows, queries: plain(rows, queries, shard_rows=shard_rows))
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").collect()]
    want = _exact(rows, lambda i: i % 50 == 0)
    got = _found(neighbours.op7_nearest_neighbours(spark, f"/root/testdata/{sf}"))
    assert set(got) == set(want)
    hits = sum(len({v for _, v in got[q]} & {v for _, v in want[q]}) for q in want)
    assert hits >= 0.95 * sum(len(w) for w in want.values())
    by_id = dict(rows)
    for q, best in got.items():
        assert best == sorted(best) and len(best) == len(want[q])
        a = np.array(by_id[q], float)
        for s, v in best:
            b = np.array(by_id[v], float)
            assert abs(s + a @ b / np.sqrt(a @ a) / np.sqrt(b @ b)) < 1e-12


def test_odd_rows_and_copies(spark):
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [None, 1.0]),
            (None, [1.0, 0.0]), (50, [1.0, 0.0]), (50, [1.0, 0.0]), (7, [0.5, 0.5]), (8, [1.0, 2.0, 3.0]), (100, [1.0, 0.0, 0.0]), (150, [])]
    rows += [(1000 + i, [0.0, 1.0]) for i in range(300)] + [(2000 + i, [0.0, float(i + 1)]) for i in range(5)]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, id int, v int")
    got = _found(neighbours.nearest(df, F.col("vec_id") % 50 == 0))
    want = _exact(rows, lambda i: i % 50 == 0)
    assert got.keys() == want.keys()
    for q in want:
        assert [round(s, 12) for s, _ in got[q]] == [round(s, 12) for s, _ in want[q]]
        assert [v for _, v in got[q]] == [v for _, v in want[q]] or q >= 1000
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert neighbours.nearest(df, F.lit(None).cast("boolean")).count() == 0


def test_many_shards_find_the_same(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(1200, 8)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = _exact(rows, lambda i: i % 50 == 0)
    for shard_rows in (100, 5000):
        got = _found(neighbours.nearest(df, F.col("vec_id") % 50 == 0, shard_rows=shard_rows))
        hits = sum(len({v for _, v in got[q]} & {v for _, v in want[q]}) for q in want)
        assert hits >= 0.97 * 5 * len(want)


def test_flat_arrays():
    rng = np.random.default_rng(0)
    g = neighbours.Graph(rng.normal(size=(500, 6)).astype(np.float32))
    for level, flat in enumerate(g.flat):
        for i in range(500):
            own = flat[i, :g.degree[level][i]]
            assert (own >= 0).all() and len(set(own.tolist())) == len(own) and i not in own and (g.level[own] >= level).all()
            assert (flat[i, g.degree[level][i]:] == -1).all()
