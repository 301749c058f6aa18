import numpy as np
import pytest
import xxhash

from tests.llm.brute import DOC_SCHEMA, ODD_DOCS, SF, words
from tidemark.llm import components, simhash


def _fingerprint(text):
    w = [x.encode("utf-8", "surrogatepass").lower() for x in words(text)]
    shingles = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def _groups(rows, distance=2):
    """{row: smallest id} over [(id, code)] by comparing all pairs."""
    codes = sorted({c for _, c in rows})
    arr = np.array(codes, np.uint64)
    root = list(range(len(codes)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(codes)):
        for j in np.flatnonzero(np.bitwise_count(arr[i + 1:] ^ arr[i]) <= distance) + i + 1:
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    at = {c: find(i) for i, c in enumerate(codes)}
    low = {}
    for d, c in rows:
        if d is not None:
            low[at[c]] = min(low.get(at[c], d), d)
    return [low.get(at[c]) for _, c in rows]


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want_fp = {d["doc_id"]: _fingerprint(d["text"]) for d in docs}
    ids = sorted(want_fp)
    want = dict(zip(ids, _groups([(i, want_fp[i]) for i in ids])))
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.op6_simhash(spark, sf).collect()}
    assert got == {i: (f"{want_fp[i]:016x}", want[i]) for i in ids}
    assert any(c != i for i, c in want.items())


def test_odd_rows(spark):
    df = spark.createDataFrame(ODD_DOCS, DOC_SCHEMA).selectExpr("*", "1 AS fp", "2 AS component_id", "3 AS text_hash")
    got = sorted(((r["doc_id"], r["fp"] % 2 ** 64, r["component_id"]) for r in simhash.near_duplicates(df).collect()), key=str)
    rows = [(d[0], _fingerprint(d[1])) for d in ODD_DOCS]
    assert got == sorted(((d, c, g) for (d, c), g in zip(rows, _groups(rows))), key=str)
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({g for g in _groups(rows)})
    assert simhash.near_duplicates(df.limit(0)).count() == 0 and simhash.keep_first(df.limit(0)).count() == 0
    alone = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (None, "x y z")], "doc_id long, text string")
    assert simhash.keep_first(alone).count() == 2


def test_large_groups_are_divided(spark):
    """A dense ball and a chain of fingerprints, with groups far over the limit."""
    rng = np.random.default_rng(1)
    centre = int(rng.integers(1 << 62))
    ball = {centre ^ (1 << int(a)) ^ (1 << int(b)) ^ (1 << int(c)) for a, b, c in rng.integers(0, 64, (1500, 3))}
    chain = [0]
    for i in range(60):
        chain.append(chain[-1] ^ (1 << i))
    far = [int(x) for x in rng.integers(0, 1 << 62, 500)]
    codes = [*ball, *chain, *far]
    df = spark.createDataFrame([(i, simhash._signed(c)) for i, c in enumerate(codes)], "id long, fp long")
    edges = simhash.link_fingerprints(df, group_rows=16)
    pairs = edges.collect()
    at = {simhash._signed(c): i for i, c in enumerate(codes)}
    root = simhash._roots(len(codes), np.array([at[r["a"]] for r in pairs]), np.array([at[r["b"]] for r in pairs]))
    assert root.tolist() == _groups(list(enumerate(codes)))


def test_components(spark):
    edges = [(i + 1, i) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200), (-5, 300)]
    got = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200, -5: -5, 300: -5}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
