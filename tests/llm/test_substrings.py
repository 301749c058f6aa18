import hashlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.brute import DOC_SCHEMA, ODD_DOCS, SF
from tidemark.llm import substrings


def _brute(rows, length=100):
    """[(doc_id, text)] -> [(n_bytes, n_removed, n_spans, kept_sha256)] in input order, by a set of all strings."""
    seen, out = set(), {}
    for d, t in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            w = raw[i:i + length]
            if w in seen:
                gone[i:i + length] = True
            seen.add(w)
        edge = np.diff(np.r_[0, gone.astype(np.int8), 0])
        out[d, t] = (len(raw), int(gone.sum()), int((edge == 1).sum()), hashlib.sha256(bytes(np.frombuffer(raw, np.uint8)[~gone])).hexdigest())
    return [out[r] for r in rows]


def test_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r["doc_id"]: tuple(r)[1:] for r in substrings.op8_suffix_dedup(spark, SF).collect()}
    want = dict(zip([d for d, _ in docs], _brute(docs)))
    assert got == want and sum(w[1] > 0 for w in want.values()) > 5


def _removed(spark, rows, **parameters):
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, spans int, g int")
    out = substrings.repeated_spans(df, **parameters).collect()
    return sorted((str(r["doc_id"]), r["text"] or "", [(s["start"], s["end"]) for s in r["spans"]]) for r in out)


def _spans(rows, length=100):
    order = sorted({(d, t) for d, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, out = set(), {}
    for d, t in order:
        raw = (t or "").encode()
        gone = np.zeros(len(raw) + 1, np.int8)
        for i in range(len(raw) - length + 1):
            if raw[i:i + length] in seen:
                gone[i:i + length] = 1
            seen.add(raw[i:i + length])
        edge = np.diff(np.r_[0, gone])
        out[d, t] = list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))
    return sorted((str(d), t or "", out[d, t]) for d, t in rows)


def _mixed(n=120, seed=3):
    rng = np.random.default_rng(seed)
    word = lambda k: "".join(chr(97 + x) for x in rng.integers(0, 26, k))
    passage, line = word(260), word(130)
    rows = []
    for i in range(n):
        parts = [word(int(rng.integers(0, 300)))]
        if i % 2:
            parts.insert(int(rng.integers(0, 2)), passage[int(rng.integers(0, 40)):])
        if i % 5 == 0:
            parts += [line, "\n", line]
        if i % 7 == 0:
            parts.append("é𝒳" * int(rng.integers(0, 90)))
        rows.append((i * 3, "".join(parts)))
    return rows


@pytest.mark.parametrize("limit", [2000, 5])
def test_passages_at_any_offset(spark, limit):
    """Also with so low a limit that the crowded anchors go string by string."""
    rows = _mixed()
    assert _removed(spark, rows, group_segments=limit) == _spans(rows)


def test_odd_rows(spark):
    rows = [(d, t) for d, t, *_ in ODD_DOCS] + [(20, "a" * 1000), (21, "ab" * 300), (22, "lang " * 30)]
    assert _removed(spark, rows) == _spans(rows)
    empty = spark.createDataFrame([], DOC_SCHEMA)
    assert substrings.repeated_spans(empty).count() == 0


@pytest.mark.parametrize("limit", [2000, 2])
def test_equal_rows_keep_what_starts_first(spark, limit):
    """A text stored more than once under one id or without an id is one document."""
    rng = np.random.default_rng(8)
    word = lambda k: "".join(chr(97 + x) for x in rng.integers(0, 26, k))
    a, b, c, shared = word(150), word(400), word(700), word(160)
    rows = [(5, a)] * 2 + [(None, b)] * 3 + [(7, c + shared + c[:200])] * 2 + [(9, word(40) + shared + word(60))] * 2 + \
        [(9, word(90) + shared[20:] + a)] + [(11, b)] + [(d, word(30) + shared[d:] + word(30)) for d in range(20, 26)] * 2
    assert _removed(spark, rows, group_segments=limit) == _spans(rows)
    assert [x for _, t, x in _removed(spark, rows[:5], group_segments=limit) if t in (a, b)] == [[]] * 5


def test_equal_rows_in_any_batches():
    """Copies of a class's first are dropped, later places marked, however the sorted rows are cut into batches."""
    rows = [(1, 1, 0, 5, 0, 120)] * 3 + [(1, 1, 0, 5, 300, 420)] * 2 + [(1, 1, 3, 6, 0, 120)] + [(1, 2, 0, 5, 150, 260)] * 2
    for size in range(1, len(rows) + 1):
        batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[i:i + size])], ["g", "s", "d", "row", "at", "end"])
                   for i in range(0, len(rows), size)]
        out = [tuple(r.values()) for b in substrings._judge_classes(iter(batches), True) for r in b.to_pylist()]
        assert {r[3:] for r in out if r[0] == 0} == {(5, 300, 420), (6, 0, 120)}
        assert sorted(r[1:] for r in out if r[0] == 1) == [(1, 0, 5, 0, 120), (1, 0, 5, 150, 260)]


def test_long_texts_in_pieces(monkeypatch):
    """Runs cut by buffers of any size cover all starts once, with anchors inside all their strings."""
    rng = np.random.default_rng(5)
    texts = [bytes(rng.integers(97, 100, int(n)).astype(np.uint8)) for n in (50, 99, 100, 101, 5000, 777, 0)]
    for size in (150, 1000, 1 << 20):
        monkeypatch.setattr(substrings, "_BUFFER", size)
        doc, at, count, g, s = substrings.segments(texts)
        starts = sorted((int(d), int(a) + k) for d, a, c in zip(doc, at, count) for k in range(int(c)))
        assert starts == [(i, a) for i, t in enumerate(texts) for a in range(max(0, len(t) - 99))]
        by_string = {}
        for d, a, c, x in zip(doc, at, count, g):
            for k in range(int(c)):
                assert by_string.setdefault(texts[d][a + k:a + k + 100], x) == x


@settings(max_examples=150, deadline=None)
@given(st.binary(max_size=300).map(lambda b: bytes(97 + x % 2 for x in b)), st.integers(9, 40))
def test_longest_previous_factors(raw, length):
    data = np.frombuffer(raw, np.uint8)
    got = substrings.repeated_starts(data, np.full(len(data), len(data)), length).tolist()
    assert got == [i for i in range(len(raw) - length + 1) if raw.find(raw[i:i + length]) < i]
