"""Multiprobe hashing against brute force: recall, exact scores and order, copies, crowded buckets, odd vectors."""

import os

import numpy as np
import pytest

from aeroledger.llm import nearest_neighbours as nn

SCHEMA = "vec_id bigint, embedding array<float>, score string"


def brute(rows, k=20, every=20):
    """query row -> [(vec_id, score)] over the rows that take part."""
    part = sorted({(i, tuple(np.float32(v).tolist())) for i, v, _ in rows
                   if i is not None and v is not None and None not in v and np.isfinite(v).all() and any(v)})
    ids, x = np.array([i for i, _ in part]), np.array([v for _, v in part], float)
    out = {}
    for i, v in part:
        if i % every == 0:
            score = nn.exactly(x, np.broadcast_to(np.array(v), x.shape))
            order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(out[r.query_id]) == r["rank"]
    return out


def recall(got, want):
    hits = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) for q, w in want.items())
    return hits / sum(map(len, want.values()))


def test_probe_sets_ascend_and_hold_one_side():
    sets = nn.probe_sets(3, 100)
    assert len(sets) == 27 and len({tuple(s) for s in sets}) == 27 and not sets[0].any()
    assert all(s[j] + s[5 - j] <= 1 for s in sets for j in range(3))
    assert sets[1].tolist() == [1, 0, 0, 0, 0, 0]


def test_all_probes_reach_every_neighbouring_bucket():
    rng = np.random.default_rng(1)
    hashing, q = nn.Hashing(5, 3, 1, 27), nn.unit_queries(rng.normal(size=(4, 5)))
    probed = hashing.probed(q, 0, 0)
    steps = np.floor(hashing.places(q, 0))
    for k in range(4):
        around = np.stack(np.meshgrid(*[s + np.arange(-1, 2) for s in steps[k]]), -1).reshape(-1, 3)
        assert set(hashing.keys(around, 0, np.zeros(27, int)).tolist()) == set(probed[k].tolist())
        assert probed[k, 0] == hashing.bucket(q[k:k + 1], np.zeros(1, int), 0)[0]


def clustered(seed, n, dim=16, spread=1.0, norms=False):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    x = centres[rng.integers(12, size=n)] + spread * rng.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1)[:, None]
    return x * np.exp(rng.normal(size=(n, 1)) * 2) if norms else x


@pytest.mark.parametrize("norms", [False, True])
def test_recall_and_exact_scores(spark, norms):
    rows = [(i, v.tolist(), "clash") for i, v in enumerate(clustered(2, 3000, norms=norms))]
    want = brute(rows)
    got = found(nn.nearest(spark.createDataFrame(rows, SCHEMA).repartition(5)))
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert recall(got, want) >= 0.9
    scores = {(q, i): s for q, w in brute(rows, k=3000).items() for i, s in w}
    for q, w in got.items():
        assert w == sorted(w, key=lambda p: (-p[1], p[0])) and all(scores[q, i] == s for i, s in w)


def test_copies_ties_and_odd_rows(spark):
    x = clustered(3, 40, dim=6)
    rows = [(i, v.tolist(), "c") for i, v in enumerate(x)]
    rows += [(100 + i, x[0].tolist(), "c") for i in range(500)] + [(100, x[0].tolist(), "c")]           # copies; a repeated row
    rows += [(None, x[1].tolist(), "c"), (700, None, "c"), (720, [0.0] * 6, "c"), (740, [], "c"), (760, [1.0] * 5, "c"),
             (780, [float("nan")] * 6, "c"), (800, [float("inf")] + [0.0] * 5, "c"), (820, [None] * 6, "c"), (-20, x[2].tolist(), "c"),
             (840, [-0.0, 1.0] + [0.0] * 4, "c"), (841, [0.0, 1.0] + [0.0] * 4, "c")]
    want = brute([r for r in rows if r[1] is None or len(r[1]) == 6])
    whole = nn.Hashing(6, 4, 4, 81)
    got = found(nn.nearest(spark.createDataFrame(rows, SCHEMA).repartition(3), hashing=whole))
    assert {q: w for q, w in got.items()} == want and {-20, 0, 100, 840} <= set(got)


def test_crowded_buckets_are_searched_in_blocks(spark, monkeypatch):
    x = clustered(4, 400, dim=4, spread=0.01)
    rows = [(i, v.tolist(), "c") for i, v in enumerate(x)]
    hashing = nn.Hashing(4, 1, 1, 3)
    want = found(nn.nearest(spark.createDataFrame(rows, SCHEMA), every=2, hashing=hashing))
    monkeypatch.setattr(nn, "CELL_ROWS", 15)
    monkeypatch.setattr(nn, "ANSWER_ROWS", 2)
    assert found(nn.nearest(spark.createDataFrame(rows, SCHEMA), every=2, hashing=hashing)) == want == brute(rows, every=2)


def test_fewer_candidates_and_empty_tables(spark):
    few = [(0, [1.0, 0.0], "c"), (1, [0.5, 0.5], "c"), (20, [1.0, 0.0], "c")]
    assert found(nn.nearest(spark.createDataFrame(few, SCHEMA))) == brute(few)
    for rows in ([], [(1, [1.0], "c")], [(0, None, "c")]):
        empty = nn.nearest(spark.createDataFrame(rows, SCHEMA))
        assert empty.columns == ["query_id", "rank", "vec_id", "score"] and empty.count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="benchmark tables not present")
def test_recall_on_the_given_vectors(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    want = brute([(r.vec_id, r.embedding, None) for r in vectors.collect()])
    got = found(nn.nearest(vectors))
    assert set(got) == set(want) and recall(got, want) >= 0.9
