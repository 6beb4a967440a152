"""Hard negatives against all inner products."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from attestra.llm import hard_negatives as h
from attestra.llm.common import prepared
from attestra.llm.queries import ORACLE, QUERIES
from tests import oracle
from tests.llm.conftest import SF_DIR

SCHEMA = "vec_id long, embedding array<float>, label int, block string, asked string, x string, id string, score string"


def plain_rows(raw):
    named = {}
    for vec_id, vector, label in raw:
        if vec_id is None or label is None or vector is None or any(c is None or not math.isfinite(c) for c in vector):
            continue
        whole = [math.floor(256 * max(-(2.0**20), min(2.0**20, float(np.float32(c))))) for c in vector]
        named[vec_id] = min(named.get(vec_id, (label, whole)), (label, whole))
    return [(v, *named[v]) for v in named]


def plain_mine(rows, anchors, how=h.DEFAULT):
    out = Counter()
    for a, label, vector in rows:
        if not anchors(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(vector, w)), v, other) for v, other, w in rows if v != a)
        for s, p, _ in [x for x in scored if x[2] == label][: how.positives]:
            inside = [(t, n) for t, n, other in scored if other != label and 30 * -s <= 100 * -t <= 90 * -s]
            out.update((a, p, rank, n, -s, -t) for rank, (t, n) in enumerate(inside[: how.negatives], 1))
    return out


def raw_rows(seed, count=400, dims=6):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.3) for _ in range(dims)] for _ in range(4)]
    raw = []
    for v in range(count):
        label = 0 if rng.random() < 0.4 else rng.randrange(4)
        raw.append((v, [c + rng.gauss(0, 0.25) for c in centres[label]], label))
    raw += [(1000 + k, raw[0][1], k % 3) for k in range(60)]  # copies: ties in score
    raw += [(2000, [0.0] * dims, 1), (2010, [], 2), (2020, [0.5], 1), (2030, [0.1] * (dims + 3), 0), (2040, [3e38, -3e38], 3)]
    raw += [(3000, None, 1), (3010, [0.1, None], 1), (3020, [float("nan")] * dims, 1), (3030, [float("inf")] * dims, 2), (3040, [0.1] * dims, None), (None, [0.1] * dims, 1)]
    raw += [raw[20], raw[20], (30, raw[31][1], 0), (30, raw[32][1], 3)]  # a repeated row, and an id with several vectors
    return raw


def frame(spark, raw):
    return prepared(spark).createDataFrame([(*r, *["x"] * 5) for r in raw], SCHEMA).repartition(3)


@pytest.mark.parametrize("seed, block_values, first_depth", [(1, 1 << 19, 32), (2, 300, 1), (3, 40, 4), (4, 1, 32)])
def test_mining(spark, seed, block_values, first_depth):
    raw = raw_rows(seed, 60 if block_values == 1 else 400)
    how = h.Mining(block_values=block_values, first_depth=first_depth)
    rows = h.integer_rows(frame(spark, raw))
    plain = plain_rows(raw)
    assert sorted((r.vec_id, r.label, r.x) for r in rows.collect()) == sorted(plain)
    got = Counter(tuple(r) for r in h.mine(rows, F.col("vec_id") % 10 == 0, how).collect())
    assert got == plain_mine(plain, lambda v: v % 10 == 0)


def test_search_stops_early_and_never_too_early():
    rng = np.random.default_rng(7)
    x = (rng.normal(size=(4000, 2)) * 256).astype(np.int64)
    block = h.Block(np.arange(4000), np.zeros(4000, np.int64), x)
    early = 0
    for anchor in (rng.normal(size=(40, 2)) * 256).astype(np.int64):
        best = h.Best(5)
        scored = h.search(block, anchor, np.ones(4000, bool), [best], 8)
        scores = x @ anchor
        want = np.lexsort((np.arange(4000), -scores))[:5]
        assert sorted(best.ids.tolist()) == sorted(want.tolist())
        early += scored < 2000
    assert early > 30


def test_nothing_to_mine(spark):
    rows = h.integer_rows(frame(spark, []))
    assert h.mine(rows, F.lit(True)).count() == 0
    rows = h.integer_rows(frame(spark, raw_rows(1)))
    assert h.mine(rows, F.lit(False)).count() == 0


def test_query(spark):
    name = "op13_threshold_algorithm"
    df, con = QUERIES[name](spark, SF_DIR), oracle.connect(SF_DIR)
    assert oracle.compare(df, con, ORACLE[name]) is None and oracle.compare_types(df, con, ORACLE[name]) is None
