"""Near-duplicate vectors against all pairs in double precision."""

import numpy as np
import pytest

from tidemark.llm import vector_dedup

SCHEMA = "vec_id bigint, embedding array<double>, node bigint, v string, copies int, one int"


def plain(rows, threshold):
    def unit(v):
        if v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        x = np.zeros(64)
        x[: len(v)] = v
        x = x / np.abs(x).max()
        return x / np.sqrt((x * x).sum())

    units = [unit(v) for _, v in rows]
    linked = [[j for j, b in enumerate(units) if j != i and a is not None and b is not None and (a * b).sum() >= threshold] for i, a in enumerate(units)]
    out = []
    for i, (vec_id, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        low = min(ids) if ids else None
        out.append((vec_id, len(linked[i]), low, vec_id == low))
    return out


def found(spark, rows, **kwargs):
    df = spark.createDataFrame([(i, v, 1, "clash", 2, 3) for i, v in rows], SCHEMA)
    return [tuple(r) for r in vector_dedup.near_vectors(df, **kwargs).collect()]


def same(a, b):
    assert sorted(a, key=repr) == sorted(b, key=repr)


def test_awkward_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0]), (3, [1.0, 0.0]), (None, [1.0, 0.1]), (4, None), (5, [0.0, 0.0]), (6, [float("nan"), 1.0]),
            (7, [float("inf"), 1.0]), (8, [1.0, None]), (9, []), (10, [1e300, 1e300]), (11, [1e-300, 1e-300, 0.0]), (12, [-1.0, -1.0]), (None, [0.0, 0.0, 5.0]), (13, [-0.0, -1.0]), (14, [0.0, -2.0])]
    same(found(spark, rows), plain(rows, 0.95))
    assert found(spark, []) == []


@pytest.mark.parametrize("threshold", [0.95, 0.5])
def test_matches_all_pairs_with_chains_and_crowds(spark, monkeypatch, threshold):
    """Chains of neighbours just above the threshold, a crowd in which all are linked, copies, and loose vectors, over
    several blocks and tiles."""
    monkeypatch.setattr(vector_dedup, "FEW", 100)
    monkeypatch.setattr(vector_dedup, "TILE_ROWS", 32)
    monkeypatch.setattr(vector_dedup, "TILE_COLUMNS", 48)
    rng = np.random.default_rng(5)
    vectors = list(rng.normal(size=(150, 16)))
    at = np.arange(60) * 0.3
    chain = np.zeros((60, 16))
    chain[:, 0], chain[:, 1], chain[:, 2] = np.cos(at), np.sin(at), at / 3
    centre = rng.normal(size=16)
    crowd = [centre + 0.12 * rng.normal(size=16) for _ in range(150)]
    vectors += [*chain, *crowd, *crowd[:20]]
    rows = [(i, [float(x) for x in v]) for i, v in zip(rng.permutation(len(vectors)).tolist(), vectors, strict=True)]
    want = plain(rows, threshold)
    assert {n for _, n, _, _ in want} >= {0} and max(n for _, n, _, _ in want) > 40
    same(found(spark, rows, threshold=threshold), want)


def test_bounds_hold_and_spare_full_precision():
    rng = np.random.default_rng(1)
    base = rng.normal(size=(40, 64))
    x = vector_dedup.unit_rows(np.concatenate([base, base + 0.01 * rng.normal(size=base.shape), base + 0.2 * rng.normal(size=base.shape)]))
    codes, scales, rest = vector_dedup.quantised(x)
    exact = x @ x.T
    near = scales[:, None] * scales * (codes.astype(int) @ codes.astype(int).T)
    assert (np.abs(exact - near) <= rest[:, None] + rest + rest[:, None] * rest).all()
    side = (x, codes, scales, rest)
    i, j, full = vector_dedup.tile_links(side, side, slice(0, 120), slice(0, 120), 0.95)
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == set(zip(*(y.tolist() for y in np.nonzero(exact >= 0.95)), strict=True))
    assert full < 400  # of 14400 pairs


def test_wide_vectors_stay_exact():
    rng = np.random.default_rng(2)
    x = vector_dedup.unit_rows(np.abs(rng.normal(size=(30, 3000))))
    side = (x, *vector_dedup.quantised(x))
    i, _, _ = vector_dedup.tile_links(side, side, slice(0, 30), slice(0, 30), 0.64)
    assert len(i) == ((x @ x.T) >= 0.64).sum()
