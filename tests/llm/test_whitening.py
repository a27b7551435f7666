"""Whitening against a plain computation over all rows."""

import math

import numpy as np
import pytest

from quarryline.llm import whitening


def plain(rows):
    """{(id, component): (n, deviation, whitened, explained)} of whole vectors."""
    whole = [(i, np.array([math.floor(256 * float(np.float32(c))) for c in v], object)) for i, v in rows]
    fit = {tuple(x) for _, x in whole}
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array([[c - s / n for c, s in zip(x, sums, strict=True)] for x in sorted(fit)], float)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    out = {}
    for i, x in whole:
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True))
        shift = np.array([c - s / n for c, s in zip(x, sums, strict=True)], float)
        for k in range(4):
            e = values[-1 - k]
            out.setdefault((i, k + 1), []).append((n, deviation, shift @ vectors[:, -1 - k] / math.sqrt(e), e / values.sum()))
    return out


def test_whiten(spark):
    rng = np.random.default_rng(3)
    spread = rng.normal(size=(6, 6))
    rows = [(i, [float(c) for c in rng.normal(size=6) @ spread]) for i in range(300)]
    rows += [(i, rows[7][1]) for i in range(400, 700)] + [(None, rows[3][1]), (7, rows[8][1])]  # a hot vector, odd ids
    odd = [(800, None), (801, []), (802, [1.0] * 5), (803, [1.0] * 5 + [None]), (804, [1.0] * 5 + [float("nan")]), (805, [float("-inf")] * 6)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows + odd], "vec_id long, embedding array<float>, at int, n int").repartition(5)
    got = whitening.whiten(df)
    assert got.columns[:4] == ["vec_id", "embedding", "at", "n"]
    got = got.collect()
    want = plain(rows)
    assert len(got) == 4 * len(rows)
    sign = {}
    for r in got:
        options = want[r["vec_id"], r["_ql_component"]]
        assert any(
            r["_ql_n"] == n and r["_ql_deviation"] == deviation and abs(r["_ql_explained"] - share) < 1e-9
            and abs(abs(r["_ql_whitened"]) - abs(w)) < 1e-7
            and sign.setdefault(r["_ql_component"], r["_ql_whitened"] * w > 0) == (r["_ql_whitened"] * w > 0)
            for n, deviation, w, share in options
        )
        assert r["_ql_identity_error"] < 1e-9


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_nothing_to_whiten(spark, rows):
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert got.count() == 0 and "_ql_whitened" in got.columns


def test_fewer_components_and_large_entries(spark):
    rows = [(1, [0.0, 0.0, 5.0]), (2, [1e15, 0.0, 5.0]), (3, [3e15, 0.0, 5.0])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert [(r["_ql_component"], r["_ql_n"], round(r["_ql_explained"], 9), r["_ql_deviation"]) for r in got] == [(1, 3, 1.0, None)] * 3
    values = {r["vec_id"]: r["_ql_whitened"] for r in got}
    assert abs(sum(values.values())) < 1e-9 and abs(sum(v * v for v in values.values()) / 3 - 1) < 1e-9
