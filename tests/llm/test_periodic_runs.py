"""Periodic runs against a quadratic brute force."""

import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest_llm import sha
from modrisk.llm import periodic_runs
from modrisk.llm.queries import op13_periodic_runs


def slow_runs(x, least=24, turns=3):
    """Every lag over the whole row; of a stretch, only its smallest period counts."""
    found = []
    for q in range(1, len(x) // turns + 1):
        i = 0
        while i < len(x) - q:
            j = i
            while j < len(x) - q and x[j] == x[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, turns * q):
                found.append((i, j - i + q, q))
            i = max(j, i + 1)
    smallest = [r for r in found if not any(all(x[k] == x[k + p] for k in range(r[0], r[0] + r[1] - p)) for p in range(1, r[2]))]
    return sorted(smallest, key=lambda r: (r[0], r[2]))


def slow_row(ident, text):
    words = "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text or "").split(" ")
    words = [w for w in words if w]
    h = zlib.crc32(str(ident).encode()) if ident is not None else 1
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = slow_runs(words)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    milli = 1000 * best[1] // best[2] if found else None
    return (
        ident, len(found), *best, milli, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)),
        sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def row(r):
    return tuple(r[c] for c in ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"))


@pytest.mark.parametrize("few", [2, 3, 50])
def test_runs_like_brute_force(few):
    draw = random.Random(few)
    for _ in range(150):
        x = []
        for _ in range(draw.randrange(1, 6)):
            base = [draw.randrange(few) for _ in range(draw.randrange(1, draw.choice([4, 30])))]
            if draw.random() < 0.4:
                base = base * draw.randrange(1, 4) + base[: draw.randrange(len(base))]
            x += [base[i % len(base)] for i in range(draw.randrange(draw.choice([20, 120])))]
            if draw.random() < 0.3 and x:
                x[draw.randrange(len(x))] = 99
        assert periodic_runs.runs(np.array(x, np.int64)) == slow_runs(x)


def test_splitting_keeps_all_runs():
    """Rare words split; runs at the edges of a segment, and segments next to each other, stay whole."""
    x = np.array([*range(100, 140), *[1, 2, 3] * 8, 500, *[4] * 24, *[5] * 23, 600, *[6, 7] * 12, 700])
    assert periodic_runs.runs(x) == [(40, 24, 3), (65, 24, 1), (113, 24, 2)]
    assert all(e - s >= 24 for s, e in periodic_runs.segments(x))
    assert periodic_runs.segments(np.arange(1000)) == [] == periodic_runs.segments(np.zeros(0, np.int64))


def test_long_rows_are_not_quadratic():
    x = np.zeros(300_000, np.int64)
    assert periodic_runs.runs(x) == [(0, 300_000, 1)]
    period = np.random.default_rng(1).integers(0, 1000, 90_001)
    assert periodic_runs.runs(np.resize(period, 300_000)) == [(0, 300_000, 90_001)]


def test_query_like_brute_force(spark, sf, documents):
    short = documents.filter(F.length("text") < 2500).collect()  # brute force is cubic; the query runs on whole tables
    got = {r["doc_id"]: row(r) for r in op13_periodic_runs(spark, sf).collect()}
    assert len(got) == documents.count()
    want = {r["doc_id"]: slow_row(r["doc_id"], r["text"]) for r in short}
    assert {i: got[i] for i in want} == want
    assert any(w[1] for w in want.values())


def test_odd_rows(spark, odd, nothing):
    got = periodic_runs.run_table(odd.withColumn("start", F.lit(1)), rewrite=periodic_runs.looped).collect()
    assert len(got) == odd.count()
    small = {r["doc_id"]: slow_row(r["doc_id"], r["text"]) for r in odd.collect() if len(r["text"] or "") < 1000 and r["doc_id"]}
    assert {r["doc_id"]: row(r) for r in got if r["doc_id"] in small} == small
    long = next(r for r in got if r["doc_id"] == 9)
    assert (long["n_runs"], long["start"], long["length"], long["period"]) == (1, 1, 3000, 1)
    assert long["collapsed"] == "w" * 50_000 + " tail"
    blank = next(r for r in got if r["doc_id"] == 12)
    assert (blank["n_runs"], blank["start"], blank["exponent_milli"], blank["collapsed_sha256"]) == (0, None, None, sha(""))
    assert periodic_runs.run_table(nothing).count() == 0
