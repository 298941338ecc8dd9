"""Vote-and-verify against a straightforward loop, and a planted image among distractors."""

import math
import random

from odometra.operators import spatial as S

SCHEMA = "query long, image long, x1 double, y1 double, scale1 double, angle1 double, x2 double, y2 double, scale2 double, angle2 double"


def moved(rng, scale, turn, tx, ty, noise=1.0):
    x, y, s, a = rng.uniform(0, 1000), rng.uniform(0, 800), rng.uniform(1, 6), rng.uniform(-1, 1)
    c, d = scale * math.cos(turn), scale * math.sin(turn)
    return (x, y, s, a, c * x - d * y + tx + rng.gauss(0, noise), d * x + c * y + ty + rng.gauss(0, noise), s * scale * rng.uniform(0.95, 1.05), a + turn + rng.gauss(0, 0.01))


def stray(rng):
    return (rng.uniform(0, 1000), rng.uniform(0, 800), rng.uniform(1, 6), rng.uniform(-1, 1), rng.uniform(0, 1000), rng.uniform(0, 800), rng.uniform(1, 6), rng.uniform(-1, 1))


def by_hand(rows):
    """The same by loops over one pair's matches; returns (inliers, effective)."""

    def inlier(r, t):
        a, b, c, d, tx, ty = t
        x1, y1, s1, _, x2, y2, s2, _ = r
        det = a * d - b * c
        if not det:
            return False
        ratio = s1 * s1 * abs(det) / (s2 * s2)
        e1 = (x2 - a * x1 - b * y1 - tx) ** 2 + (y2 - c * x1 - d * y1 - ty) ** 2
        u, v = x2 - tx, y2 - ty
        e2 = (x1 - (d * u - b * v) / det) ** 2 + (y1 - (a * v - c * u) / det) ** 2
        return max(ratio, 1 / ratio) <= 2 and e1 + e2 <= 1e4

    if len(rows) < 3:
        return 0, 0
    bins = [{} for _ in range(3)]
    span = math.log2(10)
    for r in rows:
        x1, y1, s1, a1, x2, y2, s2, a2 = r
        s, a = s2 / s1, a2 - a1
        tx, ty = x2 - s * (math.cos(a) * x1 - math.sin(a) * y1), y2 - s * (math.sin(a) * x1 + math.cos(a) * y1)
        if abs(tx) > 4096 or abs(ty) > 4096 or abs(math.log2(s)) > span:
            continue
        key = (min(int((ty + 4096) / 8192 * 64), 63), min(int((tx + 4096) / 8192 * 64), 63), min(int((math.log2(s) + span) / (2 * span) * 32), 31), min(int((a + math.pi) / (2 * math.pi) * 8), 7))
        for level in range(3):
            bins[level].setdefault(tuple(k >> level for k in key), []).append((s, a, tx, ty))
    ranked = sorted(bins[0], key=lambda k: (-sum(0.5**level * len(bins[level][tuple(x >> level for x in k)]) for level in range(3)), k))
    best, form, limit = 0, None, math.inf
    for i, k in enumerate(ranked[:10]):
        if i >= limit:
            break
        s, a, tx, ty = (sum(v) / len(bins[0][k]) for v in zip(*bins[0][k], strict=True))
        t = (s * math.cos(a), -s * math.sin(a), s * math.sin(a), s * math.cos(a), tx, ty)
        n = sum(inlier(r, t) for r in rows)
        if n < best or n < 3:
            continue
        best, form = n, t
        if n == len(rows):
            break
        p = math.prod((n - j) / (len(rows) - j) for j in range(3))
        limit = math.ceil(math.log(0.01) / math.log(1 - p))
    if not best:
        return 0, 0
    import numpy as np

    inside = [r for r in rows if inlier(r, form)]
    a = np.array([[r[0], r[1], 1] for r in inside])
    if np.linalg.matrix_rank(a) == 3:
        (p, q, tx), (c, d, ty) = np.linalg.lstsq(a, np.array([[r[4], r[5]] for r in inside]), rcond=None)[0].T
        refined = [r for r in rows if inlier(r, (p, q, c, d, tx, ty))]
        if len(refined) > best:
            best, inside = len(refined), refined
    x0, x1, y0, y1 = min(r[0] for r in inside), max(r[0] for r in inside), min(r[1] for r in inside), max(r[1] for r in inside)
    cell = lambda v, low, high: min(31, int((v - low) * 32 / (high - low))) if high > low else 0
    return best, len({(cell(r[0], x0, x1), cell(r[1], y0, y1)) for r in inside})


def test_counts_are_those_of_the_loop(spark):
    rng = random.Random(8)
    pairs = {}
    for k in range(60):
        rows = [moved(rng, *((rng.uniform(0.5, 2), rng.uniform(-0.8, 0.8), rng.uniform(-300, 300), rng.uniform(-300, 300)) if k % 2 else (1.3, 0.4, 50.0, -20.0))) for _ in range(k % 9)] if k % 2 else [moved(rng, 0.7 + k / 100, 0.3, 10.0 * k, -40.0, noise=10) for _ in range(k)]
        rows += [stray(rng) for _ in range(rng.randrange(0, 25))]
        if rows:
            pairs[k // 10, k] = rows
    pairs[99, 1] = [(5.0, 5.0, 2.0, 0.1, 9.0, 9.0, 2.0, 0.1)] * 4
    df = spark.createDataFrame([(*p, *r) for p, rows in pairs.items() for r in rows] + [(1, 500, None, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0), (1, 501, 1.0, 1.0, 0.0, 1.0, 1.0, 1.0, 1.0, 1.0)], SCHEMA)
    got = {(r.query, r.image): (r.inliers, r.effective) for r in S.vote_and_verify(df, ["query", "image"]).collect()}
    assert got == {p: by_hand(rows) for p, rows in pairs.items()}
    assert S.vote_and_verify(df.limit(0), ["query", "image"]).count() == 0


def test_a_planted_transform_ranks_first_among_a_thousand(spark):
    rng = random.Random(2)
    rows = [(1, 500, *moved(rng, 1.4, -0.6, 120.0, 75.0)) for _ in range(25)] + [(1, 500, *stray(rng)) for _ in range(15)]
    rows += [(1, i, *stray(rng)) for i in range(1001) if i != 500 for _ in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    scored = spark.range(1001).selectExpr("1L AS query", "id AS image", "CASE WHEN id = 500 THEN 0.1 ELSE 1.0D END AS score")
    first = S.rerank(scored, S.vote_and_verify(df, ["query", "image"])).where("rank = 1").first()
    assert first.image == 500
