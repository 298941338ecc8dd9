"""Near-dedup, exact dedup, line dedup and components against brute force."""

import hashlib
import random
import re
from collections import defaultdict
from itertools import combinations

import pytest

from odometra.llm import exactdup, linedup, neardup
from odometra.llm.common import connected
from odometra.operators.graph import connected_components

SCHEMA = "doc_id long, text string, component_id string, kept int, key string, size int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "y", 2) for i, t in rows], SCHEMA)


def words(text):
    return [w.decode() for w in (text or "").encode().lower().split()]


def shingles(text, n):
    w = words(text)
    if not w:
        return set()
    return {tuple(w)} if len(w) < n else {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def components(rows, n):
    ids = sorted({i for i, _ in rows if i is not None})
    sets = defaultdict(list)
    for i, t in rows:
        if i is not None:
            sets[i].append(shingles(t, n))
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(ids, 2):
        if any(s and t and 100 * len(s & t) >= 80 * len(s | t) for s in sets[a] for t in sets[b]):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, base = [], [[rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 8, 40, 150]))] for _ in range(12)]
    for i in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 5])):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        rows.append((i * 3 + 1, " ".join(w) if rng.random() < 0.9 else "\t".join(w).upper()))
    return rows + [(1000, None), (1001, ""), (1002, " \n\t"), (None, "a b c"), (None, None), rows[0], rows[0]]


@pytest.mark.parametrize("n", [2, 5])
def test_near_duplicates_are_those_of_brute_force(spark, n):
    rows = corpus(n)
    got = neardup.near_duplicates(table(spark, rows), words=n).collect()
    assert len(got) == len(rows)
    want = components(rows, n)
    for r in got:
        assert r.component_id == (want[r.doc_id] if r.doc_id is not None else None)
    assert {r.doc_id: r.n_shingles for r in got if r.doc_id} == {i: len(shingles(t, n)) for i, t in rows if i}


def star(n_copies, seed=0):
    """A text and copies with edits of their own: far from each other, near to it."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(200)]
    rows = []
    for k in range(n_copies):
        w = list(base)
        for e in range(rng.choice([6, 9, 12, 14, 20])):
            w[rng.randrange(200)] = f"c{k}_{e}"
        rows.append((k, " ".join(w)))
    return [*rows, (5000, " ".join(base))]


@pytest.mark.parametrize("few, block", [(2, 2048), (0, 7), (1000, 2048)])
def test_near_copies_of_one_text_lose_no_link(spark, monkeypatch, few, block):
    monkeypatch.setattr(neardup, "FEW", few)
    monkeypatch.setattr(neardup, "BLOCK", block)
    rows = star(60)
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(table(spark, rows), words=2).collect()}
    assert got == components(rows, 2)


def test_near_duplicates_of_an_empty_table(spark):
    assert neardup.near_duplicates(table(spark, []), words=2).count() == 0
    assert neardup.near_duplicates(table(spark, [(1, None)]), words=2).collect()[0].component_id == 1


def test_pruning_keeps_the_threshold():
    least = neardup.least_matches(0.8, 1e-6)
    assert len(least) == neardup.SIGNATURE // neardup.BATCH
    # a pair at the threshold shows 0.8 * n matches; pruning starts well below
    assert all(m < 0.75 * neardup.BATCH * (k + 1) for k, m in enumerate(least)) and least[-1] > 0.6 * neardup.SIGNATURE


def test_exact_dedup(spark):
    rows = [(1, "Same Text"), (2, "same text"), (5, "SAME TEXT"), (3, "ÄB"), (4, "äb"), (6, None), (7, ""), (8, "alone"), (8, "alone"), (None, "null id"), (9, "x" * 300 + "a"), (10, "x" * 300 + "b")]
    got = exactdup.exact_dedup(table(spark, rows)).collect()
    groups = defaultdict(list)
    norm = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    for i, t in rows:
        groups[norm(t)].append(i)
    assert len(got) == len(rows)
    by_sha = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in groups.items()}
    for r in got:
        ids = by_sha[r.text_sha256]
        keep = max((i for i in ids if i is not None), default=None)
        assert (r.keep_id, r.group_size, r.kept) == (keep, len(ids), r.doc_id == keep)
    assert exactdup.exact_dedup(table(spark, [])).count() == 0


def test_each_step_of_exact_dedup_reads_the_survivors_of_the_one_before(spark, monkeypatch):
    written = []
    monkeypatch.setattr(exactdup, "materialize", lambda df: written.append([tuple(r) for r in df.collect()]) or df)
    rows = [(1, "a" * 10), (2, "a" * 10), (3, "a" * 4 + "b" * 6), (4, "c" * 10), (5, "only one so long"), (6, "")]
    groups = exactdup.copy_groups(table(spark, rows), prefix=4).collect()
    assert written[0] == [(10,)]  # lengths 16 and 0 are out before anything is hashed
    assert len(written[1]) == 1 and written[1][0][0] == 10  # ccc.. is out before a whole text is
    assert [(g.keep_id, g.group_size) for g in groups] == [(2, 2)]


def deleted(rows, least):
    """Lines of later copies of all repeated runs, from the suffix array of all documents and its LCP intervals."""
    docs = sorted({(i, t) for i, t in rows if t is not None}, key=lambda d: (d[0] is not None, d[0] or 0))
    places, ids, text = [], {}, []
    for d, (_, t) in enumerate(docs):
        for at, s in enumerate(t.split("\n")):
            if s := s.strip(" \t\n\x0b\x0c\r"):
                places.append((d, at, len(s.split())))
                text.append(ids.setdefault(s, len(ids) + 1))
        places.append((d, None, 0))
        text.append(-d - 1)  # ends differ from document to document
    array = sorted(range(len(text)), key=lambda p: text[p:])
    common = [0]
    for p, q in zip(array, array[1:], strict=False):
        n = 0
        while max(p, q) + n < len(text) and text[p + n] == text[q + n]:
            n += 1
        common.append(n)
    gone = defaultdict(set)
    for k in range(1, len(array)):
        n = common[k]
        if n and sum(w for _, _, w in places[array[k] : array[k] + n]) >= least:
            low, high = k, k
            while common[low - 1] >= n:
                low -= 1
            while high + 1 < len(array) and common[high + 1] >= n:
                high += 1
            copies = sorted(array[low - 1 : high + 1])
            for size in range(1, n + 1):  # an interval has runs of all sizes above that of the interval around it
                if sum(w for _, _, w in places[copies[0] : copies[0] + size]) >= least:
                    kept = set(range(copies[0], copies[0] + size))
                    for p in copies[1:]:
                        for q in set(range(p, p + size)) - kept:
                            gone[docs[places[q][0]]].add(places[q][1])
    return gone


def test_the_first_copy_stays_whole(spark):
    line = lambda k: " ".join(f"l{k}w{j}" for j in range(30))
    rows = [(1, "\n".join([line(0)] * 3)), (2, "\n".join([line(k) for k in (1, 2, 3, 1, 2, 3, 1)])), (3, "\n".join([line(2), line(3), "own"]))]
    got = {r.doc_id: r for r in linedup.dedup_lines(table(spark, rows)).collect()}
    assert got[1].text == "\n".join([line(0)] * 2) and got[1].n_removed == 1
    assert got[2].text == "\n".join([line(k) for k in (1, 2, 3)]) and got[3].text == "own"


@pytest.mark.parametrize("seed", range(8))
def test_line_dedup_is_brute_force(spark, seed):
    rng = random.Random(seed)
    pool = [" ".join(f"p{k}_{j}" for j in range(rng.choice([1, 2, 3, 6]))) for k in range(8)]
    rows = []
    for i in range(14):
        lines = []
        for _ in range(rng.randrange(1, 14)):
            lines.append(rng.choice([rng.choice(pool), f"own {i} {rng.random()}", "", "  ", " " + rng.choice(pool) + "\t"]))
            if rng.random() < 0.3:
                k = rng.randrange(5)
                lines += pool[k : k + 4]
            if rng.random() < 0.15:  # a copy that overlaps the first
                lines += (pool[:2] * 4)[: rng.randrange(3, 8)] if seed % 2 else [pool[3]] * rng.randrange(2, 6)
        rows.append((i, "\n".join(lines)))
    rows += [(50, None), (51, ""), rows[3]]
    want = deleted(rows, 8)
    for r in linedup.dedup_lines(table(spark, rows), min_words=8).collect():
        text = next(t for i, t in rows if i == r.doc_id)
        if text is None:
            assert (r.text, r.n_lines, r.n_removed) == (None, 0, 0)
            continue
        gone = want[(r.doc_id, text)]
        assert r.n_removed == len(gone) and r.n_lines == text.count("\n") + 1
        assert r.text == "\n".join(s for at, s in enumerate(text.split("\n")) if at not in gone)


def test_line_dedup_without_repeats_or_rows(spark):
    assert linedup.dedup_lines(table(spark, []), min_words=3).count() == 0
    assert linedup.dedup_lines(table(spark, [(1, "a b c d"), (2, "e f g h")]), min_words=3).where("n_removed > 0").count() == 0


def test_connected_on_stars_and_paths(spark):
    edges = [(0, i) for i in range(1, 50)] + [(100 + i, 101 + i) for i in range(60)] + [(7, 7)]
    got = {r.node: r.root for r in connected(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert {got[i] for i in range(50)} == {0} and {got[100 + i] for i in range(61)} == {100}


def test_unfinished_components_are_an_error(spark):
    path = spark.createDataFrame([(i * 7919 % 1009, (i + 1) * 7919 % 1009) for i in range(1000)], "id1 long, id2 long")
    with pytest.raises(RuntimeError, match="finished"):
        connected_components(path, rounds=1)
