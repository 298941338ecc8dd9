"""Every stage of the pipeline against a brute-force version of it, on what the stage before left."""

import random
import re
import sys
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
from test_pairs_and_lines import components, deleted  # noqa: E402
from test_texts import targets  # noqa: E402


def bag(words, n):
    return Counter(tuple(words[i : i + n]) for i in range(max(0, len(words) - n + 1)))


def leaks(text, items):
    """Whether some window of an item's size is 0.8 alike to it, by bags of five words."""
    words = re.findall(r"\w+", (text or "").lower())
    for item in items:
        want = re.findall(r"\w+", item.lower())
        n = min(5, len(want))
        a, size = bag(want, n), len(want)
        for k in range(max(1, len(words) - size + 1)):
            b = bag(words[k : k + size], n)
            both = (a & b).total()
            if both and both / (a | b).total() >= 0.8:
                return True
    return False


@pytest.mark.parametrize("seed", [1, 2])
def test_stages_by_brute_force(spark, tmp_path, seed):
    import corpus_pipeline

    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(900)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [say(rng.choice([6, 20, 40])) for _ in range(5)]
    passages = ["\n".join(say(rng.randrange(10, 30)) for _ in range(rng.randrange(2, 6))) for _ in range(4)]
    rows = []
    for i in range(70):
        lines = [say(rng.randrange(3, 25)) for _ in range(rng.randrange(1, 8))]
        if rng.random() < 0.3:
            lines.insert(rng.randrange(len(lines) + 1), rng.choice(passages))
        if rng.random() < 0.2:
            words = rng.choice(items).split()
            words[rng.randrange(len(words))] = "other" if rng.random() < 0.5 else words[0]
            lines.insert(rng.randrange(len(lines) + 1), " ".join(words))
        rows.append((i, "\n".join(lines)))
        if rng.random() < 0.2:  # a near copy
            words = rows[-1][1].split(" ")
            words[rng.randrange(len(words))] = "changed"
            rows.append((1000 + i, " ".join(words)))
    rows += [(2000, None), (2001, ""), (2002, "12 34 -- !"), (2003, "\n\n"), rows[0]]
    langs, sources = ["en", "de", None], ["s0", "s1", "s2", None]
    docs = spark.createDataFrame([(i, t, langs[i % 3], sources[i % 4], len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for clash in ("gone", "dead_row", "dead_at", "line_dedup", "mix_row", "row"):
        docs = docs.withColumn(clash, F.lit(clash))
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    texts = lambda df: Counter((r.doc_id, r.text) for r in df.collect())

    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text, r.source) for r in docs.collect()]
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        got = texts(docs)
        if name == "language_id":
            assert got == Counter((i, t) for i, t, _ in before if re.search(r"[^\W\d_]", t or ""))
        elif name == "line_dedup":
            gone = deleted([(i, t) for i, t, _ in before], 50)
            want = [(i, "\n".join(s for at, s in enumerate(t.split("\n")) if at not in gone[(i, t)])) for i, t, _ in before]
            assert got == Counter((i, t) for i, t in want if t.split()) and sum(map(len, gone.values())) > 0
        elif name == "minhash_neardup":
            kept = components([(i, t) for i, t, _ in before], 5)
            assert got == Counter((i, t) for i, t, _ in before if kept[i] == i) and len(got) < len({i for i, _, _ in before})
        elif name == "benchmark_decontamination":
            assert got == Counter((i, t) for i, t, _ in before if not leaks(t, items)) and got.total() < len(before)
        else:
            sizes, taken = Counter(), Counter()
            for i, t, s in before:
                sizes[s] += len((t or "").split())
            want = targets(dict(sizes))
            for r in docs.collect():
                taken[r.source] += r.mix.taken
                assert 0 < r.mix.taken <= 3 * r.mix.size and r.mix.target == pytest.approx(want[r.source])
            # equal rows are joined to one another, so that a source is off by its repeated rows at most
            assert all(abs(taken[s] - want[s]) <= 0.5 + 3 * max(len(t.split()) for _, t, _ in before) for s in want)
            assert set(got) <= {(i, t) for i, t, _ in before}
