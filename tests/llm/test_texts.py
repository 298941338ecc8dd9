"""PII, token counts, decontamination, language, HTML, mixing, chat and the pipeline."""

import hashlib
import json
import math
import re

import pytest
from pyspark.sql import functions as F

from odometra.llm.common import WordHashes, shingle_run
from odometra.llm import chat, decontam, html_text, langid, mixing, pii, tokens

# -- personal data ---------------------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(s):
    return re.sub("[^0-9]", "", s)


def luhn(s):
    total = 0
    for i, c in enumerate(reversed(s)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain(text):
    return [
        [m.span() for m in EMAIL.finditer(text)],
        [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))],
        [m.span() for m in CARD.finditer(text) if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))],
        [m.span() for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15],
    ]


TEXTS = ["a@b.c@d.e x@y @b.c a@@b.c", "1.2.3.4.5.6.7.8 256.1.1.1 01.002.3.4 1.2.3", "4111 1111 1111 1111-4111111111111111 4111  1111", "+1 (212) 555-0199 +49 30 1234567- ++44 20 7946 0958 +1", "é mail: jo.e+x@ex-am.co.uk, 日本 10.0.0.1", "a" * 3000 + "@", "1" * 3000, "@" * 500, "", "1.1.1.1@2.2.2.2"]


@pytest.mark.parametrize("text", TEXTS)
def test_base_spans_are_the_expressions(text):
    assert pii.base_spans(text) == plain(text)


def test_random_base_spans():
    import random

    rng = random.Random(0)
    for _ in range(3000):
        text = "".join(rng.choice("0123456789.@+-() aBé") for _ in range(rng.randrange(60)))
        assert pii.base_spans(text) == plain(text), text


def test_bootstrapping_finds_unseen_identifiers(spark):
    rows = [(i, f"please write to email: user{i}@mail{i}.example.org today number {i}000{i}") for i in range(12)]
    rows += [(50, "please write to email: joe77(at)example today"), (51, "nothing of the kind 12345-99"), (52, None), (53, ""), (50, "other text 10.0.0.1"), (None, "x@y.zz")]
    df = spark.createDataFrame([(i, t, "e", 1) for i, t in rows], "doc_id long, text string, spans string, row int")
    got = {(r.doc_id, r.base_sha256, r.spans, r.n_added) for r in pii.find_pii(df).collect()}
    assert len(got) == len(rows)
    by_id = {}
    for r in pii.find_pii(df).collect():
        by_id.setdefault(r.doc_id, []).append(r)
    new = next(r for r in by_id[50] if r.n_added)
    start = rows[12][1].index("joe77")
    assert new.spans == f"email:{start}:{start + len('joe77(at)example')}" and new.n_email == 0
    assert new.base_sha256 == hashlib.sha256(b"").hexdigest()
    assert all(r.n_added == 0 for k, v in by_id.items() if k != 50 for r in v)
    assert by_id[None][0].spans == "email:0:6"
    assert pii.find_pii(df.limit(0)).count() == 0


def test_groups_long_values_and_further_patterns(spark):
    rows = [(i, f"please ring number: +49 30 12345{i:02} now") for i in range(12)]
    rows += [(20, "please ring number: 030 123 4567 now"), (21, "please ring number: 4000 1234 5678 9013 now")]
    rows += [(200 + i, f"write to mail: user{i}@mail.example.org today") for i in range(80)]
    rows += [(70, "write to mail: jo at host dot org today"), (71, "write to mail: " + "x1" * 50 + "(at)host today")]
    # identifiers known from the first pattern vouch for a second, which has no seed
    rows += [(80 + i, f"write to mail: nick{i}_x today") for i in range(9)] + [(90 + i, f"handle is nick{i}_x here") for i in range(9)] + [(99, "handle is nick77_x here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.find_pii(df).collect()}
    for doc, kind, value in [(20, "phone", "030 123 4567"), (21, "phone", "4000 1234 5678 9013"), (70, "email", "jo at host dot org"), (71, "email", "x1" * 50 + "(at)host"), (80, "email", "nick0_x"), (99, "email", "nick77_x")]:
        at = dict(rows)[doc].index(value)
        assert got[doc] == f"{kind}:{at}:{at + len(value)}", doc
    long = ["a" * 70 + f"{k}@host.org" for k in range(2)]
    assert len({x[3] for t in long for x in pii.instances(t, pii.base_spans(t))}) == 2


def test_recall_of_identifiers_held_out_from_the_seeds(spark):
    """Contexts of every sort, planted in random words; of each, some identifiers are in forms that are no seeds."""
    import random

    rng = random.Random(3)
    say = lambda n: " ".join("".join(rng.choice("aeiouthnr") for _ in range(rng.randrange(2, 8))) for _ in range(n))
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))

    def card():
        d = number(15)
        return next(d + c for c in "0123456789" if pii._luhn(d + c))

    sorts = [  # kind, context, a seed, an identifier that is none
        ("phone", "{} call {} now", lambda: f"+49 30 {number(6)}", lambda: f"030 {number(3)} {number(4)}"),
        ("phone", '<a href="tel:{1}">{0}</a>', lambda: f"+1({number(3)}){number(7)}", lambda: f"00{number(9)}"),
        ("email", "{} write to {} please", lambda: f"u{number(4)}@mail{number(3)}.org", lambda: f"u{number(4)}(at)mail{number(3)}"),
        ("email", "{}\nContact: {}\n", lambda: f"v{number(4)}@host.org", lambda: f"v{number(4)}@localhost"),
        ("ip", "{} client_ip={} {}", lambda: f"10.{rng.randrange(256)}.{rng.randrange(256)}.7", lambda: f"10.{rng.randrange(256, 999)}.{rng.randrange(256)}.7"),
        ("card", "{} paid by card {} {}", card, lambda: next(c for c in iter(lambda: " ".join(number(4) for _ in range(4)), "") if not pii._luhn(digits(c)))),
        ("secret", '{} token = "{}" {}', lambda: "a" + number(30) + "f", lambda: f"sk-{number(12)}-ab"),
        ("phone", "{} {} {}", lambda: f"+1 ({number(3)}) {number(3)}-{number(4)}", lambda: f"({number(3)}) {number(3)}-{number(4)}"),  # by its form alone
    ]
    rows, want = [], {}
    for k in range(30):
        for kind, frame, seed, other in sorts:
            value = (other if k % 5 == 0 else seed)()
            text = say(6) + " " + frame.format(say(1), value, say(1)) + " " + say(8)
            if k % 5 == 0:
                at = text.index(value)
                want[len(rows)] = f"{kind}:{at}:{at + len(value)}"
            rows.append((len(rows), text))
    rows += [(1000 + k, say(12) + f" room {rng.randrange(10_000, 99_999)} " + say(5)) for k in range(60)]
    got = {r.doc_id: r for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    hit = {i: want[i] in got[i].spans.split(",") for i in want}
    by_sort = [sum(hit[i] for i in want if i % len(sorts) == k) / 6 for k in range(len(sorts))]
    assert sum(hit.values()) >= 0.9 * len(want) and min(by_sort) >= 0.5, by_sort
    assert all(got[1000 + k].n_spans == 0 for k in range(60))
    assert {kind for i, r in got.items() if r.n_added for kind in [want.get(i, "secret").split(":")[0]]} == set(pii.ALL_KINDS)


def test_ties_and_odd_texts_of_personal_data(spark):
    # a value that is a seed of two kinds counts as the first; long words and very many instances in one line
    rows = [(1, "ip 1.2.3.4 " * 3), (2, "x" * 300_000 + " +1 212 555 0199 " + "y" * 300_000), (3, " ".join(f"n{k}" * 3 for k in range(20_000))), (4, "token=" + "a1" * 20), (4, None)]
    got = {(r.doc_id, r.n_spans) for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, 3), (2, 1), (3, 0), (4, 1), (4, 0)}


LONG_RUNS = {
    "Chinese": "\u5b57" * 1_000_000 + " 1.2.3.4",
    "pieces of one word": ",".join(f"k{i}" for i in range(150_000)),
    "names": "=".join("n" * 6 + str(i % 10) for i in range(100_000)),
    "digits": "1" * 1_000_000,
    "ats": "a@" * 300_000,
    "pluses": "+1(" * 300_000,
    "groups": "12 " * 300_000 + "x",
    "blanks": " " * 500_000 + "at" + " " * 500_000,
}


@pytest.mark.parametrize("name", LONG_RUNS)
def test_long_runs_take_linear_time(name):
    import time

    text = LONG_RUNS[name]
    began = time.process_time()
    pii.instances(text, pii.base_spans(text))
    assert time.process_time() - began < 30


def test_tokens_are_the_runs_that_hold_a_digit_or_at():
    import random

    rng, token = random.Random(1), re.compile(r"""[^\x20\x09-\x0D<>"'=\[\]{}|;,]*[0-9@][^\x20\x09-\x0D<>"'=\[\]{}|;,]*""")
    for _ in range(3000):
        text = "".join(rng.choice("0@ab, =|é\n<") for _ in range(rng.randrange(40)))
        assert list(pii.tokens(text)) == [m.span() for m in token.finditer(text)], text


def discovered(found, trust, support):
    """The pattern graph scored turn by turn, with dictionaries."""
    edges, best, score = {}, {}, {}
    for kind, value, of, shape, contexts in found:
        for c in contexts:
            edges.setdefault((of, c), set()).add((value, shape))
            if kind is not None:
                best[value, shape] = min(kind, best.get((value, shape), 9))
                score[value, shape] = 1.0
    while True:
        votes = {}
        for members in edges.values():
            for kind in {best[v] for v in members if v in best}:
                good = [score[v] for v in members if best.get(v) == kind]
                share = sum(good) / len(members)
                if share >= trust and sum(s >= trust for s in good) >= support:
                    for v in members:
                        if v not in best:
                            votes.setdefault(v, {}).setdefault(kind, []).append(share)
        new = {}
        for v, kinds in votes.items():
            at = {k: min(0.999, 1 - math.prod(max(1 - t, 1e-6) for t in sorted(shares))) for k, shares in kinds.items()}
            kind = max(at, key=lambda k: (round(at[k], 12), -k))
            new[v] = (kind, at[kind])
        if not new:
            return {(*v, best[v]) for v in best if trust <= score[v] < 1}
        for v, (kind, s) in new.items():
            best[v], score[v] = kind, s


def test_the_pattern_graph_against_brute_force(spark):
    import random

    for seed in range(3):
        rng = random.Random(seed)
        values = [(f"v{i}", rng.choice("td"), "s" + str(i % 3), rng.choice([None, None, None, 0, 1, 3])) for i in range(60)]
        found = [(kind, v, of, shape, [f"c{rng.choice([int(v[1:]) % 7, int(v[1:]) % 7, rng.randrange(12)])}" for _ in range(rng.randrange(1, 4))]) for v, of, shape, kind in values for _ in range(2)]
        df = spark.createDataFrame(found, "kind int, value string, class string, shape string, contexts array<string>")
        for trust, support in ((0.5, 2), (0.3, 1)):
            got = {tuple(r) for r in pii.discover(df, trust=trust, support=support, turns=None).collect()}
            assert got == discovered(found, trust, support)


# -- tokens ----------------------------------------------------------------------------


def test_counts_are_the_tokenizers():
    models = pytest.importorskip("tokenizers")
    vocabulary = [("<unk>", 0.0, 2), *[(p, s, 1) for p, s in (("▁", -2.0), ("a", -2.0), ("b", -2.0), ("ab", -3.0), ("▁a", -3.5), ("bab", -4.0), ("▁ab", -4.0), ("aa", -4.0), ("é", -5.0))], *[(f"<0x{b:02X}>", -9.0, 6) for b in range(256)]]
    tk = models.Tokenizer(models.models.Unigram([(p, s) for p, s, _ in vocabulary], 0, True))
    tk.pre_tokenizer = models.pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="first", split=True)
    counter = tokens.UnigramCounter(vocabulary)
    # that library's lowest score is of all pieces, which here is one of the bytes; as a normal piece that occurs nowhere it counts in both
    counter = tokens.UnigramCounter([*vocabulary, ("\x01", -9.0, 1)])
    import random

    rng = random.Random(0)
    for _ in range(2000):
        text = "".join(rng.choice("aabb ▁é日😀\n") for _ in range(rng.randrange(14)))
        assert counter.count(text) == len(tk.encode(text).tokens), text


def unigram_models():
    """The vocabulary file as a unigram model in two libraries: whole texts in double precision, and the best cut of a lattice."""
    models, sp = pytest.importorskip("tokenizers"), pytest.importorskip("sentencepiece")
    from sentencepiece import sentencepiece_model_pb2 as pb2

    v = tokens.read_vocabulary(tokens.VOCABULARY)
    tk = models.Tokenizer(models.models.Unigram([(p, s) for p, s, _ in v], 0, True))
    tk.pre_tokenizer = models.pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="first", split=True)
    with open(tokens.VOCABULARY, "rb") as f:
        proto = pb2.ModelProto.FromString(f.read())
    proto.trainer_spec.model_type = 1
    return tk, sp.SentencePieceProcessor(model_proto=proto.SerializeToString())


def test_counts_with_the_real_vocabulary(spark):
    tk, lattice = unigram_models()
    rows = [(1, "Hello  world, this is a test.\n\nÉté à la plage 123"), (2, None), (3, ""), (None, "x" * 5000), (4, "日本語 テスト 😀"), (5, " lead and trail"), (5, " lead and trail"), (6, "a" * 200_000 + " end"), (7, "qz" * 40 + "\t")]
    df = spark.createDataFrame([(*r, "n", 1.5) for r in rows], "doc_id long, text string, n_tokens string, n_chars double")
    got = sorted((str(r.doc_id), r.n_chars, r.n_tokens) for r in tokens.count_tokens(df).collect())
    assert got == sorted((str(i), len(t or ""), len(tk.encode(t).tokens) if t else 0) for i, t in rows)
    assert tokens.count_tokens(df.limit(0)).count() == 0
    counter = tokens.counter_of(tokens.VOCABULARY)
    for word in "the then There walking beside Straßenbahn naïve 4711 e-mail, été日".split():
        assert counter.count(word) == len(lattice.nbest_encode_as_pieces(word, 2)[0]), word


def test_types_of_pieces():
    vocabulary = [("<unk>", 0.0, 2), ("▁", -1.0, 1), ("a", -2.0, 1), ("b", -2.0, 1), ("ab", -1.0, 5), ("ba", -9.0, 4), ("</s>", 0.0, 3)]
    counter = tokens.UnigramCounter(vocabulary)
    assert counter.count("ab") == 3  # the unused piece never matches
    assert counter.count("ba") == 2  # 2 * -1 - 0.1 is above -4
    assert counter.unknown == -12.0 and counter.count("</s>") == 2  # one run of unknowns


# -- decontamination -------------------------------------------------------------------

ITEM = "the quick brown fox jumps over the lazy dog while seven wizards box quietly near the old stone bridge at dawn"


def test_benchmark_items_are_found(spark):
    bench = spark.createDataFrame([(1, ITEM), (2, "two words"), (3, ""), (4, None), (5, "completely different sentence about rivers and mountains of the far north country side")], "item_id long, text string")
    long = " ".join(f"w{i}" for i in range(4000))
    rows = [(1, f"{long} {ITEM.upper()}! {long}"), (2, ITEM), (3, ITEM.replace("fox", "cat").replace("box", "sit").replace("stone", "iron")), (4, "some two words here"), (5, None), (6, ""), (7, ITEM[:40]), (1, f"{long} {ITEM}"), (None, ITEM)]
    df = spark.createDataFrame([(i, t, 9, 0.1) for i, t in rows], "doc_id long, text string, item_id int, similarity double")
    got = sorted((str(r.doc_id), r.item_id) for r in decontam.contaminated(df, bench).collect())
    assert got == sorted([("1", 1), ("2", 1), ("4", 2), ("1", 1), ("None", 1)])
    again = sorted((str(r.doc_id), r.item_id) for r in decontam.contaminated(df, bench, items_at_once=1).collect())
    assert again == got
    assert sorted(r.doc_id for r in decontam.clean_rows(df, bench).collect()) == [3, 5, 6, 7]
    assert decontam.contaminated(df.limit(0), bench).count() == 0 and decontam.contaminated(df, bench.limit(0)).count() == 0


def test_repeated_items_and_passes_change_no_similarity(spark):
    words = [f"q{k}" for k in range(54)]  # 50 shingles
    copy = " ".join([*words[:20], "new", *words[21:]])
    framed = " ".join(words[:40])
    items = [(1, " ".join(words)), *[(k, " ".join(words)) for k in range(2, 11)], *[(k, framed + " " + " ".join(f"own{k}x{j}" for j in range(14))) for k in range(20, 40)]]
    leaks = [(1, copy), (2, items[10][1].replace("own20x7", "new"))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame(leaks, "doc_id long, text string")
    found = [sorted((r.doc_id, r.item_id, round(r.similarity, 9)) for r in decontam.contaminated(docs, bench, items_at_once=n).collect()) for n in (100, 5)]
    assert found[0] == [*[(1, k, round(45 / 55, 9)) for k in range(1, 11)], (2, 20, round(45 / 55, 9))]
    assert found[1] == found[0]
    assert decontam.clean_rows(docs, bench, items_at_once=5).count() == 0


def test_windows_by_brute_force():
    """Every window of every text against every item, by exact similarity alone."""
    import random

    rng = random.Random(5)
    vocabulary = [f"v{i}" for i in range(30)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([3, 12, 25, 40])))) for k in range(12)]
    index, hashes = decontam.Index(items, 5), WordHashes()
    for _ in range(150):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(80))]
        for _ in range(2):
            copy = rng.choice(items)[1].split()
            for _ in range(rng.choice([0, 0, 1])):
                copy[rng.randrange(len(copy))] = "new"
            at = rng.randrange(len(words) + 1)
            words[at:at] = copy
        h = decontam.word_hashes(" ".join(words), hashes)
        want = {}
        for i, (_, n, x) in enumerate(index.items):
            s = shingle_run(h, n)
            for k in range(max(1, len(s) - len(x) + 1)):
                window = s[k : k + len(x)]
                if len(window) and index.similarity(i, window) >= 0.8:
                    want[i] = max(want.get(i, 0), index.similarity(i, window))
        got = {i: v[0] for i, v in index.search(h, 0.8).items()}
        assert got == pytest.approx(want)


def test_blocks_hold_all_within_the_radius():
    import numpy as np

    index = decontam.Index([(1, ITEM)], 5)
    rng = np.random.default_rng(0)
    blocks, bits = index.blocks[index.items[0][1], len(index.items[0][2])], 16 * decontam.BLOCKS
    for n in range(decontam.RADIUS + 1):
        mark = np.unpackbits(index.mark(0).view(np.uint8))
        mark[rng.choice(bits, n, replace=False)] ^= 1
        rows, items = blocks.near(np.packbits(mark).view(np.uint16)[None])
        assert (rows.tolist(), items.tolist()) == ([0], [0])


@pytest.mark.parametrize("size", [10, 30, 100, 500])
def test_recall_at_the_threshold_and_candidates_of_a_window(size):
    """Copies of items at a similarity just above 0.8 among 4,000 items of one size."""
    import numpy as np

    rng = np.random.default_rng(size)
    prints = np.stack([decontam.fingerprints(decontam.signs(rng.integers(0, 2**63, size, dtype=np.uint64)).sum(axis=0, dtype=np.int64)[None])[0] for _ in range(4000)])
    blocks, found, seen, n = decontam.Blocks(list(range(4000)), prints), 0, 0, 200
    rng = np.random.default_rng(size)
    items = [rng.integers(0, 2**63, size, dtype=np.uint64) for _ in range(4000)][:n]
    for i, x in enumerate(items):
        other = x.copy()
        changed = int(size / 9)  # (size - c) / (size + c) >= 0.8
        other[rng.choice(size, changed, replace=False)] = rng.integers(0, 2**63, changed, dtype=np.uint64)
        rows, hits = blocks.near(decontam.fingerprints(decontam.signs(other).sum(axis=0, dtype=np.int64)[None]))
        found, seen = found + (i in hits.tolist()), seen + len(hits)
    assert found >= 0.95 * n and seen / n < 0.01 * 4000


def test_sums_of_windows_in_pieces(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(5)
    x = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    monkeypatch.setattr(decontam, "PIECE", 64)
    for m in (1, 7, 63, 64, 65, 1000, 2500):
        starts = np.unique(rng.integers(0, 3000 - m, 50))
        want = np.stack([decontam.signs(x[s : s + m]).sum(axis=0, dtype=np.int64) for s in starts])
        assert (decontam.window_sums(x, starts, m) == want).all()
    assert (decontam.total(x) == decontam.signs(x).sum(axis=0, dtype=np.int64)).all()


# -- language --------------------------------------------------------------------------


def test_suffix_automaton_phrases_are_the_longest_matches():
    import random

    rng = random.Random(0)
    for _ in range(200):
        text = "".join(rng.choice("abc ") for _ in range(rng.randrange(1, 30)))
        unit = "".join(rng.choice("abcd ") for _ in range(rng.randrange(12)))
        n = i = 0
        while i < len(unit):
            size = 1
            while i + size < len(unit) and unit[i : i + size + 1] in text and unit[i : i + size] in text:
                size += 1
            i, n = i + size, n + 1
        assert langid.SuffixAutomaton(text).phrases(unit) == n, (text, unit)


def test_languages(spark):
    said = {"en": "the weather was fine and they walked through the old town", "de": "das wetter war schön und sie gingen durch die alte stadt", "es": "el tiempo era bueno y ellos caminaron por la ciudad vieja"}
    rows = [(i * 10 + k, t, lang) for k, (lang, t) in enumerate(said.items()) for i in range(6)]
    df = spark.createDataFrame(rows + [(900, None, "en"), (901, "123 !!", "de"), (902, "", None), (903, "the town", None), (None, "die stadt", "de")], "doc_id long, text string, lang string")
    learned = langid.learn(df.where(~langid.held_out(F.col("doc_id"))), id_col="doc_id", text_col="text", lang_col="lang")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(df, learned).collect()}
    assert all(got[i][0] == lang for i, _, lang in rows) and all(0 <= s <= 1 for _, s in got.values())
    assert got[900] == got[901] == got[902] == ("und", 0.0) and got[903][0] == "en" and got[None][0] == "de"
    nothing = langid.learn(df.limit(0), id_col="doc_id", text_col="text", lang_col="lang")
    assert {r.lang_pred for r in langid.identify(df, nothing).collect()} == {"und"}


def test_every_language_is_learned(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(k, " ".join(letters[k // 26] + letters[k % 26] + x + letters[k % 26] for x in "aeiou"), f"l{k:03}") for k in range(140)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = langid.learn(df, id_col="doc_id", text_col="text", lang_col="lang")
    assert [k for k, _ in learned] == [f"l{k:03}" for k in range(140)]
    assert langid.Identifier(learned).predict(rows[139][1])[0] == "l139"


def test_phrases_cross_words():
    automaton = langid.SuffixAutomaton(langid.running("Over the hill, and far away"))
    assert automaton.phrases(langid.running("the HILL and")) == 1 and automaton.phrases(langid.running("hill the")) == 2


def test_languages_by_brute_force(spark):
    """Every prediction against a parse by plain substring search."""
    import random

    rng = random.Random(2)
    rows = [(k, " ".join("".join(rng.choice(s) for _ in range(rng.randrange(1, 7))) for _ in range(30)), lang) for k, (lang, s) in enumerate([("x", "aabcd"), ("y", "abbcd"), ("z", "abccd")] * 8)]
    rows += [(100, "a " * 40_000 + "b", "long"), (101, "a " * 30_000 + "bb", "long"), rows[0], (102, "éé ::", None), (None, "abab", "x")]
    df = spark.createDataFrame([(*r, "x", 0.5) for r in rows], "doc_id long, text string, lang string, lang_pred string, score double")
    learned = langid.learn(df, id_col="doc_id", text_col="text", lang_col="lang")
    assert {k for k, _ in learned} == {"x", "y", "z", "long"} and len(dict(learned)["long"]) == 60_004

    def phrases(text, unit):
        n = i = 0
        while i < len(unit):
            size = 1
            while unit[i : i + size + 1] in text and i + size < len(unit):
                size += 1
            i, n = i + size, n + 1
        return n

    got = langid.identify(df, learned).collect()
    assert len(got) == len(rows)
    for (i, text, _), r in zip(sorted(rows, key=str), sorted(got, key=lambda r: str((r.doc_id, next(t for k, t, _ in rows if k == r.doc_id)))), strict=True):
        if len(text) < 1000:
            cost = [phrases(said, langid.running(text)) * math.log2(len(said) + 1) for _, said in learned]
            assert r.lang_pred == learned[cost.index(min(cost))][0], (i, text)
    assert langid.identify(df.limit(0), learned).count() == 0


# -- HTML ------------------------------------------------------------------------------


def page(body, title="T", n=0):
    return f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var t='</p><p>no</p>';</script></head><body><nav><ul><li><a href='/{n}'>menu {n}</a></ul></nav>{body}<footer>&copy; foot {n}</footer></body>"


def test_article_with_boilerplate_inside():
    html = page("<header>site head</header><article><header><h1>Head&amp;line</h1></header><p><b>One</b>\n  two<br>three<p>four &#233;<aside>side</aside><div class='comments'><p>reader</p></div><form>f</form><ul><li>a<li>b</ul></article>")
    assert html_text.extract(html, None, frozenset()) == "Head&line\n\nOne two three\n\nfour é\n\na\n\nb"


def test_wrapper_of_pages_without_article(spark):
    body = "<div class='top'>Always the same</div><div id='x{0}' class='story'><h2>Title {0}</h2><p>" + "text number {0} with words {0}" * 3 + "</p><div class='tools'><p>Share this page</p></div></div><div class='notice'>cookie {0}</div>"
    rows = [(i, f"http://h.example/{i}", page(body.format(f"q{i * 7919 % 1000}"), n=i)) for i in range(12)]
    got = {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3].startswith("Title q757\n\ntext number") and "Always" not in got[3] and "cookie" not in got[3] and "menu" not in got[3] and "Share" not in got[3]


@pytest.mark.parametrize("holder", ["article", "div"])
def test_headings_closing_lines_and_quotes_that_recur_stay(spark, holder):
    """Twelve articles of one host that share a heading, a quote, a list and a closing line, with and without a marked article."""
    own = lambda i: [f"word{i} of text{i * 31 % 17} " * 12 + f"line{k}" for k in range(3)]
    body = lambda i: f"<{holder} class='entry'><h1>Title {i * 7}</h1><p>{own(i)[0]}</p><blockquote><p>All things pass.</p></blockquote><ul><li>Flour</li><li>own {i}</li></ul><div class='tools'><p>Print this</p></div><p>{own(i)[1]}</p><h2>Conclusion</h2><p>{own(i)[2]}</p><p>Thank you for reading.</p></{holder}><div class='more'>Always here</div>"
    rows = [(i, f"http://c.example/{i}", page(body(i), n=i)) for i in range(12)]
    got = {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(12):
        a, b, c = own(i)
        assert got[i].split("\n\n") == [f"Title {i * 7}", a, "All things pass.", "Flour", f"own {i}", b, "Conclusion", c, "Thank you for reading."]


def test_the_hosts_wrapper_comes_before_the_article_tag(spark):
    rows = [(i, f"http://w.example/{i}", page(f"<article><p>Subscribe to us</p></article><div class='box'><div class='story'><h2>Title {i}</h2><div class='text'><p>" + f"words{i} of story{i * 31} " * 20 + f"</p><p>end{i}</p></div></div></div>", n=i)) for i in range(10)]
    got = {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(10):
        assert got[i] == f"Title {i}\n\n" + (f"words{i} of story{i * 31} " * 20).strip() + f"\n\nend{i}"


def test_names_alone_drop_no_text_of_an_article(spark):
    odd = "<article><p>Intro.</p><div class='search-algorithms'><p>Binary search.</p></div><section id='login-systems'><p>Keys.</p></section></article>"
    assert html_text.extract(page(odd), None, frozenset()) == "Intro.\n\nBinary search.\n\nKeys."
    # one section named like boilerplate is the article's; what recurs under such a name is not
    story = "<div class='story'><p>own{0} text{1} of{0} page{1} and{0} more{1} words{0}</p>{2}<div class='comments'><p>reader{0} says{1}</p></div></div>"
    rows = [(i, f"http://c.example/{i}", page(story.format(i, i * 7, "<div class='search'><p>How search works</p></div>" if i == 3 else ""), n=i)) for i in range(10)]
    got = {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(10):
        assert got[i] == f"own{i} text{i * 7} of{i} page{i * 7} and{i} more{i * 7} words{i}" + ("\n\nHow search works" if i == 3 else "")


def test_paths_align_what_simple_tree_matching_aligns():
    import random

    rng = random.Random(1)

    def tree(depth=0):
        return [(f"div class='n{k}'", tree(depth + 1)) for k in range(rng.randrange(1, 4))] if depth < 3 else []

    def cut(nodes):
        return [(label, cut(inner)) for label, inner in nodes if rng.random() < 0.8]

    def markup(nodes):
        return "".join(f"<{label}>{markup(inner) or f'text {rng.random()}'}</div>" for label, inner in nodes)

    def kids(node):
        return [c for c in node.children if isinstance(c, html_text.Node)]

    def matched(a, b):
        """Pairs of the best alignment of two trees whose roots match: simple tree matching, children in order."""
        if a.label != b.label:
            return []
        x, y = kids(a), kids(b)
        best = [[[] for _ in range(len(y) + 1)] for _ in range(len(x) + 1)]
        for i in range(len(x)):
            for j in range(len(y)):
                best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + matched(x[i], y[j]), key=len)
        return [(a, b), *best[-1][-1]]

    def nodes(node):
        return [node, *(n for c in kids(node) for n in nodes(c))]

    for _ in range(200):
        base = tree()
        a, b = (html_text.parse(markup(cut(base))) for _ in range(2))
        paths = {n.path for n in nodes(a)} & {n.path for n in nodes(b)}
        pairs = matched(a, b)
        assert all(p.path == q.path for p, q in pairs) and {p.path for p, _ in pairs} == paths


def test_pages_without_article_tags_give_the_same_text(spark):
    """Three hosts; the article tag and the names that tell adverts are taken away, so that only the wrapper can tell."""
    import random

    rng = random.Random(4)
    say = lambda n: " ".join("".join(rng.choice("aeiouthnrsl") for _ in range(rng.randrange(2, 8))) for _ in range(n))
    rows, want = [], {}
    for i in range(60):
        said = [say(rng.randrange(8, 60)) for _ in range(rng.randrange(1, 6))]
        want[i] = "\n\n".join(said)
        body = f"<div class='q'>{rng.choice(['Buy now', 'Win this', 'Try me'])}</div><div class='x'>" + "".join(f"<p>{t}<p><b></b>" for t in said) + "</div><div class='z'>All rights kept</div>"
        rows.append((i, f"http://h{i % 3}.example/{i}", page(body, n=i % 4)))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.main_text(df).collect()}
    assert sum(got[i] == want[i] for i in want) >= 0.95 * len(want)
    assert all(html_text.extract(h, None, frozenset()) != want[i] for i, _, h in rows)  # without induction


def test_all_pages_of_a_host_are_aligned_to_their_ends(spark):
    common = "".join(f"<div class='c{chr(97 + k)}'>Standing text {k} of this place</div>" for k in range(10))
    rows = [(i, f"http://s.example/{i}", page("<div class='story'>" + "".join(f"<p>own{i} part{k} word{i * 7 + k} of{i}</p>" for k in range(4)) + f"{common}</div>", n=i)) for i in range(40)]
    # another layout in few of the pages, whose template comes late
    rows += [(100 + i, f"http://s.example/b{i}", page(f"<section><div class='long'><p>" + f"tale{i} goes{i * 3} on{i} " * 12_000 + f"</p><p>fin{i}</p><div class='late'><p>The last of all words</p></div></div></section>", n=i)) for i in range(6)]
    # near copies of one article
    copy = [f"sentence {k} " + " ".join(f"x{k}y{j}" for j in range(40)) for k in range(10)]
    rows += [(200 + i, f"http://n.example/{i}", page("<div class='story'>" + "".join(f"<p>{t if k != i else t + f' changed{i}'}</p>" for k, t in enumerate(copy)) + "</div>")) for i in range(6)]
    got = {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(40):
        assert got[i] == "\n\n".join(f"own{i} part{k} word{i * 7 + k} of{i}" for k in range(4))
    for i in range(6):
        assert got[100 + i] == (f"tale{i} goes{i * 3} on{i} " * 12_000).strip() + f"\n\nfin{i}"
        assert got[200 + i] == "\n\n".join(t if k != i else t + f" changed{i}" for k, t in enumerate(copy))


def test_odd_pages(spark):
    rows = [(1, None, None), (2, "u", ""), (3, "http://a.b/c", "plain words"), (4, "http://a.b/d", "<p>x<p>y</div></p>"), (None, "http://A.b:80/e", "<article>" + "<div>" * 2000 + "deep" + "</div>" * 2000), (3, "http://a.b/c", "plain words"), (5, "http://a.b/f", "<article></article>")]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "page_id long, url string, html string, text int, host string")
    got = sorted((str(r.page_id), r.text, r.n_chars) for r in html_text.main_text(df).collect())
    assert got == sorted([("1", "", 0), ("2", "", 0), ("3", "plain words", 11), ("3", "plain words", 11), ("4", "x\n\ny", 4), ("None", "deep", 4), ("5", "", 0)])
    assert html_text.main_text(df.limit(0)).count() == 0


# -- mixing ----------------------------------------------------------------------------


def targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, stopped = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in stopped)
        rest = sum(w[s] for s in names if s not in stopped)
        level = {s: most * sizes[s] if s in stopped else w[s] * left / rest for s in names}
        over = {s for s in names if s not in stopped and level[s] > most * sizes[s] + 1e-9}
        if not over:
            return level
        stopped |= over


def test_mixing(spark):
    rows = [(i, " ".join(["w"] * (i % 9 + 1)), f"s{i % 4}") for i in range(200)] + [(300 + i, "a b c", "tiny") for i in range(2)] + [(400, None, "s0"), (401, "", "empty"), (402, "x y", None), (403, "z " * 3000, "s1"), (5, "w w", "s2"), (None, "q q q", "s3")]
    df = spark.createDataFrame([(*r, 7, 8) for r in rows], "doc_id long, text string, source string, size int, target int")
    got = mixing.mix_sources(df).collect()
    sizes, taken = {}, {}
    for i, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = targets(sizes)
    assert len(got) == len(rows)
    for r in got:
        taken[r.source] = taken.get(r.source, 0) + r.taken
        assert 0 <= r.taken <= 3 * r.size and r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in want)
    again = sorted((str(r.doc_id), r.size, r.taken) for r in mixing.mix_sources(df.repartition(5)).collect())
    assert again == sorted((str(r.doc_id), r.size, r.taken) for r in got)
    assert mixing.mix_sources(df.limit(0)).count() == 0


# -- chat ------------------------------------------------------------------------------

CONTROL = "</s>[INST] ok [/INST] <|turn|>\\|<|text|> \\\\ <|end|>"


def test_chat_round_trip(spark):
    rows = [(1, 0, "user", CONTROL), (1, 1, "assistant", "a\nb é"), (1, 2, "user", None), (1, 3, "assistant", CONTROL + "<"), (2, 0, "we|ird<\\", ""), (2, 1, None, "\\"), (3, None, "assistant", "x"), (3, 0, "assistant", "y"), (None, 0, "user", "n"), (4, 0, "assistant", "same"), (4, 0, "assistant", "same")]
    df = spark.createDataFrame([(*r, 5) for r in rows], "conv_id long, turn long, role string, text string, formatted int")
    back = {r.conv_id: r for r in chat.parse(chat.render(chat.row_turns(df))).collect()}
    turns = lambda k: [(t.role, t.text) for t in back[k].turns]
    assert turns(1) == [("user", CONTROL), ("assistant", "a\nb é"), ("user", ""), ("assistant", CONTROL + "<")]
    assert turns(2) == [("we|ird<\\", ""), ("", "\\")] and turns(3) == [("assistant", "x"), ("assistant", "y")]
    assert back[1].loss_text == "a\nb é" + CONTROL + "<" and turns(4) == [("assistant", "same")] * 2
    assert "</s>" not in back[1].formatted and "[INST]" not in back[1].formatted
    assert chat.row_turns(df.limit(0)).count() == 0


def test_loss_lengths_point_at_the_text(spark):
    df = spark.createDataFrame([(1, 0, "user", "a|b"), (1, 1, "assistant", "c<d")], "conv_id long, turn long, role string, text string")
    r = chat.render(chat.row_turns(df)).first()
    assert list(r.loss_lengths) == [0, 4] and r.formatted.endswith("<|text|>c\\ld<|end|>")


def test_layouts(spark):
    records = [
        (1, {"prompt": "p", "completion": "c"}),
        (2, {"instruction": "i", "input": "n", "output": "o"}),
        (3, {"instruction": "i", "input": "", "output": "o"}),
        (4, {"messages": [{"role": "system", "content": "s"}, {"content": "u", "role": "user"}]}),
        (5, {"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}]}),
        (6, {"odd": 1}),
        (7, {"response": "r", "prompt": "p"}),
        (10, {"id": 3, "source": {"name": "x"}, "prompt": "p", "completion": "c"}),
        (11, {"messages": [{"role": "user", "content": "u"}, {"role": "assistant", "content": "a", "tool_calls": [{"name": "f"}]}]}),
        (12, {"messages": [{"role": "user", "content": [{"type": "text", "text": "one "}, {"type": "text", "text": "two"}]}, {"role": "assistant", "content": "[a]"}]}),
        (13, {"prompt": "p", "answer": "a"}),
        (14, {"messages": []}),
    ]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in records] + [(8, "no json"), (9, None)], "id long, j string")
    got = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in chat.canonical_turns(df, id_col="id", json_col="j").collect()}
    assert got == {1: [("user", "p"), ("assistant", "c")], 2: [("user", "i\nn"), ("assistant", "o")], 3: [("user", "i"), ("assistant", "o")], 4: [("system", "s"), ("user", "u")], 5: [("user", "h"), ("assistant", "g")], 6: [], 7: [("user", "p"), ("assistant", "r")], 8: [], 9: [], 10: [("user", "p"), ("assistant", "c")], 11: [("user", "u"), ("assistant", "a")], 12: [("user", "one two"), ("assistant", "[a]")], 13: [], 14: []}


def test_the_fingerprint_selects_the_mapping(spark):
    rows = spark.createDataFrame([(1, 0, "user", "u", "x"), (1, 1, "assistant", "a", "y")], "conversation_id long, position long, speaker string, utterance string, source string")
    assert [(t.role, t.text) for t in chat.row_turns(rows).first().turns] == [("user", "u"), ("assistant", "a")]
    with pytest.raises(ValueError, match="no layout"):
        chat.row_turns(rows.drop("speaker"))
    assert chat.row_layout(rows) == ("conversation_id", "position", "speaker", "utterance")
    assert [r.layout for r in chat.canonical_turns(spark.createDataFrame([(1, '{"a": 1}')], "i long, j string"), id_col="i", json_col="j").collect()] == [None]


LIKE_JSON = ['[{"text": "hello"}]', '[{"text": "a"}, {"text": "b"}]', '[{"foo": "x"}]', "[1, [2, [3]]]", '{"messages": [{"role": "user", "content": "x"}]}', "[]", "[", '"', "null", " [ "]


def test_texts_that_look_like_json_stay(spark):
    df = spark.createDataFrame([(k, 0, "user", t) for k, t in enumerate(LIKE_JSON)], "conv_id long, turn long, role string, text string")
    back = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in chat.parse(chat.render(chat.row_turns(df))).collect()}
    assert back == {k: [("user", t)] for k, t in enumerate(LIKE_JSON)}
    records = [json.dumps({"messages": [{"role": "user", "content": t}]}) for t in LIKE_JSON] + [json.dumps({"prompt": t, "response": t}) for t in LIKE_JSON]
    got = {r.conv_id: [t.text for t in r.turns] for r in chat.canonical_turns(spark.createDataFrame(list(enumerate(records)), "id long, j string"), id_col="id", json_col="j").collect()}
    n = len(LIKE_JSON)
    assert got == {k: [t] for k, t in enumerate(LIKE_JSON)} | {n + k: [t, t] for k, t in enumerate(LIKE_JSON)}


def test_turns_of_over_twenty_million_characters(spark):
    """Beyond the JSON reader's own limit, in a table and as JSON."""
    n = 21_000_000
    one = spark.range(1).select(F.lit(1).alias("conv_id"), F.lit(0).alias("turn"), F.lit("assistant").alias("role"), F.repeat(F.lit("[{'é|"), n // 5).alias("text"))
    sha = hashlib.sha256(("[{'é|" * (n // 5)).encode()).hexdigest()
    row = chat.parse(chat.render(chat.row_turns(one))).select(F.size("turns").alias("n"), F.length("loss_text").alias("chars"), chat.sha(F.col("loss_text")).alias("sha")).first()
    assert (row.n, row.chars, row.sha) == (1, n, sha)
    record = one.select("conv_id", F.to_json(F.struct(F.array(F.struct("role", F.col("text").alias("content"))).alias("messages"))).alias("j"))
    got = chat.canonical_turns(record, id_col="conv_id", json_col="j").select("layout", chat.sha(F.get("turns", F.lit(0))["text"]).alias("sha")).first()
    assert got.layout == "messages[].role+messages[].content" and got.sha == sha


# -- pipeline --------------------------------------------------------------------------


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    long = " ".join(f"word{i} alpha beta" for i in range(40))
    near = " ".join(f"n{'abcdefghij'[i % 10]}{i} gamma delta" for i in range(80))
    run = "\n".join(" ".join(f"r{k}x{j}" for j in range(20)) for k in range(3))
    rows = [(1, f"intro one {ITEM} {long}", "en", "s1"), (2, f"own first\n{run}", "en", "s1"), (3, f"own second\n{run}", "en", "s2"), (4, near, "en", "s1"), (5, near + " tail", "en", "s2"), (6, "1234 !!", "en", "s1"), (7, None, "en", None), (8, "clean words only here", None, None), (9, run, "en", "s2")]
    df = spark.createDataFrame([(i, t, lang, s, len(t or ""), "x") for i, t, lang, s in rows], "doc_id long, text string, lang string, source string, n_chars long, mix string")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    seen, docs = {}, df
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        path = str(tmp_path / name)
        out.write.parquet(path)
        if name != "mix_sources":
            assert out.columns == df.columns
        docs = spark.read.parquet(path)
        seen[name] = {r.doc_id: r for r in docs.collect()}
    assert set(seen["language_id"]) == {1, 2, 3, 4, 5, 8, 9}
    assert set(seen["line_dedup"]) == {1, 2, 3, 4, 5, 8} and seen["line_dedup"][3].text == "own second" and seen["line_dedup"][3].n_chars == 10
    assert set(seen["minhash_neardup"]) == {1, 2, 3, 4, 8} and set(seen["benchmark_decontamination"]) == {2, 3, 4, 8}
    mixed = seen["mix_sources"]
    assert set(mixed) <= {2, 3, 4, 8} and all(r.mix == "x" and r.mix_.taken > 0 for r in mixed.values())
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, df.limit(0), str(tmp_path)).count() == 0
    assert math.isfinite(sum(r.mix_.target for r in mixed.values()))
