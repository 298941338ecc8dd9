"""MinHash near-dedup with sequential Bayesian verification (operator 2).

1. One pass over the texts gives each document the hash of its shingle set, band keys and
   a signature of one byte per hash. Documents with equal sets become one class.
2. Classes that share a band key are candidates. Within a band bucket no pairs are spelled
   out: each class is first compared with the centre of its largest buckets and the
   smallest id it shares a bucket with, which joins large groups of near copies into
   components. What is left are
   classes of other components in the same bucket; a bucket with few of those compares
   them with all its members, a bucket with many is compared in blocks inside tasks.
3. Candidates are compared signature batch by signature batch; a pair goes when the
   posterior of its similarity leaves less than `miss` for the threshold or more.
4. Survivors are verified on full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WordHashes, connected, discard, give_back, map_in_pandas, materialize, mix, shingle_run, table

#: 64 bands of 8 hashes miss a pair of similarity 0.8 with probability 8e-6.
BANDS, ROWS = 64, 8
#: Signature bytes kept for the Bayesian comparison, and the size of a batch.
SIGNATURE, BATCH = 256, 32
#: Chance at which a pair at the threshold may be pruned by each batch.
MISS = 1e-6
#: Members outside a bucket's largest component that are paired with all its members; buckets
#: with more go in blocks of so many members and shingles.
FEW, BLOCK, BLOCK_SHINGLES = 2, 2048, 2_000_000

_MULTIPLIERS = np.random.default_rng(20240229).integers(1, 2**31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_MIX = np.random.default_rng(7).integers(1, 2**62, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_hashes(text: str | None, words: int, hashes: dict) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a whole text; the whole sequence if it has fewer words."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    return np.unique(shingle_run(h, min(words, len(found))))


def minhashes(shingles: np.ndarray) -> np.ndarray:
    """BANDS * ROWS minima of multiplied hashes, in chunks that fit the cache."""
    x = (shingles >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    least = np.full(len(_MULTIPLIERS), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 64):
        block = x[i : i + 64, None] * _MULTIPLIERS
        np.minimum(least, block.min(axis=0), out=least)
    return least


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n_shingles, set_hash, bands, sig) of (doc_id, text); null hashes for empty sets."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for pdf in batches:
            out: dict[str, list] = {"n_shingles": [], "set_hash": [], "bands": [], "sig": []}
            for text in pdf["text"]:
                s = shingle_hashes(text, words, hashes)
                out["n_shingles"].append(len(s))
                if not len(s):
                    for k in ("set_hash", "bands", "sig"):
                        out[k].append(None)
                    continue
                least = minhashes(s)
                bands = mix((least.reshape(BANDS, ROWS).astype(np.uint64) * _MIX).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))
                out["set_hash"].append(xxhash.xxh3_128_digest(s.tobytes()))
                out["bands"].append(bands.view(np.int64))
                out["sig"].append((mix(least[:: len(least) // SIGNATURE].astype(np.uint64)) & np.uint64(255)).astype(np.uint8).tobytes())
            yield pd.DataFrame({"doc_id": pdf["doc_id"], **out})
            del pdf, out
        hashes.clear()
        give_back()

    return map_in_pandas(docs, run, "doc_id long, n_shingles long, set_hash binary, bands array<long>, sig binary")


@lru_cache
def least_matches(threshold: float, miss: float) -> tuple[int, ...]:
    """For 32, 64, ... hashes: matches below which the posterior of threshold or more is under miss.

    Uniform prior; bytes of different hashes match by chance once in 256, so the chance of a
    match at similarity s is s + (1 - s) / 256. The posterior tail is summed on a grid.
    """
    grid = (np.arange(2000) + 0.5) / 2000
    p, high = grid + (1 - grid) / 256, grid >= threshold
    out = []
    for n in range(BATCH, SIGNATURE + 1, BATCH):
        m = 0
        while m <= n:
            log = m * np.log(p) + (n - m) * np.log1p(-p + 1e-15)
            weight = np.exp(log - log.max())
            if weight[high].sum() / weight.sum() >= miss:
                break
            m += 1
        out.append(m)
    return tuple(out)


def survives(a: np.ndarray, b: np.ndarray, threshold: float, miss: float) -> np.ndarray:
    """Rows of two signature matrices that no batch prunes; later batches see survivors only."""
    alive, matches = np.arange(len(a)), np.zeros(len(a), np.int64)
    for k, least in enumerate(least_matches(threshold, miss)):
        if not len(alive):
            break
        part = slice(k * BATCH, (k + 1) * BATCH)
        matches[alive] += (a[alive, part] == b[alive, part]).sum(axis=1)
        alive = alive[matches[alive] >= least]
    return alive


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(-1, SIGNATURE)


def prune(pairs: DataFrame, sigs: DataFrame, threshold: float, miss: float) -> DataFrame:
    """Pairs (a, b) whose signatures leave the threshold possible."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keep = survives(_matrix(pdf["sig_a"]), _matrix(pdf["sig_b"]), threshold, miss) if len(pdf) else []
            yield pdf.iloc[keep][["a", "b"]]

    with_sigs = pairs.join(sigs.select(F.col("doc_id").alias("a"), F.col("sig").alias("sig_a")), "a").join(sigs.select(F.col("doc_id").alias("b"), F.col("sig").alias("sig_b")), "b")
    return with_sigs.mapInPandas(run, "a long, b long")


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) with 100 * intersection >= percent * union on full sets, and the overlap."""
    joined = pairs.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b")), "b").join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a")), "a")
    both = F.size(F.array_intersect("set_a", "set_b")).cast("long")
    counted = joined.select("a", "b", both.alias("overlap"), (F.size("set_a") + F.size("set_b")).cast("long").alias("total"))
    return counted.where(100 * F.col("overlap") >= percent * (F.col("total") - F.col("overlap"))).select("a", "b")


def blocked_links(members: DataFrame, sigs: DataFrame, sets: DataFrame, threshold: float, percent: int, miss: float) -> DataFrame:
    """Verified links (a, b) of buckets (key, doc_id, root, top) with many components.

    Members are dealt into blocks bounded in rows and shingles; a task gets two blocks.
    Members outside the bucket's largest component are compared with all of the other block:
    signature batches prune, and survivors are verified by counting shared shingles of one
    member against the whole block at once. Only links that join two components are emitted,
    so a group of near copies gives fewer rows than it has members.
    """
    full = members.join(sets.select("doc_id", "shingles"), "doc_id").join(sigs, "doc_id")
    sizes = members.join(sets.select("doc_id", F.size("shingles").alias("n")), "doc_id").groupBy("key").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    dealt = full.join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least("block", o).alias("i"), F.greatest("block", o).alias("j")))
    spread = dealt.select("key", "doc_id", "root", "top", "sig", "shingles", "block", F.explode(meets).alias("at")).select("key", "doc_id", "root", "top", "sig", "shingles", "block", "at.i", "at.j")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j, top = pdf["i"].iloc[0], pdf["j"].iloc[0], pdf["top"].iloc[0]
        ids, roots, sig, block = pdf["doc_id"].to_numpy(), pdf["root"].to_numpy(), _matrix(pdf["sig"]), pdf["block"].to_numpy()
        held = [np.asarray(x, np.int64) for x in pdf["shingles"]]
        size = np.array([len(x) for x in held])
        # components by number; joined ones take one number, for all members at once
        part = np.unique(roots, return_inverse=True)[1]
        out = []
        for left, right in ((i, j), (j, i)) if i != j else ((i, i),):
            asks, others = np.flatnonzero((block == left) & (roots != top)), np.flatnonzero(block == right)
            if not len(asks) or not len(others):
                continue
            owner = np.repeat(np.arange(len(others)), size[others])
            shingle = np.concatenate([held[y] for y in others])
            order = np.argsort(shingle, kind="stable")
            shingle, owner = shingle[order], owner[order]
            for x in asks:
                maybe = np.flatnonzero(part[others] != part[x])
                maybe = maybe[survives(np.broadcast_to(sig[x], (len(maybe), SIGNATURE)), sig[others[maybe]], threshold, miss)]
                if not len(maybe):
                    continue
                low, high = np.searchsorted(shingle, held[x], "left"), np.searchsorted(shingle, held[x], "right")
                n = high - low
                places = np.repeat(low - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
                both = np.bincount(owner[places], minlength=len(others))[maybe]
                linked = others[maybe[100 * both >= percent * (size[x] + size[others[maybe]] - both)]]
                for y in linked:
                    if part[y] != part[x]:
                        out.append((min(ids[x], ids[y]), max(ids[x], ids[y])))
                        part[part == part[y]] = part[x]
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return spread.groupBy("key", "i", "j").applyInPandas(run, "a long, b long")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80, miss: float = MISS) -> DataFrame:
    """(doc_id, n_shingles, component_id), a row per input row.

    Links join documents whose sets of `words`-word shingles have 100 * intersection >=
    percent * union; component_id is the smallest id reachable. Null, empty and white-space
    texts have an empty set and are linked with nothing, as are rows without an id
    (component_id null). Texts of fewer words are one shingle. Rows that repeat an id are
    one vertex. An empty table gives no rows. Whole texts count; every candidate is decided
    on full sets; the only chance of a miss is that of the bands and of the pruning.
    """
    threshold = percent / 100
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    base = materialize(signatures(named, words))
    known = base.where("doc_id is not null and set_hash is not null")
    classes = materialize(known.groupBy("set_hash").agg(F.min("doc_id").alias("first_id")))
    # a class's smallest id stands for it; ids that repeat with other texts link classes
    firsts = classes.select("set_hash", F.col("first_id").alias("doc_id"))
    reps = materialize(known.select("doc_id", "set_hash", "bands", "sig").join(firsts, ["set_hash", "doc_id"], "left_semi").dropDuplicates(["set_hash", "doc_id"]).select("doc_id", "bands", "sig"))
    sigs = reps.select("doc_id", "sig")
    banded = reps.select("doc_id", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.count("*").alias("size"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("key", "size", "low")
    members = materialize(banded.join(shared, "key").distinct())

    wanted = members.select(F.col("doc_id").alias("wanted")).distinct()
    texts = named.join(wanted, F.col("doc_id") == F.col("wanted"), "left_semi")

    def sets_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "shingles": [shingle_hashes(t, words, hashes).view(np.int64) for t in pdf["text"]]})
            del pdf
        hashes.clear()
        give_back()

    sets = materialize(texts.mapInPandas(sets_of, "doc_id long, shingles array<long>"))
    # the text that near copies were made of meets most of them in each band: the member with
    # the largest buckets is its bucket's centre
    weight = members.groupBy("doc_id").agg(F.sum("size").alias("w"))
    centres = members.select("key", "doc_id").join(weight, "doc_id").groupBy("key").agg(F.max(F.struct("w", (-F.col("doc_id")).alias("minus"))).alias("c"))
    met = members.select("key", "doc_id").join(materialize(centres), "key").where("doc_id != -c.minus").groupBy("doc_id").agg(F.max("c").alias("c"))
    lows = members.where("doc_id > low").groupBy("doc_id").agg(F.min("low").alias("o"))
    hubs = met.select("doc_id", (-F.col("c.minus")).alias("o")).unionByName(lows).select(F.least("doc_id", "o").alias("a"), F.greatest("doc_id", "o").alias("b")).distinct()
    links = materialize(verify(prune(hubs, sigs, threshold, miss), sets, percent))

    roots = connected(links, "a", "b")
    labelled = members.join(roots, F.col("doc_id") == F.col("node"), "left").select("key", "doc_id", F.coalesce("root", "doc_id").alias("root"))
    counts = labelled.groupBy("key", "root").agg(F.count("*").alias("n"))
    open_keys = counts.groupBy("key").agg(F.sum("n").alias("size"), F.max(F.struct("n", "root")).alias("top"), F.count("*").alias("roots")).where("roots > 1").select("key", "size", F.col("top.root").alias("top"), (F.col("size") - F.col("top.n")).alias("others"))
    rest = materialize(labelled.join(open_keys, "key"))
    few = rest.where(F.col("others") <= FEW)
    x = few.where("root != top").select("key", F.col("doc_id").alias("x"), F.col("root").alias("root_x"))
    y = few.select("key", F.col("doc_id").alias("y"), F.col("root").alias("root_y"), "top")
    crossed = x.join(y, "key").where("root_x != root_y and (root_y = top or x < y)").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    many = rest.where(F.col("others") > FEW).select("key", "doc_id", "root", "top")
    found = prune(crossed.join(hubs, ["a", "b"], "left_anti"), sigs, threshold, miss)
    more = verify(found, sets, percent).unionByName(blocked_links(many, sigs, sets, threshold, percent, miss))
    # by itself, so that the join can split a class with very many copies
    same = materialize(known.select("doc_id", "set_hash").distinct().join(classes, "set_hash").where("doc_id != first_id").select(F.col("first_id").alias("a"), F.col("doc_id").alias("b")))
    components = connected(links.unionByName(more).unionByName(same), "a", "b")
    return base.join(components, F.col("doc_id") == F.col("node"), "left").select("doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id"))


def op2_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), words=2)
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
         ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * common >= 80 * (x.n + y.n - common)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT a AS doc_id, b AS other FROM e UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.other),
c AS (SELECT doc_id, min(other) AS least FROM r GROUP BY doc_id)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(c.least, w.doc_id)) AS component_id,
       w.doc_id = least(w.doc_id, coalesce(c.least, w.doc_id)) AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN c ON c.doc_id = w.doc_id
"""
