"""Merkle manifest of a dataset by higher-order SQL blocks (operator 11).

Every row is a leaf, the hash of its fields. The leaves of a tree (here: of a language) get
dense places from range-sorted parts, and fixed-size blocks of 512 of them become ordered
arrays. Inside a block, sequence, slice and transform make the hashes of runs of eight and
aggregate repeats that for three levels; the block roots are the nodes of the next round,
until each tree is one block. Rounds grow with the logarithm of the rows. On the way back
every block takes up the path above it, so a leaf's path to the root is the path inside its
block followed by its block's. No group is larger than a block, whatever a language holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.pairs import dense_ids
from .common import ascii_lower, discard, materialize, table

#: Children of a node, levels that one block collapses, and leaves of a block.
FAN, LEVELS = 8, 3
BLOCK = FAN**LEVELS


def digest(text: Column) -> Column:
    """H: lowercase hex sha256 of a string's UTF-8 bytes."""
    return F.sha2(text.cast("binary"), 256)


def encoded(value: Column) -> Column:
    """A field as byte count, colon and value, or - where it is null: no two lists of fields read alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*fields: Column) -> Column:
    return digest(F.concat(*map(encoded, fields)))


def parents(nodes: Column) -> Column:
    """Hashes of runs of eight nodes; the last run may be shorter."""
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / FAN).cast("int"))
    return F.transform(runs, lambda i: digest(F.array_join(F.slice(nodes, i * FAN + 1, F.lit(FAN)), "")))


def depth(size: Column) -> Column:
    """Levels above the leaves of a tree of so many leaves."""
    return F.size(F.filter(F.array(*[F.lit(FAN**k) for k in range(20)]), lambda reach: reach < size))


def siblings(levels: Column, place: Column) -> Column:
    """The path of the node at a place of the lowest level: of each level but the highest, the rest of its run to the left and right."""

    def beside(nodes: Column, level: Column) -> Column:
        at = F.call_function("shiftright", place, level * 3)
        first = at - at % FAN
        return F.struct(F.array_join(F.slice(nodes, first + 1, at - first), "").alias("left"), F.array_join(F.slice(nodes, at + 2, first + FAN - 1 - at), "").alias("right"))

    below = F.slice(levels, F.lit(1), F.size(levels) - 1)
    return F.transform(below, beside)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda node, s: digest(F.concat(s["left"], node, s["right"])))


def proof_digest(path: Column) -> Column:
    """Hash of all siblings of a path, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def climb(nodes: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """(tree, place, digest, *carry, path, top) of nodes (tree, size, place, digest, *carry).

    size is the number of a tree's nodes, place counts them from 0. path is that to the
    tree's top node: array of (left, right).
    """
    item = F.struct("place", "digest", *carry)
    blocks = nodes.groupBy("tree", "size", F.expr(f"place div {BLOCK}").alias("block")).agg(F.array_sort(F.collect_list(item)).alias("items"))
    lowest = F.array(F.transform("items", lambda x: x["digest"]))
    rounds = F.slice(F.sequence(F.lit(1), F.lit(LEVELS)), F.lit(1), F.least(F.lit(LEVELS), depth(F.col("size"))))
    levels = F.aggregate(rounds, lowest, lambda found, _: F.concat(found, F.array(parents(F.element_at(found, -1)))))
    blocks = materialize(blocks.withColumn("levels", levels))
    root = F.element_at(F.element_at("levels", -1), 1)
    if blocks.where(F.col("size") > BLOCK).isEmpty():
        blocks = blocks.select("tree", "items", "levels", F.array().cast("array<struct<left:string,right:string>>").alias("up"), root.alias("top"))
    else:
        above = climb(blocks.select("tree", F.ceil(F.col("size") / BLOCK).alias("size"), F.col("block").alias("place"), root.alias("digest")))
        above = above.select(F.col("tree").alias("up_tree"), F.col("place").alias("up_place"), F.col("path").alias("up"), "top")
        blocks = blocks.join(above, (F.col("tree") == F.col("up_tree")) & (F.col("block") == F.col("up_place"))).select("tree", "items", "levels", "up", "top")
    placed = F.transform("items", lambda x, i: F.struct(x.alias("x"), siblings(F.col("levels"), i).alias("path")))
    out = blocks.select("tree", "up", "top", F.explode(placed).alias("p"))
    return out.select("tree", "p.x.place", "p.x.digest", *[f"p.x.{c}" for c in carry], F.concat("p.path", "up").alias("path"), "top")


def manifest(leaves: DataFrame, *, leaf: str, tree: str, order: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """(leaf, *carry, path, subroot, root), a row per leaf: path leads through its tree's subroot to the root.

    Leaves of a tree ascend by the columns of order (null first), ties by their hash;
    subroots ascend by tree (null first, bytewise). Rows repeated in full are leaves of
    their own. A tree of one leaf has that leaf as subroot, and a single subroot is the
    root. An empty table gives no rows. Names of the columns of `leaves` never clash with
    the operator's own, as all travel in one struct.
    """
    named = leaves.select(
        F.coalesce(F.concat(F.lit("="), F.col(tree).cast("string")), F.lit("-")).alias("tree"),
        F.struct(*order).alias("sort"),
        F.col(leaf).alias("digest"),
        F.struct(F.lit(0).alias("__"), *carry).alias("carried"),
        F.monotonically_increasing_id().alias("row"),
    )
    named = materialize(named)
    numbered = materialize(dense_ids(named, ["tree", "sort", "digest", "row"], out="number", start=0))
    discard(named)
    trees = materialize(numbered.groupBy("tree").agg(F.min("number").alias("first"), F.count("*").alias("size")).withColumnRenamed("tree", "of"))
    nodes = numbered.join(trees, F.col("tree") == F.col("of")).select("tree", "size", (F.col("number") - F.col("first")).alias("place"), "digest", "carried")
    low = climb(nodes, ["carried"])
    tops = dense_ids(materialize(low.where("place = 0").select("tree", F.col("top").alias("digest"))), ["tree"], out="place", start=0)
    tops = tops.select(F.lit("").alias("tree"), F.lit(trees.count()).cast("long").alias("size"), "place", "digest", F.col("tree").alias("name"))
    high = climb(tops, ["name"]).select("name", F.col("path").alias("above"), F.col("top").alias("root"))
    found = low.join(materialize(high), F.col("tree") == F.col("name"))
    return found.select(F.col("digest").alias("leaf"), *[F.col(f"carried.`{c}`") for c in carry], F.concat("path", "above").alias("path"), F.col("top").alias("subroot"), "root")


#: Fields of a document in the order in which its leaf hashes them.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as leaves, verified after a third of them were tampered with. A null doc_id comes first and stays untampered."""
    docs = table(spark, sf_dir, "documents")
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    text = F.when(tampered, ascii_lower(F.col("text"))).otherwise(F.col("text"))
    leaves = docs.select("doc_id", "lang", leaf_digest(*map(F.col, FIELDS)).alias("leaf"), leaf_digest(*map(F.col, FIELDS[:-1]), text).alias("now"))
    found = manifest(leaves, leaf="leaf", tree="lang", order=["doc_id"], carry=["doc_id", "now"])
    found = found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), fold(F.col("now"), F.col("path")).alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def _sql(levels: int = 10) -> str:
    """SQL of the query for trees of up to 8^levels leaves: the levels are written out."""

    def field(name: str, value: str) -> str:
        return f"coalesce(octet_length(encode({value}::VARCHAR))::VARCHAR || ':' || {value}::VARCHAR, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(field(f, text if f == "text" else f) for f in FIELDS) + ")"

    # CRC-32: fixed polynomial 0xEDB88320
    table_of = "list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)"
    bits = "list_transform(range(256), lambda i: " + table_of + ")"
    crc = "xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), lambda c, b: xor(t[xor(c, b) % 256 + 1], c >> 8)), 4294967295)"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    out = [
        f"crc AS (SELECT {bits} AS t)",
        f"""d AS (SELECT doc_id, coalesce('=' || lang, '-') AS tree, {leaf("text")} AS leaf, {leaf(f"CASE WHEN doc_id IS NOT NULL AND {crc} % 3 = 0 THEN {lower} ELSE text END")} AS now FROM documents, crc)""",
        "a0 AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, now) - 1 AS p, leaf AS h, count(*) OVER (PARTITION BY tree) AS n FROM d)",
    ]

    def rise(at: str, first: str) -> None:
        """Nodes by level; above a tree's top its level stays as it is."""
        for k in range(1, levels + 1):
            below = first if k == 1 else f"{at}{k - 1}"
            out.append(f"{at}{k} AS (SELECT tree, p // 8 AS p, CASE WHEN max(n) > 1 THEN sha256(string_agg(h, '' ORDER BY p)) ELSE max(h) END AS h, (max(n) + 7) // 8 AS n FROM {below} GROUP BY tree, p // 8)")

    rise("a", "a0")
    out.append(f"b0 AS (SELECT '' AS tree, tree AS name, row_number() OVER (ORDER BY encode(tree)) - 1 AS p, h, count(*) OVER () AS n FROM a{levels})")
    rise("b", "b0")
    sides = "coalesce((SELECT string_agg(x.h, '' ORDER BY x.p) FROM {level} x WHERE x.tree = {of} AND x.p // 8 = {place} // 8 AND x.p {cmp} {place}), '')"
    k = 0
    out.append("f0 AS (SELECT a0.doc_id, a0.leaf, a0.now AS node, a0.tree, a0.p, b0.p AS q, '' AS proof FROM a0 JOIN b0 ON a0.tree = b0.name)")
    for at, of, place in (("a", "f.tree", "f.p"), ("b", "''", "f.q")):
        for level in range(levels):
            where = f"({place} // {8**level})"
            left, right = (sides.format(level=f"{at}{level}", of=of, place=where, cmp=c) for c in "<>")
            more = f"(SELECT max(n) FROM {at}{level} x WHERE x.tree = {of}) > 1"
            k += 1
            out.append(f"s{k} AS (SELECT f.*, {left} AS l, {right} AS r, {more} AS more FROM f{k - 1} f), f{k} AS (SELECT doc_id, leaf, CASE WHEN more THEN sha256(l || node || r) ELSE node END AS node, tree, p, q, CASE WHEN more THEN proof || l || r ELSE proof END AS proof FROM s{k})")
    return f"""WITH {", ".join(out)}
SELECT f.doc_id, f.leaf, b0.h AS subroot, b{levels}.h AS root, sha256(f.proof) AS proof_sha256, f.node AS folded_root, f.node = b{levels}.h AS verified
FROM f{k} f JOIN b0 ON f.tree = b0.name CROSS JOIN b{levels}"""


ORACLE = _sql(6)
