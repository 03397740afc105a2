"""Merkle manifest of a dataset: a hash tree a group, a tree over the groups'
roots, and a proof for each row.

Leaves are ranked within their group by a range partitioning (no group is
gathered in one task). The rank's digits, base ``RUN``, are then grouped away
one after the other inside blocks of ``RUN ** DIGITS`` leaves: each grouping
nests the structs of a run as the children of one node, so a block ends as one
row of bounded size, and all its groupings share one exchange. The digests of
the blocks are the leaves of the next, smaller table, until one node a group
is left. Downwards, each block row gets the path from its own node to the root
(one join a table, on the block's number); ``transform`` and ``explode`` then
emit the proofs of all its leaves without a join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut
from .line_dedup import LOWER, UPPER

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Nodes that one parent has at most, and digits grouped away within a block.
RUN, DIGITS = 8, 3
BLOCK = RUN ** DIGITS
_PATH = "array<struct<left:string,right:string>>"


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Digest of a row: each field as its UTF-8 byte count, ``:`` and value, or ``-`` for null."""
    def part(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return F.sha2(F.concat(*map(part, fields)), 256)


def _ranked(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` (with column ``grp``, never null) with ``rank``, from 0, in its
    group by ``order``, and ``total``, the size of the group. The order must be
    total: it decides which task has a row."""
    placed = cut(nodes.repartitionByRange("grp", *order).sortWithinPartitions("grp", *order)
                 .withColumn("at", F.monotonically_increasing_id()), "merkle-order")
    placed = placed.withColumn("task", F.shiftrightunsigned("at", 33))
    # One row for each group and task.
    counts = placed.groupBy("grp", "task").agg(F.min("at").alias("begin"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("grp")
    offsets = counts.select(
        "grp", "task", "begin", F.sum("n").over(whole).alias("total"),
        (F.sum("n").over(whole.orderBy("task").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"))
    return placed.join(offsets, ["grp", "task"]).withColumn("rank", F.col("at") - F.col("begin") + F.col("before")).drop(
        "at", "task", "begin", "before")


def _levels(total: Column) -> Column:
    """Groupings until ``total`` nodes are one, as far as one block goes."""
    return sum((F.when(total > RUN ** k, 1).otherwise(0) for k in range(DIGITS)), F.lit(0))


def _nested(nodes: DataFrame) -> DataFrame:
    """One row a block of the nodes (grp, rank, total, leaf): ``grp``, ``block``,
    ``total``, ``levels``, ``digest`` and ``tree``, the nested children. Where a
    group needs fewer groupings, the only child is handed on as it is."""
    digits = [f"d{k}" for k in range(DIGITS)]
    t = nodes.select("grp", F.floor(F.col("rank") / BLOCK).alias("block"), "total", _levels(F.col("total")).alias("levels"),
                     *[(F.floor(F.col("rank") / RUN ** k) % RUN).cast("int").alias(d) for k, d in enumerate(digits)],
                     F.col("leaf").alias("node"))
    t = t.repartition("grp", "block")
    for k in range(DIGITS):
        t = t.groupBy("grp", "block", *digits[k + 1:]).agg(
            F.first("total").alias("total"), F.first("levels").alias("levels"),
            F.sort_array(F.collect_list(F.struct(F.col(digits[k]).alias("no"), "node"))).alias("run"))
        children = F.col("run.node")
        digest = F.when(F.col("levels") > k, F.sha2(F.array_join(F.col("run.node.digest"), ""), 256)).otherwise(
            children[0]["digest"])
        t = t.select("grp", "block", *digits[k + 1:], "total", "levels",
                     F.struct(digest.alias("digest"), children.alias("children")).alias("node"))
    return t.select("grp", "block", "total", "levels", F.col("node.digest").alias("digest"),
                    F.col("node.children").alias("tree"))


def _tables(leaves: DataFrame, order: list[str]) -> list[DataFrame]:
    """Block tables from the leaves up; the last has one row a group."""
    nodes = _ranked(leaves, order)
    out = [cut(_nested(nodes), "merkle-blocks")]
    while (out[-1].agg(F.max("total")).first()[0] or 0) > BLOCK:
        upper = out[-1].select("grp", F.col("block").alias("rank"), F.ceil(F.col("total") / BLOCK).alias("total"),
                               F.struct("digest").alias("leaf"))
        out.append(cut(_nested(upper), "merkle-blocks"))
    return out


def _step(level: int, at: Column, digests: Column) -> Column:
    """What a child at ``at`` of the run adds to the path."""
    own = F.array(F.struct(F.array_join(F.slice(digests, F.lit(1), at), "").alias("left"),
                           F.array_join(F.slice(digests, at + 2, F.lit(RUN)), "").alias("right")))
    return F.when(F.col("levels") > level, own).otherwise(F.array().cast(_PATH))


def _emitted(blocks: DataFrame, carried: list[str]) -> DataFrame:
    """The leaves of the blocks: ``grp``, ``block``, ``no`` (rank in the table),
    ``leaf``, ``path`` (from the leaf to the root) and the carried columns."""
    t = blocks.select("grp", "block", F.lit(0).cast("long").alias("no"), "levels", "path", F.col("tree").alias("run"), *carried)
    for k in reversed(range(DIGITS)):
        t = t.select("grp", "block", "no", "levels", "path", F.col("run.digest").alias("digests"), F.posexplode("run").alias("at", "node"), *carried)
        more = [F.col("node.children").alias("run")] if k else [F.col("node").alias("leaf")]
        t = t.select("grp", "block", (F.col("no") * RUN + F.col("at")).alias("no"), "levels",
                     F.concat(_step(k, F.col("at"), F.col("digests")), "path").alias("path"), *more, *carried)
    return t.withColumn("no", F.col("block") * BLOCK + F.col("no"))


def _down(tables: list[DataFrame], top: DataFrame, carried: list[str]) -> DataFrame:
    """Leaves of the lowest table with their paths; ``top`` (grp, path and the
    carried columns) has a row a group."""
    paths = top.withColumn("block", F.lit(0).cast("long"))
    for k, t in reversed(list(enumerate(tables))):
        leaves = _emitted(t.join(paths, ["grp", "block"]), carried)
        if k:
            paths = leaves.select("grp", F.col("no").alias("block"), "path", *carried)
    return leaves


@dataclass
class Manifest:
    """``roots`` (grp, subroot, root, path) has a row a group, ``blocks`` are
    the tables of the trees from the leaves up."""
    roots: DataFrame
    blocks: list[DataFrame]

    def proofs(self) -> DataFrame:
        """(grp, no, leaf, path, subroot, root) per leaf: its place in the
        group, its struct (``digest`` and what was carried), and the siblings
        left and right of it and of each node above it."""
        return _down(self.blocks, self.roots, ["subroot", "root"])


def build(docs: DataFrame, columns: Sequence[str] = COLUMNS, key: str = "doc_id", group: str = "lang",
          claim: Column | None = None) -> Manifest:
    """The manifest of ``docs``: leaves of the ``columns``, a tree a value of
    ``group`` with its leaves by ascending ``key``, and a tree over the groups'
    roots by bytes of the group. A node is the digest of its up to 8 children's
    hex digests; a lone last child is hashed too; a group of one leaf has that
    leaf as its root. ``claim`` is a digest to carry with the leaf, for ``fold``.

    Null keys and a null group come first; rows of the same key follow their
    digests, so repeated rows are leaves beside each other. An empty table has
    no root and no proofs. Other columns are not read. Values are hashed as
    Spark writes them as strings: integers in decimal.
    """
    # No group is null: the mark before a value keeps the order of the bytes.
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("grp"), F.col(key).alias("key"),
        leaf_digest([F.col(c) for c in columns]).alias("digest"),
        (F.lit(None).cast("string") if claim is None else claim).alias("claim"),
        F.xxhash64(F.monotonically_increasing_id()).alias("tie"))
    # Digests once, before the range bounds are taken from them.
    leaves = cut(leaves, "merkle-leaves").select("grp", "key", "tie", F.col("digest").alias("hash"),
                                                 F.struct("digest", "key", "claim").alias("leaf"))
    blocks = _tables(leaves, ["key", "hash", "tie"])
    last = blocks[-1].select("grp", F.col("digest").alias("subroot"))
    trees = _tables(last.select(F.lit("").alias("grp"), F.col("grp").alias("name"),
                                F.struct(F.col("subroot").alias("digest"), F.col("grp").alias("name")).alias("leaf")), ["name"])
    top = trees[-1].select("grp", F.array().cast(_PATH).alias("path"), F.col("digest").alias("root"))
    roots = _down(trees, top, ["root"]).select(F.col("leaf.name").alias("grp"), F.col("leaf.digest").alias("subroot"),
                                               "root", "path")
    return Manifest(cut(roots, "merkle-roots"), blocks)


def fold(digest: Column, path: Column) -> Column:
    """The root that a digest and a path give."""
    return F.aggregate(path, digest, lambda d, p: F.sha2(F.concat(p["left"], d, p["right"]), 256))


def siblings(path: Column) -> Column:
    """The digests of a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), "")


def tampered(docs: DataFrame, columns: Sequence[str] = COLUMNS) -> Column:
    """Digest of a third of the rows (3 divides the crc32 of the id) with the
    text's A-Z in lower case; null for the others and for a null id."""
    changed = [F.translate("text", UPPER, LOWER) if c == "text" else F.col(c) for c in columns]
    return F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, leaf_digest(changed))


def manifest_report(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``
    (digest of the proof's siblings), ``folded_root`` from the tampered leaf or
    else the original one, and ``verified``. Cases as in ``build``."""
    folded = fold(F.coalesce("leaf.claim", "leaf.digest"), F.col("path"))
    return build(docs, claim=tampered(docs)).proofs().select(
        F.col("leaf.key").alias("doc_id"), F.col("leaf.digest").alias("leaf"), "subroot", "root",
        F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"), folded.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))


def oracle_sql(levels: int = 8) -> str:
    """For groups of up to 8 ** levels rows."""
    def digest(text: str) -> str:
        parts = ", ".join(f"coalesce(strlen({x}) || ':' || {x}, '-')" for x in (
            text if c == "text" else f"CAST({c} AS VARCHAR)" for c in COLUMNS))
        return f"sha256(concat({parts}))"
    bits = "flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ascii(c), 0, 0, 0, 0, 0, 0, 0]))"
    step = "xor(xor(a, b) >> 1, CASE WHEN xor(a, b) & 1 = 1 THEN 3988292384 ELSE 0 END)"
    crc = f"xor(4294967295, list_reduce(list_transform({bits}, lambda x: CAST(x AS BIGINT)), lambda a, b: {step}, CAST(4294967295 AS BIGINT)))"
    lowered = f"translate(text, '{UPPER}', '{LOWER}')"
    ctes = [f"""leaves AS (SELECT doc_id, coalesce('=' || lang, '') AS g, {digest('text')} AS leaf,
  CASE WHEN {crc} % 3 = 0 THEN {digest(lowered)} END AS claim FROM documents)""",
            """ranked AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r,
  count(*) OVER (PARTITION BY g) AS n FROM leaves)""",
            "a0 AS (SELECT g, r, n, leaf AS h FROM ranked)"]

    def grow(a: str) -> None:
        for k in range(levels):
            ctes.append(f"{a}r{k} AS (SELECT g, r // 8 AS r, any_value(n) AS n, list(h ORDER BY r) AS run FROM {a}{k} GROUP BY g, r // 8)")
            ctes.append(f"{a}{k + 1} AS (SELECT g, r, (n + 7) // 8 AS n, CASE WHEN n > 1 THEN sha256(array_to_string(run, '')) ELSE run[1] END AS h FROM {a}r{k})")
    grow("a")
    ctes.append(f"subs AS (SELECT g, h, row_number() OVER (ORDER BY g) - 1 AS r, count(*) OVER () AS n FROM a{levels})")
    ctes.append("b0 AS (SELECT 0 AS g, r, n, h FROM subs)")
    grow("b")

    def path(a: str, base: str, keep: str) -> None:
        """Adds the runs above each row of ``base`` (g0, r), from the lowest."""
        for k in range(levels):
            before = base if k == 0 else f"{a}p{k - 1}"
            ctes.append(f"{a}p{k} AS (SELECT p.*, x.run AS {a}run{k}, x.n AS {a}n{k} FROM {before} p JOIN {a}r{k} x ON x.g = p.{keep} AND x.r = p.r{a} // {8 ** (k + 1)})")

    def sides(a: str, k: int) -> tuple[str, str]:
        at = f"CAST(r{a} // {8 ** k} % 8 AS BIGINT)"
        return (f"array_to_string({a}run{k}[1:{at}], '')", f"array_to_string({a}run{k}[{at} + 2:], '')")
    ctes.append(f"rows AS (SELECT q.doc_id, q.leaf, q.claim, q.g AS ga, 0 AS gb, q.r AS ra, s.r AS rb, s.h AS subroot, t.h AS root FROM ranked q JOIN subs s ON s.g = q.g CROSS JOIN b{levels} t)")
    path("a", "rows", "ga")
    path("b", f"ap{levels - 1}", "gb")
    steps = [(a, k) for a in "ab" for k in range(levels)]
    proof = " || ".join(f"CASE WHEN {a}n{k} > 1 THEN {sides(a, k)[0]} || {sides(a, k)[1]} ELSE '' END" for a, k in steps)
    last = f"bp{levels - 1}"
    for i, (a, k) in enumerate(steps):
        left, right = sides(a, k)
        was = "coalesce(claim, leaf)" if i == 0 else "f"
        drop = "" if i == 0 else " EXCLUDE (f)"
        ctes.append(f"f{i} AS (SELECT *{drop}, CASE WHEN {a}n{k} > 1 THEN sha256({left} || {was} || {right}) ELSE {was} END AS f FROM {last if i == 0 else f'f{i - 1}'})")
    return "WITH " + ",\n".join(ctes) + f"""
SELECT doc_id, leaf, subroot, root, sha256({proof}) AS proof_sha256, f AS folded_root, f = root AS verified FROM f{len(steps) - 1}"""
