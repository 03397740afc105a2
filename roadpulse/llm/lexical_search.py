"""Ranked lexical search of many items at once, sharing what the items share.

The score of a document for an item is a sum over the item's terms, so any
common part of two items is worth one accumulator a document:

1. Terms that occur in exactly the same items form one class (mined by
   grouping terms by their sorted lists of items).
2. Every item is its classes, those of most items first. Items that begin
   alike share the prefixes: a prefix is a node of the query-sharing DAG, its
   accumulator that of its parent plus that of one class. An item's score is
   its last node's accumulator.

One pass over the texts stores each document's length and frequencies of the
items' terms; corpus counts come from that table. A second pass, over the table
alone, computes for a batch of documents the class accumulators, then the
nodes, depth by depth, each once, and keeps the best k of each item in its task.

Items are taken in blocks of a checked size, whose terms and DAG are broadcast;
each block is held against all documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut
from .line_dedup import LOWER, UPPER

#: (item, term) pairs of a block; a block of one item may have more.
BLOCK_PAIRS = 200_000
#: Cells of the accumulators that a task holds at a time, and rows of a first-level top list.
CELLS, SALTS = 2_000_000, 64

#: ASCII letters and digits and all bytes above ASCII are parts of terms, others split; A-Z become a-z.
_SPLIT = bytes(x + 32 if 65 <= x <= 90 else x if x >= 128 or 48 <= x <= 57 or 97 <= x <= 122 else 32 for x in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return (text or b"").translate(_SPLIT).split()


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [sorted(set(terms(t.as_py()))) for t in b.column("text")]
        yield pa.RecordBatch.from_arrays([b.column("item_id"), pa.array(found, pa.list_(pa.binary()))], names=["item_id", "terms"])


def item_pairs(items: DataFrame) -> DataFrame:
    """(item_id, term), once each. Rows of one id are one item."""
    kind = items.schema["item_id"].dataType.simpleString()
    return (items.select("item_id", F.col("text").cast("binary").alias("text"))
            .mapInArrow(_item_terms, f"item_id {kind}, terms array<binary>")
            .select("item_id", F.explode("terms").alias("term")).distinct())


def in_blocks(pairs: DataFrame, limit: int = BLOCK_PAIRS) -> tuple[DataFrame, int]:
    """``pairs`` with ``block``, and the number of blocks: as many as it takes
    until none of several items has more than ``limit`` pairs."""
    blocks = max(1, -(-pairs.count() // limit))
    while True:
        dealt = pairs.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int"))
        sizes = dealt.groupBy("block", "item_id").count().groupBy("block").agg(F.sum("count").alias("n"), F.count(F.lit(1)).alias("items"))
        if sizes.where((F.col("n") > limit) & (F.col("items") > 1)).isEmpty():
            return dealt, blocks
        blocks *= 2


def term_classes(pairs: DataFrame) -> DataFrame:
    """(block, term, class, items): the class of each term, that is a digest of
    the list of its items, and how many items have it."""
    listed = pairs.groupBy("block", "term").agg(F.sort_array(F.collect_list(
        F.coalesce(F.md5(F.col("item_id").cast("string").cast("binary")), F.lit("-")))).alias("items"))
    return listed.select("block", "term", F.sha2(F.array_join("items", ","), 256).alias("class"), F.size("items").alias("items"))


def query_dag(pairs: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (block, node, parent, class, depth), each once, and items (block,
    item_id, node). A node is a digest of a prefix of classes, those of most
    items first; the parent of depth 1 is null."""
    of_item = (pairs.join(classes, ["block", "term"]).select("block", "item_id", "class", "items").distinct()
               .groupBy("block", "item_id")
               .agg(F.sort_array(F.collect_list(F.struct((-F.col("items")).alias("order"), "class"))).alias("chain")))
    prefix = F.aggregate(
        "chain", F.array().cast("array<string>"),
        lambda made, c: F.concat(made, F.array(F.sha2(F.concat(F.coalesce(F.try_element_at(made, F.lit(-1)), F.lit("")), c["class"]), 256))))
    chains = of_item.select("block", "item_id", "chain", prefix.alias("nodes"))
    at = chains.select("block", "nodes", F.posexplode("chain").alias("no", "c"))
    nodes = at.select("block", F.col("nodes")[F.col("no")].alias("node"), F.get("nodes", F.col("no") - 1).alias("parent"),
                      F.col("c.class").alias("class"), (F.col("no") + 1).alias("depth")).distinct()
    return nodes, chains.select("block", "item_id", F.element_at("nodes", -1).alias("node"))


def frequencies(docs: DataFrame, known: Broadcast) -> DataFrame:
    """(doc_id, n, at, tf) per row of ``docs`` with a term: its number of terms
    and, of the known terms (term -> number), which it holds how often."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value
        for b in batches:
            n, at, tf, rows = [], [], [], []
            for i, t in enumerate(b.column("text")):
                words = terms(t.as_py())
                if words:
                    counts = Counter(words)
                    held = number.keys() & counts.keys()
                    rows.append(i)
                    n.append(len(words))
                    at.append([number[w] for w in held])
                    tf.append([counts[w] for w in held])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(n, pa.int64()), pa.array(at, pa.list_(pa.int32())),
                 pa.array(tf, pa.list_(pa.int64()))], names=["doc_id", "n", "at", "tf"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(
        run, "doc_id long, n long, at array<int>, tf array<long>")


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Plan:
    """A block's DAG as arrays, nodes by depth: what a task evaluates."""

    def __init__(self, nodes: list, items: list, class_of: list[int], weights: list[int], n_docs: int, length: int):
        self.class_of, self.weights = np.array(class_of, np.int64), np.array(weights, np.int64)
        self.n_docs, self.length = n_docs, length
        number: dict[str, int] = {}
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        for depth in range(1, max((x[3] for x in nodes), default=0) + 1):
            level = [x for x in nodes if x[3] == depth]
            self.levels.append((np.array([number.get(x[1], 0) for x in level], np.int64), np.array([x[2] for x in level], np.int64)))
            number |= {x[0]: i for i, x in enumerate(level)}
        depth_of = {x[0]: x[3] for x in nodes}
        #: Per depth: the items that end there, and their nodes' places.
        ends = [[(i, number[n]) for i, n in enumerate(items) if depth_of[n] == d + 1] for d in range(len(self.levels))]
        self.ends = [(np.array([e[0] for e in x], np.int64), np.array([e[1] for e in x], np.int64)) for x in ends]
        self.n_items, self.n_classes = len(items), 1 + max(class_of, default=-1)
        self.width = max([self.n_classes, self.n_items, *(len(x[0]) for x in self.levels)])

    def scores(self, n: np.ndarray, sizes: np.ndarray, at: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """Documents x items: ``at`` and ``tf`` hold ``sizes`` entries a document."""
        m = np.array([50 + 50 * int(x) * self.n_docs // self.length for x in n], np.int64)
        doc = np.repeat(np.arange(len(n)), sizes)
        part = self.weights[at] * (1_000_000_000 * tf // (1000 * tf + 20 * m[doc]))
        classes = np.zeros((self.n_classes, len(n)), np.int64)
        np.add.at(classes, (self.class_of[at], doc), part)
        out = np.zeros((self.n_items, len(n)), np.int64)
        made = np.zeros((1, len(n)), np.int64)
        for (parents, own), (items, places) in zip(self.levels, self.ends):
            made = made[parents] + classes[own]
            out[items] = made[places]
        return out


class Best:
    """The ``k`` best documents of each item: score, then id (null last)."""

    def __init__(self, n_items: int, k: int):
        self.k, self.least, self.held = k, np.ones(n_items, np.int64), []
        self.size = 0

    def add(self, ids: np.ndarray, none: np.ndarray, scores: np.ndarray) -> None:
        item, doc = np.nonzero(scores >= self.least[:, None])
        self.held.append((item, scores[item, doc], none[doc], ids[doc]))
        self.size += len(item)
        if self.size > 4 * self.k * len(self.least):
            self.trim()

    def trim(self) -> tuple[np.ndarray, ...]:
        item, score, none, ids = (np.concatenate(x) for x in zip(*self.held)) if self.held else [np.zeros(0, np.int64)] * 4
        order = np.lexsort((ids, none, -score, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        order = order[place < self.k]
        last = place == self.k - 1
        item_of_last = item[last]
        kept = tuple(np.concatenate(x)[order] for x in zip(*self.held)) if self.held else (item, score, none, ids)
        if len(item_of_last):
            # Equal scores stay candidates: a smaller id may follow.
            self.least[item_of_last] = kept[1][place[place < self.k] == self.k - 1]
        self.held, self.size = [kept], len(order)
        return kept


def scored(table: DataFrame, plan: Broadcast, k: int) -> DataFrame:
    """(item, doc_id, score): each task's best ``k`` documents of each item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = plan.value
        best = Best(p.n_items, k)
        step = max(1, CELLS // p.width)
        for b in batches:
            for start in range(0, b.num_rows, step):
                s = b.slice(start, step)
                ids = s.column("doc_id")
                none = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
                at, tf = s.column("at").flatten().to_numpy().astype(np.int64), s.column("tf").flatten().to_numpy()
                sizes = s.column("at").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                best.add(ids.fill_null(0).to_numpy(), none, p.scores(s.column("n").to_numpy(), sizes, at, tf))
        item, score, none, ids = best.trim()
        for start in range(0, len(item), 100_000):
            part = slice(start, start + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(item[part].astype(np.int32)), pa.array(ids[part], mask=none[part] == 1),
                                              pa.array(score[part])], names=["item", "doc_id", "score"])

    return table.mapInArrow(run, "item int, doc_id long, score long")


def _top(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    best = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _block_search(docs: DataFrame, pairs: DataFrame, block: int, k: int) -> DataFrame:
    spark = docs.sparkSession
    pairs = pairs.where(F.col("block") == block)
    classes = cut(term_classes(pairs), "lexical-classes")
    nodes, ends = query_dag(pairs, classes)
    # At most BLOCK_PAIRS rows each (or those of one item).
    known = classes.select("term", "class").orderBy("term").collect()
    number = {bytes(r["term"]): i for i, r in enumerate(known)}
    class_no = {c: i for i, c in enumerate(sorted({r["class"] for r in known}))}
    nodes = [(r["node"], r["parent"], class_no[r["class"]], r["depth"]) for r in nodes.collect()]
    ends = ends.collect()
    words = spark.sparkContext.broadcast(number)
    table = cut(frequencies(docs, words), "lexical-frequencies")
    n_docs, length = table.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = dict(table.select(F.explode("at").alias("at")).groupBy("at").count().collect())
    weights = [weight(n_docs, df.get(i, 0)) for i in range(len(known))]
    plan = spark.sparkContext.broadcast(Plan(nodes, [r["node"] for r in ends], [class_no[r["class"]] for r in known], weights, n_docs, length))
    each = scored(table, plan, k).withColumn("salt", F.spark_partition_id() % SALTS)
    ids = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(ends)], f"item int, item_id {pairs.schema['item_id'].dataType.simpleString()}")
    top = _top(_top(each, ["item", "salt"], k).drop("rank"), ["item"], k)
    return top.join(F.broadcast(ids), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` best rows of ``docs``
    with a score above 0, ranked from 1, equal scores by ascending doc_id (null last).

    Terms are maximal runs of ASCII letters, digits and characters above ASCII,
    A-Z in lower case. With N documents that have a term, L terms in all, n of
    one document, df documents holding a term and tf its occurrences, a term
    weighs w = floor(1000 ln((2N+2)/(2df+1))) and adds w * (1000000000 tf div
    (1000 tf + 20 m)), m = 50 + 50 n N div L.

    Rows of one item_id are one item with the terms of all (null is an id as
    others); an item without terms has no rows. A null or empty text has no
    terms and isn't counted in N. Repeated documents each have a rank. No items
    or documents: no rows. Other columns are not read.
    """
    pairs, blocks = in_blocks(cut(item_pairs(items), "lexical-items"))
    found = [_block_search(docs, pairs, b, k) for b in range(blocks)]
    while len(found) > 1:
        found = [a.unionByName(b) if b is not None else a for a, b in zip(found[::2], [*found[1::2], None])]
    return found[0]


def oracle_sql(k: int = 50) -> str:
    found = (r"regexp_extract_all(translate({}, '" + f"{UPPER}', '{LOWER}'" + r"), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
    return f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {found.format('text')} AS t FROM documents),
s AS (SELECT count(*) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS length FROM d WHERE len(t) > 0),
i AS (SELECT DISTINCT item_id, unnest({found.format('text')}) AS term FROM benchmark),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM i) GROUP BY r, term),
f AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, s GROUP BY term),
m AS (SELECT r, doc_id, 50 + (50 * len(t) * n_docs) // length AS m FROM d, s),
x AS (SELECT item_id, r, any_value(doc_id) AS doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM i JOIN p USING (term) JOIN f USING (term) JOIN m USING (r) GROUP BY item_id, r)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM x WHERE score > 0)
WHERE rank <= {k}"""
