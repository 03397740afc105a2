"""Line dedup, Merkle manifest and lexical search against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from roadpulse.llm import lexical_search, line_dedup, merkle

BLANKS = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def last(doc):
    return (doc is None, doc)


# Line dedup

def kept_lines(rows, least=10):
    """(doc_id, number of lines, number dropped, kept text) per row."""
    first, holders = {}, defaultdict(set)
    split = [(doc, (text or "").split("\n")) for doc, text in rows]
    key = lambda line: line.strip(BLANKS).translate(LOWER)
    for doc, lines in split:
        for k in map(key, lines):
            if len(k) >= least:
                first[k] = min(first.get(k, doc), doc, key=last)
                holders[k].add(doc)
    out = []
    for doc, lines in split:
        kept = [x for x in lines if len(holders[key(x)]) < 2 or first[key(x)] == doc]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def lined(seed, n=60):
    rng = random.Random(seed)
    pool = [f"Line number {i} of the pool" for i in range(40)] + ["short", "", "ninechars", "ten chars!", "É" * 10]
    decorate = lambda s: rng.choice(["", " ", "\t\x0b"]) + rng.choice([s, s.upper(), s]) + rng.choice(["", "\r", "  "])
    return [(i, "\n".join(decorate(rng.choice(pool + [f"own line {i} {j}"])) for j in range(rng.choice([1, 3, 70, 200])))) for i in range(n)]


def report(df):
    return Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in line_dedup.dedup_report(df).collect())


def expected(rows):
    return Counter((d, n, g, sha(t)) for d, n, g, t in kept_lines(rows))


def test_lines_equal_brute_force(docs_of):
    rows = lined(1)
    assert report(docs_of(rows)) == expected(rows)


def test_a_line_of_most_documents_is_hot(docs_of, spark):
    rows = [(i, f"the line that all documents hold\nmine alone is number {i}") for i in range(300)] + lined(2, 5)
    lines = line_dedup.line_hashes(docs_of(rows))
    assert len(line_dedup.hot_keys(lines, 8)) == 1
    assert report(docs_of(rows)) == expected(rows)


def test_line_cases(docs_of, edges):
    rows = [*edges, (None, "a line that two documents hold"), (20, "A line that two documents hold "), (21, "\n\n"),
            (22, "one here\ntwice in one text\ntwice in one text"), (23, "a\x00b nul in a line\n x"), (24, "A\x00b nul in a line"),
            (25, "one id, several texts"), (25, "one id, several texts\nmore"), (26, "one id, several texts"),
            (27, "\n".join(["a line that two documents hold"] * 20_000 + ["end of it"]))]
    df = docs_of(rows, clash=True)
    assert report(df) == expected(rows)
    assert line_dedup.dedup_report(docs_of([])).collect() == []
    left = line_dedup.dedup_lines(df)
    assert left.columns == df.columns
    assert Counter((r.doc_id, r.text or "") for r in left.collect()) == Counter((d, t) for d, _, _, t in kept_lines(rows))


def test_bitmaps_hold_only_words_with_gaps(docs_of):
    rows = [(1, "a shared line of text"), (2, "\n".join([f"unique line {i}" for i in range(640)] + ["a shared line of text"]))]
    maps = line_dedup.keep_bitmaps(docs_of(rows)).collect()
    assert [(r.doc_id, [(w.word, w.bits) for w in r.keep]) for r in maps] == [(2, [(10, ~1)])]


# Merkle manifest

def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def brute_manifest(rows):
    """Rows of the report from (doc_id, source, lang, n_chars, text)."""
    def leaf(r, change=False):
        *rest, text = r
        return sha("".join(map(field, [*rest, text.translate(LOWER) if change and text is not None else text])))

    def tree(nodes):
        """Root, and the siblings of each node (left, right), level by level."""
        paths, places = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for i, p in enumerate(places):
                run = nodes[p // 8 * 8:p // 8 * 8 + 8]
                paths[i].append(("".join(run[:p % 8]), "".join(run[p % 8 + 1:])))
            nodes = [sha("".join(nodes[i:i + 8])) for i in range(0, len(nodes), 8)]
            places = [p // 8 for p in places]
        return nodes[0], paths

    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0], leaf(r)))
        trees[g] = tree([leaf(r) for r in groups[g]])
    root, above = tree([trees[g][0] for g in names]) if names else (None, [])
    out = []
    for g, up in zip(names, above):
        for r, path in zip(groups[g], trees[g][1]):
            path = path + up
            node = leaf(r, r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0)
            for a, b in path:
                node = sha(a + node + b)
            out.append((r[0], leaf(r), trees[g][0], root, sha("".join(a + b for a, b in path)), node, node == root))
    return Counter(out)


MANIFEST = "doc_id long, source string, lang string, n_chars long, text string"


def manifest(spark, rows, schema=MANIFEST):
    df = spark.createDataFrame([(*r, *["x"] * (schema.count(",") - 4)) for r in rows], schema)
    cols = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return Counter(tuple(r[c] for c in cols) for r in merkle.manifest_report(df).collect())


@pytest.mark.parametrize("sizes", [[1], [8], [9], [3, 64, 65], [513, 1], [1500, 7, 600]])
def test_manifest_equals_brute_force(spark, sizes):
    rng = random.Random(sum(sizes))
    rows = [(i * 7 + g, rng.choice("ab"), f"l{g}", i, f"Text {i} É") for g, n in enumerate(sizes) for i in range(n)]
    rng.shuffle(rows)
    assert manifest(spark, rows) == brute_manifest(rows)


def test_manifest_of_many_groups(spark):
    rows = [(i, "s", f"{i % 700:03}", 1, "A") for i in range(1400)]
    assert manifest(spark, rows) == brute_manifest(rows)


def test_manifest_cases(spark):
    rows = [(1, None, None, None, None), (None, "s", "en", 3, "abc"), (2, "", "", 0, ""), (3, "S", "en", 9, "X" * 60_000),
            (3, "S", "en", 9, "same id"), *[(4, "S", "é", 4, "COPY")] * 20, (5, "a:b", "é", -1, "1:-"), (6, "s", "z", 2, "Up")]
    got = manifest(spark, rows, MANIFEST + ", grp string, rank string, leaf string, path string, tie string")
    assert got == brute_manifest(rows)
    assert manifest(spark, []) == Counter()


def test_a_changed_row_is_found(spark):
    rows = [(i, "s", "en", 1, f"Text {i}") for i in range(30)]
    df = spark.createDataFrame(rows, MANIFEST)
    proofs = merkle.build(df).proofs().cache()
    root = proofs.first()["root"]
    by_key = {r.leaf.key: r.path for r in proofs.collect()}
    assert all(sha("") != root for _ in [0]) and len(by_key) == 30
    folded = proofs.select(merkle.fold(F.col("leaf.digest"), F.col("path")).alias("r"), merkle.fold(F.lit(sha("x")), F.col("path")).alias("w"))
    assert {(r.r, r.w == root) for r in folded.collect()} == {(root, False)}
    proofs.unpersist()


# Lexical search

def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_search(docs, items, k):
    held = [(d, Counter(words(t))) for d, t in docs if words(t)]
    n_docs, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(w for _, c in held for w in c)
    queries = defaultdict(set)
    for i, t in items:
        queries[i] |= set(words(t))
    out = []
    for i, q in queries.items():
        found = []
        for d, c in held:
            m = 50 + 50 * sum(c.values()) * n_docs // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 20 * m))
                        for w in q if w in c)
            if score > 0:
                found.append((-score, d is None, d))
        out += [(i, rank, d, -s) for rank, (s, _, d) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=str)


def searched(spark, docs, items, k=5):
    d = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, score string")
    q = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, node string")
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in lexical_search.search(d, q, k).collect()), key=str)


def some_texts(rng, n, longest):
    pool = ["the"] * 8 + ["of"] * 4 + [f"w{i}" for i in range(60)] + ["Zoë", "日本", "x-y", "A1"]
    return [(i, " ".join(rng.choice(pool) for _ in range(rng.randrange(longest)))) for i in range(n)]


@pytest.mark.parametrize("limit", [200_000, 40])
def test_search_equals_brute_force(spark, monkeypatch, limit):
    rng = random.Random(limit)
    docs, items = some_texts(rng, 150, 60), some_texts(rng, 25, 14)
    monkeypatch.setattr(lexical_search.in_blocks, "__defaults__", (limit,))
    monkeypatch.setattr(lexical_search, "CELLS", 500)
    assert searched(spark, docs, items) == brute_search(docs, items, 5)


def test_search_cases(spark, edges):
    docs = [*edges, *[(50, "tie here")] * 7, (49, "tie here"), (None, "tie here"), (51, "... ,;"), (52, "TIE\x00here")]
    items = [(1, "Here, tie!"), (1, "word"), (2, None), (3, ""), (4, "absent"), (None, "word x"), (5, "tie tie tie"), (5, "tie")]
    assert searched(spark, docs, items) == brute_search(docs, items, 5)
    assert searched(spark, [], items) == [] == searched(spark, docs, [])


def test_shared_prefixes_are_nodes_once(spark):
    items = spark.createDataFrame([(i, "common words of all" + (" and of half" if i % 2 else "") + f" own{i}") for i in range(10)],
                                  "item_id long, text string")
    pairs, blocks = lexical_search.in_blocks(lexical_search.item_pairs(items))
    classes = lexical_search.term_classes(pairs)
    nodes, ends = lexical_search.query_dag(pairs, classes)
    assert blocks == 1 and classes.select("class").distinct().count() == 12
    # One class of four terms, one of two, and one a own term: a node for each.
    assert nodes.count() == 12 and ends.count() == 10
