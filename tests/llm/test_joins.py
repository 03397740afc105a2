"""N-gram join, components and license scan."""

import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from roadpulse.llm import license_scan, ngram_join
from roadpulse.llm.components import min_labels

from .conftest import SF


def shingles(text, k=5):
    w = (text or "").encode().lower().split()
    return set() if not w else {tuple(w)} if len(w) < k else {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def brute_force(rows, percent=75):
    """(number of shingles, component) per row; rows are documents of their own."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    where = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            where[g].append(i)
    common = Counter((a, b) for at in where.values() for n, a in enumerate(at) for b in at[n + 1:])
    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            root[find(a)] = find(b)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return Counter((doc, len(sets[i]), least.get(find(i))) for i, (doc, _) in enumerate(rows))


def result(df):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.ngram_jaccard_join(df).collect())


def near_copies(seed=3):
    rng = random.Random(seed)
    rows, doc = [], 0
    passage = [f"p{i}" for i in range(60)]
    for _ in range(6):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([8, 40, 150]))]
        for _ in range(rng.choice([1, 3, 25])):
            w = list(base)
            for _ in range(rng.randrange(4)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(10_000)}"
            rows.append((doc, " ".join(w + passage * rng.randrange(2))))
            doc += 1
    return rows


def test_join_equals_brute_force_on_near_copies(docs_of):
    rows = near_copies()
    assert result(docs_of(rows)) == brute_force(rows)


def test_rounds_and_remaining_pairs_agree(docs_of, monkeypatch):
    rows = near_copies(seed=5)
    monkeypatch.setattr(ngram_join, "FEW_PAIRS", 0)
    assert result(docs_of(rows)) == brute_force(rows)


def test_join_equals_brute_force_on_the_table(spark):
    docs = spark.read.parquet(SF + "/documents.parquet")
    assert result(docs) == brute_force([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_join_cases(docs_of, edges):
    rows = [*edges, (10, "a b c d"), (11, "A  B\tc d"), (12, "a b c d e"), (13, "one"), (14, "One")]
    assert result(docs_of(rows, clash=True)) == brute_force(rows)
    assert result(docs_of([])) == Counter()
    left = ngram_join.keep_one_each(docs_of(rows, clash=True))
    ids = sorted(r.doc_id for r in left.collect() if r.doc_id is not None)
    assert ids == [1, 2, 3, 4, 5, 6, 7, 10, 12, 13] and left.columns == docs_of([], clash=True).columns


def test_rows_that_share_only_an_id_stay(docs_of):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (2, "quite another text of its own"), (3, None), (4, "a b c d e f")]
    left = ngram_join.keep_one_each(docs_of(rows))
    assert sorted((r.doc_id, r.text or "") for r in left.collect()) == [(1, rows[0][1]), (2, rows[2][1]), (3, "")]


def odd_texts(seed=2):
    """Words around the edges of the eight-byte steps, all white space, and bytes that only look like some."""
    rng = random.Random(seed)
    letters = ["a", "B", "\u00e9", "\x00", "\u65e5", "\x1c", "\x85", "\xa0", " ", " ", "\t", "\n", "\x0b", "\x0c", "\r"]
    loose = ["".join(rng.choices(letters, k=rng.randrange(40))) for _ in range(400)]
    sizes = [1, 2, 7, 8, 9, 16, 17, 63, 64, 65, 130]
    words = [" " * (i % 2) + " ".join("".join(rng.choices("abA\x00", k=rng.choice(sizes))) for _ in range(rng.randrange(12)))
             for i in range(400)]
    return [None, "", " ", *loose, *words, *loose[:50]]


@pytest.mark.parametrize("slice_bytes", [1, 50, 1 << 19])
def test_token_sets_equal_shingle_sets(monkeypatch, slice_bytes):
    monkeypatch.setattr(ngram_join, "SLICE_BYTES", slice_bytes)
    texts = odd_texts()
    for k in (1, 3, 5):
        column = pa.array([b"left out"] + [None if t is None else t.encode() for t in texts], pa.binary())[1:]
        sets = list(ngram_join.Shingler(k).sets(column))
        expected = [frozenset(shingles(t, k)) for t in texts]
        assert [len(s) for s in sets] == [len(e) for e in expected]
        assert all((s[1:] > s[:-1]).all() for s in sets)
        named = {}
        assert all(named.setdefault(e, s.tobytes()) == s.tobytes() for e, s in zip(expected, sets))
        assert len(np.unique(np.concatenate(sets))) == len(set().union(*expected))
    assert list(ngram_join.Shingler().sets(pa.array([], pa.binary()))) == []


def test_token_sets_cost_a_few_splits():
    """Shingling takes the time of a few splits into words (nine with a Python step for every word)."""
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(5_000)]
    column = pa.array([" ".join(rng.choices(vocabulary, k=500)).encode() for _ in range(2_000)], pa.binary())

    def seconds(run):
        took = []
        for _ in range(3):
            before = time.process_time()
            run()
            took.append(time.process_time() - before)
        return min(took)
    split = seconds(lambda: [t.as_py().lower().split() for t in column])
    assert seconds(lambda: list(ngram_join.Shingler().sets(column))) < 5 * split


def test_condition_of_the_remaining_pairs_is_compiled(spark, tmp_dir):
    """Java interprets methods of over 8000 bytes for ever."""
    spark.createDataFrame([(1, 2, 3, 4, 5)], "token long, cid long, n int, pos int, comp long").write.parquet(tmp_dir + "/buckets")
    spark.createDataFrame([(2, [1] * ngram_join.MAP_WORDS)], "cid long, bits array<long>").write.parquet(tmp_dir + "/sets")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        pairs = ngram_join._remaining(spark.read.parquet(tmp_dir + "/buckets"), spark.read.parquet(tmp_dir + "/sets"), 75)
        code = spark._jvm.PythonSQLUtils.explainString(pairs._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert 0 < max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", code))) < 8000


def join_rows(df):
    """Rows that each join by token of a collected query has made, from the metrics of its plan."""
    def walk(node):
        found = [node.metrics().get("numOutputRows").get().value()] if "Join [token" in node.simpleString(100) else []
        children = node.children()
        return found + [x for i in range(children.size()) for x in walk(children.apply(i))]
    return walk(df._jdf.queryExecution().executedPlan())


def test_remaining_pair_is_made_once(spark, tmp_dir):
    """Not once for every token its classes share."""
    rng = random.Random(6)
    classes = [(rng.randrange(18, 24), rng.randrange(20)) for _ in range(40)]  # size, component
    # Each class has three of four tokens as its first; the map rules nothing out.
    rows = [(token, cid, n, pos, comp) for cid, (n, comp) in enumerate(classes)
            for pos, token in enumerate(sorted(rng.sample(range(4), 3)), 1)]
    spark.createDataFrame(rows, "token long, cid long, n int, pos int, comp long").write.parquet(tmp_dir + "/buckets")
    spark.createDataFrame([(cid, [-1] * ngram_join.MAP_WORDS) for cid in range(40)], "cid long, bits array<long>").write.parquet(tmp_dir + "/sets")
    expected = set()
    for token, x, xn, xpos, xc in rows:
        for other, y, yn, ypos, yc in rows:
            needed = -(-(xn + yn) * 75 // 175)
            if (token == other and x < y and xc != yc and 100 * min(xn, yn) >= 75 * max(xn, yn)
                    and xpos <= xn - needed + 1 and ypos <= yn - needed + 1):
                expected.add((x, y, xc, yc))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        pairs = ngram_join._remaining(spark.read.parquet(tmp_dir + "/buckets"), spark.read.parquet(tmp_dir + "/sets"), 75)
        found = Counter(map(tuple, pairs.collect()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert found == Counter(expected) and join_rows(pairs) == [len(expected)]


def test_remaining_pairs_alone_equal_brute_force(docs_of, monkeypatch):
    rows = near_copies(seed=7)
    monkeypatch.setattr(ngram_join, "ROUNDS", 0)
    assert result(docs_of(rows)) == brute_force(rows)


def test_later_rounds_pick_the_most_alike(spark, tmp_dir):
    """Most classes of a bucket just miss the threshold: after the first round each meets those its map has most in common with."""
    rows = [(1, cid, 20, 1, cid) for cid in range(12)]
    maps = [(cid, [((1 << 20) - 1) << 20 * (cid // 2 % 3) if i == cid // 6 else 0 for i in range(ngram_join.MAP_WORDS)])
            for cid in range(12)]
    spark.createDataFrame(rows, "token long, cid long, n int, pos int, comp long").write.parquet(tmp_dir + "/buckets")
    spark.createDataFrame(maps, "cid long, bits array<long>").write.parquet(tmp_dir + "/sets")
    pairs = ngram_join._some_pairs(spark.read.parquet(tmp_dir + "/buckets"), spark.read.parquet(tmp_dir + "/sets"), 1, 75)
    assert sorted(map(tuple, pairs.collect())) == [(x, x + 1, x, x + 1) for x in range(0, 12, 2)]


def test_components(spark):
    rng = random.Random(1)
    for edges in ([], [(5, 5)], [(i, i + 1) for i in range(300)], [(rng.randrange(200), rng.randrange(200)) for _ in range(150)]):
        root = {}

        def find(x):
            while root.setdefault(x, x) != x:
                x = root[x]
            return x
        for a, b in edges:
            if a != b:
                a, b = sorted((find(a), find(b)))
                root[b] = a
        got = {r.node: r.comp for r in min_labels(spark.createDataFrame(edges, "x long, y long")).collect()}
        assert got == {n: find(n) for n in root}


def test_components_of_short_chains(spark):
    """A node that hangs on two centres is not settled, even if no centre hangs on another."""
    rng = random.Random(7)
    chains = [[1, 4, 3, 5, 2]] + [rng.sample(range(1, n + 1), n) for n in (5, 8, 12)]
    for chain in chains:
        links = spark.createDataFrame([(min(p), max(p)) for p in zip(chain, chain[1:])], "x long, y long")
        got = sorted((r.node, r.comp) for r in min_labels(links).collect())
        assert got == [(n, 1) for n in sorted(chain)]


def test_licenses(docs_of, edges):
    filler = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do " * 3
    mit, gpl = license_scan.TEMPLATES[2][1], license_scan.TEMPLATES[4][1]
    long = license_scan.TEMPLATES[3][1]
    rows = [*edges, (20, filler + mit + ". " + filler), (21, (filler + gpl.upper() + "\n") * 3), (22, filler + long.replace("copy", "xx")),
            (23, "released under the old mit license"), (24, mit), (25, "x " * 40_000 + long + " y" * 40_000)]
    got = {(r.doc_id, r.license): round(r.containment, 3) for r in license_scan.scan_licenses(docs_of(rows, clash=True)).collect()}
    assert got[20, "mit"] == got[24, "mit"] == got[21, "gpl-3.0"] == got[25, "mit"] == 1.0
    assert 0.75 <= got[22, "mit"] < 1.0 and not any(d in (1, 2, 3, 4, 5, 23, None) for d, _ in got)
    assert license_scan.scan_licenses(docs_of([])).collect() == []
    assert license_scan.scan_licenses(docs_of(rows), templates=()).collect() == []


@pytest.mark.parametrize("words", [5, 6, 9, 10, 17, 30, 120])
def test_band_settings(words):
    s = license_scan.stride(words)
    for place in range(3 * s):
        assert any(k * s <= place and place + words <= k * s + 2 * s for k in (place // s, place // s - 1))
    assert 1 - (1 - license_scan.least_similarity(words)) ** license_scan.bands(words) >= license_scan.GUARANTEE


def test_each_license_and_its_near_misses(docs_of):
    """Every template is found in filler under its own license alone, or with
    others whose templates it holds whole; long texts are found by pieces."""
    filler = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor " * 3
    templates = license_scan.TEMPLATES
    long = " ".join(f"clause{i} of the long agreement between party{i % 97}" for i in range(600))
    rows = [(i, filler + text + ". " + filler) for i, (_, text) in enumerate(templates)] + [(900, filler + long)]
    found = {}
    for r in license_scan.scan_licenses(docs_of(rows), templates=(*templates, ("long", long))).collect():
        found.setdefault(r.doc_id, {})[r.license] = r.containment
    for i, (name, _) in enumerate(templates):
        assert found[i][name] == 1.0, (name, found.get(i))
        for kin in license_scan.FAMILIES.values():
            own = set(found[i]) & set(kin)
            assert not own or name not in kin or own == {name}, (name, own)
    assert found[900] == {"long": 1.0} and len(license_scan.in_pieces([("long", long)])) > 5
