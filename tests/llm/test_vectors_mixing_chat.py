import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadpulse.llm import chat_format, mixing, sentence_pieces, vector_search
from roadpulse.llm.vector_search import hadamard, nearest

from .conftest import SF


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_recall_and_scores(spark):
    data = spark.read.parquet(SF + "/embeddings.parquet")
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in data.collect()]
    got = defaultdict(list)
    for r in nearest(data, data.where("vec_id % 20 = 0")).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    hits = wanted = 0
    for q, v in rows:
        if q % 20 == 0:
            score = sorted((-float((v * x).sum()), i) for i, x in rows if i != q)[:20]
            hits += len({i for _, i in score} & {i for _, i, _ in got[q]})
            wanted += len(score)
            assert [k for k, *_ in got[q]] == list(range(1, len(score) + 1))
            assert [(-s, i) for _, i, s in got[q]] == sorted((-s, i) for _, i, s in got[q])
            exact = {i: float((v * x).sum()) for i, x in rows}
            assert all(math.isclose(s, exact[i], rel_tol=1e-12) for _, i, s in got[q])
    assert hits >= 0.9 * wanted


@pytest.mark.parametrize("long", [1, 40])
def test_recall_with_mixed_norms(spark, long):
    """Long vectors do not cost the others, nor themselves, their recall."""
    rng = np.random.default_rng(long)
    x = rng.normal(size=(6_000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[3_000:] *= rng.uniform(0.5, 1.0, size=(3_000, 1))
    x[-long:] *= 10.0 / np.linalg.norm(x[-long:], axis=1)[:, None]
    df = vectors(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)]).select(
        "vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    got = defaultdict(set)
    for r in nearest(df, df.where("vec_id % 40 = 0")).collect():
        got[r.query_id].add(r.vec_id)
    x = x.astype(np.float32).astype(float)
    hits = 0
    for q in range(0, len(x), 40):
        score = x @ x[q]
        score[q] = -np.inf
        hits += len(got[q] & set(np.argsort(-score)[:20].tolist()))
    assert hits >= 0.9 * 20 * len(range(0, len(x), 40))


def test_vector_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (20, [3.0, 4.0], 1), (1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [nan, 1.0], 1),
            (5, [inf, 1.0], 1), (6, [None, 1.0], 1), (None, [1.0, 1.0], 1), (7, [1.0, 2.0, 3.0], 1), (8, [2.0, 0.0], None),
            (9, [2.0, 0.0], None), (9, [2.0, 0.0], None), (40, None, 1), (60, [0.0, 0.0], 1)]
    df = vectors(spark, rows).withColumn("id", F.lit("x")).withColumn("codes", F.lit(1))
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in nearest(df, df.where("vec_id % 20 = 0"), k=3).collect()}
    assert got == {(0, 1): (20, 3.0), (0, 2): (8, 2.0), (0, 3): (9, 2.0), (20, 1): (8, 6.0), (20, 2): (9, 6.0), (20, 3): (0, 3.0)}
    assert nearest(df.limit(0), df.limit(0)).collect() == []


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 64))
    assert np.allclose(np.linalg.norm(hadamard(x), axis=1), np.linalg.norm(x, axis=1))


def test_mixture_follows_the_weights(spark):
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.lit("ten chars.").alias("text"), F.lit("en").alias("lang"),
                                      F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, "b").alias("source"))
    got = Counter(r.source for r in mixing.mix_sources(docs, {"hot": 1.0, "b": 3.0}).select("source").collect())
    assert got[None] == 0 and abs(got["hot"] - 7_500) < 400 and abs(got["b"] - 22_500) < 600
    again = mixing.mix_sources(docs, {"hot": 40.0}, epochs=2.0)
    counts = Counter(r.doc_id for r in again.select("doc_id").collect())
    mean = sum(counts.values()) / 10_000
    spread = sum((counts.get(i, 0) - mean) ** 2 for i in range(0, 30_000, 3)) / 10_000
    assert abs(mean - 6.0) < 0.15 and abs(spread - mean) < 0.4
    keys = [r.shuffle_key for r in again.select("shuffle_key").collect()]
    assert keys == sorted(keys)


def test_large_means_are_sums_of_parts(spark):
    docs = spark.createDataFrame([(i, "x" * (1000 if i else 1), "a" if i else "b") for i in range(50)], "doc_id long, text string, source string")
    n = mixing.mix_sources(docs, {"b": 1.0}).count()
    assert abs(n - 49_001) < 6 * 49_001 ** 0.5


def test_mixture_cases(docs_of, edges):
    got = mixing.mix_sources(docs_of(edges, clash=True), epochs=3.0)
    assert set(got.columns) == set(docs_of([], clash=True).columns) and dict(got.dtypes)["copy"] == "bigint"
    counts = Counter((r.doc_id, r.text) for r in got.collect())
    assert counts[3, "same text twice " * 20] % 2 == 0
    assert mixing.mix_sources(docs_of([])).collect() == []
    assert mixing.mix_sources(docs_of([(1, None), (2, "")]), epochs=1.0).columns[-2:] == ["copy", "shuffle_key"]


@pytest.mark.parametrize("text", ["", "\\", "</s>", "<\\/s>", "[INST] ok [/INST]", "<<SYS>> <</SYS>>\\\\[TEXT]", "<s>" * 3, "a<", "[/INST", "<</SYS>"])
def test_chat_codec_round_trip(text):
    codec = chat_format.Codec()
    for role in ("system", "user", "assistant", "", "tool[/ROLE]", "[TEXT]"):
        written = "".join(p for p, _ in codec.segments(role, text))
        assert codec.read_turn(written + "[INST]next") == (role, text, len(written))
        assert not any(m in codec.escape(text) for m in codec.t.marks())


def test_chat_cases(spark):
    rng = random.Random(2)
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (None, 0, None, "lost"), (2, 0, "assistant", "first"),
            (2, 0, "assistant", "first"), (3, None, "user", "x"), (3, 0, "assistant", "y" * 200_000), (4, 1, "bot", "</s>")]
    rows += [(5, i, ("user", "assistant")[i % 2], f"turn {i} {rng.random()}") for i in range(9_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("seq", F.lit(1))
    segments = chat_format.format_chats(df.repartition(4))
    direct = {r.conv_id: r for r in chat_format.read_back(segments, sorted_by_seq=True).collect()}
    assert {r.conv_id: r for r in chat_format.read_back(segments).collect()} == direct
    assert {k: (r.n_turns, r.n_bad_turns, r.complete) for k, r in direct.items()} == {
        1: (2, 0, True), None: (1, 1, False), 2: (2, 2, True), 3: (2, 0, True), 4: (1, 1, False), 5: (9_000, 0, True)}
    assert direct[3].loss_chars == 200_000 and direct[1].loss_chars == 0
    assert chat_format.read_back(chat_format.format_chats(df.limit(0)), sorted_by_seq=True).collect() == []


def best_path(word, pieces):
    """Brute force over all segmentations (single characters may be unknown)."""
    found = []

    def walk(at, score, ids, starts):
        if at == len(word):
            found.append((score, -len(starts), tuple(reversed(starts)), ids))
            return
        for end in range(at + 1, min(len(word), at + pieces.longest) + 1):
            if word[at:end] in pieces.plain:
                i, s = pieces.plain[word[at:end]]
                walk(end, score + s, [*ids, i], [*starts, at])
            elif end == at + 1:
                walk(end, score + pieces.unknown, [*ids, *(pieces.byte_ids[b] for b in word[at].encode())], [*starts, at])
    walk(0, 0.0, [], [])
    return max(found)[3]


def test_word_viterbi_equals_brute_force():
    pieces = sentence_pieces.Pieces.read(sentence_pieces.model_path(sentence_pieces.DEFAULT_MODEL))
    encoder = sentence_pieces.WordEncoder(pieces)
    for word in [" the", "reading", " 2024", "über", "▁x", "日本", "  a", "\n\n", " antion", "ththeat"]:
        assert encoder.ids(word) == best_path(word, pieces)


def test_dictionary_equals_the_word_recurrence(spark):
    pieces = sentence_pieces.Pieces.read(sentence_pieces.model_path(sentence_pieces.DEFAULT_MODEL))
    encoder = sentence_pieces.WordEncoder(pieces)
    docs = spark.read.parquet(SF + "/documents.parquet").limit(40)
    rows = [r for r in sentence_pieces.dictionary(spark, docs, pieces).collect() if r.ids is not None]
    assert len(rows) > 500 and all(list(r.ids) == encoder.ids(r.word) for r in rows)


def test_pieces_cases(docs_of, edges):
    for most in (1, 1 << 19):
        encoded = sentence_pieces.encode(docs_of(edges, clash=True), most=most)
        got = Counter((r.doc_id, r.text) for r in sentence_pieces.decode(encoded).collect())
        assert got == Counter((i, t or "") for i, t in edges)
    assert sentence_pieces.encode_report(docs_of([])).collect() == []


def recall(spark, rows, queries, k=20):
    """Of ``rows`` (n x d): the share of the true neighbours of the first ``queries`` that are found."""
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    found = {}
    for r in vector_search.nearest(df, df.where(F.col("vec_id") < queries), k).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    score = rows[:queries] @ rows.T
    score[np.arange(queries), np.arange(queries)] = -np.inf
    true = np.argsort(-score, axis=1, kind="stable")[:, :k]
    return np.mean([len(found[i] & set(t)) / k for i, t in enumerate(true.tolist())])


@pytest.mark.parametrize("dim, n, queries", [(16, 3000, 60), (64, 3000, 60), (256, 2000, 20), (768, 1500, 8)])
def test_recall_by_dimension(spark, dim, n, queries):
    rows = np.random.default_rng(dim).normal(size=(n, dim))
    assert recall(spark, rows / np.linalg.norm(rows, axis=1)[:, None], queries) >= 0.9


@pytest.mark.parametrize("long", [vector_search.FEW_VECTORS, vector_search.FEW_VECTORS + 1])
def test_recall_at_the_edge_of_whole_octaves(spark, long):
    rng = np.random.default_rng(long)
    rows = rng.normal(size=(4000, 64))
    rows /= np.linalg.norm(rows, axis=1)[:, None]
    rows[rng.permutation(4000)[:long]] *= 10
    assert recall(spark, rows, 60) >= 0.9
