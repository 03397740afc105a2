"""Each stage against a brute-force version of its step."""

import corpus_pipeline
from roadpulse.llm import sentence_pieces
from roadpulse.llm.secret_scan import spans

from .conftest import SF
from .test_joins import brute_force


def test_stages(spark):
    docs = spark.read.parquet(SF + "/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "secrets", "mixture", "pieces"]
    rows = {r.doc_id: r.text for r in docs.collect()}
    out = {}
    frame = docs
    for name, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, SF)
        out[name] = frame.collect()
        if name != "pieces":
            assert frame.columns == docs.columns
            frame = spark.createDataFrame(out[name], docs.schema)
    good = {r.doc_id: r.text for r in out["quality"]}
    assert good.items() <= rows.items() and 0.5 * len(rows) < len(good) < len(rows)
    groups = brute_force(list(good.items()))
    assert {r.doc_id for r in out["near_duplicates"]} == {d for d, _, c in groups if d == c}
    assert not any(spans(r.text) for r in out["secrets"]) and len(out["secrets"]) == len(out["near_duplicates"])
    clean = {r.doc_id: r.text for r in out["secrets"]}
    assert all(clean[r.doc_id] == r.text for r in out["mixture"])
    pieces = sentence_pieces.Pieces.read(sentence_pieces.model_path(sentence_pieces.DEFAULT_MODEL))
    mixed = sorted(r.doc_id for r in out["mixture"])
    assert sorted(r.doc_id for r in out["pieces"]) == mixed
    for r in out["pieces"]:
        assert b"".join(pieces.spelled[i] for i in r.ids)[1:].decode() == clean[r.doc_id] and r.n_pieces == len(r.ids)
