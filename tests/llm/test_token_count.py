import random
import time

import pytest
from tokenizers import Tokenizer

from roadpulse.llm.token_count import (DEFAULT_VOCABULARY, counter_for, token_counts, vocabulary_path)

TEXTS = ["", " ", "  a  b ", "don't we'll 're 's", "x<|endoftext|>y  <|endoftext|>", "<|endo", "naïve café 123,456.7 \n\n\t x",
         "日本語 текст", "՘a ꟎1", "-" * 300, "aaaa" * 50, "🙂👍🏽 ok", "\x1c y　 z", "The quick brown fox's  tail"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_path(DEFAULT_VOCABULARY))


@pytest.mark.parametrize("text", TEXTS)
def test_every_prefix_counts_as_the_library(library, text):
    table = counter_for(vocabulary_path(DEFAULT_VOCABULARY)).table(text)
    for n in range(len(text) + 1):
        assert table.at(n) == len(library.encode(text[:n], add_special_tokens=False).ids)


def test_fit_is_within_the_budget(library):
    text = "some words of   text, and more: don't stop " * 20
    table = counter_for(vocabulary_path(DEFAULT_VOCABULARY)).table(text)
    for budget in (0, 1, 7, 50, 10_000):
        chars = table.fit(budget)
        assert table.at(chars) <= budget
        assert chars == len(text) or table.at(chars + 1) > budget or budget == 0


def test_fit_on_random_texts(library):
    rng = random.Random(4)
    parts = ["a", " ", "  ", "\n", "'ll", "'", "re", "word", " word", "123", "!!", "<|endoftext|>", "<|", "é", "日", "\x1c", " \t", "…"]
    counter = counter_for(vocabulary_path(DEFAULT_VOCABULARY))
    for _ in range(300):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 14)))
        counts = [len(library.encode(text[:n], add_special_tokens=False).ids) for n in range(len(text) + 1)]
        table = counter.table(text)
        assert [table.at(n) for n in range(len(text) + 1)] == counts, repr(text)
        for budget in range(counts[-1] + 1):
            chars = table.fit(budget)
            j = max(i for i, c in enumerate(table.counts) if c <= budget)
            until = table.ends[j + 1] if j < len(table.words) else len(text) + 1
            assert chars == max(n for n in range(until) if counts[n] <= budget and n >= table.ends[max(0, j - 1)])


@pytest.mark.parametrize("text", ["x" * 300_000, " " * 1_000_000, "日" * 100_000, "a" + " " * 200_000 + "b" * 200_000, "-" * 60_000 + "<|endoftext|>"])
def test_long_words_take_linear_time(text):  # a cut special string counts the word before it again, at most 12 times
    table = counter_for(vocabulary_path(DEFAULT_VOCABULARY)).table(text)
    began = time.monotonic()
    for budget in (1, table.total // 2, table.total - 1):
        chars = table.fit(budget)
        assert table.at(chars) <= budget
    assert time.monotonic() - began < 30


def test_column_cases(spark, docs_of, edges, library):
    got = token_counts(docs_of(edges, clash=True), budget=100).collect()
    assert len(got) == len(edges)
    want = sorted((i is None, i or 0, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids))
                  for i, t in edges)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 100) for r in got)
    assert token_counts(docs_of([])).collect() == []
