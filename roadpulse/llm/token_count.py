"""Token counts by prefix dynamic programming over a byte-level BPE vocabulary.

For each pre-token the table ``counts[i]`` holds the exact number of tokens of
its first ``i`` bytes. The last token of a prefix is the one token that ends
there and is compatible with the last token before it (two tokens are
compatible when the merges, applied to their joined bytes, give back the two),
so the table is filled left to right without encoding any prefix on its own.
Token counts of a text, of each of its prefixes and of the longest prefix
within a budget are then sums over these tables; the text is not encoded again.

Spark partitions the documents; a task keeps the tables of recent pre-tokens in
a bounded cache, so nothing is shuffled.
"""

from __future__ import annotations

import json
import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import accumulate

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from .common import text_or_empty

DEFAULT_VOCABULARY = "byte_bpe_50k.json"
#: Pre-tokens kept per generation of a task's cache; two generations are held.
CACHE_WORDS = 400_000

# Fixed value: the public byte-level BPE pre-tokenization pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The same for texts in ASCII.
_ASCII_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"
#: Characters of the longest contraction in the pattern.
_CONTRACTION = 3
# Unicode tables differ between libraries from here on; such texts are split
# by the tokenizer's own pre-tokenizer.
_UNSTABLE = re.compile("[՘-\U0010ffff]")


def vocabulary_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-in characters of byte-level vocabularies."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    moved = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}


class PrefixCounter:
    """Prefix tables of one vocabulary file."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = _byte_alphabet()
        vocab = spec["model"]["vocab"]
        self.token_id = {bytes(alphabet[c] for c in t): i for t, i in vocab.items()
                         if all(c in alphabet for c in t)}
        self.token_bytes = {i: b for b, i in self.token_id.items()}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.made_by = {made: (rank, a, b) for (a, b), (rank, made) in self.merges.items()}
        self._spines: tuple[dict, dict] = ({}, {})
        self.special = [t["content"] for t in spec["added_tokens"]]
        self._split_special = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        self._words = regex.compile(PATTERN).findall
        self._ascii_words = re.compile(_ASCII_PATTERN, re.ASCII).findall
        self._ends = ahocorasick.Automaton()  # bytes as code points 0 to 255
        for b, i in self.token_id.items():
            self._ends.add_word(b.decode("latin-1"), (i, len(b)))
        self._ends.make_automaton()
        self._library_words = Tokenizer.from_file(path).pre_tokenizer
        self._valid: dict[tuple[int, int], bool] = {}
        self._cache_words = cache_words
        self._young: dict[str, bytes | tuple[int, ...]] = {}
        self._old: dict[str, bytes | tuple[int, ...]] = {}

    def encode_bytes(self, word: bytes) -> list[int]:
        """Plain BPE: merge the pair of lowest rank, leftmost first."""
        ids = [self.token_id[word[i:i + 1]] for i in range(len(word))]
        merges = self.merges
        while len(ids) > 1:
            best = min(((merges[p][0], i) for i, p in enumerate(zip(ids, ids[1:])) if p in merges), default=None)
            if best is None:
                break
            i = best[1]
            ids[i:i + 2] = [merges[ids[i], ids[i + 1]][1]]
        return ids

    def _spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """The tokens at the right (1) or left (0) edge while ``token`` is
        merged, from the byte up, each with the rank of the merge that ends it."""
        found = self._spines[side].get(token)
        if found is None:
            edge, ends = [token], [math.inf]
            while (made := self.made_by.get(edge[-1])) is not None:
                edge.append(made[1 + side])
                ends.append(made[0])
            found = self._spines[side][token] = list(zip(reversed(edge), reversed(ends)))
        return found

    def compatible(self, left: int, right: int) -> bool:
        """``left`` then ``right`` is how their joined bytes are encoded
        (``left`` -1: ``right`` alone): at no time does a merge across the
        boundary come before the next merge on either side."""
        known = self._valid.get((left, right))
        if known is None:
            if len(self._valid) > 4 * self._cache_words:
                self._valid.clear()
            if left < 0:
                known = self.encode_bytes(self.token_bytes[right]) == [right]
            else:
                known = self.compatible(-1, right) and not self._merge_across(left, right)
            self._valid[left, right] = known
        return known

    def _merge_across(self, left: int, right: int) -> bool:
        a, b = self._spine(left, 1), self._spine(right, 0)
        i = j = 0
        while True:
            (x, x_ends), (y, y_ends) = a[i], b[j]
            found = self.merges.get((x, y))
            if found is not None and found[0] < x_ends and found[0] <= y_ends:
                return True
            if x_ends == y_ends == math.inf:
                return False
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1

    def byte_counts(self, word: bytes) -> list[int]:
        """Tokens of the first 0, 1, ... bytes of one pre-token."""
        last, counts, at = [-1], [0], 0
        known = self._valid
        for end, (t, size) in self._ends.iter(word.decode("latin-1")):
            if end < at:
                continue
            if end > at:
                raise ValueError("no token of the vocabulary ends here")
            before = last[end + 1 - size]
            ok = known.get((before, t))
            if ok or ok is None and self.compatible(before, t):
                last.append(t)
                counts.append(counts[end + 1 - size] + 1)
                at += 1
        return counts

    def char_counts(self, word: str) -> bytes | tuple[int, ...]:
        """Tokens of the first 0, 1, ... code points of one pre-token; those of
        short words are kept, a byte each, in the cache, whose size is bounded
        by two generations."""
        found = self._young.get(word)
        if found is None:
            found = self._old.pop(word, None)
            if found is None:
                data = word.encode()
                counts = self.byte_counts(data)
                found = tuple(counts) if len(data) == len(word) else tuple(
                    counts[i] for i in range(len(counts)) if i == len(data) or data[i] & 0xC0 != 0x80)
            if len(self._young) >= self._cache_words:
                self._old, self._young = self._young, {}
            if len(word) <= 60:
                found = self._young[word] = bytes(found)
        return found

    def plain_words(self, text: str) -> list[str]:
        if text.isascii():
            return self._ascii_words(text)
        if not _UNSTABLE.search(text):
            return self._words(text)
        return [text[b:e] for _, (b, e) in self._library_words.pre_tokenize_str(text)]

    def words(self, text: str) -> list[str]:
        """Pre-tokens and special strings, in order; joined they are ``text``."""
        if self._split_special is None or not any(s in text for s in self.special):
            return self.plain_words(text)
        out, at = [], 0
        for m in self._split_special.finditer(text):
            out += self.plain_words(text[at:m.start()])
            out.append(m.group())
            at = m.end()
        return out + self.plain_words(text[at:])

    def tokens(self, words: list[str]) -> list[int]:
        """Tokens of each pre-token or special string."""
        out = []
        young = self._young
        for w in words:
            found = young.get(w)
            if found is None:
                found = b"\1" if w in self.special else self.char_counts(w)
                young = self._young
            out.append(found[-1])
        return out

    def count(self, text: str) -> int:
        """Tokens of the whole text."""
        return sum(self.tokens(self.words(text)))

    def table(self, text: str) -> PrefixTable:
        return PrefixTable(self, text)


class PrefixTable:
    """Token counts of every prefix of one text."""

    def __init__(self, counter: PrefixCounter, text: str):
        self.counter, self.text = counter, text
        self.words = counter.words(text)
        self.counts = list(accumulate(counter.tokens(self.words), initial=0))

    @cached_property
    def ends(self) -> list[int]:
        return list(accumulate(map(len, self.words), initial=0))

    @property
    def total(self) -> int:
        return self.counts[-1]

    def at(self, chars: int) -> int:
        """Tokens of the first ``chars`` code points, as encoding them alone
        would give."""
        chars = max(0, min(chars, len(self.text)))
        j = bisect_right(self.ends, chars) - 1
        return self._cut(j, chars - self.ends[j])

    def _cut(self, j: int, chars: int, counts: bytes | tuple[int, ...] | None = None) -> int:
        """Tokens of the words before word ``j`` and its first ``chars`` code
        points (``counts``: the word's own table)."""
        end = self.ends[j] + chars
        if chars == 0:
            if j < 2 or not (self.words[j - 1].isspace() and self.words[j - 2].isspace()):
                return self.counts[j]
            return self.counts[j - 2] + self.counter.count(self.text[self.ends[j - 2]:end])
        word = self.words[j]
        if word in self.counter.special:
            first = j - 1 if j and self.words[j - 1] not in self.counter.special else j
        elif j and self.words[j - 1].isspace() and word[chars - 1].isspace() and word[:chars].isspace():
            first = j - 1
        elif len(word) <= _CONTRACTION:
            first = j
        else:
            # A part of any other pre-token is one pre-token too.
            return self.counts[j] + (counts or self.counter.char_counts(word))[chars]
        # The cut parts a special string or a contraction, or regroups the
        # blanks before it: the words at the cut alone are split again.
        return self.counts[first] + self.counter.count(self.text[self.ends[first]:end])

    def fit(self, budget: int) -> int:
        """Code points of the longest prefix within ``budget`` tokens that ends
        in or at the end of the first pre-token to exceed it. One backward pass
        over the counts that this pre-token's table holds."""
        j = bisect_right(self.counts, budget) - 1
        if j < 0:
            return 0
        if j == len(self.words):
            return len(self.text)
        word = self.words[j]
        counts = None if word in self.counter.special else self.counter.char_counts(word)
        for chars in range(len(word) - 1, 0, -1):
            if self._cut(j, chars, counts) <= budget:
                return self.ends[j] + chars
        # Blanks of two words are one at the end of a text, maybe of more tokens.
        return self.ends[j] if self._cut(j, 0) <= budget else self.ends[j - 1]


@lru_cache(maxsize=2)
def counter_for(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def token_counts(docs: DataFrame, budget: int = 1024, vocabulary: str = DEFAULT_VOCABULARY,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit``
    (more than ``budget`` tokens) and ``fit_chars`` (code points of the longest
    prefix within the budget, see ``PrefixTable.fit``).

    Counts equal those of the vocabulary's library without begin, end or added
    special tokens; special strings inside a text count as one token. A null
    text counts as empty (all zero), a null id stays null, repeated rows each
    give a row, and other columns are not read. Texts of any length are
    processed whole.
    """
    schema = StructType([StructField("doc_id", docs.schema[id_col].dataType), StructField("n_bytes", LongType(), False),
                         StructField("n_tokens", LongType(), False), StructField("over_limit", BooleanType(), False),
                         StructField("fit_chars", LongType(), False)])
    read = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"),
                       F.octet_length(text_or_empty(text_col)).cast("long").alias("n_bytes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_for(vocabulary_path(vocabulary))
        for b in batches:
            n_tokens, fit = [], []
            for cell in b.column("text"):
                prefixes = counter.table(cell.as_py())
                n_tokens.append(prefixes.total)
                fit.append(prefixes.fit(budget))
            n = pa.array(n_tokens, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("n_bytes"), n, pa.array([x > budget for x in n_tokens], pa.bool_()),
                 pa.array(fit, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars"])

    return read.mapInArrow(run, schema)
