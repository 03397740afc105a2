"""SentencePiece encoding and decoding by a relational lattice.

A text is cut into words: runs of letters or of other characters, with the
spaces before them. No piece of the vocabulary crosses such a cut (checked when
it is read), so the best segmentation of a text is that of its words. For the
words of the corpus, most frequent first and bounded in number, the lattice is
a join: all substrings up to the longest piece are exploded and equi-joined to
the piece table, the edges are grouped by word, and a higher-order ``aggregate``
folds Viterbi over them. The finished dictionary is broadcast; tasks replace
words by their ids and run the same recurrence for words outside it.

Texts are never shuffled: only word counts and the lattice of the dictionary are.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import cut, let, text_or_empty

DEFAULT_MODEL = "piece_bpe_32k.model"
#: Most words of the broadcast dictionary, and code points of a word in it.
DICTIONARY_WORDS, DICTIONARY_CHARS = 1 << 18, 32
#: Most pieces of a vocabulary (each task holds it).
MAX_PIECES = 1 << 18
#: Bytes of ids a task holds before it hands them on, and rows decoded at a time.
ENCODED_BYTES = 4_000_000
DECODED_ROWS = 500
#: Words outside the dictionary that a task remembers.
CACHE_WORDS = 200_000
#: An unknown character costs as much as the worst piece and this.
UNKNOWN_PENALTY = 10.0

# Words: cut between letters and other characters, and before spaces.
WORDS = r" *\p{L}+| *[^\p{L} ]+| +"
_any_words = regex.compile(WORDS)
_ascii_words = re.compile(r" *[A-Za-z]+| *[^A-Za-z ]+| +")


@dataclass
class Pieces:
    """A vocabulary: ids and scores of its plain pieces (with spaces for the
    meta symbol), ids of its byte pieces, and the bytes each id stands for."""

    plain: dict
    byte_ids: list
    spelled: list
    longest: int
    unknown: float

    @classmethod
    def read(cls, path: str) -> Pieces:
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain, byte_ids, spelled = {}, [0] * 256, []
        if model.get_piece_size() > MAX_PIECES:
            raise ValueError(f"at most {MAX_PIECES} pieces")
        for i in range(model.get_piece_size()):
            text = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(text[3:5], 16)] = i
                spelled.append(bytes([int(text[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                spelled.append(b"")
            else:
                text = text.replace("▁", " ")
                plain[text] = (i, float(model.get_score(i)))
                spelled.append(text.encode())
        if 0 in byte_ids:
            raise ValueError("the vocabulary lacks byte pieces")
        crossing = [t for t in plain if not _any_words.fullmatch(t)]
        if crossing:
            raise ValueError(f"pieces cross the cuts between words: {crossing[:5]}")
        return cls(plain, byte_ids, spelled, max(map(len, plain)), min(s for _, s in plain.values()) - UNKNOWN_PENALTY)


def words_of(text: str) -> list[str]:
    return (_ascii_words if text.isascii() else _any_words).findall(text)


def model_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class WordEncoder:
    """Viterbi over single words, with a bounded cache."""

    def __init__(self, pieces: Pieces):
        self.p = pieces
        self.ends = ahocorasick.Automaton()
        for text, (i, score) in pieces.plain.items():
            self.ends.add_word(text, (i, score, len(text)))
        self.ends.make_automaton()
        self.cache: dict[str, bytes] = {}

    def ids(self, word: str) -> list[int]:
        """Best by score, then fewer pieces, then the shorter last piece; a
        character without a piece of its own becomes its bytes."""
        score, count = [0.0] + [-math.inf] * len(word), [0] * (len(word) + 1)
        back: list[tuple[int, int]] = [(0, 0)] * (len(word) + 1)
        at, whole = 1, False

        def settle(end: int) -> None:
            nonlocal at, whole
            while at <= end:
                if not whole:
                    better(at - 1, at, self.p.unknown, -1)
                at, whole = at + 1, False

        def better(start: int, end: int, gain: float, piece: int) -> None:
            new = (score[start] + gain, count[start] - 1, start, piece)
            if new > (score[end], count[end], *back[end]):
                score[end], count[end], back[end] = new[0], new[1], (start, piece)

        for last, (i, gain, size) in self.ends.iter(word):
            settle(last)
            better(last + 1 - size, last + 1, gain, i)
            whole = whole or size == 1
        settle(len(word))
        out: list[int] = []
        end = len(word)
        while end:
            start, piece = back[end]
            out += [piece] if piece >= 0 else [self.p.byte_ids[b] for b in reversed(word[start:end].encode())]
            end = start
        return out[::-1]

    def packed(self, word: str) -> bytes:
        found = self.cache.get(word)
        if found is None:
            if len(self.cache) >= CACHE_WORDS:
                self.cache.clear()
            found = np.array(self.ids(word), "<i4").tobytes()
            if len(word) <= 4 * DICTIONARY_CHARS:
                self.cache[word] = found
        return found


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(Pieces.read(path))


def _prefixed(text: Column) -> Column:
    """The dummy space before a text; an empty text stays empty."""
    return F.when(text != F.lit(""), F.concat(F.lit(" "), text)).otherwise(F.lit(""))


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n) over all texts, words up to DICTIONARY_CHARS code points."""
    words = F.regexp_extract_all(_prefixed(text_or_empty(text_col)), F.lit(WORDS), F.lit(0))
    return (docs.select(F.explode(words).alias("word")).where(F.length("word") <= DICTIONARY_CHARS)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def frequent_words(counts: DataFrame, most: int = DICTIONARY_WORDS) -> DataFrame:
    """The words whose count reaches the smallest power of two that leaves
    ``most`` or fewer."""
    counts = cut(counts, "piece-words")
    level = F.floor(F.log2(F.col("n").cast("double"))).cast("int")
    by_level = {r[0]: r[1] for r in counts.groupBy(level.alias("level")).count().collect()}
    kept, least = 0, 63
    while least > 0 and kept + by_level.get(least - 1, 0) <= most:
        least -= 1
        kept += by_level.get(least, 0)
    return counts.where(level >= least).select("word")


def lattice(words: DataFrame, pieces: DataFrame, longest: int) -> DataFrame:
    """(word, edges): per word all its pieces as (end, start, score, id)."""
    starts = words.repartition("word").select("word", F.explode(F.sequence(F.lit(1), F.length("word"))).alias("start"))
    spans = starts.select("word", "start", F.explode(F.sequence(F.lit(1), F.least(
        F.lit(longest), F.length("word") - F.col("start") + 1))).alias("size"))
    substrings = spans.select("word", (F.col("start") - 1).alias("start"), (F.col("start") - 1 + F.col("size")).alias("end"),
                              F.expr("substring(word, start, size)").alias("piece"))
    edges = substrings.join(F.broadcast(pieces), "piece")
    return edges.groupBy("word").agg(F.collect_list(F.struct("end", "start", "score", "id")).alias("edges"))


def _viterbi(word: Column, edges: Column) -> Column:
    """Ids of the best path through a word's edges; null if none covers it."""
    first = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("count"), F.lit(0).alias("start"), F.lit(-1).alias("id")))

    def step(best: Column, end: Column) -> Column:
        def reached(x: Column) -> Column:
            return let(F.get(best, x["start"]), lambda b: F.when(b.isNotNull(), F.struct(
                (b["score"] + x["score"]).alias("score"), (b["count"] - 1).alias("count"), x["start"].alias("start"),
                x["id"].alias("id"))))
        arriving = F.transform(F.filter(edges, lambda x: x["end"] == end), reached)
        return F.concat(best, F.array(F.array_max(arriving)))

    def back(best: Column) -> Column:
        path = F.aggregate(
            F.sequence(F.lit(1), F.length(word)),
            F.struct(F.length(word).alias("at"), F.array().cast("array<int>").alias("ids")),
            lambda s, _: F.when(s["at"] == 0, s).otherwise(F.struct(
                F.get(best, s["at"])["start"].alias("at"),
                F.concat(F.array(F.get(best, s["at"])["id"]), s["ids"]).alias("ids"))))
        return F.when(F.get(best, F.length(word)).isNotNull(), path["ids"])

    return let(F.aggregate(F.sequence(F.lit(1), F.length(word)), first, step), back)


def dictionary(spark: SparkSession, docs: DataFrame, pieces: Pieces, text_col: str = "text",
               most: int = DICTIONARY_WORDS) -> DataFrame:
    """(word, ids) of the frequent words; ids are null for a word that pieces
    do not cover (it needs bytes). No filter on them here: the optimizer would
    move it below and run the fold twice."""
    table = spark.createDataFrame([(t, i, s) for t, (i, s) in pieces.plain.items()], "piece string, id int, score double")
    words = frequent_words(word_counts(docs, text_col), most)
    return lattice(words, table, pieces.longest).select(
        "word", _viterbi(F.col("word"), F.col("edges")).alias("ids"))


def encode(docs: DataFrame, model: str = DEFAULT_MODEL, id_col: str = "doc_id", text_col: str = "text",
           most: int = DICTIONARY_WORDS) -> DataFrame:
    """Per row: ``doc_id``, ``ids`` (array of int) and ``text_sha256`` of the
    text they stand for.

    A null or empty text has no ids, a null id stays null, repeated rows each
    give a row, and other columns are not read. Texts and words of any length
    are encoded whole.
    """
    spark = docs.sparkSession
    path = model_path(model)
    pieces = Pieces.read(path)
    known = dictionary(spark, docs, pieces, text_col, most).toArrow()
    packed = {}
    for b in known.to_batches():
        offsets = b.column("ids").offsets.to_numpy() * 4
        flat = b.column("ids").values.to_numpy().astype("<i4").tobytes()
        packed.update((w, flat[x:y]) for w, x, y in zip(b.column("word").to_pylist(), offsets, offsets[1:]) if y > x)
    shared = spark.sparkContext.broadcast(packed)
    del known, packed
    text = text_or_empty(text_col)
    read = docs.select(F.col(id_col).alias("doc_id"), _prefixed(text).alias("text"), F.sha2(text, 256).alias("text_sha256"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        other = _encoder(model_path(model)).packed
        listed = shared.value.get
        for b in batches:
            at, size, rows = 0, 0, []
            for t in b.column("text"):
                rows.append(b"".join([listed(w) or other(w) for w in words_of(t.as_py())]))
                size += len(rows[-1])
                if size >= ENCODED_BYTES:
                    yield _batch(b, at, rows)
                    at, size, rows = at + len(rows), 0, []
            if rows:
                yield _batch(b, at, rows)

    kind = docs.schema[id_col].dataType.simpleString()
    return read.mapInArrow(run, f"doc_id {kind}, ids array<int>, text_sha256 string")


def _batch(b: pa.RecordBatch, at: int, rows: list[bytes]) -> pa.RecordBatch:
    ends = np.cumsum([0, *(len(r) // 4 for r in rows)]).astype(np.int32)
    ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(rows), "<i4")))
    part = b.slice(at, len(rows))
    return pa.RecordBatch.from_arrays([part.column("doc_id"), ids, part.column("text_sha256")],
                                      names=["doc_id", "ids", "text_sha256"])


def decode(encoded: DataFrame, model: str = DEFAULT_MODEL) -> DataFrame:
    """``encoded`` with a column ``text`` for its ``ids`` (null ids: null; no
    ids: empty). An existing ``text`` is replaced."""
    others = [c for c in encoded.columns if c != "text"]
    schema = StructType([*encoded.select(*others).schema.fields, StructField("text", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelled = _encoder(model_path(model)).p.spelled
        for b in batches:
            ids = b.column(b.schema.get_field_index("ids"))
            flat, ends = ids.values.to_numpy(), ids.offsets.to_numpy()
            for at in range(0, len(b), DECODED_ROWS):
                part = b.slice(at, DECODED_ROWS)
                text = [b"".join([spelled[i] for i in flat[ends[k]:ends[k + 1]].tolist()])[1:].decode() if ids[k].is_valid
                        else None for k in range(at, at + len(part))]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(text, pa.string())],
                                                 names=[*b.schema.names, "text"])

    return encoded.select(*others).mapInArrow(run, schema)


def encode_report(docs: DataFrame, model: str = DEFAULT_MODEL) -> DataFrame:
    """Of ``encode`` per row: ``n_pieces``, ``ids_hash`` (xxhash64 of the ids)
    and ``round_trip``, whether decoding the ids gives the text again."""
    both = decode(encode(docs, model), model)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"),
                       (F.sha2(F.col("text"), 256) == F.col("text_sha256")).alias("round_trip"))
