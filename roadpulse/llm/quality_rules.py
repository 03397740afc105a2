"""Quality rules by distribution divergence, in DataFrame functions only.

Each document gives two histograms, of character classes and of common words.
They are compared, by the Jensen-Shannon distance (base 2, between 0 and 1),
with the reference of the document's language: the mean shares of all its
documents (each counts the same, so one long document cannot bend it). Base rules on length and repetition come first, and each comparison
has a minimum length below which it has no say.

One pass over the texts makes a few numbers per document, which are written to
the shared folder; references and verdicts come from those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, let, text_or_empty, unpacked, whole_rows

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Least words (common words) and characters a comparison needs.
MIN_COMPARED_WORDS = 100
MIN_COMPARED_CHARS = 300
#: Most histograms lie in the share of other words, so distances are short: from a
#: reference with a share c of common words, a text without any is at a distance of
#: 0.30 for c = 0.17, 0.33 for 0.20, 0.56 for 0.50 (references below 0.17 need a
#: lower limit). In sf0.1 (c of 0.20 to 0.22) one of 7,367 texts with 8 % and more
#: common words of their language is farther than this.
MAX_WORD_DISTANCE = 0.3
MAX_CHAR_DISTANCE = 0.3

# Common words of the languages compared, lower case.
COMMON_WORDS = (
    "the of and to in a is that it was for on are as with he by at be or",
    "le la de et les des un une du en est que dans qui pour pas sur au il ce",
    "der die das und den von zu mit ist im dem nicht ein eine auf für sich des auch als",
    "el los y que en un una se del las por con no su para es al lo como más",
)
# Character classes, peeled off in this order; the rest is one more.
CLASSES = (("lower", "[a-z]+"), ("upper", "[A-Z]+"), ("digit", "[0-9]+"), ("wide", r"[^\x00-\x7F]+"),
           ("symbol", r"[#*$%&|<>]+"))


def common_words() -> list[str]:
    return list(dict.fromkeys(w for line in COMMON_WORDS for w in line.split()))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != F.lit(""))


def repeated_words(words: Column) -> Column:
    """Words inside a window of three that occurs twice or more in the array.
    Windows are sorted by a 64-bit hash with their place, so equal ones are
    neighbours."""
    def hashes(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(
            F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    def places(h: Column) -> Column:
        keyed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(keyed, lambda s: F.transform(F.filter(s, lambda x, k: F.coalesce(
            (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]),
            F.get(s, k - 1)["h"] == x["h"], F.get(s, k + 1)["h"] == x["h"], F.lit(False))), lambda x: x["i"]))

    def count(h: Column) -> Column:
        covered = F.flatten(F.transform(places(h), lambda i: F.array(i, i + 1, i + 2)))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), F.size(F.array_distinct(covered))).otherwise(0)

    return F.when(F.size(words) >= 3, let(words, lambda w: let(hashes(w), count))).otherwise(0)


def _peeled(text: Column) -> Column:
    """Characters of each class of a text, the rest last."""
    def step(k: int, left: Column, size: Column, done: list[Column]) -> Column:
        if k == len(CLASSES):
            return F.array(*done, size)
        return let(F.regexp_replace(left, CLASSES[k][1], ""), lambda rest: step(
            k + 1, rest, F.length(rest), [*done, size - F.length(rest)]))
    return step(0, text, F.length(text), [])


def features(docs: DataFrame, whole: bool = False) -> DataFrame:
    """Per row the base numbers and both histograms (``chars`` by class,
    ``common`` by common word, the other words last); ``whole``: and ``row``,
    the row itself."""
    vocabulary = common_words()
    carried = ["row"] if whole else []
    read = docs.select("doc_id", "lang", text_or_empty().alias("text"), F.xxhash64("text").alias("text_hash"),
                       *[whole_rows(docs).alias(c) for c in carried])
    listed = read.withColumn("words", words_of(F.col("text")))
    w, text = F.col("words"), F.col("text")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    known = F.filter(F.transform(w, F.lower), lambda x: x.isin(vocabulary))
    place = F.transform(known, lambda x: F.array_position(F.lit(vocabulary), x).cast("int"))
    joined = F.array_join(w, "")
    made = listed.select(
        *carried, "doc_id", "lang", "text_hash", F.size(w).cast("long").alias("n_words"), F.length(joined).cast("long").alias("word_chars"),
        _peeled(joined).alias("chars"), let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
        .cast("long").alias("n_dup_lines"), repeated_words(w).cast("long").alias("n_repeat_words"), place.alias("place"))
    left = F.size("place")
    counts = [left - F.size(F.array_remove("place", F.lit(k + 1))) for k in range(len(vocabulary))]
    return made.select(
        *carried, "doc_id", "lang", "text_hash", "n_words", "word_chars",
        F.col("chars")[[c for c, _ in CLASSES].index("symbol")].cast("long").alias("n_symbols"),
        "n_dup_lines", "n_repeat_words", F.transform("chars", lambda x: x.cast("long")).alias("chars"),
        F.transform(F.array(*counts, F.col("n_words").cast("int") - left), lambda x: x.cast("long")).alias("common"))


def shares(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    return let(total, lambda n: F.transform(counts, lambda x: F.when(n > 0, x / n).otherwise(F.lit(0.0))))


def jensen_shannon(p: Column, q: Column) -> Column:
    """Distance (square root of the divergence, base 2) of two histograms of
    shares; null if either is null."""
    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))
    total = F.aggregate(F.zip_with(p, q, lambda a, b: part(a, b) + part(b, a)), F.lit(0.0), lambda s, x: s + x)
    return F.sqrt(F.greatest(total / 2, F.lit(0.0)))


def references(made: DataFrame) -> DataFrame:
    """Per language: mean shares of all its documents with words."""
    n_common, n_class = len(common_words()) + 1, len(CLASSES) + 1
    shared = made.where("n_words > 0").select("lang", shares(F.col("chars")).alias("c"), shares(F.col("common")).alias("w"))
    means = shared.groupBy("lang").agg(*[F.avg(F.col("c")[i]).alias(f"c{i}") for i in range(n_class)],
                                       *[F.avg(F.col("w")[i]).alias(f"w{i}") for i in range(n_common)])
    return means.select(F.col("lang").alias("ref_lang"), F.array(*[F.col(f"c{i}") for i in range(n_class)]).alias("ref_chars"),
                        F.array(*[F.col(f"w{i}") for i in range(n_common)]).alias("ref_common"))


def judge_quality(docs: DataFrame, min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT,
                  max_word_distance: float = MAX_WORD_DISTANCE,
                  max_char_distance: float = MAX_CHAR_DISTANCE) -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words``, ``base_failed``, ``char_distance``,
    ``word_distance``, ``kept`` and ``text_hash`` (xxhash64 of the text).

    A null text counts as empty and fails the base rules; a null language is a
    language of its own with its own reference; a null id stays null; repeated
    rows each give a row and count in the references; other columns are not
    read. Texts are measured whole.
    """
    return _judged(docs, False, min_words, max_repeat_percent, max_word_distance, max_char_distance)


def _judged(docs: DataFrame, whole: bool, min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT,
            max_word_distance: float = MAX_WORD_DISTANCE, max_char_distance: float = MAX_CHAR_DISTANCE) -> DataFrame:
    made = cut(features(docs, whole), "quality-features")
    # Written, so that the planner knows its size (a row a language) before it places the join.
    joined = made.join(cut(references(made), "quality-references"), F.col("lang").eqNullSafe(F.col("ref_lang")), "left")
    failed = ((F.col("n_words") < min_words)
              | (F.lit(100) * F.col("n_repeat_words") > F.lit(max_repeat_percent) * F.col("n_words")))
    far = (((F.col("n_words") >= MIN_COMPARED_WORDS) & (F.col("word_distance") > max_word_distance))
           | ((F.col("word_chars") >= MIN_COMPARED_CHARS) & (F.col("char_distance") > max_char_distance)))
    return joined.select(
        *(["row"] if whole else []), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        jensen_shannon(shares(F.col("chars")), F.col("ref_chars")).alias("char_distance"),
        jensen_shannon(shares(F.col("common")), F.col("ref_common")).alias("word_distance"), "text_hash",
    ).withColumn("kept", ~F.col("base_failed") & ~far)


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``judge_quality`` keeps, all columns, whatever
    their names. Cases as there: repeated rows are judged alike and all stay or
    go, null and empty texts go, an empty table gives an empty one. The rows are
    carried with their numbers, so that no text is shuffled."""
    return _judged(docs, True).where("kept").select(*unpacked(docs))
