"""Line dedup: the lines of a corpus that an earlier document already holds.

Every line's key gets two 64-bit hashes. The rows (hashes, document, position)
are dealt by ranges of the first hash, sorted by hash, document and position,
and read as a stream: in a run of equal hashes all documents after the first
lose their lines. Positions to lose come back as a bitmap a document, not as
text.

A key that holds more than its share of all lines (found by a heavy-hitter
sketch over every line) isn't dealt: its first document is a minimum, which is
aggregated before the shuffle, and at most ``HOT_KEYS`` such keys exist.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, let

#: Fewest code points of a key that counts.
LEAST_CHARS = 10
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Keys that the sketch reports, keys that it follows, and groups that it is
#: merged in first (each holds some 100 kB). These change the plan only.
HOT_KEYS, FOLLOWED, MERGES = 1_000, 8_000, 64


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _tag(text: Column) -> Column:
    """Tells rows that share an id but not a text apart."""
    return F.xxhash64(text)


def line_hashes(docs: DataFrame, least: int = LEAST_CHARS) -> DataFrame:
    """(doc_id, tag, pos, h1, h2) of each line whose key counts."""
    each = docs.select("doc_id", _tag(F.col("text")).alias("tag"), F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
    keyed = each.select("doc_id", "tag", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= least)
    return keyed.select("doc_id", "tag", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def hot_keys(lines: DataFrame, parts: int) -> list[int]:
    """First hashes that more lines hold than a task has on average; at most
    HOT_KEYS. The sketches of the tasks are merged in two steps."""
    some = lines.groupBy((F.spark_partition_id() % MERGES).alias("merge")).agg(
        F.expr(f"approx_top_k_accumulate(h1, {FOLLOWED})").alias("sketch"), F.count(F.lit(1)).alias("n"))
    # Grouped by a column of one value: the sketch can't be merged with that of a task without rows.
    row = some.groupBy((F.col("merge") < MERGES).alias("all")).agg(
        F.expr(f"approx_top_k_combine(sketch, {FOLLOWED})").alias("sketch"), F.sum("n").alias("n")).select(
        F.expr(f"approx_top_k_estimate(sketch, {HOT_KEYS})").alias("top"), "n").first()
    return [x["item"] for x in row["top"] if x["count"] * parts > row["n"]] if row else []


def _first_of(hot: DataFrame) -> DataFrame:
    """(h1, h2, first): the smallest document of each hot key; a null id comes last."""
    return hot.groupBy("h1", "h2").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")).alias("first"))


def repeated_lines(docs: DataFrame, least: int = LEAST_CHARS) -> DataFrame:
    """(doc_id, tag, pos): lines whose key a smaller document holds."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lines = cut(line_hashes(docs, least), "line-hashes")
    hot = hot_keys(lines, parts)
    # The part of the unsigned hash range: its upper 31 bits times the number of parts.
    part = F.shiftright(F.shiftrightunsigned("h1", 33) * F.lit(parts), 31).cast("int")
    dealt = lines.where(~F.col("h1").isin(hot)).withColumn("part", part).repartitionById(parts, F.col("part"))
    run = (Window.partitionBy("part", "h1", "h2").orderBy(F.col("doc_id").asc_nulls_last(), "tag", "pos")
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    first = dealt.withColumn("first", F.first("doc_id").over(run))
    later = first.where(~F.col("doc_id").eqNullSafe(F.col("first"))).select("doc_id", "tag", "pos")
    if not hot:
        return later
    rows = lines.where(F.col("h1").isin(hot))
    # At most HOT_KEYS rows: the one broadcast, whatever the corpus.
    known = rows.join(F.broadcast(_first_of(rows)), ["h1", "h2"])
    return later.unionByName(known.where(~F.col("doc_id").eqNullSafe(F.col("first")["doc_id"])).select("doc_id", "tag", "pos"))


def keep_bitmaps(docs: DataFrame, least: int = LEAST_CHARS) -> DataFrame:
    """Per document that loses lines: ``doc_id``, ``tag`` (hash of its text)
    and ``keep``, a compressed bitmap of its lines: (word, bits) for each word
    of 64 lines that are not all kept, ascending; bit i of a word is set when
    line 64 * word + i stays.

    A line's key is the line without blanks at its ends, A-Z in lower case. A
    key of ``least`` code points or more that at least two documents hold stays
    in the smallest id only. A null or empty text is one empty line. Rows with
    one id are one document here: they don't repeat each other, and repeated
    rows have one bitmap; a null id counts as the largest. Only ``doc_id`` and
    ``text`` are read.
    """
    bit = F.expr("shiftleft(1L, pos % 64)")
    words = (repeated_lines(docs, least).withColumn("bit", bit)
             .groupBy("doc_id", "tag", F.floor(F.col("pos") / 64).cast("int").alias("word"))
             .agg(F.bitwise_not(F.bit_or("bit")).alias("bits")))
    return words.groupBy("doc_id", "tag").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("keep"))


def dropped_lines(keep: Column) -> Column:
    """Positions that a bitmap drops, ascending."""
    def of_word(w):
        bits = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.getbit(w["bits"], i) == 0)
        return F.transform(bits, lambda i: w["word"] * 64 + i)
    return F.flatten(F.transform(F.coalesce(keep, F.array().cast("array<struct<word:int,bits:bigint>>")), of_word))


def kept_text(text: Column, dropped: Column) -> Column:
    """The lines that stay, joined by \\n; linear in the number of lines."""
    def joined(lines):
        places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), dropped)
        return F.array_join(F.transform(places, lambda i: lines[i]), "\n")
    return let(_lines(text), joined)


def _with_dropped(docs: DataFrame, least: int) -> DataFrame:
    """(row, dropped): each row of ``docs`` as a struct, and its positions to drop."""
    maps = keep_bitmaps(docs, least).select(F.col("doc_id").alias("id"), "tag", "keep")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("own_id"),
                       _tag(F.col("text")).alias("own_tag"))
    same = F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_tag") == F.col("tag"))
    return rows.join(maps, same, "left").select("row", dropped_lines(F.col("keep")).alias("dropped"))


def dedup_lines(docs: DataFrame, least: int = LEAST_CHARS) -> DataFrame:
    """``docs`` with its texts without the lines that ``keep_bitmaps`` drops.
    All columns and rows stay; a text that loses nothing stays as it is (null too)."""
    text = F.when(F.size("dropped") > 0, kept_text(F.col("row.text"), F.col("dropped"))).otherwise(F.col("row.text"))
    return _with_dropped(docs, least).select(
        *[text.alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def dedup_report(docs: DataFrame, least: int = LEAST_CHARS) -> DataFrame:
    """Per row: ``doc_id``, ``n_lines`` (before dropping), ``n_dropped`` and
    ``kept_sha256``, the digest of the text that stays (cases as in
    ``keep_bitmaps``)."""
    whole = F.coalesce(F.col("row.text"), F.lit(""))
    kept = F.when(F.size("dropped") > 0, kept_text(F.col("row.text"), F.col("dropped"))).otherwise(whole)
    n_lines = F.length(whole) - F.length(F.replace(whole, F.lit("\n"), F.lit(""))) + 1
    return _with_dropped(docs, least).select(
        F.col("row.doc_id").alias("doc_id"), n_lines.cast("long").alias("n_lines"),
        F.size("dropped").cast("long").alias("n_dropped"), F.sha2(kept, 256).alias("kept_sha256"))


def oracle_sql(least: int = LEAST_CHARS) -> str:
    blanks = " || ".join(f"chr({ord(c)})" for c in BLANKS)
    return f"""WITH d AS (SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT row, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, {blanks}), '{UPPER}', '{LOWER}') AS key FROM l),
f AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= {least} GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
m AS (SELECT k.*, coalesce(f.first <> k.doc_id, false) AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY row, doc_id"""
