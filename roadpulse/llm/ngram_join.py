"""N-gram Jaccard join: documents whose sets of word shingles overlap by at
least a threshold, by filters under several global token orders.

A token is the 64-bit hash of a shingle; documents with equal sets form one
class. With threshold t, two linked sets of n and m tokens share at least
ceil(t * max(n, m)) tokens, so under any global order of the tokens the first
n - ceil(t n) + k tokens of one and the first m - ceil(t m) + k of the other
have at least k in common. The filters are intersected:

1. Hash order. Only these prefixes (k a quarter of the set) are shuffled, by
   token. A class must share ``least_shared(n)`` tokens of its prefix with
   other classes; most classes share too few and leave here, also those with a
   passage that many documents repeat.
2. Order by frequency among the classes left, rarest first, over whole sets.
   A class must share ceil(t n) tokens; a candidate pair must share a token in
   both plain prefixes (k = 1), at places that leave room for enough others.
3. A second hash order. Before the exact check, the pair must share a token in
   its plain prefix.

Linked classes are found in rounds: in each token's bucket every class meets
one other class that it is not yet connected with (after the first round the
most alike of a few, by maps of their tokens); verified links connect them,
and buckets within one component fall away. The pairs that then remain between
different components are checked in full, so no link is lost, and a large group
of near copies is connected without emitting all its pairs.

Nothing of corpus size reaches the driver or is broadcast; what the second
reading of the texts keeps is decided by a bitmap of fixed size, whose false
hits cost time only.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, discard, unpacked, whole_rows
from .components import min_labels

SHINGLE_WORDS = 5
PERCENT = 75
#: Rounds of a few pairs per class before the remaining pairs are checked, and
#: the pairs of a class in each. After the first, they end when no more than FEW_PAIRS times
#: as many pairs as bucket rows are left, and after the second, which picks otherwise, also when
#: more than WORTH of the pairs before are.
ROUNDS, PICKS, FEW_PAIRS, WORTH = 6, (3, 8), 4, 0.9
#: Classes of a bucket that one is compared with by their token maps, after the first round.
NEAREST = 16
#: Bits of the bitmap of surviving classes (16 MB); a fixed size.
BITMAP_BITS = 1 << 27
#: 64-bit words of a set's token map.
MAP_WORDS = 16
#: Text a task hashes at a time, and bytes of a word hashed without xxhash.
SLICE_BYTES, WORD_BYTES = 1 << 19, 64
#: Classes a task remembers.
CACHE_CLASSES = 100_000
BATCH_TOKENS = 1_000_000

# Odd multipliers of the shingle hash and the two finalizers.
_PLACE = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                                 0xA0761D6478BD642F)]
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_SECOND = np.uint64(0xC4CEB9FE1A85EC53)
# Bytes within words, masks of the first 0 to 8 bytes of a word, and a value for each length.
_IN_WORD = np.array([c not in b" \t\n\x0b\x0c\r" for c in range(256)])
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def _mix(h: np.ndarray, by: np.uint64 = _MIX) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * by
    h = (h ^ (h >> np.uint64(29))) * _PLACE[1]
    return h ^ (h >> np.uint64(32))


_LENGTHS = _mix(np.arange(WORD_BYTES + 1, dtype=np.uint64) * _PLACE[0])


class Shingler:
    """Sets of shingle hashes. Words are runs without space or \\t to \\r, A-Z in
    lower case; a text of fewer words than a shingle has its whole sequence as
    its one shingle."""

    def __init__(self, words: int = SHINGLE_WORDS):
        if not 1 <= words <= len(_PLACE):
            raise ValueError(f"shingles have 1 to {len(_PLACE)} words")
        self.k = words

    def sets(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Of each UTF-8 text its distinct tokens, ascending (that is hash
        order); a null text has none. Texts are hashed SLICE_BYTES at a time, a
        longer one by itself."""
        texts = texts.fill_null(b"").cast(pa.large_binary())
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        at = 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + SLICE_BYTES, "right")) - 1)
            yield from self._slice(texts.buffers()[2], ends[at:to + 1])
            at = to

    def _slice(self, data: pa.Buffer | None, ends: np.ndarray) -> Iterator[np.ndarray]:
        size = int(ends[-1] - ends[0])
        text = data.slice(int(ends[0]), size).to_pybytes().lower() if size else b""
        ends = ends - ends[0]
        starts, lengths = _word_spans(np.frombuffer(text, np.uint8), ends)
        h = _word_hashes(text, starts, lengths)
        shingles = np.zeros(max(0, len(h) - self.k + 1), np.uint64)
        for i in range(self.k):
            shingles += h[i:i + len(shingles)] * _PLACE[i]
        shingles = _mix(shingles)
        # The shingles that begin at a text's words, but for those that reach into the next text.
        first = np.searchsorted(starts, ends).tolist()
        for w, to in zip(first, first[1:]):
            if to - w >= self.k:
                own = np.sort(shingles[w:to - self.k + 1])
                new = np.ones(len(own), bool)
                np.not_equal(own[1:], own[:-1], out=new[1:])
                yield own[new]
            elif to > w:
                short = sum(int(x) * int(m) for x, m in zip(h[w:to], _PLACE)) + to - w
                yield _mix(np.array([short & 0xFFFFFFFFFFFFFFFF], np.uint64))
            else:
                yield np.zeros(0, np.uint64)


def _word_spans(text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the words of the texts that end at ``ends``; no
    word reaches from one text into the next."""
    inside = _IN_WORD[text]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edge = ends[(ends > 0) & (ends < len(text))]
    opens[edge] = inside[edge]
    closes[edge - 1] = inside[edge - 1]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1 - starts


def _word_hashes(text: bytes, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hashes of words, eight bytes at a time; the few words longer than
    WORD_BYTES by xxhash."""
    def eight(at: np.ndarray, left: np.ndarray) -> np.ndarray:
        return whole[at] & _FIRST_BYTES[np.minimum(left, 8)]

    # The eight bytes from each place on.
    whole = np.ndarray(len(text) + 1, "<u8", text + bytes(8), strides=(1,))
    h = _mix(eight(starts, lengths) ^ _LENGTHS[np.minimum(lengths, WORD_BYTES)])
    more = np.flatnonzero(lengths > 8)
    for done in range(8, WORD_BYTES, 8):
        h[more] = _mix(h[more] ^ (eight(starts[more] + done, lengths[more] - done) * _SECOND))
        more = more[lengths[more] > done + 8]
    for w in more:
        h[w] = xxhash.xxh3_64_intdigest(text[starts[w]:starts[w] + lengths[w]])
    return h


def class_id(tokens: np.ndarray) -> int:
    """64-bit id of a set, the same for equal sets."""
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def least_common(n: int, percent: int) -> int:
    """Tokens a set of ``n`` has in common with any set it links to, at least."""
    return -(-n * percent // 100)


def spare(n: int) -> int:
    """k of the hash-order filter for a set of ``n`` tokens."""
    return max(1, n // 4)


def hash_prefix(n: int, percent: int) -> int:
    return min(n, n - least_common(n, percent) + spare(n))


def least_shared(n: int, percent: int) -> int:
    """Hash-prefix tokens a set shares with any set it links to, at least: the
    smallest such set has ``least_common(n)`` tokens."""
    return spare(least_common(n, percent))


def token_map(tokens: np.ndarray) -> np.ndarray:
    """The tokens' low bits as a bitmap."""
    spots = np.zeros(64 * MAP_WORDS, np.uint8)
    spots[(tokens % np.uint64(64 * MAP_WORDS)).astype(np.int64)] = 1
    return np.packbits(spots, bitorder="little").view(np.uint64)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    flat = np.concatenate(arrays).view(np.int64) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("text").cast("binary").alias("text"))


def members(docs: DataFrame, words: int, hashed: bool = False) -> DataFrame:
    """(doc_id, cid, n) per row; cid is null for an empty set. If ``hashed``,
    also ``text_hash``, the xxhash64 of the text."""
    more = ["text_hash"] if hashed else []
    id_type = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for b in batches:
            sets = list(shingler.sets(b.column("text")))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([class_id(s) if len(s) else None for s in sets], pa.int64()),
                 pa.array([len(s) for s in sets], pa.int64()), *[b.column(c) for c in more]], names=["doc_id", "cid", "n", *more])

    read = docs.select("doc_id", F.col("text").cast("binary").alias("text"), *[F.xxhash64("text").alias(c) for c in more])
    return read.mapInArrow(run, f"doc_id {id_type.simpleString()}, cid long, n long" + "".join(f", {c} long" for c in more))


class _Recent:
    """Remembers the last classes a task has seen (a bounded number)."""

    def __init__(self, size: int = CACHE_CLASSES):
        self.size, self.ids = size, OrderedDict()

    def add(self, cid: int) -> bool:
        if cid in self.ids:
            self.ids.move_to_end(cid)
            return False
        self.ids[cid] = None
        if len(self.ids) > self.size:
            self.ids.popitem(last=False)
        return True


def prefix_tokens(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(cid, least, token): the hash-order prefix of each class, mostly once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, recent = Shingler(words), _Recent()
        for b in batches:
            held: list[tuple[int, int, np.ndarray]] = []
            size = 0
            for s in shingler.sets(b.column("text")):
                if len(s) and recent.add(cid := class_id(s)):
                    held.append((cid, least_shared(len(s), percent), s[:hash_prefix(len(s), percent)]))
                    size += len(held[-1][2])
                if size >= BATCH_TOKENS:
                    yield _prefix_batch(held)
                    held, size = [], 0
            if held:
                yield _prefix_batch(held)

    return _texts(docs).mapInArrow(run, "cid long, least int, tokens array<long>").select(
        "cid", "least", F.explode("tokens").alias("token"))


def _prefix_batch(held: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([h[0] for h in held], pa.int64()), pa.array([h[1] for h in held], pa.int32()),
         _lists([h[2] for h in held])], names=["cid", "least", "tokens"])


def sharing_classes(prefixes: DataFrame) -> DataFrame:
    """(cid): classes that share enough tokens of their hash prefix."""
    by_token = Window.partitionBy("token")
    shared = (prefixes.withColumn("low", F.min("cid").over(by_token)).withColumn("high", F.max("cid").over(by_token))
              .where(F.col("low") != F.col("high")))
    return (shared.groupBy("cid").agg(F.first("least").alias("least"), F.collect_set("token").alias("tokens"))
            .where(F.size("tokens") >= F.col("least")).select("cid"))


def rare_prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """(token, cid, n, pos): of each class that shares enough tokens, the
    shared ones of its prefix by (frequency, token). ``pos`` counts from 1 over
    the whole set; tokens that no other class has come first."""
    rows = sets.select("cid", "n", F.explode("tokens").alias("token"))
    df = F.count(F.lit(1)).over(Window.partitionBy("token"))
    shared = rows.withColumn("df", df).where("df > 1")
    ranked = shared.groupBy("cid", "n").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("ranked"))
    needed = F.ceil(F.col("n") * percent / F.lit(100)).cast("int")
    kept = ranked.where(F.size("ranked") >= needed)
    first = F.slice("ranked", F.lit(1), F.size("ranked") - needed + 1)
    return (kept.select("cid", "n", F.size("ranked").alias("s"), F.posexplode(first).alias("at", "x"))
            .select(F.col("x")["token"].alias("token"), "cid", "n", (F.col("n") - F.col("s") + F.col("at") + 1).alias("pos")))


def told_apart(buckets: DataFrame) -> DataFrame:
    """``buckets`` without tokens that say no more than another: of the tokens
    held by exactly the same classes, the first in the global order, which every
    class has before the others, stands for all (a passage that many documents
    share would else pair them once for each of its shingles)."""
    # 128 bits of the set of classes, as an aggregate without gathering them.
    same = [F.bit_xor(F.xxhash64("cid")).alias("s1"), F.bit_xor(F.xxhash64(F.lit(1), "cid")).alias("s2"), F.count(F.lit(1)).alias("n")]
    sets = buckets.groupBy("token").agg(*same, F.sum("pos").alias("place"))
    first = sets.groupBy("s1", "s2", "n").agg(F.min(F.struct("place", "token"))["token"].alias("token"))
    return buckets.join(first.select("token"), "token", "left_semi")


def class_bitmap(classes: DataFrame) -> bytes:
    """Bitmap of the low bits of the classes' ids: BITMAP_BITS / 8 bytes,
    however many classes there are."""
    spot = F.col("cid").bitwiseAND(F.lit(BITMAP_BITS - 1)) + 1
    parts = (classes.groupBy(F.bitmap_bucket_number(spot).alias("bucket"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position(spot)).alias("bits")).collect())
    out = bytearray(BITMAP_BITS // 8)
    for r in parts:
        out[(r["bucket"] - 1) * 4096:r["bucket"] * 4096] = r["bits"]
    return bytes(out)


def class_sets(docs: DataFrame, bitmap, words: int, percent: int) -> DataFrame:
    """(cid, n, tokens, second, bits): whole sets of the classes in the
    (broadcast) bitmap, one row a class, their plain prefix in the second hash
    order, and a map of the tokens' low bits (MAP_WORDS words)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, recent, bits = Shingler(words), _Recent(), bitmap.value
        for b in batches:
            held: list[tuple[int, np.ndarray, np.ndarray]] = []
            size = 0
            for s in shingler.sets(b.column("text")):
                if not len(s):
                    continue
                spot = (cid := class_id(s)) & (BITMAP_BITS - 1)
                if bits[spot >> 3] >> (spot & 7) & 1 and recent.add(cid):
                    second = s[np.argsort(_mix(s, _SECOND), kind="stable")[:len(s) - least_common(len(s), percent) + 1]]
                    held.append((cid, s, second))
                    size += len(s)
                if size >= BATCH_TOKENS:
                    yield _set_batch(held)
                    held, size = [], 0
            if held:
                yield _set_batch(held)

    return _texts(docs).mapInArrow(run, "cid long, n int, tokens array<long>, second array<long>, bits array<long>")


def _set_batch(held: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([h[0] for h in held], pa.int64()), pa.array([len(h[1]) for h in held], pa.int32()),
         _lists([h[1] for h in held]), _lists([h[2] for h in held]), _lists([token_map(h[1]) for h in held])],
        names=["cid", "n", "tokens", "second", "bits"])


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (x, y), with their components, those whose sets link."""
    left = sets.select(F.col("cid").alias("x"), F.col("n").alias("xn"), F.col("tokens").alias("xt"),
                       F.col("second").alias("xs"))
    right = sets.select(F.col("cid").alias("y"), F.col("n").alias("yn"), F.col("tokens").alias("yt"),
                        F.col("second").alias("ys"))
    both = pairs.join(left, "x").join(right, "y")
    common = F.size(F.array_intersect("xt", "yt"))
    union = F.col("xn") + F.col("yn") - common
    return (both.where(F.least("xn", "yn") * 100 >= F.greatest("xn", "yn") * percent)
            .where(F.arrays_overlap("xs", "ys"))
            .where(common * 100 >= union * percent).select("x", "y", "xc", "yc"))


def _needed(xn, yn, percent: int) -> Column:
    """Tokens that two sets of these sizes have in common if they link."""
    return F.ceil((xn + yn) * percent / F.lit(100 + percent))


def _may_link(xn, xpos, yn, ypos, percent: int):
    """Two sets can link with this as their first common token: they have
    similar sizes, and enough tokens from there on."""
    common = _needed(xn, yn, percent)
    return ((F.least(xn, yn) * 100 >= F.greatest(xn, yn) * percent)
            & (xpos <= xn - common + 1) & (ypos <= yn - common + 1))


def _cross(buckets: DataFrame) -> DataFrame:
    """Buckets that hold classes of different components."""
    w = Window.partitionBy("token")
    return (buckets.withColumn("_lo", F.min("comp").over(w)).withColumn("_hi", F.max("comp").over(w))
            .where(F.col("_lo") != F.col("_hi")).drop("_lo", "_hi"))


def _renamed(df: DataFrame, joined: DataFrame) -> DataFrame:
    """``df`` with each component's new name (node -> comp of ``joined``)."""
    new = joined.select(F.col("node").alias("comp"), F.col("comp").alias("_new"))
    return df.join(new, "comp", "left").withColumn("comp", F.coalesce("_new", "comp")).drop("_new")


def _some_pairs(buckets: DataFrame, sets: DataFrame, turn: int, percent: int) -> DataFrame:
    """Pairs: each class with at most PICKS others of different components. In
    each bucket of the first turn it meets the one that a hash of the turn,
    token and class puts first; later the one, of the NEAREST that this hash
    puts next, whose token map leaves room for the most tokens in common (most
    others of a group just miss the threshold then)."""
    order = Window.partitionBy("token").orderBy(F.xxhash64(F.lit(turn), "token", "cid"))
    if turn == 0:
        hub = F.first(F.struct("cid", "comp", "n", "pos")).over(
            order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        met = (buckets.withColumn("h", hub).where(F.col("comp") != F.col("h")["comp"])
               .where(_may_link(F.col("n"), F.col("pos"), F.col("h")["n"], F.col("h")["pos"], percent))
               .select("cid", "comp", F.xxhash64(F.lit(turn), F.col("h")["cid"]).alias("h"), F.col("h")["cid"].alias("hub"),
                       F.col("h")["comp"].alias("hub_comp")))
    else:
        def room(h: Column) -> Column:
            common = _bits_set(lambda i: F.col("bits")[i].bitwiseAND(h["bits"][i])) + F.least(F.col("extra"), h["extra"])
            return common - _needed(F.col("n"), h["n"], percent)
        following = F.collect_list(F.struct("cid", "comp", "n", "pos", "bits", "extra")).over(order.rowsBetween(1, NEAREST))
        apart = F.filter("following", lambda h: (h["comp"] != F.col("comp"))
                         & _may_link(F.col("n"), F.col("pos"), h["n"], h["pos"], percent))
        best = F.array_min(F.transform(apart, lambda h: F.struct(
            (-room(h)).alias("h"), h["cid"].alias("hub"), h["comp"].alias("hub_comp"))))
        met = (_mapped(buckets, sets).withColumn("following", following).withColumn("best", best)
               .where(F.col("best")["h"] <= 0).select("cid", "comp", "best.*"))
    hubs = met.groupBy("cid", "comp").agg(F.sort_array(F.collect_set(F.struct("h", "hub", "hub_comp"))).alias("hubs"))
    each = hubs.select("cid", "comp", F.explode(F.slice("hubs", 1, PICKS[min(turn, len(PICKS) - 1)])).alias("p"))
    hub = F.col("p")
    swap = F.col("cid") > hub["hub"]
    return each.select(F.when(swap, hub["hub"]).otherwise(F.col("cid")).alias("x"),
                       F.when(swap, F.col("cid")).otherwise(hub["hub"]).alias("y"),
                       F.when(swap, hub["hub_comp"]).otherwise(F.col("comp")).alias("xc"),
                       F.when(swap, F.col("comp")).otherwise(hub["hub_comp"]).alias("yc")).distinct()


def _bits_set(word) -> Column:
    """Bits set in all words of a map; ``word`` gives the i-th."""
    counts = [F.bit_count(word(i)) for i in range(MAP_WORDS)]
    return sum(counts[1:], counts[0])


def _mapped(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """``rows`` with the token maps of their classes, and the tokens of the set
    that add no bit of their own."""
    return (rows.join(sets.select("cid", "bits"), "cid")
            .withColumn("extra", F.col("n") - _bits_set(lambda i: F.col("bits")[i])))


def _remaining(buckets: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All pairs between components that can link: by their places, and by the
    token maps of their whole sets. A bit that the other set's map lacks stands
    for a token at least that it lacks, so two sets have no more in common than
    the bits in common and the tokens that add no bit of their own (``extra``).

    A pair is made once, at the first token its classes share: the places are
    bounds for that token, and each row has its class's ``earlier`` ones. The
    smaller set of a pair (by size, then id) shares that token within a shorter
    prefix (the larger has its size at least), so only those rows are one side.
    The condition is kept short: Java never compiles a method of over 8000
    bytes, and would interpret it for every pair."""
    places = F.sort_array(F.collect_list(F.struct("pos", "token")))
    mapped = _mapped(buckets.groupBy("cid", "comp", "n").agg(places.alias("places")), sets)
    rows = mapped.select("*", F.posexplode("places").alias("at", "place")).select(
        F.col("place")["token"].alias("token"), F.col("place")["pos"].alias("pos"), "cid", "comp", "n", "bits", "extra",
        F.slice(F.col("places")["token"], F.lit(1), F.col("at")).alias("earlier"))

    def side(c: str) -> DataFrame:
        return rows.select("token", F.col("cid").alias(c), F.col("comp").alias(f"{c}c"), F.col("n").alias(f"{c}n"),
                           F.col("pos").alias(f"{c}pos"), F.col("bits").alias(f"{c}bits"), F.col("extra").alias(f"{c}extra"),
                           F.col("earlier").alias(f"{c}earlier"))
    smaller = (F.col("xn") < F.col("yn")) | ((F.col("xn") == F.col("yn")) & (F.col("x") < F.col("y")))
    fits = _may_link(F.col("xn"), F.col("xpos"), F.col("yn"), F.col("ypos"), percent)
    needed = _needed(F.col("xn"), F.col("yn"), percent)
    enough = _bits_set(lambda i: F.col("xbits")[i].bitwiseAND(F.col("ybits")[i])) + F.least("xextra", "yextra") >= needed
    least = side("x").where(F.col("xpos") <= F.col("xn") - _needed(F.col("xn"), F.col("xn"), percent) + 1)
    return (least.join(side("y"), "token")
            .where(smaller & (F.col("xc") != F.col("yc")) & fits & enough & ~F.arrays_overlap("xearlier", "yearlier"))
            .select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"),
                    F.when(F.col("x") < F.col("y"), F.col("xc")).otherwise(F.col("yc")).alias("xc"),
                    F.when(F.col("x") < F.col("y"), F.col("yc")).otherwise(F.col("xc")).alias("yc")))


def _pairs_left(buckets: DataFrame) -> tuple[int, int]:
    """Rows of the buckets, and pairs that ``_remaining`` would form."""
    sizes = buckets.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("m"))
    pairs = sizes.groupBy("token").agg(F.sum("m").alias("n"), F.sum(F.col("m") * F.col("m")).alias("own"))
    r = pairs.agg(F.sum("n"), F.sum((F.col("n") * F.col("n") - F.col("own")) / 2)).first()
    return int(r[0] or 0), int(r[1] or 0)


def class_components(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(cid, comp) of the classes that link with others."""
    spark = docs.sparkSession
    sharing = cut(sharing_classes(prefix_tokens(docs, words, percent)), "ngram-sharing")
    bitmap = spark.sparkContext.broadcast(class_bitmap(sharing))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sets = class_sets(docs, bitmap, words, percent).repartition(parts, "cid").dropDuplicates(["cid"]).persist()
    try:
        prefixes = cut(rare_prefixes(sets, percent), "ngram-prefixes")
        held = cut(told_apart(prefixes), "ngram-told-apart")
        discard(prefixes)
        buckets, joined = held.withColumn("comp", F.col("cid")), None
        named = labels = cut(buckets.select("cid", "comp").distinct(), "ngram-labels")
        before = 0
        for turn in range(ROUNDS + 1):
            crossing = cut(_cross(buckets), "ngram-buckets")
            discard(held)
            buckets = held = crossing
            rows, left = _pairs_left(buckets)
            last = turn == ROUNDS or turn > 0 and left <= FEW_PAIRS * rows or turn > 1 and left > before * WORTH
            before = left
            pairs = _remaining(buckets, sets, percent) if last else _some_pairs(buckets, sets, turn, percent)
            # Links between components, and the components these join.
            links = cut(verified(pairs, sets, percent).select(
                F.least("xc", "yc").alias("x"), F.greatest("xc", "yc").alias("y")).distinct(), "ngram-links")
            discard(joined)
            joined = cut(min_labels(links), "ngram-joined")
            labels = cut(_renamed(labels, joined), "ngram-labels")
            # What this round has replaced; its buckets go when the next one's are written.
            discard(named, links)
            named = labels
            if last:
                discard(held, joined, sharing)
                return labels
            buckets = _renamed(buckets, joined)
    finally:
        sets.unpersist()
        bitmap.unpersist()


def ngram_jaccard_join(docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles`` (distinct shingles of the whole
    text) and ``component_id``, the smallest id reachable over links, its own
    included. Two documents link when 100 times the size of the intersection of
    their sets is ``percent`` times that of the union or more.

    A null or empty text has no shingles and links with nothing; neither do
    classes that have only null ids, and a null id without a link keeps a null
    component. Repeated rows each give a row; rows that share an id but not a
    text are documents of their own. Other columns are not read. Exact but for
    collisions of 64-bit hashes.
    """
    return _joined(docs, words, percent).select("doc_id", "n_shingles", "component_id")


def _joined(docs: DataFrame, words: int, percent: int, hashed: bool = False) -> DataFrame:
    rows = cut(members(docs, words, hashed), "ngram-members")
    classes = rows.where(F.col("cid").isNotNull()).groupBy("cid").agg(F.min("doc_id").alias("rep"))
    named = classes.join(class_components(docs, words, percent), "cid", "left")
    linked = named.where(F.col("comp").isNotNull())
    least = linked.groupBy("comp").agg(F.min("rep").alias("found"))
    ids = (linked.join(least, "comp").select("cid", "found")
           .unionByName(named.where(F.col("comp").isNull()).select("cid", F.col("rep").alias("found"))))
    return rows.join(ids, "cid", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("found", "doc_id").alias("component_id"),
        *(["text_hash"] if hashed else []))


def keep_one_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each linked group, that of the smallest
    id; of repeated rows one stays. Rows with a null id stay, and so do rows
    that share only the id with one that goes. Null and empty texts link with
    nothing and stay; an empty table gives an empty one. All columns stay,
    whatever their names."""
    others = cut(_joined(docs, SHINGLE_WORDS, PERCENT, hashed=True).where(F.col("component_id") != F.col("doc_id")).select(
        F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")).distinct(), "ngram-others")
    rows = docs.select(whole_rows(docs).alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"))
    left = rows.join(others, ["id", "hash"], "left_anti")
    again = F.row_number().over(Window.partitionBy("id", "hash").orderBy("id"))
    return left.withColumn("again", again).where((F.col("again") == 1) | F.col("id").isNull()).select(*unpacked(docs))
