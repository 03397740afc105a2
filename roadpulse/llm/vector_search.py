"""Approximate nearest neighbours by cross-polytope hashing.

Vectors are split by norm into octaves (powers of two). In each they are scaled
by its largest norm and extended by one coordinate so that the largest inner
product becomes the nearest direction; a few long vectors thus do not drown the
others in that coordinate. They are turned by fast pseudo-rotations (random
signs, then a Hadamard transform, three times). The nearest signed axis is the
hash; a table's code joins the hashes of its rotations. A query probes the
best codes of each table in every octave; the vectors found there are ranked by
their exact inner product in double precision. Where there are several octaves,
one of few vectors is met whole: its members may be near by their length alone,
in directions that probes miss.

Tables are joined bucket by bucket. A bucket, on either side, is split into
parts of bounded size, so common vectors and codes spread over many tasks, and
only the best of each part leave it. Queries that find fewer than wanted are
searched against all vectors, in parts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, FloatType, LongType,
                               StructField, StructType)

from .common import cut, let

#: Tables, fewest codes probed per table, rotations per code, neighbours wanted.
TABLES, PROBES, ROTATIONS, K = 16, 16, 1, 20
#: Share of a table's codes to probe, up to each dimension: the more dimensions,
#: the less a random direction's neighbours stand out. Measured for a recall of
#: 0.9 at 20 with 16 tables on random directions, the hardest case.
PROBED = ((256, 1 / 16), (1024, 1 / 12), (None, 1 / 8))
SEED = 20250101
#: Vectors of an octave that is met whole, at most, where a dimension has several.
FEW_VECTORS = 1024
#: Vectors and queries that meet in one task at a time, at most about.
PART_VECTORS, PART_QUERIES = 4096, 1024
_BLOCK_CELLS = 1_000_000


def hadamard(a: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row (a power of two columns)."""
    n, d = a.shape
    h = 1
    while h < d:
        pairs = a.reshape(n, d // (2 * h), 2, h)
        a = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return a / np.sqrt(d)


def probes_for(dim: int) -> int:
    """Codes to probe per table for vectors of a dimension: a share of the
    2 * 2^ceil(log2(dim + 1)) signed axes, PROBES at least."""
    share = next(s for most, s in PROBED if most is None or dim <= most)
    return max(PROBES, math.ceil(share * 2 * (1 << int(dim).bit_length())))


class CrossPolytope:
    """Codes of vectors of one dimension."""

    def __init__(self, dim: int, tables: int = TABLES, rotations: int = ROTATIONS, seed: int = SEED):
        self.width = 1 << int(dim).bit_length()  # room for one more coordinate
        if (2 * self.width) ** rotations >= 1 << 62:
            raise ValueError("too many rotations for this dimension")
        rng = np.random.default_rng([seed, dim])
        self.signs = rng.choice([-1.0, 1.0], size=(tables, rotations, 3, self.width))

    def extended(self, vectors: np.ndarray, extra: np.ndarray) -> np.ndarray:
        out = np.zeros((len(vectors), self.width))
        out[:, :vectors.shape[1]] = vectors
        out[:, vectors.shape[1]] = extra
        return out

    def nearness(self, x: np.ndarray, table: int, rotation: int) -> np.ndarray:
        """Inner product of the turned rows with each signed axis."""
        for signs in self.signs[table, rotation]:
            x = hadamard(x * signs)
        return np.concatenate([x, -x], axis=1)

    def codes(self, x: np.ndarray) -> np.ndarray:
        """(rows, tables) codes."""
        out = np.zeros((len(x), len(self.signs)), np.int64)
        for t in range(out.shape[1]):
            for r in range(self.signs.shape[1]):
                out[:, t] = out[:, t] * (2 * self.width) + self.nearness(x, t, r).argmax(axis=1)
        return out

    def probes(self, x: np.ndarray, count: int) -> np.ndarray:
        """(rows, tables, count) best codes of each table, -1 where there are fewer."""
        out = np.full((len(x), len(self.signs), count), -1, np.int64)
        for t in range(out.shape[1]):
            code, score = np.zeros((len(x), 1), np.int64), np.zeros((len(x), 1))
            for r in range(self.signs.shape[1]):
                near = self.nearness(x, t, r)
                axis = np.argsort(-near, axis=1, kind="stable")[:, :count]
                near = np.take_along_axis(near, axis, axis=1)
                total = (score[:, :, None] + near[:, None, :]).reshape(len(x), -1)
                joint = (code[:, :, None] * (2 * self.width) + axis[:, None, :]).reshape(len(x), -1)
                best = np.argsort(-total, axis=1, kind="stable")[:, :count]
                code, score = np.take_along_axis(joint, best, axis=1), np.take_along_axis(total, best, axis=1)
            out[:, t, :code.shape[1]] = code
        return out


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v, dim): vectors that are not null, empty or zero and hold only
    finite components, with an id."""
    kind = vectors.schema[vec_col].dataType
    if not isinstance(kind, ArrayType):
        raise TypeError(f"{vec_col} must be an array")
    v = F.col(vec_col)
    if not isinstance(kind.elementType, (FloatType, DoubleType)):
        v = v.cast("array<double>")
    fine = F.forall(v, lambda x: F.coalesce((x == x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return (vectors.select(F.col(id_col).alias("id"), v.alias("v"))
            .where(F.col("id").isNotNull() & F.col("v").isNotNull())
            .where(F.coalesce(fine, F.lit(False)) & F.exists("v", lambda x: x != 0))
            .withColumn("dim", F.size("v")))


def _magnitude(v: str) -> Column:
    """log2 of the norm, also of components whose squares leave the doubles."""
    big = F.array_max(F.transform(v, lambda x: F.abs(x.cast("double"))))
    return let(big, lambda b: F.log2(b) + F.log2(F.aggregate(
        v, F.lit(0.0), lambda a, x: a + (x.cast("double") / b) * (x.cast("double") / b))) / 2)


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _coded(vectors: DataFrame, probes: int | None, tables: int, rotations: int, seed: int) -> DataFrame:
    """``codes`` per vector, scaled by 2^-``top``: one per table, or the probes
    of all tables (0: as many as the dimension asks for)."""
    code = ArrayType(LongType())
    schema = StructType([*vectors.schema.fields, StructField("codes", ArrayType(code) if probes is not None else code)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes: dict[int, CrossPolytope] = {}
        for b in batches:
            dims = b.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = b.filter(pa.array(dims == dim))
                h = hashes.setdefault(int(dim), CrossPolytope(int(dim), tables, rotations, seed))
                half = np.exp2(-part.column("top").to_numpy() / 2)[:, None]  # twice, as 2^-top may leave the doubles
                x = _matrix(part.column("v"), int(dim)) * half * half
                norm = np.sqrt((x * x).sum(axis=1))
                if probes is not None:
                    count = probes or probes_for(int(dim))
                    codes = h.probes(h.extended(x / np.maximum(norm, 1e-300)[:, None], np.zeros(len(x))), count).tolist()
                    codes = [[[c for c in t if c >= 0] for t in row] for row in codes]
                    kind = pa.list_(pa.list_(pa.int64()))
                else:
                    codes = h.codes(h.extended(x, np.sqrt(np.maximum(0.0, 1.0 - norm * norm)))).tolist()
                    kind = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(codes, kind)],
                                                 names=[*part.schema.names, "codes"])

    return vectors.mapInArrow(run, schema)


def _best(k: int):
    """Of each query and the vectors of its part: the ``k`` nearest."""
    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(vectors) and len(queries):
            dim = vectors.column("dim")[0].as_py()
            ids = vectors.column("id").to_numpy()
            order = np.argsort(ids, kind="stable")  # then ties go to smaller ids
            ids, v = ids[order], _matrix(vectors.column("v"), dim)[order]
            once, first = np.unique(ids, return_index=True)  # rows of an id are in one part
            qids, q = queries.column("id").to_numpy(), _matrix(queries.column("v"), dim)
            step = max(1, _BLOCK_CELLS // v.size)
            for at in range(0, len(q), step):
                score = (v[None, :, :] * q[at:at + step, None, :]).sum(axis=2)
                if len(once) < len(ids):
                    score = np.maximum.reduceat(score, first, axis=1)
                own = once[None, :] == qids[at:at + step, None]
                near = np.argsort(np.where(own, np.inf, -score), axis=1, kind="stable")[:, :k]
                kept = ~np.take_along_axis(own, near, axis=1)
                rows = np.broadcast_to(qids[at:at + step, None], near.shape)
                out.append((rows[kept], once[near][kept], np.take_along_axis(score, near, axis=1)[kept]))
        cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
        return pa.table({"query_id": pa.array(cols[0], pa.int64()), "vec_id": pa.array(cols[1], pa.int64()),
                         "score": pa.array(cols[2], pa.float64())})
    return run


def _meet(vectors: DataFrame, queries: DataFrame, keys: list[str], k: int) -> DataFrame:
    """Nearest of the vectors and queries that share the keys, in parts."""
    def sizes(df: DataFrame, name: str, part: int) -> DataFrame:
        return df.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / F.lit(part)).cast("int").alias(name))

    both = cut(sizes(vectors, "vp", PART_VECTORS).join(sizes(queries, "qp", PART_QUERIES), keys), "ann-parts")

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        mine = F.pmod(F.xxhash64("id"), F.col(own)).cast("int").alias(f"{own}_no")
        return df.join(both, keys).select(*keys, "id", "v", mine,
                                          F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(f"{other}_no"))

    by = [*keys, "vp_no", "qp_no"]
    return (dealt(vectors, "vp", "qp").groupBy(*by).cogroup(dealt(queries, "qp", "vp").groupBy(*by))
            .applyInArrow(_best(k), "query_id long, vec_id long, score double"))


def _ranked(found: DataFrame, k: int) -> DataFrame:
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (once.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, tables: int = TABLES, probes: int | None = None,
            rotations: int = ROTATIONS, seed: int = SEED, id_col: str = "vec_id",
            vec_col: str = "embedding") -> DataFrame:
    """The ``k`` nearest found of each row of ``queries`` (of the same columns)
    among all ``vectors`` but those of its id: ``query_id``, ``rank`` (from 1),
    ``vec_id``, ``score``, the inner product in double precision; ties go to
    the smaller id. All candidates come back if there are fewer than ``k``.
    ``probes``: codes per table, by default ``probes_for`` the dimension.

    Vectors that are null, empty, zero or hold null or non-finite components,
    and null ids, take no part; vectors of different dimensions do not meet.
    Rows that share an id count as one (its best score); other columns are not
    read.
    """
    all_rows = usable(vectors, id_col, vec_col).withColumn("id", F.col("id").cast("long"))
    asked = usable(queries, id_col, vec_col).withColumn("id", F.col("id").cast("long"))
    # Doubles have some 2,100 octaves, so this table is small and can be broadcast.
    placed = all_rows.withColumn("mag", _magnitude("v")).withColumn("octave", F.round("mag").cast("int"))
    octaves = placed.groupBy("dim", "octave").agg(F.max("mag").alias("top"), F.count(F.lit(1)).alias("n"))
    several = F.count(F.lit(1)).over(Window.partitionBy("dim")) > 1
    octaves = cut(octaves.select("dim", "octave", "top", (several & (F.col("n") <= FEW_VECTORS)).alias("whole")), "ann-octaves")
    whole = F.lit(-1).cast("long")  # the one code of an octave that is met whole
    index = _coded(placed.drop("mag").join(F.broadcast(octaves), ["dim", "octave"]), None, tables, rotations, seed).select(
        "id", "v", "dim", "octave", F.posexplode(F.when(F.col("whole"), F.array(whole)).otherwise(F.col("codes")))
        .alias("tab", "code"))
    probed = _coded(asked.withColumn("top", _magnitude("v")), probes or 0, tables, rotations, seed).drop("top").join(
        F.broadcast(octaves), "dim").select("id", "v", "dim", "octave", F.posexplode(
            F.when(F.col("whole"), F.array(F.array(whole))).otherwise(F.col("codes"))).alias("tab", "several")).select(
        "id", "v", "dim", "octave", "tab", F.explode("several").alias("code"))
    found = cut(_ranked(_meet(index, probed, ["dim", "octave", "tab", "code"], k), k), "ann-found")
    counts = found.groupBy(F.col("query_id").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    short = cut(asked.join(counts, "id", "left").where(F.coalesce("n", F.lit(0)) < k).select("id", "v", "dim"), "ann-short")
    if short.isEmpty():
        return found
    exact = _ranked(_meet(all_rows, short, ["dim"], k), k)
    return found.join(short.select(F.col("id").alias("query_id")).distinct(), "query_id", "left_anti").unionByName(exact)

