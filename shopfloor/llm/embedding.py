"""Operator 2: near-duplicate vectors by cross-polytope hashing after fast Hadamard rotations.

A vector is rotated by three rounds of random signs and the fast Hadamard
transform; the signed axis nearest to it is its hash.  A table's key joins
``k`` such hashes, and every vector enters its best ``2**k`` keys (multiprobe).
``k`` follows from the number of vectors: keys are to outnumber them.  The number
of tables follows from ``k`` and the dimension: trial pairs at the limit, hashed
by the same code, give a table's chance to find one, and there are so many tables
(``TABLES`` at least) that all miss it with an estimated chance of at most ``MISS``.

Bucket rows carry the id and 128 random-projection sign bits, not the vector;
bits that differ far more than a cosine of 0.9 allows (six standard deviations) stop a
candidate, all others are confirmed on the full vectors in double precision.
Equal vectors are one class before hashing.  Links lie within the components
that the confirmed candidates span, so the numbers of links are then counted exactly
inside each component by matrix products: a task holds a stripe of the component, the
others stream past it, and no pairs are written.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.llm.buckets import bucket_components, bucket_members, one_node
from shopfloor.llm.common import Scratch, arrow_batches, table
from shopfloor.llm.wordhash import U, mix

COSINE = 0.9
TABLES = 8  # at least
MISS = 1e-4  # chance that a pair at the limit shares no key, at every size and dimension
TRIALS = 1000  # pairs, in each of the first TABLES tables
SKETCH = 128
ROUNDS = 3
BLOCK = 1024
STRIPE_BYTES = 64 << 20  # vectors that a task holds
SEED = 11


def hash_count(vectors: int, dim: int) -> int:
    """Hashes in a key: the fewest for which ``dim ** k`` is at least four times the vectors, and two at least."""
    k = 2
    while max(dim, 2) ** k < 4 * vectors:
        k += 1
    return k


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows (a power of two long), length preserving."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def rotate(x: np.ndarray, seed: list[int]) -> np.ndarray:
    rng = np.random.default_rng(seed)
    for _ in range(ROUNDS):
        x = hadamard(x * rng.choice([-1.0, 1.0], x.shape[1]))
    return x


def probe_keys(unit: np.ndarray, table_no: int, k: int) -> np.ndarray:
    """The best ``2**k`` keys of each row in one table; alternatives are ranked by how much of the axis they give up."""
    choices = min(3, 2 * unit.shape[1])
    codes, losses = [], []
    for i in range(k):
        turned = rotate(unit, [SEED, table_no, i, unit.shape[1]])
        both = np.concatenate([turned, -turned], axis=1)
        best = np.argpartition(-both, choices - 1, axis=1)[:, :choices] if both.shape[1] > choices else np.tile(
            np.arange(both.shape[1]), (len(both), 1))
        value = np.take_along_axis(both, best, axis=1)
        order = np.argsort(-value, axis=1, kind="stable")
        codes.append(np.take_along_axis(best, order, axis=1).astype(U))
        value = np.take_along_axis(value, order, axis=1)
        losses.append(value[:, :1] - value)
    combos = sorted(itertools.product(range(codes[0].shape[1]), repeat=k), key=lambda c: (sum(c), c))
    combos = [c for c in combos if sum(c) <= k + 1]
    loss = np.stack([sum(losses[i][:, c[i]] for i in range(k)) for c in combos], axis=1)
    kept = np.argsort(loss, axis=1, kind="stable")[:, :2 ** k]
    keys = []
    for c in combos:
        key = np.full(len(unit), (table_no << 24) | unit.shape[1], U)
        for i in range(k):
            key = mix(key * U(0x9E3779B97F4A7C15) + codes[i][:, c[i]] + U(1))
        keys.append(key)
    return np.take_along_axis(np.stack(keys, axis=1), kept, axis=1).view(np.int64)


@functools.cache
def table_count(dim: int, k: int, least: float = COSINE, tables: int = TABLES) -> int:
    """Tables for which a pair at ``least`` is missed with a chance of at most ``MISS``, and ``tables`` at least.

    The chance of one table is taken three standard errors below its share of the trials.
    """
    if dim < 2:
        return tables
    rng = np.random.default_rng([SEED, dim, k])
    x, z = rng.normal(size=(2, TRIALS, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    cosine = min(max(least, -1.0), 1.0)
    x, y = unit_rows(x, dim), unit_rows(cosine * x + np.sqrt(1 - cosine ** 2) * z, dim)
    both = (np.sort(np.concatenate([probe_keys(x, t, k), probe_keys(y, t, k)], axis=1)) for t in range(TABLES))
    met = np.concatenate([(keys[:, 1:] == keys[:, :-1]).any(axis=1) for keys in both])
    found = max(met.mean() - 3 * np.sqrt(met.mean() * (1 - met.mean()) / len(met)), 1 / len(met))
    return tables if found >= 1 else max(tables, int(np.ceil(np.log(MISS) / np.log1p(-found))))


def sketches(unit: np.ndarray) -> np.ndarray:
    """128 random-projection signs of each row as two longs."""
    planes = np.random.default_rng([SEED, unit.shape[1]]).normal(size=(unit.shape[1], SKETCH))
    bits = np.packbits(unit @ planes > 0, axis=1, bitorder="little")
    return bits.view(np.int64)


def _matrix(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lengths, and the values of all lists one after the other as doubles."""
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return lengths, lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)


def unit_rows(x: np.ndarray, dim: int) -> np.ndarray:
    """Rows of length one, filled with zeros to a power of two."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    wide = 1 << max(dim - 1, 0).bit_length()
    return np.pad(x, ((0, 0), (0, wide - dim)))


def _keys(tables: dict[int, int], vectors: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                lengths, flat = _matrix(part.column(1))
                starts = np.cumsum(lengths) - lengths
                for dim in np.unique(lengths).tolist():
                    rows = np.flatnonzero(lengths == dim)
                    unit = unit_rows(flat[starts[rows][:, None] + np.arange(dim)], dim)
                    s = sketches(unit)
                    k = hash_count(vectors, dim)
                    keys = np.concatenate([probe_keys(unit, t, k) for t in range(tables[dim])], axis=1)
                    each = pa.array(np.arange(len(rows) + 1) * keys.shape[1], pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(pa.array(rows)), pa.array(s[:, 0]), pa.array(s[:, 1]),
                         pa.ListArray.from_arrays(each, pa.array(keys.ravel()))], names=["rep", "s0", "s1", "keys"])
    return run


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x, y) / np.sqrt(np.einsum("ij,ij->i", x, x) * np.einsum("ij,ij->i", y, y))


def _confirm(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            la, fa = _matrix(batch.column("va"))
            lb, fb = _matrix(batch.column("vb"))
            keep = np.zeros(batch.num_rows, bool)
            sa, sb = np.cumsum(la) - la, np.cumsum(lb) - lb
            for dim in np.unique(la[la == lb]).tolist():
                rows = np.flatnonzero((la == dim) & (lb == dim))
                place = np.arange(dim)
                keep[rows] = cosines(scaled(fa[sa[rows][:, None] + place]), scaled(fb[sb[rows][:, None] + place])) >= least
            yield batch.select(["a", "b"]).filter(pa.array(keep))
    return run


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows divided by a power of two near their largest value, so that squares neither vanish nor overflow."""
    return x / np.exp2(np.floor(np.log2(np.abs(x).max(axis=1, keepdims=True))))


def _count_links(least: float):
    """Links of rows with the vectors of a stripe: a stripe's own rows come first, then all rows of its component."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, {}
        for batch in batches:
            component, stripe = batch.column("component").to_numpy(), batch.column("stripe").to_numpy()
            asked = batch.column("asked").to_numpy(zero_copy_only=False).astype(np.int8)
            new = (np.diff(component) != 0) | (np.diff(stripe) != 0) | (np.diff(asked) != 0)
            cuts = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if at != (component[a], stripe[a]):
                    at, held = (component[a], stripe[a]), {}
                lengths, flat = _matrix(part.column("v"))
                starts = np.cumsum(lengths) - lengths
                rep, copies = part.column("rep").to_numpy(), part.column("copies").to_numpy()
                found = np.zeros(part.num_rows, np.int64)
                for dim in np.unique(lengths).tolist():
                    rows = np.flatnonzero(lengths == dim)
                    x = scaled(flat[starts[rows][:, None] + np.arange(dim)])
                    norm = np.sqrt(np.einsum("ij,ij->i", x, x))
                    if not asked[a]:
                        held.setdefault(dim, []).extend(
                            (x[i:i + BLOCK], norm[i:i + BLOCK], rep[rows[i:i + BLOCK]], copies[rows[i:i + BLOCK]])
                            for i in range(0, len(rows), BLOCK))
                        continue
                    for y, y_norm, y_rep, weight in held.get(dim, []):
                        alike = (x @ y.T) / (norm[:, None] * y_norm[None, :]) >= least
                        alike &= rep[rows][:, None] != y_rep[None, :]
                        found[rows] += alike @ weight
                if asked[a]:
                    yield pa.RecordBatch.from_arrays([part.column("rep"), pa.array(found)], names=["rep", "links"])
    return run


def counted_links(scratch: Scratch, reps: DataFrame, labels: DataFrame, least: float) -> DataFrame:
    """``(rep, links)``: linked vectors, copies counted, of every vector of a component.

    A component is cut into stripes of at most STRIPE_BYTES, and into more while
    there are idle tasks; a task holds one stripe and the component streams past it.
    """
    at_once = int(scratch.spark.conf.get("spark.sql.shuffle.partitions"))
    inside = scratch.save(reps.join(labels.withColumnRenamed("node", "rep"), "rep"), "inside")
    size = inside.groupBy("component").agg(F.sum(8 * F.size("v")).alias("b"), F.count("*").alias("n"))
    stripes = F.greatest(F.ceil(F.col("b") / F.lit(STRIPE_BYTES)), F.least(F.ceil(F.col("n") / F.lit(4 * BLOCK)), F.lit(at_once)))
    striped = inside.join(size.select("component", stripes.cast("long").alias("stripes")), "component")
    own = striped.select("component", F.pmod(F.xxhash64("rep"), "stripes").alias("stripe"), F.lit(False).alias("asked"),
                         "rep", "copies", "v")
    asked = striped.select("component", F.explode(F.sequence(F.lit(0).cast("long"), F.col("stripes") - 1)).alias("stripe"),
                           F.lit(True).alias("asked"), "rep", "copies", "v")
    both = own.unionByName(asked).repartition("component", "stripe").sortWithinPartitions("component", "stripe", "asked")
    with arrow_batches(scratch.spark, BLOCK):
        found = scratch.save(both.mapInArrow(_count_links(least), "rep long, links long"), "counted")
    links = scratch.save(found.groupBy("rep").agg(F.sum("links").alias("links")), "counts")
    scratch.drop(inside, found)
    return links


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = COSINE,
                 tables: int = TABLES) -> DataFrame:
    """``(id, links, component)`` for every row of ``vectors``.

    Vectors that are null, empty, zero or hold null or non-finite components
    are linked with nothing, and so are rows with a null id (their component
    is null).  Vectors of different lengths are never linked.  Rows that repeat
    an id are vectors of their own in one component, whatever their values.
    Other columns are not read; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "vectors")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    good = F.coalesce(
        F.col("id").isNotNull() & (F.size("v") > 0)
        & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
        & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = scratch.save(rows.select("id", F.when(good, F.col("v")).alias("v"),
                                    F.when(good, F.xxhash64("v", F.lit(1))).alias("k1"),
                                    F.when(good, F.xxhash64("v", F.lit(2))).alias("k2"),
                                    F.monotonically_increasing_id().alias("node")), "rows")
    usable = rows.where("v IS NOT NULL")
    # One class per distinct vector, named by its first row.
    classes = usable.groupBy("k1", "k2").agg(F.min(F.struct("id", "node")).alias("first"), F.count("*").alias("copies"))
    classes = scratch.save(classes.select("k1", "k2", F.col("first.id").alias("id"), F.col("first.node").alias("rep"), "copies"),
                           "classes")
    reps = usable.select(F.col("node").alias("rep"), "v").join(classes.select("rep", "copies"), "rep")
    reps = scratch.save(reps, "reps")
    several = usable.groupBy("id").agg(F.min("k1").alias("a1"), F.max("k1").alias("z1"), F.min("k2").alias("a2"),
                                       F.max("k2").alias("z2")).where("a1 < z1 OR a2 < z2").select("id")
    known = scratch.save(one_node(usable.select("id", "k1", "k2").join(several, "id").join(
        classes.select("k1", "k2", F.col("rep").alias("node")), ["k1", "k2"]).select("id", "node")), "one_id")
    count = classes.count()
    dims = [r["d"] for r in reps.select(F.size("v").alias("d")).distinct().collect()]  # one row per vector length
    per_dim = {d: table_count(1 << max(d - 1, 0).bit_length(), hash_count(count, d), least, tables)
               for d in dims}  # vectors are filled to a power of two before they are hashed
    hashed = reps.select("rep", "v").mapInArrow(_keys(per_dim, count),
                                                "rep long, s0 long, s1 long, keys array<long>")
    keyed = scratch.save(hashed.select("rep", "s0", "s1", F.explode("keys").alias("key")), "keyed")
    members = bucket_members(scratch, keyed)
    scratch.drop(keyed)
    angle = np.arccos(min(least, 1.0)) / np.pi
    most = int(np.ceil(SKETCH * angle + 6 * np.sqrt(SKETCH * angle * (1 - angle)))) + 1

    def plausible():
        return F.bit_count(F.col("s0").bitwiseXOR(F.col("x_s0"))) + F.bit_count(
            F.col("s1").bitwiseXOR(F.col("x_s1"))) <= most

    def confirmed(pairs: DataFrame) -> DataFrame:
        at_b = pairs.join(reps.select(F.col("rep").alias("b"), F.col("v").alias("vb")), "b")
        both = at_b.join(reps.select(F.col("rep").alias("a"), F.col("v").alias("va")), "a")
        return both.select("a", "b", "va", "vb").mapInArrow(_confirm(least), "a long, b long")

    labels = bucket_components(scratch, members, ["s0", "s1"], plausible, confirmed, known=known)
    links = counted_links(scratch, reps, labels, least)
    named = classes.join(links, "rep", "left").join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "k1", "k2", "id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
        F.coalesce("component", "rep").alias("part"))
    named = scratch.save(named, "components")
    least_id = named.groupBy("part").agg(F.min("id").alias("component"))
    named = scratch.save(named.drop("id").join(least_id, "part").drop("part"), "named")
    scratch.drop(members, labels, links, reps)
    linked = usable.select("id", "k1", "k2").join(named, ["k1", "k2"]).select("id", "links", "component")
    bare = rows.where("v IS NULL").select("id")
    others = linked.join(bare.distinct(), "id", "left_semi").groupBy(F.col("id").alias("_id")).agg(
        F.min("component").alias("_other"))  # vectors without links, in the component of their id's other rows
    alone = bare.join(others, F.col("id") == F.col("_id"), "left").select(
        "id", F.lit(0).cast("long").alias("links"), F.coalesce("_other", "id").alias("component"))
    return linked.unionByName(alone)


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings")).select(
        F.col("id").alias("vec_id"), F.col("links").alias("n_links"), F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))
