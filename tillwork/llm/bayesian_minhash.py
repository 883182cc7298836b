"""Near-duplicate documents by MinHash, with sequential Bayesian verification.

1. Each document is a set of word shingles; documents with the same set are one class, found by a
   digest of the set. A class has a MinHash signature, cut into bands.
2. Classes with an equal band are members of a bucket. Instead of all pairs of a bucket, its pivots
   meet its members: one pivot in the first round, four times as many in each further one. Members
   that are connected already do not meet, a pivot that has met all is done, and a bucket whose
   members are connected is done, so that a group of near copies costs its size. Nor do members
   meet that cannot link: their common part is at most what either shares with any candidate,
   which is counted beforehand. Members that the first round leaves are compared more closely: what
   they share with others that are left is counted anew and marked in a map of ``MAP_BITS`` bits, and
   every bit that only one of two maps has stands for a shingle that only one of the sets has. For
   sets far larger than the map this excludes less; it never excludes a link.
3. A candidate pair's signatures are compared batch by batch. With m of n values equal and a uniform
   prior, the similarity reaches the threshold with the probability that at most m of n + 1 trials
   succeed; pairs for which that falls below ``MISS`` go.
4. Survivors are verified on their full sets, and verified links connect components.

Misses: two sets as similar as the threshold share no band with probability
(1 - t^ROWS)^BANDS, 1e-6 at 0.8, and less the more similar they are; ``MISS`` adds as much.

Scale: only buckets that two classes share are kept, counted by a combined minimum and maximum.
Sets are made again for candidate classes alone; long ones are cut into fragments by their hashes.
Joins on hot buckets and pivots are written before anything is grouped, so that Spark splits them.
The driver sees sums. Shingles are known by 64 bits.

Edge cases: a null or empty text has no shingles, links with nothing and is its own component.
With fewer words than n, the whole text is one shingle. Repeated rows are rows of one class, each
with its result; null ids take part and never are a component's smallest id, unless it has no
other. Other columns are not read. Texts are read whole. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwork.llm.components import components, stored
from tillwork.llm.encoding import starts_of
from tillwork.llm.positional_index import document_key
from tillwork.llm.vertical_join import STEP, digests, gram_sets
from tillwork.llm.words import mixed, slices

BANDS, ROWS = 75, 8
COMPARED, BATCH = 256, 32  # signature values kept for the comparison, and compared at once
MISS = 1e-6
BLOCK = 65_536  # shingles hashed at once
FRAGMENT = 32_768  # shingles of a set that are verified in one row
MAP_LONGS = 16
MAP_BITS = 64 * MAP_LONGS

SIGNED = (
    "key struct<doc_id:long,text:long>, n_shingles long, class long, check long, "
    "bands array<long>, signature binary"
)
PARTS = "class long, fragment long, bits int, grams array<long>"


def _constants(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors and summands of the hash functions, the same in every task."""
    seeds = mixed(np.arange(1, 2 * count + 1, dtype=np.uint64) * STEP)
    values = (seeds >> np.uint64(32)).astype(np.uint32)
    return values[:count] | np.uint32(1), values[count:]


def signatures(sizes: np.ndarray, grams: np.ndarray, count: int) -> np.ndarray:
    """``count`` smallest hash values of each set, a row for each; sets are not empty."""
    factors, summands = _constants(count)
    out = np.empty((len(sizes), count), np.uint32)
    values = (grams >> np.uint64(32)).astype(np.uint32)
    ends = np.cumsum(sizes)
    low = 0
    while low < len(sizes):
        first = ends[low] - sizes[low]
        high = max(low + 1, int(np.searchsorted(ends, first + BLOCK, side="right")))
        part = values[first : ends[high - 1]]
        starts = starts_of(sizes[low:high])
        held = np.empty_like(part)
        for k in range(count):
            np.multiply(part, factors[k], out=held)
            np.add(held, summands[k], out=held)
            out[low:high, k] = np.minimum.reduceat(held, starts)
        low = high
    return out


def band_keys(found: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band of each signature."""
    keys = np.tile(np.arange(bands, dtype=np.uint64), (len(found), 1))
    cut = found[:, : bands * rows].reshape(len(found), bands, rows)
    for k in range(rows):
        keys = mixed(keys * STEP + cut[:, :, k])
    return keys.view(np.int64)


def _signed(n: int, bands: int, rows: int):
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for batch in batches:
            for part in slices(batch):
                sizes, grams = gram_sets(part.column("text"), n)
                classes, checks = digests(sizes, grams)
                fresh = np.zeros(len(sizes), bool)
                for row, (name, size) in enumerate(zip(classes.tolist(), sizes.tolist())):
                    if size and name not in sent:
                        sent.add(name)
                        fresh[row] = True
                own = signatures(sizes[fresh], grams[np.repeat(fresh, sizes)], max(bands * rows, COMPARED))
                keys = band_keys(own, bands, rows)
                offsets = np.append(0, np.cumsum(np.where(fresh, bands, 0))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel()))
                short = own[:, :COMPARED].astype("<u2")
                texts = iter(short)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("key"),
                        pa.array(sizes),
                        pa.array(classes),
                        pa.array(checks),
                        lists,
                        pa.array([next(texts).tobytes() if f else None for f in fresh.tolist()], pa.binary()),
                    ],
                    names=["key", "n_shingles", "class", "check", "bands", "signature"],
                )

    return made


def least_matches(percent: int, miss: float, count: int = COMPARED, batch: int = BATCH) -> list[int]:
    """For each number of compared values, the fewest equal ones with which the probability that
    the similarity reaches the threshold is not below ``miss``."""
    t, out = percent / 100, []
    for n in range(batch, count + 1, batch):
        below, m = 0.0, -1
        while below < miss:
            m += 1
            below += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return out


def _plausible(least: list[int]):
    """Pairs whose signatures pass every comparison; a pair that fails one is not compared on."""

    def left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, COMPARED)
                for c in ("of_a", "of_b")
            )
            alive = np.arange(len(a))
            equal = np.zeros(len(a), np.int64)
            for k, needed in enumerate(least):
                part = slice(k * BATCH, (k + 1) * BATCH)
                equal[alive] += (a[alive, part] == b[alive, part]).sum(axis=1)
                alive = alive[equal[alive] >= needed]
            yield batch.select(["a", "b", "n_a", "n_b"]).take(pa.array(alive))

    return left


def _bits(n: int) -> int:
    """How many leading bits of their hashes cut a set of n shingles into fragments."""
    return max(0, int(n - 1).bit_length() - FRAGMENT.bit_length() + 1)


def _fragments(n: int):
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for batch in batches:
            for part in slices(batch):
                sizes, grams = gram_sets(part.column("text"), n)
                for name, own in zip(part.column("class").to_pylist(), np.split(grams, np.cumsum(sizes)[:-1])):
                    if name in sent or not len(own):
                        continue
                    sent.add(name)
                    bits = _bits(len(own))
                    cell = (own >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(own), np.int64)
                    heads = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
                    lists = pa.ListArray.from_arrays(
                        pa.array(np.append(heads, len(own)).astype(np.int32)), pa.array(own.view(np.int64))
                    )
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(heads), name)),
                            pa.array(cell[heads]),
                            pa.array(np.full(len(heads), bits, np.int32)),
                            lists,
                        ],
                        names=["class", "fragment", "bits", "grams"],
                    )

    return made


def _verified(pairs: DataFrame, signs: DataFrame, parts: DataFrame, percent: int, miss: float) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    of_a = signs.select(F.col("class").alias("a"), F.col("signature").alias("of_a"))
    of_b = signs.select(F.col("class").alias("b"), F.col("signature").alias("of_b"))
    plausible = stored(
        pairs.join(of_a, "a")
        .join(of_b, "b")
        .mapInArrow(_plausible(least_matches(percent, miss)), "a long, b long, n_a long, n_b long"),
        "plausible",
    )
    left, right = (
        parts.select(F.col("class").alias(c), *(F.col(x).alias(f"{x}_{c}") for x in ("fragment", "bits", "grams")))
        for c in "ab"
    )
    fewer = F.least("bits_a", "bits_b")
    same_cell = F.expr("shiftright(fragment_a, bits_a - least(bits_a, bits_b))") == F.expr(
        "shiftright(fragment_b, bits_b - least(bits_a, bits_b))"
    )
    both = F.size(F.array_intersect("grams_a", "grams_b")).cast("long").alias("both")
    overlaps = stored(
        plausible.join(left, "a").join(right, "b").where(same_cell & (fewer >= 0)).select("a", "b", "n_a", "n_b", both),
        "overlaps",
    )
    total = overlaps.groupBy("a", "b", "n_a", "n_b").agg(F.sum("both").alias("both"))
    union = F.col("n_a") + F.col("n_b") - F.col("both")
    return total.where(F.col("both") * 100 >= union * percent).select("a", "b")


def _members(signed: DataFrame) -> DataFrame:
    """(bucket, class, n) for buckets that several classes share."""
    spread = signed.where(F.col("signature").isNotNull()).select(
        F.explode("bands").alias("bucket"), "class", F.col("n_shingles").alias("n")
    )
    several = stored(
        spread.groupBy("bucket")
        .agg(F.min("class").alias("low"), F.max("class").alias("high"))
        .where("low <> high")
        .select("bucket"),
        "buckets",
    )
    return stored(spread.join(several, "bucket"), "held").distinct()


def _can_link(n, shared, other, percent: int):
    """Whether a set of n, of which ``shared`` are in other sets, can link with one of ``other``."""
    return shared * (100 + percent) >= (n + other) * percent


def _weighed(members: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """Members with ``shared``, how many of a class' shingles other candidates have, and ``weight``,
    the number of its buckets: it is largest for the text that others were made from. Members that
    can link with none of their bucket go."""
    shared = _shared(parts).groupBy("class").agg(F.count("*").alias("shared"))
    weights = members.groupBy("class").agg(F.count("*").alias("weight"))
    counted = stored(weights.join(shared, "class"), "counted")
    named = stored(members.join(counted, "class"), "weighed")
    return _live(named, percent)


def _shared(parts: DataFrame) -> DataFrame:
    """(gram, class) for shingles that several classes of ``parts`` have."""
    single = parts.select("class", F.explode("grams").alias("gram"))
    often = stored(
        single.groupBy("gram")
        .agg(F.min("class").alias("low"), F.max("class").alias("high"))
        .where("low <> high")
        .select("gram"),
        "often",
    )
    return single.join(often, "gram")


def _mapped(members: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """Members with ``shared`` counted among themselves alone, and ``bits``, which of ``MAP_BITS``
    bits these shingles fall on."""
    left = stored(members.select("class").distinct(), "left")
    place = F.col("gram").bitwiseAND(MAP_BITS - 1)
    marked = _shared(parts.join(left, "class", "left_semi")).select(
        "class",
        F.floor(place / 64).cast("int").alias("slot"),
        F.expr(f"shiftleft(1L, cast((gram & {MAP_BITS - 1}) % 64 as int))").alias("bit"),
    )
    longs = [
        F.coalesce(F.bit_or(F.when(F.col("slot") == k, F.col("bit"))), F.lit(0).cast("long")).alias(f"b{k}")
        for k in range(MAP_LONGS)
    ]
    counted = stored(marked.groupBy("class").agg(F.count("*").alias("shared"), *longs), "maps").select(
        "class", "shared", F.struct(*[f"b{k}" for k in range(MAP_LONGS)]).alias("bits")
    )
    return _live(stored(members.drop("shared").join(counted, "class"), "mapped"), percent)


def _both_at_most(x_shared, y_shared, x_bits, y_bits):
    """No more shingles than this are in both of two sets, by their maps."""
    lone = sum((F.bit_count(x_bits[f"b{k}"].bitwiseXOR(y_bits[f"b{k}"])) for k in range(MAP_LONGS)), F.lit(0))
    return F.floor((x_shared + y_shared - lone) / 2)


def _live(members: DataFrame, percent: int) -> DataFrame:
    """Members of buckets with several labels that can link with the smallest set there."""
    buckets = stored(
        members.groupBy("bucket")
        .agg(F.min("n").alias("least"), F.min("label").alias("low"), F.max("label").alias("high"))
        .where("low <> high")
        .select("bucket", "least"),
        "open",
    )
    able = _can_link(F.col("n"), F.col("shared"), F.col("least"), percent)
    return stored(members.join(buckets, "bucket").where(able).drop("least"), "live")


def _candidates(members: DataFrame, tested: DataFrame, pivots: int, percent: int) -> DataFrame:
    """New pairs (a, b) of pivots and members that are not connected yet. Two pivots meet once: the
    one that comes first is the pivot of the pair."""
    first = Window.partitionBy("bucket").orderBy(F.desc("weight"), "class")
    chosen = stored(
        members.withColumn("place", F.row_number().over(first))
        .where(F.col("place") <= pivots)
        .select("bucket", *(F.col(c).alias(f"p_{c}") for c in members.columns if c != "bucket")),
        "pivots",
    )
    size = F.least("n", "p_n") * 100 >= F.greatest("n", "p_n") * percent
    forward = F.col("class") < F.col("p_class")
    common = F.least("shared", "p_shared")
    if "bits" in members.columns:
        common = F.least(common, _both_at_most(*(F.col(c) for c in ("shared", "p_shared", "bits", "p_bits"))))
    able = _can_link(F.col("n"), common, F.col("p_n"), percent)
    later = (F.col("weight") < F.col("p_weight")) | (
        (F.col("weight") == F.col("p_weight")) & (F.col("class") > F.col("p_class"))
    )
    met = members.join(chosen, "bucket").where((F.col("label") != F.col("p_label")) & later & size & able)
    return (
        met.select(
            F.least("class", "p_class").alias("a"),
            F.greatest("class", "p_class").alias("b"),
            F.when(forward, F.col("n")).otherwise(F.col("p_n")).alias("n_a"),
            F.when(forward, F.col("p_n")).otherwise(F.col("n")).alias("n_b"),
        )
        .distinct()
        .join(tested, ["a", "b"], "left_anti")
    )


def _unfinished(members: DataFrame, labels: DataFrame, pivots: int, percent: int) -> DataFrame:
    """Members with their new labels, without pivots that have met all, of buckets that are not
    connected."""
    first = Window.partitionBy("bucket").orderBy(F.desc("weight"), "class")
    left = members.withColumn("place", F.row_number().over(first)).where(F.col("place") > pivots)
    named = (
        left.drop("place", "label")
        .join(labels.withColumnRenamed("node", "class"), "class", "left")
        .withColumn("label", F.coalesce("label", "class"))
    )
    return _live(stored(named, "labelled"), percent)


def near_duplicates(
    docs: DataFrame, n: int = 4, percent: int = 80, bands: int = BANDS, rows: int = ROWS, miss: float = MISS
) -> DataFrame:
    """``key`` (id and text hash), ``n_shingles``, ``class_id`` (smallest id with the same set)
    and ``component_id`` (smallest id that links reach) for every row of ``docs``.

    Two documents link when their sets' intersection has at least ``percent`` hundredths of the
    size of their union.
    """
    texts = docs.select(document_key(docs).alias("key"), "text")
    signed = stored(texts.mapInArrow(_signed(n, bands, rows), SIGNED), "signed")
    classes = stored(
        signed.where("n_shingles > 0").groupBy("class", "check").agg(F.min("key.doc_id").alias("class_id")), "classes"
    )
    members = stored(_members(signed).withColumn("label", F.col("class")), "members")
    wanted = stored(members.select("class").distinct(), "wanted")
    chosen = stored(
        signed.where(F.col("signature").isNotNull())
        .join(wanted, "class")
        .groupBy("class")
        .agg(F.first("signature").alias("signature"), F.min("key").alias("key")),
        "signs",
    )
    parts = stored(
        texts.join(chosen.select("class", "key"), "key")
        .select("class", "text")
        .mapInArrow(_fragments(n), PARTS)
        .dropDuplicates(["class", "fragment"]),
        "parts",
    )
    spark = docs.sparkSession
    members = _weighed(members, parts, percent)
    links = tested = spark.createDataFrame([], "a long, b long")
    labels = spark.createDataFrame([], "node long, label long")
    pivots = 1
    while not members.isEmpty():
        pairs = stored(_candidates(members, tested, pivots, percent), "pairs")
        found = stored(_verified(pairs, chosen, parts, percent, miss), "found")
        tested = stored(tested.unionByName(pairs.select("a", "b")), "tested")
        if not found.isEmpty():
            links = stored(links.unionByName(found), "links")
            labels = stored(components(links), "labels")
        members = _unfinished(members, labels, pivots, percent)
        if pivots == 1:
            members = _mapped(members, parts, percent)
        pivots *= 4
    named = classes.join(labels, F.col("class") == F.col("node"), "left").select(
        "class", "check", "class_id", F.coalesce("label", "class").alias("label")
    )
    least = stored(named.groupBy("label").agg(F.min("class_id").alias("component_id")), "least")
    named = stored(named.join(least, "label").select("class", "check", "class_id", "component_id"), "named")
    own = F.col("key.doc_id")
    has_set = F.col("n_shingles") > 0
    return signed.select("key", "n_shingles", "class", "check").join(named, ["class", "check"], "left").select(
        "key",
        "n_shingles",
        F.when(has_set, F.col("component_id")).otherwise(own).alias("component_id"),
        F.when(has_set, F.col("class_id")).otherwise(own).alias("class_id"),
    )
