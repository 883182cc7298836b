"""Similarity join of documents on word n-grams, by vertical partitioning.

All distinct n-grams of the corpus, ordered by their hash, are cut into fragments. A task of one
fragment sees the part of every document that falls into it and nothing else; what the fragments
count is summed for each document, and later for each pair.

1. Documents with the same n-gram set are one class, found by a digest of the set.
2. Fragments find the n-grams that at least two classes have, and count them for each class. A
   class linked with another shares at least 0.8 of its n-grams, so that the sums leave only
   near copies; passages that many documents quote do not get further.
3. Among these, n-grams are ordered from rare to frequent. Linked classes share one of the first
   n - ceil(0.8 n) + 1, of which those that occur once need no index.
4. Pairs from that index are verified by the sum of their fragments' overlaps. For components it
   is enough to link each class with the centre of its index entries; pairs that would only link
   what is linked already are not formed. Centres are tried first, and then all pairs of index
   entries whose classes lie in different components and whose overlap can still be large enough:
   each fragment marks the bits of its n-grams in a map of ``MAP_BITS`` bits, and every bit that only
   one of two maps has stands for an n-gram that only one of the sets has. For sets far larger than
   the map this bound excludes less; it never excludes a link.

Scale: a fragment holds about ``FRAGMENT`` n-grams, so their number grows with the corpus; near copies
are verified in groups of fragments, whose number follows the longest set. What is grouped by n-gram is
stored before it meets the entries again, so that Spark splits a hot n-gram. An
n-gram is sent to its fragment at most once for each slice of text, however many documents have
it: those that several documents of a slice share are known to be shared there and go on without
their fragment. A class that copies make frequent is sent once by each task. Nothing but totals
reaches the driver.

n-grams are known by 40 bits and their fragment; with a fragment of 2 million n-grams a chance
match has a probability of 2e-6 for an n-gram and far less for a pair's verdict.

Edge cases: a null or empty text has no n-grams, links with nothing and is its own component.
With fewer words than n, the whole text is one n-gram. Repeated rows are rows of one class, each
with its result; null ids take part and never are a component's smallest id, unless it has no
other. Other columns are not read. Long texts are read whole. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwork.llm.components import components, stored
from tillwork.llm.encoding import starts_of, summed
from tillwork.llm.positional_index import document_key
from tillwork.llm.words import ascii_words, filled, mixed, slices, word_hashes

FRAGMENT = 2_000_000
LEAST_FRAGMENTS = 64
LEAST_SLABS, SLAB = 4, 32_768  # fragments are verified in groups; n-grams of a set in one, on average
LOW_BITS = 40
MAP_LONGS = 16
MAP_BITS = 64 * MAP_LONGS
STEP = np.uint64(0x9E3779B97F4A7C15)


def gram_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Size of each text's set of word n-grams, and the sets' hashes, sorted within each text."""
    counts, words, codes = ascii_words(pc.ascii_lower(filled(texts)))
    hashes = word_hashes(words)[codes]
    starts = starts_of(counts)
    rolled = np.zeros(max(len(hashes) - n + 1, 0), np.uint64)
    for k in range(n):
        rolled = rolled * STEP + hashes[k : k + len(rolled)]
    rolled = mixed(rolled)
    sets = []
    for start, count in zip(starts.tolist(), counts.tolist()):
        if count >= n:
            own = np.sort(rolled[start : start + count - n + 1])
            sets.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        elif count:
            whole = np.full(1, count, np.uint64)
            for word in hashes[start : start + count]:
                whole = whole * STEP + word
            sets.append(mixed(whole + STEP))
        else:
            sets.append(np.zeros(0, np.uint64))
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    return sizes, np.concatenate(sets) if sets else np.zeros(0, np.uint64)


def digests(sizes: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each set that do not depend on its order."""
    sums = summed(mixed(grams + STEP), sizes)
    more = summed(mixed(grams ^ STEP), sizes)
    return mixed(sums + sizes.astype(np.uint64)).view(np.int64), mixed(more).view(np.int64)


def _sets(n: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sizes, grams = gram_sets(part.column("text"), n)
                first, second = digests(sizes, grams)
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(sizes), pa.array(first), pa.array(second)],
                    names=["key", "n_shingles", "class", "check"],
                )

    return rows


PARTS = (
    "fragment int, lane int, classes binary, counts binary, lows binary, marks binary"
)
SHARED = "class long, fragment int, grams array<long>"


def _packed(lows: np.ndarray) -> bytes:
    return lows.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : LOW_BITS // 8].tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    narrow = np.frombuffer(data, np.uint8).reshape(-1, LOW_BITS // 8)
    wide = np.zeros((len(narrow), 8), np.uint8)
    wide[:, : LOW_BITS // 8] = narrow
    return wide.view("<u8").ravel()


def _runs(values: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values."""
    if not len(values):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))


def _fragmented(n: int, fragments: int):
    """Rows for each slice of text and fragment.

    Lane 0 goes to the fragment's task: n-grams that one class of the slice has, by class, and
    the marks of those that several have. The other lanes carry the latter with their classes.
    """
    low_mask = np.uint64((1 << LOW_BITS) - 1)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for batch in batches:
            for part in slices(batch):
                sizes, grams = gram_sets(part.column("text"), n)
                classes, _ = digests(sizes, grams)
                fresh = np.zeros(len(sizes), bool)
                for row, (name, size) in enumerate(zip(classes.tolist(), sizes.tolist())):
                    if size and name not in sent:
                        sent.add(name)
                        fresh[row] = True
                keep = np.repeat(fresh, sizes)
                grams = grams[keep]
                owner = np.repeat(classes, sizes)[keep]
                cell = ((grams >> np.uint64(LOW_BITS)) * np.uint64(fragments)) >> np.uint64(64 - LOW_BITS)
                low = grams & low_mask
                order = np.argsort(cell << np.uint64(LOW_BITS) | low, kind="stable")
                ids = (cell << np.uint64(LOW_BITS) | low)[order]
                heads = _runs(ids)
                many = np.diff(np.append(heads, len(ids))) > 1
                shared = np.zeros(len(ids), bool)
                shared[order] = np.repeat(many, np.diff(np.append(heads, len(ids))))
                marks = ids[heads[many]]
                yield from _lane(cell, low, owner, ~shared, marks, 0)
                lane = 1 + int(abs(int(owner[0])) % 1_000_000) if len(owner) else 1
                yield from _lane(cell, low, owner, shared, marks[:0], lane)

    return rows


def _lane(cell, low, owner, keep, marks, lane) -> Iterator[pa.RecordBatch]:
    cell, low, owner = cell[keep].astype(np.int64), low[keep], owner[keep]
    order = np.argsort(cell, kind="stable")
    cell, low, owner = cell[order], low[order], owner[order]
    mark_cells = (marks >> np.uint64(LOW_BITS)).astype(np.int64)
    mark_lows = marks & np.uint64((1 << LOW_BITS) - 1)
    names = np.union1d(np.unique(cell), np.unique(mark_cells))
    bounds = np.searchsorted(cell, np.append(names, np.iinfo(np.int64).max))
    mark_bounds = np.searchsorted(mark_cells, np.append(names, np.iinfo(np.int64).max))
    columns: list[list] = [[] for _ in range(6)]
    for k, name in enumerate(names.tolist()):
        a, b = bounds[k], bounds[k + 1]
        heads = _runs(owner[a:b])
        counts = np.diff(np.append(heads, b - a)).astype("<u4")
        values = (
            name,
            lane,
            owner[a:b][heads].astype("<i8").tobytes(),
            counts.tobytes(),
            _packed(low[a:b]),
            _packed(mark_lows[mark_bounds[k] : mark_bounds[k + 1]]),
        )
        for column, value in zip(columns, values):
            column.append(value)
    kinds = (pa.int32(), pa.int32(), *(pa.binary(),) * 4)
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)],
        names=["fragment", "lane", "classes", "counts", "lows", "marks"],
    )


def _shared_of_fragment(key: tuple, rows: pa.Table) -> pa.Table:
    """The n-grams of one fragment that two classes or more have, by class."""
    fragment, lane = key[0].as_py(), key[1].as_py()
    joined = {c: b"".join(rows.column(c).to_pylist()) for c in ("classes", "counts", "lows", "marks")}
    owner = np.repeat(np.frombuffer(joined["classes"], "<i8"), np.frombuffer(joined["counts"], "<u4"))
    low = _unpacked(joined["lows"])
    if lane == 0:
        order = np.lexsort((owner, low))
        low, owner = low[order], owner[order]
        once = np.ones(len(low), bool)
        once[1:] = (low[1:] != low[:-1]) | (owner[1:] != owner[:-1])
        low, owner = low[once], owner[once]
        heads = _runs(low)
        lengths = np.diff(np.append(heads, len(low)))
        marked = np.isin(low[heads], _unpacked(joined["marks"]))
        keep = np.repeat((lengths > 1) | marked, lengths)
        low, owner = low[keep], owner[keep]
    order = np.argsort(owner, kind="stable")
    low, owner = low[order], owner[order]
    heads = _runs(owner)
    grams = (np.uint64(fragment) << np.uint64(LOW_BITS) | low).view(np.int64)
    offsets = np.append(heads, len(owner)).astype(np.int32)
    return pa.table(
        {
            "class": pa.array(owner[heads], pa.int64()),
            "fragment": pa.array(np.full(len(heads), fragment, np.int32)),
            "grams": pa.ListArray.from_arrays(pa.array(offsets), pa.array(grams)),
        }
    )


def _needed(n, percent: int):
    """ceil(percent / 100 * n): the overlap that a link of a set of n takes at least."""
    return F.floor((n * percent + 99) / 100).cast("long")


def _verified(pairs: DataFrame, parts: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link: overlaps counted by fragment, summed by pair."""
    left = parts.select(F.col("class").alias("a"), "fragment", F.col("grams").alias("left"))
    right = parts.select(F.col("class").alias("b"), "fragment", F.col("grams").alias("right"))
    overlaps = (
        pairs.join(left, "a")
        .join(right, ["b", "fragment"])
        .groupBy("a", "b")
        .agg(F.sum(F.size(F.array_intersect("left", "right"))).alias("both"))
    )
    size_a = sizes.select(F.col("class").alias("a"), F.col("n").alias("size_a"))
    size_b = sizes.select(F.col("class").alias("b"), F.col("n").alias("size_b"))
    union = F.col("size_a") + F.col("size_b") - F.col("both")
    return (
        overlaps.join(size_a, "a")
        .join(size_b, "b")
        .where(F.col("both") * 100 >= union * percent)
        .select("a", "b")
    )


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose classes are not known to be connected."""
    of_a = labels.select(F.col("node").alias("a"), F.col("label").alias("label_a"))
    of_b = labels.select(F.col("node").alias("b"), F.col("label").alias("label_b"))
    return (
        pairs.join(of_a, "a", "left")
        .join(of_b, "b", "left")
        .where(F.coalesce("label_a", "a") != F.coalesce("label_b", "b"))
        .select("a", "b")
    )


def _in_reach(pairs: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes allow a link."""
    size_a = sizes.select(F.col("class").alias("a"), F.col("n").alias("size_a"))
    size_b = sizes.select(F.col("class").alias("b"), F.col("n").alias("size_b"))
    low, high = F.least("size_a", "size_b"), F.greatest("size_a", "size_b")
    return (
        pairs.join(size_a, "a").join(size_b, "b").where(low * 100 >= high * percent).select("a", "b")
    )


def _bit_maps(parts: DataFrame) -> DataFrame:
    """``class`` and ``bits``: which of ``MAP_BITS`` bits its shared n-grams fall on, by fragment and
    then for the class."""
    place = F.pmod(F.xxhash64("gram"), F.lit(MAP_BITS)).cast("int")
    marked = parts.select("class", F.explode("grams").alias("gram")).select(
        "class",
        F.floor(place / 64).cast("int").alias("slot"),
        F.expr(f"shiftleft(1L, cast(pmod(xxhash64(gram), {MAP_BITS}) % 64 as int))").alias("bit"),
    )
    longs = [
        F.coalesce(F.bit_or(F.when(F.col("slot") == k, F.col("bit"))), F.lit(0).cast("long")).alias(f"b{k}")
        for k in range(MAP_LONGS)
    ]
    return marked.groupBy("class").agg(*longs).select(
        "class", F.struct(*[f"b{k}" for k in range(MAP_LONGS)]).alias("bits")
    )


def _class_labels(index: DataFrame, parts: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Components of classes, from links between index neighbours."""
    centres = stored(
        index.groupBy("gram")
        .agg(F.max(F.struct("weight", "class")).alias("top"), F.count("*").alias("classes"))
        .where("classes > 1")
        .select("gram", F.col("top.class").alias("centre")),
        "centres",
    )
    spokes = stored(
        index.join(centres, "gram")
        .where(F.col("class") != F.col("centre"))
        .groupBy(F.col("class").alias("a"), F.col("centre").alias("b"))
        .agg(F.count("*").alias("votes")),
        "spokes",
    )
    best = spokes.groupBy("a").agg(F.max(F.struct("votes", "b")).alias("top")).select("a", "top.b")
    links = stored(_verified(_in_reach(_ordered(best), sizes, percent), parts, sizes, percent), "star")
    labels = stored(components(links), "labels")

    more = _in_reach(_apart(_ordered(spokes), labels), sizes, percent)
    links = stored(links.union(_verified(more, parts, sizes, percent)), "star")
    labels = stored(components(links), "labels")

    pairs = _ordered(_pairs_apart(index, labels, parts, percent))
    links = stored(links.union(_verified(pairs, parts, sizes, percent)), "star")
    return stored(components(links), "labels")


def _pairs_apart(index: DataFrame, labels: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """Index neighbours in different components that can still link.

    In each gram's group, the members outside its largest component meet all members of other
    components; the largest one does not meet itself. Of two sets that link, the common part is
    at least percent / (100 + percent) of both sizes together. It is at most what either shares
    with anyone, and, seen from a common gram, the ranks up to it in one set and the rest behind it
    in the other. Nor is it more than half of what both share with others without the bits that
    only one of their maps has.
    """
    named = stored(
        index.join(labels, F.col("class") == F.col("node"), "left").select(
            "gram", "class", F.coalesce("label", "class").alias("label"), "rank", "shared", "n"
        ),
        "named",
    )
    largest = (
        named.groupBy("gram", "label")
        .agg(F.count("*").alias("members"))
        .groupBy("gram")
        .agg(F.max(F.struct("members", "label"))["label"].alias("top"), F.count("*").alias("labels"))
        .where("labels > 1")
        .select("gram", "top")
    )
    mixed_groups = stored(named.join(stored(largest, "largest"), "gram"), "mixed")
    few = mixed_groups.select("class").distinct()
    maps = stored(_bit_maps(parts.join(few, "class", "left_semi")), "maps")
    mixed_groups = mixed_groups.join(maps, "class")
    fields = F.struct("class", "label", "rank", "shared", "n", "bits")
    outside = mixed_groups.where("label <> top").select("gram", fields.alias("x"))
    inside = mixed_groups.select("gram", fields.alias("y"))
    x, y = F.col("x"), F.col("y")
    lone = sum(
        (F.bit_count(x["bits"][f"b{k}"].bitwiseXOR(y["bits"][f"b{k}"])) for k in range(MAP_LONGS)), F.lit(0)
    )
    common = F.least(
        x["shared"],
        y["shared"],
        F.least(x["rank"], y["rank"]) + F.least(x["shared"] - x["rank"], y["shared"] - y["rank"]),
        F.floor((x["shared"] + y["shared"] - lone) / 2),
    )
    possible = (
        (x["label"] != y["label"])
        & (F.least(x["n"], y["n"]) * 100 >= F.greatest(x["n"], y["n"]) * percent)
        & (common * (100 + percent) >= (x["n"] + y["n"]) * percent)
    )
    joined = outside.alias("o").join(inside.alias("i"), (F.col("o.gram") == F.col("i.gram")) & possible)
    return joined.select(x["class"].alias("a"), y["class"].alias("b"))


def join(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``key`` (id and text hash), ``n_shingles``, ``class_id`` (smallest id with the same set)
    and ``component_id`` (smallest id that links reach) for every row of ``docs``.

    Two documents link when their sets' intersection has at least ``percent`` hundredths of the
    size of their union.
    """
    texts = docs.select(document_key(docs).alias("key"), "text")
    sets = stored(
        texts.mapInArrow(
            _sets(n),
            "key struct<doc_id:long,text:long>, n_shingles long, class long, check long",
        ),
        "sets",
    )
    classes = stored(
        sets.where("n_shingles > 0")
        .groupBy("class", "check")
        .agg(F.min("key.doc_id").alias("class_id"), F.first("n_shingles").alias("n")),
        "classes",
    )
    total = classes.agg(F.sum("n")).first()[0] or 0
    fragments = max(LEAST_FRAGMENTS, -(-total // FRAGMENT))
    shared = stored(
        texts.mapInArrow(_fragmented(n, fragments), PARTS)
        .groupBy("fragment", "lane")
        .applyInArrow(_shared_of_fragment, SHARED),
        "shared",
    )
    sizes = stored(
        shared.groupBy("class")
        .agg(F.sum(F.size("grams")).alias("shared"))
        .join(classes.select("class", "n"), "class")
        .where(F.col("shared") >= _needed(F.col("n"), percent))
        .select("class", "n"),
        "sizes",
    )
    longest = sizes.agg(F.max("n")).first()[0] or 0
    slabs = min(fragments, max(LEAST_SLABS, -(-longest // SLAB)))
    parts = stored(
        shared.join(sizes, "class")
        .select("class", (F.col("fragment") % slabs).alias("fragment"), F.explode("grams").alias("gram"))
        .groupBy("class", "fragment")
        .agg(F.collect_set("gram").alias("grams")),
        "parts",
    )
    index = stored(_index(parts, sizes, percent), "index")
    labels = _class_labels(index, parts, sizes, percent)
    named = (
        classes.join(labels, F.col("class") == F.col("node"), "left")
        .select("class", "check", "class_id", F.coalesce("label", "class").alias("label"))
    )
    named = stored(named, "named")
    least = stored(named.groupBy("label").agg(F.min("class_id").alias("component_id")), "least")
    named = named.join(least, "label").select("class", "check", "class_id", "component_id")
    own = F.col("key.doc_id")
    return sets.join(named, ["class", "check"], "left").select(
        "key",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(own).alias("component_id"),
        F.when(F.col("n_shingles") > 0, F.col("class_id")).otherwise(own).alias("class_id"),
    )


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their component, with their columns.

    Rows that repeat an id and a text are one document and stay or go together; so do rows
    without id.
    """
    found = join(docs, n, percent)
    gone = stored(
        found.where(~F.col("key.doc_id").eqNullSafe(F.col("component_id")))
        .select(F.col("key").alias("gone"))
        .distinct(),
        "gone",
    )
    whole = docs.select(
        F.struct(*(docs[c] for c in docs.columns)).alias("row"), document_key(docs).alias("key")
    )
    return whole.join(gone, F.col("key") == F.col("gone"), "left_anti").select("row.*")


def _index(parts: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Entries (gram, class, weight, rank, shared, n): the rarest shared n-grams of each class,
    as many as a link cannot miss. ``rank`` is the gram's place among the ``shared`` ones, which
    other near copies have too; ``n`` is the size of the set. The weight ranks classes by the
    share of their n-grams that others have too, which is all of them for the text that others
    were copied from, and then by how frequent these are."""
    single = parts.select("class", F.explode("grams").alias("gram"))
    often = stored(single.groupBy("gram").agg(F.count("*").alias("classes")).where("classes > 1"), "often")
    by_class = Window.partitionBy("class")
    ranked = (
        single.join(often, "gram")
        .withColumn("rank", F.row_number().over(by_class.orderBy("classes", "gram")))
        .withColumn("shared", F.count("*").over(by_class))
        .withColumn("common", F.avg(F.log2("classes")).over(by_class))
    )
    return (
        ranked.join(sizes, "class")
        .withColumn("weight", F.struct(F.col("shared") / F.col("n"), "common"))
        .where(F.col("rank") <= F.col("shared") - _needed(F.col("n"), percent) + 1)
        .select("gram", "class", "weight", "rank", "shared", "n")
    )
