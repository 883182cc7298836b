"""Prefix trie of conversations, by double-array tries.

1. Turns are ordered in each conversation and known by a 128-bit hash of role and text; the texts
   themselves are not moved. ``rebuilt`` gives each conversation the head of another one.
2. Conversations, sorted by their leading turns, are cut into shards. A shard numbers its distinct
   turns, packs their sequences into BASE and CHECK arrays, and walks every conversation through
   them, which gives the shard's nodes with their members, ends, children and subtree sums.
3. A node is closed if no other shard can hold it; its row is final. Upper nodes that neighbouring
   shards share are open: their parts are merged by the hash of their path, and their subtree sums
   come from the closed parts below them by pointer doubling, in as many rounds as the deepest open
   node's depth has binary digits.

Scale: a shard is a bounded number of turns in sorted order, not a group, so that a first turn, or
a whole conversation, that a third of all conversations share is spread over shards; only the
path itself is merged. A conversation with very many turns is cut into segments of ``SEGMENT``
turns, linked by the hash of the path before them, and its turns are numbered without a group of
its own. The ids of conversations that end at a shared node are hashed as a sorted stream. Only
the depth of the deepest open node reaches the driver.

Edge cases: a null role or text is empty; a null turn number comes first. Turns with equal numbers
are ordered by the hash of role and text, repeated rows are turns of their own. Rows without
conversation id belong to no conversation and count nowhere. The donor of a negative id is that
of SQL's remainder, which has the sign of the id. A conversation left without turns is a member
of the root and ends there. An empty table has no nodes. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwork.llm.components import stored
from tillwork.llm.encoding import starts_of

SEGMENT = 1024
LEADING = 8  # turns that sort conversations into shards
SHARD = 250_000  # turns in one trie
ROW_BITS = 33  # of monotonically_increasing_id, the rest is the partition

# The rule by which conversations are rebuilt.
BLOCK, HEADS = 100, 6

NODE = (
    "x long, y long, depth long, open boolean, up_x long, up_y long, up_open boolean, up_conv long, "
    "conv_id long, n_convs long, chars long, n_children long, n_leaves long, saved long, "
    "ends array<long>, ends_sha256 string"
)
NOTHING = hashlib.sha256(b"").hexdigest()


def _numbered(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, part, row, a, b, chars) and, for each conversation and part of the sorted
    table, the runs (conv_id, part, first, before, n): first row, turns before it, turns in all."""
    role, text = (F.coalesce(conversations[c].cast("string"), F.lit("")) for c in ("role", "text"))
    hashed = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        conversations["turn"].alias("turn"),
        F.xxhash64(role, text).alias("a"),
        F.xxhash64(text, F.lit(1), role).alias("b"),
        F.length(text).cast("long").alias("chars"),
    )
    order = ("conv_id", "turn", "a", "b")
    turns = stored(
        hashed.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("conv_id", "a", "b", "chars", F.monotonically_increasing_id().alias("row"))
        .withColumn("part", F.shiftright("row", ROW_BITS)),
        "turns",
    )
    by_conv = Window.partitionBy("conv_id")
    so_far = by_conv.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = (
        turns.groupBy("conv_id", "part")
        .agg(F.min("row").alias("first"), F.count("*").alias("turns"))
        .select(
            "conv_id",
            "part",
            "first",
            F.coalesce(F.sum("turns").over(so_far), F.lit(0)).alias("before"),
            F.sum("turns").over(by_conv).alias("n"),
        )
    )
    return turns, stored(runs, "runs")


def _donor(conv_id: Column) -> Column:
    return conv_id - conv_id % BLOCK


def rebuilt(conversations: DataFrame, size: int = SEGMENT) -> DataFrame:
    """``conv_id``, ``segment``, ``length`` (of the conversation) and ``turns``, in order: an array
    of (pos, a, b, x, y, chars) with at most ``size`` entries.

    a and b name a turn, x and y a turn at its position. The first turns of each conversation, a
    number of them fixed by the checksum of its id, are those of its block's first conversation.
    """
    turns, runs = _numbered(conversations)
    ids = runs.where("before = 0").select(
        "conv_id",
        "n",
        (F.crc32(F.col("conv_id").cast("string")) % HEADS).alias("head"),
        _donor(F.col("conv_id")).alias("donor"),
    )
    lengths = ids.select(F.col("conv_id").alias("donor"), F.col("n").alias("donor_n"))
    taken = F.least("head", F.coalesce("donor_n", F.lit(0)))
    convs = stored(
        ids.join(lengths, "donor", "left").select(
            "conv_id",
            "donor",
            "head",
            taken.alias("taken"),
            (taken + F.greatest(F.col("n") - F.col("head"), F.lit(0))).alias("length"),
        ),
        "convs",
    )
    place = (F.col("row") - F.col("first") + F.col("before")).alias("place")
    own = (
        turns.join(runs.join(convs, "conv_id"), ["conv_id", "part"])
        .select("*", place)
        .where("place >= head")
        .select("conv_id", "length", (F.col("taken") + F.col("place") - F.col("head")).alias("pos"), "a", "b", "chars")
    )
    heads = (
        turns.where(F.col("conv_id") % BLOCK == 0)
        .join(runs, ["conv_id", "part"])
        .select(F.col("conv_id").alias("donor"), place, "a", "b", "chars")
        .where(F.col("place") < HEADS - 1)
    )
    given = (
        convs.join(heads, "donor")
        .where("place < taken")
        .select("conv_id", "length", F.col("place").alias("pos"), "a", "b", "chars")
    )
    entry = F.struct(
        "pos",
        "a",
        "b",
        F.xxhash64("pos", "a", "b").alias("x"),
        F.xxhash64("b", "a", "pos").alias("y"),
        "chars",
    )
    full = (
        own.unionByName(given)
        .groupBy("conv_id", "length", F.floor(F.col("pos") / size).cast("long").alias("segment"))
        .agg(F.sort_array(F.collect_list(entry)).alias("turns"))
    )
    kind = dict(full.dtypes)["turns"]
    turnless = convs.where("length = 0").select(
        "conv_id", "length", F.lit(0).cast("long").alias("segment"), F.array().cast(kind).alias("turns")
    )
    return full.unionByName(turnless)


def _with_starts(segments: DataFrame, size: int) -> DataFrame:
    """Adds ``x`` and ``y``, the hash of the path before each segment."""

    def total(name: str) -> Column:
        return F.aggregate(
            F.col("turns")[name], F.lit(0).cast("long"), lambda held, value: held.bitwiseXOR(value)
        )

    before = Window.partitionBy("conv_id").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    several = segments.where(F.col("length") > size)
    starts = several.select("conv_id", "segment", total("x").alias("sx"), total("y").alias("sy")).select(
        "conv_id",
        "segment",
        *(F.coalesce(F.bit_xor(f"s{c}").over(before), F.lit(0)).alias(c) for c in "xy"),
    )
    single = segments.where(F.col("length") <= size)
    zero = {c: F.lit(0).cast("long") for c in "xy"}
    return single.withColumns(zero).unionByName(several.join(starts, ["conv_id", "segment"]))


class DoubleArray:
    """A trie of symbol sequences: the child of state s for symbol c is BASE[s] + c, if CHECK of
    that place is s. State 0 is the root."""

    WINDOW = 256  # places looked at before the array is made longer

    def __init__(self, size: int):
        self.base = np.zeros(size + 1, np.int64)
        self.check = np.full(size + 1, -1, np.int64)
        self.check[0] = 0
        self.free, self.end = 1, 1

    def _grow(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])

    def _holes(self, window: int) -> np.ndarray:
        """Free places among the first ``window`` that may be free."""
        return self.free + np.flatnonzero(self.check[self.free : min(self.end, self.free + window)] < 0)

    def _place_children(self, state: int, symbols: np.ndarray) -> None:
        offsets = symbols - symbols[0]
        for place in self._holes(self.WINDOW).tolist():
            self._grow(place + int(offsets[-1]) + 1)
            if (self.check[place + offsets] < 0).all():
                break
        else:
            place = self.end
            self._grow(place + int(offsets[-1]) + 1)
        self.base[state] = place - symbols[0]
        self.check[place + offsets] = state
        self.end = max(self.end, place + int(offsets[-1]) + 1)

    def add_level(self, states: np.ndarray, symbols: np.ndarray) -> None:
        """Children of states that have none yet: all (state, symbol) of one depth."""
        order = np.lexsort((symbols, states))
        states, symbols = states[order], symbols[order]
        once = np.ones(len(states), bool)
        once[1:] = (states[1:] != states[:-1]) | (symbols[1:] != symbols[:-1])
        states, symbols = states[once], symbols[once]
        heads = np.flatnonzero(np.append(True, states[1:] != states[:-1]))
        sizes = np.diff(np.append(heads, len(states)))
        for head, size in zip(heads[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
            self._place_children(int(states[head]), symbols[head : head + size])
        alone = heads[sizes == 1]
        if len(alone):
            self._grow(self.end + len(alone))
            places = np.append(self._holes(self.end), np.arange(self.end, self.end + len(alone)))[: len(alone)]
            self.base[states[alone]] = places - symbols[alone]
            self.check[places] = states[alone]
            self.end = max(self.end, int(places[-1]) + 1)
            self.free = int(places[-1]) + 1

    def step(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The children for the symbols; all are known to exist."""
        found = self.base[states] + symbols
        if not (self.check[found] == states).all():
            raise AssertionError("a sequence left the trie")
        return found


def _dense(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers of distinct pairs from 1 on, in the order of their first occurrence."""
    if not len(a):
        return np.zeros(0, np.int64)
    order = np.lexsort((b, a))
    new = np.ones(len(a), bool)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    heads = np.flatnonzero(new)
    first = np.minimum.reduceat(order, heads)
    names = np.empty(len(heads), np.int64)
    names[np.argsort(first, kind="stable")] = np.arange(1, len(heads) + 1)
    out = np.empty(len(a), np.int64)
    out[order] = names[np.cumsum(new) - 1]
    return out


def _shared_lead(
    groups: np.ndarray, turns: np.ndarray, starts: np.ndarray, counts: np.ndarray, leading: int
) -> np.ndarray:
    """For each row, how many leading turns it has in common with the shard's first or last row;
    -1 if it begins elsewhere."""
    best = np.full(len(counts), -1, np.int64)
    for edge in (0, len(counts) - 1):
        same = groups == groups[edge]
        depth = np.where(same, 0, -1)
        for level in range(min(leading, int(counts[edge]))):
            rows = np.flatnonzero(same & (counts > level))
            same = np.zeros(len(counts), bool)
            same[rows] = turns[starts[rows] + level] == turns[starts[edge] + level]
            depth[same] = level + 1
        best = np.maximum(best, depth)
    return best


def _sha_of(ids: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest()


def _levels(trie: DoubleArray, states: np.ndarray, symbols, starts, counts, grow: bool) -> np.ndarray:
    """The state of every turn. With ``grow`` the trie gets the states it lacks on the way."""
    at = np.zeros(len(symbols), np.int64)
    rows = np.flatnonzero(counts > 0)
    states = states[rows]
    level = 0
    while len(rows):
        where = starts[rows] + level
        if grow:
            trie.add_level(states, symbols[where])
        states = at[where] = trie.step(states, symbols[where])
        level += 1
        going = counts[rows] > level
        rows, states = rows[going], states[going]
    return at


def _shard(rows: pa.Table, size: int, leading: int) -> pa.RecordBatch:
    """The nodes of one shard; rows are sorted by segment, path before it, lead and id."""
    lists = rows.column("turns").combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0)
    entries = lists.flatten()
    a, b, x, y, chars = (
        np.asarray(entries.field(c).to_numpy(zero_copy_only=False), np.int64) for c in ("a", "b", "x", "y", "chars")
    )
    conv, segment, length, start_x, start_y = (
        rows.column(c).to_numpy().astype(np.int64) for c in ("conv_id", "segment", "length", "x", "y")
    )
    counts = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    starts = starts_of(counts)
    goes_on = length > (segment + 1) * size

    fresh = np.ones(len(conv), bool)
    for column in (segment, start_x, start_y):
        fresh[1:] &= column[1:] == column[:-1]
    fresh[1:] = ~fresh[1:]
    groups = np.cumsum(fresh)
    symbols = _dense(a, b)
    trie = DoubleArray(2 * len(symbols) + len(conv))
    at_root = np.zeros(len(conv), np.int64)
    trie.add_level(at_root, groups)
    tops = trie.step(at_root, groups)
    _levels(trie, tops, symbols, starts, counts, grow=True)
    at = _levels(trie, tops, symbols, starts, counts, grow=False)

    # Every visit of a conversation to a node: first the starts, then all turns.
    owner = np.repeat(np.arange(len(conv)), counts)
    level = np.arange(len(at)) - starts[owner]
    above = np.empty(len(at), np.int64)
    if len(at):
        above[1:] = at[:-1]
        above[level == 0] = tops[owner[level == 0]]

    def path(values: np.ndarray, start: np.ndarray) -> np.ndarray:
        run = np.bitwise_xor.accumulate(values) if len(values) else values
        return run ^ np.append(0, run)[starts[owner]] ^ start[owner]

    state = np.concatenate([tops, at])
    row = np.concatenate([np.arange(len(conv)), owner])
    depth = np.concatenate([np.zeros(len(conv), np.int64), level + 1])
    hash_x = np.concatenate([start_x, path(x, start_x)])
    hash_y = np.concatenate([start_y, path(y, start_y)])
    length_of = np.concatenate([np.zeros(len(conv), np.int64), chars])
    parent = np.concatenate([np.full(len(conv), -1), above])

    names, first, node = np.unique(state, return_index=True, return_inverse=True)
    n = len(names)
    up = np.where(parent[first] < 0, -1, np.searchsorted(names, parent[first]))
    lead = _shared_lead(groups, a, starts, counts, leading)
    shared = (np.minimum(depth, leading) <= lead[row]) | goes_on[row] | ((depth == 0) & (segment[row] > 0))
    is_open = np.bincount(node, shared, n) > 0
    counted = (depth > 0) | (segment[row] == 0)
    members = np.bincount(node, counted, n).astype(np.int64)
    smallest = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(smallest, node, conv[row])

    children, leaves, saved = (np.zeros(n, np.int64) for _ in range(3))
    depth_of = depth[first]
    own = np.maximum(members - 1, 0) * length_of[first]
    by_depth = np.argsort(depth_of, kind="stable")
    bounds = np.searchsorted(depth_of[by_depth], np.arange(int(depth_of.max()) + 2))
    for d in range(int(depth_of.max()), -1, -1):
        here = by_depth[bounds[d] : bounds[d + 1]]
        here = here[~is_open[here]]
        leaves[here[children[here] == 0]] = 1
        saved[here] += own[here]
        below = here[up[here] >= 0]
        np.add.at(children, up[below], 1)
        np.add.at(leaves, up[below], leaves[below])
        np.add.at(saved, up[below], saved[below])

    last = np.where(counts > 0, len(conv) + starts + counts - 1, np.arange(len(conv)))
    done = np.flatnonzero(~goes_on)
    order = done[np.lexsort((conv[done], node[last[done]]))]
    ended = np.bincount(node[last[done]], minlength=n)
    ids = conv[order]
    ends_at = starts_of(ended)
    digests: list = [NOTHING] * n
    for k in np.flatnonzero(~is_open & (ended > 0)).tolist():
        digests[k] = _sha_of(ids[ends_at[k] : ends_at[k] + ended[k]])
    kept = np.where(is_open, ended, 0)
    offsets = np.append(0, np.cumsum(kept)).astype(np.int32)
    open_ids = ids[np.repeat(is_open, ended)]

    has_up = up >= 0
    above_open = np.where(has_up, is_open[up], False)
    values = {
        "x": hash_x[first],
        "y": hash_y[first],
        "depth": depth_of + segment[row[first]] * size,
        "open": is_open,
        "up_x": pa.array(hash_x[first][up], mask=~has_up),
        "up_y": pa.array(hash_y[first][up], mask=~has_up),
        "up_open": above_open,
        "up_conv": pa.array(smallest[up], mask=~has_up | above_open),
        "conv_id": smallest,
        "n_convs": members,
        "chars": length_of[first],
        "n_children": children,
        "n_leaves": leaves,
        "saved": saved,
        "ends": pa.ListArray.from_arrays(pa.array(offsets), pa.array(open_ids)),
        "ends_sha256": pa.array(digests, pa.string(), mask=is_open),
    }
    return pa.RecordBatch.from_pydict(
        {k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in values.items()}
    )


def _shards(size: int, leading: int, limit: int):
    """Nodes of consecutive shards of a sorted partition."""

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, turns = [], 0
        for batch in batches:
            sizes = np.diff(batch.column("turns").offsets.to_numpy()) + 1
            part = (turns + np.cumsum(sizes)) // limit
            cuts = [0, *(np.flatnonzero(np.diff(part, prepend=0)) + 1).tolist(), batch.num_rows]
            for low, high in zip(cuts, cuts[1:]):
                if high > low:
                    held.append(batch.slice(low, high - low))
                    turns += int(sizes[low:high].sum())
                if turns >= limit:
                    yield _shard(pa.Table.from_batches(held), size, leading)
                    held, turns = [], 0
        if held:
            yield _shard(pa.Table.from_batches(held), size, leading)

    return nodes


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One checksum for each node, of its ids in consecutive sorted rows."""
    name, digest, found = None, None, []

    def result(rows):
        fields = ("x", "y", "depth")
        arrays = [pa.array([r[0][k] for r in rows], pa.int64()) for k in range(3)]
        return pa.RecordBatch.from_arrays([*arrays, pa.array([r[1] for r in rows])], names=[*fields, "ends_sha256"])

    for batch in batches:
        keys = zip(*(batch.column(c).to_pylist() for c in ("x", "y", "depth")))
        for key, ids in zip(keys, batch.column("ends")):
            text = ",".join(map(str, ids.values.to_numpy().tolist()))
            if key != name:
                if digest is not None:
                    found.append((name, digest.hexdigest()))
                name, digest = key, hashlib.sha256(text.encode())
            else:
                digest.update(f",{text}".encode())
        if len(found) > 10_000:
            yield result(found)
            found = []
    if digest is not None:
        yield result([*found, (name, digest.hexdigest())])


def _merged(nodes: DataFrame) -> DataFrame:
    """Open nodes with the sums of their parts and the number of all their children."""
    parts = (
        nodes.where("open")
        .groupBy("x", "y", "depth")
        .agg(
            F.max("up_x").alias("up_x"),
            F.max("up_y").alias("up_y"),
            F.min("conv_id").alias("conv_id"),
            F.sum("n_convs").alias("n_convs"),
            F.max("chars").alias("chars"),
            F.sum("n_children").alias("closed"),
            F.sum("n_leaves").alias("leaves"),
            F.sum("saved").alias("saved"),
        )
    )
    parts = stored(parts, "open")
    children = (
        parts.where("depth > 0")
        .groupBy(F.col("up_x").alias("x"), F.col("up_y").alias("y"), (F.col("depth") - 1).alias("depth"))
        .agg(F.count("*").alias("opened"))
    )
    n_children = F.col("closed") + F.coalesce("opened", F.lit(0))
    return stored(
        parts.join(children, ["x", "y", "depth"], "left")
        .withColumn("n_children", n_children)
        .withColumn("leaves", F.col("leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0))
        .withColumn("saved", F.col("saved") + (F.col("n_convs") - 1) * F.col("chars"))
        .drop("closed", "opened"),
        "merged",
    )


def _subtree_sums(nodes: DataFrame) -> DataFrame:
    """``x``, ``y``, ``depth`` with ``n_leaves`` and ``saved_tokens`` summed over all open nodes below.

    After k rounds a node has the sums of the nodes less than 2^k levels below it, and points at
    the node 2^k levels above.
    """
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    above = F.struct(F.col("up_x").alias("x"), F.col("up_y").alias("y"), (F.col("depth") - 1).alias("depth"))
    state = nodes.select(
        F.struct("x", "y", "depth").alias("id"), F.when(F.col("depth") > 0, above).alias("up"), "leaves", "saved"
    )
    for _ in range(deepest.bit_length()):
        gained = (
            state.where(F.col("up").isNotNull())
            .groupBy(F.col("up").alias("id"))
            .agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        )
        jumps = state.where(F.col("up").isNotNull()).select(F.col("id").alias("up"), F.col("up").alias("next"))
        state = stored(
            state.join(gained, "id", "left")
            .join(jumps, "up", "left")
            .select(
                "id",
                F.col("next").alias("up"),
                (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
            ),
            "sums",
        )
    return state.select("id.x", "id.y", "id.depth", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))


COLUMNS = (
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
)


def trie(
    segments: DataFrame, size: int = SEGMENT, leading: int = LEADING, limit: int = SHARD
) -> DataFrame:
    """One row for each node of the trie of ``segments``, as ``rebuilt`` returns them for ``size``.

    ``conv_id`` is the smallest member, ``parent_conv_id`` that of the parent, ``saved_tokens`` what
    storing each node of the subtree once saves, in code points, and ``ends_sha256`` the checksum
    of the ids of members that end at the node.
    """
    whole = stored(segments, "segments")
    order = ("segment", "x", "y", "lead", "conv_id")
    lead = F.slice(F.col("turns")["a"], 1, leading)
    rows = _with_starts(whole, size).withColumn("lead", lead).repartitionByRange(*order).sortWithinPartitions(*order)
    nodes = stored(
        rows.select("conv_id", "segment", "length", "x", "y", "turns").mapInArrow(_shards(size, leading, limit), NODE), "nodes"
    )
    key = ["x", "y", "depth"]
    merged = _merged(nodes)
    ends = (
        nodes.where(F.col("open") & (F.size("ends") > 0))
        .select(*key, "ends", F.col("ends")[0].alias("first"))
        .repartition(*key)
        .sortWithinPartitions(*key, "first")
        .select(*key, "ends")
        .mapInArrow(_digested, "x long, y long, depth long, ends_sha256 string")
    )
    opened = (
        merged.drop("leaves", "saved")
        .join(_subtree_sums(merged), key)
        .join(ends, key, "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING)))
    )
    closed = nodes.where("not open").withColumnRenamed("saved", "saved_tokens")
    picked = ["up_x", "up_y", *(c for c in COLUMNS if c != "parent_conv_id")]
    parents = merged.select(
        F.col("x").alias("up_x"), F.col("y").alias("up_y"), (F.col("depth") + 1).alias("depth"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    below_open = (
        closed.where("up_open").select(*picked).unionByName(opened.select(*picked))
        .join(parents, ["up_x", "up_y", "depth"], "left")
    )
    below_closed = closed.where("not up_open").withColumn("parent_conv_id", F.col("up_conv"))
    return below_open.select(*COLUMNS).unionByName(below_closed.select(*COLUMNS))
