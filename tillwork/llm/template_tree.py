"""Line dedup with a log-template tree of fixed depth.

A line's path in the tree is its number of tokens and its first ``depth`` tokens, where tokens
with digits count as a variable field. The lines of a leaf are generalised by vote: at each
position the token that most documents agree on is part of the leaf's template, every other token
there is a variable field. A line belongs to the template if it agrees with it in at least
``similarity`` of its tokens, those left out that are fields in both, and in at
least one token behind the path, as the path alone shows nothing; the lines that do not agree vote again among themselves. A leaf
whose vote finds no template that ``min_docs`` documents support is split by the place with the
strongest token that not all its lines share, and its parts vote. What is left when nothing can be
split stands for itself. Lines of templates that ``min_docs`` documents have are dropped,
except for the first in document order.

Scale: only leaves that ``min_docs`` documents reach can hold such a template, and only leaves with
more than one distinct line need votes. Equal lines are one row with a count before they vote, and
votes are sums that are combined before their shuffle, so that a line, leaf or template in a third
of all documents does not gather anywhere. The leaves are hashes of 8 bytes; they are broadcast
while their checked number is at most ``BROADCAST_LEAVES`` and joined by a shuffle beyond.

Edge cases: a null text stays null and has no lines. Lines without a token are never dropped.
Rows that repeat an id and a text are one document and are cut alike; an id with several texts is
several documents. Null ids come first in document order. Text is rebuilt from its own lines, so
that kept lines keep every character. ``cleaned`` reads ``doc_id`` and ``text`` and gives four
columns; ``replace_text`` keeps all columns of the table. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.llm.components import stored
from tillwork.llm.positional_index import document_key

TOKEN = r"[^\x20\x09-\x0D]+"
FIELD = "<*>"
BROADCAST_LEAVES = 1_000_000


def _tokens(line: Column) -> Column:
    """Tokens of a line; only lines with a digit have fields to look for."""
    words = F.regexp_extract_all(line, F.lit(TOKEN), F.lit(0))
    fields = F.transform(words, lambda t: F.when(t.rlike("[0-9]"), F.lit(FIELD)).otherwise(t))
    return F.when(line.rlike("[0-9]"), fields).otherwise(words)


def lines_of(docs: DataFrame, depth: int) -> DataFrame:
    """(key, line_no, tokens, leaf, shape) for every line with a token.

    ``leaf`` hashes the line's path in the tree, ``shape`` is a digest of all its tokens.
    """
    raw = docs.where(F.col("text").isNotNull()).select(
        document_key(docs).alias("key"), F.posexplode(F.split("text", "\n")).alias("line_no", "line")
    )
    # Generated, so that the tokens are cut once for all that is made of them.
    cut = raw.where(F.col("line").rlike(TOKEN)).select(
        "key", "line_no", F.explode(F.array(_tokens(F.col("line")))).alias("tokens")
    )
    return cut.select(
        "key",
        "line_no",
        "tokens",
        F.xxhash64(F.size("tokens"), F.slice("tokens", 1, depth)).alias("leaf"),
        F.unhex(F.md5(F.array_join("tokens", " ").cast("binary"))).alias("shape"),
    )


def _bounded(leaves: DataFrame) -> DataFrame:
    return F.broadcast(leaves) if leaves.count() <= BROADCAST_LEAVES else leaves


def _generalised(
    shapes: DataFrame, depth: int, min_docs: int, similarity: float
) -> tuple[DataFrame, DataFrame]:
    """(shape, leaf) of the lines that agree with their leaf's template, and the lines that can
    still vote, in leaves that are split where the vote found no supported template."""
    spread = shapes.select(
        "leaf", "shape", "docs", F.size("tokens").alias("n"), F.posexplode("tokens").alias("place", "token")
    )
    counts = stored(
        spread.groupBy("leaf", "place", "token").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs),
        "counts",
    )
    votes = counts.groupBy("leaf", "place").agg(F.max(F.struct("docs", "token"))["token"].alias("token"))
    agreeing = stored(
        spread.join(votes, ["leaf", "place", "token"])
        .groupBy("leaf", "shape", "n", "docs")
        .agg(
            F.count_if(F.col("token") != FIELD).alias("same"),
            F.count_if(F.col("token") == FIELD).alias("fields"),
            F.count_if((F.col("token") != FIELD) & (F.col("place") >= depth)).alias("behind"),
        )
        .where("behind > 0")
        .where(F.col("same") >= (F.col("n") - F.col("fields")) * similarity)
        .select("leaf", "shape", "docs"),
        "agreeing",
    )
    found = stored(
        agreeing.groupBy("leaf").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs).select("leaf"),
        "found",
    )
    named = agreeing.join(found, "leaf").select("leaf", "shape")
    again = shapes.join(found, "leaf", "left_semi").join(named, ["leaf", "shape"], "left_anti")
    return named, again.unionByName(_split(shapes.join(found, "leaf", "left_anti"), counts, min_docs))


def _split(shapes: DataFrame, counts: DataFrame, min_docs: int) -> DataFrame:
    """The lines dealt into leaves by their token at the strongest place that is not constant;
    tokens of fewer than ``min_docs`` documents share a leaf. Leaves without such a place go."""
    whole = shapes.groupBy("leaf").agg(F.sum("docs").alias("all"))
    at = (
        counts.join(whole, "leaf")
        .where("docs < all")
        .groupBy("leaf")
        .agg(F.max(F.struct("docs", "place", "token"))["place"].alias("at"))
    )
    tokens = counts.select("leaf", F.col("place").alias("at"), F.col("token").alias("own"), F.lit(True).alias("known"))
    return (
        shapes.join(at, "leaf")
        .withColumn("own", F.get("tokens", "at"))
        .join(tokens, ["leaf", "at", "own"], "left")
        .withColumn("leaf", F.xxhash64("leaf", "at", F.when(F.col("known"), F.col("own"))))
        .select(*shapes.columns)
    )


def templates(
    docs: DataFrame, depth: int = 3, similarity: float = 0.7, min_docs: int = 3
) -> tuple[DataFrame, DataFrame]:
    """The lines whose leaf ``min_docs`` documents reach, as (key, line_no, shape), and the
    template of each shape, as (shape, template)."""
    lines = lines_of(docs, depth)
    everywhere = stored(lines.select("key", "line_no", "leaf", "shape"), "lines")
    seen = everywhere.select("leaf", "key").distinct()
    busy = stored(
        seen.groupBy("leaf").agg(F.count("*").alias("docs")).where(F.col("docs") >= min_docs).select("leaf"),
        "leaves",
    )
    places = stored(everywhere.join(_bounded(busy), "leaf"), "places")
    support = (
        places.select("leaf", "shape", "key").distinct().groupBy("leaf", "shape").agg(F.count("*").alias("docs"))
    )
    several = stored(
        support.groupBy("leaf").agg(F.count("*").alias("shapes")).where("shapes > 1").select("leaf"),
        "several",
    )
    texts = (
        lines.join(_bounded(several), "leaf")
        .groupBy("leaf", "shape")
        .agg(F.first("tokens").alias("tokens"))
    )
    open_shapes = stored(texts.join(support, ["leaf", "shape"]), "shapes")
    named = support.select("shape", F.col("shape").alias("template")).where("false")
    turn = 0
    while not open_shapes.isEmpty():
        agreeing, left = _generalised(open_shapes, depth, min_docs, similarity)
        label = F.unhex(F.md5(F.concat_ws(":", F.lit(turn), "leaf").cast("binary")))
        named = stored(named.union(agreeing.select("shape", label.alias("template"))), "named")
        open_shapes, turn = stored(left, "shapes"), turn + 1
    return places.select("key", "line_no", "shape"), named


def dropped_lines(
    docs: DataFrame, depth: int = 3, similarity: float = 0.7, min_docs: int = 3
) -> DataFrame:
    """(key, lines): the numbers of the lines that go, for documents that lose any."""
    places, named = templates(docs, depth, similarity, min_docs)
    placed = stored(
        places.join(named, "shape", "left").select(
            "key", "line_no", F.coalesce("template", "shape").alias("template")
        ),
        "placed",
    )
    spread = (
        placed.select("template", "key").distinct().groupBy("template").agg(F.count("*").alias("docs"))
    )
    first = placed.groupBy("template").agg(F.min(F.struct("key", "line_no")).alias("first"))
    # Stored, so that Spark splits a template that very many lines have.
    recurring = stored(
        spread.where(F.col("docs") >= min_docs).join(first, "template").select("template", "first"), "recurring"
    )
    return (
        placed.join(recurring, "template")
        .where(F.struct("key", "line_no") != F.col("first"))
        .groupBy("key")
        .agg(F.collect_set("line_no").alias("lines"))
    )


def _with_drops(docs: DataFrame, drops: DataFrame) -> DataFrame:
    """Each row of ``docs`` as ``row`` with its text as lines and the numbers of those that go."""
    drops = stored(drops, "drops")
    whole = docs.select(
        F.struct(*(docs[c] for c in docs.columns)).alias("row"), document_key(docs).alias("key")
    )
    none = F.array().cast("array<int>")
    return whole.join(drops, "key", "left").select(
        "row", F.split("row.text", "\n").alias("all"), F.coalesce("lines", none).alias("gone")
    )


def _rebuilt() -> Column:
    """The lines that stay, joined; the same column where nothing goes."""
    numbers = F.sequence(F.lit(0), F.size("all") - 1)
    kept = F.transform(F.array_except(numbers, F.col("gone")), lambda i: F.get(F.col("all"), i))
    return F.when(F.size("gone") > 0, F.array_join(kept, "\n")).otherwise(F.col("row.text"))


def cleaned(docs: DataFrame, **options) -> DataFrame:
    """``doc_id``, the ``text`` that is left, ``n_lines`` before and ``n_dropped``."""
    docs = docs.select("doc_id", "text")
    n_lines = F.when(F.col("row.text").isNull(), 0).otherwise(F.size("all"))
    return _with_drops(docs, dropped_lines(docs, **options)).select(
        "row.doc_id",
        _rebuilt().alias("text"),
        n_lines.cast("long").alias("n_lines"),
        F.size("gone").cast("long").alias("n_dropped"),
    )


def replace_text(docs: DataFrame, **options) -> DataFrame:
    """All rows and columns of ``docs``, with the text that is left."""
    drops = dropped_lines(docs.select("doc_id", "text"), **options)
    columns = [_rebuilt().alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return _with_drops(docs, drops).select(*columns)
