"""Benchmark decontamination on a distributed positional index of the training documents.

Built-in functions only. Every test item is cut into windows of consecutive words. A first pass
over the documents counts the test terms in the whole corpus; the rarest terms of each window are
its anchors. A second pass stores the postings (document, position) of the anchors, and with them
each document's length. Anchor postings, moved back by the anchor's place in its window, are the
places where a window can start; for exact phrases the lists of all anchors must meet there. The
positions that the window's other terms must have are then intersected with the postings of the
documents that are left, and places where all lists meet are exact phrases; with ``slop``, terms
may be off their place, and with ``least``, some may be missing, which gives proximity matches. Of a
window that may miss k places, the k + 1 rarest places are its anchors, as one of them is met.

Scale: the anchors' postings are a small part of the corpus, as rare terms are chosen by corpus
counts; term counts are combined before their shuffle. Test terms, anchors and candidate
documents are stored tables, so that Spark broadcasts them while they are small and shuffles when
they are not; nothing is broadcast by force. A term or passage that a third of all documents hold
makes one row for each occurrence, spread by Spark's skew join.

Edge cases: a null or empty text has no words and no hits. Rows with equal id and text share
their result, each keeps its row. Null document ids are ordinary ids. Items without words have no
window; null item ids are left out of a document's list. Windows that several items share are
matched once. Other columns are not read. Texts are read whole. Empty tables give no matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwork.llm.components import stored

# Fixed value: what a word is made of, after A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANCHORS = 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Words of a text with A-Z lower-cased; a text of ASCII alone takes the faster function."""
    ascii_only = F.octet_length(text) == F.length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def document_key(docs: DataFrame) -> Column:
    """Id and text together, so that rows that repeat an id with another text stay apart."""
    return F.struct(
        docs["doc_id"].alias("doc_id"),
        F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("text"),
    )


def windows_of(items: DataFrame, window: int) -> DataFrame:
    """``item_id`` and ``terms``, an array of ``window`` words, or fewer for a shorter item."""
    words = items.select("item_id", words_of(F.coalesce(items["text"], F.lit(""))).alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    return (
        words.where(F.size("w") > 0)
        .select("item_id", "w", F.explode(starts).alias("start"))
        .select("item_id", F.slice("w", F.col("start"), F.lit(window)).alias("terms"))
        .distinct()
    )


def _tokens(docs: DataFrame) -> DataFrame:
    """(key, pos, term) for every word; after a document's last word, the empty term."""
    text = F.coalesce(docs["text"], F.lit(""))
    return docs.select(
        document_key(docs).alias("key"),
        F.posexplode(F.concat(words_of(text), F.array(F.lit("")))).alias("pos", "term"),
    )


def _anchors(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """(id, term, place, rank, anchors): the ``ANCHORS`` rarest different terms of each window in
    the corpus; windows with a term that the corpus lacks have no row."""
    placed = windows.select("id", F.size("terms").alias("size"), F.posexplode("terms").alias("place", "term"))
    known = placed.join(counts, "term").groupBy("id", "size").agg(
        F.count("*").alias("known"), F.array_sort(F.collect_set(F.struct("n", "term"))).alias("terms")
    )
    rare = (
        known.where(F.col("known") == F.col("size"))
        .select("id", F.slice("terms", 1, ANCHORS).alias("terms"))
        .select("id", F.size("terms").alias("anchors"), F.posexplode("terms").alias("rank", "rare"))
        .select("id", "anchors", "rank", F.col("rare.term").alias("term"))
    )
    first = placed.groupBy("id", "term").agg(F.min("place").alias("place"))
    return rare.join(first, ["id", "term"])


def _near_anchors(windows: DataFrame, counts: DataFrame, least: float) -> DataFrame:
    """(id, term, place): of each window, as many of its rarest places as may be missing, and one
    more; a term that the corpus lacks is the rarest."""
    placed = windows.select("id", F.size("terms").alias("size"), F.posexplode("terms").alias("place", "term"))
    may_miss = F.col("size") - F.ceil(F.col("size") * F.lit(least)).cast("int")
    return (
        placed.join(counts, "term", "left")
        .groupBy("id", "size")
        .agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)), "place", "term"))).alias("terms"))
        .select("id", F.explode(F.slice("terms", F.lit(1), may_miss + 1)).alias("rare"))
        .select("id", "rare.term", "rare.place")
    )


def matches(
    docs: DataFrame, items: DataFrame, window: int = 13, slop: int = 0, least: float = 1.0
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Occurrences of the items' windows, the windows, and the documents' lengths.

    Occurrences: ``key``, ``id`` of the window, ``start``, ``length``, ``found`` (terms that are
    within ``slop`` words of their place; at least the share ``least`` of the window).
    Windows: ``id``, ``item_id``. Lengths: ``key``, ``n_words``, a row for each document row.
    A proximity match can begin before its text, where the first terms are missing.
    """
    cut = stored(windows_of(items, window), "windows")
    of_items = cut.select(F.concat_ws(" ", "terms").alias("id"), "item_id")
    windows = cut.select(F.concat_ws(" ", "terms").alias("id"), "terms").distinct()
    terms = stored(windows.select(F.explode("terms").alias("term")).distinct(), "terms")
    counts = stored(
        _tokens(docs).join(terms, "term").groupBy("term").agg(F.count("*").alias("n")), "counts"
    )
    exact = slop == 0 and least >= 1.0
    anchors = stored(_anchors(windows, counts) if exact else _near_anchors(windows, counts, least), "anchors")
    wanted = stored(
        anchors.select("term").union(docs.sparkSession.range(1).select(F.lit("").alias("term"))).distinct(),
        "wanted",
    )
    postings = stored(_tokens(docs).join(wanted, "term").select("key", "pos", "term"), "postings")
    lengths = postings.where("term = ''").select("key", F.col("pos").cast("long").alias("n_words"))
    shifts = F.sequence(F.lit(-slop), F.lit(slop))
    met = postings.where("term <> ''").join(anchors, "term")
    if exact:
        met = (
            met.select("key", (F.col("pos") - F.col("place")).alias("start"), "id", "rank", "anchors")
            .where("start >= 0")
            .groupBy("key", "start", "id", "anchors")
            .agg(F.count_distinct("rank").alias("ranks"))
            .where(F.col("ranks") == F.col("anchors"))
        )
    else:
        met = (
            met.select("key", "pos", "place", "id", F.explode(shifts).alias("shift"))
            .select("key", (F.col("pos") - F.col("place") - F.col("shift")).alias("start"), "id")
            .distinct()
        )
    candidates = stored(met.select("key", "start", "id"), "candidates")
    suspects = stored(candidates.select("key").distinct(), "suspects")
    needed = (
        candidates.join(windows, "id")
        .select("key", "start", "id", F.size("terms").alias("length"), F.posexplode("terms").alias("place", "term"))
        .select("key", "start", "id", "length", "place", "term", F.explode(shifts).alias("shift"))
        .select("key", "start", "id", "length", "place", "term", (F.col("start") + F.col("place") + F.col("shift")).alias("pos"))
    )
    suspect_docs = docs.select("doc_id", "text", document_key(docs).alias("key")).join(suspects, "key", "left_semi")
    nearby = _tokens(suspect_docs).join(terms, "term", "left_semi").distinct()
    occurrences = (
        needed.join(nearby, ["key", "pos", "term"])
        .groupBy("key", "id", "start", "length")
        .agg(F.count_distinct("place").alias("found"))
        .where(F.col("found") >= F.ceil(F.col("length") * F.lit(least)))
    )
    return stored(occurrences, "occurrences"), of_items, lengths


def hits(docs: DataFrame, items: DataFrame, window: int = 13, slop: int = 1, least: float = 0.9) -> DataFrame:
    """``key``, ``n_words``, ``n_exact`` and ``n_near`` (windows that the text holds as they are,
    and as proximity matches, exact ones included) for every row of ``docs``."""
    exact, _, lengths = matches(docs, items, window)
    near, _, _ = matches(docs, items, window, slop, least)

    def counted(found: DataFrame, name: str) -> DataFrame:
        return found.select("key", "id").distinct().groupBy("key").agg(F.count("*").alias(name))

    both = counted(near, "n_near").join(counted(exact, "n_exact"), "key", "left")
    number = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_exact", "n_near")]
    return lengths.join(both, "key", "left").select("key", "n_words", *number)


def contamination(docs: DataFrame, items: DataFrame, window: int = 13, share: int = 20) -> DataFrame:
    """``key``, ``n_words``, ``n_hit`` (words inside any exact occurrence), ``item_ids`` and
    ``contaminated`` (``share`` times the hit words are at least all words) for every row."""
    found, of_items, lengths = matches(docs, items, window)
    spans = found.groupBy("key", "start").agg(F.max(F.col("start") + F.col("length")).alias("end"))
    before = Window.partitionBy("key").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    covered = F.coalesce(F.max("end").over(before), F.lit(0))
    hits = (
        spans.select("key", (F.col("end") - F.greatest("start", covered)).alias("more"))
        .groupBy("key")
        .agg(F.sum(F.greatest("more", F.lit(0))).alias("n_hit"))
    )
    held = (
        found.select("key", "id")
        .distinct()
        .join(of_items, "id")
        .groupBy("key")
        .agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"))
    )
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return (
        lengths.join(hits.join(held, "key", "left"), "key", "left")
        .select(
            "key",
            "n_words",
            n_hit.alias("n_hit"),
            F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        )
        .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words")))
    )


def without_contaminated(docs: DataFrame, items: DataFrame, window: int = 13, share: int = 20) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their columns."""
    bad = stored(
        contamination(docs, items, window, share).where("contaminated").select(F.col("key").alias("bad")).distinct(),
        "contaminated",
    )
    whole = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), document_key(docs).alias("key"))
    return whole.join(bad, F.col("key") == F.col("bad"), "left_anti").select("row.*")
