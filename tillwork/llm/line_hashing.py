"""Substring dedup by hashing lines.

Texts are cut into pieces at line ends and after sentences; case, punctuation and white space of a
piece do not matter. Hashed units are all pairs of neighbouring pieces or sentences, and of the
pieces, lines, sentences (also over several lines of a paragraph) and paragraphs those of
``min_words`` words or more; a shorter one can only go with a neighbour, which a pair finds.
Digests are grouped over the whole corpus. A unit is repeated if an equal one ends before it or stands in an earlier
document, by document id. Repeated units that share a piece form a run; runs of ``min_words``
words or more are removed, so that short lines go where they repeat in the same order, and not
where each of them is common by itself. The earliest occurrence stays. Results hold the original
offsets of what is removed, in code points.

Scale: rows are narrow (an id, offsets and a 16-byte digest). A piece is in at most eight units,
mostly in two, so that their number grows with the text alone. A first pass counts eight bytes of
each digest; only units whose count is above one are kept and compared in full. The earliest
occurrence is a grouped minimum of these. Both joins are of stored tables, with one row for a digest
on one side, and are written, so that Spark splits a line that a third of all documents hold.
Runs are formed inside one text.

Edge cases: a null or empty text has no units. Repeated rows are different occurrences; the
later ones lose their units, and the first keeps them. Null ids rank first; rows with one id and
several texts rank by a hash of the text. Pieces that become empty when normalised belong
to the piece before them. Other columns are not read. Long texts and lines are read whole. An
empty table gives no rows.

Missed: passages that share no whole unit with the earlier text, such as a part of one sentence
or sentences with a changed word; of a passage, the part outside of repeated units.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.llm.components import stored
from tillwork.llm.encoding import starts_of
from tillwork.llm.words import filled, numpy_of, slices

UNITS = (
    "doc_id long, text_hash long, row long, first long, last long, start long, end long, word long, n_words long, "
    "digest binary"
)
UNIT_COLUMNS = [c.split()[0] for c in UNITS.split(", ")]
REMOVED = (
    "doc_id long, start long, end long, n_words long, digest string, kept_doc_id long, kept_start long, "
    "text_hash long, later boolean"
)

# What ends a sentence, inside a line and at its end.
_CLOSE = r"[\"'”’»)\]]*"
_AFTER = rf"[.!?…]{_CLOSE}\s+|[。！？]{_CLOSE}"
_AT_END = rf"[.!?…。！？]{_CLOSE}\s*$"


def _bounds(changes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of the groups that begin where ``changes`` is set."""
    first = np.flatnonzero(changes)
    return first, np.append(first[1:], len(changes)) - 1


def _pieces(texts: pa.Array) -> dict:
    """The pieces of all texts that hold a word: text, line, place, words, and what they end."""
    lists = pc.split_pattern(texts, "\n")
    counts = numpy_of(pc.list_value_length(lists)).astype(np.int64)
    lines = lists.flatten()
    lengths = numpy_of(pc.utf8_length(lines)).astype(np.int64)
    begin = starts_of(lengths + 1)
    begin -= np.repeat(begin[starts_of(counts)], counts)
    blank = numpy_of(pc.equal(pc.utf8_trim_whitespace(lines), ""))
    blank[starts_of(counts)] = True
    paragraph = np.cumsum(blank)
    cut = pc.split_pattern(pc.replace_substring_regex(lines, _AFTER, "\\0\n"), "\n")
    sizes = numpy_of(pc.list_value_length(cut)).astype(np.int64)
    parts = cut.flatten()
    places = starts_of(numpy_of(pc.utf8_length(parts)).astype(np.int64))
    line = np.repeat(np.arange(len(lines)), sizes)
    places += begin[line] - places[starts_of(sizes)][line]
    plain = pc.utf8_trim_whitespace(pc.replace_substring_regex(pc.utf8_lower(parts), r"[^\p{L}\p{N}]+", " "))
    words = numpy_of(pc.add(pc.count_substring(plain, " "), 1)).astype(np.int64)
    keep = np.flatnonzero(~numpy_of(pc.equal(plain, "")))
    stops = numpy_of(pc.match_substring_regex(parts, _AT_END))[keep]
    line, start = line[keep], places[keep]
    new_line = np.append(True, line[1:] != line[:-1])[: len(line)]
    start[new_line] = begin[line[new_line]]
    end = np.append(start[1:], 0)[: len(start)]
    last = np.append(new_line[1:], True)[: len(line)]
    end[last] = (begin + lengths)[line[last]]
    return {
        "owner": np.repeat(np.arange(len(counts)), counts)[line],
        "start": start,
        "end": end,
        "words": words[keep],
        "plain": plain.take(pa.array(keep)).to_pylist(),
        "new_line": new_line,
        "paragraph": paragraph[line],
        "stops": stops,
    }


def _ranges(p: dict, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last piece of every unit."""
    n = len(p["start"])
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new_paragraph = np.append(True, p["paragraph"][1:] != p["paragraph"][:-1])
    new_sentence = new_paragraph | np.append(True, p["stops"][:-1])
    before, found = starts_of(p["words"]), []
    for changes, pairs in (
        (np.ones(n, bool), True),
        (p["new_line"], False),
        (new_sentence, True),
        (new_paragraph, False),
    ):
        first, last = _bounds(changes)
        enough = before[last] + p["words"][last] - before[first] >= min_words
        found.append((first * n + last)[enough])
        if pairs:
            same = p["owner"][first[1:]] == p["owner"][first[:-1]]
            found.append((first[:-1] * n + last[1:])[same])
    return np.divmod(np.unique(np.concatenate(found)), n)


def _units(min_words: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in slices(batch):
                p = _pieces(filled(part.column("text")))
                first, last = _ranges(p, min_words)
                owner, plain, before = p["owner"][first], p["plain"], starts_of(p["words"])
                digests = [
                    hashlib.blake2b(" ".join(plain[a : b + 1]).encode(), digest_size=16).digest()
                    for a, b in zip(first.tolist(), last.tolist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array(owner)),
                        part.column("text_hash").take(pa.array(owner)),
                        pa.array(row + owner),
                        pa.array(first),
                        pa.array(last),
                        pa.array(p["start"][first]),
                        pa.array(p["end"][last]),
                        pa.array(before[first]),
                        pa.array(before[last] + p["words"][last] - before[first]),
                        pa.array(digests, pa.binary()),
                    ],
                    names=UNIT_COLUMNS,
                )
                row += part.num_rows

    return rows


def in_runs(found: list[dict], min_words: int) -> list[dict]:
    """Of one text's repeated units, the narrowest that cover all runs of ``min_words`` words."""
    found = sorted(found, key=lambda u: (u["first"], u["last"]))
    runs: list[list[dict]] = []
    reach = -1
    for unit in found:
        if unit["first"] > reach:
            runs.append([])
        runs[-1].append(unit)
        reach = max(reach, unit["last"])
    out = []
    for run in runs:
        if max(u["word"] + u["n_words"] for u in run) - run[0]["word"] >= min_words:
            covered: set[int] = set()
            narrow = sorted(run, key=lambda u: u["last"] - u["first"])
            for apart in (True, False):
                for unit in narrow:
                    pieces = range(unit["first"], unit["last"] + 1)
                    if covered.isdisjoint(pieces) if apart else not covered.issuperset(pieces):
                        covered.update(pieces)
                        out.append(unit)
    return out


def _runs(min_words: int):
    names = [c.split()[0] for c in REMOVED.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    types = [kinds[c.split()[1]] for c in REMOVED.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in names]
            keys = (batch.column(c).to_pylist() for c in ("doc_id", "text_hash", "later"))
            for found, *key in zip(batch.column("found"), *keys):
                own = dict(zip(("doc_id", "text_hash", "later"), key))
                for unit in in_runs(found.as_py(), min_words):
                    values = unit | own | {"digest": unit["digest"].hex()}
                    for column, name in zip(out, names):
                        column.append(values[name])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=names)

    return rows


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))


def _with_later(table: DataFrame, rows: DataFrame) -> DataFrame:
    """``table`` with ``later``: of the ``rows`` that repeat an id and a text, this is not the first."""
    several = (
        rows.groupBy(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash"))
        .agg(F.min("row").alias("first_row"), F.max("row").alias("last_row"))
        .where("first_row < last_row")
        .drop("last_row")
    )
    same = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_hash") == F.col("of_hash"))
    later = F.coalesce(F.col("row") > F.col("first_row"), F.lit(False))
    return table.join(several, same, "left").withColumn("later", later).drop("of_id", "of_hash", "first_row")


def repeated_units(docs: DataFrame, min_words: int = 25) -> DataFrame:
    """What is to be removed: ``doc_id``, ``start``, ``end``, ``n_words``, the ``digest`` in
    hexadecimal, and ``kept_doc_id`` and ``kept_start`` of the occurrence that stays. Spans of
    one text can overlap where a wider unit is needed beside a narrow one. ``text_hash`` and
    ``later`` tell rows with the same id apart: of rows that repeat an id and a text, the first has
    ``later`` false, and all others have it true and lose the same units."""
    units = stored(_keyed(docs).mapInArrow(_units(min_words), UNITS), "units")
    mark = F.xxhash64("digest").alias("mark")
    several = stored(
        units.select(mark).groupBy("mark").agg(F.count("*").alias("times")).where("times > 1").select("mark"), "several"
    )
    again = stored(units.select("*", mark).join(several, "mark").drop("mark"), "again")
    earliest = stored(
        again.groupBy("digest")
        .agg(F.min(F.struct("doc_id", "text_hash", "row", "start", "end")).alias("kept"), F.count("*").alias("times"))
        .where("times > 1")
        .select("digest", "kept"),
        "earliest",
    )
    unit = ("first", "last", "start", "end", "word", "n_words", "digest")
    met = stored(
        again.join(earliest, "digest")
        .where((F.col("row") != F.col("kept.row")) | (F.col("start") >= F.col("kept.end")))
        .select(
            "doc_id",
            "text_hash",
            "row",
            F.struct(
                *unit, F.col("kept.doc_id").alias("kept_doc_id"), F.col("kept.start").alias("kept_start")
            ).alias("unit"),
        ),
        "met",
    )
    found = met.groupBy("row", "doc_id", "text_hash").agg(F.collect_list("unit").alias("found"))
    return _with_later(found, units).mapInArrow(_runs(min_words), REMOVED)


def merged(spans: list[dict]) -> list[dict]:
    """Sorted spans with those that overlap made one."""
    out: list[dict] = []
    for span in spans:
        if out and span["start"] < out[-1]["end"]:
            out[-1] = {"start": out[-1]["start"], "end": max(out[-1]["end"], span["end"])}
        else:
            out.append(span)
    return out


def without_units(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """``doc_id``, the ``text`` without its removed units, and ``removed``, their spans in the
    original text, for every row of ``docs``, from which ``removed`` was made."""
    spans = removed.groupBy(
        F.col("doc_id").alias("in_id"), F.col("text_hash").alias("in_hash"), F.col("later").alias("in_later")
    ).agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("removed"))
    numbered = stored(_keyed(docs).withColumn("row", F.monotonically_increasing_id()), "numbered")
    same = (
        F.col("doc_id").eqNullSafe(F.col("in_id"))
        & (F.col("text_hash") == F.col("in_hash"))
        & (F.col("later") == F.col("in_later"))
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, gone in zip(batch.column("text").to_pylist(), batch.column("removed").to_pylist()):
                for span in reversed(merged(gone or [])):
                    end = span["end"] + 1 if text[span["end"] : span["end"] + 1] == "\n" else span["end"]
                    text = text[: span["start"]] + text[end:]
                texts.append(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string()), batch.column("removed")],
                names=["doc_id", "text", "removed"],
            )

    joined = _with_later(numbered, numbered.drop("text")).join(spans, same, "left").select("doc_id", "text", "removed")
    return joined.mapInArrow(cut, "doc_id long, text string, removed array<struct<start:long,end:long>>")
