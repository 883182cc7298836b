"""Secret scans over an incremental ledger of content-addressed blobs.

Every version of every path is addressed by the SHA-256 of its text. The ledger, a Parquet
folder, holds one row for each scan of a blob: the rule versions that were applied and what they
found. ``scan`` looks up which (blob, rule version) pairs the ledger lacks, reads only those
texts, appends their findings, and joins the ledger back to all paths. A second run over the same
texts scans nothing; a new version of one rule scans every blob for that rule only.

Scale: the ledger is asked with digests alone. Pending texts meet as one blob after map-side
combining, so a text that makes up a third of all rows is one row per task before the shuffle and
is scanned once; with at most ``FEW`` pending blobs, as in a run over mostly known texts, no other
text moves. The join back to the paths moves digests and findings, no text; findings are stored
before it, one row for each blob that has any, so that Spark can split a hot blob on the other side.

Edge cases: a null text is the empty text. Repeated rows and repeated paths each get their own
result. A null path is a path. Texts of any length are scanned whole. Extra columns and clashing
names do not matter, as only the two named columns are read. An empty table gives an empty result
and an empty ledger. Two runs must not append to one ledger at the same time; a run that fails
before its append leaves the ledger as it was, as Spark commits the append as a whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.llm.components import stored
from tillwork.llm.words import filled, slices

FEW = 100_000  # digests that are sent to every task: about 10 MB
LEDGER = "blob string, rules array<string>, findings array<struct<kind:string,start:long,end:long>>"


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern`` whose ``group`` has ``least`` characters.

    ``hint`` is a cheaper pattern that every text with a match has.
    """

    kind: str
    pattern: str
    hint: str
    group: int = 0
    least: int = 0
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The three base kinds, in the order in which they are listed.
BASE_RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]""",
        2,
        8,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", "AKIA", 0, 16),
    Rule("hex", r"[0-9a-f]+", r"[0-9a-f]{32}", 0, 32),
)
RULES = (
    *BASE_RULES,
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", "PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", r"\.eyJ", 0, 40),
)


def matches(rule: Rule, text: str) -> list[tuple[int, int]]:
    """Start and end of the rule's matches, in code points."""
    found = re.compile(rule.pattern, re.ASCII).finditer(text)
    return [m.span() for m in found if len(m.group(rule.group)) >= rule.least]


def _scanner(rules: tuple[Rule, ...]):
    by_name = {r.name: r for r in rules}
    schema = pa.schema(
        [
            ("blob", pa.string()),
            ("rules", pa.list_(pa.string())),
            (
                "findings",
                pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])),
            ),
        ]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts, names = filled(part.column("text")), part.column("rules").to_pylist()
                found: list[list[dict]] = [[] for _ in names]
                for name, rule in by_name.items():
                    near = pc.indices_nonzero(pc.match_substring_regex(texts, rule.hint))
                    for row in near.to_pylist():
                        if name in names[row]:
                            spans = matches(rule, texts[row].as_py())
                            found[row] += [{"kind": rule.kind, "start": a, "end": b} for a, b in spans]
                yield pa.RecordBatch.from_arrays(
                    [part.column("blob"), part.column("rules"), pa.array(found, schema.field(2).type)],
                    schema=schema,
                )

    return scan


def _ledger(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def unseen(blobs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Each ``blob`` of ``blobs`` with the names of the rule versions that the ledger lacks for it."""
    wanted = F.array(*(F.lit(r.name) for r in rules))
    seen = ledger.groupBy("blob").agg(F.flatten(F.collect_set("rules")).alias("seen"))
    missing = F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>")))
    return (
        blobs.select("blob")
        .distinct()
        .join(seen, "blob", "left")
        .select("blob", missing.alias("rules"))
        .where(F.size("rules") > 0)
    )


def _texts(blobs: DataFrame, pending: DataFrame) -> DataFrame:
    """``blob``, ``text`` and ``rules`` of the pending blobs, each once. Few pending blobs are looked up
    where the texts are read, so that only their texts move."""
    if pending.count() <= FEW:
        blobs = blobs.join(F.broadcast(pending.select("blob")), "blob", "left_semi")
    return blobs.dropDuplicates(["blob"]).join(pending, "blob").select("blob", "text", "rules")


def scan(
    versions: DataFrame,
    ledger_path: str,
    rules: tuple[Rule, ...] = RULES,
    path: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Bring the ledger up to date for ``versions`` and return each row's findings.

    One row per input row: the path column, ``blob`` and ``findings``, an array of
    (kind, start, end) by start, then by the order of ``rules``. Offsets are code points, ends
    are exclusive.
    """
    spark = versions.sparkSession
    content = F.coalesce(versions[text], F.lit(""))
    blob = F.sha2(content.cast("binary"), 256).alias("blob")
    paths = stored(versions.select(versions[path], blob), "paths")
    pending = stored(unseen(paths, _ledger(spark, ledger_path), rules), "pending")
    texts = _texts(versions.select(blob, content.alias("text")), pending)
    texts.mapInArrow(_scanner(rules), LEDGER).write.mode("append").parquet(ledger_path)

    kinds = F.array(*(F.lit(r.kind) for r in rules))
    wanted = F.array(*(F.lit(r.name) for r in rules))
    current = F.filter(
        F.flatten(F.transform(F.collect_list(F.struct("rules", "findings")), _tagged)),
        lambda f: F.array_contains(wanted, f["rule"]),
    )
    ordered = F.transform(
        F.sort_array(
            F.transform(
                "found",
                lambda f: F.struct(f["start"], F.array_position(kinds, f["kind"]), f["end"], f["kind"]),
            )
        ),
        lambda f: F.struct(f["kind"].alias("kind"), f["start"].alias("start"), f["end"].alias("end")),
    )
    findings = (
        _ledger(spark, ledger_path)
        .where(F.size("findings") > 0)
        .groupBy("blob")
        .agg(current.alias("found"))
        .select("blob", ordered.alias("findings"))
    )
    findings = stored(findings, "findings")
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    return (
        paths.join(findings, "blob", "left")
        .select(path, "blob", F.coalesce("findings", none).alias("findings"))
    )


def _tagged(entry):
    """The findings of one ledger row, each with the name of the rule version that made it."""
    return F.transform(
        entry["findings"],
        lambda f: F.struct(
            F.get(F.filter(entry["rules"], lambda r: F.startswith(r, F.concat(f["kind"], F.lit("@")))), F.lit(0)).alias("rule"),
            f["kind"].alias("kind"),
            f["start"].alias("start"),
            f["end"].alias("end"),
        ),
    )
