"""Registered queries of the subpackage, one per operator, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.llm import (
    bayesian_minhash,
    curve_packing,
    id_files,
    license_alignment,
    line_hashing,
    positional_index,
    prefix_trie,
    quality_rules,
    secret_ledger,
    spelling_blocks,
    subword_classifier,
    template_tree,
    vertical_join,
)
from tillwork.llm.oracles import SQL  # noqa: F401
from tillwork.llm.shipping import ship
from tillwork.session import fresh_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; every query reads its inputs here, after its code is shipped."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_template_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines whose template recurs, the first occurrence excepted."""
    return template_tree.cleaned(table(spark, sf_dir, "documents"))


def op2_license_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The license of every document, by alignment with public notices and texts."""
    return license_alignment.scan(table(spark, sf_dir, "documents"))


def op3_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, by way of a ledger that starts empty."""
    found = secret_ledger.scan(table(spark, sf_dir, "documents"), fresh_dir(spark, "ledger"))
    base = [r.kind for r in secret_ledger.BASE_RULES]

    def joined(spans):
        return F.array_join(
            F.transform(spans, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ","
        )

    of_base = F.filter("findings", lambda f: f["kind"].isin(*base))

    def counted(kind: str):
        return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *(counted(kind).alias(f"n_{kind}") for kind in base),
        F.sha2(joined(of_base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("findings")).alias("spans"),
    )


def op4_line_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated units of 25 words or more in all documents, with original offsets."""
    return line_hashing.repeated_units(table(spark, sf_dir, "documents"))


def op5_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and items of the benchmark that every document holds."""
    found = positional_index.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    listed = F.array_join("item_ids", ",")
    return found.select(
        "key.doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(listed.cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op5_proximity_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows that every document holds, exact and as proximity matches."""
    found = positional_index.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("key.doc_id", "n_words", "n_exact", "n_near")


def op6_subword_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, trained on labels outside the held-out part."""
    docs = table(spark, sf_dir, "documents")
    model = subword_classifier.fit(docs, table(spark, sf_dir, "labels"))
    return subword_classifier.scored(docs, model)


def op7_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 4096 ids, neighbours on the curve together."""
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return curve_packing.pack(table(spark, sf_dir, "documents"), tokenizer)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of the threshold table for every document."""
    return quality_rules.measured(table(spark, sf_dir, "documents"))


def op9_vertical_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents on five-word shingles, similarity 0.8."""
    found = vertical_join.join(table(spark, sf_dir, "documents"))
    return found.select("key.doc_id", "n_shingles", "component_id", "class_id")


def op10_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and checksum, read back from the files of token ids."""
    folder = fresh_dir(spark, "ids")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    id_files.write(table(spark, sf_dir, "documents"), folder, tokenizer)
    return id_files.documents(spark, folder)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations, with members, ends and subtree sums."""
    return prefix_trie.trie(prefix_trie.rebuilt(table(spark, sf_dir, "conversations")))


def op12_bayesian_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents on four-word shingles, similarity 0.8."""
    found = bayesian_minhash.near_duplicates(table(spark, sf_dir, "documents"))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    return found.select("key.doc_id", "n_shingles", "component_id", "class_id").select("*", kept)


def op13_spelling_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the vocabulary with its near words, form and root."""
    return spelling_blocks.variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_template_tree": op1_template_tree,
    "op2_license_alignment": op2_license_alignment,
    "op3_secret_ledger": op3_secret_ledger,
    "op4_line_hashing": op4_line_hashing,
    "op5_positional_index": op5_positional_index,
    "op5_proximity_hits": op5_proximity_hits,
    "op6_subword_classifier": op6_subword_classifier,
    "op7_curve_packing": op7_curve_packing,
    "op8_quality_rules": op8_quality_rules,
    "op9_vertical_join": op9_vertical_join,
    "op10_id_files": op10_id_files,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_bayesian_minhash": op12_bayesian_minhash,
    "op13_spelling_blocks": op13_spelling_blocks,
}
