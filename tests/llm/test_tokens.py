"""Encoding, id files and packing against plain loops over the tokenizers library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillwork.llm import curve_packing, id_files
from tillwork.llm.encoding import Encoder
from tillwork.session import fresh_dir

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
BITS = [
    "a", "B", " ", "  ", "\n", "\t", "İ", "é", "'s", "'", "don't", ".", "!!", "<|endoftext|>",
    "<|ENDOFTEXT|>", "1", "23", " ", "　", "ﬁ", "中文", "😀", "Σ", "ς", "…", "<|", "|>",
    "́", "x.", "Word,", "Ñ", "ß", "\x85", "\x1c",
]


@pytest.mark.parametrize("path,spaced,folded", [(BYTES, True, False), (WORDS, False, True)])
def test_pieces_give_the_ids_of_whole_texts(path, spaced, folded):
    rng = random.Random(1)
    texts = ["".join(rng.choice(BITS) for _ in range(rng.randrange(14))) for _ in range(4000)]
    counts, ids = Encoder(path, spaced, folded).encode(pa.array([*texts, None]))
    whole = Tokenizer.from_file(path)
    want = [e.ids for e in whole.encode_batch([*texts, ""], add_special_tokens=False)]
    got = [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])]
    assert got == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=300), st.integers(0, 3))
def test_elias_fano_round_trip(gaps, zeros):
    values = np.cumsum([0] * zeros + gaps + [0]).astype(np.int64)
    data = memoryview(id_files.EliasFano.of(values).to_bytes())
    read, taken = id_files.EliasFano.read(data)
    assert taken == len(data) and read.select(0, len(values)).tolist() == values.tolist()
    assert [int(read.select(i)[0]) for i in range(len(values))] == values.tolist()
    assert read.select(len(values) // 3, len(values)).tolist() == values[len(values) // 3 :].tolist()


def test_select_over_huge_gaps_reads_few_bits():
    """One gap among very many small ones: its sample keeps its places."""
    values = np.cumsum(np.where(np.arange(50_000) == 30_000, 10_000_000, 1)).astype(np.int64)
    held = id_files.EliasFano.of(values)
    assert len(held.wide) == 1 and held.wide[0] == 29_999 // id_files.SAMPLE
    spots = [0, 29_998, 29_999, 30_000, 30_001, 30_080, 49_999]
    assert [int(held.select(i)[0]) for i in spots] == values[spots].tolist()
    with pytest.raises(IndexError):
        held.select(50_000)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(-(2**63), 2**63 - 1), max_size=200), st.integers(0, 3))
def test_document_ids_round_trip(ids, nulls):
    want = [None] * nulls + sorted(ids)
    names = id_files.unpack_names(id_files.pack_names(pa.array(want, pa.int64())))
    assert names(0, len(want)).to_pylist() == want
    assert [names(k, k + 1).to_pylist()[0] for k in range(len(want))] == want


def test_elias_fano_is_small():
    values = np.arange(0, 600_000, 600)
    assert len(id_files.EliasFano.of(values).to_bytes()) < 2 * len(values)


DOCS = [(5, "Some text here."), (2, None), (None, "no id"), (3, ""), (3, "again " * 3000), (5, "Some text here."), (-4, "<|endoftext|> x")]


def ids_of(text, path):
    whole = Tokenizer.from_file(path)
    return np.array(whole.encode(text or "", add_special_tokens=False).ids + [2], "<u4")


def test_id_files_round_trip(spark, corpus):
    folder = fresh_dir(spark, "ids")
    id_files.write(corpus(*DOCS).withColumn("start", F.lit(1)), folder, BYTES, block_ids=100)
    got = sorted(id_files.documents(spark, folder).collect(), key=lambda r: r.start)
    order = sorted(DOCS, key=lambda d: (d[0] is not None, d[0] or 0))
    assert [r.doc_id for r in got] == [d[0] for d in order]
    start = 0
    for r in got:
        assert r.start == start
        start += r.n_tokens
    assert {(r.n_tokens, r.ids_crc32) for r in got} == {
        (len(x), zlib.crc32(x)) for x in (ids_of(t, BYTES) for _, t in DOCS)
    }
    empty = fresh_dir(spark, "ids")
    id_files.write(corpus(*DOCS).where("false"), empty, BYTES)
    assert id_files.documents(spark, empty).count() == 0


def test_packing_places_every_id_once(spark, corpus):
    got = curve_packing.pack(corpus(*DOCS), WORDS, length=64).collect()
    total = sum(len(ids_of(t, WORDS)) for _, t in DOCS)
    spots = sorted((r.sequence_id * 64 + r.offset, r.length) for r in got)
    at = 0
    for place, length in spots:
        assert place == at and place // 64 == (place + length - 1) // 64
        at += length
    assert at == total
    lone = [r for r in got if r.doc_id == -4]
    x = ids_of("<|endoftext|> x", WORDS)
    assert [(r.start, zlib.crc32(x[r.start : r.start + r.length])) for r in lone] == [(r.start, r.ids_crc32) for r in lone]
    assert curve_packing.pack(corpus(*DOCS).where("false"), WORDS).count() == 0


def test_hilbert_curve_visits_every_cell_by_neighbours():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), axis=-1).reshape(-1, 3)
    keys = curve_packing.hilbert_keys(cells, 3)
    assert sorted(keys.tolist()) == list(range(512))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_a_task_tokenizes_bounded_text(monkeypatch):
    """A batch is cut into parts of TOKENIZED_BYTES before its words are; pieces do not depend on it."""

    class Context:
        get = staticmethod(lambda: Context)
        partitionId = staticmethod(lambda: 3)

    seen = []
    encode = Encoder.encode

    def counted(self, texts, pieces=None):
        seen.append(texts.nbytes)
        return encode(self, texts, pieces)

    monkeypatch.setattr(Encoder, "encode", counted)
    monkeypatch.setattr(curve_packing, "TaskContext", Context)
    texts = [f"word{i % 50} and more " * 2_000 for i in range(200)] + [None, ""]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts))), "text": pa.array(texts)})

    def tokens():
        made = list(curve_packing._tokenized(WORDS, 2, False, True)(iter([batch])))
        return pa.Table.from_batches(made).to_pylist()

    cut = tokens()
    assert batch.nbytes > 6_000_000 and max(seen) < 3_200_000
    monkeypatch.setattr(curve_packing, "TOKENIZED_BYTES", 1 << 40)
    assert cut == tokens() and [r["row"] for r in cut] == [(3 << 33) + i for i in range(len(texts))]
