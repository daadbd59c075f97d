"""Byte-level BPE and the alignment of two tokenizers against the libraries and a brute-force version."""

import base64
import hashlib
import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tastebud.llm import byte_bpe, token_align
from tastebud.llm.common import prepare
from tests.llm import brute as B

SF = "/root/testdata/sf0.01"
BITS = ["'s", "'t", "'re", "'ve", "'m", "'ll", "'d", "'", "’", " ", "  ", "\n", "\t", "\r\n", "a", "re", "don", "é", "日本", "9",
        "٣", "½", "!", "?", "...", "▁", "\x1c", " ", "　", "😀", "x" * 70, "ab" * 60, "<|endoftext|>", "<s>", "<0x41>",
        "\x00", "​", "é", "hello world"]


def soup(n, seed, size=25):
    rng = random.Random(seed)
    return ["".join(rng.choices(BITS, k=rng.randint(0, size))) for _ in range(n)]


@pytest.fixture(scope="module")
def table():
    return byte_bpe.load_ranks()


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken
    with open(byte_bpe.ranks_path(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    assert byte_bpe.PATTERN == public_tokenizers.PATTERN
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded(texts, table):
    ids, counts = byte_bpe.encode_texts(pa.array(texts, pa.string()), table)
    ends = np.r_[0, np.cumsum(counts)]
    return [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])]


def test_ids_are_the_librarys(table, library):
    texts = [*soup(3000, 1), None, "", " ", "\n\n", " " * 3000 + "x", " " * 3000, "é" * 5000, "ab" * 9000, "'" * 99]
    assert encoded(texts, table) == [library.encode_ordinary(x or "") for x in texts]
    assert encoded([], table) == []
    sliced = pa.array(texts, pa.string()).slice(7, 50)
    ids, _ = byte_bpe.encode_texts(sliced, table)
    assert ids.tolist() == [i for x in texts[7:57] for i in library.encode_ordinary(x)]


def test_both_trees_agree_with_plain_merging(table):
    pairs = table.pairs.ranks
    rng = random.Random(3)
    for _ in range(300):
        piece = bytes(rng.choices(b"aeinrst' \xc3\xa9", k=rng.randint(2, 60)))
        ids = [int(table.byte_rank[c]) for c in piece]
        while True:  # the lowest rank, of equal ones the leftmost
            best = min(((pairs.get(a * len(table.tokens) + b, 1 << 30), i) for i, (a, b) in enumerate(zip(ids, ids[1:]))),
                       default=(1 << 30, 0))
            if best[0] == 1 << 30:
                break
            ids[best[1]:best[1] + 2] = [best[0]]
        assert byte_bpe.merge_long(piece, table) == ids
        width = 1 << max(1, (len(piece) - 1).bit_length())
        row = np.zeros((1, width), np.int32)
        row[0, :len(piece)] = [table.byte_rank[c] for c in piece]
        token, start = byte_bpe.merge_together(row, np.array([len(piece)]), table.pairs)
        assert token[start].tolist() == ids


def test_a_long_piece_costs_no_square(table, library):
    text = "".join(random.Random(5).choices("etaoinshr", k=200_000))
    t0 = time.time()
    got = encoded([text], table)[0]
    assert time.time() - t0 < 20 and b"".join(table.tokens.take(pa.array(got)).to_pylist()).decode() == text
    assert encoded([text[:4000]], table)[0] == library.encode_ordinary(text[:4000])


def test_documents_with_odd_columns(spark, table, library):
    prepare(spark)
    texts = [*soup(40, 8), None, "", "x" * 3000, "same", "same"]
    rows = [(None if i % 9 == 0 else i // 2, x, "n", [1], b"") for i, x in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, ids array<int>, decoded binary")
    coded = byte_bpe.encode_documents(df, table)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids) for r in coded.collect())
    assert got == sorted((d is None, d or 0, len(w), w) for d, t, *_ in rows for w in [library.encode_ordinary(t or "")])
    back = byte_bpe.decode_documents(coded, table)
    assert sorted(bytes(r.decoded) for r in back.collect()) == sorted((t or "").encode() for t in texts)
    assert byte_bpe.encode_documents(df.where("doc_id = -1"), table).count() == 0
    none = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert [bytes(r.decoded) for r in byte_bpe.decode_documents(none, table).collect()] == [b""]


def test_op12_query_equals_the_library(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = E.queries()["op12_byte_bpe"](spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = library.encode_ordinary(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


@pytest.fixture(scope="module")
def pair():
    return token_align.load_pair()


def test_the_identity_map_keeps_bytes(pair):
    table = pair.b.table
    raw = table.raw.tobytes()
    for a, b in enumerate(pair.same.tolist()):
        if b >= 0:
            assert raw[table.raw_start[b]:][:table.raw_len[b]] == pair.a.tokens[a].as_py()
    assert (pair.same >= 0).sum() > 10_000


def test_merged_pieces_are_the_librarys(pair):
    import public_tokenizers
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path("piece_bpe_32k.model")))
    texts = [x for x in [*soup(2000, 9), "x" * 500, "é" * 300, " " * 200, "क्षत्रिय " * 40] if x and "▁" not in x]
    ids, counts = pair.b.encode_spaced(pa.array([" " + x for x in texts]))
    ends = np.r_[0, np.cumsum(counts)]
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == sp.encode(texts)


@pytest.mark.parametrize("pairs_a_slice", [1 << 22, 700])
def test_alignment_equals_brute_force(spark, pair, monkeypatch, pairs_a_slice):
    prepare(spark)
    monkeypatch.setattr(token_align, "SLICE_PAIRS", pairs_a_slice)
    texts = [*soup(150, 2), None, "", "x" * 2000, "same text", "same text", "▁ mark", "aaa"]
    rows = [(None if i % 40 == 0 else i // 2, x) for i, x in enumerate(texts)]
    df = spark.createDataFrame([(*r, 0, "g") for r in rows], "doc_id long, text string, n_a int, rid string").repartition(5)
    got = token_align.align_documents(df, pair).collect()
    assert sorted(map(tuple, got), key=str) == sorted(B.aligned(rows), key=str)
    assert token_align.align_documents(df.where("doc_id = -1"), pair).count() == 0


def test_pairs_handed_on_early_add_up(spark, pair, monkeypatch):
    """A task that forgets its counts between parts gives the same sums."""
    prepare(spark)
    rows = [(i, t) for i, t in enumerate(soup(60, 4))]
    batches = pa.RecordBatch.from_pylist([{"doc_id": d, "text": t} for d, t in rows])
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    want = sorted(B.aligned(rows), key=str)
    assert batches.num_rows == len(want)
    monkeypatch.setattr(token_align, "MAX_REMEMBERED", 10)
    monkeypatch.setattr(token_align, "PART_IDS", 50)
    assert sorted(map(tuple, token_align.align_documents(df, pair).collect()), key=str) == want


def test_op11_query_on_a_table_of_short_texts(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("text", F.substring("text", 1, 300)).orderBy("doc_id").limit(150)
    docs.coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, E.queries()["op11_token_alignment"](spark, str(tmp_path)).collect()))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    digest = lambda g: hashlib.sha256(g.encode()).hexdigest() if g else ""
    assert got == sorted((*r[:-1], digest(r[-1])) for r in B.aligned(rows))
