import random
import zlib

import numpy as np
import pytest
from corpora import documents, no_docs, odd_docs, odd_rows
from tokenizers import Tokenizer

from wicklake.llm import tokens
from wicklake.llm.common import table
from wicklake.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


def brute(tokenizer, rows):
    start, out = 0, {}
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        out[doc_id] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    return out


def test_whole_table_equals_direct_encoding(spark, small, tokenizer):
    got = tokens.encode_documents(table(spark, small, "documents"), tokenizer_path()).collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in got} == brute(tokenizer, [(d, t) for d, t, _, _ in documents(small)])


def test_pieces_equal_whole_texts(tokenizer):
    rng, encoder = random.Random(11), tokens.PieceEncoder(tokenizer_path())
    alphabet = [" ", " ", "  ", "\n", "\t", "a", "Be", "don't", "12", "é", "ß.", "…", " ", " ", "x\n", "😀", "'s", "\x00", "<|endoftext|>"]
    texts = ["", " ", "  ", "a ", " a", "a \nb", "a\n b", "a \n b", *("".join(rng.choices(alphabet, k=rng.randint(1, 30))) for _ in range(3000))]
    for some in (texts, texts[::-1]):
        for text, ids in zip(some, encoder.encode(some)):
            assert list(ids) == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_forgetting_pieces(tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "_MOST_PIECES", 5)  # more pieces are known for a batch only
    encoder = tokens.PieceEncoder(tokenizer_path())
    for text in ("one two three four", "five six seven eight one two", "one two nine"):
        assert list(encoder.encode([text])[0]) == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("planes", ["byte", "bit"])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 64, 100, 1000])
def test_planes_round_trip(planes, n):
    ids = np.random.default_rng(n).integers(0, 2**32 if n % 2 else 50257, n, dtype=np.uint32)
    body, sizes = tokens.pack(ids, planes, block=64)
    assert (tokens.unpack(b"".join(body), sizes, n, planes, block=64) == ids).all()
    if planes == "bit" and n == 64:
        plane = np.unpackbits(np.frombuffer(tokens.zstandard.ZstdDecompressor().decompress(body[3]), np.uint8))[:n]
        assert (plane == (ids >> 3 & 1)).all()


def test_odd_rows_small_chunks(spark, tokenizer):
    path = tokens.fresh_dir(spark, "odd")
    tokens.write(odd_docs(spark), tokenizer_path(), path, planes="bit", block=16, chunk=32)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in tokens.read(spark, path).collect())
    rows = sorted(((r[0], r[1]) for r in odd_rows()), key=lambda r: (r[0] is not None, r[0] or 0))
    start = 0
    for (doc_id, text), row in zip(rows, got):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        assert row == (start, doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len(got) == len(rows)


def test_no_rows(spark):
    assert tokens.encode_documents(no_docs(spark), tokenizer_path()).collect() == []
