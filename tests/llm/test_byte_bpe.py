import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from ledgerline.llm import byte_bpe
from ledgerline.llm.queries import QUERIES

from .conftest import ODD_ROWS

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = byte_bpe.read_ranks(PATH)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def texts():
    rnd = random.Random(5)
    found = ["", None, "a" * 900, "ab" * 500, "é" * 300, " " * 500 + "x", "\n\n \t x  y", "it's we'll I'm", "日本語" * 40, "1234567890" * 20,
             "🎉" * 30 + "ab", "aaab" * 150, "\x1c \x85\xa0x", "".join(rnd.choice("etaoinshr") for _ in range(700))]
    return found + ["".join(rnd.choice("aeiouns tr'1é") for _ in range(rnd.randint(1, 300))) for _ in range(80)]


def test_same_as_library(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "WORD_BYTES", 300)
    encoder = byte_bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    for block in (texts(), texts()):  # the second time from memory
        offsets, ids = encoder.block(block)
        for i, text in enumerate(block):
            assert ids[offsets[i]:offsets[i + 1]].tolist() == library.encode_ordinary(text or "")
        monkeypatch.setattr(byte_bpe, "REMEMBERED", 0)


def test_round_trip_and_odd_rows(odd, library):
    found = byte_bpe.round_trip(odd, PATH, public_tokenizers.PATTERN).collect()
    assert sorted(map(str, ((r.doc_id, bytes(r.decoded).decode()) for r in found))) == sorted(map(str, ((i, t or "") for i, t, _ in ODD_ROWS)))
    assert all(r.ids == library.encode_ordinary(bytes(r.decoded).decode()) for r in found)


def test_decoding_has_no_aggregate_and_skips_unknown_ids(spark, monkeypatch):
    monkeypatch.setattr(byte_bpe, "BLOCK_IDS", 3)
    assert "agg" not in byte_bpe.DECODING.lower()  # bytes are put in order by their places
    rows = [(0, [5, 300, 5]), (1, None), (2, []), (3, [10**6, 7, None, 9, 10**6]), (4, [8] * 9), (5, [10**6]), (6, [1])]
    piece = {rank: p for p, rank in RANKS.items()}
    decoded, name = byte_bpe.decode(spark.createDataFrame(rows, "n int, ids array<int>").coalesce(1), RANKS)
    got = {r.n: bytes(r[name]) for r in decoded.collect()}
    assert got == {n: b"".join(piece.get(i, b"") for i in ids or []) for n, ids in rows}


def test_empty_table_and_clashing_name(empty, odd):
    assert byte_bpe.round_trip(empty, PATH, public_tokenizers.PATTERN).collect() == []
    encoded, name = byte_bpe.encode(odd, RANKS, public_tokenizers.PATTERN)
    assert name != "ids" and set(encoded.columns) == {*odd.columns, name}
    decoded, data = byte_bpe.decode(encoded, RANKS, name)
    assert all(bytes(r[data]).decode() == (r.text or "") for r in decoded.collect())


def test_query(spark, odd, tmp_path, library):
    odd.select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for i, text, _ in ODD_ROWS:
        ids = library.encode_ordinary(text or "")
        want.append(str((i, len(ids), sha(" ".join(map(str, ids)).encode()), sha((text or "").encode()))))
    assert sorted(want) == sorted(str(tuple(r)) for r in QUERIES["op3_byte_bpe"](spark, str(tmp_path)).collect())
