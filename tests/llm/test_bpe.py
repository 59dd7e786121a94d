import base64
import hashlib
import struct

import public_tokenizers as P
import pytest
import tiktoken

from skein.llm import bpe


@pytest.fixture(scope="module")
def tik():
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def brute_offsets(tik, text, ids):
    """Starts, ends and the number of tokens that begin inside a character, byte by byte."""
    of = [i for i, c in enumerate(text) for _ in c.encode()]
    begins = [k == 0 for c in text for k, _ in enumerate(c.encode())]
    starts, ends, split, at = [], [], 0, 0
    for i in ids:
        n = len(tik.decode_single_token_bytes(i))
        starts.append(of[at])
        ends.append(of[at + n - 1] + 1)
        split += not begins[at]
        at += n
    assert at == len(of)
    return starts, ends, split


def brute(tik, text):
    text = text or ""
    ids = tik.encode_ordinary(text)
    starts, ends, split = brute_offsets(tik, text, ids)
    offsets = hashlib.sha256(struct.pack(f"<{2 * len(ids)}i", *starts, *ends)).hexdigest()
    return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), offsets, split


def test_query_against_library(spark, sf, tik):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = bpe.op7_byte_bpe(spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256, r.offsets_sha256, r.n_split) == brute(tik, docs[r.doc_id])


def test_odd_rows(odd, odd_dir, none_dir, spark, tik):
    got = sorted(tuple(r) for r in bpe.op7_byte_bpe(spark, odd_dir).collect())
    assert got == sorted((r.doc_id, *brute(tik, r.text)) for r in odd.collect())
    assert bpe.op7_byte_bpe(spark, none_dir).count() == 0


def test_offsets_and_round_trip(odd):
    v = P.path("byte_bpe_50k.json")
    coded = bpe.encode(odd, v, P.PATTERN)
    back = bpe.decode(coded, v, P.PATTERN)
    for r in back.collect():
        text = r.text or ""
        assert r.decoded == text
        assert len(r.ids) == len(r.starts) == len(r.ends)
        if text:
            assert r.starts[0] == 0 and r.ends[-1] == len(text)
            assert all(a < b for a, b in zip(r.starts, r.ends))
            assert all(b >= a2 for b, a2 in zip(r.ends, r.starts[1:]))
    assert "score" in coded.columns


def test_split_characters_and_special_strings(spark, tik):
    c = bpe.codec(P.path("byte_bpe_50k.json"), P.PATTERN)
    for text in ["<|endoftext|> x", "𝒳𝒴", "é", "a\x1cb\x1d \x1e", " 　x​᠎", "don't  WE'LL", "\r\n \r\n", "x" * 300]:
        ids = c.encode([text])[0]
        assert ids == tik.encode_ordinary(text)
        starts, ends, split = c.offsets(text, ids)
        assert (starts.tolist(), ends.tolist(), split) == brute_offsets(tik, text, ids)
        assert c.decode(ids) == text
    ids = c.encode(["𝒳"])[0]
    assert len(ids) > 1 and c.decode(ids[:1]) == "�"


def test_caches_and_joined_pieces(monkeypatch, tik):
    c = bpe.Codec(P.path("byte_bpe_50k.json"), P.PATTERN)
    texts = ["it's 'sx ''s \x1c\x1d a\n\n b \t c ?!\n", "<|endoftext|>\n<|endoftext|> é☃ 12 ½ ⅷ", " 's 're'll '", "\u2028x\u00a0y\x85z", ""] + ["w%d " % i * 3 for i in range(50)]
    monkeypatch.setattr(bpe, "CACHE_PIECES", 20)
    monkeypatch.setattr(bpe, "JOINED", 7)
    monkeypatch.setattr(bpe, "CACHE_CHARS", 6)
    for part in (texts, texts[:3], texts[3:]):
        assert c.encode(part) == [tik.encode_ordinary(t) for t in part]
        assert c.digest(part) == [brute(tik, t) for t in part]


def test_clashing_names(odd):
    with pytest.raises(ValueError):
        bpe.encode(odd, P.path("byte_bpe_50k.json"), P.PATTERN, ids="Score")
