import hashlib
import zlib

import numpy as np
import pytest

from skein.llm import media


def brute_fingerprints(samples):
    """One frame and one bin at a time."""
    x = [(b - 128) / 128 for b in samples]
    n = 1
    while (n - 1) * media.HOP + media.FRAME < len(x):
        n += 1
    frames = []
    for i in range(n):
        part = x[i * media.HOP : i * media.HOP + media.FRAME]
        part += [0.0] * (media.FRAME - len(part))
        mags = np.abs(np.fft.rfft(np.array(part, np.float32) * media.WINDOW))
        row = []
        for a, b in zip(media.BANDS, media.BANDS[1:]):
            best = a + int(np.argmax(mags[a:b]))
            row.append(best if mags[best] > media.FLOOR * mags[media.BANDS[0] :].mean() else None)
        frames.append(row)
    out = []
    for t, row in enumerate(frames):
        for b, one in enumerate(row):
            for step in range(1, media.FAN + 1):
                for to in (b, b + 1):
                    if one is not None and t + step < n and to < len(row) and frames[t + step][to] is not None:
                        out.append((t, one << 16 | frames[t + step][to] << 4 | step))
    return sorted(out)


def test_query_against_plain_bytes(spark, sf):
    docs = {r.doc_id: r.text.encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = media.op6_wav_fingerprints(spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        p = docs[r.doc_id]
        p += b"\0" * (-len(p) % 64)
        assert (r.n_bytes, r.payload_bytes) == (len(docs[r.doc_id]), len(p))
        assert r.payload_sha256 == hashlib.sha256(p).hexdigest() and r.tail_crc32 == zlib.crc32(p[-64:])
        assert r.media_bytes == len(p) + 44
    assert len({r.feature for r in got}) >= len(set(docs.values())) * 0.9


def test_fingerprints_against_brute_force(spark, sf):
    made = {r.doc_id: r.feature for r in media.op6_wav_fingerprints(spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        payload = media.padded(r.text.encode())
        t, c = media.fingerprints(payload)
        want = brute_fingerprints(payload)
        assert list(zip(t.tolist(), c.tolist())) == want
        if len(payload) > media.FRAME:
            times, codes = (np.array(x, np.int32).tobytes() for x in (zip(*want) if want else ((), ())))
            assert made[r.doc_id] == f"{len(want)}:{hashlib.sha256(times + codes).hexdigest()}"


def test_blocks_do_not_matter(monkeypatch):
    data = np.random.default_rng(1).integers(0, 256, 100_000, dtype=np.uint8).tobytes()
    whole = media.fingerprints(data)
    monkeypatch.setattr(media, "BLOCK_FRAMES", 7)
    assert all((a == b).all() for a, b in zip(whole, media.fingerprints(data)))


def test_tone_gives_its_bin():
    tone = (128 + 100 * np.sin(2 * np.pi * 1000 * np.arange(8000) / media.RATE)).astype(np.uint8).tobytes()
    _, codes = media.fingerprints(tone)
    assert 32 in set((codes >> 16).tolist())


def test_odd_rows(spark, odd, odd_dir, none_dir):
    got = media.op6_wav_fingerprints(spark, odd_dir).collect()
    assert len(got) == odd.count()
    empty = [r for r in got if r.n_bytes == 0]
    assert {r.payload_bytes for r in empty} == {64} and len({tuple(r)[1:] for r in empty}) == 1
    assert media.op6_wav_fingerprints(spark, none_dir).count() == 0
    full = media.with_fingerprints(odd).collect()
    assert all(media.from_wav(bytes(r.wav)).rstrip(b"\0") == (r.text or "").encode().rstrip(b"\0") for r in full)
    with pytest.raises(ValueError):
        media.with_fingerprints(odd, media="Score")


def test_short_texts_have_their_own_fingerprints():
    texts = ["word", "wore", "a", "two words", *(f"a short text of number {k}, some words" * (1 + k % 6) for k in range(400))]
    made = [media.digest(t.encode())[-1] for t in texts]
    assert all(len(t) <= media.FRAME for t in texts) and not any(f.startswith("0:") for f in made)
    assert len(set(made)) >= 0.95 * len(set(texts)) and media.digest(b"word")[-1] == made[0]
