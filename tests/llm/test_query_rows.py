"""The queries themselves, through their columns, against plain versions on a small table with odd rows."""

import hashlib
import random
import time
import zlib
from collections import Counter

import numpy as np
import pytest

from talkmill.llm import private_spans, queries, repeats, telephony, warc_bundles
from tests.llm import brute


def sha(data):
    return hashlib.sha256(data).hexdigest()


def texts():
    rnd = random.Random(11)
    words = lambda n: " ".join(rnd.choice("alpha beta gamma delta x yy zzz été 12").strip() + str(rnd.randint(0, 40)) for _ in range(n))
    passage, long_one = words(60), words(300)
    rows = {1: words(90) + " " + passage + " " + words(20), 2: passage + "\n" + words(30), 3: long_one, 4: long_one + " and more", 5: None, 6: "", 7: "  \n", 8: words(3), 9: "a" * 450}
    rows |= {10: "mail a.b@c.de or +49 30 1234567 or 10.0.0.1 card 4111 1111 1111 1111 see https://x.org/a, token=abcdefghijkl0123", 11: rows_dup, 12: rows_dup}
    return rows


rows_dup = "the same line of text here\nagain and again " * 12


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("rows")
    rows = [(d, t, "en", "s", 0, "clash") for d, t in texts().items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, data string").write.parquet(str(base / "documents.parquet"))
    return str(base)


def covered(sequence, length, count):
    gone = np.zeros(len(sequence), bool)
    for i in range(len(sequence) - length + 1):
        if count[tuple(sequence[i : i + length])] > 1:
            gone[i : i + length] = True
    return gone


def runs(gone):
    return int((np.diff(gone.astype(int), prepend=0) == 1).sum())


def test_op8_rows(spark, table):
    docs = {d: (t or "").encode() for d, t in texts().items()}
    split = {d: t.split() for d, t in docs.items()}
    by_byte = Counter(tuple(t[i : i + 400]) for t in docs.values() for i in range(len(t) - 399))
    by_word = Counter(tuple(w[i : i + 50]) for w in split.values() for i in range(len(w) - 49))
    got = {r.doc_id: r for r in queries.op8_repeats(spark, table).collect()}
    assert set(got) == set(docs)
    for d, t in docs.items():
        gone, said = covered(t, 400, by_byte), covered(split[d], 50, by_word)
        r = got[d]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(t), int(gone.sum()), runs(gone), sha(np.frombuffer(t, np.uint8)[~gone].tobytes())), d
        assert (r.n_passages, r.n_passage_words) == (runs(said), int(said.sum())), d
    assert got[2].n_passage_words >= 60


def test_op8_ids_with_two_texts(spark):
    long_one = "".join(random.Random(3).choice("abcdefgh ") for _ in range(900))
    rows = [(1, long_one), (1, "tiny"), (1, long_one[:500]), (None, long_one[200:800]), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute.without_repeats([(t or "").encode() for _, t in rows], 400)
    got = sorted((r.n_bytes, r.kept_sha256) for r in repeats.report(df).collect())
    assert got == sorted((len((t or "").encode()), sha(w)) for (_, t), w in zip(rows, want, strict=True))


def test_op5_rows(spark, table):
    want = brute.near_components(texts(), 4, 80)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in queries.op5_chosen_path(spark, table).collect()}
    assert got == {d: (n, c, c == d) for d, (n, c) in want.items()}


def test_op3_rows(spark, table):
    got = {r.doc_id: r for r in queries.op3_private_spans(spark, table).collect()}
    for d, t in texts().items():
        own = private_spans.spans(t or "")
        base = [s for s in own if s[2] in private_spans.BASE]
        r = got[d]
        assert r.spans == private_spans.joined(own) and r.base_sha256 == sha(private_spans.joined(base).encode())
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[2] == k for s in base) for k in private_spans.BASE)
    assert (got[10].n_email, got[10].n_ip, got[10].n_card, got[10].n_phone) == (1, 1, 1, 1)


def test_op3_time_follows_the_text():
    for text in ("://a" * 250_000, "token=" * 170_000, "a@" * 500_000):
        began = time.perf_counter()
        private_spans.spans(text)
        assert time.perf_counter() - began < 10


def slow_feature(payload):
    def mulaw(b):
        b = ~b & 0xFF
        size = (((b & 15) << 3) + 132 << (b >> 4 & 7)) - 132
        return -size if b & 128 else size

    x = [mulaw(b) for b in payload]
    pcm = [v for a, b in zip(x, [*x[1:], x[-1]], strict=True) for v in (a, (a + b) // 2)]
    raw = np.array(pcm, "<i2").tobytes()
    flips = sum((a < 0) != (b < 0) for a, b in zip(pcm, pcm[1:], strict=False))
    return f"pcm:{len(pcm)}:{zlib.crc32(raw):08x};energy:{sum(v * v for v in pcm) // len(pcm)};peak:{max(map(abs, pcm))};flips:{flips};"


def test_op7_rows(spark, table):
    got = {r.doc_id: r for r in queries.op7_telephony(spark, table).collect()}
    for d, t in texts().items():
        data = (t or "").encode()
        payload = data + b"\0" * (max(64, -(-len(data) // 64) * 64) - len(data))
        media = telephony.wav(payload)
        r = got[d]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32, r.media_bytes, r.media_sha256) == (len(data), len(payload), sha(payload), zlib.crc32(payload[-64:]), len(media), sha(media))
        assert r.feature.startswith(slow_feature(payload))


def test_squeezed_pcm_is_whole(monkeypatch):
    rnd = np.random.default_rng(6)
    for n in (0, 1, 2, 3, 64, 101):
        pcm = rnd.integers(-32768, 32768, n).astype(np.int16)
        assert telephony.opened(telephony.squeezed(pcm)).tolist() == pcm.tolist()
    pcm = rnd.integers(-32768, 32768, 1000).astype(np.int16)
    whole, energy = telephony.resample(pcm).tolist(), telephony.energy(pcm)
    monkeypatch.setattr(telephony, "CHUNK", 7)
    assert telephony.resample(pcm).tolist() == whole and telephony.energy(pcm) == energy


def test_frames_are_held_against_the_seek_table(spark):
    df = spark.createDataFrame([(i, "u", f"page {i} " * 50) for i in range(30)], "page_id long, url string, html string")
    where = warc_bundles.folder(spark)
    manifest = warc_bundles.write(df, where, frame_bytes=2000)
    assert warc_bundles.read(manifest, where).count() == 30
    row = manifest.first()
    reader = warc_bundles.BundleReader(where)
    assert reader.frame(row.bundle, row.frame_start, row.frame_bytes).startswith(b"WARC/1.1")
    for start, size in ((row.frame_start + 1, row.frame_bytes), (row.frame_start, row.frame_bytes + 1)):
        with pytest.raises(ValueError):
            reader.frame(row.bundle, start, size)


def test_words_are_hashed_piece_by_piece(monkeypatch):
    text = " ab  cd\té ef\n" * 50 + "x" * 100
    whole = repeats.word_hashes(text.encode())
    assert len(whole) == len(text.split()) and len(set(whole.tolist())) == len(set(text.split()))
    monkeypatch.setattr(repeats, "WORD_BYTES", 9)
    assert repeats.word_hashes(text.encode()).tolist() == whole.tolist()
