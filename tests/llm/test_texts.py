import random
import re

import numpy as np
import pytest

from talkmill.llm import host_rules, line_index, private_spans, telephony, url_tree, warc_bundles
from tests.llm import brute

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def base_spans(t):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [(m.start(), m.end(), "email") for m in EMAIL.finditer(t)]
    out += [(m.start(), m.end(), "ip") for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), m.end(), "card") for m in CARD.finditer(t) if 14 <= len(digits(m)) <= 19 and private_spans.luhn(digits(m))]
    out += [(m.start(), m.end(), "phone") for m in PHONE.finditer(t) if 10 <= len(digits(m)) <= 15]
    return sorted(out, key=lambda s: (s[0], private_spans.KINDS.index(s[2])))


def test_base_spans_equal_the_patterns():
    rnd = random.Random(1)
    for _ in range(30_000):
        t = "".join(rnd.choice("aB1122334455.@@ -+()9é\n") for _ in range(rnd.randint(0, 60)))
        assert [s for s in private_spans.spans(t) if s[2] in private_spans.BASE] == base_spans(t), t


def test_added_spans():
    kinds = lambda t: [(k, t[a:b]) for a, b, k in private_spans.spans(t)]
    assert ("account", "DE89 3704 0044 0532 0130 00") in kinds("Your IBAN: DE89 3704 0044 0532 0130 00.")
    assert not [k for k in kinds("IBAN: DE89 3704 0044 0532 0130 01") if k[0] == "account"]
    assert ("ssn", "123-45-6789") in kinds("no 123-45-6789 here")
    assert ("secret", "04dbebab91ab85687d33") in kinds('token = "04dbebab91ab85687d33"')
    assert ("url", "https://a.example/x?y") in kinds("see (https://a.example/x?y).")


def test_find_and_redact(spark):
    rows = [(1, "mail a@b.cd now", "x", "s"), (2, None, "x", "s"), (3, "", "x", "s"), (None, "card 4111 1111 1111 1111", "x", "s"), (5, "plain " * 9000, "x", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string, row string")
    found = {r.doc_id: [(s.start, s.end, s.kind) for s in r.spans] for r in private_spans.find(df).collect()}
    assert found == {1: [(5, 11, "email")], 2: [], 3: [], None: [(5, 24, "card")], 5: []}
    out = {r.doc_id: r.text for r in private_spans.redact(df).collect()}
    assert out == {1: "mail <EMAIL> now", 2: None, 3: "", None: "card <CARD>", 5: "plain " * 9000}
    assert private_spans.redact(df).columns == df.columns
    assert private_spans.find(df.limit(0)).count() == 0


LINES = ["the first long line", "The FIRST long line  ", "short", "another long line here", "é" * 10, "é" * 9, "", " \t"]


def some_docs(n=40):
    rnd = random.Random(2)
    return {i: None if i == 3 else "\n".join(rnd.choice([*LINES, f"only in {i} once"]) for _ in range(rnd.randint(0, 6))) for i in range(n)}


def test_line_dedup_equals_brute_force(spark):
    docs = some_docs()
    df = spark.createDataFrame([(d, t, 1) for d, t in docs.items()], "doc_id long, text string, keys long")
    out = line_index.dedup(df)
    want = brute.line_dedup(docs)
    assert {r.doc_id: r.text for r in out.collect()} == want | {3: None}
    assert out.columns == df.columns
    assert line_index.dedup(df.limit(0)).count() == 0


def test_line_index_is_reversible(spark):
    docs = some_docs()
    first, second = ({d: t for d, t in docs.items() if d % 3 != k} for k in (0, 9))
    second = {d: t for d, t in docs.items() if d % 3 == 0}
    frame = lambda x: spark.createDataFrame(list(x.items()), "doc_id long, text string")
    index = line_index.LineIndex(spark)
    index.insert(frame(first))
    before = (sorted(map(tuple, index.counts().collect())), {r.shard: r.blob for r in index.filters.collect()})
    index.insert(frame(second))
    assert {r.doc_id: r.text for r in index.dedup(frame(docs)).collect()} == brute.line_dedup(docs) | {3: None}
    index.delete(frame(second))
    assert sorted(map(tuple, index.counts().collect())) == before[0]
    held = {r.shard: np.sort(np.frombuffer(r.blob, np.uint16)).tolist() for r in index.filters.collect()}
    assert held == {k: np.sort(np.frombuffer(v, np.uint16)).tolist() for k, v in before[1].items()}


def test_filters_name_the_lines_that_are_counted(spark, monkeypatch):
    """Small slices send every key through the filters; what they do not note is not dropped."""
    monkeypatch.setattr(line_index, "ASK_ROWS", 2)
    monkeypatch.setattr(line_index, "TASK_ROWS", 2)
    docs = {d: "\n".join([f"a line of document {d}", f"a line of some {d % 5}", "a line of all of them"]) for d in range(30)}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(4)
    index = line_index.LineIndex(spark)
    index.insert(df)
    assert {r.doc_id: r.text for r in index.dedup(df).collect()} == brute.line_dedup(docs)
    keys = lambda x: {tuple(r) for r in x.select("hi", "lo").collect()}
    assert keys(index.counts().filter("n > 1")) <= keys(index.noted) and len(keys(index.noted)) < len(keys(index.counts()))
    index.noted = index.noted.limit(0)
    assert {r.doc_id: r.text for r in index.dedup(df).collect()} == docs


def test_a_deleted_line_comes_back_on_a_false_positive(spark, monkeypatch):
    """A filter that takes all keys for held ones: the log must tell that the key does not stand."""
    frame = lambda d, text: spark.createDataFrame([(d, text)], "doc_id long, text string")
    index = line_index.LineIndex(spark)
    index.insert(frame(1, "a line that stays here"))
    index.insert(frame(2, "a line that comes and goes"))
    held = lambda: [int((np.frombuffer(r.blob, np.uint16) > 0).sum()) for r in index.filters.collect()]
    index.delete(frame(2, "a line that comes and goes"))
    assert held() == [1]
    (key,) = line_index.line_keys(frame(2, "a line that comes and goes")).collect()
    own = line_index.CuckooFilter.load(index.filters.first().blob)
    print_, at = own.places(np.array([key.lo]))
    own.table[at[0], -1] = print_[0]  # another key's fingerprint, equal to that of this one
    index.filters = spark.createDataFrame([(0, own.dump())], "shard int, blob binary")
    index.insert(frame(3, "a line that comes and goes"))
    assert held() == [3]


def test_cuckoo_filter():
    keys = np.random.default_rng(3).integers(-(1 << 62), 1 << 62, 5000)
    own = line_index.CuckooFilter(5000)
    assert own.insert(keys) and own.contains(keys).all()
    own = line_index.CuckooFilter.load(own.dump())
    assert own.contains(np.random.default_rng(4).integers(-(1 << 62), 1 << 62, 5000)).mean() < 0.01
    own.remove(keys[:2500])
    assert own.contains(keys[2500:]).all() and (own.table > 0).sum() == 2500
    assert not line_index.CuckooFilter(10).insert(keys)


def test_host_rules(spark):
    good, bad = "the quick brown fox jumps over it " * 1, "spam "
    text = lambda i: " ".join(f"w{i}x{j}" for j in range(60))
    rows = [(i, text(i), "good", 7) for i in range(30)] + [(100 + i, bad * 100, "bad", 7) for i in range(60)] + [(200, text(200), "bad", 7), (300, None, None, 7), (301, text(301), None, 7), (302, good, "good", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, host long")
    kept = {r.doc_id: (r.kept, r.host_rejected) for r in host_rules.judge(df).collect()}
    assert all(kept[i] == (True, False) for i in range(30))
    assert kept[200] == (False, True) and kept[100] == (False, True)
    assert kept[300] == (False, False) and kept[301][0] and kept[302] == (False, False)
    out = host_rules.keep_good(df)
    assert out.columns == df.columns and {r.doc_id for r in out.collect()} == {d for d, (k, _) in kept.items() if k}
    assert host_rules.judge(df.limit(0)).count() == 0
    assert host_rules.measure_text("a b c a b c\nx\nx\n\n\n#é".encode()) == (9, 10, 1, 1, 6)


def test_url_tree(spark):
    from pyspark.sql import functions as F

    rows = [(i, f"http://H.org/spam/{i}", 1 if i < 12 else None) for i in range(20)] + [(50 + i, f"http://h.org/news/{i}", 0 if i < 12 else None) for i in range(20)] + [(90, None, None), (91, "no scheme", None), (92, "x://www.example.com/en/1", None), (93, "x://example.com/en/1?q", None), (94, "x://a.net/fr/#t", None), (95, "http://host.com", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, mark int")
    out = {r.page_id: r for r in url_tree.judge(df, label=F.col("mark")).collect()}
    assert {out[i].verdict for i in range(20)} == {"block"} and {out[50 + i].verdict for i in range(20)} == {"allow"}
    assert out[19].template_rejected and out[19].host == "h.org" and out[19].rule is None
    assert [(out[i].host, out[i].path, out[i].rule, out[i].verdict) for i in range(90, 96)] == [("", "", None, "allow"), ("", "", None, "allow"), ("www.example.com", "/en/1", "www.example.com/en/", "allow"), ("example.com", "/en/1", "example.com/en/", "block"), ("a.net", "/fr/", "net/fr/", "block"), ("host.com", "", None, "allow")]
    assert url_tree.judge(df.limit(0)).count() == 0


def test_warc_round_trip(spark):
    rows = [(1, "u1", "same"), (2, "u2", "same"), (3, "u\r\n3", None), (4, None, ""), (5, "u", "é" * 5000), (None, "u", "same"), (9, "u", "same\r\n\r\nWARC/1.1")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, bundle string")
    where = warc_bundles.folder(spark)
    manifest = warc_bundles.write(df, where, frame_bytes=500)
    got = {r.page_id: r for r in warc_bundles.read(manifest, where).collect()}
    assert {k: (r.record_type, r.refers_to) for k, r in got.items()} == {1: ("revisit", 2), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None), 5: ("response", None), None: ("revisit", 2), 9: ("response", None)}
    for key, _, html in rows:
        data = (html or "").encode()
        assert got[key].payload_bytes == len(data) and got[key].payload_digest == warc_bundles.digest(data)
    row = manifest.filter("page_id = 9").first()
    assert warc_bundles.payload(row, where)[1] == b"same\r\n\r\nWARC/1.1"
    fs, base = warc_bundles.file_system(where)
    for name in {r.bundle for r in manifest.collect()}:
        data = fs.open_input_file(f"{base}/{name}").read()
        assert {(a, b) for a, b, _ in warc_bundles.seek_table(data)} == {(r.frame_start, r.frame_bytes) for r in manifest.collect() if r.bundle == name}
    assert warc_bundles.read(warc_bundles.write(df.limit(0), where), where).count() == 0


def slow_adpcm(block):
    value, index = int.from_bytes(block[:2], "little", signed=True), min(block[2], 88)
    out = [value]
    for byte in block[4:]:
        for n in (byte & 15, byte >> 4):
            step = int(telephony.STEPS[index])
            delta = (step >> 3) + step * (n >> 2 & 1) + (step >> 1) * (n >> 1 & 1) + (step >> 2) * (n & 1)
            value = max(-32768, min(32767, value + (-delta if n & 8 else delta)))
            index = max(0, min(88, index + (-1, -1, -1, -1, 2, 4, 6, 8)[n & 7]))
            out.append(value)
    return out


def test_codecs():
    raw = np.random.default_rng(5).integers(0, 256, 64 * 30, dtype=np.uint8)
    assert telephony.adpcm(raw).tolist() == [slow_adpcm(raw[i : i + 64].tobytes()) for i in range(0, len(raw), 64)]
    mulaw, alaw = telephony.tables()
    assert mulaw[[0, 127, 128, 255]].tolist() == [-32124, 0, 32124, 0]
    assert alaw[[0x55, 0xD5, 0x2A, 0xAA]].tolist() == [-8, 8, -32256, 32256]
    assert len(set(alaw.tolist())) == 256
    assert telephony.resample(np.array([0, 10, 20], np.int16)).tolist() == [0, 5, 10, 15, 20, 20]
    for tag in (telephony.ALAW, telephony.MULAW, telephony.ADPCM):
        assert telephony.parsed(telephony.wav(raw.tobytes(), tag)) == (tag, 8000, 64 if tag == 17 else 1, raw.tobytes())
    with pytest.raises(ValueError):
        telephony.parsed(b"x" * 60)


def test_media_round_trip(spark):
    import hashlib
    import zlib

    rows = [(1, "hello"), (2, None), (3, ""), (4, "é" * 64), (5, "hello"), (None, "x" * 30_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    stored = telephony.store(df)
    got = {r.doc_id: r for r in telephony.features(stored).collect()}
    for key, text in rows:
        data = (text or "").encode()
        payload = telephony.padded(data)
        r = got[key]
        assert len(payload) % 64 == 0 and payload.startswith(data) and len(payload) - len(data) <= 64
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
    assert got[1].feature == got[5].feature and got[1].media_sha256 == got[5].media_sha256
    assert {r.doc_id: len(r.pcm) for r in telephony.to_pcm(stored).collect()}[1] == 64 * 2 * 2
    assert telephony.features(telephony.store(df.limit(0))).count() == 0


def test_pcm_is_stored(spark, tmp_path):
    df = spark.createDataFrame([(1, "hello"), (2, None), (3, "é" * 640)], "doc_id long, text string")
    media = telephony.store(df)
    got = {r.doc_id: r.feature for r in telephony.features(media, str(tmp_path / "pcm")).collect()}
    held = {r.doc_id: telephony.opened(bytes(r.pcm)).tobytes() for r in spark.read.parquet(str(tmp_path / "pcm")).collect()}
    assert held == {r.doc_id: bytes(r.pcm) for r in telephony.to_pcm(media).collect()}
    import zlib

    assert all(got[d].startswith(f"pcm:{len(x) // 2}:{zlib.crc32(x):08x};") for d, x in held.items())
