import os
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from talkmill.llm import packing, queries, sentence_pieces

T = queries.TOKENIZERS
pytestmark = pytest.mark.skipif(not os.path.isdir(T), reason="no tokenizer files")
ODD = ["", " ", "  ", "a", " a  b ", "▁a ▁b", "<s> </s> <|endoftext|>", "x\n\n\ty", "🤗 é ö 你好 한국어", " " * 40 + "x", "İ ΑΣ It's we'll \x1c\x85\xa0", "\u0301e\u0301"]


def texts(n, seed):
    rnd = random.Random(seed)
    return ODD + ["".join(rnd.choice("   abcdethnorsi.,\n\tÉé你0123'\"-=#😀") for _ in range(rnd.randint(0, 40))) for _ in range(n)]


def test_pieces_equal_the_library():
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=f"{T}/piece_bpe_32k.model")
    model, some = sentence_pieces.Model(f"{T}/piece_bpe_32k.model"), texts(1500, 1)
    for text, got in zip(some, model.encode(some), strict=True):
        ids = np.frombuffer(got, "<u4").tolist()
        assert ids == lib.encode(text)
        assert model.decode(np.array(ids, int)) == lib.decode(ids) == text.replace("▁", " ")


def test_unigram_is_viterbi():
    """The same pieces as a unigram model (its long runs of marks, of one score, left out)."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto.FromString(open(f"{T}/piece_bpe_32k.model", "rb").read())
    proto.trainer_spec.model_type = pb.TrainerSpec.UNIGRAM
    raw = proto.SerializeToString()
    lib, model = sentencepiece.SentencePieceProcessor(model_proto=raw), sentence_pieces.Model("", raw)
    some = [" ".join(t.split()) for t in texts(400, 2)]
    score = lambda ids: sum(lib.get_score(i) for i in ids if not lib.is_byte(i))
    for text, got in zip(some, model.encode(some), strict=True):
        ids, want = np.frombuffer(got, "<u4").tolist(), lib.encode(text)
        assert ids == want or score(ids) == pytest.approx(score(want))


def test_encode_and_decode_frames(spark):
    rows = [(i, t, "x") for i, t in enumerate(texts(30, 3))] + [(900, None, "x"), (None, "null id", "x"), (0, "", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = sentence_pieces.decode(sentence_pieces.encode(df, f"{T}/piece_bpe_32k.model"), f"{T}/piece_bpe_32k.model").collect()
    assert Counter((r.doc_id, r.text) for r in out) == Counter((i, (t or "").replace("▁", " ")) for i, t, _ in rows)
    assert sentence_pieces.encode(df.limit(0), f"{T}/piece_bpe_32k.model").count() == 0


def test_round_trip_takes_one_worker_for_each_task(spark, tmp_path):
    """The query's ids and decoded texts are those of two passes, and come from one."""
    model = f"{T}/piece_bpe_32k.model"
    rows = [(i, t) for i, t in enumerate(texts(30, 5))] + [(900, None), (None, "null id"), (0, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    once, ids = sentence_pieces.encode(df, model, back=True), sentence_pieces.encode(df, model)
    assert Counter((r.doc_id, *r.ids) for r in once.collect()) == Counter((r.doc_id, *r.ids) for r in ids.collect())
    assert Counter((r.doc_id, r.text) for r in once.collect()) == Counter((r.doc_id, r.text) for r in sentence_pieces.decode(ids, model).collect())
    df.write.parquet(str(tmp_path / "documents.parquet"))
    asked = queries.op1_sentence_pieces(spark, str(tmp_path))
    assert asked._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert asked.count() == len(rows)


def test_word_ids_equal_the_library():
    from tokenizers import Tokenizer

    lib, some = Tokenizer.from_file(f"{T}/word_bpe_49k.json"), texts(1500, 4)
    some += ["".join(chr(c) for c in np.random.default_rng(i).integers(1, 256, 40)) for i in range(300)]
    for text, got in zip(some, packing.load(f"{T}/word_bpe_49k.json").encode(some), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids


def test_plans_hold_the_histogram():
    rnd = random.Random(5)
    for classes in (8, 64):
        histogram = {s: rnd.randint(1, 300) for s in rnd.sample(range(1, classes + 1), classes // 2)}
        held = Counter()
        n = 0
        for times, pattern in packing.plan(histogram, classes):
            assert sum(s * k for s, k in pattern.items()) <= classes
            n += times
            for s, k in pattern.items():
                held[s] += times * k
        assert held == Counter(histogram)
        # no worse than placing the largest first, and no more than a sequence for each size above the fractional optimum
        demand = np.array([histogram.get(s, 0) for s in range(1, classes)])
        optimum = packing.fractional(demand, classes)[1].sum() + histogram.get(classes, 0)
        assert n <= len(packing.best_fit(list(histogram.items()), classes)) and n <= optimum + len(histogram)
    assert packing.plan({}, 8) == []


def test_packed_sequences(spark):
    from tokenizers import Tokenizer

    rnd = random.Random(6)
    docs = [(i, " ".join(rnd.choice(["alpha", "beta", "gamma's", "12"]) for _ in range(rnd.choice([0, 3, 40, 300, 900])))) for i in range(60)] + [(60, None), (61, ""), (5, "again")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = packing.pack(df, f"{T}/word_bpe_49k.json", capacity=128, classes=32, with_ids=True).collect()
    lib = Tokenizer.from_file(f"{T}/word_bpe_49k.json")
    want = Counter((d, tuple(lib.encode(t or "", add_special_tokens=False).ids) + (1,)) for d, t in docs)
    by_doc, by_seq = {}, {}
    for r in rows:
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert Counter((d, tuple(x for p in sorted(ps, key=lambda p: p.start) for x in p.ids)) for (d, _), ps in by_doc.items()) == want
    for parts in by_seq.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 128
    assert len(by_seq) <= 1.1 * sum(r.length for r in rows) / 128 + 2
    packed = packing.pack(df, f"{T}/word_bpe_49k.json", capacity=128, classes=32, with_ids=True)
    assert all(len(s.ids) == 128 or len(s.ids) & (len(s.ids) - 1) == 0 for s in packing.sequences(packed, 128).collect())
    assert packing.pack(df.limit(0), f"{T}/word_bpe_49k.json").count() == 0
