import random
from collections import Counter

import numpy as np
import pytest

from talkmill.llm import chosen_path, repeats
from talkmill.llm.components import components
from tests.llm import brute


def corpus(seed, n=150):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(n):
        if texts and rnd.random() < 0.5:
            words = (rnd.choice(texts) or "").split()
            for _ in range(rnd.randint(0, 4)):
                if words:
                    words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
            texts.append(" ".join(words))
        else:
            texts.append(" ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([0, 1, 3, 4, 5, 40, 80, 120]))))
    return dict(enumerate(texts)) | {n: None, n + 1: "", n + 2: "  \n"}


def test_near_duplicates_equal_brute_force(spark):
    docs = corpus(1)
    df = spark.createDataFrame([(d, t, 0) for d, t in docs.items()] + [(None, docs[0], 0), (0, docs[0], 0)], "doc_id long, text string, label long")
    rows = chosen_path.near_duplicates(df, k=4).collect()
    want = brute.near_components(docs, 4, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows if r.doc_id is not None} == want
    assert [r.component_id for r in rows if r.doc_id is None] == [None] and len(rows) == len(docs) + 2
    kept = chosen_path.keep_first(df, k=4)
    assert kept.columns == df.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([d for d, (_, c) in want.items() if c == d] + [None, 0])
    assert chosen_path.near_duplicates(df.limit(0)).count() == 0


def test_large_group_of_near_copies(spark, monkeypatch):
    """Small limits send the group through deep nodes and blocks."""
    monkeypatch.setattr(chosen_path, "LIMIT", 8)
    monkeypatch.setattr(chosen_path, "BLOCK", 4)
    rnd = random.Random(2)
    base = [f"b{i}" for i in range(100)]
    docs = {}
    for d in range(60):
        words = list(base)
        for _ in range(rnd.randint(0, 3)):
            words[rnd.randrange(100)] = f"x{d}"
        docs[d] = " ".join(words)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in chosen_path.near_duplicates(df, k=4).collect()}
    assert got == brute.near_components(docs, 4, 80)


def test_a_step_makes_a_row_for_each_class_and_tree(spark, monkeypatch):
    """A large group's nodes are made once in each step, and their number follows the group's size, not its square."""
    monkeypatch.setattr(chosen_path, "LIMIT", 8)
    plain, made = chosen_path.nodes, {}

    def counted(classes, level):
        made[level] = rows = spark.sparkContext.accumulator(0)

        def run(batches):
            for batch in batches:
                rows.add(batch.num_rows)
                yield batch

        out = plain(classes, level)
        return out.mapInArrow(run, out.schema)

    monkeypatch.setattr(chosen_path, "nodes", counted)
    for n in (20, 40):
        sig = np.full((chosen_path.TREES, chosen_path.LEVELS), 7, np.uint32).tobytes()
        found = chosen_path.members(spark.createDataFrame([(i, sig) for i in range(n)], "doc_id long, sig binary"))
        last = len(chosen_path.DEPTHS)
        assert found.filter(f"level = {last}").count() == n * chosen_path.TREES
        assert [made[level].value for level in range(2, last + 1)] == [n * chosen_path.TREES] * (last - 1)


def test_large_nodes_are_branched_by_few_tokens(spark, monkeypatch):
    """Classes that have three tokens in common, two of them also the next (two) and none all six."""
    monkeypatch.setattr(chosen_path, "LIMIT", 4)
    for depth in (4, 5):
        sig = np.random.default_rng(9).integers(0, 1 << 32, (8, chosen_path.TREES, chosen_path.LEVELS), dtype=np.uint32)
        sig[:, :, :3] = sig[0, :, :3]
        sig[1, :, :depth] = sig[0, :, :depth]
        if depth == 5:
            sig[:, :, 3] = sig[0, :, 3]
        df = spark.createDataFrame([(i, bytearray(x.tobytes())) for i, x in enumerate(sig)], "doc_id long, sig binary")
        small = chosen_path.members(df).filter("n <= 4").collect()
        assert {r.doc_id for r in small} == {0, 1}


def test_thresholds_that_trees_do_not_cover_are_refused(spark):
    df = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    for percent in (50, 79, 101):
        with pytest.raises(ValueError):
            chosen_path.near_duplicates(df, percent=percent)
    assert chosen_path.near_duplicates(df, percent=90).count() == 1
    assert chosen_path.sketch_share(95) > chosen_path.sketch_share(80) > 0.59


def test_blocks_link_what_is_similar():
    rnd = np.random.default_rng(3)
    sets = [np.unique(rnd.integers(0, 60, 40).astype(np.uint64)) for _ in range(40)]
    labels = np.arange(40)
    got = {tuple(sorted(p)) for p in chosen_path.linked(sets, labels, np.ones(40, bool), 50)}
    assert got == {(i, j) for i in range(40) for j in range(i + 1, 40) if chosen_path.similar(sets[i], sets[j], 50)}


def test_components(spark):
    rnd = random.Random(4)
    pairs = [(rnd.randint(0, 80), rnd.randint(0, 80)) for _ in range(50)] + [(200 + i, 201 + i) for i in range(20)] + [(7, 7)]
    label = {x: x for p in pairs for x in p}
    for _ in label:
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    got = components(spark.createDataFrame(pairs, "a long, b long"))
    assert {r.id: r.label for r in got.collect()} == label


def test_transform_marks_repeats():
    rnd = random.Random(5)
    for _ in range(150):
        n, alphabet = rnd.choice([1, 3, 8]), rnd.choice(["a", "ab", "abcdefgh"])
        texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 50))).encode() for _ in range(rnd.randint(1, 5))]
        count = Counter(t[i : i + n] for t in texts for i in range(len(t) - n + 1))
        got = repeats.repeated([np.frombuffer(t, np.uint8) for t in texts], n)
        assert [x.tolist() for x in got] == [[i for i in range(len(t) - n + 1) if count[t[i : i + n]] > 1] for t in texts]


def test_contexts_cover_each_window_once():
    data = bytes(random.Random(6).choice(b"ab ") for _ in range(3000))
    runs = repeats.contexts(np.frombuffer(data, np.uint8))
    assert [p for _, _, a, b in runs for p in range(a, b + 1)] == list(range(len(data) - 399))
    assert all(b <= at <= a + 400 - repeats.GRAM for _, at, a, b in runs)


def repeat_corpus():
    rnd = random.Random(7)
    text = lambda n: "".join(rnd.choice("abcdefghij klmnopé") for _ in range(n))
    shared, edge, copy = text(700), text(390), text(900)
    edited = [copy[:k] + "#" + copy[k + 1 :] for k in (100, 450, 451, 800)]
    return [text(500) + shared + text(300), shared, text(200) + shared[:500], edge + text(200), text(200) + edge, copy, copy, *edited, "a" * 1500, "a" * 399, "a" * 400, None, "", text(5000)]


def test_repeats_equal_brute_force(spark, monkeypatch):
    docs = list(enumerate(repeat_corpus())) + [(None, "z" * 450)]
    df = spark.createDataFrame([(d, t, 0) for d, t in docs], "doc_id long, text string, data long")
    want = brute.without_repeats([(t or "").encode() for _, t in docs], 400)
    for size in (repeats.BATCH_BYTES, 500):  # the second counts windows instead
        monkeypatch.setattr(repeats, "BATCH_BYTES", size)
        out = repeats.without_repeats(df)
        assert out.columns == df.columns
        assert {r.doc_id: r.text for r in out.collect()} == {d: None if t is None else w.decode("utf-8", "replace") for (d, t), w in zip(docs, want, strict=True)}
    assert {r.doc_id: (r.n_bytes, r.n_bytes - r.n_removed) for r in repeats.digests(df).collect()} == {d: (len((t or "").encode()), len(w)) for (d, t), w in zip(docs, want, strict=True)}
    assert repeats.digests(df.limit(0)).count() == 0


def test_links_of_a_block_span_the_labels_of_a_large_group():
    n = 60
    i, j = np.nonzero(np.triu(np.ones((n, n), bool), 1))
    whole = chosen_path.spanning(np.arange(n) // 2, i, j)
    assert len(whole) == n // 2 - 1
    reached = {0}
    for _ in range(n):
        reached |= {x // 2 for p in whole for x in (i[p], j[p]) if {i[p] // 2, j[p] // 2} & reached}
    assert reached == set(range(n // 2))
    assert chosen_path.spanning(np.array([3, 4]), i[:0], j[:0]) == []
