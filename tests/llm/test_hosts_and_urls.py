import random

from talkmill.llm import host_rules, queries, url_tree


def host_kept(docs):
    """{id: (host, text)} to {id: kept}, by plain loops."""
    rules = {"base": lambda m: m[0] < 50 or 100 * m[4] > 50 * m[0], "symbols": lambda m: 10 * m[2] > m[1], "lines": lambda m: m[3] >= 3 and 4 * m[3] > m[0]}
    failed, hosts = {}, {}
    for d, (host, text) in docs.items():
        m = host_rules.measure_text((text or "").encode())
        failed[d] = {k: f(m) for k, f in rules.items()}
        hosts.setdefault(host or "", []).append(d)
    bad = {}
    for k in rules:
        rates = {h: sum(failed[d][k] for d in ds) / len(ds) for h, ds in hosts.items()}
        mean = sum(rates.values()) / len(rates)
        var = sum((r - mean) ** 2 for r in rates.values()) / len(rates)
        weight = min(max(mean * (1 - mean) / var - 1, 2.0), 10_000.0) if var > 1e-18 else 10_000.0
        limit = min(0.8, mean + (mean * (1 - mean) / (weight + 1)) ** 0.5)
        shrunk = {h: (rates[h] * len(ds) + mean * weight) / (len(ds) + weight) for h, ds in hosts.items()}
        bad[k] = {h for h in hosts if shrunk[h] > limit}
        bad[f"all {k}"] = {h for h in hosts if shrunk[h] > 0.8}
    out = {}
    for d, (host, _) in docs.items():
        soft = any(failed[d][k] and (host or "") in bad[k] for k in ("symbols", "lines"))
        out[d] = not failed[d]["base"] and not soft and not any((host or "") in bad[f"all {k}"] for k in rules)
    return out, failed


def host_corpus():
    rnd = random.Random(4)
    good = lambda: " ".join(f"w{rnd.randint(0, 10**6)}" for _ in range(80))
    odd = lambda: " ".join(f"w{rnd.randint(0, 10**6)}##" for _ in range(80))
    docs = {}
    for host in range(12):
        for i in range(30):
            docs[len(docs)] = (f"h{host}", odd() if host == 3 and i < 12 or i == 0 else "short" if host == 5 and i < 29 else good())
    docs[len(docs)] = (None, None)
    docs[len(docs)] = (None, "")
    return docs


def test_host_verdicts_equal_plain_loops(spark, tmp_path):
    docs = host_corpus()
    df = spark.createDataFrame([(d, t, h, 7, "x") for d, (h, t) in docs.items()], "doc_id long, text string, source string, n_words long, host string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    want, failed = host_kept(docs)
    got = {r.doc_id: r for r in queries.op9_host_rules(spark, str(tmp_path)).collect()}
    assert {d: r.kept for d, r in got.items()} == want
    assert {d: r.base_failed for d, r in got.items()} == {d: f["base"] for d, f in failed.items()}
    # the hosts' verdicts decide: soft failures go on the bad host and stay elsewhere, and a host of failures loses its good document
    soft = [d for d, f in failed.items() if f["symbols"] and not f["base"]]
    assert any(want[d] for d in soft) and any(not want[d] for d in soft)
    assert any(not want[d] and not any(failed[d].values()) for d, (h, _) in docs.items() if h == "h5")
    kept = host_rules.keep_good(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {d for d, k in want.items() if k}
    assert host_rules.keep_good(df.limit(0)).count() == 0


def test_cue_labels_block_pages_without_a_rule(spark, tmp_path):
    rows = [(i, f"https://m.casino-win.example.org/en/{i}") for i in range(8)] + [(100 + i, f"https://quiet.example.org/en/{i}") for i in range(8)] + [(200, "https://bets.example.org/en/1")]
    spark.createDataFrame(rows + rows[:1], "page_id long, url string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {r.page_id: r for r in queries.op10_url_tree(spark, str(tmp_path)).collect()}
    assert all(got[i].rule is None and got[i].verdict == "block" for i in range(8))
    assert all(got[100 + i].verdict == "allow" for i in range(8))
    assert got[200].verdict == "allow"  # one page is no support


def test_deep_paths_are_told_apart(spark):
    from pyspark.sql import functions as F

    deep = lambda x, i: f"http://h.org/a/b/c/d/e/{x}/{i}"
    rows = [(i, deep("bad", i), 1) for i in range(20)] + [(50 + i, deep("good", i), 0) for i in range(20)] + [(90, deep("bad", 99), None), (91, deep("good", 99), None), (92, "http://h.org/" + "/".join("xyz" * 20), None)]
    df = spark.createDataFrame(rows, "page_id long, url string, mark int")
    got = {r.page_id: r.verdict for r in url_tree.judge(df, label=F.col("mark")).collect()}
    assert got[90] == "block" and got[91] == "allow" and got[92] == "allow"
