"""Quality rules with host verdicts.

Each document gets its counts and rule failures. Failures are summed by host, and each
host's rate is shrunk towards a beta prior fitted to all hosts by moments. Besides the
base rule there are soft ones, which good documents fail at times: such a failure
counts only on a host whose shrunk rate of that rule lies above what the prior lets
expect of hosts (its mean and SPREAD standard deviations). A host whose shrunk rate of
any rule is above MAX_HOST_RATE loses all its documents.

Defined cases: a null text has no words and so fails the base rule; a null host is
the host ''; a repeated row counts again; extra columns are ignored by judge() and
returned as they are by keep_good(); an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Characters that count as symbols (fixed by the contract).
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEAT = 50, 50
#: A host goes if its shrunk rate of a rule is above this.
MAX_HOST_RATE = 0.8
#: Standard deviations of the prior above its mean from which a host's rate of a soft rule is bad.
SPREAD = 1.0
#: Weight of the prior in documents: bounds for the fitted value.
STRENGTH = (2.0, 10_000.0)
METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RULES = {
    "base": "n_words < {min_words} or 100 * n_repeat_words > {max_repeat} * n_words",
    "symbols": "10 * n_symbols > word_chars",
    "lines": "n_dup_lines >= 3 and 4 * n_dup_lines > n_words",
}


def measure_text(data: bytes) -> tuple[int, int, int, int, int]:
    """METRICS of a text in UTF-8."""
    words = data.split()
    joined = np.frombuffer(b"".join(words), np.uint8)
    chars = int(((joined & 0xC0) != 0x80).sum())
    symbols = sum(data.count(x) for x in (SYMBOLS[i : i + 1] for i in range(len(SYMBOLS))))
    seen: set[bytes] = set()
    dup = 0
    for line in data.split(b"\n"):
        if line in seen:
            dup += 1
        elif line.strip():
            seen.add(line)
    return len(words), chars, symbols, dup, repeat_words(words)


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more."""
    if len(words) < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    pair = ids[:-1] * len(known) + ids[1:]
    if len(known) > 1 << 20:
        pair = np.unique(pair, return_inverse=True)[1]
        triple = pair[:-1] * len(known) + ids[2:]
    else:
        triple = pair[:-1] * len(known) + ids[2:]
    _, where, n = np.unique(triple, return_inverse=True, return_counts=True)
    hit = n[where] > 1
    marked = np.zeros(len(words), bool)
    for k in range(3):
        marked[k : k + len(hit)] |= hit
    return int(marked.sum())


def measure(docs: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """(row: all columns of docs, host, METRICS)."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), common.text_bytes(text).alias("data"))
    return _measured(rows, f"row {rows.schema['row'].dataType.simpleString()}")


def _measured(rows: DataFrame, first: str) -> DataFrame:
    name = first.split()[0]

    def make():
        def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
            got = list(zip(*(measure_text(x.as_py()) for x in batch.column("data")), strict=True))
            return pa.RecordBatch.from_arrays([batch.column(name), batch.column("host"), *(pa.array(x, pa.int64()) for x in got)], [name, "host", *METRICS])

        return fn

    return common.map_batches(rows, make, f"{first}, host string, " + ", ".join(f"{m} long" for m in METRICS))


def failures(metrics: DataFrame, min_words: int = MIN_WORDS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """metrics with a boolean failed_<rule> for each rule."""
    return metrics.withColumns({f"failed_{k}": F.expr(v.format(min_words=min_words, max_repeat=max_repeat)) for k, v in RULES.items()})


def host_rates(failed: DataFrame) -> DataFrame:
    """A row per host: n, and per rule failures f_<rule> (map-side sums, so a hot host is one small row per task)."""
    return failed.groupBy("host").agg(F.count("*").alias("n"), *[F.sum(F.col(f"failed_{k}").cast("long")).alias(f"f_{k}") for k in RULES])


def priors(hosts: DataFrame) -> dict[str, tuple[float, float]]:
    """Beta (alpha, beta) of each rule by moments of the hosts' rates; one row comes to the driver."""
    row = hosts.agg(*[f(F.col(f"f_{k}") / F.col("n")).alias(f"{s}_{k}") for k in RULES for s, f in (("m", F.avg), ("v", F.var_pop))]).first()
    out = {}
    for k in RULES:
        m, v = row[f"m_{k}"] or 0.0, row[f"v_{k}"] or 0.0
        strength = min(max(m * (1 - m) / v - 1, STRENGTH[0]), STRENGTH[1]) if v > 0 else STRENGTH[1]
        out[k] = (m * strength, (1 - m) * strength)
    return out


def limit(alpha: float, beta: float, max_rate: float = MAX_HOST_RATE, spread: float = SPREAD) -> float:
    """The rate above which a host is bad by a rule with this prior."""
    mean = alpha / (alpha + beta)
    return min(max_rate, mean + spread * (mean * (1 - mean) / (alpha + beta + 1)) ** 0.5)


def host_verdicts(failed: DataFrame, max_rate: float = MAX_HOST_RATE, spread: float = SPREAD) -> DataFrame:
    """(host, n, rate_<rule>, rejected, bad_<rule>) of every host."""
    hosts = common.saved(host_rates(failed))
    fit = priors(hosts)
    rated = hosts.select("host", "n", *[((F.col(f"f_{k}") + a) / (F.col("n") + a + b)).alias(f"rate_{k}") for k, (a, b) in fit.items()])
    rated = rated.withColumn("rejected", F.greatest(*[F.col(f"rate_{k}") for k in RULES]) > max_rate)
    return rated.withColumns({f"bad_{k}": F.col(f"rate_{k}") > limit(*fit[k], max_rate, spread) for k in RULES})


def with_verdicts(failed: DataFrame, hosts: DataFrame) -> DataFrame:
    """failed with host_rejected, soft_rejected and kept."""
    soft = [k for k in RULES if k != "base"]
    named = hosts.select("host", F.col("rejected").alias("host_rejected"), *[f"bad_{k}" for k in soft])
    bad = common.saved(named.filter(" or ".join(["host_rejected", *[f"bad_{k}" for k in soft]])))
    joined = common.join_small(failed, bad, "host", "left")
    hit = F.lit(False)
    for k in soft:
        hit = hit | (F.col(f"failed_{k}") & F.coalesce(f"bad_{k}", F.lit(False)))
    joined = joined.withColumns({"host_rejected": F.coalesce("host_rejected", F.lit(False)), "soft_rejected": hit}).drop(*[f"bad_{k}" for k in soft])
    return joined.withColumn("kept", ~F.col("failed_base") & ~F.col("host_rejected") & ~F.col("soft_rejected"))


def judge(docs: DataFrame, doc_id: str = "doc_id", host: str = "source", text: str = "text", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """(doc_id, host, METRICS, failed_<rule>, host_rejected, soft_rejected, kept) of each document."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), common.text_bytes(text).alias("data"))
    failed = failures(common.saved(_measured(rows, "doc_id long")))
    return with_verdicts(failed, host_verdicts(failed, max_rate))


def keep_good(docs: DataFrame, host: str = "source", text: str = "text", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The rows of docs, with all their columns, that neither a rule nor their host's verdict rejects.

    Texts are measured twice: writing them with their metrics would take their size on disk.
    """
    failed = failures(measure(docs, host, text))
    return with_verdicts(failed, host_verdicts(failed.drop("row"), max_rate)).filter("kept").select("row.*")


SQL = r"""
WITH doc AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
lined AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM doc),
lines AS (
  SELECT doc_id, sum(n - 1) AS n_dup_lines
  FROM (SELECT doc_id, line, count(*) AS n FROM lined WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY ALL) GROUP BY doc_id),
grams AS (
  SELECT doc_id, i, (w[i], w[i + 1], w[i + 2]) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM doc WHERE len(w) >= 3)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
marks AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
metric AS (
  SELECT doc.doc_id, host, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM doc LEFT JOIN lines USING (doc_id) LEFT JOIN marks USING (doc_id)),
failed AS (
  SELECT *, {base} AS failed_base, {symbols} AS failed_symbols, {lines} AS failed_lines FROM metric),
hosts AS (
  SELECT host, count(*) AS n, {sums} FROM failed GROUP BY host),
moment AS (SELECT {moments} FROM hosts),
prior AS (SELECT *, {strengths} FROM moment),
verdict AS (
  SELECT host, greatest({rates}) > {max_rate} AS host_rejected, {bads} FROM hosts CROSS JOIN prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed_base AS base_failed,
       NOT failed_base AND NOT host_rejected{soft} AS kept
FROM failed JOIN verdict USING (host)
"""


def oracle() -> str:
    rules = {k: v.format(min_words=MIN_WORDS, max_repeat=MAX_REPEAT) for k, v in RULES.items()}
    strength = "CASE WHEN v_{0} > 0 THEN least(greatest(m_{0} * (1 - m_{0}) / v_{0} - 1, {1}), {2}) ELSE {2} END AS s_{0}"
    text = SQL.replace("{max_rate}", str(MAX_HOST_RATE)).replace("{sums}", ", ".join(f"sum(CAST(failed_{k} AS BIGINT)) AS f_{k}" for k in RULES))
    text = text.replace("{moments}", ", ".join(f"avg(f_{k} / n) AS m_{k}, var_pop(f_{k} / n) AS v_{k}" for k in RULES))
    text = text.replace("{strengths}", ", ".join(strength.format(k, *STRENGTH) for k in RULES))
    text = text.replace("{rates}", ", ".join(f"(f_{k} + m_{k} * s_{k}) / (n + s_{k})" for k in RULES))
    soft = [k for k in RULES if k != "base"]
    text = text.replace("{bads}", ", ".join(f"(f_{k} + m_{k} * s_{k}) / (n + s_{k}) > least({MAX_HOST_RATE}, m_{k} + {SPREAD} * sqrt(m_{k} * (1 - m_{k}) / (s_{k} + 1))) AS bad_{k}" for k in soft))
    text = text.replace("{soft}", "".join(f" AND NOT (failed_{k} AND bad_{k})" for k in soft))
    for k, v in rules.items():
        text = text.replace("{" + k + "}", f"({v})")
    return text
