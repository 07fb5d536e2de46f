"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds at-signs, scheme marks, plus signs, digits
and identifier cues; a deterministic parser expands each anchor to the left and the
right and validates what it finds. Base kinds follow fixed patterns; the method adds
urls, account numbers (IBAN by its checksum, or digits after a cue), social security
numbers and secrets after a cue.

Defined cases: null and empty texts have no spans; repeated rows are found again;
other columns are ignored by find() and kept by redact(); an empty table gives an
empty result.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "account", "ssn", "secret")
#: Kinds that redact() masks.
PRIVATE = tuple(k for k in KINDS if k != "url")
#: Words before an account number or a secret, in lower case.
ACCOUNT_CUES = ("iban", "account", "acct", "konto", "cuenta", "compte", "routing")
SECRET_CUES = ("token", "secret", "password", "passwd", "api_key", "apikey", "api key", "access key")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGITS = "0123456789"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SSN = re.compile(r"(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
SCHEME = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*\Z")
ADDRESS = re.compile(r"[^\s\"'<>\\^`{|}]+")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:[\x20-]?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
AFTER_CUE = re.compile(r"[\x20]*(?:number|no\.?|nr\.?|#)?[\x20]*[:=#]?[\x20]*", re.I)
NUMBER = re.compile(r"[0-9](?:[\x20-]?[0-9]){5,19}(?![0-9])")
TO_SECRET = re.compile(r"[\x20]*[:=][\x20]*[\"']?")
SECRET = re.compile(r"[A-Za-z0-9_/+=-]{12,}")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def is_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def is_iban(text: str) -> bool:
    plain = text.replace(" ", "").replace("-", "")
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


@lru_cache(maxsize=1)
def automaton():
    import ahocorasick

    words = {"@": "email", "://": "url", "+": "phone"} | dict.fromkeys(DIGITS, "digit")
    for cues, kind in ((ACCOUNT_CUES, "account"), (SECRET_CUES, "secret")):
        for cue in cues:
            words |= dict.fromkeys((cue, cue.upper(), cue.capitalize()), kind)
    built = ahocorasick.Automaton()
    for word, kind in words.items():
        built.add_word(word, (kind, len(word)))
    built.make_automaton()
    return built


def spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, by start, then kind as in KINDS."""
    found: list[tuple[int, int, str]] = []
    ends = dict.fromkeys(KINDS, 0)

    def add(kind: str, start: int, end: int) -> None:
        if start >= ends[kind]:
            ends[kind] = end
            found.append((start, end, kind))

    for last, (anchor, size) in automaton().iter(text):
        at = last - size + 1
        if anchor == "digit":
            if at and text[at - 1] in DIGITS:
                continue
            if at >= ends["ip"] and (m := IP.match(text, at)):
                ends["ip"] = m.end()
                if is_ip(m[0]):
                    found.append((at, m.end(), "ip"))
            if at >= ends["card"] and (m := CARD.match(text, at)):
                ends["card"] = m.end()
                digits = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    found.append((at, m.end(), "card"))
            if (at == 0 or text[at - 1] != "-") and (m := SSN.match(text, at)):
                add("ssn", at, m.end())
        elif anchor == "email":
            start = at
            while start > ends["email"] and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (m := DOMAIN.match(text, at + 1)):
                add("email", start, m.end())
        elif anchor == "phone":
            if at >= ends["phone"] and (m := PHONE.match(text, at)):
                ends["phone"] = m.end()
                if 10 <= sum(c in DIGITS for c in m[0]) <= 15:
                    found.append((at, m.end(), "phone"))
        elif anchor == "url":
            # the address is read only if it will be added, so a run of marks is read once
            if at < ends["url"] or not text[last + 1 : last + 2].isalnum() or not (scheme := SCHEME.search(text[max(0, at - 32) : at])):
                continue
            if (rest := ADDRESS.match(text, last + 1)) and (address := rest[0].rstrip(".,;:!?)]")):
                add("url", at - len(scheme[0]), last + 1 + len(address))
        elif anchor == "account":
            start = AFTER_CUE.match(text, last + 1).end()
            if (m := IBAN.match(text, start)) and is_iban(m[0]) or (m := NUMBER.match(text, start)):
                add("account", m.start(), m.end())
        elif (m := TO_SECRET.match(text, last + 1)) and m.end() >= ends["secret"] and (m := SECRET.match(text, m.end())):
            add("secret", m.start(), m.end())
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def joined(some: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in some)


def read(batch: pa.RecordBatch) -> list[str]:
    """The texts of a batch. Nothing is kept between batches here, and what other operators keep in this worker is emptied."""
    common.hold("private_spans", lambda: None)
    return [x.as_py().decode("utf-8", "replace") for x in batch.column("data")]


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans array<struct<start, end, kind>>)."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), common.text_bytes(text).alias("data"))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))

    def make():
        def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [[{"start": a, "end": b, "kind": k} for a, b, k in spans(x)] for x in read(batch)]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, kind)], ["doc_id", "spans"])

        return fn

    return common.map_batches(rows, make, "doc_id long, spans array<struct<start: long, end: long, kind: string>>")


def masked(text: str, kinds: tuple[str, ...] = PRIVATE) -> str:
    """text with each run of overlapping spans replaced by the mark of its first kind."""
    out, done, mark = [], 0, ""
    runs: list[list] = []
    for a, b, k in spans(text):
        if k in kinds:
            if runs and a < runs[-1][1]:
                runs[-1][1] = max(runs[-1][1], b)
            else:
                runs.append([a, b, k])
    for a, b, mark in runs:
        out += [text[done:a], f"<{mark.upper()}>"]
        done = b
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, text: str = "text", kinds: tuple[str, ...] = PRIVATE) -> DataFrame:
    """docs with the spans of kinds masked in text; a null text stays null."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("row"), F.col(text).isNull().alias("none"), common.text_bytes(text).alias("data"))

    def make():
        def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [None if none else masked(x, kinds) for x, none in zip(read(batch), batch.column("none").to_pylist(), strict=True)]
            return pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "text"])

        return fn

    out = common.map_batches(rows, make, f"row {rows.schema['row'].dataType.simpleString()}, text string")
    return out.select(*[F.col("text").alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns])
