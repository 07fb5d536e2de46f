"""Telephony audio columns: mu-law, A-law and IMA ADPCM to resampled PCM.

Companded samples are expanded by 256-entry tables built from the coding rule;
ADPCM blocks are decoded by numpy one nibble step at a time across all blocks of a
slice. Media are WAV files in a binary column.

Defined cases: null and empty payloads are padded to one block of zero bytes; equal
payloads give equal media and features; other columns are ignored; an empty table
gives an empty result; bytes that are no WAV file raise an error.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

RATE, TARGET_RATE, BLOCK = 8_000, 16_000, 64
#: Samples that are widened at once.
CHUNK = 1 << 20
#: How media and PCM are stored.
STORED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "9"}
#: WAV format tags (fixed by the format).
ALAW, MULAW, ADPCM = 6, 7, 17
#: IMA ADPCM step sizes and index changes (fixed values of the format).
STEPS = np.array([
    7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118, 130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449,
    494, 544, 598, 658, 724, 796, 876, 963, 1060, 1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845, 8630, 9493, 10442,
    11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767,
], np.int32)
CHANGES = np.array([-1, -1, -1, -1, 2, 4, 6, 8], np.int32)


@lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, np.ndarray]:
    """(mu-law, A-law) tables from a byte to a 16-bit sample."""
    code = np.arange(256)
    mu = ~code & 0xFF
    size = (((mu & 0x0F) << 3) + 0x84 << ((mu & 0x70) >> 4)) - 0x84
    mulaw = np.where(mu & 0x80, -size, size).astype(np.int16)
    a = code ^ 0x55
    segment, step = (a & 0x70) >> 4, (a & 0x0F) << 4
    size = np.where(segment == 0, step + 8, (step + 0x108) << np.maximum(segment - 1, 0))
    return mulaw, np.where(a & 0x80, size, -size).astype(np.int16)


def adpcm(data: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Samples of IMA ADPCM mono blocks, a row for each block (4 bytes of state, then nibbles, low first)."""
    blocks = data.reshape(-1, block)
    head = np.ascontiguousarray(blocks[:, :2]).view("<i2").ravel()
    value, index = head.astype(np.int32), np.minimum(blocks[:, 2], 88).astype(np.int32)
    out = np.empty((1 + 2 * (block - 4), len(blocks)), np.int16)
    out[0] = value
    for k in range(4, block):
        byte = blocks[:, k]
        for j, nibble in enumerate((byte & 15, byte >> 4)):
            step, low = STEPS[index], (nibble & 7).astype(np.int32)
            delta = (step >> 3) + np.where(low & 4, step, 0) + np.where(low & 2, step >> 1, 0) + np.where(low & 1, step >> 2, 0)
            value = np.clip(np.where(nibble & 8, value - delta, value + delta), -32768, 32767)
            index = np.clip(index + CHANGES[low], 0, 88)
            out[2 * (k - 4) + 1 + j] = value
    return out.T


def resample(pcm: np.ndarray, source: int = RATE, target: int = TARGET_RATE) -> np.ndarray:
    """Linear interpolation in whole numbers, some samples at a time; the last sample is held."""
    if not len(pcm) or source == target:
        return pcm
    out = np.empty(len(pcm) * target // source, np.int16)
    for start in range(0, len(out), CHUNK):
        at = np.arange(start, min(len(out), start + CHUNK), dtype=np.int64) * source
        left, part = at // target, at % target
        a, b = pcm[left].astype(np.int64), pcm[np.minimum(left + 1, len(pcm) - 1)].astype(np.int64)
        out[start : start + CHUNK] = (a * (target - part) + b * part) // target
    return out


def interlaced(pcm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Even samples, and the floored mean of the two around each odd one (the last is held)."""
    even, n = pcm[::2], len(pcm) // 2
    return even, (even[:n].astype(np.int32) + np.append(even[1:], even[-1:])[:n]) >> 1


def squeezed(pcm: np.ndarray) -> bytes:
    """PCM without loss in a form that compresses well: even samples, then odd ones less the mean of their neighbours, modulo 2**16."""
    even, mean = interlaced(pcm)
    return even.astype("<i2").tobytes() + (pcm[1::2] - mean).astype("<i2").tobytes()


def opened(data: bytes) -> np.ndarray:
    """The PCM of squeezed bytes."""
    x = np.frombuffer(data, "<i2")
    out = np.empty(len(x), "<i2")
    out[::2] = x[: len(x) - len(x) // 2]
    out[1::2] = (x[len(x) - len(x) // 2 :] + interlaced(out)[1]).astype(np.int16)
    return out


def wav(payload: bytes, tag: int = MULAW, rate: int = RATE, block: int = BLOCK) -> bytes:
    """A mono WAV file whose data chunk is the payload."""
    if tag == ADPCM:
        per = 1 + 2 * (block - 4)
        fmt = struct.pack("<HHIIHHHH", tag, 1, rate, rate * block // per, block, 4, 2, per)
        n = len(payload) // block * per
    else:
        fmt, n = struct.pack("<HHIIHHH", tag, 1, rate, rate, 1, 8, 0), len(payload)
    chunks = struct.pack("<4sI", b"fmt ", len(fmt)) + fmt + struct.pack("<4sII", b"fact", 4, n) + struct.pack("<4sI", b"data", len(payload))
    pad = b"\0" * (len(payload) % 2)
    return struct.pack("<4sI4s", b"RIFF", 4 + len(chunks) + len(payload) + len(pad), b"WAVE") + chunks + payload + pad


def parsed(media: bytes) -> tuple[int, int, int, bytes]:
    """(format tag, rate, block size, data) of a WAV file."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, tag, rate, block = 12, 0, 0, 1
    while at + 8 <= len(media):
        name, size = struct.unpack_from("<4sI", media, at)
        if name == b"fmt ":
            tag, _, rate, _, block = struct.unpack_from("<HHIIH", media, at + 8)
        elif name == b"data":
            return tag, rate, block, media[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("no data chunk")


def expanded(tag: int, data: bytes, block: int = BLOCK) -> np.ndarray:
    """16-bit samples of a data chunk."""
    raw = np.frombuffer(data, np.uint8)
    if tag == ADPCM:
        return adpcm(raw, block).ravel()
    return tables()[tag == ALAW][raw]


def padded(text: bytes, block: int = BLOCK) -> bytes:
    """text and zero bytes up to a positive multiple of block."""
    return text + b"\0" * (max(block, -(-len(text) // block) * block) - len(text))


def store(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tag: int = MULAW, path: str | None = None) -> DataFrame:
    """(doc_id, n_bytes, media) of each text as a WAV column, written to the shared folder and read from there."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), common.text_bytes(text).alias("data"))

    def make():
        def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [x.as_py() for x in batch.column("data")]
            media = [wav(padded(t), tag) for t in texts]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

        return fn

    return common.saved(common.map_batches(rows, make, "doc_id long, n_bytes long, media binary"), path, **STORED)


def samples(media: bytes, rate: int = TARGET_RATE) -> np.ndarray:
    """16-bit samples of a WAV file at the given rate."""
    tag, source, block, data = parsed(media)
    return resample(expanded(tag, data, block), source, rate)


def decoded(media: bytes, rate: int = TARGET_RATE) -> bytes:
    """samples() as little-endian bytes."""
    return samples(media, rate).astype("<i2").tobytes()


def to_pcm(media: DataFrame, rate: int = TARGET_RATE) -> DataFrame:
    """(doc_id, pcm): little-endian 16-bit samples of each media value at the given rate."""

    def make():
        def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = [decoded(x.as_py(), rate) for x in batch.column("media")]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary())], ["doc_id", "pcm"])

        return fn

    return common.map_batches(media.select("doc_id", "media"), make, "doc_id long, pcm binary", "media")


def energy(pcm: np.ndarray) -> int:
    """The mean square, in whole numbers; some samples are widened at a time."""
    parts = (pcm[i : i + CHUNK].astype(np.int64) for i in range(0, len(pcm), CHUNK))
    return sum(int((x * x).sum()) for x in parts) // max(1, len(pcm))


def block_energies(blocks: np.ndarray) -> np.ndarray:
    """The sum of squares of each row."""
    rows = max(1, CHUNK // blocks.shape[1])
    parts = (blocks[i : i + rows].astype(np.int64) for i in range(0, len(blocks), rows))
    return np.concatenate([(x * x).sum(axis=1) for x in parts])


DIGESTS = {"payload_bytes": pa.int64(), "payload_sha256": pa.string(), "tail_crc32": pa.int64(), "media_bytes": pa.int64(), "media_sha256": pa.string()}
DIGESTS_SQL = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string"


def store_pcm(media: DataFrame, path: str | None = None) -> DataFrame:
    """Digests of each media value, the energies of its payload as other codes, and its resampled PCM (squeezed), written to the shared folder and read from there."""

    def make():
        def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
            stored = [x.as_py() for x in batch.column("media")]
            data = [parsed(m)[3] for m in stored]
            sizes = np.array([len(d) // BLOCK for d in data])
            blocks = adpcm(np.frombuffer(b"".join(data), np.uint8))
            sums = np.add.reduceat(block_energies(blocks), np.cumsum(sizes) - sizes)
            rows = []
            for m, payload, n, total in zip(stored, data, sizes, sums, strict=True):
                others = f"alaw:{energy(expanded(ALAW, payload))};adpcm:{int(total) // (int(n) * blocks.shape[1])}"
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-BLOCK:]), len(m), hashlib.sha256(m).hexdigest(), others, squeezed(samples(m))))
            kinds = DIGESTS | {"others": pa.string(), "pcm": pa.binary()}
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds.values(), strict=True)]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), *columns], ["doc_id", "n_bytes", *kinds])

        return fn

    return common.saved(common.map_batches(media.select("doc_id", "n_bytes", "media"), make, f"{DIGESTS_SQL}, others string, pcm binary", "media"), path, **STORED)


def features(media: DataFrame, path: str | None = None) -> DataFrame:
    """Digests and features of each media value, those of the PCM from the bytes stored and read back.

    The feature names the resampled PCM's length, CRC, energy, peak and sign changes,
    then the payload's energy as A-law and as ADPCM blocks.
    """

    def make():
        def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for x, others in zip(batch.column("pcm"), batch.column("others").to_pylist(), strict=True):
                pcm = opened(x.as_py())
                stored = pcm.tobytes()
                peak, flips = int(np.abs(pcm.astype(np.int32)).max()), int((np.diff(np.signbit(pcm)) != 0).sum())
                rows.append(f"pcm:{len(pcm)}:{zlib.crc32(stored):08x};energy:{energy(pcm)};peak:{peak};flips:{flips};{others}")
            names = ["doc_id", "n_bytes", *DIGESTS]
            return pa.RecordBatch.from_arrays([*map(batch.column, names), pa.array(rows, pa.string())], [*names, "feature"])

        return fn

    return common.map_batches(store_pcm(media, path), make, f"{DIGESTS_SQL}, feature string", "pcm")
