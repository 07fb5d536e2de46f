"""SentencePiece encoding and decoding by one forward pass over a trie of marked words.

The distinct marked words of a slice are sorted, which is the depth-first order of
their trie; forward states are kept on a stack and shared by all words with the
same prefix. For a unigram model a state is the best score of the prefix and its
last piece (Viterbi). A BPE model has no path scores to maximise: there a state is
the last piece of the prefix's own encoding, which is the one piece whose pair with
the state before it survives the merges, so results equal those of the library.

Words are split before a mark that follows another character and around line
breaks; the model is refused if one of its pieces spans such a place.

Defined cases: null and empty texts give no ids; ids outside the model decode to
nothing; a mark in the input decodes to a space; other columns pass through carry.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

MARK = "▁"
#: Words that a Python worker keeps encoded; beyond it the store starts anew.
CACHE_WORDS = 800_000
#: Pairs of pieces whose test a worker keeps.
CACHE_PAIRS = 500_000
#: Score of an unknown character below the lowest of the model (fixed by the format's library).
UNKNOWN_PENALTY = 10.0
SPLIT = re.compile(f"{MARK}+[^{MARK}\\n]*|\\n|[^{MARK}\\n]+")


class Model:
    """Pieces, scores and settings of a model file."""

    def __init__(self, path: str, model: bytes | None = None):
        from sentencepiece import sentencepiece_model_pb2 as pb

        if model is None:
            with open(path, "rb") as f:
                model = f.read()
        proto = pb.ModelProto.FromString(model)
        if proto.normalizer_spec.precompiled_charsmap or proto.normalizer_spec.remove_extra_whitespaces or not proto.normalizer_spec.escape_whitespaces:
            raise ValueError("only models without text normalisation are supported")
        kind = pb.ModelProto.SentencePiece
        self.bpe = proto.trainer_spec.model_type == pb.TrainerSpec.BPE
        self.prefix = MARK if proto.normalizer_spec.add_dummy_prefix else ""
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == kind.UNKNOWN)
        plain = [(i, p) for i, p in enumerate(proto.pieces) if p.type in (kind.NORMAL, 0)]
        if any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in proto.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        if any(MARK in p.piece.lstrip(MARK) or "\n" in p.piece for _, p in plain):
            raise ValueError("a piece spans a word boundary")
        self.ids = {p.piece: i for i, p in plain}
        self.scores = {p.piece: p.score for _, p in plain}
        #: Every tail of a piece, and whether it is a piece itself.
        self.ends = dict.fromkeys((p[k:] for p in self.ids for k in range(len(p))), False) | dict.fromkeys(self.ids, True)
        self.byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == kind.BYTE}
        self.floor = min(self.scores.values(), default=0.0) - UNKNOWN_PENALTY
        self.outputs = [p.piece.replace(MARK, " ").encode() if p.type in (kind.NORMAL, 0) else bytes([int(p.piece[3:5], 16)]) if p.type == kind.BYTE else " ⁇ ".encode() if p.type == kind.UNKNOWN else b"" for p in proto.pieces]
        self.parts: dict[str, tuple[str, str]] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.cache: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """Pieces of a short text by its merges, best score first, then leftmost."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def halves(self, piece: str) -> tuple[str, str]:
        """The two parts that a piece's last merge joins; ('', '') if the merges don't arrive at it."""
        if (known := self.parts.get(piece)) is None:
            rest, known = list(piece), ("", "")
            while len(rest) > 1:
                scores = [self.scores.get(a + b, -np.inf) for a, b in zip(rest, rest[1:])]
                at = max(range(len(scores)), key=scores.__getitem__)
                if scores[at] == -np.inf:
                    known = ("", "")
                    break
                known = (rest[at], rest[at + 1])
                rest[at : at + 2] = ["".join(known)]
            self.parts[piece] = known
        return known

    def adjacent(self, left: str, right: str) -> bool:
        """Whether two pieces stay apart and whole beside each other; left '' for a word's start.

        Merges are undone from the last: at each step a merge across the border must
        not come before the one just undone (of equal scores the left one comes first).
        """
        key = (left, right)
        if (known := self.pairs.get(key)) is None:
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            whole = len(right) == 1 or self.halves(right)[0] != ""
            if not whole or not left:
                known = whole
            elif right[:2] == MARK + MARK or left[-2:] == MARK + MARK:  # runs of marks have equal scores
                known = self.merged(left + right) == [left, right]
            else:
                known = self.apart(left, right)
            self.pairs[key] = known
        return known

    def apart(self, left: str, right: str) -> bool:
        scores, at_least, strict = self.scores, -np.inf, False
        a = scores[left] if len(left) > 1 else np.inf
        b = scores[right] if len(right) > 1 else np.inf
        while True:
            across = scores.get(left + right)
            if across is not None and (across > at_least or across == at_least and not strict):
                return False
            if a < b:
                at_least, strict = a, True
                left = self.halves(left)[1]
                a = scores[left] if len(left) > 1 else np.inf
            elif b < np.inf:
                at_least, strict = b, False
                right = self.halves(right)[0]
                b = scores[right] if len(right) > 1 else np.inf
            else:
                return True

    def encode_sorted(self, words: list[str]) -> list[bytes]:
        """Ids of sorted distinct words as little-endian uint32, sharing the states of common prefixes."""
        ends, scores, bpe, pairs = self.ends, self.scores, self.bpe, self.pairs
        last: list[str] = [""]
        best: list[float] = [0.0]
        before, out = "", []
        for word in words:
            shared, most = 0, min(len(before), len(word))
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del last[shared + 1 :], best[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                start = end - 1
                piece = word[start:end]
                known = ends.get(piece, True)  # a character that the model lacks stands alone
                if bpe:
                    while True:
                        if known:
                            fits = pairs.get((last[start], piece))
                            if fits or fits is None and self.adjacent(last[start], piece):
                                break
                        start -= 1
                        piece = word[start:end]
                        known = ends[piece]  # some piece has a state, so this ends before the tails of pieces do
                    last.append(piece)
                else:
                    top, chosen = best[start] + scores.get(piece, self.floor), piece
                    while start and known is not None:
                        start -= 1
                        piece = word[start:end]
                        known = ends.get(piece)
                        if known and best[start] + scores[piece] >= top:
                            top, chosen = best[start] + scores[piece], piece
                    last.append(chosen)
                    best.append(top)
            out.append(self.ids_of(word, last))
            before = word
        return out

    def ids_of(self, word: str, last: list[str]) -> bytes:
        found: list[int] = []
        end = len(word)
        while end:
            piece = last[end]
            if (i := self.ids.get(piece)) is not None:
                found.append(i)
            elif self.byte_ids:
                found += [self.byte_ids[b] for b in reversed(piece.encode())]
            else:
                found.append(self.unknown)
            end -= len(piece)
        return array("I", found[::-1]).tobytes()

    def clear(self) -> None:
        self.cache.clear()
        self.pairs.clear()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian uint32."""
        common.hold("sentence_pieces", self.clear)
        split = [SPLIT.findall((self.prefix + t).replace(" ", MARK)) if t else [] for t in texts]
        cache = self.cache
        missing = sorted(set(chain.from_iterable(split)) - cache.keys())
        if len(cache) + len(missing) > CACHE_WORDS:
            cache.clear()
            missing = sorted(set(chain.from_iterable(split)))
        cache.update(zip(missing, self.encode_sorted(missing), strict=True))
        return [b"".join(map(cache.__getitem__, words)) for words in split]

    def decode(self, ids: np.ndarray) -> str:
        table, n = self.outputs, len(self.outputs)
        text = b"".join([table[i] for i in ids.tolist() if 0 <= i < n]).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


@lru_cache(maxsize=2)
def load(path: str) -> Model:
    return Model(path)


def encode(df: DataFrame, model: str, text: str = "text", carry: tuple[str, ...] = ("doc_id",), back: bool = False) -> DataFrame:
    """carry columns and ids array<int>.

    back: also text string, what the ids decode to as decode() gives it, from the same worker:
    a second pass would take a second worker for each task, with a store of words of its own.
    """
    rows = df.select(*carry, common.text_bytes(text).alias("data"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("data").schema)

    def make():
        m = load(model)

        def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = m.encode([x.as_py().decode("utf-8", "replace") for x in batch.column("data")])
            ends = np.cumsum([0, *(len(x) // 4 for x in found)])
            values = np.frombuffer(b"".join(found), "<i4")
            columns = [*batch.select(carry).columns, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))]
            if back:
                columns.append(pa.array([m.decode(values[a:b]) for a, b in zip(ends, ends[1:])], pa.string()))
            return pa.RecordBatch.from_arrays(columns, [*carry, "ids", *["text"] * back])

        return fn

    return common.map_batches(rows, make, f"{schema}, ids array<int>{', text string' * back}")


def decode(df: DataFrame, model: str, ids: str = "ids", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """carry columns and text string; null ids decode to the empty text."""
    rows = df.select(*carry, F.coalesce(F.col(ids), F.array().cast("array<int>")).alias("__ids"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("__ids").schema)

    def run(batches):
        m = load(model)
        for batch in batches:
            column = batch.column("__ids")
            texts = [m.decode(x.values.to_numpy(zero_copy_only=False)) for x in column]
            yield pa.RecordBatch.from_arrays([*batch.select(carry).columns, pa.array(texts, pa.string())], [*carry, "text"])

    return rows.mapInArrow(run, f"{schema}, text string")
