"""SentencePiece encoding and decoding by shared-prefix Viterbi.

A text is escaped as the model's trainer does (a mark in front of it and for each blank)
and cut into marked words, across which no piece reaches. A task sorts the distinct words
of a batch, so that they are the leaves of a trie in depth-first order, and walks it: the
forward states of the prefix that a word shares with the one before are still there, and
only the states of its own characters are worked out.

The state of a prefix depends on the model. Pieces of a unigram model have log
probabilities, and the state is the best sum with the last piece's start. A BPE model
ranks merges instead; there each prefix has one segmentation, and its last piece is the
one that stands beside the last piece of what is before it, that is, merging the two
pieces' characters ends in just these two. Either way ids equal the library's.

Defined results: null and empty texts have no ids; characters without a piece become
bytes, which decode to them again; the mark itself decodes to a blank; repeated rows are
encoded each; no rows give no rows.
"""

from __future__ import annotations

import heapq
import re
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

from millrace.llm.common import batched, or_empty

MARK = "▁"
CACHE_WORDS = 500_000
_CACHED_CHARS = 200
_NEVER = float("-inf")


class Segmenter:
    """Cuts marked words into pieces.

    ``scores`` maps pieces to their scores; ``merges`` tells that these rank merges.
    Characters that are no piece stand alone.
    """

    def __init__(self, scores: dict[str, float], merges: bool, unknown: float = -1e3):
        self._scores = scores
        self._merges = merges
        self._unknown = unknown
        self._longest = max(map(len, scores), default=1)
        self._beside: dict[tuple[str, str], bool] = {}
        # Pieces by their characters from the last to the first; "" leads to the piece.
        self._endings: dict = {}
        if merges:
            for piece in scores:
                if self.merged(piece) == [piece]:
                    node = self._endings
                    for char in reversed(piece):
                        node = node.setdefault(char, {})
                    node[""] = piece

    def merged(self, symbols: Iterable[str]) -> list[str]:
        """Merge neighbours, best score first and leftmost of equals, until none makes a piece."""
        parts = list(symbols)
        n = len(parts)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda: list[tuple[float, int, int, str]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j >= 0:
                both = parts[i] + parts[j]
                score = self._scores.get(both)
                if score is not None:
                    heapq.heappush(agenda, (-score, i, j, both))

        for i in range(n - 1):
            offer(i, i + 1)
        while agenda:
            _, i, j, both = heapq.heappop(agenda)
            if not parts[i] or not parts[j] or right[i] != j or parts[i] + parts[j] != both:
                continue
            parts[i], parts[j] = both, ""
            right[i] = right[j]
            if right[j] >= 0:
                left[right[j]] = i
            offer(left[i], i)
            offer(i, right[i])
        return [p for p in parts if p]

    def _stands(self, before: str, piece: str) -> bool:
        """Whether merging the characters of two pieces ends in just these two."""
        key = (before, piece)
        found = self._beside.get(key)
        if found is None:
            if len(self._beside) >= 1_000_000:
                self._beside.clear()
            found = self.merged(before + piece) == [before, piece]
            self._beside[key] = found
        return found

    def _last_merged(self, word: str, end: int, lasts: list[str]) -> str:
        """The last piece of the one segmentation of the prefix up to ``end``."""
        node, at = self._endings, end
        while at:
            node = node.get(word[at - 1])
            if node is None:
                break
            at -= 1
            piece = node.get("")
            if piece is not None and (not at or self._stands(lasts[at], piece)):
                return piece
        return word[end - 1]  # a character that is no piece merges with nothing

    def _last_scored(self, word: str, end: int, lasts: list[str], sums: list[float]) -> str:
        """The last piece of the best segmentation of the prefix up to ``end``."""
        best, last = _NEVER, word[end - 1]
        for start in range(max(0, end - self._longest), end):
            piece = word[start:end]
            score = self._scores.get(piece, self._unknown if start == end - 1 else None)
            if score is not None and sums[start] + score > best:
                best, last = sums[start] + score, piece
        sums.append(best)
        return last

    def segment(self, words: Iterable[str]) -> Iterator[tuple[str, list[str]]]:
        """Each distinct word with its pieces, in sorted order."""
        # The forward states of the prefixes of the word before: last piece, best sum.
        before, lasts, sums = "", [""], [0.0]
        for word in sorted(set(words)):
            if self._merges and MARK * 2 in word:
                # Runs of marks have equal scores, of which the leftmost wins only as a whole.
                yield word, self.merged(word)
                continue
            shared, most = 0, min(len(before), len(word))
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del lasts[shared + 1 :], sums[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                if self._merges:
                    lasts.append(self._last_merged(word, end, lasts))
                else:
                    lasts.append(self._last_scored(word, end, lasts, sums))
            before = word
            pieces, end = [], len(word)
            while end:
                pieces.append(lasts[end])
                end -= len(lasts[end])
            yield word, pieces[::-1]


class PieceModel:
    """A model file's pieces, with encoding and decoding of texts."""

    def __init__(self, model: bytes, cache_words: int = CACHE_WORDS):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        parsed = proto.ModelProto()
        parsed.ParseFromString(model)
        spec = parsed.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("only models that leave the text as it is are supported")
        kinds = proto.ModelProto.SentencePiece
        processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = processor.get_piece_size()
        self._prefix = MARK if spec.add_dummy_prefix else ""
        self._ids: dict[str, bytes] = {}  # little-endian, like all ids here
        scores: dict[str, float] = {}
        self._bytes = [processor.unk_id().to_bytes(4, "little")] * 256
        self._text: list[bytes] = []
        for n in range(size):
            piece, kind = parsed.pieces[n].piece, parsed.pieces[n].type
            shown = piece.replace(MARK, " ").encode()
            if kind == kinds.BYTE:
                value = int(piece[3:5], 16)
                self._bytes[value] = n.to_bytes(4, "little")
                shown = bytes([value])
            elif kind == kinds.CONTROL:
                shown = b""
            elif kind == kinds.UNKNOWN:
                shown = parsed.trainer_spec.unk_surface.encode()
            else:
                self._ids[piece] = n.to_bytes(4, "little")
                scores[piece] = parsed.pieces[n].score
            self._text.append(shown)
        if any(MARK in p.lstrip(MARK) for p in scores):
            raise ValueError("pieces reach across words")
        merges = parsed.trainer_spec.model_type == proto.TrainerSpec.BPE
        self._segmenter = Segmenter(scores, merges, min(scores.values(), default=0.0) - 10.0)
        # Control characters that are in no piece part words as well.
        apart = "".join(c for c in "\n\t\r" if not any(c in p for p in scores))
        self._words = re.compile(f"{MARK}*[^{MARK}{apart}]+|{MARK}+" + (f"|[{apart}]+" if apart else "")).findall
        # Two generations: when the newer is full the older goes, and what is used moves on.
        self._new: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._cache_words = cache_words

    def _id_bytes(self, pieces: list[str]) -> bytes:
        ids = self._ids
        return b"".join([ids[p] if p in ids else self._byte_ids(p) for p in pieces])

    def _byte_ids(self, character: str) -> bytes:
        return b"".join([self._bytes[b] for b in character.encode("utf-8", "surrogatepass")])

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        words = [self._words(self._prefix + t.replace(" ", MARK)) if t else [] for t in texts]
        distinct = set()
        for found in words:
            distinct.update(found)
        new, old = self._new, self._old
        known = dict(zip(distinct, map(new.get, distinct)))
        unknown = []
        for word in [w for w, ids in known.items() if ids is None]:
            if word in old:
                known[word] = new[word] = old[word]
            else:
                unknown.append(word)
        for word, pieces in self._segmenter.segment(unknown):
            known[word] = self._id_bytes(pieces)
            if len(word) <= _CACHED_CHARS:  # long words are looked up in this batch only
                new[word] = known[word]
        out = [b"".join(map(known.__getitem__, found)) for found in words]
        if len(new) > self._cache_words:
            self._new, self._old = {}, new
        return out

    def decode(self, ids: Iterable[int]) -> str:
        raw = b"".join(map(self._text.__getitem__, ids))
        if self._prefix and raw.startswith(b" "):
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


def _model(model: bytes) -> PieceModel:
    """The model of this Python worker, which later tasks of the worker find again."""
    kept = sys.__dict__.setdefault("_piece_models", {})
    if hash(model) not in kept:
        kept.clear()
        kept[hash(model)] = PieceModel(model)
    return kept[hash(model)]


def read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, model: bytes, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids, text_sha256`` for each row; the hash is that of the text encoded."""
    body = or_empty(F.col(text))
    rows = batched(docs.select(F.col(doc_id).alias("doc_id"), body.alias("text"), F.sha2(body, 256).alias("text_sha256")))
    schema = StructType(
        [rows.schema["doc_id"], StructField("ids", ArrayType(IntegerType())), StructField("text_sha256", StringType())]
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = _model(model)
        for batch in batches:
            out = batch[["doc_id", "text_sha256"]].copy()
            out["ids"] = [np.frombuffer(b, "<i4") for b in pieces.encode(batch["text"].tolist())]
            yield out[["doc_id", "ids", "text_sha256"]]

    return rows.mapInPandas(run, schema)


def decode(encoded: DataFrame, model: bytes) -> DataFrame:
    """``encoded`` with the ``text`` that its ``ids`` stand for."""
    schema = StructType([*encoded.schema.fields, StructField("text", StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = _model(model)
        for batch in batches:
            out = batch.copy()
            out["text"] = [pieces.decode(ids.tolist()) for ids in batch["ids"]]
            yield out

    return encoded.mapInPandas(run, schema)
