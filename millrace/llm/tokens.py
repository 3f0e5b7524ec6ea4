"""Token ids of whole texts, by the tokenizers library, without encoding a word twice.

Both vocabularies split text before they merge: never across the start of a run of ASCII
white space, and always between a letter and an ASCII character that is none, save behind
an apostrophe. So a text is cut there into units, a task encodes each distinct unit once,
many in one call, and a text's ids are its units' ids in turn. The units of a batch are
slices of its bytes, which Arrow makes distinct; ids are gathered by number. Texts with
other white space are encoded whole, as there the cut could change the split.
"""

from __future__ import annotations

import itertools
import os
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

#: Distinct units of a generation that a worker remembers, and the longest one worth it.
CACHE_UNITS = 500_000
UNIT_CHARS = 200
#: Bytes of text that are cut together. A longer text is cut by itself.
_SLICE_BYTES = 4 << 20
_TOGETHER = 64
_ASCII_ODD = "\x1c\x1d\x1e\x1f"
_OTHER_SPACE = _ASCII_ODD + "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_SEPARATOR = "<|endoftext|>"
# Letters below are letters in every version of Unicode that libraries may go by. One of
# them becomes a letter and a mark when it is made small.
_LAST_LETTER = "\u0250"
_TWO_WHEN_SMALL = "\u0130"

# Kinds of bytes: what is not told from a byte alone, white space, line feed, letter,
# apostrophe, other ASCII.
_UNTOLD, _SPACE, _FEED, _LETTER, _APOSTROPHE, _SIGN = range(6)
_KINDS = np.full(256, _UNTOLD, np.uint8)
_KINDS[:128] = _SIGN
_KINDS[[*b"\t\x0b\x0c\r "]] = _SPACE
_KINDS[ord("\n")] = _FEED
_KINDS[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1)]] = _LETTER
_KINDS[ord("'")] = _APOSTROPHE


def _pairs(*pairs: tuple[int, int]) -> np.ndarray:
    """By eight times the kind of a byte and the kind of the next: whether the pair is listed."""
    found = np.zeros(64, bool)
    found[[8 * a + b for a, b in pairs]] = True
    return found


_INSIDE = [(_LETTER, _APOSTROPHE), (_LETTER, _SIGN), (_SIGN, _LETTER)]
_BLACK = (_UNTOLD, _LETTER, _APOSTROPHE, _SIGN)
# A unit has the white space before it, or none where the vocabulary drops it.
_CUTS_SPACED = _pairs(*_INSIDE, *((a, b) for a in _BLACK for b in (_SPACE, _FEED)))
_CUTS_BARE = _pairs(*_INSIDE, *((a, b) for a in (_SPACE, _FEED) for b in _BLACK))
_AFTER_FEED = _pairs(*((_FEED, b) for b in _BLACK))


def _kinds(data: np.ndarray) -> np.ndarray:
    """Kinds of the bytes of UTF-8 text; both bytes of a letter below _LAST_LETTER are letters."""
    kinds = _KINDS[data]
    leads = np.flatnonzero((data >= 0xC3) & (data <= 0xC8))
    code = (data[leads].astype(np.int32) & 0x1F) << 6 | data[leads + 1] & 0x3F
    leads = leads[(code != 0xD7) & (code != 0xF7) & (code != ord(_TWO_WHEN_SMALL))]
    kinds[leads] = kinds[leads + 1] = _LETTER
    return kinds


def _plain(text: str) -> bool:
    """Whether all are letters that need no normalising but small letters."""
    return text.isalpha() and (text.isascii() or max(text) < _LAST_LETTER and _TWO_WHEN_SMALL not in text)


class UnitEncoder:
    """``encode`` gives the ids of each text as little-endian unsigned 32-bit integers.

    ``leading_space`` tells that white space belongs to the ids (byte-level vocabularies);
    else the vocabulary drops it. Strings of special tokens count as ordinary text.
    Units are remembered for two generations: when the newer one is full the older one is
    dropped, and what is used again moves to the newer.
    """

    def __init__(self, vocabulary: str, leading_space: bool, cache_units: int = CACHE_UNITS):
        from tokenizers import Tokenizer, pre_tokenizers

        # One vocabulary in memory, set up anew for each of three uses.
        self._tokenizer = Tokenizer.from_str(vocabulary)
        self._separator = self._tokenizer.token_to_id(_SEPARATOR)
        self._split, self._normal = self._tokenizer.pre_tokenizer, self._tokenizer.normalizer
        self._unsplit = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self._spaced = leading_space
        self._new: dict[bytes, bytes] = {}
        self._old: dict[bytes, bytes] = {}
        self._cache_units = cache_units

    def _ids(self, texts: list[str], joined: bool = False, letters: bool = False) -> list[np.ndarray]:
        """Ids of texts: whole ones, or with separators between units, of letters only or not.

        Words of letters only are one part of either vocabulary's split, so they need not
        be searched for it, and plain ones need no normalising but small letters.
        """
        used = self._tokenizer
        used.encode_special_tokens = not joined
        used.pre_tokenizer = self._unsplit if letters else self._split
        used.normalizer = None if letters and not self._spaced else self._normal
        found = used.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4") for e in found]

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [ids.tobytes() for ids in self._ids(texts)]

    def _learn(self, units: list[bytes]) -> Iterator[bytes]:
        """Ids of distinct units, in turn. A special token between them keeps them apart."""
        texts = [u.decode() for u in units]
        plain = [_plain(t[1:] if t[:1] == " " else t) for t in texts]
        odd = ["<|" in t or len(t) > UNIT_CHARS for t in texts]
        letters = [t if self._spaced else t.lower() for t, p, o in zip(texts, plain, odd) if p and not o]
        others = [t for t, p, o in zip(texts, plain, odd) if not p and not o]
        ways = self._apart(others, False), self._apart(letters, True), iter(self._whole([t for t, o in zip(texts, odd) if o]))
        for p, o in zip(plain, odd):
            yield next(ways[2 if o else p])

    def _apart(self, texts: list[str], letters: bool) -> Iterator[bytes]:
        step = _TOGETHER * 256
        for at in range(0, len(texts), step):
            starts = range(at, min(at + step, len(texts)), _TOGETHER)
            joined = [_SEPARATOR.join(texts[i : i + _TOGETHER]) for i in starts]
            for ids in self._ids(joined, True, letters):
                cuts = (np.flatnonzero(ids == self._separator) * 4).tolist()
                raw = ids.tobytes()
                begin = 0
                for end in [*cuts, len(raw)]:
                    yield raw[begin:end]
                    begin = end + 4

    def _cut(self, data: np.ndarray, text_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places where units begin, the bytes that units have, and where they begin in these."""
        kinds = _kinds(data)
        pairs = kinds[:-1] << 3 | kinds[1:]
        first = np.zeros(len(data), bool)
        first[text_starts] = True
        if self._spaced:
            first[1:] |= _CUTS_SPACED[pairs]
            first[1:] |= first[:-1] & _AFTER_FEED[pairs]
            starts = np.flatnonzero(first)
            return starts, data, starts
        first[1:] |= _CUTS_BARE[pairs]
        kept = (kinds != _SPACE) & (kinds != _FEED)
        starts = np.flatnonzero(first)
        return starts, data[kept], (np.cumsum(kept) - kept)[starts]

    def _lookup(self, units: list[bytes]) -> list[bytes]:
        """Ids of distinct units."""
        new, old = self._new, self._old
        found = list(map(new.get, units))
        unknown = []
        for n in [n for n, ids in enumerate(found) if ids is None]:
            unit = units[n]
            ids = old.get(unit)
            if ids is None:
                unknown.append(n)
            else:
                found[n] = new[unit] = ids
        for n, ids in zip(unknown, self._learn([units[n] for n in unknown])):
            found[n] = ids
            if len(units[n]) <= UNIT_CHARS:  # long units are looked up in this batch only
                new[units[n]] = ids
        if len(new) > self._cache_units:
            self._new, self._old = {}, new
        return found

    def _join(self, texts: list[bytes]) -> list[bytes]:
        """Ids of texts without other white space, by their units."""
        ends = np.cumsum([len(t) for t in texts])
        if not ends[-1]:
            return [b""] * len(texts)
        text_starts = np.append(0, ends[:-1])
        starts, data, places = self._cut(np.frombuffer(b"".join(texts), np.uint8), text_starts[text_starts < ends])
        buffers = [None, pa.py_buffer(np.append(places, len(data))), pa.py_buffer(data)]
        # Look-ups in a large table are what costs, so units are made distinct first.
        units = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
        found = self._lookup(units.dictionary.to_numpy(zero_copy_only=False).tolist())
        which = units.indices.to_numpy()
        lengths = np.fromiter(map(len, found), np.int64) // 4
        many = lengths[which]
        upto = np.append(0, np.cumsum(many))
        # A unit's ids lie in a row among those of the distinct units.
        shift = (np.cumsum(lengths) - lengths)[which] - upto[:-1]
        out = np.frombuffer(b"".join(found), "<u4")[np.repeat(shift, many) + np.arange(upto[-1])].tobytes()
        cuts = 4 * upto[np.searchsorted(starts, np.append(text_starts, ends[-1]))]
        return [out[a:b] for a, b in itertools.pairwise(cuts.tolist())]

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        out: list[bytes | None] = []
        held, size = [], 0  # places and bytes of texts to cut together

        def settle() -> None:
            for (n, _), ids in zip(held, self._join([data for _, data in held])):
                out[n] = ids

        for n, text in enumerate(texts):
            odd = _ASCII_ODD if text.isascii() else _OTHER_SPACE
            if any(map(text.__contains__, odd)):
                out.append(self._whole([text])[0])
                continue
            out.append(None)
            held.append((n, text.encode()))
            size += len(held[-1][1])
            if size >= _SLICE_BYTES:
                settle()
                held, size = [], 0
        if held:
            settle()
        return out


def encoder(vocabulary: str, leading_space: bool) -> UnitEncoder:
    """The encoder of this Python worker, which later tasks of the worker find again."""
    # Code sent by value has new globals in every task, so they cannot hold it.
    kept = sys.__dict__.setdefault("_unit_encoders", {})
    key = (hash(vocabulary), leading_space)
    if key not in kept:
        # A task has one core, and the library would start a thread for each of the machine's.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        kept.clear()
        kept[key] = UnitEncoder(vocabulary, leading_space)
    return kept[key]


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()
