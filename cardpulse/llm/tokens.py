"""Token ids of whole texts by the ``tokenizers`` library.

The byte-level vocabulary splits a text into pieces before merging, and no
piece reaches across the start of a run of white space.  So a text is the
concatenation of its *chunks* (one blank or newline, then the visible run after
it), and equal chunks have equal ids: each worker encodes a chunk once and
keeps its ids.  New chunks are encoded together, as one text; there each chunk
begins at a token that begins with white space.  A text with adjacent or other
white space, where that need not hold, is encoded as it is.
"""

from __future__ import annotations

import os
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import regex

VOCABULARY = "byte_bpe_50k.json"
#: Chunks in a generation of a worker's memory.  A full generation becomes the old
#: one, and what is found there moves on; this changes only speed.
CACHE_CHUNKS = 300_000
CACHE_BYTES = 64 << 20

_CUT = "\0"
_PIECE = regex.compile(public_tokenizers.PATTERN)


def _byte_symbols() -> dict[int, str]:
    """How byte-level vocabularies spell a byte: itself if printable, else the next character from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) if b in plain else chr(256 + rest.index(b)) for b in range(256)} | {0: _CUT}


_SYMBOLS = _byte_symbols()
#: Marks the first chunk of a text, which has no white space before it.
_HEAD = "\1"
#: Texts with one of these are not cut: white space next to white space, the start of a special token, other white space, our own marks.
_APART = "[ \\n][ \\n]|<\\||[\\x00\\x01\\t\\r\\x0b\\x0c\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{180e}\\x{2000}-\\x{200b}\\x{2028}-\\x{202f}\\x{205f}\\x{2060}\\x{3000}\\x{feff}]"


def _spelled(text: str) -> str:
    """The pieces of a text in byte symbols, cut marks between them."""
    return _CUT.join(_PIECE.findall(text)).encode().decode("latin-1").translate(_SYMBOLS)


class _Memory:
    """Chunks, numbered as they come; the ids of all of them lie in one array, in the order of the numbers."""

    def __init__(self):
        self._chunks = pa.array([], pa.string())
        self._ids = np.empty(1 << 16, "<u4")
        self._start = np.zeros(1 << 14, np.int64)

    def __len__(self) -> int:
        return len(self._chunks)

    def full(self) -> bool:
        return len(self) > CACHE_CHUNKS or self._chunks.nbytes > CACHE_BYTES

    def add(self, chunks: pa.Array, ids: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Number new, distinct chunks, whose ids follow each other in ``ids``."""
        n, stop = len(self), len(self) + len(chunks)
        end = self._start[n]
        self._start = _room(self._start, stop + 1)
        self._ids = _room(self._ids, end + len(ids))
        self._start[n + 1 : stop + 1] = end + np.cumsum(size)
        self._ids[end : end + len(ids)] = ids
        self._chunks = pa.concat_arrays([self._chunks, chunks])
        return np.arange(n, stop)

    def find(self, chunks: pa.Array) -> np.ndarray:
        """Their numbers, -1 for unknown ones."""
        if not len(self) or not len(chunks):
            return np.full(len(chunks), -1)
        return pc.fill_null(pc.index_in(chunks, self._chunks), -1).to_numpy().astype(np.int64)

    def ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these chunks one behind the other, and how many each has."""
        start = self._start[numbers]
        size = self._start[numbers + 1] - start
        at = np.repeat(start - np.cumsum(size) + size, size)
        at += np.arange(len(at))
        return self._ids[at], size


def _room(a: np.ndarray, n: int) -> np.ndarray:
    """``a`` with place for ``n`` values."""
    if n <= len(a):
        return a
    out = np.zeros(max(n, len(a) * 3 // 2), a.dtype)
    out[: len(a)] = a
    return out


class Encoder:
    """Little-endian unsigned 32-bit ids of texts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import Split

        self._path = path
        # merges of text that is split into pieces and spelled in byte symbols here
        self._merges = Tokenizer.from_file(path)
        self._merges.pre_tokenizer = Split(_CUT, "removed")
        self._known, self._old = _Memory(), _Memory()
        self._spaced = np.zeros(self._merges.get_vocab_size(with_added_tokens=True), bool)
        for i in range(len(self._spaced)):
            self._spaced[i] = (self._merges.id_to_token(i) or "x")[0] in _SYMBOLS[32] + _SYMBOLS[10]

    @cached_property
    def _tokenizer(self):
        """The vocabulary file as it is; only texts that are not cut need it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self._path)

    def _encode(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _apiece(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks encoded one by one, and how many each has."""
        found = [e.ids for e in self._merges.encode_batch_fast([_spelled(c) for c in chunks], add_special_tokens=False)]
        return np.array([i for ids in found for i in ids], "<u4"), np.array([len(ids) for ids in found], np.int64)

    def _together(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks encoded in one go, and how many each has; a leading newline is part of the chunk, a blank is not written."""
        written = pc.binary_join_element_wise(pc.if_else(pc.starts_with(chunks, "\n"), "", " "), chunks, "")
        whole = pc.binary_join(pa.ListArray.from_arrays([0, len(written)], written), "")[0].as_py()
        ids = np.array(self._merges.encode_batch_fast([_spelled(whole)], add_special_tokens=False)[0].ids, "<u4")
        starts = np.flatnonzero(self._spaced[ids])
        if len(starts) != len(chunks) or starts[0]:
            raise ValueError("a chunk's tokens do not begin with its white space")
        return ids, np.diff(starts, append=len(ids))

    def _numbers(self, chunks: pa.Array) -> np.ndarray:
        """Numbers of distinct chunks in the memory ``_known``, which learns the new ones."""
        if self._known.full():
            self._known, self._old = _Memory(), self._known
        known = self._known
        found = known.find(chunks)
        new = np.flatnonzero(found < 0)
        missing = chunks.take(pa.array(new))
        before = self._old.find(missing)
        moved = before >= 0
        head = ~moved & pc.starts_with(missing, _HEAD).to_numpy(zero_copy_only=False)
        blank = ~moved & pc.equal(missing, "").to_numpy(zero_copy_only=False)  # a blank at the end of a text
        for kind, encode in ((moved, lambda _: self._old.ids(before[moved])), (head, lambda own: self._apiece([c[1:] for c in own.to_pylist()])),
                             (blank, lambda _: self._apiece([" "])), (~(moved | head | blank), self._together)):
            if kind.any():
                own = missing.filter(pa.array(kind))
                found[new[kind]] = known.add(own, *encode(own))
        return found

    def ids(self, texts: pa.Array | list[str | None]) -> list[bytes]:
        """Ids per text; none for a null or empty one."""
        texts = pc.fill_null(pa.array(texts, pa.string()) if isinstance(texts, list) else texts.cast(pa.string()), "")
        apart = pc.match_substring_regex(texts, _APART)
        whole = apart.to_numpy(zero_copy_only=False)
        out = np.empty(len(texts), object)
        out[whole] = self._encode(texts.filter(apart).to_pylist())
        rest = texts.filter(pc.invert(apart))
        if len(rest):
            cut = pc.split_pattern(pc.binary_join_element_wise(_HEAD, pc.replace_substring(rest, "\n", " \n"), ""), " ")
            coded = cut.flatten().dictionary_encode()
            own = self._numbers(coded.dictionary)
            ids, size = self._known.ids(own[coded.indices.to_numpy()])
            raw = ids.tobytes()
            upto = np.concatenate([[0], np.cumsum(size)]) * 4
            bounds = upto[cut.offsets.to_numpy() - cut.offsets[0].as_py()].tolist()
            out[~whole] = [raw[a:b] for a, b in zip(bounds, bounds[1:])]
        return out.tolist()


@lru_cache(maxsize=1)
def encoder(vocabulary: str = VOCABULARY) -> Encoder:
    """This process's encoder; ``vocabulary`` names a public vocabulary file or is a path."""
    return Encoder(vocabulary if os.path.isabs(vocabulary) else public_tokenizers.path(vocabulary))


def in_slices(texts: pa.Array, size: int = 1 << 22):
    """Slices of ``texts`` of about ``size`` bytes, one text at least, with their begin."""
    length = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    upto = np.cumsum(length)
    at = 0
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(upto, upto[at] - length[at] + size)))
        yield at, texts.slice(at, stop - at)
        at = stop
