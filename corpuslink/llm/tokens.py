"""Token ids of whole texts from a public tokenizer file, fast enough for corpora.

The ids are those of ``Tokenizer.encode(text, add_special_tokens=False)``. Both
supported files never join characters across a single space, so a text is cut at
its single spaces, each distinct piece is encoded once by the tokenizer, and the
ids of a text are the joined ids of its pieces. A text for which that does not hold
(runs of white space) is encoded whole. Pieces are remembered per Python worker, up
to a bound; the bound changes the speed only.
"""

from __future__ import annotations

import ctypes
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Where the tokenizer files lie (a folder); unset: the installed public package.
TOKENIZER_DIR_ENV = "LLM_TOKENIZER_DIR"
MAX_PIECES = 1_500_000
ROOM_FOR_ALL = 500_000         # beyond this, only pieces seen twice at once are remembered
MAX_PIECE_CHARS = 64
SEPARATOR = "\x02"
#: White space other than the space and the line feed (fixed by Unicode).
OTHER_SPACE = tuple("\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u180e\u2000\u2001\u2002\u2003"
                    "\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def tokenizer_path(name: str) -> str:
    """The file of a public tokenizer: from the folder in the environment, else the package."""
    folder = os.environ.get(TOKENIZER_DIR_ENV)
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers
    return public_tokenizers.path(name)


class PieceEncoder:
    """``encode(texts)`` gives the ids of texts as one array of ``dtype``."""

    def __init__(self, path: str, dtype: str = "<u4"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype(dtype)
        vocab = self.tokenizer.get_vocab()
        if len(vocab) and max(vocab.values()) > np.iinfo(self.dtype).max:
            raise ValueError(f"ids of {path} do not fit {dtype}")
        self.byte_level = "Ġthe" in vocab
        # what a text cut at single spaces must not hold
        self.whole = ("\x00", "  ", " \n", "\n ", "\n\n", *OTHER_SPACE) \
            if self.byte_level else ("\x00",)
        if self.byte_level:
            size = max(vocab.values()) + 1
            self.starts = np.zeros(size, bool)
            for token, i in vocab.items():
                self.starts[i] = token.startswith("Ġ") or token == "Ċ"
        else:
            ids = self._ids(SEPARATOR)
            if len(ids) != 1:
                raise ValueError(f"{path}: the separator is not one token")
            self.separator = ids[0]
        self.tails = [self._ids(x) for x in ".,"]
        if any(len(x) != 1 for x in self.tails):
            raise ValueError(f"{path}: a full stop or comma is not one token")
        self.pieces: dict[str, bytes] = {}

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _bytes(self, text: str) -> bytes:
        return np.array(self._ids(text), self.dtype).tobytes()

    def _new(self, new: list[str]) -> dict[str, bytes]:
        """Encode unseen pieces, many in one call, and cut the ids at the piece starts."""
        made: dict[str, bytes] = {}
        group, alone = [], []
        for p in new:
            if self.byte_level:
                fits = len(p) > 1 and p[0] in " \n" and "<|" not in p
            else:
                fits = p != "" and SEPARATOR not in p and "<|" not in p
            (group if fits else alone).append(p)
        for p in alone:
            made[p] = self._bytes(p)
        width = self.dtype.itemsize
        for k in range(0, len(group), 200):
            part = group[k:k + 200]
            if self.byte_level:
                ids = np.array(self._ids("".join(part)), np.int64)
                cuts = np.flatnonzero(self.starts[ids])
                ends = np.append(cuts[1:], len(ids))
            else:
                ids = np.array(self._ids(f" {SEPARATOR} ".join(part)), np.int64)
                stops = np.flatnonzero(ids == self.separator)
                cuts = np.concatenate([[0], stops + 1])
                ends = np.append(stops, len(ids))
            if len(cuts) != len(part) or (self.byte_level and len(cuts) and cuts[0] != 0):
                for p in part:
                    made[p] = self._bytes(p)
                continue
            raw = ids.astype(self.dtype).tobytes()
            for p, a, b in zip(part, (cuts * width).tolist(), (ends * width).tolist()):
                made[p] = raw[a:b]
        return made

    def _pieces_of(self, keys: list[str], often: np.ndarray) -> list[bytes]:
        """The ids of each piece, from memory or newly encoded. Once many are remembered,
        only those that occur ``often`` here are: most of the others never come again."""
        known = self.pieces
        found = list(map(known.get, keys))
        if None not in found:
            return found
        missing, k = [], -1
        for _ in range(found.count(None)):
            k = found.index(None, k + 1)
            missing.append(k)
        made = self._new([keys[k] for k in missing])
        for k in missing:
            found[k] = made[keys[k]]
        if len(known) > ROOM_FOR_ALL:
            missing = np.array(missing)[often[missing]].tolist()
        for k in missing:
            key = keys[k]
            if len(key) <= MAX_PIECE_CHARS:
                known[key] = found[k]
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts joined, number of ids of each text); null is an empty text."""
        if len(self.pieces) > MAX_PIECES:
            self.pieces.clear()
        texts = texts.cast(pa.large_string()).fill_null("")
        whole = [i for i, t in enumerate(texts.to_pylist())
                 if any(map(t.__contains__, self.whole))]
        if not whole:
            return self._encode_cut(texts)
        mask = np.ones(len(texts), bool)
        mask[whole] = False
        ids, some = self._encode_cut(texts.filter(pa.array(mask)))
        alone = {i: np.frombuffer(self._bytes(texts[i].as_py()), self.dtype) for i in whole}
        sizes = np.zeros(len(texts), np.int64)
        sizes[mask] = some
        sizes[whole] = [len(alone[i]) for i in whole]
        parts, done = [], 0
        ends = np.concatenate([[0], np.cumsum(sizes * mask)])
        for i in whole:
            parts += [ids[done:ends[i]], alone[i]]
            done = ends[i]
        return np.concatenate([*parts, ids[done:]]), sizes

    def _encode_cut(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts that may be cut before each single space."""
        if not len(texts):
            return np.zeros(0, self.dtype), np.zeros(0, np.int64)
        # byte level: a line feed starts a piece, too; else it is white space like a space
        cut = pc.split_pattern(pc.replace_substring(
            texts, "\n", " \n" if self.byte_level else " "), " ")
        bounds = cut.offsets.to_numpy()
        words = cut.values.slice(int(bounds[0]), int(bounds[-1] - bounds[0])).dictionary_encode()
        bounds = bounds - bounds[0]
        codes = words.indices.to_numpy()
        distinct = words.dictionary
        # a full stop or comma after a letter or digit, at a piece's end, is its own token
        tailed = pc.match_substring_regex(distinct, r"[\pL\pN][.,]$")
        stems = pc.if_else(tailed, pc.utf8_slice_codeunits(distinct, 0, -1),
                           distinct).dictionary_encode()
        tail = np.where(tailed.to_numpy(zero_copy_only=False), np.where(
            pc.ends_with(distinct, ".").to_numpy(zero_copy_only=False), *self.tails), -1)[codes]
        codes = stems.indices.to_numpy()[codes]
        keys = stems.dictionary.to_pylist()
        often = np.bincount(codes, minlength=len(keys)) > 1
        if self.byte_level:
            pieces = self._pieces_of([w if w[:1] == "\n" else " " + w for w in keys], often)
            first = bounds[:-1]                       # a text's first word has no space
            pieces += self._pieces_of(cut.values.take(pa.array(cut.offsets.to_numpy()[:-1]))
                                      .to_pylist(), np.zeros(len(first), bool))
            codes[first] = len(keys) + np.arange(len(first))
            tail[first] = -1
        else:
            pieces = self._pieces_of(keys, often)
        size = np.fromiter(map(len, pieces), np.int64, len(pieces)) // self.dtype.itemsize
        start = np.cumsum(size) - size
        flat = np.frombuffer(b"".join([*pieces, bytes(self.dtype.itemsize)]), self.dtype)
        number = size[codes]
        has = tail >= 0
        number += has
        ends = np.cumsum(number)
        at = np.repeat(start[codes] - (ends - number), number)
        at += np.arange(len(at))
        ids = flat[at]
        ids[ends[has] - 1] = tail[has]
        return ids, np.diff(np.concatenate([[0], ends])[bounds])


def slices(texts: pa.Array, max_bytes: int = 8 << 20) -> Iterator[tuple[int, int]]:
    """(first row, rows) of runs of about ``max_bytes``, one row at least."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False),
                      dtype=np.int64)
    at = 0
    while at < len(texts):
        before = int(sizes[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, before + max_bytes, "right")))
        yield at, to - at
        at = to


_ENCODERS: dict[tuple[str, str], PieceEncoder] = {}


def encoder(path: str, dtype: str = "<u4") -> PieceEncoder:
    """The worker's encoder for a file (loaded once per Python worker)."""
    key = (path, dtype)
    if key not in _ENCODERS:
        _ENCODERS[key] = PieceEncoder(path, dtype)
    return _ENCODERS[key]


def release() -> None:
    """At a task's end, give freed memory back to the system: a Python worker stays for
    later tasks, of other operators, too."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):                    # not every C library has it
        pass


def forget() -> None:
    """Give the memory of remembered pieces back (a worker's later tasks may not encode)."""
    for e in _ENCODERS.values():
        e.pieces.clear()
