"""Token ids of whole texts with a public tokenizer file, in Arrow batches."""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from roadframe.llm.words import Words

VOCABULARY = "word_bpe_49k.json"
#: known pieces, and known chunks, of a worker's younger and older half (memory
#: bound; the ids do not depend on it)
KNOWN = 250_000
#: rows and bytes of text encoded at once: long slices repeat more of their words
ROWS, BYTES = 4000, 4 << 20


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Place of a public vocabulary file; every worker looks for its own."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: letters of Latin-1 beyond ASCII; lower() is the tokenizer's own lower case there
_LETTERS = "a-z\u00df-\u00f6\u00f8-\u00ff"
#: texts of printable ASCII, accented Latin-1 letters, blanks and line ends are
#: composed already; the strings of special tokens begin with _SPECIAL
_SPECIAL = "<|"
_PLAIN = "^[ \\n!-~\u00c0-\u00d6\u00d8-\u00de" + _LETTERS + "]*$"
#: the vocabulary file's split pattern for such texts in lower case
_PIECES = "('s|'t|'re|'ve|'m|'ll|'d|[" + _LETTERS + "]+|[0-9]|[^ \\n0-9" + _LETTERS + "]+)"


class Known(dict):
    """Answers kept in two halves: once the younger one is full it becomes the
    older one, so what is still in use stays and the rest is forgotten."""

    def __init__(self):
        super().__init__()
        self.older: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        found = self.older.get(key)
        if found is None:
            found = self.find(key)
        if len(self) >= KNOWN:
            self.older = dict(self)
            self.clear()
        self[key] = found
        return found


class Chunks(Known):
    """Ids of chunks between white space by the whole library."""

    def __init__(self, tokenizer, code: str):
        super().__init__()
        self.tokenizer, self.code = tokenizer, code

    def find(self, key: str) -> bytes:
        return array(self.code, self.tokenizer.encode(key, add_special_tokens=False).ids).tobytes()


def _byte_letters() -> dict[int, int]:
    """The library's byte-level alphabet: printable Latin-1 stands for itself,
    the other bytes, in order, for the characters from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in own]
    return {b: 256 + i for i, b in enumerate(rest)}


_BYTE_LETTERS = _byte_letters()


def _ragged(flat: np.ndarray, size: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``flat`` (run ``c`` has ``size[c]`` values) in the order of
    ``code``, and where each of them ends."""
    first, many = (np.cumsum(size) - size)[code], size[code]
    ends = np.cumsum(many)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(first - (ends - many), many)], ends


class Pieces(Known):
    """Ids of pieces of the split pattern by the library's model."""

    def __init__(self, tokenizer, code: str):
        super().__init__()
        self.model, self.code = tokenizer.model, code

    def find(self, key: str) -> bytes:
        mapped = key if key.isascii() else key.encode().decode("latin-1").translate(_BYTE_LETTERS)
        return array(self.code, [t.id for t in self.model.tokenize(mapped)]).tobytes()


class TextEncoder:
    """Ids of whole texts by the tokenizers library, without special tokens.

    The tokenizer treats runs of white space alike and never joins across
    them, nor across the pieces of its split pattern. So the texts of a batch
    that are plain Latin are split at once by that pattern and every distinct
    piece goes through the library's model; any other text goes chunk by chunk
    through the whole library (the strings of special tokens hold no white
    space, so a chunk keeps them whole).
    """

    def __init__(self, name: str = VOCABULARY):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary_path(name))
        code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.dtype = np.dtype(code)
        self.chunks, self.pieces = Chunks(self.tokenizer, code), Pieces(self.tokenizer, code)
        self.has_pattern = name == VOCABULARY  # the patterns above are that file's

    def encode(self, text: str | None) -> np.ndarray:
        """One text, chunk by chunk."""
        parts = map(self.chunks.__getitem__, re.split("[ \n]+", text or ""))
        return np.frombuffer(b"".join(parts), self.dtype)

    def encode_all(self, texts: pa.Array, end: int) -> list[np.ndarray]:
        """Every text's ids with ``end`` appended; null is as empty."""
        filled = pc.fill_null(texts.cast(pa.large_string()), "")
        plain = pa.array(np.zeros(len(filled), bool))
        if self.has_pattern:
            plain = pc.and_not(pc.match_substring_regex(filled, _PLAIN), pc.match_substring(filled, _SPECIAL))
        simple = pc.if_else(plain, filled, "")
        chunks = Words(simple)
        pieces = Words(pc.replace_substring_regex(pc.utf8_lower(chunks.unique), _PIECES, r"\1 "))
        found = [self.pieces[p] for p in pieces.unique.to_pylist()]
        size = np.fromiter(map(len, found), np.int64, len(found)) // self.dtype.itemsize
        # ids of every distinct chunk, then of every chunk of the texts
        flat, ends = _ragged(np.frombuffer(b"".join(found), self.dtype), size, pieces.code)
        size = np.diff(np.concatenate(([0], ends))[pieces.offsets])
        ids, ends = _ragged(flat, size, chunks.code)
        cuts = np.concatenate(([0], ends))[chunks.offsets]
        tail = np.array([end], self.dtype)
        return [np.concatenate((ids[a:b] if ok else self.encode(filled[i].as_py()), tail))
                for i, (a, b, ok) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), plain.to_pylist(), strict=True))]


_ENCODERS: dict[str, TextEncoder] = {}


def encoder(name: str = VOCABULARY) -> TextEncoder:
    """The worker's encoder; it is kept from task to task."""
    if name not in _ENCODERS:
        _ENCODERS[name] = TextEncoder(name)
    return _ENCODERS[name]
