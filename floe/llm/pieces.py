"""Encoding texts piece by piece with a memory of pieces met before.

A tokenizer that looks at words one by one gives a text the ids of its pieces
in order, if the text is cut only where a word surely ends.  Most pieces
repeat, so the tokenizers library sees each distinct piece about once a worker.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Characters of text cut and encoded at once.
RUN = 1 << 22


def load_tokenizer(path: str):
    """The file's tokenizer, without truncation or padding.  A Spark task has one core,
    so the library's own threads stay off in its worker."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def runs(texts: list[str]) -> Iterator[list[str]]:
    run: list[str] = []
    size = 0
    for t in texts:
        if run and size + len(t) > RUN:
            yield run
            run, size = [], 0
        run.append(t)
        size += len(t)
    if run:
        yield run


class Memory:
    """``encode`` gives the ids of new pieces, as bytes of little-endian unsigned
    32-bit integers; beyond ``limit`` distinct pieces the memory starts anew."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], limit: int):
        self.encode, self.limit, self.known = encode, limit, {}

    def lookup(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces."""
        known = self.known
        new = [p for p in pieces if p not in known]
        if len(known) + len(new) > self.limit:
            known = self.known = {}
            new = pieces
        known.update(zip(new, self.encode(new)))
        return [known[p] for p in pieces]

    def ids(self, pieces: pa.Array, per_text: np.ndarray) -> list[np.ndarray]:
        """Ids of texts, from all their pieces in order and the pieces per text."""
        coded = pieces.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        found = self.lookup(coded.dictionary.to_pylist())
        flat = np.frombuffer(b"".join(found), "<u4")
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        each = size[codes]
        upto = np.cumsum(each)
        total = int(upto[-1]) if len(upto) else 0
        at = np.arange(total) - np.repeat(upto - each - (np.cumsum(size) - size)[codes], each)
        ends = np.concatenate([[0], upto])[np.cumsum(per_text)]
        return np.split(flat[at], ends[:-1]) if len(per_text) else []


def library_ids(tokenizer, texts: list[str]) -> list[bytes]:
    """Ids of whole strings, as the library encodes them without added special tokens."""
    out: list[bytes] = []
    for a in range(0, len(texts), 4096):
        for e in tokenizer.encode_batch_fast(texts[a : a + 4096], add_special_tokens=False):
            out.append(array("I", e.ids).tobytes())
    return out


def _byte_alphabet() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the
    others, in order, for the characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


_ALPHABET = _byte_alphabet()
#: Letters whose lower case and normal form are one character each, and what their UTF-8 bytes look like to the model.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017e"
_MAPPED = {c: "".join(_ALPHABET[b] for b in chr(c).encode()) for c in range(0xC0, 0x180)}
#: One word of these letters, maybe after a space, maybe with one mark at its end: its pre-tokens are plain.
_PLAIN = re.compile(f"( ?)([{_LETTERS}]+)([.,]?)")


def word_ids(tokenizer, pieces: list[str], lower: bool) -> list[bytes]:
    """Ids of pieces.  A plain word is one pre-token and its closing mark another, both
    merged by the library's model directly; other pieces go through the whole library."""
    tokenize = tokenizer.model.tokenize

    def merged(mapped: str) -> bytes:
        return array("I", [t.id for t in tokenize(mapped)]).tobytes()

    mark = {"": b"", ".": merged("."), ",": merged(",")}
    out: list[bytes | None] = []
    for p in pieces:
        m = _PLAIN.fullmatch(p)
        if m is None:
            out.append(None)
            continue
        space, word, end = m.groups()
        word = word.lower() if lower else word
        word = word if word.isascii() else word.translate(_MAPPED)
        out.append(merged("\u0120" + word if space else word) + mark[end])
    rest = [i for i, b in enumerate(out) if b is None]
    for i, b in zip(rest, library_ids(tokenizer, [pieces[i] for i in rest])):
        out[i] = b
    return out
