"""Token ids of whole texts by a public byte-level BPE tokenizer of the tokenizers library.

The tokenizer cuts a text into pieces (words, numbers, signs, white space) and
merges bytes within each piece alone, so a piece has the same ids wherever it
stands. A worker therefore asks the library's model once for each new piece and
keeps its ids. Texts with characters outside the listed ones are given to the library
whole, and so are those that hold an added token such as ``<|endoftext|>`` where
these count as tokens.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable

import numpy as np

# Letters, signs and white space for which the piece pattern below equals the tokenizer's own.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ſ"
_SIGNS = "‘’“”–—…«»€£§¡¿·•©®°"
_SPACE = r"\t\n\v\f\r "
# Alternatives that begin with a character or a class are passed over quickly, and none of those without a lookahead gives back.
_PIECE = re.compile(
    rf" [{_LETTERS}]++|[{_LETTERS}]++|'(?:s|t|re|ve|m|ll|d)|[0-9]++|[^{_SPACE}0-9{_LETTERS}]++"
    rf"| [0-9]++| [^{_SPACE}0-9{_LETTERS}]++|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]++"
)
_PLAIN = re.compile(rf"[\x00-\x7f{_LETTERS}{_SIGNS}]*")
# Byte-level models spell a byte as a character: itself where ISO-8859-1 prints it, the others from U+0100 on.
_PRINTED = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_SPELLED = {byte: 0x100 + n for n, byte in enumerate(b for b in range(256) if b not in _PRINTED)}


class _Ids(dict):
    """The ids of pieces; those of a new one are ``before``'s or come from the model."""

    def __init__(self, tokenize: Callable, before: dict[str, bytes]):
        self.tokenize, self.before = tokenize, before

    def __missing__(self, piece: str) -> bytes:
        ids = self.before.get(piece)
        if ids is None:
            tokens = self.tokenize(piece.encode().decode("latin-1").translate(_SPELLED))
            ids = struct.pack(f"<{len(tokens)}I", *[token.id for token in tokens])
        self[piece] = ids
        return ids


class Encoder:
    """``encode``: texts to little-endian unsigned 32-bit ids; nothing is put around a text.

    With ``added`` what a text holds of the file's added tokens gets their ids, which is the library's default.
    Without it special tokens are encoded as other text.
    """

    #: Pieces kept at once, about: a young generation and the one before, from which what is met again is taken over.
    KEPT = 1_000_000
    #: Characters looked at together.
    _CHUNK = 1 << 19

    def __init__(self, path: str, kept: int | None = None, added: bool = False):
        # A task has one core, and each thread of the library would keep memory of its own.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self._library.encode_special_tokens = not added
        self._added = [t.content for t in self._library.get_added_tokens_decoder().values()] if added else []
        self.KEPT = kept or self.KEPT
        self._ids = _Ids(self._library.model.tokenize, {})

    def encode(self, texts: list[str]) -> list[bytes]:
        out, at = [], 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and size < self._CHUNK:
                size += len(texts[end])
                end += 1
            out += self._encode(texts[at:end])
            at = end
        return out

    def _encode(self, texts: list[str]) -> list[bytes]:
        if len(self._ids) > self.KEPT // 2:
            self._ids.before = {}
            self._ids = _Ids(self._ids.tokenize, self._ids)
        ids, out = self._ids.__getitem__, []
        for text in texts:
            if not text.isascii() and not _PLAIN.fullmatch(text) or any(token in text for token in self._added):
                out.append(self._whole(text))
            else:
                out.append(b"".join(map(ids, _PIECE.findall(text))))
        return out

    def _whole(self, text: str) -> bytes:
        return np.array(self._library.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()


_ENCODERS: dict[tuple[str, int, bool], Encoder] = {}


def encoder(path: str, kept: int = Encoder.KEPT, added: bool = False) -> Encoder:
    """The worker's encoder, which goes from task to task with the ids of about ``kept`` pieces at most.

    A piece with its ids takes some 200 bytes.
    """
    if (path, kept, added) not in _ENCODERS:
        _ENCODERS[path, kept, added] = Encoder(path, kept, added)
    return _ENCODERS[path, kept, added]
