"""Token ids of whole texts, with a memory of pieces.

Both public vocabularies cut a text into pieces before anything else, and some
places where they surely cut can be seen in the bytes: white space for the word
vocabulary; for the byte-level one, before a space or a line feed that is
followed by a character other than white space. A text is cut there, each
distinct piece is encoded once by the tokenizers library, and the ids of the
text are put together from what is remembered. The result is that of encoding
the whole text (tests/llm compares them). The memory is bounded and starts anew
when it is full.
"""

from __future__ import annotations

import functools
import json
import re
import struct
from pathlib import Path

import numpy as np

#: Distinct pieces, and distinct runs of letters or signs in them, that a worker remembers of a vocabulary.
REMEMBER = 400_000

# a space or line feed is a cut unless white space may follow; the lead bytes of
# wide white-space characters count as such, so those places stay whole
_ODD = re.compile(rb"[ \n](?![!-~\xc3-\xdf\xe4-\xf4])")
_BEFORE = re.compile(rb"(?=[ \n][!-~\xc3-\xdf\xe4-\xf4])")
#: The rules of the two vocabulary files for runs inside a piece.
WORD_RUNS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
BYTE_RUNS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces of these characters are cut into runs here, all others by the library: every Unicode version agrees on them.
_PLAIN = re.compile(r"[ \n]?[!-~À-ſ]+")

#: One run of letters by every Unicode version, in the byte-level vocabulary with its space, and perhaps a sign, which is a run.
_WORD = re.compile(r"( ?[A-Za-zÀ-ÖØ-öø-ſ]+)([.,!?;:]?)")
_SIGNS = {b".", b",", b"!", b"?", b";", b":"}


def _letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class Encoder(dict):
    """Pieces -> their ids as little-endian unsigned 32-bit integers, for one vocabulary file."""

    def __init__(self, data: str):
        super().__init__()
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(data)
        self.model = self.tokenizer.model
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        # cut here only by the rules known from the file itself
        file = json.loads(data)
        cut = file["pre_tokenizer"] or {}
        self.spaced = cut.get("type") == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"] and not file["normalizer"]
        self.words = file["model"].get("end_of_word_suffix") == "</w>" and cut.get("type") == "Sequence" and cut["pretokenizers"][0].get("invert") is True
        self.findall = regex.compile(WORD_RUNS if self.words else BYTE_RUNS).findall
        if not all("<|" in t["content"] for t in file["added_tokens"]):
            self.words = self.spaced = False
        self.runs: dict[str, bytes] = {}
        self.words_seen: dict[bytes, bytes] = {}
        self.letters = _letters()
        self.packed = [struct.pack("<I", i) for i in range(self.size)]
        # the character that stands for the space before a run
        self.space = "" if self.words else self.letters[32]

    def _ids(self, text: bytes) -> bytes:
        return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, "<u4").tobytes()

    def _run(self, run: str) -> bytes:
        ids = self.runs.get(run)
        if ids is None:
            if len(self.runs) >= REMEMBER:
                self.runs.clear()
            ids = self.runs[run] = self._tokens(run if run.isascii() and run.isalpha() else run.encode().decode("latin-1").translate(self.letters))
        return ids

    def _tokens(self, run: str) -> bytes:
        packed = self.packed
        return b"".join([packed[x.id] for x in self.model.tokenize(run)])

    def _word(self, word: bytes) -> bytes:
        """A piece of ASCII letters is one run, in lower case for the word vocabulary."""
        if self.words:
            word = word.lower()
        ids = self.words_seen.get(word)
        if ids is None:
            if len(self.words_seen) >= REMEMBER:
                self.words_seen.clear()
            ids = self.words_seen[word] = self._tokens(self.space + word.decode())
        return ids

    def _piece(self, piece: bytes) -> bytes:
        text = piece.decode()
        if not _PLAIN.fullmatch(text) or "<|" in text:
            return self._ids(piece)
        if self.words:
            text = text.lower() if text.isascii() else self.tokenizer.normalizer.normalize_str(text)
        word = _WORD.fullmatch(text)
        if word:  # one run of letters, and a sign
            run, sign = word.groups()
            return self._run(run) + self._run(sign) if sign else self._run(run)
        return b"".join([self._run(r) for r in self.findall(text)])

    def __missing__(self, piece: bytes) -> bytes:
        if len(self) >= REMEMBER:
            self.clear()
        # most pieces are a word of ASCII letters, or one and a sign
        if piece.isalpha():
            ids = self[piece] = self._word(piece)
            return ids
        if piece[-1:] in _SIGNS and piece[:-1].isalpha():
            ids = self[piece] = self._word(piece[:-1]) + self._run(piece[-1:].decode())
            return ids
        # by the byte-level rules a piece comes behind a space, or begins with its line feed
        ids = self[piece] = self._piece(piece if self.words or piece[:1] == b"\n" else b" " + piece)
        return ids

    def encode(self, text: bytes | None) -> bytes:
        """The ids of a whole text; null is an empty one."""
        if not text:
            return b""
        if self.words:
            return b"".join(map(self.__getitem__, text.split()))
        if not self.spaced:
            return self._ids(text)
        if _ODD.search(text):
            first, *rest = _BEFORE.split(text)
            rest = [p[1:] if p[:1] == b" " else p for p in rest]
        else:
            first, *rest = text.replace(b"\n", b" \n").split(b" ")
        return (self._piece(first) if first else b"") + b"".join(map(self.__getitem__, rest))


@functools.cache
def encoder(path: str) -> Encoder:
    """The encoder of a vocabulary file; a worker keeps it from task to task."""
    return Encoder(Path(path).read_text())


def vocabulary(name: str) -> str:
    """Path of a public vocabulary; every machine has the files with its Python libraries."""
    import public_tokenizers

    return public_tokenizers.path(name)
