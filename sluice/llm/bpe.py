"""Byte-level BPE by proven whole tokens, with the library's ids and counts.

A text is cut at single spaces between two characters that aren't white space: there a
pre-token always begins, so that each chunk is encoded alone. Chunks that are one vocabulary
entry are known from ``whole_tokens``; the pre-tokens of the rest are looked up there too,
and only what is left is merged.
"""

from __future__ import annotations

import json
import string
import struct
from functools import lru_cache

import regex
import tiktoken
from tokenizers import Tokenizer

#: Pre-tokens of byte-level BPE, as the vocabulary files' own description states them.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Letters, digits and spaces below are the same in all three libraries (tests compare them);
#: a chunk with a character beyond is left to the tokenizer itself.
SAME_BELOW = "Ͱ"
#: Chunks remembered by one worker before it starts anew, and characters of whole texts.
REMEMBERED = 200_000
REMEMBERED_CHARS = 2_000_000


def _byte_letters() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for the 256 bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=4)
def _loaded(path: str):
    tokenizer = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    letters = _byte_letters()
    vocabulary = {bytes(letters[c] for c in token): i for token, i in model["model"]["vocab"].items()
                  if all(c in letters for c in token)}
    special = [t["content"] for t in model["added_tokens"]]
    ranks = {k: v for k, v in vocabulary.items() if k.decode("latin-1") not in special}
    # Its core merges single pre-tokens; finding them is done here.
    merger = tiktoken.Encoding("merges", pat_str=PRE_TOKENS, special_tokens={}, mergeable_ranks=ranks)._core_bpe
    return tokenizer, vocabulary, special, merger


@lru_cache(maxsize=4)
def whole_tokens(path: str) -> dict[str, int]:
    """Vocabulary strings that, encoded alone, give one token: themselves.

    Proven by encoding each of them with the library. Entries that are no text, or that the
    library cuts into pre-tokens or merges otherwise, aren't in it. The size is bounded by the
    vocabulary, whatever the corpus.
    """
    tokenizer, vocabulary, _, _ = _loaded(path)
    strings = {}
    for token, i in vocabulary.items():
        try:
            strings[token.decode("utf-8")] = i
        except UnicodeDecodeError:
            continue
    encoded = tokenizer.encode_batch(list(strings), add_special_tokens=False)
    return {s: i for (s, i), e in zip(strings.items(), encoded, strict=True) if e.ids == [i]}


#: ASCII characters that are neither white space nor letters nor digits.
MARKS = frozenset(string.punctuation)
PACK = [struct.Struct(f"<{n}I").pack for n in range(17)]


class _Unsafe(Exception):
    """A chunk whose ends touch more white space."""


class _Chunks(dict):
    """Little-endian 32-bit ids, or the number of ids, of ``before`` + chunk; filled as asked.

    ``before`` is a space, or nothing where a chunk begins a text or a line.
    """

    def __init__(self, encoder: "Encoder", before: str):
        super().__init__()
        self.encoder, self.before = encoder, before
        n = len(before)
        self.known = {s[n:]: v for s, v in encoder.whole.items()
                      if s.startswith(before) and len(s) > n and not s[n].isspace() and not s[-1].isspace()}
        self.update(self.known)

    def __missing__(self, chunk: str):
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            raise _Unsafe
        encoder = self.encoder
        # ASCII letters, after a space or not, are one pre-token, and so are a mark that follows
        # them and a line's end between two characters that aren't white space.
        if not chunk.isascii():
            value = encoder.piecewise(self.before + chunk)
        elif chunk.isalpha():
            value = encoder.value(encoder.merger.encode_single_piece((self.before + chunk).encode()))
        elif chunk[-1] in MARKS and (word := chunk[:-1]).isalpha():
            value = self[word] + encoder.merged(chunk[-1])
        elif (at := chunk.find("\n")) > 0 and not chunk[at - 1].isspace() and not chunk[at + 1].isspace():
            value = self[chunk[:at]] + encoder.merged("\n") + encoder.starts[chunk[at + 1:]]
        else:
            value = encoder.piecewise(self.before + chunk)
        if len(self) > REMEMBERED:
            self.clear()
            self.update(self.known)
        self[chunk] = value
        return value


class Encoder:
    """Ids (``ids=True``: as bytes) or counts of whole texts, without added special tokens.

    Special strings inside a text are that special token, as is the library's default.
    """

    def __init__(self, path: str, whole: dict[str, int], ids: bool):
        self.tokenizer, _, self.special, self.merger = _loaded(path)
        self.special_ids = {s: self.tokenizer.token_to_id(s) for s in self.special}
        self.ids, self.pattern = ids, regex.compile(PRE_TOKENS)
        self.whole = {s: self.value([i]) for s, i in whole.items()}
        self.nothing = b"" if ids else 0
        self.chunks, self.starts = _Chunks(self, " "), _Chunks(self, "")
        self.texts, self.chars = {}, 0

    def value(self, ids: list[int]):
        if not self.ids:
            return len(ids)
        return PACK[len(ids)](*ids) if len(ids) < len(PACK) else struct.pack(f"<{len(ids)}I", *ids)

    def merged(self, piece: str):
        """Encode one pre-token."""
        known = self.whole.get(piece)
        return self.value(self.merger.encode_single_piece(piece.encode())) if known is None else known

    def total(self, values):
        return b"".join(values) if self.ids else sum(values)

    def piecewise(self, text: str):
        """Encode a text that has no special string: whole tokens first, merges for the rest."""
        if text.isascii() or max(text) < SAME_BELOW:
            return self.total(map(self.merged, self.pattern.findall(text)))
        return self.value(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def plain(self, text: str):
        if not text:
            return self.nothing
        first, *rest = text.split(" ")
        if first and not first[-1].isspace():
            try:
                return self.total([self.starts[first], *map(self.chunks.__getitem__, rest)])
            except _Unsafe:
                pass
        return self.piecewise(text)

    def encode(self, text: str):
        """Ids or count of a text; copies of a text met before are not encoded again."""
        value = self.texts.get(text)
        if value is None:
            if self.chars + len(text) > REMEMBERED_CHARS:
                self.texts.clear()
                self.chars = 0
            value = self.texts[text] = self._encoded(text)
            self.chars += len(text)
        return value

    def _encoded(self, text: str):
        found = [s for s in self.special if s in text]
        if not found:
            return self.plain(text)
        if len(self.special) > 1:  # which of several comes first is the library's to say
            return self.value(self.tokenizer.encode(text, add_special_tokens=False).ids)
        mark, *values = found[0], None
        for i, part in enumerate(text.split(mark)):
            values += ([self.value([self.special_ids[mark]])] if i else []) + [self.plain(part)]
        return self.total(values[1:])


@lru_cache(maxsize=4)
def encoder(path: str, ids: bool) -> Encoder:
    """One encoder for each worker process."""
    return Encoder(path, whole_tokens(path), ids)


def shipped_encoder(path: str, whole: dict[str, int], ids: bool) -> Encoder:
    """The worker's encoder, made from the table that the driver has proven."""
    key = (path, ids)
    if key not in _SHIPPED:
        _SHIPPED[key] = Encoder(path, whole, ids)
    return _SHIPPED[key]


_SHIPPED: dict[tuple[str, bool], Encoder] = {}
