"""Public tokenizers inside tasks; whole texts are encoded.

The word vocabulary splits a text into runs of letters, single digits and runs
of other signs before any merge, and white space is dropped.  Runs of Latin
text are merged by tiktoken's core over the same merge ranks and remembered;
everything else goes through the tokenizers library itself.  Tests compare
the ids with the library's.
"""

from __future__ import annotations

import base64
import json
import os
import re
from array import array
from functools import lru_cache

import numpy as np
import regex

KEEP = 400_000  # runs remembered by one Python worker
WORD_BPE, BYTE_BPE, BYTE_RANKS = "word_bpe_49k.json", "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
#: Runs beyond which tiktoken's pattern (white space) or merges (others) are left to the library, with the word after them.
_LONG_RUN = re.compile(r"(?<![^\S\x1c-\x1f])([^\S\x1c-\x1f]{5000,}\S*|[^\S\x1c-\x1f]\S{50000,})")

#: Fixed values of the word vocabulary: how it splits a lower-cased text, and the mark of a run's end.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
END_OF_WORD = "</w>"

_PIECES = regex.compile(WORD_PATTERN)
#: Latin letters, ASCII signs and general punctuation: lower-casing and splitting are the same everywhere.
_UNUSUAL = re.compile("[^\t-\r -~\xa1-ɏ‐-‧]|<\\|")
_STOP = re.compile(r"[.,](?<=[^\W\d_].)(?=\s)")  # a stop right after a letter and before white space


def vocabulary(name: str) -> str:
    """Where an installed public vocabulary file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the work
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class WordEncoder:
    """Ids of a text under the word vocabulary."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        byte_of, ranks = _byte_of(), {b"\xff": 1 << 30}
        for token, i in model["vocab"].items():
            if all(ch in byte_of for ch in token):
                ended = token.endswith(END_OF_WORD)
                ranks[bytes(byte_of[ch] for ch in token.removesuffix(END_OF_WORD)) + b"\xff" * ended] = i
        #: The end of a run is a byte that UTF-8 never has; joining it comes first, as its ids are the lowest.
        self._core = tiktoken.Encoding("runs", pat_str=r"[^ ]+", mergeable_ranks=ranks, special_tokens={})._core_bpe
        self._library = library(path)
        self._known: dict[str, bytes] = {}
        self._other: dict[bytes, bytes] = {}

    def ids(self, text: bytes) -> bytes:
        """Little-endian 32-bit ids of a UTF-8 text."""
        plain = text.decode()
        if _UNUSUAL.search(plain):
            return b"".join(map(self._by_library, text.split()))
        parts, known = _STOP.sub(r" \g<0>", plain.lower()).split(), self._known
        try:
            return b"".join(map(known.__getitem__, parts))
        except KeyError:
            if len(known) > KEEP:
                known.clear()
            merge = self._core.encode_single_piece
            for p in set(parts).difference(known):
                if p.isalpha():
                    ids = merge(p.encode() + b"\xff")
                else:
                    ids = [i for x in _PIECES.findall(p) for i in merge(x.encode() + b"\xff")]
                known[p] = array("I", ids).tobytes()
            return b"".join(map(known.__getitem__, parts))

    def _by_library(self, run: bytes) -> bytes:
        found = self._other.get(run)
        if found is None:
            if len(self._other) > KEEP // 8:
                self._other.clear()
            found = self._other[run] = np.array(self._library.encode(run.decode(), add_special_tokens=False).ids, "<u4").tobytes()
        return found


class ByteEncoder:
    """Tokens of a text under the byte vocabulary; together they cover every byte."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(i) for token, i in map(bytes.split, f)}
        self._encoding = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._library = None  # read when a text needs it
        self._bytes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self._bytes[i] = len(token)

    def ids(self, text: str) -> np.ndarray:
        """Tokens of the text.

        No token goes on from a sign to white space, so a long run of white
        space, or a long word, can be cut out in front of its white space and
        encoded by the library, which stays with any length.
        """
        encode = self._encoding.encode_ordinary
        parts = _LONG_RUN.split(text) if len(text) > 5000 else [text]
        ids = [encode(part) if i % 2 == 0 else self._by_library(part) for i, part in enumerate(parts)]
        return np.array(ids[0] if len(ids) == 1 else [i for some in ids for i in some], np.int64)

    def _by_library(self, text: str) -> list[int]:
        if self._library is None:
            self._library = library(vocabulary(BYTE_BPE))
            self._library.encode_special_tokens = True
        return self._library.encode(text, add_special_tokens=False).ids

    def ends(self, text: str) -> np.ndarray:
        """Where each token ends, in bytes of the UTF-8 text."""
        return np.cumsum(self._bytes[self.ids(text)])


@lru_cache(maxsize=2)
def encoder(kind: type, path: str):
    """One encoder for each worker process and file."""
    return kind(path)
