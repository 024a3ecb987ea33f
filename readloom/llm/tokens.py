"""Token ids of the public byte-pair vocabularies, as the tokenizers library gives them.

That library makes some 1.5 MB of text a second; tiktoken's merge loop makes
several times that from the same ranks, so it does the work wherever both must
agree. Texts on which their ideas of white space, letter case or normal form
could differ go to the tokenizers library itself; what is said of a text there is
about its characters, never its size. Ids are little-endian unsigned 32-bit
integers in bytes. Strings of special tokens in a text are ordinary text
(encode_special_tokens), as the vocabularies' own description sets it.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

# Space that regular expression libraries class differently.
_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0 ᠎ -​    　﻿]")
_MARK = "\x00"  # stands for the vocabulary's word end; a text that has it goes to the library


_kinds: list[np.ndarray] = []
_open: list[np.ndarray] = []


def _has_unassigned(text: str) -> bool:
    """Whether a character has no meaning in this Python's Unicode tables; the library's may be newer and know it.

    A look-up in a table of all code points; as a regular expression's set of some 700 ranges it took several times the encoding.
    """
    if not _open:
        import sys
        import unicodedata

        _open.append(np.array([unicodedata.category(chr(c)) == "Cn" for c in range(sys.maxunicode + 1)]))
    return bool(_open[0][np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")].any())


def _mark_words(text: str) -> str:
    """Put the mark behind each run of letters, each digit and each run of other characters but space."""
    if not _kinds:
        import sys
        import unicodedata

        kind = (("L", 1), ("N", 2), ("Z", 0))
        table = np.full(sys.maxunicode + 1, 3, dtype=np.uint8)
        for c in range(sys.maxunicode + 1):
            category = unicodedata.category(chr(c))[0]
            for k, v in kind:
                if category == k:
                    table[c] = v
        table[[9, 10, 11, 12, 13, 32]] = 0
        _kinds.append(table)
    points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
    kind = _kinds[0][points]
    end = kind == 2
    end[:-1] |= kind[:-1] != kind[1:]
    end[-1:] = True
    end &= kind != 0
    moved = np.cumsum(end)
    out = np.zeros(len(points) + (moved[-1] if len(points) else 0), dtype="<u4")
    out[np.arange(len(points)) + moved - end] = points
    return out.tobytes().decode("utf-32-le")


def _bytes_of_characters() -> dict[str, int]:
    """The public byte-level alphabet: printable bytes stand for themselves, the others follow from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class Encoder:
    """Encodes with one tokenizer file of a byte-level BPE, with or without word ends."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self._model = Tokenizer.from_file(path)
        self._model.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        end = spec["model"].get("end_of_word_suffix") or ""
        special = {t["content"] for t in spec["added_tokens"]}
        letters = _bytes_of_characters()
        ranks = {}
        for token, rank in spec["model"]["vocab"].items():
            if token not in special:
                body = token[: -len(end)] if end and token.endswith(end) else token
                ranks[bytes(letters[c] for c in body) + (_MARK.encode() if body != token else b"")] = rank
        self._word_ends = bool(end)
        # Contractions are left to the library. Without the look-ahead the pattern is several times faster, and the same where no two spaces meet.
        self._unsure = re.compile(f"[{_MARK}']|{_ODD_SPACE.pattern}") if end else re.compile(rf"\s\s|{_ODD_SPACE.pattern}")
        pattern = rf"[^\s{_MARK}]+{_MARK}" if end else public_tokenizers.PATTERN.replace(r"|\s+(?!\S)", "")
        self._fast = tiktoken.Encoding(os.path.basename(path), pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def _plain(self, text: str) -> bool:
        """Whether both libraries are sure to read the text alike."""
        if text.isascii():
            return not self._unsure.search(text)
        if self._unsure.search(text):
            return False
        import unicodedata

        if self._word_ends and _has_unassigned(text):
            return False
        return not self._word_ends or (unicodedata.is_normalized("NFC", text) and "Σ" not in text)

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """The packed ids of each text; a null text counts as empty."""
        texts = [t if isinstance(t, str) else "" for t in texts]
        plain = [self._plain(t) for t in texts]
        fast = [t for t, p in zip(texts, plain) if p]
        if self._word_ends:
            fast = [_mark_words(t.lower()) for t in fast]
        done = iter([np.array(self._fast.encode_ordinary(t), dtype="<u4").tobytes() for t in fast])
        return [next(done) if p else np.array(self._model.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t, p in zip(texts, plain)]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This process's encoder of a file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
