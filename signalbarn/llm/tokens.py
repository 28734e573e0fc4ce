"""Token ids of a tokenizers file, with every distinct word encoded once per worker.

Byte-pair encoding never merges across the pieces that the file's
pre-tokenizer cuts, so a text's ids are those of its pieces put together. Texts
made of plain Latin letters, digits and ASCII marks are cut here at white space
and before full stops and commas, where a piece always ends, and the rest by the
file's pattern; pieces not met before go to the file's own model. All other
texts, files with other pre-tokenizers, and texts that hold the string of one of
the file's added tokens are encoded whole by the library, as the file says.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np

#: Entries of each generation of a worker's cache; two generations are kept, some 200 bytes an entry.
CACHE_ENTRIES = 150_000
#: Characters whose classes and lower case are the same in Python's `re` and in the files' patterns.
_PLAIN = re.compile("[\\x00-\\x1b\\x20-\\x7fÀ-įı-ɏ]*")
_CONTROL = re.compile("[\x1c-\x1f]")
#: Places before white space, a full stop or a comma that may lie inside a piece.
_SPACED_ODD = [re.compile(r"\s\s"), re.compile(r"(?<![^\W_])[.,]")]
_LOWERED_ODD = [re.compile(r"(?<=[^\w\s])[.,]"), re.compile(r"(?<=_)[.,]")]
#: The same for ASCII texts, which these read faster.
_SPACED_ODD_ASCII = [re.compile(p.pattern, re.ASCII) for p in _SPACED_ODD]
_LOWERED_ODD_ASCII = [re.compile(p.pattern, re.ASCII) for p in _LOWERED_ODD]
#: The two public pre-tokenizer patterns (fixed values), as `re` writes them for plain texts.
_SPACED = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
_LOWERED = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
_LOWERED_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _byte_letters() -> dict[int, int]:
    """Byte-level vocabularies show bytes that do not print as characters from 256 on (a fixed rule of these files)."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: 256 + i for i, b in enumerate(hidden)}


class _Cache(dict):
    """Keeps what was used of late: a full generation becomes the old one, and the one before goes."""

    def __init__(self, make, entries: int):
        super().__init__()
        self.make, self.entries, self.old = make, entries, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) < 100:
            if len(self) >= self.entries:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


class TextEncoder:
    """Encodes texts to ids, as little-endian unsigned 32-bit integers in bytes."""

    def __init__(self, path: str, cache_entries: int = CACHE_ENTRIES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = spec.get("added_tokens", [])
        #: Added tokens are found in the text as it is; only the library knows where it looks for those it normalises.
        self.marks = [t["content"] for t in added]
        self.kind = "other" if any(t.get("normalized") for t in added) else self._kind(spec)
        self.letters = _byte_letters()
        self.space = chr(self.letters[32])
        self.model = self.tokenizer.model
        self.words = _Cache(self._encode_word, cache_entries)

    @staticmethod
    def _kind(spec: dict) -> str:
        model, pre, norm = spec["model"], spec.get("pre_tokenizer") or {}, spec.get("normalizer")
        if model.get("type") != "BPE" or model.get("dropout") or model.get("byte_fallback") or spec.get("truncation"):
            return "other"
        if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not norm:
            return "spaced"
        parts = [p.get("type") for p in pre.get("pretokenizers", [])]
        if parts == ["Split", "ByteLevel"] and norm and [n.get("type") for n in norm.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]:
            split, level = pre["pretokenizers"]
            if split["pattern"].get("Regex") == _LOWERED_PATTERN and split["behavior"] == "Removed" and split["invert"] and not level["use_regex"] and not level["add_prefix_space"]:
                return "lowered"
        return "other"

    def _encode_word(self, word: str) -> bytes:
        # letters alone, with the space before them, are one piece
        if not (word[1:] if word[0] == " " else word).isalpha():
            pieces = _SPACED.findall(word) if self.kind == "spaced" else _LOWERED.findall(word)
            if len(pieces) != 1 or pieces[0] != word:
                return b"".join(map(self.words.__getitem__, pieces))
        if word.isascii() and word.isprintable():
            shown = word.replace(" ", self.space)
        else:
            shown = word.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _cut(self, text: str) -> list[str] | None:
        """The words of a plain text, or None for a text that the library must encode whole."""
        if self.kind == "other" or any(m in text for m in self.marks):
            return None
        plain = text.isascii()
        if _CONTROL.search(text) if plain else not _PLAIN.fullmatch(text):
            return None
        if self.kind == "lowered":
            text = text.lower()
            if any(m in text for m in self.marks):  # only now spelled like an added token, which it is not
                return None
            if any(p.search(text) for p in (_LOWERED_ODD_ASCII if plain else _LOWERED_ODD)):
                return text.split()
            return text.replace(",", " ,").replace(".", " .").split()
        if text[0].isspace() or any(p.search(text) for p in (_SPACED_ODD_ASCII if plain else _SPACED_ODD)):
            return _SPACED.findall(text)
        cut = text.replace(" ", "\x1e ").replace("\n", "\x1e\n").replace(",", "\x1e,").replace(".", "\x1e.")
        return cut.removeprefix("\x1e").split("\x1e")

    def encode_many(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text; a null text has none."""
        get, out = self.words.__getitem__, []
        for text in texts:
            words = self._cut(text) if text else []
            out.append(self._whole(text) if words is None else b"".join(map(get, words)))
        return out

    def encode(self, text: str | None) -> bytes:
        return self.encode_many([text])[0]


_encoders: dict[str, TextEncoder] = {}


def encoder(path: str, cache_entries: int = CACHE_ENTRIES) -> TextEncoder:
    """One encoder per file and worker process."""
    if path not in _encoders:
        _encoders[path] = TextEncoder(path, cache_entries)
    return _encoders[path]
