"""Token ids of whole texts, by the ``tokenizers`` library.

A BPE tokenizer first splits a text into pieces and then encodes each piece
by itself, so a piece's ids can be kept and used again.  Texts in scripts
whose splitting is certain to agree are split here, many at once: at their
spaces first, and each different word of them into pieces; the library's model encodes
a new piece, known words are looked up once for all their places.  Any other
text goes to the library whole.  Both ways give the same ids.

Special tokens' strings inside a text are ordinary text.  A null text is
empty.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from codecs import charmap_decode
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Letters, marks and spaces outside these ranges may be classed otherwise by
# another library's Unicode tables, or change under normalisation.
_UNSURE = r"[^\t\n\r\x20-\x7e¡-¬®-įĲ-ž‐-‧‰-⁞₠-₿]"
#: The letters and numbers of those ranges (fixed values).
_LETTER, _NUMBER = "A-Za-zªµºÀ-ÖØ-öø-įĲ-ž", "0-9²³¹¼-¾"

#: The splits of byte-level BPE and of ``WORD_LEVEL`` (as tokenizer files state it, a fixed value) on those ranges.
SPLIT_BYTE_LEVEL = rf" ?[{_LETTER}]+|'(?:s|t|re|ve|m|ll|d)| ?[{_NUMBER}]+| ?[^\s{_LETTER}{_NUMBER}]+|\s+(?!\S)|\s+"
WORD_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPLIT_WORD_LEVEL = rf"[{_LETTER}]+|'(?:s|t|re|ve|m|ll|d)|[{_NUMBER}]|[^\s{_LETTER}{_NUMBER}]+"

#: Most of the sure characters that are neither letters, numbers nor white space.
_SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: White space that is a piece together with other white space, and a space that is one alone.
_SPACES = r"\s\s| \z"

#: Words kept by a worker process, in characters and ids 64 bytes each on average; beyond that it starts anew.
KEPT_PIECES = 1_000_000
#: As many for splits that leave spaces out.
KEPT_WORDS = 800_000
#: Code points that are encoded at once, about.
AT_ONCE = 4_000_000

_encoders: dict[str, "Encoder"] = {}


def encoder(path: str) -> "Encoder":
    """This process's encoder for the tokenizer file ``path``."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def forget_encoders() -> None:
    """Drop this process's encoders and their pieces: for tasks of a job whose texts are encoded."""
    _encoders.clear()


class Encoder:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            pattern, self.lower = _splitting(json.load(f))
        self.split = re.compile(pattern).findall if pattern else None
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.model = self.tokenizer.model.tokenize
        self.most = KEPT_WORDS if self.lower else KEPT_PIECES
        self._forget()

    def _forget(self) -> None:
        #: Numbers of words; their ids one after the other, and where each word's end.
        self.known: dict[str, int] = {}
        self.ids, self.ends, self.size = array("I"), array("q", [0]), 0

    def encode_batches(self, texts: pa.Array) -> Iterator[bytes]:
        """As ``encode``, some texts at a time."""
        sizes = np.cumsum(pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(texts):
            end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + AT_ONCE, "right")))
            yield from self.encode(texts.slice(at, end - at))
            at = end

    def encode(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        """Of each text its ids as little-endian unsigned 32-bit integers."""
        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        out = [b""] * len(texts)
        if self.split is None:
            apart, sure = np.arange(len(texts)), np.zeros(0, dtype=np.int64)
        else:
            unsure = pc.match_substring_regex(texts, _UNSURE if self.lower else f"{_UNSURE}|{_SPACES}").to_numpy(zero_copy_only=False)
            apart, sure = np.flatnonzero(unsure), np.flatnonzero(~unsure)
        for k in apart.tolist():
            out[k] = self._whole(texts[k].as_py())
        if len(sure):
            ids, bounds = self._by_words(texts.take(pa.array(sure)) if len(apart) else texts)
            for k, x, y in zip(sure.tolist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                out[k] = ids[x:y].tobytes()
        return out

    def _whole(self, text: str) -> bytes:
        if self.split is None or re.search(_UNSURE, text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return self._joined([f"\0{piece}" for piece in self.split(text)]).tobytes()

    def _by_words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The texts' ids one after the other, and where each text's begin and the last one's end."""
        if len(self.known) > self.most or self.size > 64 * self.most:
            self._forget()
        # Of the sure characters, Arrow and the pattern have the same four as white space.
        parts = pc.ascii_split_whitespace(texts) if self.lower else pc.split_pattern(texts, " ")
        offsets = parts.offsets.to_numpy()
        words = parts.flatten().dictionary_encode()
        keys, own = words.dictionary.to_numpy(zero_copy_only=False).tolist(), words.indices.to_numpy().astype(np.int64)
        if self.lower:
            keys = [k.lower() for k in keys]
        else:
            # A text's first word has no space before it.
            firsts = offsets[:-1] - offsets[0]
            keys += [f"\0{keys[k]}" for k in own[firsts].tolist()]
            own[firsts] = np.arange(len(keys) - len(firsts), len(keys))
        numbers = np.array(list(map(self._number, keys)), dtype=np.int64)[own]
        ends = np.array(self.ends)
        first, many = ends[numbers], ends[numbers + 1] - ends[numbers]
        after = np.concatenate([[0], np.cumsum(many)])
        at = np.repeat(first - after[:-1], many)
        at += np.arange(len(at))
        return np.array(self.ids, dtype="<u4")[at], after[offsets - offsets[0]]

    def _number(self, key: str) -> int:
        """The number of a word: of byte-level splits with the space before it, and without if the key begins with NUL."""
        number = self.known.get(key)
        if number is None:
            own = self._new(key)
            self.ids.extend(own)
            number = self.known[key] = len(self.ends) - 1
            self.ends.append(len(self.ids))
            self.size += len(key) + 4 * len(own)
        return number

    def _new(self, key: str) -> list[int] | array:
        text = key if self.lower else key[1:] if key[:1] == "\0" else f" {key}"
        # Of the sure characters, letters alone are a piece, and so are the signs at a word's end.
        if key.isalpha():
            pieces = [text]
        elif (inner := key.rstrip(_SIGNS)) and inner[-1].isalpha() and len(inner) < len(key):
            return self._joined([inner, key[len(inner):] if self.lower else f"\0{key[len(inner):]}"])
        else:
            pieces = self.split(text)
        if len(pieces) == 1:
            if not (text.isascii() and text.isalnum()):  # those bytes are written as themselves
                text = charmap_decode(text.encode("utf-8"), "strict", _BYTES)[0]
            return [t.id for t in self.model(text)]
        return self._joined(pieces if self.lower else [p[1:] if p[0] == " " and len(p) > 1 else f"\0{p}" for p in pieces])

    def _joined(self, keys: list[str]) -> array:
        own, ends = array("I"), self.ends
        for number in map(self._number, keys):
            own += self.ids[ends[number]:ends[number + 1]]
        return own


def _byte_characters() -> dict[int, str]:
    """The character by which byte-level BPE writes each byte: printable ones themselves, the others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {**{b: chr(b) for b in printable}, **{b: chr(0x100 + k) for k, b in enumerate(others)}}


_BYTES = "".join(_byte_characters()[b] for b in range(256))


def _splitting(described: dict) -> tuple[str | None, bool]:
    """The splitting pattern and whether texts are lower-cased first, if the file's layout is a known one."""
    before, normal = described.get("pre_tokenizer") or {}, described.get("normalizer")
    if before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and normal is None:
        return SPLIT_BYTE_LEVEL, False
    steps = before.get("pretokenizers") or []
    if (before.get("type") == "Sequence" and [s.get("type") for s in steps] == ["Split", "ByteLevel"]
            and steps[0].get("behavior") == "Removed" and steps[0].get("invert")
            and steps[0]["pattern"].get("Regex") == WORD_LEVEL
            and not steps[1].get("use_regex") and not steps[1].get("add_prefix_space")
            and [n.get("type") for n in (normal or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]):
        return SPLIT_WORD_LEVEL, True
    return None, False
