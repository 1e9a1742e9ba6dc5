"""Token ids of whole text columns, with the ids of each distinct word looked up once."""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

# fixed values: the normaliser and splitter of the word vocabularies for which words can be looked up alone
NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# Letters, digits and signs below U+0250 are single, composed characters and no white space; without an
# apostrophe the splitter sees only runs of letters, single digits and runs of signs.
PLAIN = re.compile("[!-&(-~¡-įı-ɏ]+")
ASCII_RUNS = re.compile("[a-z]+|[0-9]|[^a-z0-9]+")
OTHER_RUNS = regex.compile(r"\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
# Words a worker remembers, so that its memory stays bounded; later ones are encoded each time they turn up.
REMEMBERED = 400_000
SLICE_BYTES = 2 << 20

_encoders: dict[str, Encoder] = {}


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself if it prints, else the next free one from U+0100."""
    printing = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printing]
    return {b: chr(b) for b in printing} | {b: chr(0x100 + i) for i, b in enumerate(others)}


class Encoder:
    """Encodes string arrays; keeps the ids of words between batches."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        splitters = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        self.by_word = ((spec.get("normalizer") or {}).get("normalizers") == NORMALIZER and len(splitters) == 2
                        and splitters[0].get("pattern") == {"Regex": SPLIT} and splitters[1]["type"] == "ByteLevel"
                        and not splitters[1]["add_prefix_space"] and spec.get("post_processor") is None)
        self.letters = _byte_letters()
        self.words: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        found = self.words.get(word)
        if found is None:
            spelled = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
            found = np.array([t.id for t in self.model.tokenize(spelled)], "<u4").tobytes()
            if len(self.words) < REMEMBERED:
                self.words[word] = found
        return found

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a text without white space."""
        found = self.words.get(chunk)
        if found is not None:
            return found
        if not PLAIN.fullmatch(chunk) or "<|" in chunk:
            return self._whole(chunk)
        lower = chunk.lower()
        runs = ASCII_RUNS.findall(lower) if lower.isascii() else OTHER_RUNS.findall(lower)
        return self._word(runs[0]) if len(runs) == 1 else b"".join([self._word(r) for r in runs])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and how many each text has."""
        if self.by_word:
            split = pc.ascii_split_whitespace(texts)
            coded = split.flatten().dictionary_encode()
            found = [self._chunk(c) if c else b"" for c in coded.dictionary.to_pylist()]
            indices, per_text = coded.indices.to_numpy(), pc.list_value_length(split).to_numpy()
        else:
            found = [self._whole(t) for t in texts.to_pylist()]
            indices, per_text = np.arange(len(found)), np.ones(len(found), np.int64)
        sizes = np.fromiter((len(f) for f in found), np.int64, len(found)) >> 2
        firsts = np.cumsum(sizes) - sizes
        lengths = sizes[indices]
        ends = np.cumsum(lengths)
        spots = np.repeat(firsts[indices] - (ends - lengths), lengths) + np.arange(lengths.sum())
        ids = np.frombuffer(b"".join(found), "<u4")[spots]
        word_ends = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(per_text)])]
        return ids, np.diff(word_ends)


def encoder(path: str) -> Encoder:
    """The worker's own encoder for this vocabulary."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def slices(texts: pa.Array, size: int = SLICE_BYTES):
    """(first row, texts) in runs of at most ``size`` bytes; a longer text is a run of its own."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    ends = np.cumsum(pc.binary_length(texts).to_numpy())
    first = 0
    while first < len(texts):
        limit = (ends[first - 1] if first else 0) + size
        last = max(first + 1, int(np.searchsorted(ends, limit, side="right")))
        yield first, texts.slice(first, last - first)
        first = last
