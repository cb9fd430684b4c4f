"""Byte-level BPE over the public vocabulary files: an encoder whose ids are those of the ``tokenizers`` library.

``tiktoken`` does the merging; its ranks are read from the tokenizer's own JSON file and the order of the merges is
checked against the ids, so both libraries must agree. Special tokens in a text become their ids, as there.
"""

from __future__ import annotations

import functools
import json

import numpy as np
import tiktoken

#: The white space that the pre-tokenizer's pattern knows, and the pattern.
ODD_BLANKS = "\t\x0b\x0c\r\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Without look-ahead it runs in linear time; equal where no two white-space characters follow one another.
SIMPLE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"
_RUNS = ("  ", " \n", "\n ", "\n\n")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _letters() -> dict[str, int]:
    """The letter that stands for each byte in the file: itself if printable, else the next free one from 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, free = {chr(b): b for b in own}, 256
    for b in range(256):
        if chr(b) not in out or b not in own:
            out[chr(free)] = b
            free += 1
    return out


class Encoder:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, letters = spec["model"]["vocab"], _letters()
        special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        ranks = {bytes(letters[c] for c in word): i for word, i in vocab.items() if word not in special}
        last = -1
        for merge in spec["model"]["merges"]:
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            if vocab[left + right] <= last:
                raise ValueError("the merges of this vocabulary do not follow its ids")
            last = vocab[left + right]
        self._simple = tiktoken.Encoding("simple", pat_str=SIMPLE_PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self._ranks, self._special = ranks, special
        words = {i: w for w, i in ranks.items()} | {i: w.encode() for w, i in special.items()}
        self.words = [words.get(i, b"") for i in range(max(words) + 1)]
        self.size = np.array([len(w) for w in self.words], np.int64)
        blank, ink = set(b" \t\n\x0b\x0c\r"), set(range(0x21, 0x7F))
        self.blank_first = np.array([bool(w) and w[0] in blank for w in self.words])
        self.ink_last = np.array([bool(w) and w[-1] in ink for w in self.words])

    @functools.cached_property
    def _full(self) -> tiktoken.Encoding:
        """Only workers that meet runs of white space hold this second table."""
        return tiktoken.Encoding("full", pat_str=PATTERN, mergeable_ranks=self._ranks, special_tokens=self._special)

    def encode(self, text: str) -> np.ndarray:
        runs = any(r in text for r in _RUNS) or any(c in text for c in (ODD_BLANKS[:4] if text.isascii() else ODD_BLANKS))
        return (self._full if runs else self._simple).encode_to_numpy(text, allowed_special="all")

    def decode(self, ids: np.ndarray) -> str:
        words = self.words
        return b"".join([words[i] for i in ids.tolist()]).decode("utf-8", "replace")


@functools.lru_cache(2)
def encoder(path: str) -> Encoder:
    """Once per Python worker."""
    return Encoder(path)
