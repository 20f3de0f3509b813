"""Ids of many words at once, for a tokenizer file of the word-end BPE kind.

Words of Latin letters alone are merged here, all together: in each round every word that still can merges its best pair. All other strings go through the tokenizers library,
and so does every word if the file is of another kind.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np

_ASCII, _LATIN = re.compile(rb"[A-Za-z]+"), re.compile("[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 is itself, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class WordEncoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, kinds = spec["model"], json.dumps([spec["normalizer"], spec["pre_tokenizer"]])
        self.fast = model["type"] == "BPE" and model.get("end_of_word_suffix") == "</w>" and '"ByteLevel"' in kinds and '"Lowercase"' in kinds and not model.get("dropout")
        if not self.fast:
            return
        vocabulary, letters = model["vocab"], byte_letters()
        self.inner = np.array([vocabulary[c] for c in letters], np.int64)
        self.last = np.array([vocabulary[c + "</w>"] for c in letters], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        key = np.array([vocabulary[a] << 20 | vocabulary[b] for a, b in pairs], np.int64)
        order = np.argsort(key)
        self.key, self.rank = key[order], order
        self.made = np.array([vocabulary[a + b] for a, b in pairs], np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; a number beyond all ranks if it has none."""
        key = left << 20 | right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.rank[at], len(self.key))

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of lower-case words, and how many each has."""
        size = np.array([*map(len, words)], np.int64)
        raw = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(size)
        symbol = self.inner[raw]
        symbol[ends - 1] = self.last[raw[ends - 1]]
        word, none = np.repeat(np.arange(len(words)), size), len(self.key)
        rank = np.full(len(symbol), none)
        rank[:-1] = np.where(word[1:] == word[:-1], self.ranks(symbol[:-1], symbol[1:]), none)
        done_symbol, done_word = [], []
        while len(symbol):
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            counts = np.diff(np.append(starts, len(word)))
            best = np.minimum.reduceat(rank, starts)
            over = np.repeat(best == none, counts)
            if over.any():
                done_symbol.append(symbol[over])
                done_word.append(word[over])
                symbol, word, rank, best = symbol[~over], word[~over], rank[~over], best[best < none]
                if not len(symbol):
                    break
                starts = np.flatnonzero(np.diff(word, prepend=-1))
                counts = np.diff(np.append(starts, len(word)))
            hits = np.flatnonzero(rank == np.repeat(best, counts))
            at = hits[np.flatnonzero(np.diff(word[hits], prepend=-1))]  # the leftmost of each word
            symbol[at] = self.made[rank[at]]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            at -= np.arange(len(at))  # as one symbol before it went in each earlier word
            symbol, word, rank = symbol[keep], word[keep], rank[keep]
            for left in (at, at[at > 0] - 1):
                right = np.minimum(left + 1, len(symbol) - 1)
                same = (right > left) & (word[left] == word[right])
                rank[left] = np.where(same, self.ranks(symbol[left], symbol[right]), none)
        symbol, word = np.concatenate(done_symbol), np.concatenate(done_word)
        return symbol[np.argsort(word, kind="stable")].astype(np.uint32), np.bincount(word, minlength=len(words))

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        plain, at, other = [], [], []
        for i, t in enumerate(texts):
            if self.fast and _ASCII.fullmatch(t):
                plain.append(t.lower())
                at.append(i)
            elif self.fast and _LATIN.fullmatch(s := t.decode()):
                plain.append(unicodedata.normalize("NFC", s).lower().encode())
                at.append(i)
            else:
                other.append(i)
        flat, lengths = self.merge(plain) if plain else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
        if not other:
            return flat, lengths
        found = [x.ids for x in self.library.encode_batch_fast([texts[i].decode() for i in other], add_special_tokens=False)]
        size = np.zeros(len(texts), np.int64)
        size[at], size[other] = lengths, [*map(len, found)]
        out, ends = np.empty(int(size.sum()), np.uint32), np.cumsum(size)
        mine = np.repeat(np.isin(np.arange(len(texts)), at), size)
        out[mine] = flat
        out[~mine] = np.concatenate([np.array(x, np.uint32) for x in found])
        return out, size
