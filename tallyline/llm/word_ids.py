"""Ids of whole texts from a word-level tokenizer file, encoding each distinct word of a task once.

The tokenizer drops white space and never joins what white space parts, so the ids of a text are
those of its words one after the other. Distinct words go to the library in long strings: a
pre-token ends with exactly one id that has the word-end suffix, which tells where a word's ids end.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

from tallyline.llm.text_arrays import LOWER, equal_ranges, range_hashes, word_bounds

# Words of these characters split into pre-tokens in a way that is safe to count here.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
# The split pattern of the tokenizer file, for plain words in lower case.
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zà-öø-ÿß]+|[0-9]|[^\sa-zà-öø-ÿ0-9]+")
_JOIN = 2000


class WordEncoder:
    """Ids of words, kept between batches in sorted arrays of at most `most` words.

    Words are found by hash, and what is found is compared byte by byte.
    """

    def __init__(self, path: str, most: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        suffix = model.get("end_of_word_suffix") or ""
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.last = np.zeros(self.size, bool)
        if suffix:
            self.last[[i for word, i in model["vocab"].items() if word.endswith(suffix)]] = True
        self.joins = bool(suffix)
        self.most = most
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.first = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)
        self.place = np.zeros(0, np.int64)
        self.size_of = np.zeros(0, np.int64)
        self.bytes = np.zeros(0, np.uint8)

    def _encode(self, words: list[str]) -> list[list[int]]:
        out: list = [None] * len(words)
        plain, pieces, rest = [], [], []
        for i, word in enumerate(words):
            if self.joins and _PLAIN.fullmatch(word):
                plain.append(i)
                pieces.append(len(_PIECES.findall(word.lower())))
            else:
                rest.append(i)
        runs = range(0, len(plain), _JOIN)
        texts = [" ".join([words[i] for i in plain[k : k + _JOIN]]) for k in runs]
        for k, found in zip(runs, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = np.array(found.ids, np.int64)
            ends = np.flatnonzero(self.last[ids]) + 1
            upto = np.cumsum(pieces[k : k + _JOIN])
            if len(ends) != upto[-1]:
                rest += plain[k : k + _JOIN]
                continue
            cuts = ends[upto - 1].tolist()
            ids = ids.tolist()
            for i, a, b in zip(plain[k : k + _JOIN], [0, *cuts[:-1]], cuts, strict=True):
                out[i] = ids[a:b]
        found = self.tokenizer.encode_batch_fast([words[i] for i in rest], add_special_tokens=False)
        for i, x in zip(rest, found, strict=True):
            out[i] = x.ids
        return out

    def _learn(self, keys: np.ndarray, words: list[bytes]) -> None:
        found = self._encode([w.decode("utf-8") for w in words])
        count = np.array([len(x) for x in found], np.int64)
        fresh = np.array([i for x in found for i in x], np.uint32)
        first = len(self.ids) + np.cumsum(count) - count
        place = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, place, keys)
        self.first = np.insert(self.first, place, first)
        self.count = np.insert(self.count, place, count)
        self.ids = np.concatenate([self.ids, fresh])
        size = np.array([len(w) for w in words], np.int64)
        self.place = np.insert(self.place, place, len(self.bytes) + np.cumsum(size) - size)
        self.size_of = np.insert(self.size_of, place, size)
        self.bytes = np.concatenate([self.bytes, np.frombuffer(b"".join(words), np.uint8)])

    def _each(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words in turn and how many each has, without what is kept."""
        raw = data.tobytes()
        found = self._encode([raw[a:b].decode("utf-8") for a, b in zip(start.tolist(), end.tolist(), strict=True)])
        return np.array([i for x in found for i in x], np.uint32), np.array([len(x) for x in found], np.int64)

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in turn, and the ids each text begins at (one entry more)."""
        start, end, firsts = word_bounds(data, bounds)
        lowered = LOWER[data]  # the tokenizer lower-cases, so words that differ in case are one
        keys, example, which = np.unique(range_hashes(lowered, start, end), return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > self.most:
            self._clear()
        place = np.searchsorted(self.keys, keys)
        known = place < len(self.keys)
        known[known] = self.keys[place[known]] == keys[known]
        missing = np.flatnonzero(~known)
        if len(missing):
            raw = lowered.tobytes()
            a, b = start[example[missing]].tolist(), end[example[missing]].tolist()
            self._learn(keys[missing], [raw[x:y] for x, y in zip(a, b, strict=True)])
            place = np.searchsorted(self.keys, keys)
        at = place[which]
        if not equal_ranges(lowered, start, end, self.bytes, self.place[at], self.size_of[at]).all():
            # Two words share a hash.
            ids, count = self._each(lowered, start, end)
            return ids, np.concatenate([[0], np.cumsum(count)])[firsts]
        count = self.count[at]
        upto = np.zeros(len(count) + 1, np.int64)
        np.cumsum(count, out=upto[1:])
        source = np.repeat(self.first[at] - upto[:-1], count) + np.arange(upto[-1])
        return self.ids[source], upto[firsts]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The encoder of this Python worker, which keeps its words from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
