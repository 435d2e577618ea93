"""Byte-pair merging over many pre-tokens at once, on ragged numpy arrays.

A vocabulary file gives the tokens and the ranked merges. Pre-tokens are held as one
flat array of symbols with an array of sequence starts. Each round finds the lowest rank
of every sequence and applies all its occurrences, left to right, in all sequences
simultaneously; sequences without a pair left leave the working arrays. Within one
sequence that is the order in which the merges of a vocabulary are defined, so the
symbols that survive are the library's tokens.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np

NONE = np.int32(2**31 - 1)


@lru_cache(maxsize=1)
def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Merges:
    """Symbols and ranked merges of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        model = given["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.added = {t["content"]: t["id"] for t in given["added_tokens"]}
        self.size = max(self.vocab.values()) + 1
        self.token = {i: t for t, i in self.vocab.items()}
        letters = byte_letters()
        self.first = np.array([self.vocab[c] for c in letters], np.int32)
        self.last = np.array([self.vocab[c + self.suffix] for c in letters], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([self.vocab[a] for a, _ in pairs], np.int64)
        right = np.array([self.vocab[b] for _, b in pairs], np.int64)
        keys = left * self.size + right
        keys, where = np.unique(keys[::-1], return_index=True)  # a repeated pair keeps its last rank
        ranks = (len(pairs) - 1 - where).astype(np.int32)
        self.made = np.array([self.vocab[a + b] for a, b in pairs], np.int32)
        # a hash table of the pairs: linear probing, four times as many slots
        self._bits = int(len(keys) * 4).bit_length()
        self._keys = np.full(1 << self._bits, -1, np.int64)
        self._ranks = np.full(1 << self._bits, NONE, np.int32)
        at, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = self._keys[at[todo]] < 0
            self._keys[at[todo[free]]] = keys[todo[free]]
            won = self._keys[at[todo]] == keys[todo]
            self._ranks[at[todo[won]]] = ranks[todo[won]]
            todo = todo[~won]
            at[todo] = (at[todo] + 1) & ((1 << self._bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self._bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where the vocabulary has no such merge."""
        keys = left.astype(np.int64) * self.size + right
        at = self._slot(keys)
        found = self._keys[at]
        out = self._ranks[at]
        missed = np.flatnonzero(found != keys)
        out[missed] = NONE
        missed = missed[found[missed] >= 0]
        while len(missed):
            at[missed] = (at[missed] + 1) & ((1 << self._bits) - 1)
            found = self._keys[at[missed]]
            hit = found == keys[missed]
            out[missed[hit]] = self._ranks[at[missed[hit]]]
            missed = missed[~hit & (found >= 0)]
        return out

    def symbols(self, pieces: list[bytes], ends: np.ndarray | None = None):
        """Byte symbols of the pieces, and their starts (n + 1). `ends`: which pieces
        end a word and so close with the symbol for that."""
        starts = np.zeros(len(pieces) + 1, np.int64)
        np.cumsum([len(p) for p in pieces], out=starts[1:])
        data = np.frombuffer(b"".join(pieces), np.uint8)
        out = self.first[data]
        if self.suffix:
            closing = starts[1:] - 1 if ends is None else starts[1:][ends] - 1
            out[closing] = self.last[data[closing]]
        return out, starts

    def merge(self, symbols: np.ndarray, starts: np.ndarray):
        """Tokens of every sequence: flat ids and starts (n + 1). No sequence is empty."""
        count = len(starts) - 1
        sizes = np.zeros(count, np.int64)
        done_ids: list[np.ndarray] = []
        done_seqs: list[np.ndarray] = []
        seq = np.arange(count)
        first = starts[:-1]
        ranks = np.full(len(symbols), NONE, np.int32)
        if len(symbols) > 1:
            ranks[:-1] = self.ranks(symbols[:-1], symbols[1:])
        ranks[starts[1:] - 1] = NONE
        while len(seq):
            least = np.minimum.reduceat(ranks, first)
            lengths = np.diff(np.append(first, len(symbols)))
            over = least == NONE
            if over.any():
                gone = np.repeat(over, lengths)
                done_ids.append(symbols[gone])
                done_seqs.append(seq[over])
                sizes[seq[over]] = lengths[over]
                symbols, ranks = symbols[~gone], ranks[~gone]
                seq, lengths, least = seq[~over], lengths[~over], least[~over]
                first = np.cumsum(lengths) - lengths
                if not len(seq):
                    break
            hit = np.flatnonzero(ranks == np.repeat(least, lengths))
            # of neighbours that overlap (one symbol repeated) every second one counts
            fresh = np.ones(len(hit), bool)
            fresh[1:] = hit[1:] != hit[:-1] + 1
            if not fresh.all():
                run = np.flatnonzero(fresh)
                within = np.arange(len(hit)) - np.repeat(run, np.diff(np.append(run, len(hit))))
                hit = hit[within % 2 == 0]
            symbols[hit] = self.made[ranks[hit]]
            keep = np.ones(len(symbols), bool)
            keep[hit + 1] = False
            ranks[hit] = ranks[hit + 1]  # NONE where the pair ended its sequence
            moved = np.cumsum(keep) - 1
            lost = np.add.reduceat(~keep, first)
            symbols, ranks = symbols[keep], ranks[keep]
            first = np.cumsum(lengths - lost) - (lengths - lost)
            at = moved[hit]
            ends = np.zeros(len(symbols), bool)
            ends[np.append(first[1:], len(symbols)) - 1] = True
            begins = np.zeros(len(symbols), bool)
            begins[first] = True
            touched = np.zeros(len(symbols), bool)
            touched[at] = True
            touched[at[~begins[at]] - 1] = True
            again = np.flatnonzero(touched & ~ends)
            ranks[again] = self.ranks(symbols[again], symbols[again + 1])
            ranks[ends] = NONE
        out_starts = np.zeros(count + 1, np.int64)
        np.cumsum(sizes, out=out_starts[1:])
        ids = np.zeros(int(out_starts[-1]), np.int32)
        for part, seqs in zip(done_ids, done_seqs, strict=True):
            n = sizes[seqs]
            where = np.arange(len(part)) + np.repeat(out_starts[seqs] - (np.cumsum(n) - n), n)
            ids[where] = part
        return ids, out_starts


@lru_cache(maxsize=4)
def merges(path: str) -> Merges:
    """The vocabulary of a file, read once in a worker."""
    return Merges(path)
