"""A lexicon as a trie of bytes, intersected with the Levenshtein automata of many words at once.

The trie is walked once for a whole batch of words. Along a branch, every word that is still
within reach carries the states of its automaton as a band of edit distances; words out of
reach leave the branch, so that most of them are gone after the first letters.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

FAR = 100


class Term(NamedTuple):
    text: str
    stem: bool  # also matches longer words that start with it
    weight: float
    edits: int | None = None  # edits that still count as the term; None: what ``reach`` says


def reach(term: bytes) -> int:
    """Edits that still count as the term: none below four bytes, then one, two from eleven on."""
    return 0 if len(term) < 4 else 1 if len(term) < 11 else 2


class Lexicon:
    """Terms, and the walk that finds them in words; with ``swaps``, two neighbours changing places are one edit."""

    def __init__(self, terms: list[Term], swaps: bool = False):
        self.terms, self.swaps = terms, swaps
        self.limits = [reach(t.text.encode()) if t.edits is None else t.edits for t in terms]
        self.width = max((len(t.text.encode()) for t in terms), default=0) + 2
        self.root: dict = {}
        for i, term in enumerate(terms):
            node, letters = self.root, term.text.encode()
            for letter in letters:
                node["reach"] = max(node.get("reach", 0), self.limits[i])
                node = node.setdefault(letter, {})
            node["reach"] = max(node.get("reach", 0), self.limits[i])
            node.setdefault("terms", []).append(i)

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(term, edits) of each word data[start:end]; term -1 without one. Fewest edits win, then the later term."""
        term, edits = np.full(len(starts), -1), np.full(len(starts), FAR)
        if not self.terms or not len(starts):
            return term, edits
        sizes = ends - starts
        padded = np.concatenate((data, np.zeros(self.width, np.uint8)))
        letters = padded[starts[:, None] + np.arange(self.width)]
        letters[np.arange(self.width) >= sizes[:, None]] = 0
        most = self.root["reach"]
        band = np.full((len(starts), 2 * most + 1), FAR, np.int8)
        band[:, most:] = np.where(np.arange(most + 1) <= sizes[:, None], np.arange(most + 1), FAR)
        self._walk(self.root, 0, most, np.arange(len(starts)), band, None, -1, letters, sizes, term, edits)
        return term, edits

    def _walk(self, node, depth, most, alive, band, above, last, letters, sizes, term, edits) -> None:
        """``band[:, b]`` is the distance of ``depth`` letters of the branch to the word's first depth + b - most.

        ``above`` is the band one letter up the branch, ``last`` the letter that led here.
        """
        for i in node.get("terms", ()):
            if self.terms[i].stem:
                cost = band.min(axis=1)
            else:
                at = sizes[alive] - depth + most
                ok = (at >= 0) & (at <= 2 * most)
                cost = np.where(ok, band[np.arange(len(alive)), np.clip(at, 0, 2 * most)], FAR)
            hit = (cost <= self.limits[i]) & (cost <= edits[alive])
            term[alive[hit]], edits[alive[hit]] = i, cost[hit]
        for letter, child in node.items():
            if isinstance(letter, str):
                continue
            new = np.full_like(band, FAR)
            for b in range(2 * most + 1):
                upto = depth + 1 + b - most  # letters of the word
                if upto < 0 or upto > self.width:
                    continue
                cost = np.full(len(alive), FAR, np.int8)
                if upto:
                    cost = band[:, b] + (letters[alive, upto - 1] != letter)
                if b < 2 * most:
                    cost = np.minimum(cost, band[:, b + 1] + 1)
                if b:
                    cost = np.minimum(cost, new[:, b - 1] + 1)
                if self.swaps and above is not None and upto > 1:
                    swapped = (letters[alive, upto - 1] == last) & (letters[alive, upto - 2] == letter)
                    cost = np.where(swapped, np.minimum(cost, above[:, b] + 1), cost)
                new[:, b] = np.where(upto <= sizes[alive], np.minimum(cost, FAR), FAR)
            near = new.min(axis=1) <= child["reach"]
            if near.any():
                self._walk(child, depth + 1, most, alive[near], new[near], band[near], letter, letters, sizes, term, edits)
