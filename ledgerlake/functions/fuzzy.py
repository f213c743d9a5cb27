"""Fuzzy comparison of short texts, for use inside grouped pandas functions."""

from __future__ import annotations

import re
import unicodedata
from difflib import SequenceMatcher
from functools import lru_cache

import numpy as np

#: Roman numerals that may number a label.
ROMAN = frozenset("i ii iii iv v vi vii viii ix x xi xii xiii xiv xv xvi xvii xviii xix xx".split())


def plain(text: str | None) -> str:
    """Lower case, decomposed, without marks."""
    return "".join(c for c in unicodedata.normalize("NFKD", text or "") if not unicodedata.combining(c)).lower()


def words_of(text: str | None) -> str:
    """Plain letters and digits, single blanks."""
    return " ".join(re.sub(r"[^a-z0-9\s]", " ", plain(text)).split())


@lru_cache(maxsize=200_000)
def label_key(text: str | None) -> str:
    """A label for matching: short references in brackets dropped, longer ones kept, initials glued, leading numbering removed."""
    flat = plain(text)
    for inside in (r"\(([^)]*)\)", r"\[([^\]]*)\]"):
        flat = re.sub(inside, lambda m: " " if len(re.sub(r"[^a-z0-9]", "", m.group(1))) <= 2 else f" {m.group(1)} ", flat)
    flat = " ".join(re.sub(r"[^a-z0-9\s]", " ", flat).split())
    flat = re.sub(r"(?<!\S)[a-z](?: [a-z])+(?!\S)", lambda m: m.group().replace(" ", ""), flat)
    parts = flat.split()
    first = next((i for i, w in enumerate(parts) if not (w in ROMAN or w.isdigit())), len(parts))
    return " ".join(parts[first:])


@lru_cache(maxsize=300_000)
def ratio(a: str, b: str) -> float:
    return SequenceMatcher(None, a, b).ratio()


@lru_cache(maxsize=500_000)
def similarity(a: str, b: str) -> float:
    """Ratio of matching blocks, at least 0.9 where one text contains the other; not symmetric, as its definition is not."""
    if not a or not b:
        return 0.0
    plain_ratio = ratio(a, b)
    return max(plain_ratio, 0.9) if a in b or b in a else plain_ratio


class LetterIndex:
    """Keys by the letters they hold, to find the most similar of many. Letters in common bound the similarity and are
    counted for all keys at once; only keys whose bound reaches the best score so far are compared, and none else can win."""

    #: Largest loss of a score by rounding to three places, and a little for the bound's own arithmetic.
    ROUNDING = 0.00051

    def __init__(self, keys: list[str], names: list[str]):
        self.keys, self.names = keys, names
        self.columns: dict[tuple[str, int], int] = {}
        for key in keys:
            for c in _numbered(key):
                self.columns.setdefault(c, len(self.columns))
        self.letters, self.length = self._matrix(keys).T.copy(), np.array([len(k) for k in keys], np.float32)

    def _matrix(self, keys: list[str]) -> np.ndarray:
        out = np.zeros((len(keys), len(self.columns)), np.float32)
        for i, key in enumerate(keys):
            out[i, [self.columns[c] for c in _numbered(key) if c in self.columns]] = 1
        return out

    def bounds(self, asked: list[str], at_once: int = 32):
        """(key, bound of its similarity to each key of the index)."""
        for start in range(0, len(asked), at_once):
            part = asked[start : start + at_once]
            size = np.array([len(a) for a in part], np.float32)[:, None]
            common = self._matrix(part) @ self.letters
            bound = 2 * common / (size + self.length)
            yield from zip(part, np.where(common >= np.minimum(size, self.length), np.maximum(bound, 0.9), bound))

    def first(self, asked: list[str]) -> list[float]:
        """Score of the key of the highest bound, which the best score is not below."""
        return [round(similarity(a, self.keys[int(bound.argmax())]), 3) for a, bound in self.bounds(asked)]

    def best(self, asked: list[str], least: list[float]) -> list[tuple[str, str, float]]:
        """(key asked, name, score) of the best key that reaches ``least``; of equal scores the first name."""
        out = []
        for (a, bound), floor in zip(self.bounds(asked), least):
            found: tuple[float, str] | None = None
            near = np.flatnonzero(bound >= floor - self.ROUNDING)
            for k in near[np.argsort(-bound[near], kind="stable")]:
                if bound[k] < floor - self.ROUNDING:
                    break
                score = round(similarity(a, self.keys[k]), 3)
                if score >= floor and (found is None or (-score, self.names[k]) < found):
                    found, floor = (-score, self.names[k]), score
            if found:
                out.append((a, found[1], -found[0]))
        return out


def _numbered(key: str) -> list[tuple[str, int]]:
    """Letters with how often each came before."""
    seen: dict[str, int] = {}
    out = []
    for c in key:
        out.append((c, seen.get(c, 0)))
        seen[c] = seen.get(c, 0) + 1
    return out


class WordRuns:
    """Runs of words of one text; a bound on the ratio from letter counts spares most comparisons and loses none."""

    def __init__(self, text: str):
        self.text, self.words = text, text.split()
        counts = np.zeros((len(self.words) + 1, 128), np.int32)
        for i, w in enumerate(self.words):
            np.add.at(counts[i + 1], np.frombuffer(w.encode("ascii", "replace"), np.uint8) & 127, 1)
        self.counts = counts.cumsum(axis=0)

    def holds(self, phrase: str, least: float = 0.84) -> bool:
        """Whether some run of as many words as the phrase has is near it."""
        if not self.text or not phrase:
            return False
        if phrase in self.text:
            return True
        size = len(phrase.split())
        if size > len(self.words):
            return False
        runs = self.counts[size:] - self.counts[:-size]
        mine = np.bincount(np.frombuffer(phrase.encode("ascii", "replace"), np.uint8) & 127, minlength=128)
        spaces = size - 1
        bound = 2.0 * (np.minimum(runs, np.r_[mine[:32], 0, mine[33:]]).sum(axis=1) + spaces) / (len(phrase) + runs.sum(axis=1) + spaces)
        return any(ratio(phrase, " ".join(self.words[i : i + size])) >= least for i in np.flatnonzero(bound >= least))


def holds_words(text: str, phrase: str, least: float = 0.84) -> bool:
    return WordRuns(text).holds(phrase, least)


def holds_letters(text: str, phrase: str, least: float = 0.78) -> bool:
    """Whether some window of the phrase's length, a quarter of it apart, is near it.

    Letter counts bound the ratio: all windows are counted at once, and only those that can reach ``least`` are compared.
    """
    size = len(phrase)
    if not size or phrase in text or len(text) < size:
        return not size or phrase in text or ratio(phrase, text) >= least
    letters = np.array([text.count(c) and 1 for c in phrase], bool)
    if letters.mean() < least:
        return False
    codes = {c: i for i, c in enumerate(dict.fromkeys(phrase))}
    seen = np.zeros((len(text) + 1, len(codes)), np.int32)
    for i, c in enumerate(text):
        if c in codes:
            seen[i + 1, codes[c]] = 1
    seen = seen.cumsum(axis=0)
    starts = np.arange(0, len(text) - size + 1, max(size // 4, 1))
    mine = np.array([phrase.count(c) for c in codes])
    most = np.minimum(seen[starts + size] - seen[starts], mine).sum(axis=1) / size
    return any(ratio(phrase, text[i : i + size]) >= least for i in starts[most >= least])


class WordTable:
    """Runs of neighbouring entries as rows of a table of words, to score one label against all of them at once.

    The score of two word lists is the mean of the common words' share of the shorter list and of the ratio of their
    sorted words, or that ratio alone where no word is common, times the mean of one and the ratio of their lengths.
    """

    def __init__(self, entries: list[list[str]], longest: int):
        self.places = [(i, n) for i in range(len(entries)) for n in range(1, longest + 1) if i + n <= len(entries)]
        self.runs = [[w for e in entries[i : i + n] for w in e] for i, n in self.places]
        self.column = {w: k for k, w in enumerate(dict.fromkeys(w for r in self.runs for w in r))}
        self.holds = np.zeros((len(self.runs), len(self.column)), np.float32)
        for k, r in enumerate(self.runs):
            self.holds[k, [self.column[w] for w in r]] = 1
        self.distinct = np.maximum(self.holds.sum(axis=1), 1)
        self.length = np.array([max(len(r), 1) for r in self.runs])
        self.sorted = [" ".join(sorted(set(r))) for r in self.runs]

    def scores(self, words: list[str], least: float) -> list[tuple[float, int, int]]:
        """(score, first entry, entries) of the runs that reach ``least``; a bound spares most comparisons."""
        if not words or not self.runs:
            return []
        asked = np.zeros(len(self.column), np.float32)
        asked[[self.column[w] for w in set(words) if w in self.column]] = 1
        share = (self.holds @ asked) / np.minimum(self.distinct, len(set(words)))
        scale = 0.5 + 0.5 * np.minimum(self.length, len(words)) / np.maximum(self.length, len(words))
        mine, out = " ".join(sorted(set(words))), []
        for k in np.flatnonzero(np.where(share > 0, (share + 1) / 2, 1.0) * scale >= least):
            near = ratio(mine, self.sorted[k])
            score = float(((share[k] + near) / 2 if share[k] else near) * scale[k])
            if score >= least:
                out.append((score, *self.places[k]))
        return out


def group_thousands(text: str | None) -> str | None:
    """Longest run of digits of a text, its thousands glued, without leading zeros, grouped by three; decimals kept."""
    found = re.findall(r"\d{1,3}(?:[ \u00a0.]\d{3})+(?:,\d+)?|\d+(?:,\d+)?", text or "")
    if not found:
        return None
    whole, _, part = max((re.sub(r"[ \u00a0.]", "", f) for f in found), key=lambda f: len(f.split(",")[0])).partition(",")
    grouped = f"{int(whole):,}".replace(",", " ")
    return f"{grouped},{part}" if part else grouped


def clean_tokens(text: str | None, stop: frozenset[str] = frozenset(), longest: int = 25) -> str:
    """Words of a field without noise: too long, five times the same letter, lower-case bleed, stop words."""
    kept = [w for w in (text or "").split() if len(w) <= longest and not re.search(r"(.)\1{4,}", w) and not w.islower() and w.lower() not in stop]
    return " ".join(kept)
