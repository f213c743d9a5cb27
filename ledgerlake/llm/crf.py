"""Linear-chain conditional random field over word-shape features, in numpy.

The score of a label at a token is a sum over neighbouring tokens of weights of their features, so it is looked up
per distinct token and offset and added; only the transitions couple neighbours. Training maximises the likelihood of
the labelled rows by AdaGrad on padded batches; decoding is Viterbi on padded batches. A bound on what any label but
the first can gain tells the sentences whose best path is plain, so Viterbi runs on the others alone.
"""

from __future__ import annotations

import re
import unicodedata
from itertools import accumulate

import numpy as np
import regex

#: Tokens: plain e-mail addresses, words and numbers with inner signs, line breaks, single other characters; a cell of a
#: text is a token with the blanks before it.
_TOKEN = r"(?:[A-Za-z0-9_.+\-]+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)+|[^\W_]+(?:[.\-_+][^\W_]+)*|\n+|\S)"
CELL = re.compile(rf"[^\S\n]*{_TOKEN}")
OFFSETS = (-3, -2, -1, 0, 1, 2, 3)
BUCKETS = 1 << 15
#: Distinct tokens whose scores a worker keeps; beyond, it starts afresh, which changes no result.
TYPES_KEPT = 120_000
_UPPER, _LOWER = regex.compile(r"\p{Lu}"), regex.compile(r"\p{Ll}")
_REPEATED, _NUMBER = re.compile(r"(.)\1+"), re.compile(r"[9O.\-]+")
_BLANKS = " \t\r\f\v\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_ARABIC_DIGITS = re.compile("[٠-٩]")


def flat(text: str) -> str:
    """The text with every digit as a nine, character by character; passes of ``replace`` are faster than a table."""
    for digit in "012345678":
        text = text.replace(digit, "9")
    return _ARABIC_DIGITS.sub("9", text)


def bare(cell: str) -> str:
    """The token of a cell, without the blanks before it."""
    return cell.lstrip(_BLANKS)


def key_of(cell: str) -> str:
    """What is the same for all features of a cell: its token, and whether a blank stands before it."""
    token = bare(cell)
    return ("_" if len(token) == len(cell) else " ") + token


def places(cells: list[str]) -> tuple[list[int], list[int]]:
    """Starts and ends of the tokens: the cells lie one behind another from the start of the text."""
    ends = list(accumulate(map(len, cells)))
    return [e - len(bare(c)) for c, e in zip(cells, ends)], ends


def tokens(text: str) -> tuple[list[str], list[int], list[int]]:
    """(keys, starts, ends) of the tokens of a text."""
    cells = CELL.findall(flat(text))
    return [key_of(c) for c in cells], *places(cells)


def features(key: str) -> list[str]:
    gap, word = key[0], key[1:]
    lower = "".join(c for c in unicodedata.normalize("NFKD", word.lower()) if not unicodedata.combining(c))
    shape = _LOWER.sub("x", _UPPER.sub("X", word))
    short = _REPEATED.sub(r"\1+", shape)
    kind = "nl" if word[0] == "\n" else "mail" if "@" in word and len(word) > 1 else "num" if _NUMBER.fullmatch(word) else "alpha" if word[0].isalpha() else "other"
    out = [f"w={lower[:40]}", f"k={kind}", f"s={short[:12]}", f"g={gap}{kind}", f"c={word.isupper()}{word[0].isupper()}{kind}", f"f={shape[:24]}" if kind in ("num", "other") else f"e3={lower[-3:]}"]
    out += ["1", f"l={min(len(word), 12)}{kind}"]
    if kind == "alpha":
        out += [f"p2={lower[:2]}", f"p3={lower[:3]}", f"p4={lower[:4]}", f"e2={lower[-2:]}", f"e4={lower[-4:]}", f"i={len(word) == 1 and word.isupper()}"]
    return out


#: How many of a token's features count at each offset: all for the token itself, the first ones for its neighbours, so
#: that a sentence is not learnt by heart.
COUNTED = {0: 99, 1: 6, 2: 3, 3: 3}


def stable_hash(s: str) -> int:
    h = 2166136261
    for b in s.encode():
        h = (h ^ b) * 16777619 & 0xFFFFFFFF
    return h % BUCKETS


def stop_flags(key: str) -> int:
    """1: a full stop; 2: may begin a sentence; 4: may end one before its stop (a long lower-case word, a bracket, a sign)."""
    word = key[1:]
    return (word in (".", "!", "?") and key[0] == "_") + 2 * (key[0] == " " or word[0] == "\n") + 4 * ((len(word) >= 4 and (word.islower() or word[0] > "\u0600")) or word in ("%", ")"))


def summed(at: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """Rows added up by their place."""
    return np.stack([np.bincount(at, weights=rows[:, c], minlength=size) for c in range(rows.shape[1])], axis=1)


class Rows(dict):
    """Row numbers by cell; a new cell is scored when it is looked up."""

    def __init__(self, add):
        self.add = add

    def __missing__(self, cell: str) -> int:
        i = self[cell] = self.add(cell)
        return i


class Model:
    """Weights by offset, hashed feature and label, transitions and starts."""

    def __init__(self, labels: list[str]):
        self.labels = labels
        k = len(labels)
        self.w = np.zeros((len(OFFSETS), BUCKETS, k), np.float32)
        self.t = np.zeros((k, k), np.float32)
        self.s = np.zeros(k, np.float32)
        self.clear()
        self.forbidden()

    def clear(self) -> None:
        """An empty table of label scores by token; rows 0 and 1 are beyond a text's ends and of no token."""
        self.rows: dict[str, int] = {}
        self.cells = Rows(self.row_of)
        self.store = np.zeros((len(OFFSETS), 1024, len(self.labels)), np.float32)
        self.flags = np.zeros(1024, np.int8)

    def forbidden(self) -> None:
        """An inside label follows only its own begin or inside label."""
        self.bar = np.zeros((len(self.labels),) * 2, np.float32)
        for j, b in enumerate(self.labels):
            if b[0] == "I":
                for i, a in enumerate(self.labels):
                    if a[2:] != b[2:] or a == "O":
                        self.bar[i, j] = -1e4
        self.bar_start = np.array([-1e4 if b[0] == "I" else 0 for b in self.labels], np.float32)

    # decoding ---------------------------------------------------------------------------------------------------

    def row_of(self, cell: str) -> int:
        """Row of a new cell in the table; cells that differ in the kind of blank share one."""
        key = key_of(cell)
        if key not in self.rows:
            i = self.rows[key] = len(self.rows) + 1
            if i >= self.store.shape[1]:
                self.store = np.concatenate([self.store, np.zeros_like(self.store)], axis=1)
                self.flags = np.concatenate([self.flags, np.zeros_like(self.flags)])
            hashes = [stable_hash(f) for f in features(key)]
            for k, o in enumerate(OFFSETS):
                self.store[k, i] = self.w[k, hashes[: COUNTED[abs(o)]]].sum(axis=0)
            self.flags[i] = stop_flags(key)
        return self.rows[key]

    def decode(self, texts: list[list[str]]) -> list[np.ndarray | None]:
        """Best label numbers of each text's cells; None where all are the first label.

        All texts lie behind one another, three empty places apart, so scores, sentence ends and the bound are computed
        for all at once.
        """
        if len(self.cells) > TYPES_KEPT:
            self.clear()
        get, gap = self.cells.__getitem__, len(OFFSETS) // 2
        rows: list[int] = [0] * gap
        begins = []
        for cells in texts:
            begins.append(len(rows))
            rows.extend(map(get, cells))
            rows += [0] * gap
        at = np.array(rows, np.int32)
        n = len(at) - 2 * gap
        out: list[np.ndarray | None] = [None] * len(texts)
        if n <= 0:
            return out
        emit = np.zeros((len(at), len(self.labels)), np.float32)
        inner = emit[gap : len(at) - gap]
        for i, o in enumerate(OFFSETS):
            inner += self.store[i].take(at[gap + o : gap + o + n], axis=0)
        trans = self.t + self.bar
        into = trans.max(axis=0)
        # a path that leaves the first label once gains no more than this at its tokens and on its way back
        back = max(0.0, float((trans[1:, 0] - trans[0, 0]).max()))
        gain = (emit[:, 1:] + into[1:]).max(axis=1) - (emit[:, 0] + trans[0, 0])
        start = max(0.0, float((self.s + self.bar_start)[1:].max() - self.s[0]))
        suspect = (gain + back + start > 0) & (at > 0)
        flags = self.flags[at]
        stops = (flags[1:-1] & 1 > 0) & (flags[2:] & 2 > 0) & (flags[:-2] & 4 > 0)
        ends = np.flatnonzero(stops) + 2
        bounds = np.array([(b, b + len(c)) for b, c in zip(begins, texts)])
        cuts = np.unique(np.concatenate([ends, bounds.ravel()]))
        if not len(hits := np.flatnonzero(suspect)):
            return out
        segment = np.unique(np.searchsorted(cuts, hits, side="right"))
        parts = [(int(cuts[i]) - int(cuts[i - 1]), int(cuts[i - 1])) for i in segment]
        parts.sort()
        path = np.zeros(len(at), np.int8)
        i = 0
        while i < len(parts):
            j, longest = i, parts[i][0]
            # neighbours in length, at most about 20 000 places
            while j < len(parts) and (parts[j][0] <= longest * 1.25 + 2 and (j - i + 1) * parts[j][0] <= 20_000 or j == i):
                j += 1
            for (size, first), found in zip(parts[i:j], self.viterbi([emit[f : f + k] for k, f in parts[i:j]])):
                path[first : first + size] = found
            i = j
        for k, (a, b) in enumerate(bounds):
            if path[a:b].any():
                out[k] = path[a:b]
        return out

    def viterbi(self, emits: list[np.ndarray]) -> list[np.ndarray]:
        size = np.array([len(e) for e in emits])
        b, t, k = len(emits), int(size.max()), len(self.labels)
        e = np.zeros((t, b, k), np.float32)
        for i, x in enumerate(emits):
            e[: len(x), i] = x
        trans = np.ascontiguousarray((self.t + self.bar).T)
        back = np.zeros((t, b, k), np.int8)
        score = self.s + self.bar_start + e[0]
        final = score.copy()
        at = np.arange(b * k) * k
        for i in range(1, t):
            paths = score[:, None, :] + trans
            back[i] = paths.argmax(axis=2)
            score = paths.ravel()[at + back[i].ravel()].reshape(b, k) + e[i]
            final = np.where((size > i)[:, None], score, final)
        best = final.argmax(axis=1)
        path = np.zeros((t, b), np.int8)
        state = best.copy()
        for i in range(t - 1, -1, -1):
            live = size > i
            state = np.where(size == i + 1, best, state)
            path[i] = np.where(live, state, 0)
            if i:
                state = np.where(live, back[i, np.arange(b), state], state)
        return [path[:n, i] for i, n in enumerate(size)]

    # training ---------------------------------------------------------------------------------------------------

    def fit(self, rows: list[tuple[list[str], list[int]]], epochs: int = 8, rate: float = 0.3, decay: float = 1e-4, batch: int = 32, seed: int = 1, damping: float = 10.0) -> "Model":
        """``rows``: token keys and label numbers."""
        types: dict[str, int] = {}
        coded = [(np.array([types.setdefault(k, len(types) + 1) for k in keys]), np.array(labels)) for keys, labels in rows if keys]
        hashes = [[stable_hash(f) for f in features(k)] for k in types]
        levels = {}
        for count in set(COUNTED.values()):
            lists = [h[:count] for h in hashes]
            sizes = [len(x) for x in lists]
            levels[count] = np.concatenate([np.array(x) for x in lists]), np.repeat(np.arange(1, len(lists) + 1), sizes), np.r_[0, 0, np.cumsum(sizes)]
        k, rng = len(self.labels), np.random.default_rng(seed)
        gw, gt, gs = (np.full_like(x, damping) for x in (self.w, self.t, self.s))
        order = sorted(range(len(coded)), key=lambda i: len(coded[i][0]))
        groups = [order[i : i + batch] for i in range(0, len(order), batch)]
        for _ in range(epochs):
            for g in rng.permutation(len(groups)):
                part = [coded[i] for i in groups[g]]
                size = np.array([len(x) for x, _ in part])
                b, t = len(part), int(size.max())
                ids = np.zeros((b, t + 6), np.int64)
                gold = np.zeros((b, t), np.int64)
                for i, (x, y) in enumerate(part):
                    ids[i, 3 : 3 + len(x)] = x
                    gold[i, : len(y)] = y
                used = np.unique(ids)
                used = used[used > 0]
                parts = {}
                for count, (flat_, owner, first) in levels.items():
                    pick = np.concatenate([np.arange(first[u], first[u + 1]) for u in used])
                    own = np.searchsorted(used, owner[pick]) + 1
                    parts[count] = flat_[pick], own, np.flatnonzero(np.r_[True, own[1:] != own[:-1]]), *np.unique(flat_[pick], return_inverse=True)
                local = np.searchsorted(used, ids) + 1
                local[ids == 0] = 0
                table = np.zeros((len(OFFSETS), len(used) + 1, k), np.float32)
                for i, o in enumerate(OFFSETS):
                    feats, _, begin, _, _ = parts[COUNTED[abs(o)]]
                    table[i, 1:] = np.add.reduceat(self.w[i, feats], begin, axis=0)
                emit = sum(table[i, local[:, 3 + o : 3 + o + t]] for i, o in enumerate(OFFSETS))
                grad_e, grad_t, grad_s = self.gradient(emit.astype(np.float64), gold, size)
                flat_grad = grad_e.reshape(-1, k)
                for i, o in enumerate(OFFSETS):
                    _, own, _, names, inverse = parts[COUNTED[abs(o)]]
                    by_type = summed(local[:, 3 + o : 3 + o + t].ravel(), flat_grad, len(used) + 1)
                    g_f = summed(inverse, by_type[own], len(names)).astype(np.float32)
                    g_f -= decay * self.w[i, names] * b
                    squares = gw[i, names] + g_f**2
                    gw[i, names] = squares
                    self.w[i, names] += rate * g_f / np.sqrt(squares)
                gt += grad_t**2
                gs += grad_s**2
                self.t += (rate * grad_t / np.sqrt(gt)).astype(np.float32)
                self.s += (rate * grad_s / np.sqrt(gs)).astype(np.float32)
        return self

    def gradient(self, emit: np.ndarray, gold: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Observed minus expected counts of emissions, transitions and starts."""
        b, t, k = emit.shape
        trans = self.t.astype(np.float64) + self.bar
        live = np.arange(t)[None, :] < size[:, None]
        alpha = np.zeros((b, t, k))
        beta = np.zeros((b, t, k))
        alpha[:, 0] = self.s + self.bar_start + emit[:, 0]
        top = trans.max()
        m = np.exp(trans - top)
        for i in range(1, t):
            peak = alpha[:, i - 1].max(axis=1, keepdims=True)
            alpha[:, i] = np.log(np.exp(alpha[:, i - 1] - peak) @ m + 1e-300) + peak + top + emit[:, i]
        last = size - 1
        peak = alpha[np.arange(b), last].max(axis=1, keepdims=True)
        z = np.log(np.exp(alpha[np.arange(b), last] - peak).sum(axis=1)) + peak[:, 0]
        grad_t = np.zeros((k, k))
        for i in range(t - 2, -1, -1):
            nxt = beta[:, i + 1] + emit[:, i + 1]
            peak = nxt.max(axis=1, keepdims=True)
            value = np.log(np.exp(nxt - peak) @ m.T + 1e-300) + peak + top
            on = (size > i + 1)[:, None]
            beta[:, i] = np.where(on, value, 0.0)
            pair = np.exp(alpha[:, i, :, None] + trans + nxt[:, None, :] - z[:, None, None])
            grad_t -= (pair * on[:, :, None]).sum(axis=0)
        expected = np.exp(np.minimum(alpha + beta - z[:, None, None], 0)) * live[:, :, None]
        seen = np.zeros((b, t, k))
        np.put_along_axis(seen, gold[:, :, None], 1.0, axis=2)
        seen *= live[:, :, None]
        rows, cols = np.nonzero(live[:, 1:])
        np.add.at(grad_t, (gold[rows, cols], gold[rows, cols + 1]), 1.0)
        grad_e = seen - expected
        return grad_e, grad_t, grad_e[:, 0].sum(axis=0)
