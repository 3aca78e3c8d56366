"""Character n-gram models with modified Kneser-Ney smoothing, kept as sorted hash arrays.

Spark counts the n-grams of all texts; a model is estimated from the counts, whose
number is bounded by ``SYMBOLS ** ORDER`` whatever the input. Symbol 0 pads the start
of a text, 1 stands for every character outside the model's alphabet, and the rest are
the most frequent characters, where digits count as one and so do capitals A-Z: a text
in capitals is then as unlikely as one in symbols. A character outside the alphabet has
the probability of symbol 1 in its context times its own one among all such characters,
from the counts of every one of them.

An n-gram that holds a letter outside the alphabet also has figures of its own (``Rare``),
over the letters themselves, whatever their number: the model over symbols is what they fall
back to. A text is judged there by the other texts and by what it holds before: what it alone
holds, and once, says nothing of it. Signs that are no letters stay one symbol there, as digits and capitals do: where each had
its contexts, texts strewn with signs would make each other likely.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import cache

import numpy as np

ORDER = 4
SYMBOLS = 32
PAD, OTHER, FIRST = 0, 1, 2
CODES = SYMBOLS**ORDER
CODE_POINTS = 0x110000
#: Stands for every sign that is no letter and outside the alphabet.
SIGN = 1
#: Taken from each count of a character outside the alphabet, for those never seen.
OTHER_DISCOUNT = 0.5
#: Every digit is counted as 0, every capital as A, NUL as a space.
_FOLD = bytes.maketrans(b"\x00123456789" + bytes(range(ord("B"), ord("Z") + 1)), b" 000000000" + b"A" * 25)


def fold(text: bytes) -> str:
    """What is counted of a text."""
    return text.translate(_FOLD).decode("utf-8")


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype="<u4")


def alphabet_table(chars: Iterable[int]) -> np.ndarray:
    """Symbol of each code point."""
    table = np.full(CODE_POINTS, OTHER, dtype=np.uint8)
    for i, c in enumerate(chars):
        table[c] = FIRST + i
    return table


def gram_codes(texts: list[bytes], table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code of the n-gram that ends at each character, characters of each text, the
    characters), the texts one after the other, each padded at its start."""
    return grams_of(texts, table)[:3]


@cache
def letters() -> np.ndarray:
    """Of each code point, whether it is a letter or a mark of one, in any script."""
    return np.array([unicodedata.category(chr(c))[0] in "LM" for c in range(CODE_POINTS)])


def grams_of(texts: list[bytes], table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``gram_codes``, then which characters end an n-gram with a letter outside the alphabet, and
    the characters of these n-grams, a row each, where other signs outside it are SIGN."""
    folded = [fold(t) for t in texts]
    pad = "\0" * (ORDER - 1)
    points = code_points(pad + pad.join(folded))
    symbols = table[points].astype(np.int64)
    symbols[points == 0] = PAD
    codes = symbols[ORDER - 1 :].copy()
    for back in range(1, ORDER):
        codes += symbols[ORDER - 1 - back : len(symbols) - back] * SYMBOLS**back
    real = points[ORDER - 1 :] != 0
    other = (symbols == OTHER) & letters()[points]
    held = real.copy()
    held &= np.any([other[i : i + len(real)] for i in range(ORDER)], axis=0)
    at = np.nonzero(held)[0]
    rare = np.stack([points[at + i] for i in range(ORDER)], axis=1).astype(np.int64)
    rare[(rare != 0) & (table[rare] == OTHER) & ~letters()[rare]] = SIGN
    sizes = np.array([len(f) for f in folded], dtype=np.int64)
    return codes[real], sizes, points[ORDER - 1 :][real], np.cumsum(real)[at] - 1, rare


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values (splitmix64): distinct keys keep distinct hashes."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _key(order: int, codes: np.ndarray) -> np.ndarray:
    return mix(codes.astype(np.uint64) + np.uint64(order << 40) + np.uint64(1))


def discounts(counts: np.ndarray) -> np.ndarray:
    """D1, D2, D3+ of modified Kneser-Ney from the counts of counts; half, one and one and
    a half where a count of counts is missing."""
    return discounts_of([float((counts == k).sum()) for k in (1, 2, 3, 4)])


def discounts_of(counts_of_counts: Sequence[float]) -> np.ndarray:
    """``discounts`` from how many counts are 1, 2, 3 and 4."""
    n = [0.0, *counts_of_counts]
    if min(n[1:]) == 0:
        return np.array([0.0, 0.5, 1.0, 1.5])
    y = n[1] / (n[1] + 2 * n[2])
    d = [0.0] + [k - (k + 1) * y * n[k + 1] / n[k] for k in (1, 2, 3)]
    return np.clip(d, 0.0, [0.0, 1.0, 2.0, 3.0])


def hash_rows(points: np.ndarray) -> np.ndarray:
    """64 bits for each row: those of distinct rows are distinct, but for a chance of about
    n * n / 2 ** 65 among n rows."""
    out = np.full(len(points), points.shape[1], dtype=np.uint64)
    for column in points.T:
        out = mix(out + column.astype(np.uint64) + np.uint64(1))
    return out


def _at(keys: np.ndarray, wanted: np.ndarray, *figures: np.ndarray) -> list[np.ndarray]:
    """Of each figure the one of each wanted key, 0 where it is not among the sorted keys."""
    if not len(keys):
        return [np.zeros(len(wanted)) for _ in figures]
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    hit = keys[at] == wanted
    return [np.where(hit, f[at], 0.0) for f in figures]


def _earlier(groups: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
    """Of each row the number (or the weights) of the rows before it in its group."""
    order = np.argsort(groups, kind="stable")
    w = np.ones(len(groups)) if weights is None else weights[order].astype(np.float64)
    before = np.cumsum(w) - w
    sizes = np.bincount(groups)
    sizes = sizes[sizes > 0]
    out = np.empty(len(groups))
    out[order] = before - np.repeat(before[np.cumsum(sizes) - sizes], sizes)
    return out


@dataclass
class Rare:
    """Per length from 2 to ORDER, of the n-grams that hold a letter outside the alphabet:
    (their hashes, counts, the hashes of their contexts, each context's count, its distinct
    n-grams). After a context without such a letter only those letters are counted."""

    levels: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, rare: np.ndarray, counts: np.ndarray, table: np.ndarray) -> Rare:
        levels = {}
        for k in range(2, ORDER + 1):
            part = rare[:, ORDER - k :]
            held = (letters()[part] & (table[part] == OTHER)).any(axis=1)
            part = part[held]
            keys, first, to = np.unique(hash_rows(part), return_index=True, return_inverse=True)
            n = np.bincount(to, weights=counts[held], minlength=len(keys))
            contexts, to = np.unique(hash_rows(part[first, :-1]), return_inverse=True)
            size = len(contexts)
            levels[k] = (keys, n, contexts, np.bincount(to, weights=n, minlength=size), np.bincount(to, minlength=size).astype(np.float64))
        return cls(levels)

    def probability(self, k: int, part: np.ndarray, low: np.ndarray, owner: np.ndarray | None) -> np.ndarray:
        """P(last character | those before) of n-grams of length k, over ``low``, their
        probability from a shorter context. ``owner``: the text of each, whose own counts are
        taken off but for those of the n-grams before it; None where the texts are not among
        those counted."""
        keys, n, contexts, total, kinds = self.levels[k]
        grams, context = hash_rows(part), hash_rows(part[:, :-1])
        (count,) = _at(keys, grams, n)
        sum_, types = _at(contexts, context, total, kinds)
        if owner is not None:
            salt = mix(owner.astype(np.uint64) + np.uint64(1))
            _, first, to, own = np.unique(mix(grams ^ salt), return_index=True, return_inverse=True, return_counts=True)
            _, group = np.unique(mix(context ^ salt), return_inverse=True)
            alone = count[first] <= own
            new = alone[to] & (_earlier(to) == 0)
            count = np.maximum(count - own[to] + _earlier(to), 0)
            sum_ = sum_ - np.bincount(group)[group] + _earlier(group)
            types = types - np.bincount(group, weights=new)[group] + _earlier(group, new)
        found = sum_ > 0
        sum_ = np.where(found, sum_, 1.0)
        p = (np.maximum(count - OTHER_DISCOUNT, 0) + OTHER_DISCOUNT * types * low) / sum_
        return np.where(found, p, low)


@dataclass
class Model:
    """rare: the figures of the n-grams that hold a letter outside the alphabet. hashes: sorted; logp: of the n-gram with that hash; backoff: of it as a context;
    others: the characters seen outside the alphabet, sorted; other_logp: of each among them."""

    hashes: np.ndarray
    logp: np.ndarray
    backoff: np.ndarray
    floor: float
    others: np.ndarray
    other_logp: np.ndarray
    other_floor: float
    rare: Rare | None = None
    _memo: np.ndarray | None = field(default=None, repr=False)

    def _find(self, order: int, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = _key(order, codes)
        at = np.minimum(np.searchsorted(self.hashes, keys), len(self.hashes) - 1)
        return at, self.hashes[at] == keys

    def lookup(self, codes: np.ndarray) -> np.ndarray:
        """log P(last symbol | those before): the longest known n-gram, after the back-off
        weights of the longer contexts."""
        out = np.zeros(len(codes))
        open_ = np.arange(len(codes))
        for order in range(ORDER, 0, -1):
            part = codes[open_] % SYMBOLS**order
            at, found = self._find(order, part)
            out[open_[found]] += self.logp[at[found]]
            open_, part = open_[~found], part[~found]
            if order > 1 and len(open_):
                at, known = self._find(order - 1, part // SYMBOLS)
                out[open_[known]] += self.backoff[at[known]]
        out[open_] += self.floor
        return out

    def logp_of(self, codes: np.ndarray) -> np.ndarray:
        """As ``lookup``; what a worker has looked up once it keeps (CODES floats at most)."""
        if self._memo is None:
            self._memo = np.full(CODES, np.nan, dtype=np.float32)
        need = np.unique(codes[np.isnan(self._memo[codes])])
        if len(need):
            self._memo[need] = self.lookup(need)
        return self._memo[codes]

    def logp_of_other(self, points: np.ndarray) -> np.ndarray:
        """log P(character | one outside the alphabet)."""
        if not len(self.others):
            return np.full(len(points), self.other_floor)
        at = np.minimum(np.searchsorted(self.others, points), len(self.others) - 1)
        return np.where(self.others[at] == points, self.other_logp[at], self.other_floor)

    def logp_of_characters(self, codes: np.ndarray, points: np.ndarray) -> np.ndarray:
        """log P(character | those before), of every character its own."""
        out = self.logp_of(codes).astype(np.float64)
        other = codes % SYMBOLS == OTHER
        out[other] += self.logp_of_other(points[other])
        return out

    def _share_of_signs(self) -> float:
        """Of the characters outside the alphabet, the probability that one is no letter."""
        signs = ~letters()[self.others]
        unseen = (~letters()).sum() - signs.sum()
        return float(np.exp(self.other_logp[signs]).sum() + unseen * np.exp(self.other_floor))

    def logp_of_grams(
        self, codes: np.ndarray, points: np.ndarray, at: np.ndarray, rare: np.ndarray, table: np.ndarray, owner: np.ndarray | None
    ) -> np.ndarray:
        """``logp_of_characters``, with the figures of the n-grams ``rare`` at ``at``; ``owner``:
        the text of each of these, see ``Rare.probability``."""
        out = self.logp_of_characters(codes, points)
        if self.rare is None or not len(at):
            return out
        other = letters()[rare] & (table[rare] == OTHER)
        last, sign = other[:, -1], rare[:, -1] == SIGN
        # The character among those outside the alphabet, until a context holds a letter of them;
        # a sign then among the signs, whose share of them all is the same for each.
        among = np.exp(self.logp_of_other(points[at]))
        share = self._share_of_signs() if sign.any() else 1.0
        symbol = np.exp(self.logp_of(codes[at]).astype(np.float64))
        p, whole = np.where(last, among, np.where(sign, share, 1.0)), np.zeros(len(at), dtype=bool)
        for k in range(2, ORDER + 1):
            context = other[:, ORDER - k : -1].any(axis=1)
            p = np.where(context & ~whole, p * symbol, p)
            whole |= context
            held = np.nonzero(context | last)[0]
            p[held] = self.rare.probability(k, rare[held, ORDER - k :], p[held], None if owner is None else owner[held])
        p = np.where(sign, p * among / share, p)
        out[at] = np.log(np.where(whole, p, p * symbol))
        return out

    def __getstate__(self):
        return self.__dict__ | {"_memo": None}


def other_figures(points: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(characters sorted, log-probability of each, that of any other) from the counts of the
    characters outside an alphabet, by absolute discounting."""
    order = np.argsort(points)
    points, counts = points[order].astype(np.int64), counts[order].astype(np.float64)
    if not len(points):
        return points, counts, -float(np.log(CODE_POINTS))
    rest = OTHER_DISCOUNT * len(points) / counts.sum() / CODE_POINTS
    return points, np.log((counts - OTHER_DISCOUNT) / counts.sum() + rest), float(np.log(rest))


def estimate(codes: np.ndarray, counts: np.ndarray, others: np.ndarray, other_counts: np.ndarray) -> Model:
    """Interpolated modified Kneser-Ney from the counts of the longest n-grams: lower
    orders count the distinct symbols that an n-gram follows. ``others``: the characters
    outside the alphabet, with their counts."""
    codes, counts = codes.astype(np.int64), counts.astype(np.float64)
    levels = {ORDER: (codes, counts)}
    for order in range(ORDER - 1, 0, -1):
        shorter, n = np.unique(levels[order + 1][0] % SYMBOLS**order, return_counts=True)
        levels[order] = (shorter, n.astype(np.float64))
    prob = {0: (np.zeros(1, dtype=np.int64), np.full(1, 1.0 / SYMBOLS))}
    weight: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for order in range(1, ORDER + 1):
        grams, n = levels[order]
        d = discounts(n)[np.minimum(n, 3).astype(np.int64)]
        context, at = np.unique(grams // SYMBOLS, return_inverse=True)
        total = np.bincount(at, weights=n)
        gamma = np.bincount(at, weights=d) / total
        low_grams, low = prob[order - 1]
        base = low[np.searchsorted(low_grams, grams % SYMBOLS ** (order - 1))]
        prob[order] = (grams, (n - d) / total[at] + gamma[at] * base)
        weight[order - 1] = (context, gamma)
    hashes, logp, backoff = [], [], []
    for order in range(1, ORDER + 1):
        grams, p = prob[order]
        b = np.zeros(len(grams))
        if order in weight:
            context, gamma = weight[order]
            at = np.minimum(np.searchsorted(context, grams), len(context) - 1)
            hit = context[at] == grams
            b[hit] = np.log(np.maximum(gamma[at[hit]], 1e-12))
            # A context that starts with padding ends no counted n-gram: it has only a weight.
            extra = ~np.isin(context, grams)
            hashes.append(_key(order, context[extra]))
            logp.append(np.full(extra.sum(), np.nan))
            backoff.append(np.log(np.maximum(gamma[extra], 1e-12)))
        hashes.append(_key(order, grams))
        logp.append(np.log(np.maximum(p, 1e-12)))
        backoff.append(b)
    order_ = np.argsort(np.concatenate(hashes))
    floor = float(np.log(np.maximum(weight[0][1][0], 1e-3) / SYMBOLS))
    return Model(
        np.concatenate(hashes)[order_],
        np.concatenate(logp)[order_].astype(np.float32),
        np.concatenate(backoff)[order_].astype(np.float32),
        floor,
        *other_figures(others, other_counts),
    )
