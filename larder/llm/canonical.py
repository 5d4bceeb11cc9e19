"""Canonical words of texts, computed on bytes in numpy.

Words are runs of bytes other than ASCII white space, without outer punctuation. Numbers,
measurement units and names (capitalised words inside a sentence) become typed
placeholders; all other words are hashed in lower case.

Whether a capitalised word begins a sentence depends on the text around it, so there is a
second form of the words (``wide``), in which every capitalised word is a name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import regex

from larder.llm.common import mix64

# Words and signs taken as units, and number words.
UNITS = """mm cm km in inch inches ft foot feet yd yard yards mile miles mg kg gram grams kilogram kilograms lb lbs
pound pounds oz ounce ounces ton tons tonne tonnes ml cl liter liters litre litres gallon gallons sec second seconds
min minute minutes hr hour hours day days week weeks month months year years hz khz mhz ghz kw mw kv ma kj cal kcal
pa kpa bar psi °c °f mph kmh km/h m/s $ € £ ¥ % usd eur gbp dollar dollars euro euros cent cents percent degree
degrees bit bits byte bytes kb mb gb tb""".split()
NUMBER_WORDS = """zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen
sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million
billion first third fourth fifth half twice dozen""".split()

WORD, NUMBER, UNIT, NAME = 0, 1, 2, 3
_NUMBER = regex.compile(r"[$€£¥]?\d[\d.,:/^+\-]*(\p{L}{1,3}|%|°\p{L}?)?")
_EXACT = np.uint64(0xD1B54A32D192ED03)      # sets keys of words with their values apart from template keys
_SLICE = 1 << 19                # bytes worked on at a time
_STEP = np.uint64(0x9E3779B97F4A7C15 | 1)


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SPACE = _table(b" \t\n\r\x0b\x0c")
_DIGIT = _table(b"0123456789")
_INNER = _table(bytes(range(128, 256)) + b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ$%")
_STOP, _CLOSE = _table(b".!?:"), _table(b"\"')]")


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64."""
    inverse = np.uint64(pow(int(_STEP), -1, 1 << 64))
    one = np.ones(1, np.uint64)
    return tuple(np.concatenate([one, np.multiply.accumulate(np.full(n, x, np.uint64))]) for x in (_STEP, inverse))


class _Powers:
    size, up, down = 0, None, None

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > cls.size:
            cls.size = max(n, _SLICE + 4096)
            cls.up, cls.down = _powers(cls.size)
        return cls.up, cls.down


@dataclass
class Words:
    """Canonical words of several texts: hash, kind and span of each; ``bounds``: words of text i are bounds[i]:bounds[i + 1].

    ``wide``: the kinds if capitalised words that begin a sentence are names too; ``plain``: hashes of the words themselves.
    """
    raw: bytes
    hashes: np.ndarray
    kinds: np.ndarray
    first: np.ndarray
    last: np.ndarray
    bounds: np.ndarray
    wide: np.ndarray
    plain: np.ndarray

    def slots(self, at: int, size: int, kinds: np.ndarray | None = None) -> list[str]:
        """Values of the placeholders among ``size`` words, in order, as ``kind:value``."""
        kinds = self.kinds if kinds is None else kinds
        return [f"{kinds[i]}:{self.raw[self.first[i]:self.last[i]].decode('utf-8', 'replace')}"
                for i in range(at, at + size) if kinds[i]]

    def _places(self, size: int) -> np.ndarray:
        """Mask of the places whose ``size`` words lie within one text."""
        n = max(0, len(self.hashes) - size + 1)
        good = np.ones(n, bool)
        for end in self.bounds[1:-1].tolist():              # windows must not run into the next text
            good[max(0, end - size + 1):min(end, n)] = False
        return good

    def windows(self, size: int, min_literals: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and keys of the windows of ``size`` words within one text.

        The key hashes the template if enough words are literal, else the words with their values.
        """
        at = np.flatnonzero(self._places(size))
        rich = enough(self.kinds, size, min_literals)[at]
        keys = np.empty(len(at), np.uint64)
        keys[rich] = _rolled(self.hashes, size)[at[rich]]
        keys[~rich] = _EXACT ^ _rolled(self.plain, size)[at[~rich]] if not rich.all() else 0
        return at, mix64(keys)

    def wide_templates(self, size: int, min_literals: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and template keys in the wide form, for the windows in which it differs and has enough literal words."""
        other = _counts(self.wide != self.kinds, size) > 0
        at = np.flatnonzero(self._places(size) & enough(self.wide, size, min_literals) & other)
        return at, mix64(_rolled(np.where(self.wide > 0, _MARKS[self.wide], self.plain), size)[at])

    def exact(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and keys of all windows by their words with their values, whatever kind these are."""
        at = np.flatnonzero(self._places(size))
        return at, mix64(_EXACT ^ _rolled(self.plain, size)[at])


def _rolled(hashes: np.ndarray, size: int) -> np.ndarray:
    n = max(0, len(hashes) - size + 1)
    out = np.full(n, size, np.uint64)
    for j in range(size):
        out *= _STEP
        out += hashes[j:j + n]
    return out


def _counts(mask: np.ndarray, size: int) -> np.ndarray:
    """How many of each ``size`` consecutive words are in the mask."""
    if len(mask) < size:
        return np.zeros(0, np.int64)
    sums = np.concatenate([[0], np.cumsum(mask)])
    return sums[size:] - sums[:-size]


def enough(kinds: np.ndarray, size: int, min_literals: int) -> np.ndarray:
    """Mask of the windows with enough literal words for a template."""
    return _counts(kinds == WORD, size) >= min(min_literals, size)


def _lowered(text: bytes) -> bytes:
    """Lower case with every byte in its place (ASCII letters only where lower case changes the length)."""
    low = text.decode("utf-8", "replace").lower().encode()
    return low if len(low) == len(text) else text.lower()


def _slices(raw: bytes) -> Iterator[tuple[int, int]]:
    """Pieces of about ``_SLICE`` bytes that end at line breaks or spaces."""
    at = 0
    while at < len(raw):
        end = min(len(raw), at + _SLICE)
        while end < len(raw) and not _SPACE[raw[end]]:
            end += 1
        yield at, end
        at = end


def _words_of(raw: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, ...]:
    """hash, first, last, flags (has digit, capitalised, ends a sentence, opens a line) of the words of a slice."""
    space = _SPACE[raw]
    start = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    if not len(start):
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, *(np.zeros(0, bool) for _ in range(4))
    end = np.flatnonzero(~space & np.concatenate([space[1:], [True]])) + 1
    n = len(raw)
    inner = _INNER[raw]
    mark = np.flatnonzero((raw[:-2] == 0xE2) & (raw[1:-1] == 0x80))         # dashes and curly quotes
    for j in range(3):
        inner[mark + j] = False
    place = np.arange(n)
    first = np.minimum.reduceat(np.where(inner, place, n), start)
    last = np.maximum.reduceat(np.where(inner, place, -1), start) + 1
    bare = last <= first
    first[bare], last[bare] = start[bare], start[bare]
    up, down = _Powers.get(n)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((low.astype(np.uint64) + np.uint64(1)) * up[:n], dtype=np.uint64)])
    hashes = mix64((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64))
    digits = np.concatenate([[0], np.cumsum(_DIGIT[raw])])
    changed = raw != low
    changes = np.concatenate([[0], np.cumsum(changed)])
    padded = np.append(changed, [False, False])
    wide = raw[np.minimum(first, n - 1)] >= 0xC0
    capital = (changes[last] - changes[first] == 1) & (padded[first] | (wide & padded[first + 1])) \
        & (last - first > 1 + wide)
    tail = raw[end - 1]
    ends = _STOP[tail] | (_CLOSE[tail] & _STOP[raw[np.maximum(end - 2, 0)]])
    breaks = np.concatenate([[0], np.cumsum(raw == 10)])
    opens = np.concatenate([[True], breaks[start[1:]] > breaks[end[:-1]]])
    return hashes, first, last, digits[last] > digits[first], capital, ends, opens


def _hash(word: str) -> np.uint64:
    return _words_of(*(np.frombuffer(word.encode(), np.uint8),) * 2)[0][0]


_UNIT_HASHES = np.sort(np.array([_hash(w) for w in UNITS], np.uint64))
_NUMBER_HASHES = np.sort(np.array([_hash(w) for w in NUMBER_WORDS], np.uint64))
_MARKS = np.array([0, 0xA1, 0xB2, 0xC3], np.uint64)       # hashes of the placeholders


def _among(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes


def canonical_words(texts: list[bytes]) -> Words:
    """Canonical words of some texts (their bytes are held together: give a bounded number)."""
    raw = b"\n".join(texts)
    low = b"\n".join(map(_lowered, texts))
    parts, opened = [], True
    for at, end in _slices(raw):
        h, first, last, digit, capital, ends, opens = _words_of(
            np.frombuffer(raw, np.uint8, end - at, at), np.frombuffer(low, np.uint8, end - at, at))
        if len(opens):
            opens[0] = opened or b"\n" in raw[at:at + int(first[0])]
            opened = False
        opened = opened or b"\n" in raw[at + (int(last[-1]) if len(last) else 0):end]
        parts.append((h, first + at, last + at, digit, capital, ends, opens))
    if not parts:
        parts = [_words_of(np.zeros(0, np.uint8), np.zeros(0, np.uint8))]
    h, first, last, digit, capital, ends, opens = (np.concatenate([p[i] for p in parts]) for i in range(7))
    kinds = np.zeros(len(h), np.int64)
    initial = opens.copy()
    initial[1:] |= ends[:-1]
    kinds[capital] = NAME
    kinds[_among(h, _UNIT_HASHES)] = UNIT
    kinds[_among(h, _NUMBER_HASHES)] = NUMBER
    for i in np.flatnonzero(digit).tolist():
        if _NUMBER.fullmatch(raw[first[i]:last[i]].decode("utf-8", "replace")):
            kinds[i] = NUMBER
    wide = kinds
    kinds = np.where((wide == NAME) & initial, WORD, wide)
    hashes = np.where(kinds > 0, _MARKS[kinds], h)
    starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    bounds = np.searchsorted(first, starts[:-1]) if len(texts) else np.zeros(0, np.int64)
    return Words(raw, hashes, kinds, first, last, np.append(bounds, len(h)), wide, h)
