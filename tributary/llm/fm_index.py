"""An FM-index over numbered words: suffix order, wavelet matrix of the transform, backward search.

The order is exact for as many words as the threshold and one more; longer patterns are not asked for.
Everything is a numpy array over the index or over all streamed patterns at once.
"""

import numpy as np


class WaveletMatrix:
    """Ranks of symbols in a sequence: one packed bit vector per bit of a symbol."""

    def __init__(self, symbols: np.ndarray):
        self.levels = max(1, int(symbols.max(initial=0)).bit_length())
        self.bits, self.before, self.zeros = [], [], []
        for level in range(self.levels - 1, -1, -1):
            bit = (symbols >> level) & 1
            packed = np.packbits(np.append(bit, np.zeros(64 - len(bit) % 64, bit.dtype)).astype(np.uint8), bitorder="little")
            words = packed.view("<u8")
            self.bits.append(words)
            self.before.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)]))
            self.zeros.append(int(len(bit) - bit.sum()))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def moved(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where positions go when a sequence is sorted down to their symbols."""
        for k in range(self.levels):
            word, low = at >> 6, (at & 63).astype(np.uint64)
            ones = self.before[k][word] + np.bitwise_count(self.bits[k][word] & ((np.uint64(1) << low) - np.uint64(1)))
            bit = (symbols >> (self.levels - 1 - k)) & 1
            at = np.where(bit == 1, self.zeros[k] + ones, at - ones)
        return at


def _ranks(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Dense ranks of pairs."""
    return np.unique(first * (int(second.max(initial=0)) + 1) + second, return_inverse=True)[1]


def _later(ranks: np.ndarray, by: int) -> np.ndarray:
    """Ranks ``by`` places on; past the end counts as smallest."""
    return np.concatenate([ranks[by:] + 1, np.zeros(min(by, len(ranks)), ranks.dtype)])


class FMIndex:
    """Index of texts, each an array of numbers above 0; a zero separates them."""

    def __init__(self, texts: list[np.ndarray], threshold: int):
        self.threshold = threshold
        zero = np.zeros(1, np.int64)
        self.text = np.concatenate([part for t in texts for part in (t, zero)]) if texts else zero
        ranks, width = np.unique(self.text, return_inverse=True)[1], 1
        while 2 * width <= threshold:
            ranks = _ranks(ranks, _later(ranks, width))
            width *= 2
        # Equal ranks here: the same first `threshold` symbols. They are neighbours in the order.
        alike = _ranks(ranks, _later(ranks, threshold - width)) if threshold > width else ranks
        self.order = np.lexsort((_later(ranks, width), ranks))
        group = alike[self.order]
        starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        self.starts, self.ends = starts, np.append(starts[1:], len(group))
        self.group = np.cumsum(np.append(True, group[1:] != group[:-1])) - 1
        transform = self.text[self.order - 1]
        self.wavelet = WaveletMatrix(transform)
        symbols = np.arange(int(self.text.max()) + 1)
        self.base = np.searchsorted(np.sort(transform), symbols)  # symbols that are smaller
        self.origin = self.wavelet.moved(symbols, np.zeros(len(symbols), np.int64))

    def extended(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward step: intervals of suffixes that start with the symbol and then match as before."""
        shift = self.base[symbols] - self.origin[symbols]
        return self.wavelet.moved(symbols, low) + shift, self.wavelet.moved(symbols, high) + shift

    def lowest(self, values: np.ndarray) -> np.ndarray:
        """Least value of each group of suffixes with the same first ``threshold`` symbols; one value per position."""
        return np.minimum.reduceat(values[self.order], self.starts)

    def matching(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics of texts: ``length, group`` for each position of all texts, and where each text starts.

        The length of the longest match that starts there, up to the threshold; the group if it is reached,
        else -1. A match that cannot be extended is given up to the longest shorter one that can.
        """
        sizes = np.array([len(t) for t in texts], np.int64)
        begin = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64) if len(sizes) else sizes
        flat = np.concatenate(texts) if texts else np.zeros(0, np.int64)
        length, group = np.zeros(len(flat), np.int64), np.full(len(flat), -1, np.int64)
        active = np.flatnonzero(sizes)
        low, high = np.zeros(len(sizes), np.int64), np.full(len(sizes), len(self.text), np.int64)
        depth = np.zeros(len(sizes), np.int64)
        step = 0
        while len(active):
            at = begin[active] + sizes[active] - 1 - step
            symbols = flat[at]
            known = symbols < len(self.base)
            new_low, new_high = self.extended(np.where(known, symbols, 0), low[active], high[active])
            good = known & (new_low < new_high)
            low[active[good]], high[active[good]] = new_low[good], new_high[good]
            depth[active[good]] += 1
            for text, place in zip(active[~good], at[~good]):
                low[text], high[text], depth[text] = self._again(flat, place, depth[text])
            full = active[depth[active] >= self.threshold]
            of = self.group[low[full]]
            low[full], high[full], depth[full] = self.starts[of], self.ends[of], self.threshold
            length[at] = depth[active]
            group[begin[full] + sizes[full] - 1 - step] = of
            step += 1
            active = active[sizes[active] > step]
        return length, group, begin

    def _again(self, flat: np.ndarray, place: int, most: int) -> tuple[int, int, int]:
        """The longest match from a position on, at most ``most`` words, by search from its end."""
        for size in range(int(most), 0, -1):
            low, high = np.zeros(1, np.int64), np.full(1, len(self.text), np.int64)
            for symbol in flat[place:place + size][::-1]:
                if symbol >= len(self.base) or low[0] >= high[0]:
                    high[0] = low[0]
                    break
                low, high = self.extended(np.array([symbol]), low, high)
            if low[0] < high[0]:
                return int(low[0]), int(high[0]), size
        return 0, len(self.text), 0
