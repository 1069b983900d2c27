"""Elias-Fano sequences and a two-level n-gram trie over them, in memory-mapped bytes."""

import numpy as np

#: Bits between entries of the directory of the upper bits; queries answered at once.
BLOCK, AT_ONCE = 512, 1 << 15

#: Place of the k-th one of a byte.
_ONE_AT = np.full((256, 8), 8, np.uint8)
for _b in range(256):
    _ones = [k for k in range(8) if _b >> k & 1]
    _ONE_AT[_b, : len(_ones)] = _ones


def _pick(parts: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row of ``parts``, the one that holds the ``left``-th one; its number, and how many
    ones are still left in it."""
    upto = np.cumsum(np.bitwise_count(parts), axis=1, dtype=np.int64)
    k = (upto <= left[:, None]).sum(axis=1)
    rows = np.arange(len(parts))
    before = np.where(k > 0, upto[rows, k - 1], 0)
    return parts[rows, k], k, left - before


class EliasFano:
    """A sequence that never falls, in about 2 + log2(universe / length) bits an entry.

    Each entry's lower bits are packed side by side; its upper bits are written in unary. ``parts``
    are the arrays to store, in order, and what ``stored`` takes again.
    """

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, zeros: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.zeros = n, low_bits, low, high, zeros
        self.words = high.view(np.uint64).reshape(-1, BLOCK // 64)
        # Eight bytes from every byte on, without a copy.
        whole = max(1, len(low) - 7)
        self.window = np.ndarray((whole,), np.uint64, low, 0, (1,))

    @classmethod
    def of(cls, values: np.ndarray) -> "EliasFano":
        n, top = len(values), int(values[-1]) + 1 if len(values) else 1
        low_bits = min(48, max(0, (top // max(n, 1)).bit_length() - 1))
        places, packed = np.arange(low_bits), [np.zeros(0, np.uint8)]
        for at in range(0, n if low_bits else 0, AT_ONCE):  # a multiple of 8: parts end at a byte
            bits = (values[at : at + AT_ONCE, None] >> places & 1).astype(np.uint8)
            packed.append(np.packbits(bits.ravel(), bitorder="little"))
        low = np.concatenate([*packed, np.zeros(8, np.uint8)])
        upper = (values >> low_bits).astype(np.int64)
        length = n + (top >> low_bits) + 2
        length = (length + BLOCK - 1) // BLOCK * BLOCK
        unary = np.zeros(length, np.uint8)
        unary[upper + np.arange(n)] = 1
        high = np.packbits(unary, bitorder="little")
        ones = unary.reshape(-1, BLOCK).sum(axis=1, dtype=np.int64)
        zeros = np.concatenate([[0], np.cumsum(BLOCK - ones)])
        return cls(n, low_bits, low, high, zeros)

    def parts(self) -> list[np.ndarray]:
        return [np.array([self.n, self.low_bits], np.int64), self.low, self.high, self.zeros]

    @classmethod
    def stored(cls, parts: list[np.ndarray]) -> "EliasFano":
        head, low, high, zeros = parts
        return cls(int(head[0]), int(head[1]), low, high, zeros)

    def lower(self, at: np.ndarray) -> np.ndarray:
        """The lower bits of the entries ``at``."""
        if not self.low_bits:
            return np.zeros(len(at), np.int64)
        bit = at * self.low_bits
        word = self.window[bit >> 3] >> (bit & 7).astype(np.uint64)
        return (word & np.uint64((1 << self.low_bits) - 1)).astype(np.int64)

    def _select(self, block: np.ndarray, left: np.ndarray, zeros: bool) -> np.ndarray:
        """The place of the ``left``-th one, or zero, counted from a block's begin."""
        words = self.words[block]
        word, k, left = _pick(~words if zeros else words, left)
        byte, j, left = _pick(np.ascontiguousarray(word).view(np.uint8).reshape(-1, 8), left)
        return block * BLOCK + k * 64 + j * 8 + _ONE_AT[byte, left]

    def begin(self, upper: np.ndarray) -> np.ndarray:
        """How many entries have upper bits below ``upper``: ones before the zero that ends them."""
        want = upper - 1
        last = want >= self.zeros[-1]
        outside = last | (want < 0)
        inner = np.where(outside, 0, want)
        block = np.searchsorted(self.zeros, inner, "right") - 1
        place = self._select(block, inner - self.zeros[block], zeros=True)
        return np.where(outside, np.where(last, self.n, 0), place - inner)

    def access(self, at: np.ndarray) -> np.ndarray:
        """The entries ``at``: the place of their unary one, less the ones before it."""
        ones = np.arange(len(self.zeros)) * BLOCK - self.zeros
        block = np.searchsorted(ones, at, "right") - 1
        place = self._select(block, at - ones[block], zeros=False)
        return ((place - at) << self.low_bits) + self.lower(at)

    def find(self, value: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The place of ``value`` in [first, end), or -1: the successor among the entries with its
        upper bits, by halving, if that is equal."""
        upper = value >> self.low_bits
        low = np.clip(self.begin(upper), first, end)
        top = np.clip(self.begin(upper + 1), low, end)
        want, high = value & ((1 << self.low_bits) - 1), top.copy()
        live = np.flatnonzero(low < high)
        while len(live):
            middle = (low[live] + high[live]) >> 1
            less = self.lower(middle) < want[live]
            low[live] = np.where(less, middle + 1, low[live])
            high[live] = np.where(less, high[live], middle)
            live = live[low[live] < high[live]]
        out = np.full(len(value), -1, np.int64)
        met = np.flatnonzero(low < top)
        met = met[self.lower(low[met]) == want[met]]
        out[met] = low[met]
        return out


class Trie:
    """Contexts, where their children begin, children, and a byte of probability for each.

    Children are numbers within their context's own range: a context starts where the last child
    of the one before it has ended, so the whole level never falls.
    """

    def __init__(self, contexts: EliasFano, pointers: np.ndarray, bases: np.ndarray, children, codes):
        self.contexts, self.pointers, self.bases = contexts, pointers, bases
        self.children, self.codes = children, codes

    @classmethod
    def of(cls, contexts: np.ndarray, children: np.ndarray, codes: np.ndarray) -> "Trie":
        """From pairs in order of context and child, each pair once."""
        first = np.flatnonzero(np.diff(contexts, prepend=-1) != 0)
        ends = np.concatenate([first[1:], [len(contexts)]]).astype(np.int64)
        spans = children[ends - 1] + 1 if len(first) else np.zeros(0, np.int64)
        bases = np.concatenate([[0], np.cumsum(spans)]).astype(np.int64)
        pointers = np.concatenate([first, [len(contexts)]]).astype(np.int64)
        level = children + np.repeat(bases[:-1], ends - first)
        return cls(
            EliasFano.of(contexts[first]),
            EliasFano.of(pointers),
            EliasFano.of(bases),
            EliasFano.of(level),
            codes.astype(np.uint8),
        )

    def write(self, file) -> list[tuple[int, int, str]]:
        """All levels into ``file``; where each array lies."""
        layout = []
        sequences = (self.contexts, self.pointers, self.bases, self.children)
        for part in [*(p for s in sequences for p in s.parts()), self.codes]:
            file.seek((file.tell() + 7) // 8 * 8)
            layout.append((file.tell(), len(part), part.dtype.str))
            file.write(part.tobytes())
        file.flush()
        return layout

    @classmethod
    def mapped(cls, file, layout) -> "Trie":
        """The levels of a written trie, mapped into memory."""
        arrays = [
            np.memmap(file, dtype=kind, mode="r", offset=at, shape=(n,)) if n else np.zeros(0, kind)
            for at, n, kind in layout
        ]
        return cls(*(EliasFano.stored(arrays[k : k + 4]) for k in range(0, 16, 4)), arrays[16])

    def _ranges(self, contexts: np.ndarray) -> np.ndarray:
        """First and end of each context's children, and first and end of their numbers."""
        out = np.zeros((4, len(contexts)), np.int64)
        for a in range(0, len(contexts) if self.contexts.n else 0, AT_ONCE):
            part = contexts[a : a + AT_ONCE]
            zero = np.zeros(len(part), np.int64)
            at = self.contexts.find(part, zero, zero + self.contexts.n)
            known = np.flatnonzero(at >= 0)
            at = at[known]
            for k, sequence in enumerate((self.pointers, self.bases)):
                out[2 * k, a + known] = sequence.access(at)
                out[2 * k + 1, a + known] = sequence.access(at + 1)
        return out

    def places(self, contexts: np.ndarray, sizes: np.ndarray, children: np.ndarray) -> np.ndarray:
        """The place of each pair, -1 if there is none; ``sizes`` of ``children`` belong to each of
        ``contexts``."""
        out = np.full(len(children), -1, np.int64)
        ranges = self._ranges(contexts)
        of = np.repeat(np.arange(len(contexts)), sizes)
        for a in range(0, len(children) if self.contexts.n else 0, AT_ONCE):
            first, end, base, upto = ranges[:, of[a : a + AT_ONCE]]
            child = children[a : a + AT_ONCE]
            known = np.flatnonzero(child < upto - base)
            out[a + known] = self.children.find((base + child)[known], first[known], end[known])
        return out

    def look_up(self, contexts: np.ndarray, sizes: np.ndarray, children: np.ndarray) -> np.ndarray:
        """The code of each pair, 0 if there is none."""
        place = self.places(contexts, sizes, children)
        out = np.zeros(len(children), np.uint8)
        out[place >= 0] = self.codes[place[place >= 0]]
        return out
