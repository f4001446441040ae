"""Monotone integer sequences in Elias-Fano form, and an n-gram trie made of them. All arrays live in one file that is memory-mapped."""

from __future__ import annotations

import json

import numpy as np

SEGMENT = 4096  # elements between two skip pointers


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct integers, by sorting unless they are in order."""
    v = values if (values[1:] >= values[:-1]).all() else np.sort(values)
    return v[np.concatenate([[True], v[1:] != v[:-1]])] if len(v) else v


def distinct_inverse(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same, and each value's place."""
    if len(values) and (values[1:] >= values[:-1]).all():
        new = np.concatenate([[True], values[1:] != values[:-1]])
        return values[new], np.cumsum(new) - 1
    return np.unique(values, return_inverse=True)


class EliasFano:
    """A non-decreasing sequence: the low bits packed, the high parts as a bit vector in unary; a skip pointer (bit position and value) every SEGMENT elements."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, skip_bit: np.ndarray, skip_value: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.skip_bit, self.skip_value = n, low_bits, low, high, skip_bit, skip_value

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        v = values.astype(np.uint64)
        n, top = len(v), int(v[-1]) + 1 if len(v) else 1
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        low = []
        for at in range(0, n if low_bits else 0, 16 * SEGMENT):  # whole bytes at a time, since a segment is a multiple of eight
            planes = (v[at : at + 16 * SEGMENT, None] >> np.arange(low_bits, dtype=np.uint64)).astype(np.uint8) & np.uint8(1)
            low.append(np.packbits(planes.reshape(-1), bitorder="little"))
        place = (v >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(place[-1]) + 1 if n else 0, dtype=np.uint8)
        high[place] = 1
        return cls(n, low_bits, np.concatenate([*low, np.zeros(0, np.uint8)]), np.packbits(high, bitorder="little"), place[::SEGMENT].astype(np.int64), v[::SEGMENT])

    def segment(self, k: int) -> np.ndarray:
        """Elements k*SEGMENT up to the next skip pointer."""
        begin, end = k * SEGMENT, min(self.n, (k + 1) * SEGMENT)
        first = int(self.skip_bit[k])
        last = int(self.skip_bit[k + 1]) if k + 1 < len(self.skip_bit) else 8 * len(self.high)
        byte = first // 8
        ones = np.flatnonzero(np.unpackbits(np.asarray(self.high[byte : -(-last // 8)]), bitorder="little")) + 8 * byte
        ones = ones[np.searchsorted(ones, first) :][: end - begin]
        value = (ones - np.arange(begin, end)).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            bit = begin * self.low_bits
            raw = np.unpackbits(np.asarray(self.low[bit // 8 : -(-(end * self.low_bits) // 8)]), bitorder="little")[bit % 8 :]
            raw = raw[: (end - begin) * self.low_bits].reshape(-1, self.low_bits)
            wide = np.zeros((len(raw), 64), dtype=np.uint8)
            wide[:, : self.low_bits] = raw
            value |= np.packbits(wide, axis=1, bitorder="little").view("<u8").reshape(-1)
        return value

    def at(self, index: np.ndarray) -> np.ndarray:
        """Elements at ascending positions."""
        out = np.zeros(len(index), dtype=np.uint64)
        cut = np.searchsorted(index, np.arange(0, self.n + SEGMENT, SEGMENT))
        for k in range(len(self.skip_bit)):
            if cut[k] < cut[k + 1]:
                out[cut[k] : cut[k + 1]] = self.segment(k)[index[cut[k] : cut[k + 1]] - k * SEGMENT]
        return out

    def find(self, values: np.ndarray) -> np.ndarray:
        """Positions of ascending values in a strictly increasing sequence, -1 where absent: a successor search, segment by segment."""
        out = np.full(len(values), -1, dtype=np.int64)
        if not self.n:
            return out
        cut = np.append(np.searchsorted(values, self.skip_value), len(values))
        for k in range(len(self.skip_bit)):
            s = slice(cut[k], cut[k + 1])
            if s.start < s.stop:
                own = self.segment(k)
                i = np.minimum(np.searchsorted(own, values[s]), len(own) - 1)
                out[s] = np.where(own[i] == values[s], i + k * SEGMENT, -1)
        return out


def quantise(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of one byte and the codebook: 0 for zero, else bins of equal width in the logarithm, their centre being the mean."""
    code, book = np.zeros(len(p), dtype=np.uint8), np.zeros(256)
    some = p > 0
    if some.any():
        x = np.log10(p[some])
        low, width = x.min(), max((x.max() - x.min()) / 254, 1e-9)
        c = 1 + np.minimum(254, ((x - low) / width).astype(np.int64))
        n = np.bincount(c, minlength=256)
        mean = np.bincount(c, weights=x, minlength=256) / np.maximum(n, 1)
        book[1:] = np.where(n > 0, 10**mean, 0)[1:]
        code[some] = c
    return code, book


class Trie:
    """N-grams below the words before them, of order 2 or 3, each level an Elias-Fano sequence in one mapped file.

    `vocabulary` numbers the names; `words2` holds the words w2 that precede, `start2` the monotone pointers to each
    one's successors and `next2` the successors w3. Order 3 adds the histories (w2, w1) in `words3` and, in `next3`, their
    successors as places among those of w2 (context-relative numbers). The last level carries the smoothed probability
    a = count / (total + mu) of each n-gram and the weight b = mu / (total + mu) of each history, as codes of one byte.
    A history that is known here without a successor has its weight; any other has a = 0 and b = 1.
    """

    def __init__(self, order: int, parts: dict, sizes: dict):
        self.order, self.parts, self.sizes = order, parts, sizes
        self.sequences = ("vocabulary", "words2", "start2", "next2", "words3", "next3")[: 4 if order == 2 else 6]

    @classmethod
    def build(cls, names: np.ndarray, grams: tuple[np.ndarray, ...], count: np.ndarray, total: np.ndarray, mu: float) -> Trie:
        """From distinct n-grams (w2, w3) or (w2, w1, w3) in ascending order, as places in the sorted `names`. `total` is
        how often each one's history occurs, wherever its successors may be; n-grams may have the count 0."""
        order = len(grams)
        context = total > 0
        known = count > 0
        used = np.zeros(len(names), dtype=bool)
        for g in grams[:-1]:
            used[g[context]] = True
        used[grams[-1][known]] = True
        place = np.cumsum(used) - 1  # of a name in the vocabulary
        n_words = max(1, int(used.sum()))
        b, c = place[grams[0]], place[grams[-1]]
        words2 = distinct(b[context])
        i = np.searchsorted(words2, b[known])
        pair = distinct(i * n_words + c[known])
        start2 = np.searchsorted(pair, np.arange(len(words2) + 1) * n_words)
        parts = {"vocabulary": names[used], "words2": words2, "start2": start2, "next2": pair}
        sizes = {"words": n_words, "width": 1}
        if order == 2:
            first = np.searchsorted(b[context], words2)
        else:
            a = place[grams[1]]
            each = np.searchsorted(words2, b[context]) * n_words + a[context]
            history = distinct(each)
            first = np.searchsorted(each, history)
            j = np.searchsorted(history, i * n_words + a[known])
            at = np.searchsorted(pair, i * n_words + c[known]) - start2[i]
            sizes["width"] = int(np.diff(start2).max(initial=0)) + 1
            parts |= {"words3": history, "next3": j * sizes["width"] + at}
        parts = {k: EliasFano.encode(v) for k, v in parts.items()}
        parts["a"] = quantise(count[known] / (total[known] + mu))
        parts["b"] = quantise(mu / (total[context][first] + mu))
        return cls(order, parts, sizes)

    def arrays(self) -> dict[str, np.ndarray]:
        out = {}
        for name in self.sequences:
            e = self.parts[name]
            out |= {f"{name}.low": e.low, f"{name}.high": e.high, f"{name}.bit": e.skip_bit, f"{name}.value": e.skip_value, f"{name}.n": np.array([e.n, e.low_bits])}
        for name in "ab":
            out |= {f"{name}.code": self.parts[name][0], f"{name}.book": self.parts[name][1]}
        return out

    def save(self, path: str) -> None:
        """A header line in JSON, then the arrays, each at a multiple of eight bytes."""
        arrays, at, where = self.arrays(), 0, {}
        for k, v in arrays.items():
            where[k] = [at, len(v), v.dtype.str]
            at += -(-v.nbytes // 8) * 8
        head = json.dumps({"order": self.order, "sizes": self.sizes, "where": where}).encode()
        head += b" " * (-(len(head) + 1) % 8) + b"\n"
        with open(path, "wb") as f:
            f.write(head)
            for v in arrays.values():
                f.write(v.tobytes() + b"\0" * (-v.nbytes % 8))

    @classmethod
    def load(cls, path: str) -> Trie:
        """Map the file; pages are read as they are touched."""
        with open(path, "rb") as f:
            head = f.readline()
        info, data = json.loads(head), np.memmap(path, dtype=np.uint8, mode="r", offset=0)
        get = lambda k: data[len(head) + info["where"][k][0] :][: info["where"][k][1] * np.dtype(info["where"][k][2]).itemsize].view(info["where"][k][2])
        out = cls(info["order"], {}, info["sizes"])
        out.parts = {k: EliasFano(*(int(x) for x in get(f"{k}.n")), get(f"{k}.low"), get(f"{k}.high"), get(f"{k}.bit"), get(f"{k}.value")) for k in out.sequences}
        out.parts |= {k: (get(f"{k}.code"), np.array(get(f"{k}.book"))) for k in "ab"}
        return out

    def numbers(self, names: np.ndarray) -> np.ndarray:
        """Places of ascending names in the vocabulary, -1 for unknown ones."""
        return self.parts["vocabulary"].find(names.astype(np.uint64))

    def weights(self, grams: tuple[np.ndarray, ...], convert=np.asarray) -> tuple[np.ndarray, np.ndarray]:
        """(a, b) of any n-grams (w2, w3) or (w2, w1, w3) of vocabulary numbers, with p = a + b * p of the shorter history;
        `convert` is applied to the values in the codebooks."""
        p, n_words, width = self.parts, self.sizes["words"], self.sizes["width"]

        def lookup(sequence: EliasFano, value: np.ndarray, ok: np.ndarray) -> np.ndarray:
            out = np.full(len(value), -1, dtype=np.int64)
            ask, inverse = distinct_inverse(value[ok])
            out[ok] = sequence.find(ask.astype(np.uint64))[inverse]
            return out

        def code(name: str, at: np.ndarray, missing: float) -> np.ndarray:
            codes, book = p[name]
            values = convert(np.append(book, missing))
            out = np.full(len(at), 256)
            out[at >= 0] = codes[at[at >= 0]]
            return values[out]

        x2, x3 = grams[0], grams[-1]
        i = lookup(p["words2"], x2, x2 >= 0)
        pair = lookup(p["next2"], i * n_words + x3, (i >= 0) & (x3 >= 0))
        if self.order == 2:
            return code("a", pair, 0.0), code("b", i, 1.0)
        j = lookup(p["words3"], i * n_words + grams[1], (i >= 0) & (grams[1] >= 0))
        both = (pair >= 0) & (j >= 0)
        ask, inverse = distinct_inverse(i[both])
        value = np.zeros(len(x2), dtype=np.int64)
        value[both] = j[both] * width + pair[both] - p["start2"].at(ask)[inverse].astype(np.int64)
        return code("a", lookup(p["next3"], value, both), 0.0), code("b", j, 1.0)
