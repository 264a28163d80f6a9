"""Double-array tries over whole-number labels, stepped through by numpy for many positions at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Slots looked at together for a node's children.
_WINDOW = 4096


class Trie:
    """Phrases (rows of ``phrases``, arrays of uint64 words, none of them 0) and their numbers 0, 1, 2 ...

    State 0 is the root. The child of state s by label x is base[s] + x, if check[base[s] + x] is s. accept[s] is the number
    of the phrase that ends there, or -1."""

    def __init__(self, words: np.ndarray, labels: np.ndarray, base: np.ndarray, check: np.ndarray, accept: np.ndarray, longest: int):
        self.words, self.labels, self.base, self.check, self.accept, self.longest = words, labels, base, check, accept, longest

    @classmethod
    def build(cls, phrases: list[np.ndarray]) -> "Trie":
        longest = max(map(len, phrases), default=0)
        flat = np.concatenate(phrases) if phrases else np.zeros(0, np.uint64)
        words, at, often = np.unique(flat, return_inverse=True, return_counts=True)
        labels = np.empty(len(words), np.int64)
        labels[np.argsort(-often, kind="stable")] = np.arange(len(words))  # small labels for frequent words: closer children
        rows = np.full((len(phrases), longest), -1, np.int64)
        rows[np.arange(longest)[None, :] < np.array([len(p) for p in phrases]).reshape(-1, 1)] = labels[at.reshape(-1)]
        size = len(words) + 1
        used = np.zeros(2 * size + 1, bool)
        base, check, accept = {0: 1}, {0: -2}, {}
        used[0] = True
        state = np.zeros(len(phrases), np.int64)
        end, spots = 1, {}
        for depth in range(longest):
            live = np.flatnonzero(rows[:, depth] >= 0)
            pairs, inverse = np.unique(np.stack([state[live], rows[live, depth]], 1), axis=0, return_inverse=True)
            parents, first, n = np.unique(pairs[:, 0], return_index=True, return_counts=True)
            slots = np.empty(len(pairs), np.int64)
            low = 1
            for k in np.argsort(-n, kind="stable"):
                s, kids = int(parents[k]), pairs[first[k]:first[k] + n[k], 1]
                if not s:
                    at_base = 1
                elif len(kids) == 1:
                    while low < end and used[low]:
                        low += 1
                    at_base = low - int(kids[0])
                else:  # from where the last node with as many children found room; behind the end all fit
                    if end + int(kids[-1]) + _WINDOW > len(used):
                        used = np.concatenate([used, np.zeros(end + int(kids[-1]) + _WINDOW, bool)])
                    fits, spot = kids[:0], max(low, spots.get(len(kids), 0))
                    while not len(fits):
                        upto = min(end + 1, spot + _WINDOW)
                        fits = np.flatnonzero(~used[spot:upto]) + spot - kids[0]
                        for i in range(1, len(kids)):
                            if len(fits) <= 64:
                                fits = fits[~used[fits[:, None] + kids[None, i:]].any(1)]
                                break
                            fits = fits[~used[fits + kids[i]]]
                        spots[len(kids)] = spot
                        spot = upto
                    at_base = int(fits[0])
                base[s] = at_base
                places = at_base + kids
                top = int(places[-1]) + 1
                if top > len(used):
                    used = np.concatenate([used, np.zeros(max(top, 2 * len(used)) - len(used), bool)])
                used[places] = True
                end = max(end, top)
                slots[first[k]:first[k] + n[k]] = places
                check.update(dict.fromkeys(places.tolist(), s))
            state[live] = slots[inverse.reshape(-1)]
            done = live[(rows[live, depth + 1] < 0) if depth + 1 < longest else np.ones(len(live), bool)]
            accept.update(zip(state[done].tolist(), done.tolist()))

        def array(values: dict[int, int], rest: int) -> np.ndarray:
            out = np.full(end, rest, np.int32)
            out[list(values)] = list(values.values())
            return out

        return cls(words, labels.astype(np.int32), array(base, end + 1), array(check, -1), array(accept, -1), longest)

    def count(self, x: np.ndarray) -> np.ndarray:
        """How often each phrase occurs in the sequence ``x`` of words (uint64; 0 belongs to no phrase): all positions
        take a step at a time."""
        n, size = int(self.accept.max(initial=-1)) + 1, len(self.check)
        total = np.zeros(n, np.int64)
        if not n:
            return total
        at = np.minimum(np.searchsorted(self.words, x), len(self.words) - 1)
        label = np.where(self.words[at] == x, self.labels[at], -1)
        pos = np.flatnonzero(label >= 0)
        state = np.zeros(len(pos), np.int32)
        for depth in range(self.longest):
            inside = pos + depth < len(x)
            pos, state = pos[inside], state[inside]
            step = label[pos + depth]
            to = self.base[state] + step
            ok = (step >= 0) & (to >= 0) & (to < size)
            ok[ok] = self.check[to[ok]] == state[ok]
            pos, state = pos[ok], to[ok]
            if not len(pos):
                break
            ends = self.accept[state]
            total += np.bincount(ends[ends >= 0], minlength=n)
        return total

    def pack(self) -> tuple:
        """The arrays, compressed, and the longest phrase's length."""
        raw = [a.tobytes() for a in (self.words, self.labels, self.base, self.check, self.accept)]
        return tuple(len(x).to_bytes(8, "little") + pa.compress(x, codec="zstd", asbytes=True) for x in raw) + (self.longest,)

    @classmethod
    def unpack(cls, *packed) -> "Trie":
        """A trie from what ``pack`` gave."""
        raw = [pa.decompress(bytes(x[8:]), int.from_bytes(x[:8], "little"), codec="zstd", asbytes=True) for x in packed[:-1]]
        return cls(np.frombuffer(raw[0], np.uint64), *(np.frombuffer(b, np.int32) for b in raw[1:]), packed[-1])
