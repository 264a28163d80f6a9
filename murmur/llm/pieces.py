"""SentencePiece encoding with seeded merge-dropout, and decoding.

The pieces and scores of a merge-type (BPE) model file are used as they are. A text is cut into units that no piece
crosses: a run of white-space marks with the marks-free run after it, cut once more after each character that is in no
piece of two or more characters' middle (line feeds, for one). In a unit, adjacent symbols whose
concatenation is a piece are candidates on an agenda, best score first, leftmost first among equals. A candidate is
skipped, for good, if a hash keyed by the seed, the unit, its variant and the two symbols' places is under the dropout rate;
else it is merged, and what it forms with its neighbours joins the agenda. What is left that is no piece is spelled in
byte pieces. A word's variant is a keyed hash of the document's id and of how often the word came before in it, modulo
``variants``: so a word is cut in several ways, repeated runs give the same ids, and cuts can be remembered.

Decoding joins the pieces' bytes and turns the mark back into a space; it gives back every text, white space and all, that holds no
U+2581 itself.

Defined results: a very long text is handled whole, like any other (a task holds one batch of texts); null and empty texts have no ids; a null id is hashed as the text "null"; repeated rows get equal
ids; an empty table gives no rows. Columns other than id and text are not read."""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import kept_by_worker

MARK = "▁"


def _raw(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


class Pieces:
    """Encoder and decoder for one model file."""

    def __init__(self, path: str, rate: float = 0.1, seed: int = 1, variants: int = 4, memory: int = 800_000):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.bytes_of: list[bytes] = []
        self.id_of: dict[str, int] = {}
        self.score: list[float] = []
        self.byte_id = [0] * 256
        for i in range(n):
            p = sp.id_to_piece(i)
            self.score.append(sp.get_score(i))
            if sp.is_byte(i):
                self.byte_id[int(p[3:5], 16)] = i
                self.bytes_of.append(bytes([int(p[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.bytes_of.append(b"")
            else:
                self.id_of[p] = i
                self.bytes_of.append(p.replace(MARK, " ").encode())
        if any(MARK in p.strip(MARK) or p.startswith(MARK) and p.strip(MARK) and MARK in p[p.index(p.strip(MARK)):] for p in self.id_of):
            raise ValueError("a piece goes on behind a word's end")
        self.limit, self.seed, self.variants, self.memory = int(rate * (1 << 32)), seed, variants, memory
        joins = {c for p in self.id_of for c in p if len(p) > 1}
        # a character that no longer piece holds never merges: white space that is no mark, above all
        self.alone = {c for c in "\n\t\r\x0b\x0c" if c not in joins}
        stop = "".join(re.escape(c) for c in sorted(self.alone))
        self.units = re.compile(f"{MARK}+[^{MARK}{stop}]*|[^{MARK}{stop}]+|[{stop}]" if stop else f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        self.known: list[dict[str, bytes]] = [{} for _ in range(max(1, variants))]  # by variant
        # for many units at once: characters' ids, and of every two pieces that join to one, that one and its place by score
        self.char_id = np.full(0x110000, -1, dtype=np.int32)
        for p, i in self.id_of.items():
            if len(p) == 1:
                self.char_id[ord(p)] = i
        order = {x: k for k, x in enumerate(sorted(set(self.score), reverse=True))}
        self.none = np.iinfo(np.int16).max if len(order) < np.iinfo(np.int16).max else np.iinfo(np.int32).max
        rank = np.int16 if self.none == np.iinfo(np.int16).max else np.int32
        found = sorted((self.id_of[p[:k]] * n + self.id_of[p[k:]], i, order[self.score[i]]) for p, i in self.id_of.items()
                       for k in range(1, len(p)) if p[:k] in self.id_of and p[k:] in self.id_of)
        keys = np.array([x[0] for x in found], dtype=np.uint64)
        self.n = np.uint64(n)
        self.slots = np.uint64(64 - max(4, int(len(keys) * 4).bit_length()))
        size = 1 << (64 - int(self.slots))
        self.table_key = np.full(size + 64, np.uint64((1 << 64) - 1))
        self.table_id, self.table_rank = np.zeros(size + 64, dtype=np.int32), np.full(size + 64, self.none, dtype=rank)
        self.reach = 1
        for key, slot, (_, i, r) in zip(keys, self._slot(keys).tolist(), found):
            at = slot
            while self.table_key[at] != (1 << 64) - 1:
                at += 1
            self.table_key[at], self.table_id[at], self.table_rank[at] = key, i, r
            self.reach = max(self.reach, at - slot + 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key * np.uint64(0x9E3779B97F4A7C15)) >> self.slots).astype(np.int64)

    def _join(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of pairs of symbols: the piece that they join to and its rank, ``none`` if there is none."""
        key = a.astype(np.int64).astype(np.uint64) * self.n + b.astype(np.int64).astype(np.uint64)
        slot = self._slot(key)
        out = np.full(len(key), -1, dtype=np.int64)
        open_ = np.flatnonzero((a >= 0) & (b >= 0))
        for k in range(self.reach):
            here = self.table_key[slot[open_] + k]
            hit = here == key[open_]
            out[open_[hit]] = slot[open_[hit]] + k
            open_ = open_[~hit & (here != np.uint64((1 << 64) - 1))]
            if not len(open_):
                break
        hit = out >= 0
        return np.where(hit, self.table_id[out], -1), np.where(hit, self.table_rank[out], self.table_rank.dtype.type(self.none))

    def learn(self, units: list[str], variant: int) -> None:
        """Remember the ids of many units: as ``encode_unit``, all units of about a length at a time, one merge each a round."""
        by: dict[int, list] = {8: [], 12: [], 18: [], 32: []}
        width = [8] * 9 + [12] * 4 + [18] * 6 + [32] * 14
        for x in units:
            n = len(x)
            if n <= 32:
                by[width[n]].append(x)
            else:
                self.known[variant][x] = np.array(self.encode_unit(x, variant), dtype="<u4").tobytes()
        for n, some in by.items():
            for i in range(0, len(some), 5000):
                self._learn(some[i:i + 5000], variant, n)

    def _learn(self, names: list[str], variant: int, width: int) -> None:
        length = np.fromiter(map(len, names), np.int8, len(names))
        points = np.frombuffer("".join(names).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int32)
        cols = np.arange(width)[None, :]
        full = cols < length[:, None]
        ids = self.char_id[points]
        sym = np.full((len(names), width + 1), -1, dtype=np.int32)
        sym[:, :width][full] = np.where(ids >= 0, ids, -2 - points)
        done = sym.copy()
        # of each symbol, and behind the last one: where it starts
        start = np.minimum(np.arange(width + 1, dtype=np.int8)[None, :], length[:, None])
        rank = np.full((len(names), width + 1), self.none, dtype=self.table_rank.dtype)
        r, c = np.nonzero(full[:, 1:])
        rank[r, c] = self._join(sym[r, c], sym[r, c + 1])[1]
        seed = self._seed(variant)
        keys = np.array([xxhash.xxh64_intdigest(u, seed) for u in map(_raw, names)], dtype=np.uint64)
        rows = np.arange(len(names))
        while len(rows):
            best = rank.argmin(1)
            all_rows = np.arange(len(rows))
            on = rank[all_rows, best] < self.none
            if not on.all():  # the others are finished
                done[rows[~on]] = sym[~on]
                rows, keys, sym, start, rank, best = rows[on], keys[on], sym[on], start[on], rank[on], best[on]
                all_rows = np.arange(len(rows))
                if not len(rows):
                    break
            if self.limit:
                i, j, k = (start[all_rows, np.minimum(best + d, width)].astype(np.int64) for d in (0, 1, 2))
                at = (i << 20 | (j - i) << 10 | (k - j)).astype(np.uint64)
                drop = (((keys ^ at) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(24)) & np.uint64(0xFFFFFFFF) < np.uint64(self.limit)
            else:
                drop = np.zeros(len(rows), dtype=bool)
            joined = np.where(drop, -1, self._join(sym[all_rows, best], sym[all_rows, best + 1])[0])
            # what stands behind a merged pair moves up by one
            moves = (cols > best[:, None]) & ~drop[:, None]
            for x, fill in ((sym, -1), (start, None), (rank, self.none)):
                x[:, :width] = np.where(moves, x[:, 1:], x[:, :width])
                if fill is not None:
                    x[~drop, width] = fill
            go = np.flatnonzero(~drop)
            at, new = best[go], joined[go]
            sym[go, at] = new
            rank[all_rows, best] = self.none
            rank[go, at] = self._join(new, sym[go, at + 1])[1]
            before = np.flatnonzero(at > 0)
            rank[go[before], at[before] - 1] = self._join(sym[go[before], at[before] - 1], new[before])[1]
        sym = done
        used = sym[:, :width] != -1
        ends = np.cumsum(used.sum(1)).tolist()
        flat = sym[:, :width][used]
        raw, known = flat.astype("<u4").tobytes(), self.known[variant]
        known.update(zip(names, map(raw.__getitem__, map(slice, [0, *(4 * y for y in ends)], [4 * y for y in ends]))))
        for i in np.flatnonzero((sym[:, :width] < -1).any(1)).tolist():  # some characters are spelled in bytes
            ids = []
            for s in flat[ends[i - 1] if i else 0:ends[i]].tolist():
                ids += [s] if s >= 0 else [self.byte_id[b] for b in _raw(chr(-2 - s))]
            known[names[i]] = np.array(ids, dtype="<u4").tobytes()

    def _seed(self, variant: int) -> int:
        return (self.seed * 1_000_003 + variant) & (1 << 64) - 1

    def encode_unit(self, unit: str, variant: int) -> list[int]:
        """Ids of one unit."""
        ids, score, limit = self.id_of, self.score, self.limit
        sym, n = list(unit), len(unit)
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        size = [1] * n
        key = xxhash.xxh64_intdigest(_raw(unit), self._seed(variant))
        agenda = []
        for i in range(n - 1):
            if (m := ids.get(sym[i] + sym[i + 1])) is not None:
                agenda.append((-score[m], i, 1, 1))
        heapq.heapify(agenda)
        while agenda:
            _, i, a, b = heapq.heappop(agenda)
            j = right[i] if sym[i] is not None else n
            if j >= n or size[i] != a or size[j] != b:
                continue  # one of the two has since been merged
            if limit and ((key ^ (i << 20 | a << 10 | b)) * 0x9E3779B97F4A7C15 >> 24) & 0xFFFFFFFF < limit:
                continue
            sym[i] += sym[j]
            size[i] = a + b
            sym[j] = None
            right[i] = k = right[j]
            if k < n:
                left[k] = i
                if (m := ids.get(sym[i] + sym[k])) is not None:
                    heapq.heappush(agenda, (-score[m], i, size[i], size[k]))
            if (k := left[i]) >= 0 and (m := ids.get(sym[k] + sym[i])) is not None:
                heapq.heappush(agenda, (-score[m], k, size[k], size[i]))
        out = []
        for s in sym:
            if s is not None:
                if (m := ids.get(s)) is not None:
                    out.append(m)
                else:
                    out += [self.byte_id[x] for x in _raw(s)]
        return out

    def encode(self, texts: list[str], keys: list[str]) -> list[bytes]:
        """Ids of texts, little-endian unsigned 32-bit; ``keys`` tell documents apart. The mark that the model puts before
        a text is put there."""
        if sum(map(len, self.known)) > self.memory:
            for k in self.known:
                k.clear()
        v = self.variants if self.limit else 1
        cut, new = [], [set() for _ in range(v)]
        for text, key in zip(texts, keys):
            units = self.units.findall(MARK + text.replace(" ", MARK)) if text else []
            # a word's n-th coming in the document takes the variant after its (n-1)-th; where it starts depends on the document
            start, later = xxhash.xxh64_intdigest(key, self.seed & (1 << 64) - 1) % v, []
            count = Counter(units)
            if v > 1 and len(count) < len(units):
                many, seen = {u for u, n in count.items() if n > 1}, {}
                for i, u in enumerate(units):
                    if u in many:
                        n = seen.get(u, 0)
                        seen[u] = n + 1
                        if n % v:
                            later.append((i, u, (start + n) % v))
                            new[(start + n) % v].add(u)
            new[start].update(count)
            cut.append((units, start, later))
        for k, units in enumerate(new):
            if units := units.difference(self.known[k]):
                self.learn(list(units), k)
        out = []
        for units, start, later in cut:
            ids = list(map(self.known[start].__getitem__, units))
            for i, u, k in later:
                ids[i] = self.known[k][u]
            out.append(b"".join(ids))
        return out

    def decode(self, ids: bytes) -> str:
        raw = b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))
        return raw[1:].decode("utf-8", "surrogatepass")


def encode_pieces(docs: DataFrame, path: str, rate: float = 0.1, seed: int = 1, variants: int = 4, id_col: str = "doc_id",
                  text_col: str = "text", verify: bool = True) -> DataFrame:
    """(doc_id, ids binary, n_ids, lossless): a text's ids as little-endian unsigned 32-bit numbers, and whether decoding
    them gives the text back (null if ``verify`` is off)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = kept_by_worker(("pieces", path, rate, seed, variants), lambda: Pieces(path, rate, seed, variants))
        for b in batches:
            for i in range(0, b.num_rows, 200):
                part = b.slice(i, 200)
                texts = [x or "" for x in part.column(1).to_pylist()]
                ids = p.encode(texts, [str(k) for k in part.column(0).to_pylist()])
                same = [p.decode(e) == t for e, t in zip(ids, texts)] if verify else [None] * len(ids)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), pa.array([len(e) // 4 for e in ids], pa.int64()),
                                                  pa.array(same, pa.bool_())], ["doc_id", "ids", "n_ids", "lossless"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids binary, n_ids long, lossless boolean")


def decode_pieces(coded: DataFrame, path: str, ids_col: str = "ids", out_col: str = "text") -> DataFrame:
    """``coded`` (doc_id and ids) with the decoded text; null ids give a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Pieces(path)
        for b in batches:
            texts = [None if x is None else p.decode(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", out_col])

    return coded.select("doc_id", ids_col).mapInArrow(run, f"doc_id long, `{out_col}` string")
