"""Sum-of-squares online packing of tokenised documents into fixed windows.

Each task packs the documents of its own partition as they come. A document of more than ``size``
tokens gives whole windows first; what is left of it goes, whole, to the fill level that makes the
sum of squared counts of partly filled windows smallest (a new window is one of the choices; ties go
to the fullest level). The counts are kept in an array indexed by level. At the end of a partition
the windows that are still open are merged: the fullest are filled up with cuts from the emptiest, and
the one window that may then remain is cut into lengths that are powers of two, which need no padding.
Open windows are all that a task holds.

Defined results: a null text counts as empty and gives the end token alone; documents with a null id
and repeated rows are packed like any other; an empty table gives no pieces. A piece's sequence_id
holds the partition in its upper 31 bits; it is the same whenever a task is run again."""

from __future__ import annotations

import codecs
import json
import os
import re
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIZE = 2048
END_ID = 1
#: A line that is letters which stand for themselves under canonical composition, then ASCII marks but the apostrophe: to the
#: tokenizer a run of either is one word.
_PLAIN = r"^([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)$"
#: What byte-level tokenizers make of each byte; ASCII but the control characters and spaces stands for itself.
_BYTE_LEVEL = "".join(chr(b + 162 if 0x80 <= b <= 0xA0 else 0x143 if b == 0xAD else b) for b in range(256))
#: Tokenizers whose normaliser does nothing to letters of ``_PLAIN`` but fold their case, and which cut such words as bytes.
_FOLDING = (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"])


def _bare(tk):
    """A tokenizer with the model of ``tk`` alone, for words of ``_PLAIN`` letters in lower case that are spelled as bytes already: the same ids
    without normalising each character. None if ``tk`` has other steps than those this is known of."""
    from tokenizers import Tokenizer, pre_tokenizers
    steps = [json.loads(part.__getstate__()) if part is not None else {} for part in (tk.normalizer, tk.pre_tokenizer)]
    norms, cuts = steps[0].get("normalizers", []), steps[1].get("pretokenizers", [])
    if tuple([x["type"] for x in part] for part in (norms, cuts)) != _FOLDING or cuts[1]["add_prefix_space"] or cuts[1]["use_regex"]:
        return None
    bare = Tokenizer(tk.model)
    bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    return bare


def word_encoder(path: str, cache_size: int = 1_000_000) -> Callable[[list[str]], list[bytes]]:
    """Encoder of whole texts by the tokenizer file at ``path``: little-endian unsigned 32-bit ids, without
    special tokens. Texts are cut at spaces and line feeds, which the tokenizer drops, so ids of
    the cuts can be remembered; the memory of them is bounded."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tk = Tokenizer.from_file(path)
    suffix = getattr(tk.model, "end_of_word_suffix", None)
    n_ids = max(tk.get_vocab().values()) + 1
    ends = np.zeros(n_ids, dtype=bool)
    if suffix:
        ends[[i for t, i in tk.get_vocab().items() if t.endswith(suffix)]] = True
    known: dict[str, bytes] = {"": b""}
    plain = re.compile(_PLAIN, re.MULTILINE)
    bare = _bare(tk) if suffix else None

    def whole(words: list[str]) -> None:
        for w, e in zip(words, tk.encode_batch_fast(words, add_special_tokens=False)):
            known[w] = np.array(e.ids, dtype="<u4").tobytes()

    def learn(words: set[str]) -> None:
        if not suffix:
            return whole(list(words))
        found = plain.findall("\n".join(words))  # no word holds a line feed
        low = [c.lower() if bare else c for c, _ in found]  # words that differ in case alone are one
        cores = [c for c in dict.fromkeys(low) if c not in known]
        if cores:
            # one text of all of them: its words end where the suffix is
            text = " ".join(cores)
            if bare:
                text = codecs.charmap_decode(text.encode(), "strict", _BYTE_LEVEL)[0]
            ids = np.array((bare or tk).encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
            at = np.flatnonzero(ends[ids]) + 1
            if len(at) == len(cores):
                raw, at = ids.tobytes(), (at * 4).tolist()
                known.update(zip(cores, map(raw.__getitem__, map(slice, [0, *at], at))))
            else:
                whole(cores)
        marks = [m for m in {m for _, m in found} if m not in known]
        if marks:
            whole(marks)
        known.update([(c + m, known[k] + known[m]) for (c, m), k in zip(found, low)])
        rest = [w for w in words if w not in known]
        if rest:
            whole(rest)

    def encode(texts: list[str]) -> list[bytes]:
        if len(known) > cache_size:  # the words met first, which the frequent ones are among, stay
            first = list(islice(known.items(), cache_size // 2))
            known.clear()
            known.update(first)
        cut = [t.replace("\n", " ").split(" ") for t in texts]
        new = set().union(*cut).difference(known)
        if new:
            learn(new)
        return [b"".join(map(known.__getitem__, c)) for c in cut]

    return encode


class Packer:
    """One partition's windows. ``place`` and ``close`` give finished windows: lists of (doc, start, ids, total)."""

    def __init__(self, size: int = SIZE):
        self.size = size
        self.counts = np.zeros(size + 1, dtype=np.int64)  # open windows at each fill level
        self.open: dict[int, list[list]] = {}

    def place(self, doc, ids: bytes) -> Iterator[list]:
        total, cut = len(ids) // 4, self.size * 4
        whole = total // self.size
        for k in range(whole):
            yield [(doc, k * self.size, ids[k * cut:(k + 1) * cut], total)]
        rest = total - whole * self.size
        if rest:
            piece, n = (doc, whole * self.size, ids[whole * cut:], total), self.counts
            levels = np.flatnonzero(n[1:self.size - rest + 1]) + 1
            after = levels + rest
            change = 1 - 2 * n[levels] + np.where(after < self.size, 2 * n[after] + 1, 0)
            level = 0
            if len(levels):
                k = len(levels) - 1 - int(np.argmin(change[::-1]))
                if change[k] <= 2 * n[rest] + 1:
                    level = int(levels[k])
            window = [piece]
            if level:
                window = self.open[level].pop()
                window.append(piece)
                n[level] -= 1
            if level + rest == self.size:
                yield window
            else:
                self.open.setdefault(level + rest, []).append(window)
                n[level + rest] += 1

    def close(self) -> Iterator[list]:
        left = [(level, w) for level in sorted(self.open, reverse=True) for w in self.open[level]]
        self.open, pieces = {}, [p for _, w in left for p in w]
        fill = sum(level for level, _ in left)
        i, j = 0, len(left) - 1
        spare: list = []  # pieces of the emptiest windows, last first
        while fill >= self.size:
            level, window = left[i]
            i += 1
            need = self.size - level
            while need:
                if not spare:
                    spare = left[j][1][::-1]
                    j -= 1
                piece = spare.pop()
                head, tail = _cut(piece, need)
                window.append(head)
                need -= len(head[2]) // 4
                if tail:
                    spare.append(tail)
            fill -= self.size
            yield window
        last = [p for _, w in left[i:j + 1] for p in w] + spare[::-1]
        bits = [1 << b for b in range(self.size.bit_length(), -1, -1) if fill >> b & 1] if fill < 0.97 * self.size else [fill]
        del pieces
        for n in bits:
            window = []
            while n:
                head, tail = _cut(last.pop(0), n)
                window.append(head)
                n -= len(head[2]) // 4
                if tail:
                    last.insert(0, tail)
            if window:
                yield window


def _cut(piece: tuple, n: int) -> tuple[tuple, tuple | None]:
    doc, start, ids, total = piece
    if len(ids) <= 4 * n:
        return piece, None
    return (doc, start, ids[:4 * n], total), (doc, start + n, ids[4 * n:], total)


PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, make_encoder: Callable[[], Callable[[list[str]], list[bytes]]], size: int = SIZE,
         end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", group: int = 64) -> DataFrame:
    """Pieces of all documents: ``ids`` are a piece's tokens (unsigned 32-bit, little-endian), ``start`` is where it
    starts among its document's tokens, ``offset`` where it starts in its sequence."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = make_encoder(), Packer(size)
        shard, made = TaskContext.get().partitionId() << 32, 0
        rows: list[tuple] = []

        def add(window: list) -> None:
            nonlocal made
            offset = 0
            for doc, start, ids, total in window:
                rows.append((doc, start, len(ids) // 4, ids, total, shard + made, offset))
                offset += len(ids) // 4
            made += 1

        def out() -> pa.RecordBatch:
            cols = list(zip(*rows))
            rows.clear()
            kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 3
            names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names)

        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1)
            for i in range(0, len(ids), group):
                part = [t or "" for t in texts[i:i + group].to_pylist()]
                for doc, e in zip(ids[i:i + group], encode(part)):
                    for w in packer.place(doc, e + end):
                        add(w)
                if len(rows) >= 2000:
                    yield out()
        for w in packer.close():
            add(w)
        if rows:
            yield out()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, PIECES)
