import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from murmur.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def plain_ids(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [1]


def test_encoder_is_the_tokenizer():
    tk = Tokenizer.from_file(PATH)
    texts = ["", "Hello, World!! it's a <|endoftext|> test<|startoftext|>", "naïve Ümlaut... İstanbul ΣΑΣ éa Å", "a b\tc\n\n d\x1ce",
             "12 3a b4,c.d", "x" * 700, "中文 文字, ok... don't 'quoted' (yes) $$$ the&&& re!! AB.CD ,. ퟿ ", "ſ K ﬁ ½ ² ß", "á , ́b"]
    texts += [t * 3 for t in texts]
    encode = packing.word_encoder(PATH, cache_size=20)
    for _ in range(2):
        assert [np.frombuffer(e, "<u4").tolist() for e in encode(texts)] == [tk.encode(t, add_special_tokens=False).ids for t in texts]


def rebuilt(rows, size=2048):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
        assert r.length == len(r.ids) // 4 > 0
    padding = 0
    for s in by_seq.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
    return by_doc, by_seq, padding


def test_round_trip_of_odd_rows(make, odd):
    rows = packing.pack(make(odd), lambda: packing.word_encoder(PATH)).collect()
    by_doc, _, _ = rebuilt(rows)
    texts = defaultdict(list)
    for i, t in odd:
        texts[i].append(plain_ids(t))
    for i, want in texts.items():
        got = by_doc[i]
        assert sum(r.length for r in got) == sum(map(len, want))
        if len(want) == 1:
            got.sort(key=lambda r: r.start)
            assert [r.start for r in got] == np.cumsum([0] + [r.length for r in got])[:-1].tolist()
            assert np.frombuffer(b"".join(r.ids for r in got), "<u4").tolist() == want[0]
            assert {r.doc_tokens for r in got} == {len(want[0])}
            assert zlib.crc32(got[0].ids) == zlib.crc32(np.array(want[0][:got[0].length], dtype="<u4").tobytes())


def test_empty_table(make):
    assert packing.pack(make([]).limit(0), lambda: packing.word_encoder(PATH)).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_level_choice_is_the_best_one(seed):
    """Each document goes where the sum of squared counts of partly filled windows becomes smallest."""
    rng, size = np.random.default_rng(seed), 64
    p = packing.Packer(size)
    for d in range(400):
        n = int(rng.integers(1, 50))
        before = p.counts.copy()
        for _ in p.place(d, b"\0" * 4 * n):
            pass
        after = p.counts.copy()

        def cost(level):
            c = before.copy()
            if level:
                c[level] -= 1
            if level + n < size:
                c[level + n] += 1
            return int((c[1:size] ** 2).sum())
        options = [cost(h) for h in range(size - n + 1) if h == 0 or before[h]]
        assert int((after[1:size] ** 2).sum()) == min(options)
        assert all(len(p.open.get(h, [])) == after[h] for h in range(1, size))


@pytest.mark.parametrize("seed", range(6))
def test_close_leaves_little_padding_and_loses_nothing(seed):
    rng, size = np.random.default_rng(seed), 128
    p, out, want = packing.Packer(size), [], {}
    for d in range(int(rng.integers(0, 60))):
        want[d] = int(rng.integers(1, 400))
        out += list(p.place(d, np.arange(want[d], dtype="<u4").tobytes()))
    out += list(p.close())
    got, partly = defaultdict(list), 0
    for w in out:
        n = sum(len(x[2]) // 4 for x in w)
        assert n <= size
        partly += n < size and n & (n - 1) != 0
        for doc, start, ids, total in w:
            assert total == want[doc]
            got[doc].append((start, np.frombuffer(ids, "<u4").tolist()))
    assert partly <= 1
    for d, n in want.items():
        assert [x for _, part in sorted(got[d]) for x in part] == list(range(n))


def test_words_are_learned_once_whatever_their_case_and_the_first_stay(monkeypatch):
    """Case and marks make no word new to the tokenizer, letters are not normalised one by one, and a full memory keeps what it met first."""
    bare, learned = packing._bare, []

    class Seen:
        def __init__(self, tk):
            self.tk = bare(tk)

        def encode_batch_fast(self, texts, **how):
            learned.append(texts[0])
            return self.tk.encode_batch_fast(texts, **how)

    monkeypatch.setattr(packing, "_bare", Seen)
    tk = Tokenizer.from_file(PATH)
    encode = packing.word_encoder(PATH, cache_size=20)
    letters = [chr(c) for c in [*range(0x41, 0x5b), *range(0x61, 0x7b), *range(0xc0, 0x100)] if c not in (0xd7, 0xf7)]
    for t in ["The the THE, the! Été été", " ".join(f"{a}{b}{a}" for a in letters for b in letters), "été THE? (the) thé"]:
        assert np.frombuffer(encode([t])[0], "<u4").tolist() == tk.encode(t, add_special_tokens=False).ids
    words = [w for t in learned for w in t.split(" ")]
    assert sorted(words[:2]) == sorted(["the", "Ã©tÃ©"]) and words[-1:] == ["thÃ©"]
    assert len(words) == len(set(words))
    monkeypatch.undo()
    tk.normalizer = None
    assert packing._bare(tk) is None
