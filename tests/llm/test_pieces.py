import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from murmur.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", " ", "  two  spaces ", "line\nfeed\r\ttab", "中文 \U0001f600 ünï", "<s> </s> <unk> <0x41>", "x" * 200, "The theatre " * 30, "éÅ",
         "mixed" + "\n" * 5 + "  end  "]


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


def test_without_dropout_it_is_the_model():
    sp, p = sentencepiece.SentencePieceProcessor(model_file=PATH), pieces.Pieces(PATH, rate=0.0)
    assert [ids(x) for x in p.encode(TEXTS, ["1"] * len(TEXTS))] == [sp.encode(t) for t in TEXTS]


@pytest.mark.parametrize("rate", [0.1, 0.5, 1.0])
def test_lossless_and_the_same_as_one_unit_at_a_time(rate):
    p = pieces.Pieces(PATH, rate=rate, seed=9)
    got = p.encode(TEXTS, [str(i) for i in range(len(TEXTS))])
    assert [p.decode(x) for x in got] == TEXTS
    assert all(ids(raw) == p.encode_unit(unit, v) for v, known in enumerate(p.known) for unit, raw in known.items())
    assert got == pieces.Pieces(PATH, rate=rate, seed=9, memory=1).encode(TEXTS, [str(i) for i in range(len(TEXTS))])


def test_seeds_and_documents_vary_and_rate_counts():
    text = "internationalisation of considerable understanding " * 40
    a, b = (pieces.Pieces(PATH, 0.2, s).encode([text], ["1"])[0] for s in (1, 2))
    assert a != b and pieces.Pieces(PATH, 0.2, 1).encode([text], ["2"])[0] != a
    sizes = [len(pieces.Pieces(PATH, r, 1).encode([text], ["1"])[0]) for r in (0.0, 0.1, 0.4, 1.0)]
    assert sizes == sorted(sizes) and sizes[0] < sizes[2] < sizes[3]
    singles = ids(pieces.Pieces(PATH, 1.0, 1).encode(["abc"], ["1"])[0])
    assert len(singles) == 4  # the mark and three letters


def test_odd_rows(make, odd):
    coded = pieces.encode_pieces(make(odd), PATH, rate=0.1)
    rows = coded.collect()
    assert len(rows) == len(odd) and all(r.lossless and r.n_ids == len(r.ids) // 4 for r in rows)
    back = sorted(((r.doc_id is None, r.doc_id or 0, r.text) for r in pieces.decode_pieces(coded, PATH).collect()))
    assert back == sorted((i is None, i or 0, t or "") for i, t in odd)
    assert pieces.encode_pieces(make([]).limit(0), PATH).collect() == []
