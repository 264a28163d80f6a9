import random
import re
from collections import Counter

import pytest

from murmur.llm import lines


def plain(docs, min_words):
    """The definition: windows of at least min_words words, shortest ones, that occur earlier."""
    word = re.compile(r"[^\x20\x09-\x0D]+")
    first, found, out = {}, [], {}
    order = sorted({d for d in docs if d[1] is not None}, key=lambda d: (d[0] is None, d[0] or 0))
    for d in order:
        rows = [(i, x, len(word.findall(x))) for i, x in enumerate(d[1].split("\n"))]
        rows = [r for r in rows if r[2]]
        for a in range(len(rows)):
            n = 0
            for b in range(a, len(rows)):
                n += rows[b][2]
                if n >= min_words:
                    run = tuple(r[1] for r in rows[a:b + 1])
                    first.setdefault(run, (d, rows[a][0]))
                    if first[run] != (d, rows[a][0]):
                        found.append((d, rows[a][0], rows[b][0]))
    gone = Counter()
    drop = {d: set() for d in order}
    for d, a, b in found:
        drop[d] |= set(range(a, b + 1))
    for d in order:  # lines without a word between two lines that go
        xs = d[1].split("\n")
        full = [i for i, x in enumerate(xs) if word.search(x)]
        for a, b in zip(full, full[1:]):
            if a in drop[d] and b in drop[d]:
                drop[d] |= set(range(a, b))
    for d in order:
        xs = d[1].split("\n")
        out[d] = "\n".join(x for i, x in enumerate(xs) if i not in drop[d])
        gone[d] = len(drop[d])
    return out, gone


def check(make, docs, min_words):
    table = make(docs, 3)
    got, info = lines.dedup_lines(table, min_words)
    assert got.columns == [*table.columns, info]
    want, gone = plain(docs, min_words)
    rows = Counter((r.doc_id, r.text, r[info].n_lines, r[info].n_deleted) for r in got.collect())
    assert rows == Counter((i, None, 0, 0) if t is None else (i, want[i, t], len(t.split("\n")), gone[i, t]) for i, t in docs)


@pytest.mark.parametrize("seed", range(5))
def test_random_runs_against_brute_force(make, seed):
    rng = random.Random(seed)
    pool = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 5))) for _ in range(12)]
    docs = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 25)))) for i in range(40)]
    for i in range(10):  # long shared blocks in different places
        t = docs[i][1].split("\n")
        a = rng.randrange(len(t))
        docs.append((100 + i, "\n".join([rng.choice(pool), *t[a:a + 9], rng.choice(pool)])))
    check(make, docs, 7)


def test_passages_and_copies(make):
    one = " ".join(f"p{i}" for i in range(56))
    many = "\n".join(" ".join(f"q{i}x{k}" for k in range(12)) for i in range(5))
    own = lambda i: f"line of {i} alone {i * i}"
    docs = [(1, f"{own(1)}\n{one}\n{own(-1)}"), (2, f"{one}\n{own(2)}"), (3, f"{own(3)}\n\n{many}\n{own(33)}"), (4, f"{own(4)}\n{many}"),
            (5, f"{own(1)}\nshort line"), (6, f"{own(1)}\nshort line"), (7, f"{own(1)}\n{one}\n{own(-1)}")]
    got, info = lines.dedup_lines(make(docs), 50)
    text = {r.doc_id: r.text for r in got.collect()}
    assert text == {1: docs[0][1], 2: own(2), 3: docs[2][1], 4: own(4), 5: docs[4][1], 6: docs[5][1], 7: ""}
    check(make, docs, 50)


def test_odd_rows(make, odd):
    check(make, odd, 3)
    check(make, odd + [(None, "no id at all here"), (11, "\n".join(["x y z"] * 200)), (12, "x y z\n\n \nx y z\n"), (7, "other\ntext of 7")], 3)


def test_empty_table(make):
    assert lines.dedup_lines(make([]).limit(0))[0].collect() == []


def test_first_occurrences_stay(make):
    """No line vanishes from the corpus."""
    rng = random.Random(8)
    docs = [(i, "\n".join(" ".join(rng.choice("ab") for _ in range(2)) for _ in range(20))) for i in range(20)]
    got, _ = lines.dedup_lines(make(docs), 4)
    left = {x for r in got.collect() for x in r.text.split("\n")}
    assert {x for _, t in docs for x in t.split("\n")} <= left
