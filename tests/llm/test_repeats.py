"""Operator 10 against every window, and suffix arrays against sorting."""

import random

import pytest

from tarnish.llm.repeats import remove_repeats
from tarnish.llm.suffixes import Texts, earlier_windows, permuted_common_prefixes, suffix_array


def plainly(rows, size):
    seen, out = set(), []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        b = (t or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - size + 1):
            if b[i : i + size] in seen:
                gone[i : i + size] = [True] * size
            seen.add(b[i : i + size])
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(b), sum(gone), spans, bytes(c for c, g in zip(b, gone, strict=True) if not g)))
    return sorted(out, key=str)


def removed(docs, **settings):
    return sorted(((*r[:4], bytes(r[4])) for r in remove_repeats(docs, **settings).collect()), key=str)


def test_suffix_arrays():
    r = random.Random(3)
    for _ in range(800):
        letters = r.choice([1, 2, 3, 30])
        parts = [bytes(r.randrange(letters) for _ in range(r.randint(0, 12))) for _ in range(r.randint(1, 8))]
        texts = Texts(parts)
        signs = []
        for k, p in enumerate(parts):
            signs += [1000 + x for x in p] + [k]
        order = sorted(range(len(signs)), key=lambda i: signs[i:])
        assert suffix_array(texts).tolist() == order
        prefixes = permuted_common_prefixes(texts, suffix_array(texts))
        for a, b in zip(order, order[1:], strict=False):
            n = 0
            while a + n < len(signs) and b + n < len(signs) and signs[a + n] == signs[b + n]:
                n += 1
            assert prefixes[b] == n


def test_earlier_windows_of_long_runs():
    parts = [b"ab" * 200, b"a" * 300, b"", b"ab" * 100 + b"c"]
    for size in (2, 50, 150):
        seen, wanted = set(), []
        for i, p in enumerate(parts):
            for k in range(len(p) - size + 1):
                if p[k : k + size] in seen:
                    wanted.append((i, k))
                seen.add(p[k : k + size])
        part, offset = earlier_windows(parts, size)
        assert list(zip(part.tolist(), offset.tolist(), strict=True)) == wanted


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_all_windows(docs_of, seed):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 6))) for _ in range(r.choice([3, 50]))]
    phrases = [" ".join(r.choice(words) for _ in range(r.randint(5, 60))) for _ in range(6)]

    def part():
        kind = r.randrange(4)
        return r.choice(phrases) if kind == 0 else "x" * r.randint(0, 300) if kind == 1 else r.choice(phrases)[: r.randint(0, 150)] if kind == 2 else " ".join(r.choice(words) for _ in range(r.randint(0, 80)))

    rows = [(i, "".join(part() for _ in range(r.randint(0, 5)))) for i in range(60)]
    rows += [(None, "a"), (None, phrases[0] * 2), (5, phrases[1]), (7, rows[7][1]), (70, None), (71, ""), (72, "y" * 2000)]
    docs = docs_of(rows)
    for size, gram in ((100, 40), (20, 8)):
        wanted = plainly(rows, size)
        # Groups, sorts and crowds of all sizes give the same.
        for settings in ({}, {"group_bytes": 400, "sort_bytes": 100, "crowd": 1}, {"group_bytes": 3000, "crowd": 3}):
            assert removed(docs, size=size, gram=gram, **settings) == wanted


def test_long_documents_are_cut_without_loss(docs_of, monkeypatch):
    r = random.Random(9)
    from tarnish.llm import repeats

    text = "".join(r.choice("abcdefgh ") for _ in range(3000))
    rows = [(1, text), (2, text[500:900] + "zz" + text[1000:2500]), (3, text[::-1])]
    pieces = repeats._pieces
    whole = repeats.Anchors(*repeats.utf8(__import__("pyarrow").array([text])))
    monkeypatch.setattr(repeats, "_pieces", lambda at, size: pieces(at, size, 700))
    cut = repeats.Anchors(*repeats.utf8(__import__("pyarrow").array([text])))
    assert cut.count.sum() == whole.count.sum() == len(text) - 99
    assert set(cut.hash.tolist()) == set(whole.hash.tolist())
    assert removed(docs_of(rows)) == plainly(rows, 100)


def test_odd_tables(odd, odd_rows, empty):
    got = removed(odd)
    assert got == plainly(odd_rows, 100) and len(got) == len(odd_rows)
    assert remove_repeats(empty).collect() == []
