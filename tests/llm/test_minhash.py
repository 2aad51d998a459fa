"""The pipeline's near copies against all pairs."""

import random

import pytest

from tarnish.llm.minhash import links_within, shingle_set
from tarnish.llm.simhash import drop_near_copies


def plainly(text):
    words = text.lower().split()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def roots(n, pairs):
    of = list(range(n))
    for i, j in pairs:
        low, high = sorted((of[i], of[j]))
        of = [low if x == high else x for x in of]
    return of


def varied(r, bases, copies, words=120, most=9):
    """Texts with up to ``most`` changed words, so that similarities lie on both sides of 0.8."""
    out = []
    for _ in range(bases):
        base = [f"w{r.randrange(3000)}" for _ in range(words)]
        for _ in range(copies):
            own = list(base)
            for i in r.sample(range(words), r.randint(0, most)):
                own[i] = f"x{r.randrange(10**6)}"
            out.append(" ".join(own))
    return out


def kept_by_all_pairs(texts):
    sets = [plainly(t) for t in texts]
    near = [(i, j) for i in range(len(texts)) for j in range(i) if jaccard(sets[i], sets[j]) >= 0.8]
    assert any(0.8 <= jaccard(sets[i], sets[j]) < 0.85 and i != j for i, j in near)
    return set(roots(len(texts), near))


@pytest.mark.parametrize(("bases", "copies"), [(40, 6), (1, 150)])
def test_pipeline_keeps_no_copy_of_similarity_four_fifths(docs_of, bases, copies):
    texts = varied(random.Random(bases), bases, copies)
    got = {r.doc_id for r in drop_near_copies(docs_of(list(enumerate(texts)))).collect()}
    assert got == kept_by_all_pairs(texts)


def test_links_within_join_what_all_pairs_join():
    import numpy as np

    r = random.Random(8)
    for _ in range(20):
        texts = list(dict.fromkeys(varied(r, 3, 12, 60, 5)))
        sets = [shingle_set(t) for t in texts]
        plain = [plainly(t) for t in texts]
        assert [len(s) for s in sets] == [len(s) for s in plain]
        near = [(i, j) for i in range(len(texts)) for j in range(i) if jaccard(plain[i], plain[j]) >= 0.8]
        known = [p for p in near if r.random() < 0.3]
        own = roots(len(texts), known)
        found = links_within(np.arange(len(texts)), np.array(own), sets)
        assert set(found) <= {(a, b) for p in near for a, b in (p, p[::-1])}
        assert roots(len(texts), known + found) == roots(len(texts), near)
