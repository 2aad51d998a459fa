"""Operator 3 against patterns as they are stated, and entropy counted anew for each window."""

import math
import random
import re
from collections import Counter

import pytest

from tarnish.llm.secret_scan import CLASSES, Scanner, dense_windows, merged, redact, scan_secrets

STATED = {
    "assign": (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
    "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
}


def stated(text):
    kinds = list(STATED)
    found = [(m.start(), kinds.index(k), m.end()) for k, (p, ok) in STATED.items() for m in re.finditer(p, text or "") if ok(m)]
    return [(kinds[k], a, b) for a, k, b in sorted(found)]


def entropy(s):
    return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values())


def test_base_spans_as_stated():
    r = random.Random(5)
    parts = ["token", "API_KEY", "apikey", "Secret", "ſecret", "passwd", ":", "=", " = ", '"', "'", "abc", "abcdef", "AKIA", "ABCDEFGHIJKLMNOP", "deadbeef" * 3, "0123456789abcdef", " ", "\n", "é"]
    scanner = Scanner()
    for _ in range(4000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 12)))
        assert [s for s in scanner.spans(text) if s[0] != "entropy"] == stated(text)


def test_incremental_entropy_is_the_entropy():
    r = random.Random(6)
    for c in CLASSES:
        for _ in range(200):
            run = "".join(r.choice("0123456789abcdefGHIJKLMNOPqrstuv"[: r.randint(2, 32)]) for _ in range(r.randint(5, 80)))
            windows = [(i, i + c.window) for i in range(len(run) - c.window + 1) if entropy(run[i : i + c.window]) >= c.bits - 1e-9]
            assert dense_windows(run, c.window, c.bits) == merged(windows)


def test_entropy_finds_keys_and_leaves_allowed_strings():
    scanner = Scanner()
    key = "x9Kf83hQzL0pVbN2mR7tYw1Z"
    assert [s for s in scanner.spans(f"a {key} b") if s[0] == "entropy"]
    for calm in ("internationalization_of_everything", "123e4567-e89b-12d3-a456-426614174000", "1234567890" * 4, "path/to/some/file/with/many/parts", "=" * 60, "a" * 500):
        assert not [s for s in scanner.spans(f"a {calm} b") if s[0] == "entropy"], calm


def test_runs_of_one_character():
    assert Scanner().entropy_spans("aB1" + "x" * 300) == [] == dense_windows("z" * 50, 20, 3.0)


def random_tokens(alphabet, size, n=1000, tail=0):
    r = random.Random(f"{alphabet}{size}{tail}")
    return ["".join(r.choices(alphabet, k=size)) + "".join(r.choices("0123456789", k=tail)) for _ in range(n)]


LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


@pytest.mark.parametrize("size", [20, 32])
@pytest.mark.parametrize("alphabet", [LOWER + DIGITS, UPPER + "234567", LOWER + UPPER + DIGITS, LOWER + UPPER])
def test_random_tokens_are_found(alphabet, size):
    scanner = Scanner()
    for tail in (0, 3):
        found = sum(bool(scanner.entropy_spans(f"a {t} b")) for t in random_tokens(alphabet, size, tail=tail))
        assert found >= 970, (alphabet, size, tail, found)


@pytest.mark.parametrize("alphabet", [LOWER + DIGITS, UPPER + "234567", LOWER + UPPER + DIGITS])
def test_found_tokens_are_found_whole(alphabet):
    scanner = Scanner()
    for size in (32, 40, 64):
        for t in random_tokens(alphabet, size, 300):
            assert scanner.entropy_spans(f"a {t} b") in ([], [(2, 2 + size)])


def test_redaction_leaves_no_piece_of_a_token(docs_of):
    tokens = random_tokens(LOWER + DIGITS, 64, 50)
    out = redact(docs_of([(i, f"see {t} here") for i, t in enumerate(tokens)])).collect()
    assert {r.text for r in out} == {"see [secret] here"}


def test_words_of_clean_texts_are_left():
    scanner = Scanner()
    r = random.Random(9)
    words = "the people of this small country have always found their way through mountains and long rivers without asking strangers about distance".split()
    for _ in range(2000):
        some = r.choices(words, k=r.randint(3, 9))
        for calm in ("_".join(some), "-".join(some).upper(), "".join(w.title() for w in some if len(w) > 2), "/".join(w.title() for w in some), "".join(some) + "2024"):
            assert not scanner.entropy_spans(f"a {calm} b"), calm
    for calm in ("Rechtsschutzversicherungsgesellschaften", "anticonstitutionnellement", "src/main/java/org/example/ClassLoader", "SOME_CONSTANT_NAME_OF_LENGTH_7"):
        assert not scanner.entropy_spans(f"a {calm} b"), calm


def test_redact(docs_of, spark, odd, odd_rows, empty):
    docs = docs_of([(1, 'my token = "abcdef123" here'), (2, "clean"), (3, None), (2, "clean")])
    out = redact(docs)
    assert out.schema == docs.schema
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[1].text == "my [secret] here".replace("[secret]", '[secret]"') and rows[1].n_chars == len(rows[1].text)
    assert rows[2].text == "clean" and rows[3].text is None and out.count() == 4
    # What is marked is no secret any more.
    assert all(not r.spans for r in scan_secrets(out).collect())
    assert sorted(map(str, redact(odd).collect())) == sorted(map(str, odd.collect()))
    assert redact(empty).collect() == [] and scan_secrets(empty).collect() == []
    assert scan_secrets(odd).count() == len(odd_rows)
