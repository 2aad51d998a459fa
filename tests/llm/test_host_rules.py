"""Operator 4 against plain counting."""

import random
import re

from tarnish.llm.host_rules import host_rates, host_rules, measure


def plainly(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), dup, len(twice)


def test_measures():
    r = random.Random(2)
    for _ in range(1500):
        text = "".join(r.choice(["a", "b", "é", " ", "\n", "\t", "\x1c", " ", "#", "<", "\x0b", "word "]) for _ in range(r.randint(0, 40)))
        assert measure(text) == plainly(text)
    assert measure(None) == (0, 0, 0, 0, 0, 0)


def test_verdicts(docs_of, spark, odd, odd_rows, empty):
    good = " ".join(f"w{i}" for i in range(60))
    noisy = " ".join(f"w{i}#" for i in range(60))
    rows = [(i, "source-a", good) for i in range(40)] + [(100 + i, "source-b", "short" if i < 30 else good) for i in range(40)]
    rows += [(200, "source-a", noisy), (201, "source-b", noisy), (202, "source-b", good), (203, None, good), (204, "tiny", "short")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = {r.doc_id: r for r in host_rules(docs).collect()}
    assert len(out) == len(rows)
    # A good document stays on a bad host; one that breaks a rule stays only where the host is trusted.
    assert out[0].kept and out[200].kept and out[202].kept and out[203].kept
    assert not out[201].kept and not out[100].kept and not out[204].kept
    # One document does not make a host bad: the prior draws it to the others.
    assert out[204].host_rate < 1 and out[0].host_rate < out[100].host_rate
    strict = {r.doc_id: r.kept for r in host_rules(docs, reject_rate=0.7).collect()}
    assert not strict[202] and strict[0]
    assert host_rules(empty).collect() == []
    assert host_rules(odd).count() == len(odd_rows)


def test_rates_lie_between_the_raw_rate_and_the_mean(spark):
    rows = [(h, i < f) for h, n, f in (("a", 100, 10), ("b", 100, 60), ("c", 2, 2), ("d", 50, 0)) for i in range(n)]
    rates = {r.host: (r.failed / r.n, r.rate) for r in host_rates(spark.createDataFrame(rows, "host string, any_failed boolean")).collect()}
    mean = sum(f for _, f in rows) / len(rows)
    for raw, rate in rates.values():
        assert min(raw, mean) <= rate <= max(raw, mean)
    assert rates["c"][1] < 0.9 < rates["c"][0]
