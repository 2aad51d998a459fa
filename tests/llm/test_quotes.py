"""Operator 9 on small conversations."""

import random
import re
from collections import defaultdict

from tarnish.llm.quotes import link_quotes, normal, parse

SCHEMA = "conv_id long, turn long, role string, text string"


def linked(spark, rows):
    return {(r.conv_id, r.turn): r for r in link_quotes(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_parse():
    text = "On Monday A wrote:\n> first line\n> second\n> > deeper\n>> deeper still\nmy answer\n> again\nend"
    own, passages = parse(text)
    assert own == "my answer\nend"
    assert passages == [(1, ["first line", "second"]), (2, ["deeper", "deeper still"]), (1, ["again"])]
    assert parse("a > b") == ("a > b", []) and parse(None) == (None, []) and parse("") == ("", [])
    assert normal("  «Hello,   World!» ") == "hello, world"


def test_replies(spark):
    rows = [
        (1, 0, "user", "How are you?\n\nTell me more."),
        (1, 1, "assistant", "> How are  YOU?\n\nI am well.\nThank you."),
        (1, 2, "user", "something else"),
        (1, 3, "user", "> I am well.\n> > How are you?\nGood."),
        (1, 4, "user", "> Good.\n> not said by anyone\nLast"),
        (2, 0, "user", "I am well."),
        (2, 1, "user", "> Thank you.\nnot here"),
    ]
    got = linked(spark, rows)
    assert {k: (r.parent_turn, r.root_turn, r.depth) for k, r in got.items()} == {
        (1, 0): (None, 0, 0),
        (1, 1): (0, 0, 1),
        (1, 2): (None, 2, 0),
        (1, 3): (1, 0, 2),
        (1, 4): (3, 0, 3),
        (2, 0): (None, 0, 0),
        (2, 1): (None, 1, 0),
    }
    assert got[1, 3].text == "Good." and got[1, 3].n_passages == 2 and got[1, 3].n_linked == 2 and got[1, 3].levels == 2
    assert got[2, 1].n_passages == 1 and got[2, 1].n_linked == 0


def test_long_chain(spark):
    rows = [(7, 0, "user", "line number 0")] + [(7, i, "user", f"> line number {i - 1}\nline number {i}") for i in range(1, 40)]
    got = linked(spark, rows)
    assert all(got[7, i].depth == i and got[7, i].root_turn == 0 for i in range(40))


def test_odd_rows(spark):
    rows = [(None, 0, None, "hello there"), (None, 1, "user", "> hello there\nyes"), (3, None, "user", "> hello there"), (3, 1, "user", None)]
    rows += [(4, 0, "user", "same words"), (4, 1, "user", "> same words"), (4, 1, "user", "> same words"), (4, 1, "user", "other")]
    out = link_quotes(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == len(rows)
    by = {(r.conv_id, r.turn, r.text): r for r in out}
    assert by[None, 1, "yes"].parent_turn == 0 and by[3, None, ""].parent_turn is None
    assert [r.parent_turn for r in out if (r.conv_id, r.turn) == (4, 1)] == [0, 0, 0]
    assert link_quotes(spark.createDataFrame([], SCHEMA)).collect() == []


def test_given_table_has_one_row_for_each(spark):
    messages = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    out = link_quotes(messages)
    assert out.count() == messages.count()


def by_plain_linking(rows):
    """Each message against all earlier ones of its conversation; turns are unique."""
    convs, out = defaultdict(dict), {}
    for conv, turn, _, text in rows:
        convs[conv][turn] = parse(text)
    for conv, messages in convs.items():
        units = {t: {normal(x) for x in [own, *re.split(r"\n\s*\n", own), *own.split("\n")]} - {""} for t, (own, _) in messages.items()}

        def said(text, turn):
            # The earliest message that has it; a later one is nobody's source.
            first = min((t for t in units if text in units[t]), default=None)
            return first if first is not None and first < turn else None

        parents = {}
        for turn, (own, passages) in messages.items():
            kept = [(level, lines) for level, lines in passages if normal("\n".join(lines))]
            taken, linked = defaultdict(lambda: [99, 0]), 0
            for level, lines in kept:
                texts = [normal(x) for x in lines if normal(x)]
                source = said(normal("\n".join(lines)), turn)
                sources = [source] * len(texts) if source is not None else [s for s in (said(x, turn) for x in texts) if s is not None]
                linked += bool(sources)
                for s in sources:
                    taken[s] = [min(taken[s][0], level), taken[s][1] + 1]
            parents[turn] = min(taken, key=lambda s: (taken[s][0], -taken[s][1], -s), default=None)
            out[conv, turn] = [own, len(kept), linked, max((level for level, _ in kept), default=0), parents[turn]]
        for turn in messages:
            root, depth = turn, 0
            while parents[root] is not None:
                root, depth = parents[root], depth + 1
            out[conv, turn] += [root, depth]
    return out


def random_messages(seed, convs=25, turns=14):
    rng = random.Random(seed)
    pool = ["Yes.", "no", "How are you?", "I am well, thank you", "why - not", "ONE two", "...", "see below", "the same"]
    rows = []
    for conv in [*range(convs), None]:
        said = []
        for turn in rng.sample(range(100), rng.randrange(1, turns)):
            lines = []
            for _ in range(rng.randrange(5)):
                if said and rng.random() < 0.6:
                    quote = rng.choice(said).split("\n")
                    mark = rng.choice(["> ", ">", "> > ", ">>"])
                    lines += [mark + x for x in quote[: rng.randrange(1, len(quote) + 1)]]
                    if rng.random() < 0.3:
                        lines.append(mark + rng.choice(pool))
                lines += [rng.choice([*pool, ""]) for _ in range(rng.randrange(3))]
            text = "\n".join(lines)
            said.append(text)
            rows.append((conv, turn, "user", text))
    return rows


def test_as_plain_linking(spark):
    rows = random_messages(9)
    got = linked(spark, rows)
    wanted = by_plain_linking(rows)
    told = {k: [r.text, r.n_passages, r.n_linked, r.levels, r.parent_turn, r.root_turn, r.depth] for k, r in got.items()}
    assert told == wanted
    assert sum(w[4] is not None for w in wanted.values()) > 50
