"""Operator 9: conversations linked by their quotes, in reply order, without the quotes.

A line's quote level is the number of ``>`` signs (blanks between them allowed) it
starts with. Lines without one are the message's own. Neighbouring lines of one
level are a quoted passage. Own and quoted text is normalised (lower case, runs of
white space as one blank, outer punctuation dropped) and hashed: own text as a whole, by paragraph
and by line; passages as a whole and by line.

A passage belongs to the earliest message of its conversation that has it as a whole;
if there is none, each of its lines to the earliest message that has that line. A
message replies to the one that its outermost quotes take most lines from; of equal ones the
latest. Quotes within quotes are counted, not followed: the message that is quoted has links of its own. From replies
follow each message's first message (``root_turn``) and its distance to it (``depth``), by
pointer jumping. ``(conv_id, root_turn, turn)`` puts every reply after what it answers.

Each join is on a hash that one side has once, so it makes no pairs, and groupings
combine before the shuffle; one conversation, line or first turn may hold any share of the messages.
Null conversation ids form one conversation; a message without a turn links to none. Null text stays null
and has no quotes. Rows that share a conversation and turn are each returned with
that turn's links. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnish.functions.storage import through_table

_QUOTE = re.compile(r"[ \t]*>[> \t]*")
#: A line that says who wrote the quote below it is no text of its own.
_ATTRIBUTION = re.compile(r"[ \t]*(on\b.*\bwrote|.*\b(writes|schrieb|a écrit|escribió))[ \t]*:[ \t]*", re.IGNORECASE)
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_PARAGRAPH = re.compile(r"\n\s*\n")
MAX_ROUNDS = 64

_PARSED = (
    "conv long, turn long, role string, own string, units array<binary>, "
    "passages array<struct<run: int, level: int, whole: binary, lines: array<binary>>>"
)


def normal(text: str) -> str:
    return _EDGES.sub("", " ".join(text.lower().split()))


def _digest(text: str) -> bytes | None:
    """The hash of normalised text; none for what is only punctuation."""
    plain = normal(text)
    return xxhash.xxh3_128_digest(plain.encode("utf-8", "surrogatepass")) if plain else None


def parse(text: str | None) -> tuple[str | None, list[tuple[int, list[str]]]]:
    """A message's own text, and its quoted passages as (level, lines)."""
    if text is None or ">" not in text:
        return text, []
    own: list[str] = []
    passages: list[tuple[int, list[str]]] = []
    before = 0
    for line in text.replace("\r\n", "\n").replace("\r", "\n").split("\n"):
        m = _QUOTE.match(line)
        if m is None:
            own.append(line)
            before = 0
            continue
        level = m.group().count(">")
        if not before and own and _ATTRIBUTION.fullmatch(own[-1]):
            own.pop()
        if level != before:
            passages.append((level, []))
        passages[-1][1].append(line[m.end() :])
        before = level
    return ("\n".join(own).strip() if passages else text), passages


def _parsed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = {
        "units": pa.list_(pa.binary()),
        "passages": pa.list_(pa.struct([("run", pa.int32()), ("level", pa.int32()), ("whole", pa.binary()), ("lines", pa.list_(pa.binary()))])),
    }
    for batch in batches:
        owns, units, quoted = [], [], []
        for text in batch.column(3).to_pylist():
            own, passages = parse(text)
            owns.append(own)
            parts = [own, *_PARAGRAPH.split(own), *own.split("\n")] if own else []
            units.append(sorted({d for d in map(_digest, parts) if d}))
            found = []
            for run, (level, lines) in enumerate(passages):
                whole = _digest("\n".join(lines))
                if whole:
                    found.append({"run": run, "level": level, "whole": whole, "lines": [d for d in map(_digest, lines) if d]})
            quoted.append(found)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(owns, pa.string()), pa.array(units, types["units"]), pa.array(quoted, types["passages"])],
            names=["conv", "turn", "role", "own", "units", "passages"],
        )


def link_quotes(
    messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text", role_col: str = "role"
) -> DataFrame:
    """(conv_id, turn, role, text, n_passages, n_linked, levels, parent_turn, root_turn, depth) for each row."""
    plain = messages.select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"),
        F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"),
    )
    parsed = through_table(plain.mapInArrow(_parsed, _PARSED), "messages")
    at = ["conv", "turn", "row", "run"]
    # Rows that share a conversation and turn are told apart by what they quote.
    passages = parsed.where(F.col("turn").isNotNull()).select("conv", "turn", F.xxhash64("passages").alias("row"), F.explode("passages").alias("p"))
    passages = passages.select("conv", "turn", "row", "p.run", "p.level", "p.whole", "p.lines").distinct()
    # The earliest turn of a conversation that has a unit: once for each, so that joins make no pairs.
    said = parsed.where(F.col("turn").isNotNull()).select(F.col("conv").alias("of"), "turn", F.explode("units").alias("unit"))
    said = said.groupBy("of", "unit").agg(F.min("turn").alias("said"))
    found = passages.join(said, F.col("conv").eqNullSafe(F.col("of")) & (F.col("whole") == F.col("unit")) & (F.col("said") < F.col("turn")), "left")
    found = through_table(found.select(*at, "level", "lines", "said"), "found")
    by_line = found.where("said is null").select(*at, "level", F.explode("lines").alias("line"))
    by_line = by_line.join(said, F.col("conv").eqNullSafe(F.col("of")) & (F.col("line") == F.col("unit")) & (F.col("said") < F.col("turn")))
    sources = found.where("said is not null").select(*at, "level", "said", F.size("lines").cast("long").alias("n"))
    sources = through_table(sources.unionByName(by_line.groupBy(*at, "level", "said").agg(F.count("*").alias("n"))), "sources")
    counted = found.groupBy("conv", "turn").agg(F.count("*").alias("n_passages"), F.max("level").alias("levels"))
    linked = sources.select(*at).distinct().groupBy("conv", "turn").agg(F.count("*").alias("n_linked"))
    outer = sources.groupBy("conv", "turn", "said").agg(F.min("level").alias("level"), F.sum("n").alias("n"))
    # The outermost quotes first, then most lines, then the latest.
    best = F.min(F.struct(F.col("level"), (-F.col("n")).alias("n"), (-F.col("said")).alias("said"))).alias("best")
    replies = outer.groupBy("conv", "turn").agg(best).select("conv", "turn", (-F.col("best.said")).alias("parent_turn"))
    links = _beside(_beside(_roots(through_table(replies, "replies")), counted), linked)
    m, k = parsed.alias("m"), links.alias("k")
    rows = m.join(k, F.col("m.conv").eqNullSafe(F.col("k.conv")) & (F.col("m.turn") == F.col("k.turn")), "left")
    count = [F.coalesce(f"k.{c}", F.lit(0)).cast("long").alias(c) for c in ("n_passages", "n_linked", "levels", "depth")]
    return rows.select(
        F.col("m.conv").alias("conv_id"), F.col("m.turn").alias("turn"), F.col("m.role").alias("role"), F.col("m.own").alias("text"),
        *count, F.col("k.parent_turn").alias("parent_turn"), F.coalesce("k.root_turn", "m.turn").alias("root_turn"),
    )


def _beside(left: DataFrame, right: DataFrame) -> DataFrame:
    """All columns of two tables that have a conversation and turn once each."""
    a, b = left.alias("a"), right.alias("b")
    at = F.col("a.conv").eqNullSafe(F.col("b.conv")) & (F.col("a.turn") == F.col("b.turn"))
    more = [c for c in right.columns if c not in ("conv", "turn")]
    keys = [F.when(F.col("a.turn").isNotNull(), F.col("a.conv")).otherwise(F.col("b.conv")).alias("conv"), F.coalesce("a.turn", "b.turn").alias("turn")]
    return a.join(b, at, "full").select(*keys, *(F.col(f"a.{c}") for c in left.columns if c not in ("conv", "turn")), *(F.col(f"b.{c}") for c in more))


def _roots(replies: DataFrame) -> DataFrame:
    """(conv, turn, parent_turn, root_turn, depth): each round doubles the way looked at."""
    now = replies.select("conv", "turn", "parent_turn", F.col("parent_turn").alias("root_turn"), F.lit(1).cast("long").alias("depth"))
    for _ in range(MAX_ROUNDS):
        up = now.select(F.col("conv").alias("up_conv"), F.col("turn").alias("up_turn"), F.col("root_turn").alias("up_root"), F.col("depth").alias("up_depth"))
        joined = now.join(up, F.col("conv").eqNullSafe(F.col("up_conv")) & (F.col("root_turn") == F.col("up_turn")), "left")
        now = through_table(
            joined.select(
                "conv", "turn", "parent_turn", F.coalesce("up_root", "root_turn").alias("root_turn"),
                (F.col("depth") + F.coalesce("up_depth", F.lit(0))).alias("depth"), F.col("up_root").isNotNull().alias("moved"),
            ),
            "roots",
        )
        if not now.where("moved").limit(1).count():
            return now.drop("moved")
        now = now.drop("moved")
    raise RuntimeError(f"replies are not settled in {MAX_ROUNDS} rounds")
