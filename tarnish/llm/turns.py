"""Operator 11: repair of the turn structure of conversations by cheapest edits.

A conversation's rows, by turn, become one that alternates: an optional system
message, then user and assistant in turn. Rows are kept, given the role user or
assistant, deleted, or empty ones are inserted; blank rows and repeats must be
deleted. The edit lattice has a node for each row boundary and each state of the
pattern. A bidirectional Dijkstra search runs a heap from the first boundary and
one from the last until no cheaper and no equally cheap path can be left; of all
crossings of that cost the one with the least audit (the edits' initials in
order) is taken.

Rows are range-partitioned and numbered once; a conversation's codes (role
initial and fault, two characters a row) are cut into slices of at most
128 rows. A conversation in one slice is one search. A longer one has
each slice searched from every state to every state, in parallel; the slices'
results are then multiplied (least cost, then least audit), which is the same
path: at equal cost no audit of a slice is the beginning of another, so the least
whole is made of the least parts. Only codes and audits of a conversation ever
meet in one task, never its texts.

Rows of one turn are taken by role, first 64 characters and a hash of the text.
A null conversation id is a conversation of its own; null turns come first; null
roles and texts count as one blank. Roles other than those that begin with s, u
or a must be changed or deleted. An empty table gives empty tables.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnish.functions.storage import through_table

#: Rows of a slice, as a power of two.
SLICE_BITS = 7
WHITE = " \t\n\x0b\x0c\r"
COSTS = {"K": 0, "R": 3, "D": 4, "I": 3}
TRUNCATED = 3
NEVER = 1 << 60

# States of (s?(ua)+)?: nothing yet, after s, after u, after a.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
STATES = 4
STEPS = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}
ENDS = (START, AFTER_A)
LEGAL = ("su", "ua", "au")
ROLES = {"u": "user", "a": "assistant"}

Node = tuple[int, int]


class _Lattice:
    """Edges of the edit lattice; ``codes`` has two characters a row: role initial and fault."""

    def __init__(self, codes: str) -> None:
        self.rows = [(codes[i], codes[i + 1]) for i in range(0, len(codes), 2)]

    def _edits(self, i: int) -> Iterator[tuple[str, int, str]]:
        """(edit, cost, role left) of row i."""
        role, fault = self.rows[i]
        yield "D", COSTS["D"], ""
        if fault not in "bd":
            extra = TRUNCATED if fault == "t" else 0
            yield "K", COSTS["K"] + extra, role
            for r in ROLES:
                if r != role:
                    yield "R", COSTS["R"] + extra, r

    def after(self, node: Node) -> Iterator[tuple[str, int, Node]]:
        i, q = node
        if i < len(self.rows):
            for edit, cost, role in self._edits(i):
                to = STEPS.get((q, role)) if role else q
                if to is not None:
                    yield edit, cost, (i + 1, to)
        for r in ROLES:
            if (q, r) in STEPS:
                yield "I", COSTS["I"], (i, STEPS[q, r])

    def before(self, node: Node) -> Iterator[tuple[str, int, Node]]:
        i, q = node
        if i:
            for edit, cost, role in self._edits(i - 1):
                for p in range(STATES):
                    if (STEPS.get((p, role)) if role else p) == q:
                        yield edit, cost, (i - 1, p)
        for (p, r), to in STEPS.items():
            if to == q and r in ROLES:
                yield "I", COSTS["I"], (i, p)


def search(codes: str, entry: int, exits: tuple[int, ...]) -> tuple[int, str]:
    """The least cost and, among its paths, the least audit from ``entry`` before the first row to one of ``exits`` after the last."""
    lattice = _Lattice(codes)
    n = len(lattice.rows)
    # Of each side: labels (cost, audit), settled nodes, heap. Free edges lead to the next row, so at equal
    # cost nodes are settled in the order of their rows, and a settled node's audit is the least.
    labels: tuple[dict[Node, tuple[int, str]], ...] = ({(0, entry): (0, "")}, {(n, x): (0, "") for x in exits})
    settled: tuple[dict[Node, tuple[int, str]], ...] = ({}, {})
    heaps = ([(0, 0, (0, entry))], [(0, -n, (n, x)) for x in exits])
    heapq.heapify(heaps[1])
    best = NEVER
    while True:
        for side in (0, 1):
            while heaps[side] and heaps[side][0][2] in settled[side]:
                heapq.heappop(heaps[side])
        if not heaps[0] or not heaps[1] or heaps[0][0][0] + heaps[1][0][0] > best:
            break
        side = 0 if heaps[0][0][0] <= heaps[1][0][0] else 1
        _, _, node = heapq.heappop(heaps[side])
        cost, audit = settled[side][node] = labels[side][node]
        if node in labels[1 - side]:
            best = min(best, cost + labels[1 - side][node][0])
        for edit, more, other in lattice.after(node) if side == 0 else lattice.before(node):
            label = (cost + more, audit + edit if side == 0 else edit + audit)
            old = labels[side].get(other)
            if old is None or label < old:
                labels[side][other] = label
                if old is None or label[0] < old[0]:
                    heapq.heappush(heaps[side], (label[0], other[0] if side == 0 else -other[0], other))
    if best == NEVER:
        return NEVER, ""
    forward, backward = settled
    # A path that the forward side has settled whole crosses at its end.
    backward = {**{(n, x): (0, "") for x in exits}, **backward}
    crossings = []
    for node, (cost, audit) in forward.items():
        if node in backward and cost + backward[node][0] == best:
            crossings.append(audit + backward[node][1])
        for edit, more, other in lattice.after(node):
            if other in backward and cost + more + backward[other][0] == best:
                crossings.append(audit + edit + backward[other][1])
    return best, min(crossings)


@lru_cache(maxsize=1 << 14)
def whole(codes: str) -> tuple[int, str]:
    return search(codes, START, ENDS)


@lru_cache(maxsize=1 << 8)
def matrix(codes: str) -> tuple[tuple[int, str], ...]:
    """Cost and audit from every state to every state, row by row."""
    return tuple(search(codes, p, (q,)) for p in range(STATES) for q in range(STATES))


@dataclass
class _Joined:
    """Slices in a row: from state to state the cost, the audit and the states between the slices."""

    cells: list[tuple[int, str, tuple[int, ...]]]

    @classmethod
    def of(cls, costs: list[int], audits: list[str]) -> _Joined:
        return cls([(c, a, ()) for c, a in zip(costs, audits, strict=True)])

    def then(self, other: _Joined) -> _Joined:
        cells = []
        for p in range(STATES):
            for q in range(STATES):
                paths = [(self.cells[p * STATES + m], m, other.cells[m * STATES + q]) for m in range(STATES)]
                least = min(a[0] + b[0] for a, _, b in paths)
                if least >= NEVER:
                    cells.append((NEVER, "", ()))
                    continue
                cells.append(min((least, a[1] + b[1], (*a[2], m, *b[2])) for a, m, b in paths if a[0] + b[0] == least))
        return _Joined(cells)


def joined(parts: list[_Joined]) -> _Joined:
    """The product of all, by halves, so that audits are copied once a level."""
    while len(parts) > 1:
        parts = [parts[i].then(parts[i + 1]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


def illegal_pairs(initials: str) -> int:
    return sum(initials[i : i + 2] not in LEGAL for i in range(len(initials) - 1))


def damage(conversations: DataFrame) -> DataFrame:
    """Faults by crc32 of ``conv_id:turn`` modulo 20; nulls in the key, in roles and in texts count as one blank.

    0 drops a row, 1 empties its text, 2 takes the marks ``.!?`` out, 3 repeats it, 4 gives it the role user.
    """

    def text_of(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), text_of("role").alias("role"), text_of("text").alias("text"), fault.alias("fault"))
    return rows.where("fault != 0").select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def numbered(rows: DataFrame) -> DataFrame:
    """The rows in order with ``pos``, written down: conversations are runs of it, as are their slices."""
    own = rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        # Parts rows that are alike in all, whose order changes nothing.
        F.monotonically_increasing_id().alias("seq"),
    )
    keys = ["conv_id", "turn", "role", F.substring("text", 1, 64), F.xxhash64("text"), "seq"]
    ordered = own.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("seq")
    return through_table(ordered.withColumn("pos", F.monotonically_increasing_id()), "turns")


def coded(rows: DataFrame) -> DataFrame:
    """(conv_id, pos, turn, code) of numbered rows: role initial (x: none of s, u, a) and first fault (b, d, t or -)."""
    group = F.md5(F.concat(F.col("conv_id").isNull().cast("string"), F.lit(":"), F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.lit("\0"), "role", F.lit("\0"), "text"))
    end = F.rtrim(F.col("text"), F.lit(WHITE))
    initial = F.substring("role", 1, 1)
    light = rows.select(
        "conv_id",
        "pos",
        "turn",
        F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"),
        (end == "").alias("blank"),
        (~F.substring(end, -1, 1).isin(".", "!", "?")).alias("truncated"),
        group.alias("same"),
    )
    # Written, so that a text which fills a third of a conversation is split in the join.
    repeats = light.where("not blank").groupBy("same").agg(F.min("pos").alias("first"), F.count("*").alias("n")).where("n > 1")
    found = light.join(through_table(repeats.select("same", "first"), "repeats"), "same", "left")
    fault = F.when(F.col("blank"), "b").when(F.col("pos") > F.col("first"), "d").when(F.col("truncated"), "t").otherwise("-")
    return found.select("conv_id", "pos", "turn", F.concat("initial", fault).alias("code"))


_SOLVED = (
    "conv_id {kind}, slice long, parts long, places array<long>, codes string, blank long, duplicate long, truncated long, illegal long, "
    "costs array<long>, audits array<string>"
)
_CHOSEN = "conv_id {kind}, slice long, places array<long>, codes string, blank long, duplicate long, truncated long, illegal long, cost long, entry int, audit string"


def _solve(slices: DataFrame, kind: str) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {c: [] for c in ("blank", "duplicate", "truncated", "illegal", "costs", "audits")}
            for codes, parts in zip(batch.column("codes").to_pylist(), batch.column("parts").to_pylist(), strict=True):
                faults = codes[1::2]
                for name, letter in (("blank", "b"), ("duplicate", "d"), ("truncated", "t")):
                    out[name].append(faults.count(letter))
                out["illegal"].append(illegal_pairs(codes[::2]))
                cells = [whole(codes)] if parts == 1 else matrix(codes)
                out["costs"].append([c for c, _ in cells])
                out["audits"].append([a for _, a in cells])
            types = {"costs": pa.list_(pa.int64()), "audits": pa.list_(pa.string())}
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(v, types.get(k, pa.int64())) for k, v in out.items())], names=[*batch.schema.names, *out]
            )

    return slices.select("conv_id", "slice", "parts", "places", "codes").mapInArrow(run, _SOLVED.format(kind=kind))


def _choose(solved: DataFrame, kind: str) -> DataFrame:
    """Each slice's own part of the cheapest edits; the whole cost stands at the first one."""
    same = ["conv_id", "slice", "places", "codes", "blank", "duplicate", "truncated"]
    alone = solved.where("parts = 1").select(*same, "illegal", F.col("costs")[0].alias("cost"), F.lit(0).alias("entry"), F.col("audits")[0].alias("audit"))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("slice")
        costs, audits, codes, illegal = (table.column(c).to_pylist() for c in ("costs", "audits", "codes", "illegal"))
        all_parts = joined([_Joined.of(c, a) for c, a in zip(costs, audits, strict=True)])
        # A tie between the two ends is decided by the audit, as within a search.
        cost, _, between, end = min((*all_parts.cells[START * STATES + q], q) for q in ENDS)
        states = [START, *between, end]
        part = [a[p * STATES + q] for a, p, q in zip(audits, states[:-1], states[1:], strict=True)]
        for i in range(1, len(codes)):
            illegal[i] += illegal_pairs(codes[i - 1][-2] + codes[i][0])
        names = [c.split()[0] for c in _CHOSEN.split(", ")]
        more = {
            "illegal": pa.array(illegal, pa.int64()),
            "cost": pa.array([cost] + [0] * (len(part) - 1), pa.int64()),
            "entry": pa.array(states[:-1], pa.int32()),
            "audit": pa.array(part, pa.string()),
        }
        return pa.table([more.get(n, table.column(n) if n in table.column_names else None) for n in names], names=names)

    # A row for each slice of a long conversation, without its texts.
    long = solved.where("parts > 1").groupBy("conv_id").applyInArrow(run, _CHOSEN.format(kind=kind))
    return alone.unionByName(long)


def _edits(chosen: DataFrame, kind: str) -> DataFrame:
    """(conv_id, slice, k, pos, edit, new_role) of all that is left or inserted; ``pos`` is null for what is inserted."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = batch.column("conv_id"), []
            for i, (s, places, codes, entry, audit) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("slice", "places", "codes", "entry", "audit")), strict=True)):
                state, at = entry, 0
                for k, edit in enumerate(audit):
                    pos = None if edit == "I" else places[at]
                    role = codes[2 * at] if edit == "K" else None
                    at += edit != "I"
                    if edit == "D":
                        continue
                    if edit != "K":
                        role = next(r for r in ROLES if (state, r) in STEPS)
                    rows.append((i, s, k, pos, edit, None if edit == "K" else ROLES[role]))
                    state = STEPS[state, role]
            columns = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(columns[0], pa.int64())),
                    pa.array(columns[1], pa.int64()),
                    pa.array(columns[2], pa.int64()),
                    pa.array(columns[3], pa.int64()),
                    pa.array(columns[4], pa.string()),
                    pa.array(columns[5], pa.string()),
                ],
                names=["conv_id", "slice", "k", "pos", "edit", "new_role"],
            )

    return chosen.select("conv_id", "slice", "places", "codes", "entry", "audit").mapInArrow(
        run, f"conv_id {kind}, slice long, k long, pos long, edit string, new_role string"
    )


def repair_conversations(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A report with one row for each conversation of ``rows`` (conv_id, turn, role, text), and the repaired rows.

    Report: conv_id, gaps (turns missing between the first and the last), blank,
    duplicate and truncated rows, illegal neighbours, cost and audit. Repaired:
    conv_id, slice and k (their order), turn, role, text, edit.
    """
    kind = dict(rows.dtypes)["conv_id"]
    ordered = numbered(rows)
    codes = coded(ordered).withColumn("slice", F.shiftright("pos", SLICE_BITS))
    entries = F.sort_array(F.collect_list(F.struct("pos", "code")))
    slices = (
        codes.groupBy("conv_id", "slice")
        .agg(entries.alias("rows"), F.min("turn").alias("first"), F.max("turn").alias("last"))
        .select("conv_id", "slice", F.col("rows.pos").alias("places"), F.array_join("rows.code", "").alias("codes"))
    )
    slices = through_table(slices, "slices")
    parts = through_table(slices.groupBy("conv_id").agg(F.count("*").alias("parts")), "parts")
    counted = slices.alias("s").join(parts.alias("p"), F.col("s.conv_id").eqNullSafe(F.col("p.conv_id"))).select("s.*", "parts")
    chosen = through_table(_choose(through_table(_solve(counted, kind), "solved"), kind), "edits")
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("slice", "audit"))), lambda x: x["audit"])
    report = chosen.groupBy("conv_id").agg(
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")), F.array_join(in_order, "").alias("audit")
    )
    turns = ordered.groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"))
    report = (
        report.alias("r")
        .join(turns.alias("t"), F.col("r.conv_id").eqNullSafe(F.col("t.conv_id")))
        .select("r.conv_id", F.coalesce("gaps", F.lit(0)).alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    )
    repaired = (
        _edits(chosen, kind)
        .alias("e")
        .join(ordered.alias("o"), F.col("e.pos") == F.col("o.pos"), "left")
        .select(
            "e.conv_id", "slice", "k", "turn", F.coalesce("new_role", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text"), "edit"
        )
    )
    return report, repaired


def conversation_hashes(repaired: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of the lines ``role:text``, newline-joined.

    A SHA-256 is made from its first byte to its last, so a conversation is one
    task's; that task reads its rows in order and holds a batch of them at a time.
    """
    kind = dict(repaired.dtypes)["conv_id"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            done_ids, done = [], []
            for i, (conv, role, text) in enumerate(zip(*(c.to_pylist() for c in batch.columns), strict=True)):
                if digest is None or conv != now:
                    if digest is not None:
                        done_ids.append(now)
                        done.append(digest.hexdigest())
                    now, digest = conv, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            yield pa.RecordBatch.from_arrays([pa.array(done_ids, batch.schema.field(0).type), pa.array(done, pa.string())], names=["conv_id", "repaired_sha256"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], batch.schema.field(0).type), pa.array([digest.hexdigest()], pa.string())], names=["conv_id", "repaired_sha256"])

    ordered = repaired.repartition("conv_id").sortWithinPartitions("conv_id", "slice", "k").select("conv_id", "role", "text")
    return ordered.mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


def repair_report(conversations: DataFrame) -> DataFrame:
    """One row for each conversation of ``conversations``, after ``damage`` and repair, with a digest of what is left."""
    report, repaired = repair_conversations(damage(conversations))
    hashes = conversation_hashes(repaired)
    every = conversations.select("conv_id").distinct()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    nothing = hashlib.sha256(b"").hexdigest()
    return (
        every.alias("a")
        .join(report.alias("r"), F.col("a.conv_id").eqNullSafe(F.col("r.conv_id")), "left")
        .join(hashes.alias("h"), F.col("a.conv_id").eqNullSafe(F.col("h.conv_id")), "left")
        .select(
            "a.conv_id",
            *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers),
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
        )
    )
