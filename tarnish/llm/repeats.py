"""Operator 10: removal of every byte that lies in a long string seen earlier in the corpus.

A byte goes if it is covered by a string of ``size`` bytes that also starts
earlier: in a document before (smaller id), or earlier in its own. Strings are
judged on the input; matches never cross documents.

1. Every window of ``size`` bytes is anchored at the smallest hash of the short grams
   in it, so equal windows have equal anchors, and neighbouring windows mostly one. Each
   group of documents sends its anchors' hashes once, packed, to the bucket of
   the hash, which answers with those that came from two places or more. No other
   window can repeat.
2. For an anchor that repeats, the windows it stands for are a short segment of
   text. A group drops segments it has had already (all their windows are repeats)
   and sends the others to the shard of their anchor. A shard sorts all suffixes of its
   distinct segments by induction (``suffixes.py``), and the permuted common
   prefixes tell which windows also start earlier.
3. What shards found goes back to the documents, which drop the covered bytes.

An anchor with very many different surroundings would fill a shard. Its windows
go one by one to shards of their own content, where equal ones meet. So no
shard holds more than a bounded number of segments of an anchor for each group of
documents, and all is exact: hashes only choose what is compared.

Null text counts as empty. A null id comes before all others; rows that share an
id are in order of their text, equal rows as they come. Documents shorter than ``size`` lose nothing. An
empty table gives an empty result. Memory is bounded by a group of documents
(``GROUP_BYTES``, or one document if that is longer) and a shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnish.llm.common import binaries, id_and_text, ranges, utf8
from tarnish.llm.suffixes import earlier_windows

SIZE = 100
GRAM = 40
#: Bytes of text in a group of documents; changes no result.
GROUP_BYTES = 8 << 20
#: Shards of segments for each group of documents; changes no result.
SHARDS_PER_GROUP = 4
#: Bytes of segments that one suffix array is made of; changes no result.
SORT_BYTES = 3 << 20
#: Different surroundings of an anchor from which on its windows go one by one; changes no result.
CROWD = 5_000

_B = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_POSITION_BITS = 24


#: Bytes of text whose windows are hashed at once: their arrays stay in a core's cache; changes no result.
PIECE_BYTES = 1 << 17


def _power(k: int) -> np.uint64:
    return np.uint64(pow(_B, k, 1 << 64))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A hash of each string of ``k`` bytes, by doubling."""
    n = len(data) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power, done, width = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93), None, 1
    covered = 0
    while True:
        if k & width:
            done = power.copy() if done is None else done[: len(power) - covered] * _power(width) + power[covered : covered + len(done)]
            covered += width
        if covered == k:
            return _mixed(done[:n])
        power = power[:-width] * _power(width) + power[width:]
        width *= 2


def _smallest(keys: np.ndarray, width: int) -> np.ndarray:
    """The smallest key of each ``width`` in a row, by doubling."""
    n, have, low = len(keys) - width + 1, 1, keys
    while have * 2 <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    return np.minimum(low[:n], low[width - have : width - have + n])


class Anchors:
    """The anchors of all windows of some documents in a row.

    ``hash``: 48 bits of the gram; ``begin``, ``count``: its windows' starts in the row of
    bytes; ``around``: 16 bits of what surrounds it.
    """

    def __init__(self, data: np.ndarray, at: np.ndarray, size: int = SIZE, gram: int = GRAM) -> None:
        parts = [self._of(data[a:b], np.array(ends) - a, size, gram) + (a,) for a, b, ends in _pieces(at, size)]
        self.begin = np.concatenate([p[0] + p[4] for p in parts] or [np.zeros(0, np.int64)])
        self.count = np.concatenate([p[1] for p in parts] or [np.zeros(0, np.int64)])
        self.hash = np.concatenate([p[2] for p in parts] or [np.zeros(0, np.uint64)])
        self.around = np.concatenate([p[3] for p in parts] or [np.zeros(0, np.uint64)])

    @staticmethod
    def _of(data: np.ndarray, ends: np.ndarray, size: int, gram: int):
        empty = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64))
        if len(data) < size:
            return empty
        grams = gram_hashes(data, gram)
        low = np.uint64((1 << _POSITION_BITS) - 1)
        keys = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        anchor = (_smallest(keys, size - gram + 1) & low).astype(np.int64)
        # A window must end within the document it starts in.
        start = np.arange(len(anchor))
        whole = start + size <= np.repeat(ends, np.diff(np.r_[0, ends]))[: len(anchor)]
        first = whole & np.r_[True, (anchor[1:] != anchor[:-1]) | ~whole[:-1]]
        begin = np.flatnonzero(first)
        if not len(begin):
            return empty
        stop = np.flatnonzero(whole & np.r_[~first[1:] & whole[1:], False] ^ whole) + 1
        count = stop - begin
        sides = grams[begin] + grams[begin + count + size - gram - 1] * _power(1) + count.astype(np.uint64)
        return begin, count, grams[anchor[begin]] >> np.uint64(16), _mixed(sides) >> np.uint64(48)


def _pieces(at: np.ndarray, size: int, chunk: int = PIECE_BYTES) -> Iterator[tuple[int, int, list[int]]]:
    """(begin, end, ends of documents) of pieces of the row; long documents are cut with an overlap that no window spans twice."""
    begin, ends = 0, []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a > chunk:
            if ends:
                yield begin, ends[-1], ends
            for s in range(a, b - size + 1, chunk):
                stop = min(s + chunk + size - 1, b)
                yield s, stop, [stop]
            begin, ends = b, []
            continue
        ends.append(b)
        if b - begin >= chunk:
            yield begin, b, ends
            begin, ends = b, []
    if ends:
        yield begin, ends[-1], ends


def _ordered(table: pa.Table) -> pa.Table:
    """The documents of a group in order: by id, null first, then by text."""
    return table.take(pc.sort_indices(table, sort_keys=[("doc_id", "ascending"), ("text", "ascending")], null_placement="at_start"))


def _long(values) -> bytes:
    return np.ascontiguousarray(values, np.int64).tobytes()


def _longs(value: bytes, columns: int = 1) -> np.ndarray:
    flat = np.frombuffer(value, np.int64)
    return flat.reshape(-1, columns) if columns > 1 else flat


def _distinct(values: np.ndarray) -> np.ndarray:
    """In order, by sorting: quicker than ``np.unique``, which hashes, where most values differ."""
    values = np.sort(values)
    return values[np.r_[True, values[1:] != values[:-1]]] if len(values) else values


def _by_shard(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(shard, kind="stable")
    bounds = np.flatnonzero(np.r_[True, np.diff(shard[order]) != 0, True]) if len(shard) else [0]
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        yield int(shard[order[a]]), order[a:b]


def _send_hashes(buckets: int, size: int, gram: int):
    def run(table: pa.Table) -> pa.Table:
        group = table.column("grp")[0].as_py()
        anchors = Anchors(*utf8(_ordered(table).column("text")), size, gram)
        key = _distinct(anchors.hash << np.uint64(16) | anchors.around)
        parts = list(_by_shard(((key >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)))
        return pa.table(
            {
                "bucket": pa.array([b for b, _ in parts], pa.int64()),
                "grp": pa.array([group] * len(parts), pa.int64()),
                "hashes": binaries([key[i].tobytes() for _, i in parts]),
            }
        )

    return run


def _answer_hashes(crowd: int):
    def run(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()]
        groups = table.column("grp").to_numpy()
        key = np.concatenate(parts)
        source = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        order = np.argsort(key)
        key, source = key[order], source[order]
        hash_ = key >> np.uint64(16)
        head = np.flatnonzero(np.r_[True, hash_[1:] != hash_[:-1]])
        counts = np.diff(np.r_[head, len(key)])
        kinds = np.add.reduceat(np.r_[True, key[1:] != key[:-1]].astype(np.int64), head)
        # Twice the hash, and one if it is crowded.
        answer = hash_ << np.uint64(1) | np.repeat(kinds > crowd, counts)
        answer, source = answer[many := np.repeat(counts > 1, counts)], source[many]
        found = list(_by_shard(source))
        return pa.table(
            {
                "grp": pa.array([groups[s] for s, _ in found], pa.int64()),
                "answers": binaries([_distinct(answer[i]).tobytes() for _, i in found]),
            }
        )

    return run


#: A shard's row: segments of one group of documents. ``places`` has (hash, document, start, windows) for each.
_SEGMENTS = "shard long, grp long, ids binary, places binary, sizes binary, bytes binary, done binary"


def _send_segments(shards: int, size: int, gram: int):
    def run(documents: pa.Table, answers: pa.Table) -> pa.Table:
        columns: dict[str, list] = {c.split()[0]: [] for c in _SEGMENTS.split(", ")}
        if documents.num_rows:
            _segments(_ordered(documents), answers, shards, size, gram, columns)
        types = [pa.int64(), pa.int64(), *[pa.binary()] * 5]
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(columns.items(), types, strict=True)})

    return run


def _segments(documents: pa.Table, answers: pa.Table, shards: int, size: int, gram: int, columns: dict[str, list]) -> None:
    group = documents.column("grp")[0].as_py()
    doc_ids = documents.column("doc_id").fill_null(-(2**63)).to_numpy()
    data, at = utf8(documents.column("text"))
    anchors = Anchors(data, at, size, gram)
    answer = _distinct(np.concatenate([np.frombuffer(x, np.uint64) for x in answers.column("answers").to_pylist()] or [np.zeros(0, np.uint64)]))
    known = answer >> np.uint64(1)
    where = np.minimum(np.searchsorted(known, anchors.hash), max(0, len(known) - 1))
    repeats = known[where] == anchors.hash if len(known) else np.zeros(len(anchors.hash), bool)
    crowded = (answer[where] & np.uint64(1)).astype(bool) & repeats if len(known) else repeats
    # Those that repeat within this group alone.
    _, which, times = np.unique(anchors.hash, return_inverse=True, return_counts=True)
    take = np.flatnonzero(repeats | (times[which] > 1))
    single = np.where(crowded[take], anchors.count[take], 1)
    begin = np.repeat(anchors.begin[take], single) + ranges(single)
    count = np.repeat(np.where(crowded[take], 1, anchors.count[take]), single)
    hash_ = np.repeat(anchors.hash[take], single)
    alone = np.repeat(crowded[take], single)

    whole = data.tobytes()
    seen: dict[bytes, int] = {}
    first = np.empty(len(begin), bool)
    for i, (a, b) in enumerate(zip(begin.tolist(), (begin + count + size - 1).tolist(), strict=True)):
        first[i] = seen.setdefault(whole[a:b], i) == i
    # What is in there came first, in order.
    segments = list(seen)
    del seen, whole
    document = np.searchsorted(at, begin, side="right") - 1
    start = begin - at[document]
    done = _runs(document[~first], start[~first], count[~first])
    own = np.flatnonzero(first)
    # A window that goes alone is found by its own bytes.
    route = np.where(alone, _window_hashes(data, begin, alone, size), hash_)[own]
    for shard, i in _by_shard((_mixed(route) % np.uint64(shards)).astype(np.int64)):
        j = own[i]
        places = np.column_stack([np.where(alone, 0, hash_)[j].astype(np.int64), document[j], start[j], count[j]])
        sizes = count[j] + size - 1
        text = b"".join([segments[k] for k in i.tolist()])
        for name, value in (
            ("shard", shard), ("grp", group), ("ids", _long(doc_ids[document[j]])), ("places", _long(places)),
            ("sizes", _long(sizes)), ("bytes", text), ("done", None),
        ):
            columns[name].append(value)
    if len(done):
        for name in columns:
            columns[name].append({"shard": group % shards, "grp": group, "done": _long(done)}.get(name))


def _window_hashes(data: np.ndarray, begin: np.ndarray, wanted: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(len(begin), np.uint64)
    at = np.flatnonzero(wanted)
    for k in range(0, len(at), 4096):
        i = at[k : k + 4096]
        rows = data[begin[i][:, None] + np.arange(size)].astype(np.uint64)
        powers = np.array([pow(_B, e, 1 << 64) for e in range(size)], np.uint64)
        out[i] = ((rows + np.uint64(1)) * powers).sum(axis=1, dtype=np.uint64)
    return out


def _runs(document: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """(document, start, windows) with neighbouring windows put together."""
    if not len(document):
        return np.zeros((0, 3), np.int64)
    order = np.lexsort((start, document))
    document, start, stop = document[order], start[order], (start + count)[order]
    head = np.flatnonzero(np.r_[True, (document[1:] != document[:-1]) | (start[1:] > stop[:-1])])
    return np.column_stack([document[head], start[head], np.maximum.reduceat(stop, head) - start[head]])


def _compare(size: int, sort_bytes: int):
    """What a shard finds: for each group, (document, start, windows) that start earlier elsewhere."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        found = [(g, d) for g, d in zip(table.column("grp").to_pylist(), table.column("done").to_pylist(), strict=True) if d]
        held = table.filter(pc.is_valid(table.column("places")))
        if held.num_rows:
            groups = held.column("grp").to_numpy()
            places = [_longs(x, 4).reshape(-1, 4) for x in held.column("places").to_pylist()]
            source = np.repeat(np.arange(len(places)), [len(p) for p in places])
            place = np.concatenate(places)
            ids = np.concatenate([_longs(x) for x in held.column("ids").to_pylist()])
            sizes = np.concatenate([_longs(x) for x in held.column("sizes").to_pylist()])
            text = b"".join(held.column("bytes").to_pylist())
            at = np.r_[0, np.cumsum(sizes)]
            # Anchors together; among theirs, segments in order of document and start.
            order = np.lexsort((place[:, 2], place[:, 1], ids, place[:, 0]))
            repeated = []
            for some in _sorts(order, place[:, 0], sizes, sort_bytes):
                some = some[np.lexsort((place[some, 2], place[some, 1], groups[source[some]], ids[some]))]
                repeated.append(_earlier(some, text, at, place, size))
            which, offset, windows = (np.concatenate(x) for x in zip(*repeated, strict=True))
            for s, i in _by_shard(source[which]):
                p = place[which[i]]
                found.append((int(groups[s]), _long(_runs(p[:, 1], p[:, 2] + offset[i], windows[i]))))
        return pa.table({"grp": pa.array([g for g, _ in found], pa.int64()), "found": binaries([f for _, f in found])})

    return run


def _sorts(order: np.ndarray, hash_: np.ndarray, sizes: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """Parts of about ``most`` bytes, with all segments of an anchor in one."""
    total = np.cumsum(sizes[order])
    heads = np.flatnonzero(np.r_[True, np.diff(hash_[order]) != 0])
    begin, held = 0, 0
    for h in heads[1:].tolist():
        if total[h - 1] - held >= most:
            yield order[begin:h]
            begin, held = h, int(total[h - 1])
    yield order[begin:]


def _earlier(some: np.ndarray, text: bytes, at: np.ndarray, place: np.ndarray, size: int):
    """(segment, offset, windows) of what starts earlier, of segments in order of document and start."""
    seen: dict[bytes, int] = {}
    parts, distinct, copies = [], [], []
    for i, a, b in zip(some.tolist(), at[some].tolist(), at[some + 1].tolist(), strict=True):
        part = text[a:b]
        if part in seen:
            copies.append(i)
        else:
            seen[part] = i
            parts.append(part)
            distinct.append(i)
    part, offset = earlier_windows(parts, size)
    copy = np.array(copies, np.int64)
    return (
        np.r_[np.array(distinct, np.int64)[part], copy],
        np.r_[offset, np.zeros(len(copy), np.int64)],
        np.r_[np.ones(len(part), np.int64), place[copy, 3]],
    )


def _cut(size: int):
    def run(documents: pa.Table, found: pa.Table) -> pa.Table:
        if not documents.num_rows:
            return pa.table({k: pa.array([], t) for k, t in (("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary()))})
        documents = _ordered(documents)
        data, at = utf8(documents.column("text"))
        spans = np.concatenate([_longs(x, 3).reshape(-1, 3) for x in found.column("found").to_pylist()] or [np.zeros((0, 3), np.int64)])
        change = np.zeros(len(data) + 1, np.int32)
        np.add.at(change, at[spans[:, 0]] + spans[:, 1], 1)
        np.add.at(change, at[spans[:, 0]] + spans[:, 1] + spans[:, 2] + size - 1, -1)
        gone = np.cumsum(change[:-1], dtype=np.int32) > 0
        before = np.r_[0, np.cumsum(gone)]
        begins = gone & np.r_[True, ~gone[:-1]] if len(gone) else gone
        # A run that goes on from the document before is a run of its own.
        inner = at[(at > 0) & (at < len(data))]
        begins[inner] = gone[inner]
        runs = np.r_[0, np.cumsum(begins)]
        kept = [data[a:b][~gone[a:b]].tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        return pa.table(
            {
                "doc_id": documents.column("doc_id"),
                "n_bytes": pa.array(np.diff(at)),
                "n_removed": pa.array(np.diff(before[at])),
                "n_spans": pa.array(np.diff(runs[at])),
                "kept": binaries(kept),
            }
        )

    return run


def remove_repeats(
    docs: DataFrame,
    size: int = SIZE,
    gram: int = GRAM,
    id_col: str = "doc_id",
    text_col: str = "text",
    group_bytes: int = GROUP_BYTES,
    sort_bytes: int = SORT_BYTES,
    crowd: int = CROWD,
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) for each row; ``kept`` holds the bytes that are left."""
    if not 8 <= gram <= size:
        raise ValueError("a gram has 8 bytes at least and a window's size at most")
    wanted = id_and_text(docs, id_col, text_col)
    total = wanted.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-total // group_bytes))
    shards = groups * SHARDS_PER_GROUP
    grouped = wanted.withColumn("grp", F.pmod(F.xxhash64("doc_id"), F.lit(groups)))
    by_group = grouped.groupBy("grp")
    hashes = by_group.applyInArrow(_send_hashes(groups, size, gram), "bucket long, grp long, hashes binary")
    answers = hashes.groupBy("bucket").applyInArrow(_answer_hashes(crowd), "grp long, answers binary")
    segments = by_group.cogroup(answers.groupBy("grp")).applyInArrow(_send_segments(shards, size, gram), _SEGMENTS)
    found = segments.groupBy("shard").applyInArrow(_compare(size, sort_bytes), "grp long, found binary")
    return by_group.cogroup(found.groupBy("grp")).applyInArrow(
        _cut(size), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )
