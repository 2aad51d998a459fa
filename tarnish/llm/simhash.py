"""Operator 5: near copies by SimHash and a self-join of binary tries.

A document's fingerprint is the majority of the bits of its three-word shingles'
XXH64 (seed 42), repeats counted. Fingerprints that differ in at most ``radius``
bits are linked, and linked documents form classes.

Of ``radius + 1`` blocks of a fingerprint, two linked ones share a block. So
each distinct fingerprint goes to one trie for each block, with its bits turned
so that this block leads. In a trie the join starts from the pairs (node, itself)
below the leading block and walks down pairs of nodes together, one bit a step:
children of unlike bits add one to the pair's errors, and a pair beyond the
budget is dropped with all below it. It runs with budgets 1 to ``radius``, and drops
pairs of nodes whose fingerprints are all in one class already, so a dense group
costs about its size and not its square. Only links that join classes come out:
at most one for each fingerprint and trie.

Rows of one table only, whatever their number; copies share a fingerprint and
are grouped before the shuffle. Texts without words have fingerprint zero, are
linked like any other. Null ids never become a class's id unless it has no
other. Repeated rows each come out. An empty table gives an empty result.

``drop_near_copies`` asks for a similarity and not for few bits: two sets of
five-word shingles of Jaccard similarity 0.8 differ in about 15 of 100 bits, which
four blocks of 64 bits cannot tell. Its fingerprints have ``WIDE`` bits, and each of
many tries takes 64 of them in an order of its own: there the join starts below the
leading ``lead`` bits and walks down with the budget ``NEAR_RADIUS``. Classes of a trie
are parted into those of all ``WIDE`` bits, as 64 bits chain texts that are not alike;
these are candidates, and ``minhash`` verifies them on the whole sets. The leading bits grow
with the number of texts, so a node holds about ``NODE_SIZE`` however many there are,
and the number of tries with the leading bits, so the odds of a miss stay (``tries_for``).
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnish.functions.storage import through_table
from tarnish.llm import minhash
from tarnish.llm.common import free_name, id_and_text, ranges, tidy
from tarnish.llm.links import components

SHINGLE_WORDS = 3
SEED = 42
RADIUS = 3
#: Distinct fingerprints that a trie holds on average; sets the number of tries, changes no result.
TRIE_SIZE = 40_000
#: Pairs of nodes looked at together; bounds memory, changes no result.
FRONTIER = 1 << 20
#: Bits of a near-copy fingerprint, a multiple of 64.
WIDE = 512
#: Bits of a trie's 64 that candidates may differ in, and the budgets of its walks: dense groups are one class after the first.
NEAR_RADIUS = 11
NEAR_BUDGETS = (4, NEAR_RADIUS)
#: The share of bits that differ at similarity 0.8, at most: 0.152 for large sets, this for five shingles within six.
#: For four within five it is 0.1875; these have keys of their own (``short_keys``).
NEAR_SHARE = 0.157
#: The odds of a miss at that share, if the tries' bits were independent.
MISS = 1e-6
#: Bits of all ``WIDE`` that candidates may differ in: ``NEAR_SHARE`` and 4.8 deviations, beyond which about as few lie.
WIDE_RADIUS = 120
#: Rows of a class of a trie that are compared with each other; larger ones are candidates as they are.
CLASS_ROWS = 4096
#: Rows of a class below which classes are compared together.
FEW_ROWS = 64
#: Texts for each task that compares prints.
SHARD_TEXTS = 5000
#: Texts that agree in the leading bits, on average and at most.
NODE_SIZE = 64
LEAST_LEAD = 12

_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: str | None, k: int = SHINGLE_WORDS) -> int:
    """64 bits as an unsigned integer; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line, digest = b" ".join(words), xxhash.xxh64_digest
    if len(words) <= k:
        hashes = digest(line, SEED)
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = np.cumsum(sizes) - 1
        begins = (ends + 1 - sizes)[: len(words) - k + 1]
        hashes = b"".join([digest(line[a:b], SEED) for a, b in zip(begins.tolist(), ends[k - 1 :].tolist(), strict=True)])
    rows = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(rows[:, i], minlength=256) @ _BYTE_BITS for i in range(8)])
    return int.from_bytes(np.packbits(2 * ones > len(rows)).tobytes(), "big")


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) for each row, the fingerprint as a signed long."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [signed(fingerprint(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.int64())], names=["doc_id", "fingerprint"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, fingerprint long")


class _Classes:
    """Union by smallest number, on arrays."""

    def __init__(self, n: int) -> None:
        self.of = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.of[a], self.of[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.of, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = self.of[self.of]
                if (up == self.of).all():
                    break
                self.of = up


def trie_join(
    values: np.ndarray, lead: int, radius: int, frontier: int = FRONTIER, bits: int = 64, budgets: Sequence[int] | None = None
) -> np.ndarray:
    """The class of each of the sorted, distinct ``values``: the first index of its class.

    Links values that agree in the ``lead`` leading bits and differ in ``radius`` bits at most.
    ``budgets`` are those of the walks, of which the last is ``radius``.
    """
    classes = _Classes(len(values))
    if len(values) < 2:
        return classes.of
    top = values >> np.uint64(bits - lead) if lead else np.zeros(len(values), np.uint64)
    begin = np.flatnonzero(np.r_[True, top[1:] != top[:-1]])
    end = np.r_[begin[1:], len(values)]
    wide = end - begin > 1
    roots = (begin[wide], end[wide], begin[wide], end[wide], np.zeros(int(wide.sum()), np.int8))
    for budget in budgets or range(1, radius + 1):
        stack = [(lead, roots)]
        while stack:
            depth, nodes = stack.pop()
            if len(nodes[0]) > frontier:
                half = len(nodes[0]) // 2
                stack += [(depth, tuple(x[half:] for x in nodes)), (depth, tuple(x[:half] for x in nodes))]
                continue
            nodes = _apart(nodes, classes)
            if not len(nodes[0]):
                continue
            nodes = _leaves(values, nodes, budget, classes)
            if len(nodes[0]) and depth < bits:
                stack.append((depth + 1, _down(values, nodes, depth, budget, bits)))
    return classes.of


def _apart(nodes: tuple, classes: _Classes) -> tuple:
    """Without the pairs of nodes that lie in one class as a whole."""
    a, b, c, d, _ = nodes
    # Runs of one class: a node is of one class if no change lies within it.
    change = np.r_[0, np.cumsum(classes.of[1:] != classes.of[:-1])]
    one = (change[a] == change[b - 1]) & (change[c] == change[d - 1]) & (classes.of[a] == classes.of[c])
    return tuple(x[~one] for x in nodes)


def _leaves(values: np.ndarray, nodes: tuple, budget: int, classes: _Classes, small: int = 16) -> tuple:
    """Compares the values of small pairs of nodes; gives the pairs that are left."""
    a, b, c, d, _ = nodes
    n, m = b - a, d - c
    few = n * m <= small
    size = (n * m)[few]
    if len(size):
        at = np.repeat(np.cumsum(size) - size, size)
        k = np.arange(int(size.sum())) - at
        width = np.repeat(m[few], size)
        i, j = np.repeat(a[few], size) + k // width, np.repeat(c[few], size) + k % width
        near = (i < j) & (np.bitwise_count(values[i] ^ values[j]) <= budget)
        classes.join(i[near], j[near])
    return tuple(x[~few] for x in nodes)


def _down(values: np.ndarray, nodes: tuple, depth: int, budget: int, bits: int) -> tuple:
    """The pairs of children one bit further down that are within the budget."""
    a, b, c, d, errors = nodes
    bit = np.uint64(1) << np.uint64(bits - 1 - depth)

    def split(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        # The first value of the node with this bit set; bits above agree, bits below count from 0.
        first = (values[lo] | bit) >> np.uint64(bits - 1 - depth) << np.uint64(bits - 1 - depth)
        return np.clip(np.searchsorted(values, first), lo, hi)

    m, k = split(a, b), split(c, d)
    same = (a == c) & (b == d)
    more = errors + np.int8(1)
    parts = [
        (a, m, c, k, errors, np.ones(len(a), bool)),
        (m, b, k, d, errors, np.ones(len(a), bool)),
        (a, m, k, d, more, more <= budget),
        # A node with itself has these two once.
        (m, b, c, k, more, (more <= budget) & ~same),
    ]
    out = []
    for w, x, y, z, e, keep in parts:
        keep = keep & (w < x) & (y < z) & ((w != y) | (x - w > 1))
        out.append(tuple(v[keep] for v in (w, x, y, z, e)))
    return tuple(np.concatenate(v) for v in zip(*out, strict=True))


def _turned(value: Column, by: int) -> Column:
    return value if by == 0 else F.shiftleft(value, by).bitwiseOR(F.shiftrightunsigned(value, 64 - by))


def links(prints: DataFrame, radius: int = RADIUS, trie_size: int = TRIE_SIZE) -> DataFrame:
    """(a, b) of distinct fingerprints: few links, with the classes that all links have."""
    distinct = prints.select("fingerprint").distinct()
    n = distinct.count()
    blocks = radius + 1
    width = 64 // blocks
    # Tries by block and by the first bits of the block that leads.
    prefix = min(width, max(0, math.ceil(math.log2(max(1, n) / trie_size))))

    def run(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        values = np.sort(table.column("turned").to_numpy().view(np.uint64))
        first = trie_join(values, width, radius)
        own = np.flatnonzero(first != np.arange(len(values)))
        by = np.uint64(block * width)
        back = values >> by | values << (np.uint64(64) - by) if block else values
        return pa.table({"a": back[own].view(np.int64), "b": back[first[own]].view(np.int64)})

    turned = F.explode(F.array(*(F.struct(F.lit(i).alias("block"), _turned(F.col("fingerprint"), i * width).alias("turned")) for i in range(blocks))))
    tries = distinct.select(turned.alias("t")).select("t.block", "t.turned")
    shard = F.shiftrightunsigned("turned", 64 - prefix) if prefix else F.lit(0).cast("long")
    return tries.withColumn("shard", shard).groupBy("block", "shard").applyInArrow(run, "a long, b long")


def class_ids(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fingerprint, root) of the fingerprints that are linked to another; root names the class."""
    return components(links(prints, radius)).select(F.col("node").alias("fingerprint"), F.col("root"))


def near_copies(docs: DataFrame, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row; component_id is the smallest id of its class."""
    prints = through_table(fingerprints(docs, id_col, text_col), "simhash")
    least = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    rooted = least.join(class_ids(prints, radius), "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    roots = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(roots, "root").select("fingerprint", "component_id")
    return prints.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


_dice = np.random.Generator(np.random.PCG64(SEED))
_STEP = _dice.integers(0, 1 << 63, WIDE // 64, dtype=np.uint64) << np.uint64(1) | np.uint64(1)


def wide_print(shingles: np.ndarray) -> bytes | None:
    """The majority of each of ``WIDE`` bits of the shingles' hashes; none without shingles."""
    if not len(shingles):
        return None
    ones = np.zeros(WIDE, np.int64)
    # So many rows that their sum fits a byte.
    for i in range(0, len(shingles), 255):
        h = shingles[i : i + 255, None] + _STEP
        h = (h ^ h >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(31)
        ones += np.unpackbits(h.view(np.uint8), axis=1).sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * ones > len(shingles)).tobytes()


def short_keys(shingles: np.ndarray) -> np.ndarray:
    """The sums of any four of four or five shingles: sets so short are near if they share one."""
    whole = shingles.sum(keepdims=True, dtype=np.uint64)
    return (whole if len(shingles) == 4 else whole - shingles if len(shingles) == 5 else whole[:0]).view(np.int64)


def wide_prints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, word_key, print, short_keys) for each row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, prints, short = [], [], []
            for text in batch.column(1).to_pylist():
                shingles = minhash.shingle_set(text)
                keys.append(minhash.word_key(text))
                prints.append(wide_print(shingles))
                short.append(short_keys(shingles))
            columns = [pa.array(keys, pa.int64()), pa.array(prints, pa.binary()), pa.array(short, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *columns], names=["doc_id", "text_key", "word_key", "print", "short_keys"])

    wanted = id_and_text(docs, id_col, text_col).withColumn("text_key", F.xxhash64("text"))
    return wanted.mapInArrow(tidy(run), "doc_id long, text_key long, word_key long, print binary, short_keys array<long>")


def tries_for(lead: int) -> int:
    """So many tries that all miss a pair of ``NEAR_SHARE`` by odds of ``MISS``."""
    rest = 64 - lead
    within = sum(math.comb(rest, k) * NEAR_SHARE**k * (1 - NEAR_SHARE) ** (rest - k) for k in range(NEAR_RADIUS + 1))
    return math.ceil(math.log(MISS) / math.log1p(-((1 - NEAR_SHARE) ** lead) * within))


def orders(tries: int) -> np.ndarray:
    """The 64 bits of each trie: bits of the fingerprint in rounds of shuffles, so that leading bits are spread over all."""
    dice = np.random.Generator(np.random.PCG64(SEED + 1))
    return np.array([dice.permutation(WIDE)[:64] for _ in range(tries)])


def print_classes(buckets: np.ndarray, prints: np.ndarray, radius: int = WIDE_RADIUS) -> np.ndarray:
    """The first index of the class of each row: classes lie within a run of ``buckets``, of prints within ``radius``.

    ``prints`` has a row of 64-bit words for each row. Runs of over ``CLASS_ROWS`` rows are one class.
    """
    n = len(buckets)
    classes = _Classes(n)
    begin = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1]]) if n else np.zeros(0, np.int64)
    size = np.diff(np.r_[begin, n])

    def compare(at: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Classes of the rows ``at``, each with the rows behind it and before its run's end."""
        found = _Classes(len(at))
        left = np.arange(len(at))
        for step in range(1, int((ends - left).max(initial=1))):
            left = left[left + step < ends[left]]
            apart = left[found.of[left] != found.of[left + step]]
            near = apart[np.bitwise_count(prints[at[apart]] ^ prints[at[apart + step]]).sum(axis=1) <= radius]
            found.join(near, near + step)
        return found.of

    few = size <= FEW_ROWS
    if few.any():
        counts = size[few]
        at = np.repeat(begin[few], counts) + ranges(counts)
        classes.of[at] = at[compare(at, np.repeat(np.cumsum(counts), counts))]
    for first, rows in zip(begin[~few].tolist(), size[~few].tolist(), strict=True):
        own = np.arange(first, first + rows)
        classes.of[own] = first + compare(own, np.full(rows, rows)) if rows <= CLASS_ROWS else first
    return classes.of


def candidates(made: DataFrame, trie_size: int = TRIE_SIZE) -> DataFrame:
    """(word_key, bucket, centre, bits) of the texts that share a class of a trie and of prints, or a short key, with another.

    The centre is one text of the bucket, from which the text differs in ``bits`` bits.
    """
    each = made.where("print IS NOT NULL").select("word_key", "print", "short_keys").dropDuplicates(["word_key"])
    n = each.count()
    lead = min(32, max(LEAST_LEAD, math.ceil(math.log2(max(1, n) / NODE_SIZE))))
    # Tries by their first bits, as in ``links``.
    prefix = min(lead, max(0, math.ceil(math.log2(max(1, n) / trie_size))))
    tries = tries_for(lead)

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taken = orders(tries)
        for whole in batches:
            for i in range(0, len(whole), 2000):
                batch = whole.slice(i, 2000)
                prints = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(len(batch), WIDE // 8)
                bits = np.unpackbits(prints, axis=1)
                for t, own in enumerate(taken):
                    values = np.packbits(bits.take(own, axis=1), axis=1).view(">u8")[:, 0].astype(np.uint64)
                    shard = (values >> np.uint64(64 - prefix)).astype(np.int32) if prefix else np.zeros(len(batch), np.int32)
                    columns = [batch.column(0), pa.array(np.full(len(batch), t, np.int32)), pa.array(shard), pa.array(values.view(np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, names=["word_key", "trie", "shard", "value"])

    def walk(table: pa.Table) -> pa.Table:
        values, at = np.unique(table.column("value").to_numpy().view(np.uint64), return_inverse=True)
        keys, own = table.column("word_key").to_numpy(), trie_join(values, lead, NEAR_RADIUS, budgets=NEAR_BUDGETS)[at]
        several = np.bincount(own, minlength=len(values))[own] > 1
        root = values[own[several]].view(np.int64)
        trie = np.full(len(root), table.column("trie")[0].as_py(), np.int32)
        return pa.table({"word_key": keys[several], "trie": trie, "root": root})

    def part(table: pa.Table) -> pa.Table:
        buckets, keys = table.column("bucket").to_numpy(), table.column("word_key").to_numpy()
        order = np.lexsort((keys, buckets))
        buckets, keys = buckets[order], keys[order]
        prints = np.frombuffer(b"".join(table.column("print").to_pylist()), np.uint64).reshape(len(keys), WIDE // 64)[order]
        own = print_classes(buckets, prints)
        several = np.flatnonzero(np.bincount(own, minlength=len(own))[own] > 1)
        bits = np.bitwise_count(prints[several] ^ prints[own[several]]).sum(axis=1).astype(np.int32)
        return pa.table({"word_key": keys[several], "bucket": buckets[several], "centre": keys[own[several]], "bits": bits})

    dealt = each.select("word_key", "print").mapInArrow(tidy(deal), "word_key long, trie int, shard int, value long")
    walked = dealt.groupBy("trie", "shard").applyInArrow(walk, "word_key long, trie int, root long")
    walked = walked.select("word_key", F.xxhash64("trie", "root").alias("bucket")).join(each.select("word_key", "print"), "word_key")
    shard = F.pmod(F.xxhash64("bucket"), F.lit(math.ceil(max(1, n) / SHARD_TEXTS)))
    parted = walked.groupBy(shard).applyInArrow(part, "word_key long, bucket long, centre long, bits int")
    found = parted.select("word_key", F.xxhash64("bucket", "centre").alias("bucket"), "centre", "bits")
    # Two sets of five that share four are not near, so a key counts if a set of four has it.
    short = each.select("word_key", F.explode("short_keys").alias("bucket"), F.size("short_keys").alias("keys"))
    fours = short.groupBy("bucket").agg(F.min(F.when(F.col("keys") == 1, F.col("word_key"))).alias("centre"), F.count("*").alias("n")).where("n > 1 AND centre IS NOT NULL")
    return found.unionByName(short.join(fours.select("bucket", "centre"), "bucket").select("word_key", "bucket", "centre", F.lit(0).alias("bits")))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows and columns of one document of each class: the one with the smallest id.

    Links are five-word shingle sets of Jaccard similarity 0.8 or more: candidates of
    the tries, verified by ``minhash``. Rows that share both id and text are one document, of
    which one row stays; of texts that share an id and a class, that with the smallest hash.
    """
    text_key = F.xxhash64(F.col(text_col).cast("string"))
    made = through_table(wide_prints(docs, id_col, text_col), "wide-prints")
    shared = through_table(candidates(made), "buckets")
    rooted = made.join(minhash.class_ids(docs, made, shared, id_col, text_col), "word_key", "left")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("kept")
    kept = rooted.groupBy(F.coalesce("root", "word_key")).agg(first).select("kept.doc_id", "kept.text_key").distinct()
    own_id, own_key = free_name("own_id", docs, kept), free_name("own_key", docs, kept)
    keyed = docs.withColumns({own_id: F.col(id_col).cast("long"), own_key: text_key})
    left = keyed.join(kept, keyed[own_id].eqNullSafe(kept.doc_id) & (keyed[own_key] == kept.text_key), "left_semi")
    return left.dropDuplicates([own_id, own_key]).select(*docs.columns)
