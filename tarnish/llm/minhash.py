"""The exact check of near copies: Jaccard similarity of sets of five-word shingles.

Candidates are buckets of texts that ``simhash`` finds in its tries (MinHash bands
once; the module keeps its name). Every link is verified on the whole sets, and
links make classes.

Each text is first held against one other, the nearest of its buckets' centres, as a
table of pairs. All buckets that hang together make a crowd. Of crowds that are then
still several classes, and more than two texts, each text meets every other of another
class once, however many buckets they share: a crowd is dealt into blocks, and for each
pair of blocks one task has their sets, counts what they share, and gives out only links
that join classes. Blocks are of bounded size, most crowds are one, and texts of the
largest class are not held against each other. Nothing is sampled or capped.

Texts with the same words in the same order are one before that. Texts without
words are one class and near to nothing else.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnish.functions.storage import through_table
from tarnish.llm.common import id_and_text, ranges, tidy
from tarnish.llm.links import components

SHINGLE_WORDS = 5
SEED = 42
#: Similarity of 4 in 5 or more, in whole numbers.
NEAR = (4, 5)
#: Shingles of a block, and its shingles times its texts; bound a task's memory and time, change no result.
BLOCK_SHINGLES = 1 << 19
BLOCK_WORK = 1 << 26


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_set(text: str | None, k: int = SHINGLE_WORDS) -> np.ndarray:
    """The distinct hashes of the text's shingles, sorted; of texts of fewer words, that of the text."""
    words = _words(text)
    if not words:
        return np.zeros(0, np.uint64)
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= k:
        return np.array([digest(line, SEED)], np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes) - 1
    begins = (ends + 1 - sizes)[: len(words) - k + 1]
    return np.unique(np.array([digest(line[a:b], SEED) for a, b in zip(begins.tolist(), ends[k - 1 :].tolist(), strict=True)], np.uint64))


def word_key(text: str | None) -> int:
    value = xxhash.xxh64_intdigest(b" ".join(_words(text)), SEED)
    return value - (1 << 64) if value >> 63 else value


def _sets(docs: DataFrame, made: DataFrame, keys: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(word_key, shingles) of the texts whose words are among ``keys``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t).view(np.int64) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["word_key", "shingles"])

    # One row stands for all of the same words, so copies don't meet in the join.
    row = F.xxhash64("doc_id", "text_key").alias("row_key")
    one = made.groupBy("word_key").agg(F.min(F.xxhash64("doc_id", "text_key")).alias("row_key")).join(keys, "word_key", "left_semi")
    texts = id_and_text(docs, id_col, text_col).withColumn("text_key", F.xxhash64("text")).select(row, "text")
    return texts.join(one, "row_key").select("word_key", "text").dropDuplicates(["word_key"]).mapInArrow(tidy(run), "word_key long, shingles array<long>")


def _near(shared: Column, n: Column, m: Column) -> Column:
    a, b = NEAR
    return shared * (a + b) >= (n + m) * a


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are near."""
    left, right = (sets.select(F.col("word_key").alias(c), F.col("shingles").alias(f"of_{c}")) for c in "ab")
    both = pairs.join(left, "a").join(right, "b")
    return both.where(_near(F.size(F.array_intersect("of_a", "of_b")), F.size("of_a"), F.size("of_b"))).select("a", "b")


def links_within(keys: np.ndarray, roots: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links of near sets that join the classes ``roots``, enough for the classes that all links make."""
    n, (few, all_) = len(keys), NEAR
    sizes = np.array([len(s) for s in sets])
    _, number = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(n), sizes)[np.argsort(number, kind="stable")]
    ends = np.cumsum(np.bincount(number))
    begins = np.r_[0, ends[:-1]]
    at = np.r_[0, np.cumsum(sizes)]
    of = np.unique(roots, return_inverse=True)[1]
    members = np.bincount(of)
    # Texts of the largest class need no look: those outside find them. So it stays the one once a text has been passed over.
    out, largest, passed = [], members.argmax(), False
    for i in range(n):
        if of[i] == largest and (passed or members[largest] > 1):
            passed = True
            continue
        mine = number[at[i] : at[i + 1]]
        counts = ends[mine] - begins[mine]
        shared = np.bincount(owner[np.repeat(begins[mine], counts) + ranges(counts)], minlength=n)
        for j in np.flatnonzero(shared * (few + all_) >= (sizes + sizes[i]) * few).tolist():
            if of[j] != of[i]:
                out.append((int(keys[i]), int(keys[j])))
                stays, goes = (of[j], of[i]) if of[j] == largest else (of[i], of[j])
                of[of == goes] = stays
                members[stays] += members[goes]
        if not passed and members[of[i]] > members[largest]:
            largest = of[i]
    return out


def _within(table: pa.Table) -> pa.Table:
    table = table.combine_chunks()
    sets = table.column("shingles").chunk(0) if table.num_rows else pa.array([], pa.list_(pa.int64()))
    whole, at = sets.flatten().to_numpy(), np.cumsum(np.r_[0, sets.value_lengths().to_numpy()])
    found = links_within(table.column("word_key").to_numpy(), table.column("root").to_numpy(), [whole[a:b] for a, b in zip(at[:-1], at[1:], strict=True)])
    return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})


def _block_pairs(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(crowd, x, y, word_key, root): the members of crowds of several classes, in each pair of blocks with their own."""
    sized = members.join(sets.select("word_key", F.size("shingles").alias("size")), "word_key")
    apart = sized.groupBy("crowd").agg(F.count("*").alias("n"), F.sum("size").alias("size"), F.min("root").alias("low"), F.max("root").alias("high"))
    # Of two members the pair is known.
    blocks = F.ceil(F.greatest(F.col("size") / BLOCK_SHINGLES, F.sqrt(F.col("size") * F.col("n") / BLOCK_WORK)))
    apart = apart.where("n > 2 AND low < high").select("crowd", blocks.alias("blocks"))
    dealt = members.join(apart, "crowd").withColumn("own", F.pmod(F.xxhash64("word_key"), "blocks"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return dealt.where("blocks = 1 OR own <> other").select("crowd", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "word_key", "root")


def class_ids(docs: DataFrame, made: DataFrame, shared: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word_key, root) of the texts that are near to another.

    ``made`` holds the (doc_id, text_key, word_key) of ``docs``, ``shared`` the candidates: a
    (word_key, bucket, centre, bits) for each member of a bucket, ``bits`` less for a likelier centre.
    """
    sets = through_table(_sets(docs, made, shared.select("word_key").distinct(), id_col, text_col), "shingles")
    stars = shared.where("word_key <> centre").select(F.col("word_key").alias("a"), F.col("centre").alias("b"), "bits")
    # Centres of one text hang together, so it links all to the smallest: most of these links are the same for many texts.
    each = through_table(stars.groupBy("a").agg(F.min_by("b", F.struct("bits", "b")).alias("b"), F.collect_set("b").alias("centres")), "centres")
    links = through_table(_verified(each.select("a", "b"), sets), "near")
    hang = each.select(F.explode(F.concat(F.array("a"), "centres")).alias("a"), F.array_min("centres").alias("b"))
    crowds = components(hang).select(F.col("node").alias("word_key"), F.col("root").alias("crowd"))
    rooted = crowds.join(components(links).withColumnRenamed("node", "word_key"), "word_key", "left")
    members = through_table(rooted.select("crowd", "word_key", F.coalesce("root", "word_key").alias("root")), "members")
    rest = _block_pairs(members, sets).join(sets, "word_key").groupBy("crowd", "x", "y").applyInArrow(_within, "a long, b long")
    return components(links.unionByName(rest)).select(F.col("node").alias("word_key"), "root")
