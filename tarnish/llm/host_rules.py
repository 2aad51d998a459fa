"""Operator 4: quality rules on documents, and verdicts on the hosts they come from.

Each document is measured and held against four rules. A host's share of
documents that fail any of them is shrunk towards all hosts' share by a beta
prior fitted to the hosts (moments), so that a host with few documents is not
judged by chance. Documents of a host that fails often have to pass every rule;
on other hosts only the base rules drop a document; a host beyond
``reject_rate`` loses all its documents. Verdicts go back to the documents by a join
on the host.

Null text has no words, and so fails for being short. Documents without a host
form a host of their own. Rows are counted as they come, repeated ones too. An
empty table gives an empty result. Counting combines before the shuffle, and
adaptive execution splits a host with many documents in the join.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnish.functions.storage import through_table

SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\x0b\x0c\r"

MEASURES = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three that the text holds twice or more."""
    n = len(words)
    if n < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    if len(numbers) >= 1 << 21:
        _, ids2 = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)
        windows = ids2[:-1] * np.int64(len(numbers)) + ids[2:]
    else:
        windows = ids[:-2] << 42 | ids[1:-1] << 21 | ids[2:]
    _, which, counts = np.unique(windows, return_inverse=True, return_counts=True)
    twice = counts[which] > 1
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : n - 2 + k] |= twice
    return int(covered.sum())


def measure(text: str | None) -> tuple[int, int, int, int, int, int]:
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    chars = len(text) - sum(map(text.count, _SPACES))
    lines = [x for x in text.split("\n") if x.strip(_SPACES)]
    return len(words), chars, sum(map(text.count, SYMBOLS)), len(lines), len(lines) - len(set(lines)), repeated_words(words)


def measure_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """(doc_id, host) and the measures of each row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measure(t) for t in batch.column(2).to_pylist()]
            columns = np.array(rows, np.int64).reshape(-1, 6)
            names = ["doc_id", "host", *(c.split()[0] for c in MEASURES.split(", "))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *map(pa.array, columns.T)], names=names)

    wanted = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(host_col).cast("string").alias("host"), F.col(text_col).cast("string").alias("text")
    )
    return wanted.mapInArrow(run, f"doc_id long, host string, {MEASURES}")


def with_failures(measured: DataFrame) -> DataFrame:
    """The rules: too short and repeated words (base), many symbols and repeated lines."""
    short = F.col("n_words") < 50
    repeated = 100 * F.col("n_repeat_words") > 50 * F.col("n_words")
    symbols = 10 * F.col("n_symbols") > F.col("n_words")
    lines = 2 * F.col("n_dup_lines") > F.col("n_lines")
    return measured.withColumns({"base_failed": short | repeated, "any_failed": short | repeated | symbols | lines})


def host_rates(failures: DataFrame) -> DataFrame:
    """(host, n, failed, rate): each host's share of failures, shrunk by the beta prior that fits all hosts."""
    hosts = failures.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("any_failed").cast("long")).alias("failed"))
    raw = F.col("failed") / F.col("n")
    # One row: hosts, documents, failures, and the weighted sum of squared shares.
    h, n, failed, squares = hosts.agg(F.count("*"), F.sum("n"), F.sum("failed"), F.sum(F.col("n") * raw * raw)).first()
    if not n:
        return hosts.withColumn("rate", F.lit(0.0))
    mean = failed / n
    within = mean * (1 - mean)
    between = squares / n - mean * mean - within * (h - 1) / n
    # As many documents as the prior counts for: one at least, all at most.
    strength = min(max(within / between - 1, 1.0), float(n)) if between > 0 else float(n)
    return hosts.withColumn("rate", (F.col("failed") + F.lit(mean * strength)) / (F.col("n") + F.lit(strength)))


def host_rules(
    docs: DataFrame,
    suspect_rate: float = 0.5,
    reject_rate: float = 0.95,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
) -> DataFrame:
    """Measures, failures, the host's rate and ``kept`` for each row."""
    measured = through_table(measure_documents(docs, id_col, text_col, host_col), "host-rules")
    failures = with_failures(measured)
    rates = host_rates(failures).select(F.col("host").alias("of_host"), F.col("rate").alias("host_rate"))
    kept = ~F.col("base_failed") & (F.col("host_rate") < reject_rate) & (~F.col("any_failed") | (F.col("host_rate") < suspect_rate))
    return failures.join(rates, F.col("host").eqNullSafe(F.col("of_host"))).drop("of_host").withColumn("kept", kept)


#: The same in SQL: rows in order of the table, so that repeated rows stay apart.
HOST_RULES_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, source, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
p AS (SELECT r, unnest(range(1, len(words) - 1)) AS i, words FROM w WHERE len(words) >= 3),
q AS (SELECT r, i, count(*) OVER (PARTITION BY r, words[i], words[i + 1], words[i + 2]) AS n FROM p),
u AS (SELECT DISTINCT r, i + k AS i FROM q, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1),
c AS (SELECT r, count(*) AS n_repeat_words FROM u GROUP BY r),
m AS (SELECT doc_id, source, len(words) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(lines) AS n_lines,
             len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
      FROM w LEFT JOIN c USING (r)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
             n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines AS any_failed
      FROM m),
h AS (SELECT source, count(*)::DOUBLE AS n, sum(any_failed::INT)::DOUBLE AS failed FROM f GROUP BY source),
t AS (SELECT count(*)::DOUBLE AS h, sum(n) AS n, sum(failed) / sum(n) AS mean, sum(failed * failed / n) / sum(n) AS sq FROM h),
b AS (SELECT n, mean, mean * (1 - mean) AS within, sq - mean * mean - mean * (1 - mean) * (h - 1) / n AS between FROM t),
s AS (SELECT mean, CASE WHEN between > 0 THEN least(greatest(within / between - 1, 1), n) ELSE n END AS strength FROM b),
g AS (SELECT source, (failed + mean * strength) / (n + strength) AS rate FROM h, s)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND rate < 0.95 AND (NOT any_failed OR rate < 0.5) AS kept
FROM f JOIN g ON f.source IS NOT DISTINCT FROM g.source
"""
