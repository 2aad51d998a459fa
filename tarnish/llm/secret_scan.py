"""Operator 3: secrets in whole texts, by patterns and by sliding entropy.

Base spans, leftmost and without overlap within a kind: ``assign`` (a name such
as ``token``, a sign, a value of six characters at least), ``access`` (key ids
of twenty characters at least) and ``hex`` (24 lower-case hex digits at least). Besides, the
entropy scan takes every run of key characters as a candidate, slides a window
over it for each character class, and keeps the Shannon entropy of the window
by adding the character that enters and taking away the one that leaves.
A run of a class with a window over its threshold is an ``entropy`` span, and runs
that meet are one span, unless the candidate is on the allow list.

Positions are code points, ends exclusive. Null and empty texts have no spans. Rows
are looked at one by one, so repeated rows, nulls elsewhere and other columns
don't matter; memory is bounded by one batch of rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnish.llm.common import tidy

KINDS = ("assign", "access", "hex", "entropy")
BASE_KINDS = KINDS[:3]

_ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# A run of fewer digits fails as a whole, so asking for 24 at once finds the same spans.
_HEX = re.compile(r"[0-9a-f]{24,}")

# Eight consonants in a row are in no word, as good as; of random strings of one case they are in many, not all.
_SPOKEN = r"(?!.*(?i:[b-df-hj-np-tv-xz]{8}))"
_WORD = r"(?:[A-Z]++(?![a-z])|(?:[a-z]++|[A-Z][a-z]++)(?:[A-Z][a-z]{2,}+)*+)"

#: Candidates that are no secrets: UUIDs, plain numbers, words joined by signs, paths of words, rulers of one sign.
#: A word is of one case, or of parts of three letters or more that each begin with a capital.
ALLOW = (
    r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
    r"[0-9_=+/-]+",
    # Words and signs in turn, so that there is one way to match.
    rf"{_SPOKEN}[_=+/-]*+(?:{_WORD}[_=+/-]++)*+(?:{_WORD})?+[0-9]{{0,4}}",
    _SPOKEN + r"[_=+/-]*+(?:(?:[a-z]++[0-9]{0,4}+|[0-9]{1,4}+)(?:[_=+/-]++|$))*+",
)


@dataclass(frozen=True)
class CharClass:
    """Characters whose windows of ``window`` are secrets from ``bits`` of entropy on."""

    run: str
    window: int
    bits: float


#: Of windows of random characters of base 36, 32 and 62 about one in a hundred is below.
CLASSES = (
    CharClass(r"[0-9a-f]", 20, 3.0),
    CharClass(r"[0-9A-F]", 20, 3.0),
    CharClass(r"[a-z0-9]", 20, 3.35),
    CharClass(r"[A-Z0-9]", 20, 3.3),
    CharClass(r"[A-Za-z0-9]", 20, 3.6),
    CharClass(r"[A-Za-z0-9+/_=-]", 20, 3.85),
)


@dataclass(frozen=True)
class Scanner:
    classes: Sequence[CharClass] = CLASSES
    allow: Sequence[str] = ALLOW
    candidate: str = r"[A-Za-z0-9+/_=-]"
    _made: dict = field(default_factory=dict, compare=False, repr=False)

    def __getstate__(self) -> dict:
        return {"classes": self.classes, "allow": self.allow, "candidate": self.candidate, "_made": {}}

    def _compiled(self):
        if not self._made:
            shortest = min(c.window for c in self.classes)
            self._made["candidates"] = re.compile(rf"(?<!{self.candidate}){self.candidate}{{{shortest},}}")
            self._made["allow"] = [re.compile(a) for a in self.allow]
            self._made["runs"] = [(re.compile(f"{c.run}{{{c.window},}}"), c.window, c.bits) for c in self.classes]
        return self._made["candidates"], self._made["allow"], self._made["runs"]

    def entropy_spans(self, text: str) -> list[tuple[int, int]]:
        candidates, allow, runs = self._compiled()
        found: list[tuple[int, int]] = []
        for m in candidates.finditer(text):
            word = m.group()
            if any(a.fullmatch(word) for a in allow):
                continue
            for run, window, bits in runs:
                # The whole run, as windows over the threshold leave out a secret's ends.
                found += [(m.start() + p.start(), m.start() + p.end()) for p in run.finditer(word) if dense_windows(p.group(), window, bits)]
        return merged(found)

    def spans(self, text: str | None) -> list[tuple[str, int, int]]:
        """All spans by start, then kind as in KINDS."""
        if not text:
            return []
        found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m.group(1)) >= 6]
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
        found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
        found += [(a, 3, b) for a, b in self.entropy_spans(text)]
        return [(KINDS[k], a, b) for a, k, b in sorted(found)]


def dense_windows(run: str, window: int, bits: float) -> list[tuple[int, int]]:
    """Where windows of ``run`` hold ``bits`` of entropy or more."""
    # One more than the window: a character enters before the one that leaves is taken away.
    weight = [0.0, *(c * math.log2(c) for c in range(1, window + 2))]
    counts: dict[str, int] = {}
    total, out = 0.0, []
    # Entropy is log2(window) - total / window, with total the sum of c * log2(c) over the counts.
    most = window * (math.log2(window) - bits) + 1e-9
    for i, c in enumerate(run):
        n = counts.get(c, 0)
        counts[c] = n + 1
        total += weight[n + 1] - weight[n]
        if i >= window:
            n = counts[gone := run[i - window]]
            counts[gone] = n - 1
            total += weight[n - 1] - weight[n]
        if i >= window - 1 and total <= most:
            out.append((i - window + 1, i + 1))
    return merged(out)


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def scan_secrets(docs: DataFrame, scanner: Scanner | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans) for each row: an array of (kind, start, end)."""
    scanner = scanner or Scanner()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[{"kind": k, "start": a, "end": b} for k, a, b in scanner.spans(t)] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, _SPANS)], names=["doc_id", "spans"])

    wanted = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return wanted.mapInArrow(run, "doc_id long, spans array<struct<kind: string, start: long, end: long>>")


def redact(
    docs: DataFrame, mark: str = "[secret]", scanner: Scanner | None = None, text_col: str = "text", length_col: str = "n_chars"
) -> DataFrame:
    """The same rows and columns, with every span of the text replaced by ``mark``.

    Where spans overlap, one mark stands for all. ``length_col``, if there, is set
    to the new length of texts that changed.
    """
    scanner = scanner or Scanner()
    at = docs.columns.index(text_col)
    length_at = docs.columns.index(length_col) if length_col in docs.columns else None

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            changed = {}
            for i, t in enumerate(texts):
                parts, last = [], 0
                for a, b in merged((a, b) for _, a, b in scanner.spans(t)):
                    parts += [t[last:a], mark]
                    last = b
                if parts:
                    changed[i] = "".join([*parts, t[last:]])
            if changed:
                columns = list(batch.columns)
                columns[at] = pa.array([changed.get(i, t) for i, t in enumerate(texts)], columns[at].type)
                if length_at is not None:
                    old = columns[length_at].to_pylist()
                    columns[length_at] = pa.array([len(changed[i]) if i in changed else n for i, n in enumerate(old)], columns[length_at].type)
                batch = pa.RecordBatch.from_arrays(columns, schema=batch.schema)
            yield batch

    return docs.mapInArrow(tidy(run), docs.schema)
