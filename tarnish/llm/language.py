"""Operator 7: language by unigrams of word pieces, summed over all segmentations.

The pieces are those of a public vocabulary, given by path. Each language has
a probability for each piece; a word's probability is the sum over all ways to
cut it into pieces, by a forward pass over its letters. The probabilities come
from expectation maximisation with the same passes forward and back. A text's words
are its runs of letters, in lower case, and its language is the one under which
they are likeliest. As no piece crosses a word, a distinct word is summed once
and looked up after that.

Training takes about ``docs_per_lang`` documents of each language, chosen by a
hash of their id: the model's one bound. Whole texts are scored. A null text, or
one without a letter, is ``und`` with score 0, as is every text if nothing was learned. Languages
that are equally likely: the first by name. Rows are scored one by one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnish.llm.common import chunks, id_and_text, ranges, remainder

FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
DOCS_PER_LANG = 500
CACHE_WORDS = 500_000
#: Letters that are segmented together; a longer run of letters is taken in parts.
MAX_WORD = 64

#: What often stands behind a word.
_MARKS = ".,!?;:"
_LETTERS = regex.compile(r"\p{L}+")


class _Numbered(dict):
    """Numbers words as they come; ``new`` holds those not looked at yet."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list = []

    def __missing__(self, word):
        self[word] = number = len(self)
        self.new.append(word)
        return number


def words_of(token: str) -> list[str]:
    core = token.rstrip(_MARKS)
    if core.isascii() and core.isalpha() and len(core) <= MAX_WORD:
        return [core.lower()]
    return [w[i : i + MAX_WORD] for w in _LETTERS.findall(token.lower()) for i in range(0, len(w), MAX_WORD)]


class Pieces:
    """The letter pieces of a sentencepiece vocabulary; ``▁`` stands before the first letter of a word."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        spelled = {model.id_to_piece(i).lower() for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
        self.pieces = sorted(p for p in spelled if regex.fullmatch(r"▁?\p{L}*", p))
        self.number = {p: i for i, p in enumerate(self.pieces)}
        self.longest = max(map(len, self.pieces), default=1)
        #: The piece of a letter that the vocabulary lacks.
        self.other = len(self.pieces)
        self._build_trie()

    def _build_trie(self) -> None:
        """Nodes are prefixes of pieces; node 0 is none, 1 the empty one. An edge is (node, sign), sorted, with where it leads."""
        signs = sorted(set("".join(self.pieces)))
        self.sign = np.zeros(ord(signs[-1]) + 2 if signs else 1, np.int64)
        self.sign[[ord(c) for c in signs]] = np.arange(1, len(signs) + 1)
        self.width = len(signs) + 1
        node, edges, held = {"": 1}, {}, {}
        for number, piece in enumerate(self.pieces):
            for end in range(1, len(piece) + 1):
                if piece[:end] not in node:
                    node[piece[:end]] = len(node) + 1
                    edges[node[piece[: end - 1]] * self.width + int(self.sign[ord(piece[end - 1])])] = node[piece[:end]]
            held[node[piece]] = number
        self.edge = np.array(sorted(edges), np.int64)
        self.leads = np.array([edges[k] for k in self.edge.tolist()], np.int64)
        self.piece_at = np.full(len(node) + 1, -1, np.int32)
        self.piece_at[list(held)] = list(held.values())

    def _step(self, node: np.ndarray, sign: np.ndarray) -> np.ndarray:
        """The node one sign further, or 0."""
        if not len(self.edge):
            return np.zeros(len(node), np.int64)
        key = node * self.width + sign
        at = np.minimum(np.searchsorted(self.edge, key), len(self.edge) - 1)
        return np.where(self.edge[at] == key, self.leads[at], 0)

    def lattice(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """sizes, and for each word, end and length the number of the piece there, or -1.

        Words have the mark before them, so a word of n letters has n + 1 signs.
        """
        sizes = np.fromiter((len(w) + 1 for w in words), np.int64, len(words))
        most = int(sizes.max(initial=1))
        grid = np.full((most + 1, min(self.longest, most) + 1, len(words)), -1, np.int32)
        codes = np.frombuffer("".join("▁" + w for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
        # The last entry of the table is that of no sign.
        sign = self.sign[np.minimum(codes, len(self.sign) - 1)]
        word, place = np.repeat(np.arange(len(words)), sizes), ranges(sizes)
        left = np.repeat(sizes, sizes) - place
        # All places at once walk the pieces from there, a sign at a time, until no piece goes on.
        begin, node, length = np.arange(len(codes)), np.ones(len(codes), np.int64), 0
        while len(begin):
            node = self._step(node, sign[begin + length])
            length += 1
            on = np.flatnonzero(node)
            begin, node = begin[on], node[on]
            piece = self.piece_at[node]
            has = np.flatnonzero(piece >= 0)
            at = begin[has]
            grid[place[at] + length, length, word[at]] = piece[has]
            on = np.flatnonzero(left[begin] > length)
            begin, node = begin[on], node[on]
        lone = np.flatnonzero(grid[place + 1, 1, word] < 0)
        grid[place[lone] + 1, 1, word[lone]] = self.other
        return sizes, grid


def forward(sizes: np.ndarray, grid: np.ndarray, odds: np.ndarray) -> np.ndarray:
    """alpha[end, word, language]: the probability of all ways to cut a word's first ``end`` signs."""
    alpha = np.zeros((grid.shape[0], grid.shape[2], odds.shape[1]))
    alpha[0] = 1
    for end in range(1, grid.shape[0]):
        for length in range(1, min(end, grid.shape[1] - 1) + 1):
            piece = grid[end, length]
            has = np.flatnonzero(piece >= 0)
            if len(has):
                alpha[end, has] += alpha[end - length, has] * odds[piece[has]]
    return alpha


def expected(sizes: np.ndarray, grid: np.ndarray, odds: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How often each piece is used in each language, over all ways to cut words that occur ``counts`` times."""
    alpha = forward(sizes, grid, odds)
    beta = np.zeros_like(alpha)
    word = np.arange(len(sizes))
    beta[sizes, word] = 1
    total = alpha[sizes, word]
    weight = np.divide(counts, total, out=np.zeros_like(total), where=total > 0)
    used = np.zeros_like(odds)
    for end in range(grid.shape[0] - 1, 0, -1):
        for length in range(1, min(end, grid.shape[1] - 1) + 1):
            piece = grid[end, length]
            has = np.flatnonzero((piece >= 0) & (end <= sizes))
            if len(has):
                p = piece[has]
                flow = odds[p] * beta[end, has]
                beta[end - length, has] += flow
                np.add.at(used, p, alpha[end - length, has] * flow * weight[has])
    return used


def _by_length(words: Sequence[str], most: int = 4096) -> Iterator[np.ndarray]:
    """Parts of words of like length."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(sizes, kind="stable")
    sizes = sizes[order]
    begin = 0
    while begin < len(order):
        end = min(begin + most, int(np.searchsorted(sizes, 1.25 * sizes[begin] + 2, side="right")))
        yield order[begin:end]
        begin = end


class LanguageModel:
    """Piece probabilities by language; pickles as (path, languages, odds, priors)."""

    def __init__(self, path: str, languages: Sequence[str], odds: np.ndarray, priors: np.ndarray) -> None:
        self.path, self.languages, self.odds, self.priors = path, list(languages), odds, priors
        self._ready = False

    def __getstate__(self) -> dict:
        return {"path": self.path, "languages": self.languages, "odds": self.odds, "priors": self.priors, "_ready": False}

    def _prepare(self) -> None:
        if not self._ready:
            self.pieces = Pieces(self.path)
            self._forget()
            self._ready = True

    def _forget(self) -> None:
        self.tokens, self.words = _Numbered(), _Numbered()
        self.by_token = np.zeros((0, len(self.languages)))
        self.by_word = np.zeros((0, len(self.languages)))
        self.letters = np.zeros(0, bool)

    def log_odds(self, words: Sequence[str]) -> np.ndarray:
        """The log probability of each word under each language."""
        out = np.zeros((len(words), len(self.languages)))
        for part in _by_length(words):
            sizes, grid = self.pieces.lattice([words[i] for i in part])
            alpha = forward(sizes, grid, self.odds)
            out[part] = np.log(np.maximum(alpha[sizes, np.arange(len(part))], 1e-300))
        return out

    def _learn(self) -> None:
        new = self.tokens.new
        if not new:
            return
        number = self.words.__getitem__
        held = [[number(w) for w in words_of(t)] for t in new]
        if self.words.new:
            self.by_word = np.concatenate([self.by_word, self.log_odds(self.words.new)])
            self.words.new.clear()
        counts = np.fromiter(map(len, held), np.int64, len(held))
        flat = np.fromiter((w for h in held for w in h), np.int64, int(counts.sum()))
        rows = np.zeros((len(new), len(self.languages)))
        np.add.at(rows, np.repeat(np.arange(len(new)), counts), self.by_word[flat])
        self.by_token = np.concatenate([self.by_token, rows])
        self.letters = np.concatenate([self.letters, counts > 0])
        new.clear()

    def predict(self, texts: Sequence[str | None]) -> tuple[list[str], np.ndarray]:
        """The likeliest language of each text, and its probability among the languages."""
        self._prepare()
        best, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.languages:
            return best, score
        for a, b in chunks(texts):
            if len(self.tokens) > CACHE_WORDS:
                self._forget()
            number = self.tokens.__getitem__
            units = []
            for t in texts[a:b]:
                tokens = (t or "").split()
                units.append(np.fromiter(map(number, tokens), np.int64, len(tokens)))
            self._learn()
            for i, u in enumerate(units, a):
                if not self.letters[u].any():
                    continue
                distinct, counts = np.unique(u, return_counts=True) if len(u) > 4096 else (u, None)
                rows = self.by_token[distinct]
                total = (rows if counts is None else rows * counts[:, None]).sum(axis=0) + np.log(self.priors)
                k = int(total.argmax())
                best[i], score[i] = self.languages[k], 1 / np.exp(total - total[k]).sum()
        return best, score


def fit(path: str, counts: dict[tuple[str, str], int], docs: dict[str, int], rounds: int = 3, smooth: float = 0.02) -> LanguageModel:
    """From how often each (language, word) occurs, by expectation maximisation from equal pieces of a length."""
    languages = sorted(docs)
    pieces = Pieces(path)
    at = {x: i for i, x in enumerate(languages)}
    words = sorted({w for _, w in counts})
    row = {w: i for i, w in enumerate(words)}
    times = np.zeros((len(words), len(languages)))
    for (lang, w), n in counts.items():
        times[row[w], at[lang]] += n
    size = len(pieces.pieces) + 1
    odds = np.full((size, len(languages)), 1.0 / size)
    parts = [(part, *pieces.lattice([words[i] for i in part])) for part in _by_length(words)]
    for _ in range(rounds):
        used = np.full_like(odds, smooth)
        for part, sizes, grid in parts:
            used += expected(sizes, grid, odds, times[part])
        odds = used / used.sum(axis=0)
    total = sum(docs.values())
    return LanguageModel(path, languages, odds, np.array([docs[x] / total for x in languages]))


def train_language(
    docs: DataFrame, path: str, docs_per_lang: int = DOCS_PER_LANG, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> LanguageModel:
    """Learns from (text, language) of the rows outside the held-out fold."""
    known = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    known = known.where(F.col("lang").isNotNull() & (remainder(F.col("doc_id"), FOLDS) != HELD_OUT))
    # One row for each language.
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not sizes:
        return LanguageModel(path, [], np.zeros((0, 0)), np.zeros(0))
    share = F.lit(0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, F.lit(int(1_000_003 * min(1.0, docs_per_lang / n)) + 1)).otherwise(share)
    some = known.where(F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(0))), F.lit(1_000_003)) < share).select("lang", "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found.update((lang, w) for token in (text or "").split() for w in words_of(token))
        if found:
            yield pa.RecordBatch.from_pydict({"lang": [x for x, _ in found], "word": [w for _, w in found], "n": list(found.values())})

    rows = some.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")).toArrow()
    columns = [c.to_pylist() for c in rows.columns]
    return fit(path, {(x, w): n for x, w, n in zip(*columns, strict=True)}, sizes)


def predict_language(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) for each row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, score = model.predict(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double")


