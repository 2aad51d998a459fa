"""Operators 1 and 8 against the tokenizers library itself."""

import zlib
from collections import defaultdict
from functools import cache

import numpy as np
import public_tokenizers
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tarnish.llm.packing import assign, pack
from tarnish.llm.token_files import FrameReader, open_folder, read_token_files, write_token_files
from tarnish.llm.tokens import WordEncoder, encoder_for

WORD, BYTE = map(public_tokenizers.path, ("word_bpe_49k.json", "byte_bpe_50k.json"))
PIECES = st.sampled_from([" ", "  ", "\n", "\t", "\x1c", " ", "a", "B", "é", "É", "ß", ",", "'s", "'LL", "1", "<|endoftext|>", "<|ENDOFTEXT|>", "́", "Σ", "漢", "😀", "word", ".\n", "_"])


@cache
def library(path, special_as_text):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = special_as_text
    return tokenizer


def plain(path, texts, special_as_text=False):
    tokenizer = library(path, special_as_text)
    return [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("path", [WORD, BYTE])
@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.lists(PIECES, max_size=25).map("".join), min_size=1, max_size=5))
def test_ids_by_words_are_the_ids_of_whole_texts(path, texts):
    for special_as_text in (False, True):
        ids, counts = encoder_for(path, special_as_text).encode(texts)
        assert [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])] == plain(path, texts, special_as_text)


def test_forgetting_words_changes_nothing():
    encoder = WordEncoder(WORD, cache_units=2)
    for text in ("one two three four", "five six", "one, two.", None, "", "two. one! \n three"):
        assert encoder.encode([text])[0].tolist() == plain(WORD, [text])[0]


def test_token_files(spark, odd, odd_rows, scratch):
    manifest = write_token_files(odd, scratch, WORD, end_id=2)
    rows = read_token_files(spark, scratch, manifest).collect()
    by_id = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    wanted = sorted((d, tuple([*i, 2])) for (d, _), i in zip(by_id, plain(WORD, [t for _, t in by_id]), strict=True) if d is not None)
    got = sorted((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in rows if r.doc_id is not None)
    assert got == wanted and len(rows) == len(odd_rows)
    ordered = sorted(rows, key=lambda r: r.start)
    assert [r.start for r in ordered] == [sum(x.n_tokens for x in ordered[:i]) for i in range(len(ordered))]
    ids = [r.doc_id for r in ordered]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))


def test_readers_take_only_what_they_want(spark, docs_of, scratch):
    docs = docs_of([(i, f"text number {i} " * (i % 7)) for i in range(300)])
    manifest = write_token_files(docs, scratch, WORD, end_id=2)
    whole = {r.doc_id: tuple(r) for r in read_token_files(spark, scratch, manifest).collect()}
    some = {r.doc_id: tuple(r) for r in read_token_files(spark, scratch, manifest, wanted=[7, 250]).collect()}
    assert some == {d: whole[d] for d in (7, 250)}
    fs, root = open_folder(scratch)
    with fs.open_input_file(f"{root}/{manifest[0][1]}") as file:
        reader = FrameReader(file)
        wanted = reader.ids[3]
        assert list(reader.find([wanted])) == [(wanted, reader.read(3))]
        raw = file.seek(0) or file.read()
    # Any zstandard reader passes over the tables.
    content = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
    assert zlib.crc32(content) == zlib.crc32(b"".join(reader_bytes(raw)))


def reader_bytes(raw):
    import io

    class File(io.BytesIO):
        def size(self):
            return len(raw)

    reader = FrameReader(File(raw))
    return [reader.read(i) for i in range(len(reader.ids))]


def test_damage_is_seen(spark, docs_of, scratch):
    manifest = write_token_files(docs_of([(1, "some words here"), (2, "others")], 1), scratch, WORD, end_id=2)
    fs, root = open_folder(scratch)
    path = f"{root}/{manifest[0][1]}"
    with fs.open_input_file(path) as f:
        raw = bytearray(f.read())
    raw[12] ^= 1
    with fs.open_output_stream(path) as f:
        f.write(bytes(raw))
    with pytest.raises(Exception, match="damaged|checksum|corrupt|decompress"):
        read_token_files(spark, scratch, manifest).collect()


def test_empty_table(spark, empty, scratch):
    assert write_token_files(empty, scratch, WORD, end_id=2) == []
    assert read_token_files(spark, scratch, []).collect() == []
    assert pack(empty, BYTE, end_id=1).collect() == []


@settings(max_examples=200, deadline=None)
@given(lengths=st.lists(st.integers(1, 90), max_size=40))
def test_assign_covers_all_and_pads_nothing(lengths):
    pieces = assign(np.array(lengths, np.int64), 32, 1.0, 0.1)
    check_pieces(pieces, lengths, 32)


def check_pieces(pieces, lengths, size):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for d, start, n, s, offset in pieces:
        by_doc[d].append((start, n))
        by_sequence[s].append((offset, n))
    for parts, total in [(by_doc[d], n) for d, n in enumerate(lengths)] + [(x, None) for x in by_sequence.values()]:
        at = 0
        for start, n in sorted(parts):
            assert start == at and n > 0
            at += n
        if total is None:
            assert at == size or (at < size and at & (at - 1) == 0)
        else:
            assert at == total


def test_costs_are_balanced():
    lengths = np.array([30] * 10 + [2] * 20, np.int64)
    pieces = assign(lengths, 32, 1.0, 1.0)
    costs = defaultdict(float)
    for _, _, n, s, _ in pieces:
        costs[s] += n + n * n
    assert max(costs.values()) <= 32 + 32 * 32


def test_pack(odd, odd_rows):
    rows = pack(odd, BYTE, end_id=1, size=64, window=500).collect()
    encoded = [tuple([*i, 1]) for i in plain(BYTE, [t for _, t in odd_rows])]
    assert sum(r.length for r in rows) == sum(map(len, encoded))
    by_id = defaultdict(list)
    for r in rows:
        by_id[r.doc_id, r.doc_tokens].append((r.start, tuple(np.frombuffer(r.ids, "<u4").tolist())))
    once = {(d, len(e)): e for (d, _), e in zip(odd_rows, encoded, strict=True) if d not in (4, None)}
    for key, ids in once.items():
        assert sum((i for _, i in sorted(by_id[key])), ()) == ids
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == 64 or at & (at - 1) == 0
