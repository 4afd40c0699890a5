"""Token ids, the packed sequences and the indexed token files against plain Python."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SMALL
from edge import EDGE, edge_docs, empty_docs, texts
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from accolade.llm import packing, queries, token_files
from accolade.llm.tokens import MARKS, WordIds, word_bpe_path

LIBRARY = Tokenizer.from_file(word_bpe_path())
WORDS = WordIds(word_bpe_path())


def plain(text):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids + [2]
    return np.array(ids, "<u4").tobytes()


def test_every_letter_before_every_mark():
    """Letters whose lower case is not one letter, such as İ, next to each mark, alone and at the end of a word."""
    letters = [chr(c) for c in range(0x41, 0x250) if chr(c).isalpha()]
    bodies = [f"{c}{m} ab{c}{m}{n} {c}b{m}" for c in letters for m, n in zip(MARKS, MARKS[::-1], strict=True)]
    bodies += ["YENİ, SERİ.", "İ()", "İ.İ, İS, aİ!?"]
    wanted = LIBRARY.encode_batch(bodies, add_special_tokens=False)
    assert [t for t, e in zip(bodies, wanted, strict=True) if np.frombuffer(WORDS.encode(t), "<u4").tolist() != e.ids] == []


@given(st.text(st.one_of(st.sampled_from(" \n\tabzAZé'.,!<|>endoftextΣİ́ ٣"), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_word_ids_are_the_library_s(text):
    assert WORDS.encode(text) + np.array([2], "<u4").tobytes() == plain(text)


def test_word_ids_of_documents(con):
    for _, text, _ in texts(con):
        assert WORDS.encode(text) + np.array([2], "<u4").tobytes() == plain(text)


@pytest.mark.parametrize("n", [0, 1, 2, 5, 300, 3000])
def test_perfect_hash_is_minimal(n):
    hashes = token_files.key_hashes(list(range(n)))
    seeds, slots = token_files.perfect_hash(hashes)
    assert sorted(slots.tolist()) == list(range(n)) and len(seeds) == max(1, n // 4)


def test_index_finds_its_keys_and_few_others():
    keys = [None, None, 3, 3, 3, 8, 10, 10]
    seeds, slots = token_files.index_of(keys)
    found, first, n = token_files.find([None, 3, 8, 10], seeds, slots)
    assert found.all() and first.tolist() == [0, 2, 5, 6] and n.tolist() == [2, 3, 1, 2]
    assert not token_files.find(list(range(100, 400)), seeds, slots)[0].any()


def test_token_file_query_against_plain_ids(spark, con):
    want, start = [], 0
    for doc, text, _ in texts(con):
        ids = plain(text)
        want.append((doc, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    got = queries.op3_perfect_hash_index(spark, SMALL).collect()
    assert sorted(map(tuple, got)) == want


@pytest.mark.parametrize("width", [2, 4])
def test_token_files_edges_and_lookup(spark, width):
    path = token_files.fresh_path(spark)
    token_files.write(edge_docs(spark), path, shards=3, width=width, block_bytes=200)
    got = sorted(token_files.digests(token_files.lookup(spark, path)).collect(), key=lambda r: r["start"])
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == Counter(
        (d, len(plain(t)) // 4, zlib.crc32(plain(t))) for d, t, *_ in EDGE)
    assert [r["start"] for r in got] == np.cumsum([0] + [r["n_tokens"] for r in got])[:-1].tolist()
    keys = [r["doc_id"] for r in got]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    some = token_files.digests(token_files.lookup(spark, path, [1, 7, None, 99])).collect()
    assert sorted(map(str, some)) == sorted(str(r) for r in got if r["doc_id"] in (1, 7, None))
    empty = token_files.fresh_path(spark)
    token_files.write(empty_docs(spark), empty)
    assert token_files.lookup(spark, empty).count() == 0


def check_packs(rows, capacity, want):
    """Each id in one piece; gapless sequences; returns the share of padding."""
    per_doc, per_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        per_doc[r["doc_id"], r["doc_tokens"]].append((r["start"], r["length"], r["ids_crc32"]))
        per_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in per_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(per_sequence) == list(range(len(per_sequence)))
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    return 1 - sum(r["length"] for r in rows) / (capacity * len(per_sequence)) if rows else 0


def wanted(docs, capacity):
    want = Counter()
    for doc, text, *_ in docs:
        ids = plain(text)
        for at in range(0, len(ids), 4 * capacity):
            want[doc, at // 4, len(ids[at:at + 4 * capacity]) // 4, zlib.crc32(ids[at:at + 4 * capacity])] += 1
    return want


def test_packing_query(spark, con):
    rows = queries.op7_shortest_pack_first(spark, SMALL).collect()
    assert check_packs(rows, 4096, wanted(texts(con), 4096)) < 0.05


def test_packing_edges(spark):
    rows = packing.pack(edge_docs(spark), capacity=64).collect()
    check_packs(rows, 64, wanted(EDGE, 64))
    assert packing.pack(empty_docs(spark)).count() == 0
    carried = packing.pack(edge_docs(spark), capacity=64, with_ids=True).collect()
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] for r in carried)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 10**12), max_size=30))
def test_histogram_placement(counts):
    steps = packing.shortest_pack_first(counts, 50)
    placed = Counter()
    for length, rank, count, _, offset in sorted(steps):
        assert rank == placed[length] and offset + length <= 50
        placed[length] += count
    assert placed == Counter(counts)
    spans = sorted((first, first + count, offset, offset + length) for length, _, count, first, offset in steps)
    edges = sorted({s[0] for s in spans} | {s[1] for s in spans})
    for edge in edges[:-1]:  # at each sequence where anything changes
        inside = sorted((a, b) for lo, hi, a, b in spans if lo <= edge < hi)
        assert [a for a, _ in inside] == [0] + [b for _, b in inside][:-1]
