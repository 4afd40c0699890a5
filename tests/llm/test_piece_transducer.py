"""The transducer's shortest paths against the public library's pieces, and back."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
import sentencepiece
from conftest import SMALL
from edge import EDGE, edge_docs, empty_docs, texts
from hypothesis import given, settings
from hypothesis import strategies as st

from accolade.llm import piece_transducer, queries

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=piece_transducer.piece_path())
MACHINE = piece_transducer.Transducer(piece_transducer.piece_path())
LETTERS = st.one_of(st.sampled_from(" \n\tabcdehinorst.,'ABTHE0123<>x▁é漢🙂()=-_/"), st.characters(exclude_categories=["Cs"], exclude_characters="\0"))


@settings(max_examples=1500, deadline=None)
@given(st.text(LETTERS, max_size=40))
def test_paths_and_decoding_are_the_library_s(text):
    ids = MACHINE.encode(text)
    assert ids.tolist() == LIBRARY.encode(text)
    assert MACHINE.decode(ids) == LIBRARY.decode(ids.tolist())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(3, 31999), max_size=12))
def test_any_ids_decode_as_the_library_does(ids):
    assert MACHINE.decode(np.array(ids, int)) == LIBRARY.decode(ids)


def test_probabilities_as_weights(tmp_path):
    """A unigram machine takes the likeliest pieces, whatever merges would do."""
    def field(number, body):
        return bytes([number << 3 | 2, len(body)]) + body

    def entry(piece, score, kind=1):
        return field(1, field(1, piece.encode()) + b"\x15" + np.float32(score).tobytes() + bytes([3 << 3, kind]))

    rules = field(3, bytes([3 << 3, 1, 4 << 3, 0]))
    entries = [("▁", -3), ("▁a", -1), ("ab", -1), ("abc", -9), ("c", -2), ("b", -2), ("a", -2), ("bc", -1.5)]
    model = tmp_path / "unigram.model"
    model.write_bytes(entry("<unk>", 0, 2) + b"".join(entry(*e) for e in entries) + field(2, bytes([3 << 3, 1])) + rules)
    machine = piece_transducer.Transducer(str(model))
    assert [machine.pieces[i] for i in machine.path("▁abc")] == ["▁a", "bc"]


def test_query_against_the_library(spark, con):
    got = {r["doc_id"]: r for r in queries.op8_weighted_transducer(spark, SMALL).collect()}
    for doc, text, _ in texts(con):
        ids = LIBRARY.encode(text)
        assert (got[doc]["ids"], got[doc]["n_tokens"], got[doc]["round_trip"]) == (ids, len(ids), True)
        assert got[doc]["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        assert got[doc]["n_fallback"] == sum(LIBRARY.is_byte(i) for i in ids)


def test_edges(spark):
    got = piece_transducer.encode(edge_docs(spark)).collect()
    assert sorted(((r["doc_id"], r["ids"]) for r in got), key=str) == sorted(((d, LIBRARY.encode(t or "")) for d, t, *_ in EDGE), key=str)
    assert piece_transducer.encode(empty_docs(spark)).count() == 0


def test_other_normalisers_are_refused(tmp_path):
    model = tmp_path / "x.model"
    model.write_bytes(b"\x1a\x04\x12\x02ab")  # a normaliser with a table of its own
    with pytest.raises(ValueError, match="normalise"):
        piece_transducer.Transducer(str(model))
