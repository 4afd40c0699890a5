"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Three machines are compiled from a model file and composed with each text:

* the normaliser: a space becomes the word mark, and one mark goes before the text;
* the pieces: an arc for every piece of the vocabulary, from the piece before it.  The arc from u
  to v has weight 0 if the model's merges leave the two apart (merging the letters of uv gives
  back u, v) and no weight otherwise.  For merge-trained models (BPE) a row of pieces is what the
  merges make of a text exactly if every neighbouring pair is such a pair, so of all paths through
  a text only the model's own has finite weight; for models with piece probabilities (unigram),
  an arc weighs the piece's negative log probability and any pair may follow;
* byte fallback: a letter without a piece passes through one arc for each of its UTF-8 bytes.

The shortest path in the tropical semiring (sums along a path, the smallest path wins) is found
by one pass over a text's letters that holds the best way to each place.  Where arcs weigh 0 or
nothing, no path is shorter than 0, so a depth-first search over the same composition, longest
pieces first, ends with the first path it completes; at most one way of weight 0 leads to a
place, so a place without a way on is never entered twice.  Decoding runs the
machine backwards: pieces to letters, runs of byte pieces to UTF-8, marks to spaces.

No piece of such a vocabulary has a word mark behind a letter, so paths of the words are
independent and a word's path is found once in a worker process and looked up afterwards; where
a vocabulary has such pieces, texts are not divided.  Texts pass one scan without a shuffle.

Defined results: null and empty texts have no ids and decode to the empty text; repeated rows and
keys are encoded one by one; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import math
import re
import sys
import zlib
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from accolade.llm.common import bounded_batches, over_batches

MARK = "\N{LOWER ONE EIGHTH BLOCK}"
#: Kinds of pieces and of models, and field numbers, in the public model format (fixed values).
NORMAL, USER_DEFINED, BYTE = 1, 4, 6
UNIGRAM, BPE = 1, 2
PIECES, TRAINER, NORMALIZER = 1, 2, 3
#: Words kept with their paths in a worker process, in two halves; longer words are not kept.  Arcs
#: kept with their weights.
WORDS_KEPT, LONGEST_KEPT, ARCS_KEPT = 600_000, 40, 400_000
MARKS = ".,;:!?"


def piece_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _fields(data: bytes):
    """(number, value) of each field of a protocol-buffers message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
            continue
        size = number() if kind == 2 else 8 if kind == 1 else 4
        yield tag >> 3, data[at:at + size]
        at += size


class Transducer:
    """The compiled machines of one model file."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            model = list(_fields(file.read()))
        self.pieces, scores, kinds = [], [], []
        for number, value in model:
            if number == PIECES:
                entry = dict(_fields(value))
                self.pieces.append(entry[1].decode())
                scores.append(float(np.frombuffer(entry.get(2, b"\0" * 4), "<f4")[0]))
                kinds.append(entry.get(3, NORMAL))
        trainer = dict(_fields(dict(model).get(TRAINER, b"")))
        rules = dict(_fields(dict(model).get(NORMALIZER, b"")))
        if rules.get(2) or rules.get(4, 1) or not rules.get(5, 1):
            raise ValueError("only models that normalise nothing but spaces are compiled")
        self._prefix, self._merges = bool(rules.get(3, 1)), trainer.get(3, UNIGRAM) == BPE
        usable = [i for i, k in enumerate(kinds) if k in (NORMAL, USER_DEFINED)]
        self._ids = {self.pieces[i]: i for i in usable}
        self._weights = {i: -scores[i] for i in usable}
        self._bytes = {int(self.pieces[i][3:5], 16): i for i, k in enumerate(kinds) if k == BYTE}
        self._byte_of = {i: b for b, i in self._bytes.items()}
        self._merge_weights = {p: self._weights[i] for p, i in self._ids.items()}
        self._heads = {p[:n] for p in self._ids for n in range(1, len(p))}  # what a longer piece may begin with
        # states of the piece machine: twice the piece's number + 1 (0: none), and 1 more where it goes on
        self._states = {s: 2 * (self._ids.get(s, -1) + 1) + (s in self._heads) for s in self._heads.union(self._ids)}
        divided = not any(MARK in p.lstrip(MARK) or "\n" in p for p in self._ids)
        self._words = re.compile(rf"\n|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+" if divided else r"(?s).+").findall
        self._arcs: dict[int, bool] = {}
        self._newer: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._letters = [p.replace(MARK, " ") for p in self.pieces]
        self._is_byte = np.zeros(len(self.pieces), bool)
        self._is_byte[list(self._byte_of)] = True

    def _merged(self, text: str) -> list[str]:
        """What the merges make of a text, best score first, the leftmost of equals."""
        own, weigh = list(text), self._merge_weights.get
        weights = [weigh(a + b, math.inf) for a, b in zip(own, own[1:])]
        while weights and (least := min(weights)) < math.inf:
            at = weights.index(least)
            own[at:at + 2] = [own[at] + own[at + 1]]
            del weights[at]
            if at:
                weights[at - 1] = weigh(own[at - 1] + own[at], math.inf)
            if at < len(weights):
                weights[at] = weigh(own[at] + own[at + 1], math.inf)
        return own

    def _follows(self, before: int, piece: int) -> bool:
        """Whether the merges leave two neighbouring pieces apart; -1 is the start or a byte."""
        arc = before << 32 | piece
        known = self._arcs.get(arc)
        if known is None:
            if len(self._arcs) >= ARCS_KEPT:
                self._arcs.clear()
            pair = [self.pieces[i] for i in (before, piece) if i >= 0]
            known = self._arcs[arc] = self._merged("".join(pair)) == pair
        return known

    def _choices(self, text: str, start: int) -> list[tuple[int, int]]:
        """(piece, end) of the arcs that leave a place, longest last; piece -1 goes through the bytes of a letter."""
        states, out = self._states, []
        for end in range(start + 1, len(text) + 1):
            state = states.get(text[start:end], 0)
            if state > 1:
                out.append(((state >> 1) - 1, end))
            elif end == start + 1:
                out.append((-1, end))
            if not state & 1:
                break
        return out

    def _free_path(self, text: str) -> list[int]:
        """Ids along the path of weight 0, for arcs that weigh 0 or nothing."""
        n, arcs = len(text), self._arcs
        closed, start, before, way = bytearray(n + 1), 0, -1, []
        choices = self._choices(text, 0) if n else []
        while start < n:
            while choices:
                piece, end = choices.pop()
                if closed[end]:
                    continue
                if piece >= 0:
                    known = arcs.get(before << 32 | piece)
                    if not (self._follows(before, piece) if known is None else known):
                        continue
                way.append((before, start, choices, piece))
                start, before = end, piece
                choices = self._choices(text, end) if end < n else []
                break
            else:
                closed[start] = 1
                if not way:
                    raise ValueError("the pieces leave no path through a text")
                before, start, choices, _ = way.pop()
        out = []
        for i, (_, at, _, piece) in enumerate(way):
            out += [piece] if piece >= 0 else [self._bytes[b] for b in text[at:way[i + 1][1] if i + 1 < len(way) else n].encode()]
        return out

    def path(self, text: str) -> list[int]:
        """Ids along the shortest path of a normalised text."""
        if self._merges:
            return self._free_path(text)
        n, ids, heads = len(text), self._ids, self._heads
        weights, pieces, origins = [0.0] + [math.inf] * n, [-1] * (n + 1), [0] * (n + 1)
        for start in range(n):
            so_far = weights[start]
            if so_far == math.inf:
                continue
            for end in range(start + 1, n + 1):
                own = text[start:end]
                piece = ids.get(own)
                if piece is not None:
                    weight = so_far + self._weights[piece]
                    if weight < weights[end]:
                        weights[end], pieces[end], origins[end] = weight, piece, start
                elif end == start + 1 and weights[end] == math.inf:  # a letter without a piece: through its bytes
                    weights[end], pieces[end], origins[end] = so_far, -1, start
                if own not in heads:
                    break
        out, at = [], n
        while at:
            piece, start = pieces[at], origins[at]
            out += [piece] if piece >= 0 else [self._bytes[b] for b in reversed(text[start:at].encode())]
            at = start
        return out[::-1]

    def _word(self, word: str) -> bytes:
        found = self._older.get(word)
        if found is None:
            core = word.rstrip(MARKS)
            if core != word and len(core) > 1:
                marks = word[len(core):]
                head, tail = self._newer.get(core) or self._word(core), self._newer.get(marks) or self._word(marks)
                # two shortest paths join into one if the arc between them has its weight
                last, first = int.from_bytes(head[-4:], "little"), int.from_bytes(tail[:4], "little")
                if self._merges and last not in self._byte_of and first not in self._byte_of and self._follows(last, first):
                    found = head + tail
            if found is None:
                found = np.array(self.path(word), "<i4").tobytes()
        if len(word) <= LONGEST_KEPT:
            if 2 * len(self._newer) >= WORDS_KEPT:
                self._older, self._newer = self._newer, {}
            self._newer[word] = found
        return found

    def normalise(self, text: str) -> str:
        return (MARK if self._prefix else "") + text.replace(" ", MARK) if text else ""

    def encode(self, text: str | None) -> np.ndarray:
        known, out = self._newer.get, []
        for word in self._words(self.normalise(text or "")):
            found = known(word)
            if found is None:
                found = self._word(word)
                known = self._newer.get  # the store may have been renewed
            out.append(found)
        return np.frombuffer(b"".join(out), "<i4")

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement letters."""
        letters, byte_of, out, at = self._letters, self._byte_of, [], 0
        if not len(ids):
            return ""
        listed, places = ids.tolist(), np.flatnonzero(self._is_byte[ids])
        for run in np.split(places, np.flatnonzero(np.diff(places) > 1) + 1) if len(places) else ():
            start, end = int(run[0]), int(run[-1]) + 1
            out += [letters[i] for i in listed[at:start]]
            out.append(bytes([byte_of[i] for i in listed[start:end]]).decode("utf-8", "replace"))
            at = end
        text = "".join(out + [letters[i] for i in listed[at:]])
        return text[1:] if self._prefix and text.startswith(" ") else text

    def fallback(self, ids: np.ndarray) -> int:
        return int(self._is_byte[ids].sum())


def transducer(path: str) -> Transducer:
    """The compiled machine of this worker process, which its later tasks find with its words."""
    kept = sys.modules.setdefault("accolade_worker_machines", ModuleType("accolade_worker_machines"))
    machines = kept.__dict__.setdefault("machines", {})
    if path not in machines:
        machines[path] = Transducer(path)
    return machines[path]


def encode(docs: DataFrame, model: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids, n_tokens, n_fallback, ids_crc32, round_trip) of every document.

    ``round_trip`` says whether the decoded ids are the text again.
    """
    bounded_batches(docs.sparkSession)
    path = model or piece_path()
    kind = docs.schema[key].dataType.simpleString()

    def make():
        machine = transducer(path)

        def step(batch):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            ids = [machine.encode(t) for t in texts]
            offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
            flat = pa.array(np.concatenate([*ids, np.empty(0, np.int32)]).astype(np.int32))
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), flat), pa.array(np.diff(offsets).astype(np.int64)),
                 pa.array([machine.fallback(i) for i in ids], pa.int64()),
                 pa.array([zlib.crc32(i.astype("<u4").tobytes()) for i in ids], pa.int64()),
                 pa.array([machine.decode(i) == t for i, t in zip(ids, texts, strict=True)])],
                names=["doc", "ids", "n_tokens", "n_fallback", "ids_crc32", "round_trip"])

        return step

    schema = f"doc {kind}, ids array<int>, n_tokens long, n_fallback long, ids_crc32 long, round_trip boolean"
    return over_batches(docs.select(key, text), make, schema).withColumnRenamed("doc", key)
