"""SentencePiece encoding and decoding by a shared-prefix Viterbi search.

A text is cut into marked words (runs of the space mark and what follows);
no piece crosses from a word into the next mark, so the words can be encoded
one by one.  The distinct words of a batch are sorted, which lays them out as
a trie in depth-first order: going from one word to the next, the forward
states of their common prefix are kept and only the new characters extend
them.

A forward state holds, per prefix, its best score and last piece.  For a
model of additive scores that is the usual Viterbi recursion.  For a merge
(BPE) model the score of a path is not a sum: a sequence of pieces is what
merging yields exactly when every two neighbours are what merging their two
texts yields.  A step is therefore open only to pieces compatible with the
last piece of the prefix before them, and the result equals the library's.
"""

from __future__ import annotations

import heapq
import re
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from scorewright.llm.common import ship_package

MARK = "▁"
WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
# what a worker keeps between texts: ids of words, and which pieces may be
# neighbours (a pair and its place in the table take about 100 bytes)
WORD_BYTES = 48 << 20
PAIR_BYTES = 24 << 20
ENTRY = 120  # a word's place in the tables
TEXTS = 512  # encoded at a time
_NO_TAIL = object()
_ALONE = -1e10  # score of a character outside the vocabulary


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of a protocol-buffer message's fields."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield tag >> 3, data[at:at + size]
        at += size


def check_model(data: bytes) -> None:
    """Raise ``ValueError`` unless the model file says what the encoder does:
    merges, a space mark before the text and for every space, nothing else
    changed.  Fixed values: the field numbers of the model file (trainer 2
    with model type 3; normalizer 3 with rules 2, dummy prefix 3, extra white
    space 4, escaping 5) and the type number of merge models, 2."""
    parts = dict((n, dict(_fields(v))) for n, v in _fields(data) if n in (2, 3))
    trainer, normal = parts.get(2, {}), parts.get(3, {})
    if trainer.get(3, 1) != 2:
        raise ValueError(f"model type {trainer.get(3, 1)}: only merge (BPE) models are built")
    if normal.get(2) or normal.get(3, 1) != 1 or normal.get(4, 1) != 0 or normal.get(5, 1) != 1:
        raise ValueError("the model's normalisation is not built: only a space mark before the text and for every space")


class Pieces:
    """A vocabulary: piece -> (id, score), ids of the byte pieces, and
    whether pieces come from merges."""

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: list[int] | None, unknown: int,
                 merges: bool = True):
        self.pieces, self.byte_ids, self.unknown, self.merges = pieces, byte_ids, unknown, merges
        self.text = {i: p for p, (i, _) in pieces.items()}
        self._pairs: dict[str, dict[str, bool]] = {}
        self._kept = 0
        # every tail of a piece; with its score if it is a piece that a path
        # can use (for merges: one that merging its own text yields)
        self.tails: dict[str, float | None] = {p[k:]: None for p in pieces for k in range(1, len(p))}
        for piece, (_, score) in pieces.items():
            if not merges or self.merge(piece) == [piece]:
                self.tails[piece] = score
            else:
                self.tails.setdefault(piece, None)

    @classmethod
    def load(cls, path: str) -> Pieces:
        """Of a merge model without a normalisation of its own; any other
        kind of model file is refused."""
        import sentencepiece

        with open(path, "rb") as fh:
            check_model(fh.read())
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, byte_ids = {}, {}
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                pieces[piece] = (i, model.get_score(i))
        bytes_known = [byte_ids[b] for b in range(256)] if len(byte_ids) == 256 else None
        return cls(pieces, bytes_known, model.unk_id())

    def merge(self, text: str, cut: int | None = None) -> list[str] | None:
        """The pieces that merging yields: always the neighbours whose joint
        piece scores highest, the leftmost of equals.  None as soon as one of
        them lies across the place ``cut``, since pieces only grow."""
        parts: list[str | None] = list(text)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        known, size = self.pieces.get, len(parts)
        queue = [(-found[1], i, left, right) for i, (left, right) in enumerate(zip(text, text[1:]))
                 if (found := known(left + right)) is not None]
        heapq.heapify(queue)
        while queue:
            _, i, left, right = heapq.heappop(queue)
            j = after[i]
            if parts[i] != left or j >= size or parts[j] != right:
                continue
            end = after[j]
            if cut is not None and i < cut < end:
                return None
            joint = parts[i] = left + right
            parts[j], after[i] = None, end
            if end < size:
                before[end] = i
                if (found := known(joint + parts[end])) is not None:
                    heapq.heappush(queue, (-found[1], i, joint, parts[end]))
            start = before[i]
            if start >= 0 and (found := known(parts[start] + joint)) is not None:
                heapq.heappush(queue, (-found[1], start, parts[start], joint))
        return [p for p in parts if p is not None]

    def compatible(self, left: str, right: str) -> bool:
        """Whether merging the joint text yields these two pieces."""
        after = self._pairs.get(left)
        known = None if after is None else after.get(right)
        if known is None:
            if self._kept * 100 >= PAIR_BYTES:
                self._forget_pairs()
            after = self._pairs.setdefault(sys.intern(left), {})
            known = after[sys.intern(right)] = self.merge(left + right, len(left)) == [left, right]
            self._kept += 1
        return known

    def _forget_pairs(self) -> None:
        """Drop the older half."""
        for left in list(self._pairs):
            if self._kept * 200 <= PAIR_BYTES:
                break
            self._kept -= len(self._pairs.pop(left))

    def ending_at(self, word: str, end: int) -> list[str]:
        """The pieces that end ``word[:end]``, shortest first; a character
        outside the vocabulary can stand alone."""
        tails, found = self.tails, []
        for start in range(end - 1, -1, -1):
            text = word[start:end]
            step = tails.get(text, _NO_TAIL)
            if step is _NO_TAIL:
                break  # nothing longer can be a piece
            if step is not None:
                found.append(text)
        if not found or len(found[0]) > 1:
            found.insert(0, word[end - 1])
        return found

    def extend(self, word: str, end: int, scores: list[float], last: list[str | None]) -> tuple[float, str]:
        """Forward state of ``word[:end]`` from those of its shorter prefixes."""
        found = self.ending_at(word, end)
        if self.merges:
            pairs = self._pairs
            for text in reversed(found):  # exactly one is open
                before = last[end - len(text)]
                if before is None:
                    return 0.0, text
                after = pairs.get(before)
                fits = None if after is None else after.get(text)
                if fits or (fits is None and self.compatible(before, text)):
                    return 0.0, text
        best, piece = -np.inf, found[0]
        for text in reversed(found):
            step = self.tails.get(text)
            score = scores[end - len(text)] + (_ALONE if step is None else step)
            if score > best:
                best, piece = score, text
        return best, piece

    def ids_of(self, parts: list[str]) -> list[int]:
        out: list[int] = []
        for part in parts:
            found = self.pieces.get(part)
            if found is not None:
                out.append(found[0])
            elif self.byte_ids is not None:
                out.extend(self.byte_ids[b] for b in part.encode("utf-8"))
            else:
                out.append(self.unknown)
        return out

    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of distinct words (as 32-bit integers), by one depth-first
        pass over their trie."""
        out: dict[str, bytes] = {}
        scores, last, path = [0.0], [None], ""
        for word in sorted(words):
            if self.merges and MARK * 2 in word:
                # runs of marks tie on score, so order in the text decides
                out[word] = array("i", self.ids_of(self.merge(word))).tobytes()
                continue
            shared, most = 0, min(len(path), len(word))
            while shared < most and path[shared] == word[shared]:
                shared += 1
            del scores[shared + 1:], last[shared + 1:]
            for end in range(shared + 1, len(word) + 1):
                score, piece = self.extend(word, end, scores, last)
                scores.append(score)
                last.append(piece)
            path = word
            parts, at = [], len(word)
            while at:
                parts.append(last[at])
                at -= len(last[at])
            out[word] = array("i", self.ids_of(parts[::-1])).tobytes()
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ids: pieces joined, bytes put together, marks to
        spaces, the mark before the text dropped."""
        byte_of = {} if self.byte_ids is None else self._byte_of()
        raw = b"".join(bytes([byte_of[i]]) if i in byte_of else self.text.get(i, "").encode("utf-8") for i in ids)
        text = raw.decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text

    def _byte_of(self) -> dict[int, int]:
        if not hasattr(self, "_bytes"):
            self._bytes = {i: b for b, i in enumerate(self.byte_ids)}
        return self._bytes


class TextEncoder:
    """Encodes and decodes texts; the distinct words of a call are encoded
    once, and remembered within ``WORD_BYTES``.  Words that only one call had
    are forgotten first, the oldest of them before the others."""

    def __init__(self, pieces: Pieces):
        self.pieces, self.known, self.once, self.size = pieces, {}, {}, 0
        self.raw = None

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        split = [WORDS.findall((MARK + t).replace(" ", MARK)) if t else [] for t in texts]
        words = set().union(*split)
        for again in words & self.once.keys():
            del self.once[again]
        new = self.pieces.encode_words(list(words - self.known.keys()))
        self.known.update(new)
        out = [np.frombuffer(b"".join(map(self.known.__getitem__, words)), dtype=np.int32) for words in split]
        self.once.update(dict.fromkeys(new))
        self.size += sum(map(sys.getsizeof, new)) + sum(map(sys.getsizeof, new.values())) + ENTRY * len(new)
        if self.size > WORD_BYTES:
            self._forget()
        return out

    def _forget(self) -> None:
        for candidates in (self.once, self.known):
            for word in list(candidates):
                if self.size <= WORD_BYTES * 3 // 4:
                    return
                self.once.pop(word, None)
                self.size -= sys.getsizeof(word) + sys.getsizeof(self.known.pop(word)) + ENTRY

    def decode(self, ids: np.ndarray) -> str:
        """As :meth:`Pieces.decode`, by table."""
        if self.raw is None:
            byte_of = {} if self.pieces.byte_ids is None else self.pieces._byte_of()
            top = max([*self.pieces.text, *byte_of, self.pieces.unknown]) + 1
            self.raw = [bytes([byte_of[i]]) if i in byte_of else self.pieces.text.get(i, "").encode("utf-8")
                        for i in range(top)]
        text = b"".join(map(self.raw.__getitem__, ids.tolist())).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


_ENCODERS: dict[str, TextEncoder] = {}


def text_encoder(path: str) -> TextEncoder:
    """One per worker process and model: what it has learnt serves the next
    task too (a function of the module, so that tasks share its globals)."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TextEncoder(Pieces.load(path))
    return _ENCODERS[path]


def _code(path: str, keep_ids: bool):
    def run(batches) -> Iterator[pa.RecordBatch]:
        coder = text_encoder(path)
        for batch in batches:
            texts, keep = batch.column("text"), [c for c in batch.schema.names if c != "text"]
            for a in range(0, batch.num_rows, TEXTS):
                part = texts.slice(a, TEXTS).to_pylist()
                ids = coder.encode(part)
                cols = [batch.column(c).slice(a, TEXTS) for c in keep] + [
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()),
                    pa.array([coder.decode(x) == (t or "") for x, t in zip(ids, part)], pa.bool_())]
                names = [*keep, "n_pieces", "ids_crc32", "round_trip"]
                if keep_ids:
                    bounds = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                    flat = np.concatenate(ids) if ids else np.zeros(0, dtype=np.int32)
                    cols.append(pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat, pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)
    return run


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text",
           keep: dict[str, str] | None = None, keep_ids: bool = True) -> DataFrame:
    """One row per row of ``docs``: the columns ``keep`` (new name -> column;
    default the id as ``doc_id``), ``n_pieces, ids_crc32`` (of the ids as
    little-endian unsigned 32-bit integers), ``round_trip`` (whether decoding
    gives the text back) and, with ``keep_ids``, ``ids``.

    Null and empty texts have no ids and decode to the empty text; a text
    that contains the space mark itself decodes to spaces instead and is told
    by ``round_trip``.  Null ids and repeated rows are rows like others; an
    empty input gives an empty result.
    """
    ship_package(docs.sparkSession)
    keep = {"doc_id": id_col} if keep is None else keep
    rows = docs.select(*(F.col(c).alias(k) for k, c in keep.items()), F.col(text_col).cast("string").alias("text"))
    schema = rows.drop("text").schema.add("n_pieces", "long").add("ids_crc32", "long").add("round_trip", "boolean")
    if keep_ids:
        from pyspark.sql.types import ArrayType, IntegerType

        schema = schema.add("ids", ArrayType(IntegerType()))
    return rows.mapInArrow(_code(model, keep_ids), schema)
