"""Token files as wavelet matrices.

Texts are encoded in id order; the tokens of consecutive documents form
shards, and each shard is one compressed file: a wavelet matrix of its token
sequence.  Bit-plane p holds the p-th highest bit of every token, after the
tokens were stably ordered by the planes before (zeros first).  Planes are
compressed in pieces, and a stored directory tells the ones before each, so
rank takes constant and select logarithmic time on the pieces it meets.  One
file thus answers, without inflating the rest: the token at a position, how
often a token occurs in a range, where its i-th occurrence is, and the tokens
of a document.  ``count_tokens``, ``find_tokens`` and ``document_tokens`` ask
all files of a manifest.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, functions as F

from scorewright.llm.common import row_id, shared_dir, ship_package
from scorewright.llm.store import StoredFile, clear_temporary, open_stored

MAGIC = b"WMTOK02\n"
END_ID = 1
SHARD_TOKENS = 1 << 22
PIECE_BYTES = 1 << 15
PIECE_BITS = 8 * PIECE_BYTES
ANSWER_VALUES = 1 << 16  # tokens or rows of an answer that are sent at a time
BLOCK_BYTES = 12 << 20  # texts of about this size are encoded at a time
# a worker keeps the ids of twice so many words between texts (about 200 bytes each)
CACHE_WORDS = 400_000
MANIFEST = "part int, seq int, file string, docs bigint, tokens bigint, bytes bigint, sha256 string"


class Plane:
    """One bit-plane in pieces of ``PIECE_BYTES``, each fetched when it is
    first asked for.  ``ones`` is the stored directory: the ones before every
    piece; a fetched piece gets the ones before each of its 64-bit words."""

    def __init__(self, ones: np.ndarray, fetch):
        self.ones, self._fetch, self._held = ones, fetch, {}

    @classmethod
    def of(cls, bit: np.ndarray) -> Plane:
        raw = np.packbits(bit, bitorder="little")
        raw = np.pad(raw, (0, -len(raw) % 8))
        starts = range(0, len(raw), PIECE_BYTES)
        counts = [np.bitwise_count(raw[a:a + PIECE_BYTES]).sum(dtype=np.int64) for a in starts]
        return cls(np.cumsum([0, *counts], dtype=np.int64), lambda k: raw[k * PIECE_BYTES:(k + 1) * PIECE_BYTES])

    @property
    def pieces(self) -> int:
        return len(self.ones) - 1

    def raw(self, k: int) -> np.ndarray:
        return self._fetch(k)

    def _piece(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        if k not in self._held:
            words = self._fetch(k).view("<u8")
            counts = np.bitwise_count(words).astype(np.int64)
            self._held[k] = words, self.ones[k] + np.cumsum(counts) - counts
        return self._held[k]

    def look(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bits at places, and the ones before each.  A place after the
        last bit has the ones of the whole plane."""
        bits, ranks = np.zeros(len(at), dtype=bool), np.full(len(at), self.ones[-1])
        piece = at // PIECE_BITS
        for k in np.unique(piece[piece < self.pieces]).tolist():
            words, before = self._piece(k)
            here = np.nonzero(piece == k)[0]
            inside = at[here] - k * PIECE_BITS
            here, inside = here[inside < 64 * len(words)], inside[inside < 64 * len(words)]
            word, low = words[inside >> 6], (inside & 63).astype(np.uint64)
            one = np.uint64(1)
            bits[here] = (word >> low) & one != 0
            ranks[here] = before[inside >> 6] + np.bitwise_count(word & ((one << low) - one))
        return bits, ranks

    def select(self, bit: int, nth: np.ndarray) -> np.ndarray:
        """Places of the nth (from 0) bits of that value: binary search over
        pieces, then over words."""
        out = np.empty(len(nth), dtype=np.int64)
        starts = self.ones if bit else np.arange(len(self.ones)) * PIECE_BITS - self.ones
        piece = np.searchsorted(starts[:-1], nth, side="right") - 1
        for k in np.unique(piece).tolist():
            words, before = self._piece(k)
            here = np.nonzero(piece == k)[0]
            if not bit:
                before = k * PIECE_BITS + np.arange(len(before)) * 64 - before
            at = np.searchsorted(before, nth[here], side="right") - 1
            spread = np.unpackbits(words[at].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little") == bit
            hit = spread & (np.cumsum(spread, axis=1) == (nth[here] - before[at] + 1)[:, None])
            out[here] = k * PIECE_BITS + at * 64 + np.argmax(hit, axis=1)
        return out


class WaveletMatrix:
    """``planes``: per bit, highest first; ``zeros``: how many zeros each has."""

    def __init__(self, planes: list[Plane], zeros: list[int], n: int):
        self.n, self.bits, self.planes, self.zeros = n, len(planes), planes, zeros

    @classmethod
    def build(cls, tokens: np.ndarray, bits: int) -> WaveletMatrix:
        level, planes, zeros = tokens, [], []
        for p in range(bits - 1, -1, -1):
            bit = (level >> np.array(p, level.dtype)) & np.array(1, level.dtype) != 0
            planes.append(Plane.of(bit))
            low = level[~bit]
            zeros.append(len(low))
            level = np.concatenate([low, level[bit]])
        return cls(planes, zeros, len(tokens))

    def _kind(self):
        return np.uint16 if self.bits <= 16 else np.uint32

    def access(self, at: np.ndarray) -> np.ndarray:
        """The tokens at positions."""
        at, out = np.asarray(at, dtype=np.int64), np.zeros(len(at), dtype=self._kind())
        for plane, zeros in zip(self.planes, self.zeros):
            bit, ones = plane.look(at)
            at = np.where(bit, zeros + ones, at - ones)
            out = (out << 1) | bit
        return out

    def _ranges(self, tokens: np.ndarray, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        known = (tokens >= 0) & (tokens < 1 << self.bits)
        ends = np.concatenate([np.full(len(tokens), start), np.where(known, end, start)])
        for p, (plane, zeros) in enumerate(zip(self.planes, self.zeros)):
            bit = np.tile(tokens >> (self.bits - 1 - p) & 1 == 1, 2)
            ones = plane.look(ends)[1]
            ends = np.where(bit, zeros + ones, ends - ones)
        return ends[:len(tokens)], ends[len(tokens):]

    def count(self, tokens: np.ndarray, start: int = 0, end: int | None = None) -> np.ndarray:
        """Occurrences of each token in [start, end); 0 for what is no id."""
        first, last = self._ranges(np.asarray(tokens, dtype=np.int64), start, self.n if end is None else end)
        return last - first

    def locate(self, token: int, nth: np.ndarray) -> np.ndarray:
        """Positions of the nth occurrences (from 0) of a token."""
        first, last = self._ranges(np.array([token], dtype=np.int64), 0, self.n)
        at = np.asarray(nth, dtype=np.int64)
        if len(at) and not (0 <= at.min() and at.max() < last[0] - first[0]):
            raise IndexError(token)
        at = first[0] + at
        for p in range(self.bits - 1, -1, -1):
            bit = token >> (self.bits - 1 - p) & 1
            at = self.planes[p].select(bit, at - self.zeros[p] if bit else at)
        return at

    def tokens(self) -> np.ndarray:
        """The whole sequence, by undoing the orderings from the last plane."""
        kind = self._kind()
        out = np.zeros(self.n, dtype=kind)
        for p in range(self.bits - 1, -1, -1):
            plane = self.planes[p]
            raw = np.concatenate([plane.raw(k) for k in range(plane.pieces)]) if plane.pieces else np.zeros(0, np.uint8)
            bit = np.unpackbits(raw, count=self.n, bitorder="little").astype(bool)
            level = np.empty_like(out)
            level[~bit] = out[:self.zeros[p]]
            level[bit] = out[self.zeros[p]:] | kind(1 << (self.bits - 1 - p))
            out = level
        return out


def dump(matrix: WaveletMatrix, doc_ids: list, lengths: np.ndarray) -> bytes:
    """A shard file: header, sizes of all sections, document table, directory
    of ones, pieces of the planes; each section compressed by itself."""
    pack = zstandard.ZstdCompressor(level=1).compress
    has_id = np.array([d is not None for d in doc_ids], dtype=np.uint8)
    ids = np.array([0 if d is None else d for d in doc_ids], dtype="<i8")
    ones = np.concatenate([p.ones for p in matrix.planes]).astype("<i8")
    parts = [pack(x.tobytes()) for x in (has_id, ids, lengths.astype("<i8"), ones)]
    parts += [pack(p.raw(k).tobytes()) for p in matrix.planes for k in range(p.pieces)]
    head = MAGIC + struct.pack("<qqqq", matrix.n, len(ids), matrix.bits, len(parts))
    head += struct.pack(f"<{matrix.bits}q", *matrix.zeros) + struct.pack(f"<{len(parts)}q", *map(len, parts))
    return head + b"".join(parts)


class TokenFile:
    """A shard file open for questions: header, document table and directory
    are read at once, a piece of a plane only when an answer needs it."""

    def __init__(self, stream):
        self._stream = stream
        head = stream.read(len(MAGIC) + 32)
        if head[:len(MAGIC)] != MAGIC:
            raise ValueError("not a token file")
        n, _, bits, sections = struct.unpack_from("<qqqq", head, len(MAGIC))
        numbers = struct.unpack(f"<{bits + sections}q", stream.read(8 * (bits + sections)))
        zeros, sizes = list(numbers[:bits]), numbers[bits:]
        self._unpack = zstandard.ZstdDecompressor().decompress
        self._ends = (np.cumsum(sizes) + len(head) + 8 * len(numbers)).tolist()
        self._sizes = sizes
        has_id, ids = self._section(0, np.uint8), self._section(1, "<i8")
        self.doc_ids = [int(d) if h else None for h, d in zip(has_id.tolist(), ids.tolist())]
        self.lengths = self._section(2, "<i8")
        self.ends = np.cumsum(self.lengths)
        ones = self._section(3, "<i8").reshape(bits, -1)
        planes = [Plane(row, self._fetch(4 + p * (len(row) - 1))) for p, row in enumerate(ones)]
        self.matrix = WaveletMatrix(planes, zeros, n)

    def _section(self, i: int, kind) -> np.ndarray:
        self._stream.seek(self._ends[i] - self._sizes[i])
        return np.frombuffer(self._unpack(self._stream.read(self._sizes[i])), kind)

    def _fetch(self, first: int):
        return lambda k: self._section(first + k, np.uint8)

    def document(self, row: int) -> np.ndarray:
        """The tokens of the file's row-th document, end id included."""
        return self.matrix.access(np.arange(self.ends[row] - self.lengths[row], self.ends[row]))


# what the chunk cuts below rely on; fixed values of the tokenizer files
CUT_NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
CUT_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def cuts_at_spaces(file: dict) -> bool:
    """Whether a tokenizer file normalises and cuts texts as
    :class:`ChunkEncoder` takes for granted."""
    before = file.get("pre_tokenizer") or {}
    first = (before.get("pretokenizers") or [{}])[0]
    return bool(file.get("normalizer") == CUT_NORMALIZER and first.get("type") == "Split"
                and first.get("pattern") == {"Regex": CUT_PATTERN} and first.get("behavior") == "Removed"
                and first.get("invert") and file["model"].get("end_of_word_suffix"))


def _strings(array: pa.StringArray) -> list[str]:
    """As ``to_pylist``, by one conversion of all."""
    return array.to_numpy(zero_copy_only=False).tolist()


class ChunkEncoder:
    """Ids of whole texts by the tokenizers library.

    For the tokenizer that :func:`cuts_at_spaces` tells, no token crosses an
    ASCII white space, so a text's ids are those of its chunks between them:
    the chunks of a block of texts are told apart by Arrow, each distinct one
    is resolved once, and the ids are gathered by the chunks' numbers.  A
    chunk of letters and closing punctuation is cut between the two, as the
    pre-tokenizer does.  Its letters are one word of the pre-tokenizer, with
    one end-of-word token, so new words are encoded many at a time and told
    apart by these tokens; where their number does not fit, one by one.  Any
    other tokenizer gets whole texts."""

    TAIL = ".,!|#$%&*;:?"
    JOINED = 500

    def __init__(self, path: str, dtype=np.uint16, word_end: str | None = None):
        from tokenizers import Tokenizer

        self.tokenizer, self.dtype = Tokenizer.from_file(path), dtype
        self.words, self.before = {"": b""}, {}  # this generation's and the last one's
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.batch = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        self.ends = None
        if word_end:
            self.ends = np.zeros(self.vocabulary, dtype=bool)
            for token, i in self.tokenizer.get_vocab().items():
                self.ends[i] = token.endswith(word_end)

    def _one_by_one(self, texts: list[str]) -> list[bytes]:
        found = self.batch(texts, add_special_tokens=False)
        return [np.array(f.ids, dtype=self.dtype).tobytes() for f in found]

    def _learn_words(self, words: list[str]) -> None:
        groups = [words[a:a + self.JOINED] for a in range(0, len(words), self.JOINED)]
        width = np.dtype(self.dtype).itemsize
        for group, found in zip(groups, self.batch([" ".join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(found.ids, dtype=self.dtype)
            cuts = (np.nonzero(self.ends[ids])[0] + 1) * width
            if len(cuts) == len(group) and (not group or cuts[-1] == ids.nbytes):
                raw, bounds = ids.tobytes(), [0, *cuts.tolist()]
                self.words.update(zip(group, [raw[a:b] for a, b in zip(bounds, bounds[1:])]))
            else:
                self.words.update(zip(group, self._one_by_one(group)))

    def _recall(self, wanted: set[str]) -> set[str]:
        """Bring what the last generation knows into this one; the others."""
        wanted -= self.words.keys()
        for word in wanted & self.before.keys():
            self.words[word] = self.before[word]
        return wanted - self.before.keys()

    def _resolve(self, chunks: pa.StringArray) -> list[bytes]:
        """Ids of distinct chunks."""
        lower = pc.ascii_lower(chunks)
        core = pc.ascii_rtrim(lower, characters=self.TAIL)
        plain = pc.and_(pc.string_is_ascii(lower), pc.ascii_is_alpha(core)).to_numpy(zero_copy_only=False)
        texts, heads, whole = _strings(lower), _strings(core), []
        for i in np.nonzero(~plain)[0].tolist():
            # in lower case too: a mark split off would join the punctuation
            if not (heads[i].isalpha() and heads[i].lower().isalpha()):
                # as it is: in lower case it might name a special token
                heads[i] = texts[i] = chunks[i].as_py()
                whole.append(i)
        tails = [text[len(head):] for text, head in zip(texts, heads)]
        if len(self.words) > CACHE_WORDS:
            self.words, self.before = {"": b""}, self.words
        odd = {texts[i] for i in whole}
        self._learn_words(list(self._recall(set(heads) - odd)))
        words, new = self.words, list(self._recall(odd.union(tails)))
        words.update(zip(new, self._one_by_one(new)))
        return [words[head] + words[tail] if tail else words[head] for head, tail in zip(heads, tails)]

    def encode_block(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, each text's with the end
        id, and how many each text has.  Null texts are empty."""
        texts, width = pc.fill_null(texts, ""), np.dtype(self.dtype).itemsize
        end = np.array([END_ID], dtype=self.dtype).tobytes()
        if self.ends is None:
            coded = [ids + end for ids in self._one_by_one(texts.to_pylist())]
            return np.frombuffer(b"".join(coded), dtype=self.dtype), np.array([len(c) // width for c in coded], dtype=np.int64)
        split = pc.ascii_split_whitespace(texts)
        chunks = split.flatten().dictionary_encode()
        ids = [*self._resolve(chunks.dictionary), end]
        stops = np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))
        codes = np.insert(chunks.indices.to_numpy(zero_copy_only=False), stops, len(ids) - 1)
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // width
        starts = np.cumsum(sizes) - sizes
        flat, counts = np.frombuffer(b"".join(ids), dtype=self.dtype), sizes[codes]
        ends = np.cumsum(counts)
        at = np.repeat((starts[codes] - ends + counts).astype(np.int32), counts)
        at += np.arange(len(at), dtype=np.int32)
        return flat[at], np.diff(ends[stops + np.arange(len(stops))], prepend=0)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian ids of every text, without the end id."""
        ids, counts = self.encode_block(pa.array(texts, pa.string()))
        stops = np.cumsum(counts)
        return [ids[a:b - 1].tobytes() for a, b in zip((stops - counts).tolist(), stops.tolist())]


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """One per worker process and tokenizer."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _ENCODERS:
        import json

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        top = max([*file["model"]["vocab"].values(), *(t["id"] for t in file.get("added_tokens", []))], default=0)
        _ENCODERS[path] = ChunkEncoder(path, np.uint16 if top < 65_000 else np.uint32,
                                       file["model"]["end_of_word_suffix"] if cuts_at_spaces(file) else None)
    return _ENCODERS[path]


def _blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of at most BLOCK_BYTES of text, or of one row."""
    stops = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(stops):
        before = int(stops[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(stops, before + BLOCK_BYTES, side="right")))
        yield batch.slice(first, last - first)
        first = last


def _write_shards(folder: str, tokenizer: str, shard_tokens: int):
    def run(batches) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, coder = TaskContext.get().partitionId(), encoder(tokenizer)
        bits = int(max(coder.vocabulary, END_ID + 1) - 1).bit_length()
        done, ids, coded, lengths, size = [], [], [], [], 0

        def flush():
            nonlocal ids, coded, lengths, size
            if not ids:
                return
            tokens = np.concatenate(coded)
            file = StoredFile(folder, f"part-{part:06d}-{len(done):06d}.wmt")
            file.write(dump(WaveletMatrix.build(tokens, bits), ids, np.concatenate(lengths)))
            done.append((part, len(done), file.name, len(ids), len(tokens), file.size, file.close()))
            ids, coded, lengths, size = [], [], [], 0

        for batch in batches:
            for block in _blocks(batch):
                tokens, counts = coder.encode_block(block.column("text"))
                doc_ids, stops, first = block.column("doc_id").to_pylist(), np.cumsum(counts), 0
                while first < len(doc_ids):
                    # up to the text with which the shard is full
                    before = int(stops[first] - counts[first])
                    last = min(int(np.searchsorted(stops, shard_tokens - size + before)), len(doc_ids) - 1)
                    ids += doc_ids[first:last + 1]
                    coded.append(tokens[before:int(stops[last])])
                    lengths.append(counts[first:last + 1])
                    size, first = size + len(coded[-1]), last + 1
                    if size >= shard_tokens:
                        flush()
        flush()
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(zip(*done), (pa.int32(), pa.int32(), pa.string(), pa.int64(),
                                                             pa.int64(), pa.int64(), pa.string()))],
                names=["part", "seq", "file", "docs", "tokens", "bytes", "sha256"])
    return run


def write(docs: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
          shard_tokens: int = SHARD_TOKENS, parts: int | None = None) -> DataFrame:
    """Encode every text with an end id and write the shards, in ascending id
    order, into ``folder``; returns the manifest (``part, seq, file, docs,
    tokens, bytes, sha256``; part and seq give the order).

    Null texts are encoded as empty ones; null ids come first; equal ids are
    ordered by their text's hash; every row is a document of its own.
    """
    spark = docs.sparkSession
    ship_package(spark)
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
                       F.xxhash64(F.coalesce(text, F.lit(""))).alias("tie"), row_id().alias("rid"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie"), F.col("rid")]
    dealt = rows.repartitionByRange(*([parts] if parts else []), *order).sortWithinPartitions(*order)
    manifest = f"{folder}/manifest"
    dealt.select("doc_id", "text").mapInArrow(
        _write_shards(folder, tokenizer, shard_tokens), MANIFEST).write.parquet(manifest)
    clear_temporary(folder)
    return spark.read.schema(MANIFEST).parquet(manifest)


def _read_files(folder: str):
    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, first in zip(batch.column("file").to_pylist(), batch.column("first").to_pylist()):
                with open_stored(folder, name) as stream:
                    file = TokenFile(stream)
                    raw = memoryview(file.matrix.tokens().astype("<u4")).cast("B")
                doc_ids, lengths, ends = file.doc_ids, file.lengths, file.ends
                starts = ends - lengths
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()), pa.array(first + starts, pa.int64()),
                     pa.array(lengths, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])
    return run


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, decoded from
    the committed files."""
    spark = manifest.sparkSession
    # one row per writing task, whatever the input
    totals = {r["part"]: r["n"] for r in manifest.groupBy("part").agg(F.sum("tokens").alias("n")).collect()}
    offsets, at = [], 0
    for part in sorted(totals):
        offsets.append((part, at))
        at += totals[part]
    before = spark.createDataFrame(offsets, "part int, offset long")
    earlier = (F.sum("tokens").over(_by_part()) - F.col("tokens"))
    files = manifest.withColumn("within", earlier).join(F.broadcast(before), "part").select(
        "file", (F.col("offset") + F.col("within")).alias("first"))
    n = max(1, manifest.count())
    return files.repartition(min(n, 10_000)).mapInArrow(
        _read_files(folder), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def _ask(manifest: DataFrame, folder: str, answer, schema: str) -> DataFrame:
    """Rows that ``answer(file)`` gives, as tuples, for every committed file;
    files are dealt out one by one."""
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "array<int>": pa.list_(pa.int32())}
    fields = pa.schema([(name, kinds[kind]) for name, kind in (f.split(" ") for f in schema.split(", "))])

    def emit(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows), fields)], schema=fields)

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("file").to_pylist():
                with open_stored(folder, name) as stream:
                    rows, held = [], 0
                    for row, size in answer(TokenFile(stream)):
                        rows.append(row)
                        held += size
                        if held >= ANSWER_VALUES:
                            yield emit(rows)
                            rows, held = [], 0
                    if rows:
                        yield emit(rows)

    ship_package(manifest.sparkSession)
    n = max(1, manifest.count())
    return manifest.select("file").repartition(min(n, 10_000)).mapInArrow(run, schema)


def count_tokens(manifest: DataFrame, folder: str, tokens: list[int]) -> DataFrame:
    """``token, n``: how often each of the (distinct) tokens occurs in all
    files, by two ranks per plane and file.  What never occurs, or is no id,
    has no row."""
    asked = np.unique(np.array(tokens, dtype=np.int64))

    def answer(file: TokenFile):
        found = file.matrix.count(asked)
        return [((t, n), 1) for t, n in zip(asked.tolist(), found.tolist()) if n]

    return _ask(manifest, folder, answer, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))


def find_tokens(manifest: DataFrame, folder: str, tokens: list[int]) -> DataFrame:
    """``token, doc_id, place``: every occurrence of the (distinct) tokens by
    select, as a place (from 0) in its document.  Documents without an id
    have a null ``doc_id``; what never occurs has no row."""
    asked = sorted(set(tokens))

    def answer(file: TokenFile):
        starts = file.ends - file.lengths
        for token, n in zip(asked, file.matrix.count(np.array(asked, dtype=np.int64)).tolist()):
            for first in range(0, n, ANSWER_VALUES):
                at = file.matrix.locate(token, np.arange(first, min(n, first + ANSWER_VALUES)))
                rows = np.searchsorted(file.ends, at, side="right")
                for row, place in zip(rows.tolist(), (at - starts[rows]).tolist()):
                    yield (token, file.doc_ids[row], place), 1

    return _ask(manifest, folder, answer, "token bigint, doc_id bigint, place bigint")


def document_tokens(manifest: DataFrame, folder: str, first_id: int, last_id: int) -> DataFrame:
    """``doc_id, tokens`` (end id included) of every document with
    ``first_id <= doc_id <= last_id``; only the pieces that hold them are
    inflated.  Rows of equal ids are rows of their own; documents without an
    id are in no range."""
    def answer(file: TokenFile):
        for row, doc_id in enumerate(file.doc_ids):
            if doc_id is not None and first_id <= doc_id <= last_id:
                yield (doc_id, file.document(row).astype(np.int32)), int(file.lengths[row])

    return _ask(manifest, folder, answer, "doc_id bigint, tokens array<int>")


def _by_part():
    from pyspark.sql import Window

    return Window.partitionBy("part").orderBy("seq")


def round_trip(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Encode into the cluster's shared folder and read the files back."""
    folder = shared_dir(docs.sparkSession, "tokens")
    return read(write(docs, folder, tokenizer, **options), folder)
