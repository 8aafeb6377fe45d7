import collections
import io
import zlib

import numpy as np
import pytest

from scorewright.llm import wavelet
from scorewright.llm.catalog import tokenizer_path

TOKENIZER = "word_bpe_49k.json"


def opened(data):
    return wavelet.TokenFile(io.BytesIO(data))


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 511, 512, 513, 5000])
def test_matrix_answers(n, monkeypatch):
    monkeypatch.setattr(wavelet, "PIECE_BYTES", 64)
    monkeypatch.setattr(wavelet, "PIECE_BITS", 512)
    tokens = np.random.default_rng(n).zipf(1.4, size=n).clip(max=900).astype(np.uint16)
    file = opened(wavelet.dump(wavelet.WaveletMatrix.build(tokens, 10), [3, None], np.array([n, 0])))
    matrix = file.matrix
    assert file.doc_ids == [3, None] and file.lengths.tolist() == [n, 0]
    assert (matrix.tokens() == tokens).all() and (file.document(0) == tokens).all() and len(file.document(1)) == 0
    some = np.random.default_rng(1).integers(0, max(n, 1), 50)[:n]
    assert (matrix.access(some) == tokens[some]).all()
    asked = np.array([1, 2, 5, 900, 901, 1023, 1024, -1, 1 << 40])
    assert matrix.count(asked).tolist() == [(tokens == t).sum() for t in asked]
    for token in (1, 2, 5, 900, 901):
        places = np.nonzero(tokens == token)[0]
        assert matrix.count([token], n // 3, n // 2)[0] == ((places >= n // 3) & (places < n // 2)).sum()
        assert matrix.locate(token, np.arange(len(places))).tolist() == places.tolist()
        with pytest.raises(IndexError):
            matrix.locate(token, [len(places)])


def test_an_answer_reads_few_pieces():
    tokens = np.random.default_rng(0).integers(0, 1 << 16, 3_000_000).astype(np.uint16)
    data = wavelet.dump(wavelet.WaveletMatrix.build(tokens, 16), [1, 2], np.array([10, len(tokens) - 10]))
    file, read = opened(data), []
    section = file._section
    file._section = lambda i, kind: (read.append(i), section(i, kind))[1]
    assert (file.document(0) == tokens[:10]).all() and 16 <= len(read) <= 16 * 10
    read.clear()
    assert opened(data).matrix.count([7])[0] == (tokens == 7).sum() == file.matrix.count([7])[0]
    assert len(read) <= 32


def expected(rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path(TOKENIZER))
    out, at = [], 0
    for doc_id, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        out.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_round_trip_with_the_library(spark):
    texts = ["plain Words, don't", "İstanbul ΑΣ ς é é", "<|endoftext|> x<|startoftext|>y", "a\x1cb\x85c\xa0d\x0be\x0cf",
             "日本語 ١٢٣ ½", "", None, "x " * 30_000, "́start", "tab\tnew\nline"]
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = wavelet.round_trip(df, tokenizer_path(TOKENIZER), shard_tokens=50, parts=3).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == expected(rows)


def test_hostile_rows(hostile, monkeypatch):
    monkeypatch.setattr(wavelet, "BLOCK_BYTES", 30)
    got = wavelet.round_trip(hostile, tokenizer_path(TOKENIZER), shard_tokens=20, parts=2).orderBy("start").collect()
    src = [(r.doc_id, r.text) for r in hostile.collect()]
    assert [r.doc_id for r in got] == sorted((d for d, _ in src), key=lambda d: (d is not None, d or 0))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted(
        (str(d), n, c) for d, _, n, c in expected(src))
    ends = [r.start + r.n_tokens for r in got]
    assert [r.start for r in got] == [0, *ends[:-1]]


def test_questions_to_all_files(spark, hostile, scratch):
    from tokenizers import Tokenizer

    docs = spark.createDataFrame([(r.doc_id, r.text) for r in hostile.collect()] + [(20 + i, f"common word {i % 3} " * i) for i in range(30)],
                                 "doc_id long, text string")
    manifest = wavelet.write(docs.repartition(3), scratch, tokenizer_path(TOKENIZER), shard_tokens=60, parts=3)
    assert manifest.count() > 5
    coder = Tokenizer.from_file(tokenizer_path(TOKENIZER))
    plain = [(r.doc_id, [*coder.encode(r.text or "", add_special_tokens=False).ids, 1]) for r in docs.collect()]
    times = collections.Counter(t for _, ids in plain for t in ids)
    asked = [*sorted(times)[::3], 1, 1, 49_000, 10**9, -5]
    got = {r.token: r.n for r in wavelet.count_tokens(manifest, scratch, asked).collect()}
    assert got == {t: times[t] for t in asked if times[t]}
    got = sorted((r.token, str(r.doc_id), r.place) for r in wavelet.find_tokens(manifest, scratch, asked).collect())
    assert got == sorted((t, str(d), i) for d, ids in plain for i, t in enumerate(ids) if t in set(asked))
    got = sorted((r.doc_id, r.tokens) for r in wavelet.document_tokens(manifest, scratch, 5, 25).collect())
    assert got == sorted((d, ids) for d, ids in plain if d is not None and 5 <= d <= 25)
    assert wavelet.count_tokens(manifest, scratch, []).collect() == [] == wavelet.find_tokens(manifest, scratch, []).collect()


def test_empty(empty, scratch):
    manifest = wavelet.write(empty, scratch, tokenizer_path(TOKENIZER))
    assert wavelet.count_tokens(manifest, scratch, [1]).collect() == [] == wavelet.document_tokens(manifest, scratch, 0, 9).collect()
    assert wavelet.round_trip(empty, tokenizer_path(TOKENIZER)).collect() == []


def test_chunk_encoder_equals_the_library():
    import random

    coder = wavelet.encoder(tokenizer_path(TOKENIZER))
    random.seed(1)
    parts = ["a", "B", "é", "É", "İ", "ß", "ﬁ", "é", "H̱", "Σ", "ς", "1", "½", "漢", "ᄒ", "ᅡ", "'", "'s", ".", "!", "|", "<|",
             "<|endoftext|>", "<|ENDOFTEXT|>", "\x1c", "\x85", "\xa0", " ", "\n", "-", "̀", "ǅ", "🙂", "Ⅷ", "ª"]
    texts = ["".join(random.choices(parts, k=random.randint(1, 12))) for _ in range(20_000)]
    found = coder.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert coder.encode(texts) == [np.array(f.ids, dtype=coder.dtype).tobytes() for f in found]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_any_tokenizer_file_gives_the_librarys_ids(name):
    coder = wavelet.encoder(tokenizer_path(name))
    assert (coder.ends is None) == name.startswith("byte")
    texts = ["Plain Words, don't  stop", "", None, " İstanbul\n\nΑΣ ς é", "x" * 3000, "tail... tail,", "A a A"]
    found = coder.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
    assert coder.encode(texts) == [np.array(f.ids, dtype=coder.dtype).tobytes() for f in found]


def test_forgotten_words_are_learnt_again(monkeypatch):
    monkeypatch.setattr(wavelet, "CACHE_WORDS", 20)
    coder = wavelet.ChunkEncoder(tokenizer_path(TOKENIZER), word_end="</w>")
    texts = [" ".join(f"word{chr(97 + (i * 7 + j) % 26)}{'x' * (j % 5)}, end!" for j in range(60)) for i in range(30)]
    for text in texts:
        found = coder.tokenizer.encode(text, add_special_tokens=False)
        assert coder.encode([text]) == [np.array(found.ids, dtype=coder.dtype).tobytes()]
    assert len(coder.words) <= 20 + 61 and len(coder.before) <= 20 + 61
