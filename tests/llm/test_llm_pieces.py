import itertools
import math

import sentencepiece

from scorewright.llm import pieces
from scorewright.llm.catalog import table, tokenizer_path

MODEL = "piece_bpe_32k.model"
TEXTS = ["", "a", " leading", "trailing ", "  two  spaces ", "     ", "tab\tnew\nline\r\n", "<s> </s> <unk> <0x0A>", "ﬁ 漢字 \U0001f600 é é",
         "日本語テキスト です", "aaaaaaaaaaaaaaaa bbbb", "x" * 5000, "word " * 3000, "ReturnValue=self.__init__(x)"]


def test_other_kinds_of_models_are_refused():
    with open(tokenizer_path(MODEL), "rb") as fh:
        data = fh.read()
    pieces.check_model(data)

    def message(number, body):
        return bytes([number << 3 | 2, len(body)]) + body

    merge, plain = message(2, b"\x18\x02"), message(3, b"\x20\x00")
    pieces.check_model(merge + plain)
    for bad in (plain, message(2, b"\x18\x01") + plain, merge, merge + message(3, b"\x18\x00\x20\x00"),
                merge + message(3, b"\x12\x02ab\x20\x00"), merge + message(3, b"\x20\x00\x28\x00")):
        try:
            pieces.check_model(bad)
        except ValueError:
            continue
        raise AssertionError(bad)


def test_equals_the_library():
    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(MODEL))
    coder = pieces.TextEncoder(pieces.Pieces.load(tokenizer_path(MODEL)))
    got = coder.encode(TEXTS)
    assert [x.tolist() for x in got] == model.encode(TEXTS)
    assert [coder.decode(x) for x in got] == TEXTS
    assert [coder.pieces.decode(x.tolist()) for x in got] == TEXTS


def test_corpus_equals_the_library(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(MODEL))
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = pieces.encode(docs, tokenizer_path(MODEL)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.ids == model.encode(texts[r.doc_id]) and r.n_pieces == len(r.ids) and r.round_trip


def test_additive_scores_against_all_segmentations():
    vocabulary = {"a": -1.0, "b": -2.5, "ab": -3.0, "ba": -2.0, "aab": -3.1, "bb": -4.0}
    model = pieces.Pieces({p: (i, s) for i, (p, s) in enumerate(vocabulary.items())}, None, 99, merges=False)
    words = ["".join(w) for n in range(1, 7) for w in itertools.product("abc", repeat=n)]
    found = model.encode_words(words)

    def best(word):
        table_ = [0.0] + [-math.inf] * len(word)
        for end in range(1, len(word) + 1):
            for start in range(end):
                part = word[start:end]
                step = vocabulary.get(part, -1e10 if end - start == 1 else -math.inf)
                table_[end] = max(table_[end], table_[start] + step)
        return table_[-1]

    names = {i: p for i, p in enumerate(vocabulary)}
    for word in words:
        ids = memoryview(found[word]).cast("i").tolist()
        score = sum(vocabulary[names[i]] if i != 99 else -1e10 for i in ids)
        assert math.isclose(score, best(word))


def test_hostile_rows(hostile, empty):
    out = pieces.encode(hostile, tokenizer_path(MODEL)).collect()
    src = hostile.collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(r.doc_id) for r in src)
    # only the text with the space mark itself decodes to something else
    assert [r.doc_id for r in out if not r.round_trip] == [8]
    assert all(r.n_pieces == 0 and r.ids == [] for r in out if r.doc_id in (3, 4))
    assert pieces.encode(empty, tokenizer_path(MODEL)).collect() == []


def test_forgotten_words_and_pairs_are_learnt_again(monkeypatch):
    monkeypatch.setattr(pieces, "WORD_BYTES", 4000)
    monkeypatch.setattr(pieces, "PAIR_BYTES", 4000)
    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(MODEL))
    coder = pieces.TextEncoder(pieces.Pieces.load(tokenizer_path(MODEL)))
    for i in range(60):
        text = " ".join(f"Some{(i * 31 + j) % 97}thing else-{j % 7}" for j in range(40))
        assert coder.encode([text])[0].tolist() == model.encode(text)
        assert coder.size <= 4000 and coder.pieces._kept <= 41
        assert coder.pieces._kept == sum(map(len, coder.pieces._pairs.values())) and coder.once.keys() <= coder.known.keys()


def test_merging_stops_across_the_cut():
    model = pieces.Pieces({p: (i, -float(i)) for i, p in enumerate(["ab", "bc", "abc", "cab"])}, None, 99)
    assert model.merge("abc") == ["abc"] and model.merge("abc", 2) is None and model.merge("abab", 2) == ["ab", "ab"]
    for text in map("".join, itertools.product("abc", repeat=5)):
        for cut in range(1, 5):
            left, right = text[:cut], text[cut:]
            if model.merge(left) == [left] and model.merge(right) == [right]:
                assert model.compatible(left, right) == (model.merge(text) == [left, right])
