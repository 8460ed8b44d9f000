import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest

from quillpair.llm import packing as K
from quillpair.llm.wordtokens import WordTokens

PATH = P.path("word_bpe_49k.json")


def _ids(text):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [K.END_ID]


TEXTS = [None, "", " ", "it's DON'T we'll 123 45é  x y", "ábc ́d İstanbul ΣΑΣ", "日本語 テキスト",
         "<|endoftext|> x<|startoftext|>y <b>!!</b>", "<|ENDOFTEXT|> A.", "Don't!? I'd,'s 's. it's's, 42nd.. É, =\u0338 a.\u0338", "x\x1cy\x85z", "🙂🙂 ok", "A" * 3000]


def test_word_tokens_equal_whole_texts():
    words = WordTokens(PATH)
    for t in TEXTS[1:]:
        assert np.frombuffer(words.encode(t.encode()), words.dtype).tolist() == _ids(t)[:-1]


@pytest.mark.parametrize("bits,dims", [(4, 2), (3, 3), (2, 4)])
def test_hilbert_curve_is_a_walk(bits, dims):
    axes = np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij")
    points = np.stack([a.ravel() for a in axes], 1)
    key = K.hilbert_key(points, bits)
    assert sorted(key) == list(range(len(points)))
    steps = np.abs(np.diff(points[np.argsort(key)], axis=0)).sum(1)
    assert (steps == 1).all()


def test_pieces(spark):
    r = random.Random(4)
    texts = TEXTS + [" ".join(r.choice(["alpha", "beta", "gamma", "words"]) for _ in range(r.randrange(3000)))
                     for _ in range(20)] + ["same text here"] * 300 + ["long " * 20_000]
    rows = [(i, t, i, "b") for i, t in enumerate(texts)] + [(7, TEXTS[7], 0, "b")]
    out = K.pack(spark.createDataFrame(rows, "doc_id long, text string, row int, base string"), PATH).collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in out:
        by_doc[p.doc_id].append(p)
        by_seq[p.sequence_id].append(p)
    for i, t in enumerate(texts):
        ids, at = np.array(_ids(t), "<u4"), 0
        if i == 7:
            assert len(by_doc[i]) == 2
            continue
        for p in sorted(by_doc[i], key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            assert p.ids_crc32 == zlib.crc32(ids[at:at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    short = 0
    for pieces in by_seq.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= K.WIDTH and at & (at - 1) == 0
        short += at < K.WIDTH
    assert short <= 12


def test_empty_table(spark):
    assert K.pack(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def test_words_of_letters_are_cut_at_their_ends():
    from quillpair.llm.wordtokens import WordTokens
    words = WordTokens(P.path("word_bpe_49k.json"))
    text = " ".join(f"{chr(c)}a b{chr(c)}" for c in range(0x21, 0x3000) if chr(c).isalpha())
    for t in (text, "İstanbul ﬁne ǅ ſ ß ʰa éá 日本 ªº x²", "a‍b it's 3d a1b don't", "<|endoftext|> Ab ab"):
        assert np.frombuffer(words.encode(t.encode()), words.dtype).tolist() == _ids(t)[:-1]


def test_new_words_of_texts_are_learned_together(monkeypatch):
    words, calls = WordTokens(PATH), []
    ask = words.library.ids
    monkeypatch.setattr(words.library, "ids", lambda parts: calls.append(len(parts)) or ask(parts))
    texts = [t or "" for t in TEXTS] + [f"{a}{b}word {a}é{b}, {a}-{b} it's {a}{b}'s" for a in "abcdefgh" for b in "klmnopqr"]
    got = words.encode_all([t.encode() for t in texts])
    assert [np.frombuffer(x, words.dtype).tolist() for x in got] == [_ids(t)[:-1] for t in texts]
    assert len(calls) == 1


def test_words_of_a_to_z_have_the_ids_of_the_whole_tokenizer():
    words, r = WordTokens(PATH), random.Random(5)
    text = " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randrange(1, 14))) for _ in range(5000))
    assert np.frombuffer(words.encode(text.encode()), words.dtype).tolist() == _ids(text)[:-1]


def test_parts_of_a_batch_are_bounded(monkeypatch):
    monkeypatch.setattr(K, "PART_ROWS", 3)
    monkeypatch.setattr(K, "PART_BYTES", 10)
    texts = ["a", "b", "c", "d", "e" * 30, "", "f" * 6, "g" * 6]
    batch = K.pa.RecordBatch.from_arrays([K.pa.array(range(8)), K.pa.array(texts)], names=["doc_id", "text"])
    assert [p.column(1).to_pylist() for p in K._parts(batch)] == [["a", "b", "c"], ["d"], ["e" * 30], ["", "f" * 6], ["g" * 6]]
    assert list(K._parts(batch.slice(0, 0))) == []
