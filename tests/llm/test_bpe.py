import random

import pytest
from tokenizers import Tokenizer

from conftest_llm import sha
from modrisk.llm import bpe
from modrisk.llm.queries import op5_bpe, tokenizer

PATH = tokenizer("word_bpe_49k.json")


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_query_like_the_library(spark, sf, documents, plain):
    t = Tokenizer.from_file(PATH)
    want = {}
    for r in documents.collect():
        ids = plain(r["text"])
        want[r["doc_id"]] = (len(ids), sha(" ".join(map(str, ids))), sha(t.decode(ids, skip_special_tokens=False)))
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in op5_bpe(spark, sf).collect()}
    assert got == want


@pytest.mark.parametrize("apart", [False, True])
@pytest.mark.parametrize("mask", [0, 3, 63])
def test_chunks_and_joins_change_nothing(plain, mask, apart):
    """Odd blanks, combining marks, special tokens and long repeats, with small caches and many cuts."""
    encoder = bpe.Encoder(Tokenizer.from_file(PATH), mask=mask, longest=40, chunks=20, apart=apart, words=30)
    draw = random.Random(mask)
    bits = ["it's", "don't!!", "école", "́x", "a b", "<|endoftext|>", "x<|startoftext|>y", "　", "ΣΑΣ", "İi", "1234",
            "日本語", "👩‍💻", "...", "‍", "the", "The", "straße"]
    for _ in range(300):
        text = "".join(draw.choice(bits) + draw.choice([" ", "  ", "\n", "\t", "", "\x0b", " "]) for _ in range(draw.randrange(60)))
        assert encoder.encode(text).tolist() == plain(text)
    same = "again and again " * 500
    assert encoder.encode(same).tolist() == plain(same)
    assert len(encoder.chunks.new) + len(encoder.chunks.old) <= 40


class Gluing:
    """A tokenizer whose words are not independent: a b after an a is one token with it, and blanks do not count."""

    def get_vocab_size(self, with_added_tokens=True):
        return 4

    def encode_batch_fast(self, texts, add_special_tokens=False):
        return [type("E", (), {"ids": self.ids(t)}) for t in texts]

    @staticmethod
    def ids(text):
        out = []
        for w in text.split():
            if w == "b" and out and out[-1] == 0:
                out[-1] = 2
            else:
                out.append({"a": 0, "b": 1}.get(w, 3))
        return out


@pytest.mark.parametrize("mask", [0, 1, 63])
def test_joins_that_disagree_are_repaired(mask):
    encoder = bpe.Encoder(Gluing(), mask=mask, longest=20, chunks=10)
    assert encoder.encode("c a b c").tolist() == [3, 2, 3]
    draw = random.Random(mask)
    for _ in range(300):
        text = " ".join(draw.choice(["a", "b", "c", "ddd", "something"]) for _ in range(draw.randrange(80)))
        assert encoder.encode(text).tolist() == Gluing.ids(text)


@pytest.mark.parametrize("mask", [0, 3, 63])
def test_byte_level_words_with_their_blanks(mask):
    """A tokenizer whose words hold the blank before them, and whose runs of blanks hang together."""
    from tokenizers import models, pre_tokenizers

    alphabet = pre_tokenizers.ByteLevel.alphabet()
    vocab = {c: i for i, c in enumerate(sorted(alphabet))}
    merges = [("Ġ", "t"), ("Ġt", "h"), ("Ġth", "e"), ("Ġ", "Ġ"), ("ĠĠ", "ĠĠ"), ("a", "n"), ("an", "d"), ("Ċ", "Ċ")]
    for a, b in merges:
        vocab.setdefault(a + b, len(vocab))
    t = Tokenizer(models.BPE(vocab=vocab, merges=merges))
    t.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    encoder = bpe.Encoder(t, mask=mask, longest=40, chunks=20)
    draw = random.Random(mask)
    for _ in range(200):
        text = "".join(draw.choice(["the", "and", "then", "é", "日本", "x1"]) + draw.choice([" ", "  ", "    ", "\n", "\n\n", ""]) for _ in range(60))
        assert encoder.encode(text).tolist() == t.encode(text, add_special_tokens=False).ids


def test_words_that_do_not_stand_apart_are_an_error():
    encoder = bpe.Encoder(Gluing(), apart=True)
    with pytest.raises(ValueError):
        encoder.encode("c a b c")


def test_pieces_are_the_text():
    text = ("word " * 9000 + "x" * 40_000 + " end").encode()
    assert b"".join(bpe.pieces(text)) == text
    assert max(len(p) for p in bpe.pieces(b"word " * 9000)) < bpe.LONGEST + 10
    assert bpe.pieces(b"") == []


def test_odd_rows(spark, odd, nothing, plain):
    rows = bpe.encoded(odd, PATH, carry=["text_sha256"]).collect()
    assert sorted((str(r["doc_id"]), r["ids"]) for r in rows) == sorted((str(r["doc_id"]), plain(r["text"] or "")) for r in odd.collect())
    assert {r["decoded"] for r in rows if not r["ids"]} == {""}
    assert bpe.encoded(nothing, PATH).count() == 0
