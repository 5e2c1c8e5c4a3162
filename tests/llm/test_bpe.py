import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from carelake.llm import bpe

from .data import AWKWARD, awkward, empty

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def theirs():
    return Tokenizer.from_file(PATH)


def test_equals_the_library(theirs):
    ours = bpe.codec(PATH)
    r = random.Random(1)
    bits = [" ", "  ", "\n", "\t", "a", "the", " the", "'s", "'ll", "1", "23", "é", "ß", " ", "　", "\x1c", "\x85", "😀",
            "!", "...", "<|endoftext|>", "x" * 50, "-" * 70, "Ġ", "\r\n", "日本語", "́", "²", "½", "​"]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 14))) for _ in range(4000)]
    texts += ["a" * 20000, "ab" * 9000, "the" * 5000, " " * 5000, "\n \n " * 1000]
    texts += [f"a{chr(c)}1{chr(c)}! {chr(c)}{chr(c)} b" for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    for t in texts:
        want = theirs.encode(t, add_special_tokens=False).ids
        got = ours.encode(t)
        assert np.frombuffer(got, "<u4").tolist() == want, repr(t[:80])
        assert ours.decode(got) == theirs.decode(want, skip_special_tokens=False)


def test_texts_of_latin_letters_take_the_fast_cut(theirs):
    """All of U+00C0 to U+024F, signs among them, beside every kind of neighbour."""
    ours = bpe.codec(PATH)
    for c in range(0xA0, 0x260):
        t = f"{chr(c)} {chr(c)}a {chr(c)}1 !{chr(c)}'s  {chr(c)}'ll\n{chr(c)}"
        assert np.frombuffer(ours.encode(t), "<u4").tolist() == theirs.encode(t, add_special_tokens=False).ids, hex(c)


def test_many_special_tokens(theirs):
    text = "a <|endoftext|>" * 5000 + "<|endoftext|>" * 300
    ours = bpe.codec(PATH)
    ids = theirs.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ours.encode(text), "<u4").tolist() == ids
    assert ours.decode(ours.encode(text)) == theirs.decode(ids, skip_special_tokens=False)


def test_cut_off_characters_decode_as_the_library_does(theirs):
    ours = bpe.codec(PATH)
    ids = theirs.encode("日本語 😀 é", add_special_tokens=False).ids
    for cut in range(len(ids)):
        for part in (ids[cut:], ids[:cut]):
            assert ours.decode(np.array(part, "<u4").tobytes()) == theirs.decode(part, skip_special_tokens=False)


def test_cache_generations_do_not_change_results(monkeypatch):
    whole = bpe.codec(PATH)
    monkeypatch.setattr(bpe, "CACHE_PIECES", 8)
    small = bpe.ByteBpe(PATH)
    text = " ".join(f"word{i % 37} other{i % 11}" for i in range(500))
    assert small.encode(text) == whole.encode(text)
    assert len(small._pieces) <= 8


def test_digests(spark, theirs):
    docs = awkward(spark)
    got = sorted((r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(docs, PATH).collect())
    want = []
    for row in AWKWARD:
        ids = theirs.encode(row[1] or "", add_special_tokens=False).ids
        text = theirs.decode(ids, skip_special_tokens=False)
        want.append((row[0] or 0, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want)
    assert bpe.digests(empty(spark), PATH).count() == 0
    r = bpe.encode_decode(docs.filter("doc_id = 9"), PATH).first()
    assert r.decoded == AWKWARD[8][1]


def test_pieces(spark, theirs):
    rows = bpe.pieces(awkward(spark).filter("doc_id is not null"), PATH, 1024, 2).collect()
    for doc in {r.doc_id for r in rows}:
        text = next(x[1] for x in AWKWARD if x[0] == doc) or ""
        ids = [*theirs.encode(text, add_special_tokens=False).ids, 2]
        own = sorted({(r.piece, r.start, r.length, r.ids_crc32) for r in rows if r.doc_id == doc})
        assert own[0][1] == 0 and sum(x[2] for x in own) == len(ids)
        assert all(x[2] == 1024 for x in own[1:]) and 1 <= own[0][2] <= 1024
        for p, s, n, crc in own:
            assert crc == zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes())


def _new_pieces(r, n):
    """Distinct pre-tokens with letters of one to four bytes, digits, signs and spaces, up to 64 characters."""
    kinds = ["abcdehinorst", "éèßçñüðđ", "日本語京", "𝒜𝒷😀", "0123456789", "-.!?*#'", " "]
    out = {"".join(r.choices(r.choice(kinds), k=r.choice([1, 2, 5, 9, 20, 64]))) for _ in range(n)}
    return sorted(out | {" " + p for p in list(out)[:: 3] if len(p) < 64} | {"the", " the", "Ā", "a" * 64, "ab" * 32, "\x00", "\x7f"})


@pytest.mark.parametrize("most", [100, 8_192])
def test_new_pieces_side_by_side_equal_one_by_one(monkeypatch, most):
    monkeypatch.setattr(bpe, "MOST_PIECES", most)
    ours = bpe.ByteBpe(PATH)
    pieces = _new_pieces(random.Random(5), 3000)
    want = [ours._encode_piece(p) for p in pieces]
    assert ours._encode_pieces(pieces) == want
    assert ours._encode_pieces(pieces[:3]) == want[:3] and ours._encode_pieces([]) == []


def test_pairs_that_share_a_place_keep_their_own_verdict(monkeypatch):
    pieces = _new_pieces(random.Random(6), 500)
    want = [bpe.codec(PATH)._encode_piece(p) for p in pieces]
    monkeypatch.setattr(bpe, "PAIR_BITS", 2)
    assert bpe.ByteBpe(PATH)._encode_pieces(pieces) == want


def test_reversed_automaton_gives_the_longest_token_at_each_place():
    words = [chr(b) for b in range(256)] + ["ab", "abc", "bca", "cab", "abcab", "aaaa"]
    r = random.Random(7)
    pieces = ["".join(r.choices("abc", k=r.randint(1, 12))) for _ in range(200)] + ["aaaaaaa", "abcabcab"]
    data = np.frombuffer(b"\xff".join(p.encode() for p in pieces) + b"\xff", np.uint8)
    end = np.flatnonzero(data == 0xFF)
    found = bpe._Reversed({w: i for i, w in enumerate(words)}).longest(data, np.concatenate([[0], end[:-1] + 1]), end)
    want = []
    for p in pieces:
        want += [max((w for w in words if p.startswith(w, at)), key=len) for at in range(len(p))] + [None]
    assert [words[i] if i >= 0 else None for i in found] == want


def test_runs_do_not_change_results_and_new_pieces_walk_side_by_side(theirs):
    """Nulls, empty texts, special tokens, repeats and texts longer than a run, in order; no new word alone."""
    texts = [None, "", "<|endoftext|>a<|endoftext|>", " ".join(_new_pieces(random.Random(8), 800)), "a" * 200, "x <|endoftext|>"] * 2
    want = [theirs.encode(t or "", add_special_tokens=False).ids for t in texts]
    for run in (1, 7, 1000, 100_000):
        ours = bpe.ByteBpe(PATH)
        ours._run = run
        assert [np.frombuffer(i, "<u4").tolist() for i in ours.encode_all(texts)] == want
    ours, alone = bpe.ByteBpe(PATH), []
    ours.encode_piece = lambda piece: alone.append(piece) or bpe.ByteBpe.encode_piece(ours, piece)
    list(ours.encode_all([" ".join("".join(random.Random(i).choices("aeinorst", k=9)) for i in range(5000))]))
    assert len(alone) < 200
