import hashlib
import zlib
from array import array

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from parley.llm import bpe, packing

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(VOCABULARY)


def _ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("text", [
    "", "aaaaaaaa aaa aa", "It's we'll DON'T 1234 ² ¼ ª º", "ΑΣ ΣΑΣ İstanbul ǅ ŉ",
    "<|endoftext|>x<|startoftext|> <|x <|endoftext|", "é ﬁ 日本語 🙂🙂", "!!!...??? \x1c\x85\xa0b",
    "thththththe" * 40])
def test_encode_and_decode_equal_the_library(text):
    split, automaton, cache = bpe._codec(VOCABULARY)
    ids = b"".join(cache[w] for w in split(text))
    assert list(array("I", ids)) == _ids(text)
    assert automaton.decode(ids) == LIBRARY.decode(_ids(text), skip_special_tokens=False)


def test_every_character_below_the_simple_end_equals_the_library():
    """Also capitals whose lower case lies above it, as in AZƏRBAYCAN."""
    split, _, cache = bpe._codec(VOCABULARY)
    texts = ["AZƏRBAYCAN", "ƁƆƎ it's Ⱥ", *(f"az{chr(c)}rb {chr(c)} 1{chr(c)}!" for c in range(0x250))]
    for text in texts:
        assert list(array("I", b"".join(cache[w] for w in split(text)))) == _ids(text), text


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("abcdeinorsthu é'!.1 \nßΣ"), max_size=60))
def test_random_texts_equal_the_library(text):
    split, _, cache = bpe._codec(VOCABULARY)
    assert list(array("I", b"".join(cache[w] for w in split(text)))) == _ids(text)


def test_every_pair_of_labels_agrees_with_the_library():
    """The automaton reads a second token after a first iff the library leaves the two apart."""
    automaton = bpe.TokenAutomaton(VOCABULARY)
    bases = [t for t in range(600, 1400, 7)]
    for a in bases:
        for b in bases[::9]:
            first, second = automaton.label[a], automaton.label[b]
            if first.endswith("</w>") or not (first + second).replace("</w>", "").isascii():
                continue
            word = (first + second).removesuffix("</w>")
            if not second.endswith("</w>") or not word.isalpha():
                continue
            assert (_ids(word) == [a, b]) == automaton.step(a, b), (first, second)


def test_digests_over_edge_cases(edge_docs, no_docs):
    rows = bpe.digests(edge_docs, VOCABULARY).collect()
    expected = []
    for doc in edge_docs.select("doc_id", "text").collect():
        ids = _ids(doc["text"])
        expected.append((doc["doc_id"], len(ids),
                         hashlib.sha256(array("I", ids).tobytes()).hexdigest(),
                         hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode())
                         .hexdigest()))
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, expected))
    assert bpe.encode(no_docs, VOCABULARY).count() == 0


def test_encode_keeps_ids(edge_docs):
    for row in bpe.encode(edge_docs.where("doc_id = 11"), VOCABULARY).collect():
        assert row["decoded"].split(" ") == [LIBRARY.id_to_token(i) for i in array("I", row["ids"])]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_bins_hold_everything_once(lengths):
    bins = packing.best_two_fit(lengths, 50)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in b) <= 50 for b in bins)
    assert len(bins) <= 2 * -(-sum(lengths) // 50) + 1


def test_smallest_is_replaced_by_two_that_fit_tighter():
    # greedy: 60 + 30, gap 10; 20 + 20 fill the 40 that 30 leaves
    bins = packing.best_two_fit([60, 30, 20, 20], 100)
    assert sorted(map(sorted, bins))[0] in ([0, 2, 3], [1])
    assert {tuple(sorted(b)) for b in bins} == {(0, 2, 3), (1,)}


def test_packed_pieces(edge_docs, no_docs):
    packed = packing.pack(edge_docs, VOCABULARY, keep_ids=True, group_bytes=40_000).collect()
    by_doc = {}
    for doc in edge_docs.select("doc_id", "text").collect():
        by_doc.setdefault(doc["doc_id"], []).append([*_ids(doc["text"]), 0])
    pieces = {}
    for row in packed:
        ids = list(array("I", row["ids"]))
        assert row["ids_crc32"] == zlib.crc32(row["ids"]) and row["length"] == len(ids)
        pieces.setdefault(row["doc_id"], []).append((row["start"], row["piece"], tuple(ids)))
    for doc, texts in by_doc.items():
        cut = [(s, s // 2048, tuple(t[s:s + 2048])) for t in texts for s in range(0, len(t), 2048)]
        assert sorted(cut) == sorted(pieces[doc])
    places = {}
    for row in packed:
        places.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for rows in places.values():
        at = 0
        for offset, length in sorted(rows):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack(no_docs, VOCABULARY).count() == 0
