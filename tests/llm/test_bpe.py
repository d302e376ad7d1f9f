"""Byte-pair encoding against the tokenizers library and against merging word by word."""

import hashlib
import random
import struct

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from plantlens.llm import bpe
from plantlens.llm.common import table
from plantlens.llm.queries import LLM_QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.read_vocabulary(PATH))


HOSTILE = [
    "",
    " \t\n ",
    "a",
    "Hello WORLD, it's we'll I'VE 'sup",
    "<|endoftext|>a<|startoftext|><|endoftext|> <|ENDOFTEXT|> <|end oftext|>",
    "é ́x ạ̈ ṩ ṩ",
    "İstanbul ΣΣ ẞ ﬁ ǅ",
    "x y z　w\u0085v​u t\x1cs\x1fr\x00q",
    "你好世界 12345 ١٢ ½ Ⅷ \U0001f600\U0001f468‍\U0001f469",
    "the" * 3000,
    "a" * 5001,
    "ab" * 777 + "</w> in</w>the",
    "!?" * 400 + "''s'd'll",
    "퟿�\U0010ffff",
]


def test_hostile_texts(encoder, library):
    ids = [bpe.unpacked(i).tolist() for i in encoder.encode([t.encode() for t in HOSTILE])]
    assert ids == [library.encode(t, add_special_tokens=False).ids for t in HOSTILE]
    assert encoder.encode([HOSTILE[3].encode()] * 2) == encoder.encode([HOSTILE[3].encode()]) * 2


def test_random_characters(encoder, library):
    """Characters of all planes, so that each normalisation and class is met."""
    rng = random.Random(5)
    usable = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(map(chr, rng.choices(usable[:0x3000], k=60))) for _ in range(400)]
    texts += ["".join(map(chr, rng.choices(usable, k=60))) for _ in range(400)]
    ids = [bpe.unpacked(i).tolist() for i in encoder.encode([t.encode() for t in texts])]
    assert ids == [library.encode(t, add_special_tokens=False).ids for t in texts]


def merged_alone(word, ranks, merges):
    """The lowest rank, leftmost first, one merge at a time."""
    word = list(word)
    while True:
        found = [(ranks[p], i) for i, p in enumerate(zip(word, word[1:])) if p in ranks]
        if not found:
            return word
        rank, i = min(found)
        word[i : i + 2] = [merges[rank][2]]


@pytest.mark.parametrize("seed", range(30))
def test_any_merges(seed):
    """Merges in any order: a merge may well make a pair of lower rank."""
    rng = random.Random(seed)
    merges, size = [], 4
    for _ in range(14):
        merges.append((rng.randrange(size), rng.randrange(size), size))
        size += 1
    rng.shuffle(merges)
    index = bpe.PairIndex(merges)
    words = [[rng.randrange(4) for _ in range(rng.randrange(0, 25))] for _ in range(60)]
    ranks = {(left, right): rank for rank, (left, right, _) in enumerate(merges)}
    assert index.apply(words) == [merged_alone(w, ranks, merges) for w in words]


def test_query(spark, sf_dir, library):
    rows = {r.doc_id: r for r in LLM_QUERIES["op11_bpe"].run(spark, sf_dir).collect()}
    docs = {r.doc_id: r.text or "" for r in table(spark, sf_dir, "documents").collect()}
    assert rows.keys() == docs.keys()
    for doc_id, text in docs.items():
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected = (len(ids), struct.pack(f"<{len(ids)}I", *ids), decoded.encode())
        row = rows[doc_id]
        assert row.n_tokens == expected[0]
        assert row.ids_sha256 == hashlib.sha256(expected[1]).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(expected[2]).hexdigest()


def test_edges(spark, library):
    ddl = "doc_id long, text string, ids string, decoded int"
    rows = [(1, None, "x", 1), (2, "", "y", 2), (None, "Hi there", None, None), (3, "Hi there", "z", 3), (3, "Hi there", "z", 3)]
    docs = spark.createDataFrame(rows, ddl)
    for binary in (False, True):
        coded = bpe.encode(docs, PATH, binary=binary)
        back = bpe.decode(coded, PATH)
        assert back.columns == ["doc_id", "text", "ids", "decoded"]
        found = back.collect()
        hi = library.encode("Hi there", add_special_tokens=False).ids
        assert sorted(r.decoded for r in found) == ["", "", *["hi</w> there</w>"] * 3]
        if not binary:
            assert sorted(r.ids for r in found) == [[], [], hi, hi, hi]
        both = bpe.encode(docs, PATH, binary=binary, decoded=True).select(*back.columns)
        assert sorted(map(str, both.collect())) == sorted(map(str, found))
    assert bpe.decode(bpe.encode(docs.limit(0), PATH), PATH).count() == 0


def test_bytes_that_are_not_text(spark):
    docs = spark.sql("SELECT 1L AS doc_id, cast(X'61FF62' AS string) AS text")
    plain = spark.sql("SELECT 1L AS doc_id, 'a�b' AS text")
    assert bpe.encode(docs, PATH).first().ids == bpe.encode(plain, PATH).first().ids


def test_known_entries_stay_bounded(encoder, library, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_ENTRIES", 10)
    small = bpe.Encoder(bpe.read_vocabulary(PATH))
    texts = [f"word{i} other{i} " + "long" * 40 for i in range(50)]
    for text in texts:
        ids = bpe.unpacked(small.encode([text.encode()])[0]).tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids
    assert len(small.chunks) <= 13 and all(len(c) <= bpe.KNOWN_BYTES for c in small.chunks)


def test_other_models_are_refused():
    with pytest.raises(ValueError):
        bpe.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
