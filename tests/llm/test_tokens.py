import random

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

import regex  # noqa: E402

from contentlake.llm import tokens  # noqa: E402
from tests.llm.helpers import documents, empty, rows  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = ["a", "b", "the", " ", "  ", "\n", "\t", "'", "'s", "'re", "'ve", "'ll", "'LL", "1", "23", "é", "ß", "中", " ", "　",
            "\x1c", "\x85", "!", "...", "<|endoftext|>", "<|endof", "𝒳", "²", "Ⅷ", "́", "ing", "tion", "\r\n", "\x00", "​", "_", "-",
            "z" * 30, " " * 40, "=" * 70]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


@pytest.mark.parametrize("chunk", [7, 64, tokens.CHUNK])
def test_counts_equal_the_library_on_random_texts(library, monkeypatch, chunk):
    monkeypatch.setattr(tokens, "CHUNK", chunk)
    r = random.Random(chunk)
    texts = ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, 40))) for _ in range(2000)]
    texts += ["", " ", "a" * 3000, " " * 2000, "=-" * 900, "".join(map(chr, range(0x20, 0x3000)))]
    vocabulary = tokens.read_vocabulary(PATH)
    splitter = regex.compile("|".join(map(regex.escape, vocabulary["special"])))
    n_bytes, n_tokens = tokens.count_batch(tokens.Transducer(vocabulary), tokens.char_classes(), texts, splitter)
    assert n_tokens.tolist() == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert n_bytes.tolist() == [len(t.encode()) for t in texts]


def test_query_on_awkward_rows(spark, library):
    out = tokens.count_tokens(documents(spark, clash=True), PATH).collect()
    expected = sorted(((r[0], len((r[1] or "").encode()), len(library.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows()), key=str)
    assert sorted(((r["id"], r["n_bytes"], r["n_tokens"]) for r in out), key=str) == expected
    assert tokens.count_tokens(empty(spark), PATH).count() == 0
