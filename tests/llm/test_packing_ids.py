"""Ids of the packing operator are those of the tokenizer itself."""

import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from clientele.llm.best_fit_packing import LONGEST_RUN, _plain, encode

EDGES = [
    "", " ", "  a", "a  ", "a  b", "it's we'll I'M", "a\n\nb \n c\t\td", "x\x1cy\x1d z", "\x85a\xa0 b", "\xa0\xa0 c  \xa0",
    "!!! ... ?!", "1234567890 12,5", "é à ñ ß Ø ǅ ȳ", "a<|endoftext|>b", "<|endoftext|>", "漢字かな", "🙂 ok 🙂", "é ñ",
    "a" * (LONGEST_RUN + 1), " " * (2 * LONGEST_RUN), "ab " * 500, "\x00\x01\x7f", "²³¹ ¼½ ª º µ",
]


def check(texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text, ids in zip(texts, encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_edge_texts():
    check(EDGES)
    assert not _plain("a" * (LONGEST_RUN + 1)) and not _plain("漢") and not _plain("<|endoftext|>") and _plain("é b")


def test_every_plain_character_between_others():
    check([f"a{c}b {c} 1{c}{c}!" for c in map(chr, range(0x250))])


def test_random_plain_texts():
    rng = random.Random(7)
    some = [chr(i) for i in range(0x250)] + list("     \n\n\t''''stmdrelve") * 8
    check(["".join(rng.choices(some, k=rng.randint(0, 200))) for _ in range(2000)])
