"""Ids of whole texts from units, against the library, on odd characters."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from launchboard.llm import packing


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_equal_the_library(monkeypatch, name):
    path = public_tokenizers.path(name)
    plain = Tokenizer.from_file(path)
    rng = random.Random(5)
    parts = ["word", "Word.", "it's", "we'LL", "a.b", "a,'s", "x!!y", ".5", "5.", "A.'re", "é.", "é", "e\u0301.", "n\u0303", "漢字,", "\u00a0",
             "\u2003", "\x00", "\x1f", "\x85", "<|endoftext|>", "<|", "...", "a.\u0338b", "ß;", "ſ", "İ!", "ﬁ,", "👍🏽.", "\u200d", "_a.", "#a:", "a:\u0301"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", "", " ", "\n", "\t", "\x0b"]) for _ in range(rng.randint(0, 12)))
             for _ in range(6000)] + [None, "", " "]
    monkeypatch.setattr(packing, "UNIT_CACHE", 40)
    encoder = packing.WordEncoder(path)
    for lo in range(0, len(texts), 700):
        some = texts[lo:lo + 700]
        ids, counts = encoder.encode(pa.array(some, pa.string()))
        expected = [x.ids for x in plain.encode_batch([t or "" for t in some], add_special_tokens=False)]
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == expected
