"""Texts that hold the name of an added token, against the library alone."""

import json

import numpy as np
import pytest

from cardgrain.llm.registry import tokenizer_path
from cardgrain.llm.wordcache import WordEncoder


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_added_tokens_as_the_library_reads_them(name):
    from tokenizers import Tokenizer

    path = tokenizer_path(name)
    with open(path, encoding="utf-8") as f:
        names = [t["content"] for t in json.load(f)["added_tokens"]]
    assert names
    texts = [x for t in names for x in (f"see {t} here", t, f"a{t}b\n{t}", t.upper())] + ["no name"]
    plain = Tokenizer.from_file(path)
    want = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    got = [np.frombuffer(x, "<u4").tolist() for x in WordEncoder(path).encode(texts)]
    assert got == want
