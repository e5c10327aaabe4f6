"""Ids of pieces in packing: by the library's model, without an encoding for each."""

import numpy as np
import tokenizers

from ambermill.llm.packing import _cache
from ambermill.llm.presplit import END, all_pieces
from ambermill.llm.vocabulary import tokenizer_path

TEXTS = ["", " ", "It's the 3rd  test.\n\n Next,\tline ", "añó Übergröße ÀÿŒ 数据 处理 🙂", f"a{END}b {END}{END}", "\x00\x1c\x85\xa0\x7f", "x" * 5000, "Queequell.\r\nOsté 12,5 %"]


def test_pieces_have_the_ids_of_the_library_and_no_encodings_are_made(monkeypatch):
    library = tokenizers.Tokenizer.from_file(tokenizer_path())
    library.no_padding()
    library.no_truncation()
    want = [library.encode(t, add_special_tokens=False).ids for t in TEXTS]

    class NoEncodings:
        from_file = classmethod(lambda cls, path: cls())

        def __getattr__(self, name):
            assert not name.startswith("encode"), "an encoding for each piece"
            return getattr(library, name)

    monkeypatch.setattr(tokenizers, "Tokenizer", NoEncodings)
    _cache.cache_clear()
    try:
        cache = _cache("byte_bpe_50k.json")
        split = [all_pieces(t) for t in TEXTS]
        known = cache.fill(set().union(*split))
        assert [np.frombuffer(b"".join(known[p] for p in s), "<u4").tolist() for s in split] == want
    finally:
        _cache.cache_clear()
