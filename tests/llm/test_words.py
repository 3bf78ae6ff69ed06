"""Numbers of the words of a block."""

import pyarrow as pa
import pytest

from pointstream.llm import lm


@pytest.mark.parametrize("tokens", [[[b"b", b"a", b"b"], [], [b"\xff\xfe", b"a"]], [[]], []])
def test_words_are_numbered_by_first_use(tokens, monkeypatch):
    made, own = [], pa.array
    monkeypatch.setattr(lm.pa, "array", lambda *a, **k: made.append(1) or own(*a, **k))
    block = lm.Block.__new__(lm.Block)
    block.tokens = tokens
    words, flat = block.words()
    assert words == list(dict.fromkeys([b"", *(w for t in tokens for w in t)]))
    assert [words[k] for k in flat] == [w for t in tokens for w in t] and made  # by Arrow, not one by one
