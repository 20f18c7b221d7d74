"""Ids that an encoder keeps from call to call."""

from __future__ import annotations

import pyarrow as pa
import pytest

pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from skyledger.llm import token_store  # noqa: E402

CALLS = [
    ["one two\nthree two", None, "", "tab\there two"],
    ["three one five", "two  blanks", "Größe two 漢字 one"],
    ["six seven eight nine ten six", "one"],
    ["ten nine\none two\n"],
]


@pytest.mark.parametrize("most", [0, 3, 600_000])
def test_ids_do_not_depend_on_what_is_kept(monkeypatch, most):
    monkeypatch.setattr(token_store, "KNOWN_WORDS", most)
    encoder = token_store.Encoder(token_store.vocabulary())
    whole = Tokenizer.from_file(token_store.vocabulary())
    for texts in CALLS:
        found = encoder.encode(pa.array(texts, pa.string()))
        expected = [whole.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert [ids.tolist() for ids in found] == expected


def test_a_known_word_is_not_encoded_again(monkeypatch):
    encoder = token_store.Encoder(token_store.vocabulary())
    texts, ids = pa.array(["a word and a word"]), encoder._ids
    encoder.encode(texts)
    seen = []
    monkeypatch.setattr(encoder, "_ids", lambda some: seen.extend(some) or ids(some))
    encoder.encode(texts)
    assert not any("word" in text for text in seen)
