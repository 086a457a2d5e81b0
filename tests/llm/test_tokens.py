"""Ids part by part against the library's encoding of whole texts, whatever signs, spaces and line breaks meet."""

import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from twinledger.llm import tokens

BYTES = public_tokenizers.path("byte_bpe_50k.json")
BITS = [
    "a", "Word", " ", "  ", "\n", "\n\n", ".", ",", "_", "'s", "1", "é", "é", "\t", "!", "漢", " the", "\r\n", ", ", ". ", "\0",
    " ", " ", "①", "…",
]


def test_parts_give_the_ids_of_whole_texts(monkeypatch):
    library = Tokenizer.from_file(BYTES)
    library.encode_special_tokens = True
    monkeypatch.setattr(tokens, "KEPT", 300)  # so that parts are forgotten
    monkeypatch.setattr(tokens, "KEPT_FOR_NOW", 100)
    encoder = tokens.PartEncoder(BYTES)
    random.seed(1)
    texts = ["".join(random.choice(BITS) for _ in range(random.randrange(14))) for _ in range(8000)]
    for a in range(0, len(texts), 50):
        for text, found in zip(texts[a : a + 50], encoder.encode(texts[a : a + 50])):
            assert "".join(tokens.cut(text)).replace("\0", "") == text.replace("\0", "")
            assert np.frombuffer(found, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text
    assert len(encoder.known) <= 300 + 50 * 14
