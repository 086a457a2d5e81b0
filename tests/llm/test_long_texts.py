"""Personal data in texts made to take long: time grows with their length, and spans are those of the plain patterns."""

import random
import re
import time

import pytest

from twinledger.llm import pii

HOSTILE = [" at " + "a-" * 9, "a dot ", "1", "1.", "1 ", "a@", "a.", " ", "one, ", "one plus ", "+1 (", "@", "(at) ", "a at ", "one 10.0.0.1 ", "10.0.0.one ", "dot ", "a_"]


@pytest.mark.parametrize("piece", HOSTILE)
def test_a_million_characters_take_seconds(piece):
    text = piece * (1_000_000 // len(piece))
    begun = time.process_time()
    pii.find(text)
    assert time.process_time() - begun < 15  # about 5 on a machine that does nothing else


def test_one_start_and_a_long_tail():
    for text in ("x at " + "a-" * 400_000, "x" * 800_000 + " at y", " " * 800_000 + "at b", "x at " + "a dot " * 150_000):
        begun = time.process_time()
        pii.find(text)
        assert time.process_time() - begun < 15


def test_spans_are_those_of_the_patterns():
    whole = re.compile(
        rf"(?i)(?<![\w.])[a-z0-9][a-z0-9_%+-]*(?:(?:\s+dot\s+|\.)[a-z0-9_%+-]+)*(?:\s+at\s+|@)"
        rf"[a-z0-9-]+(?:(?:\s+dot\s+|\.)[a-z0-9-]+)*(?:\s+dot\s+|\.)(?:{pii.ENDS})(?!\w)"
    )
    four = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
    random.seed(3)
    bits = ["a", "Jane", " ", "  ", "\n", " dot ", " at ", "@", ".", "-", "_", "com", "org", "é", "1", "23", "+", " DOT ", " At ", "dot", "at", ".de", ",", "("]
    for _ in range(60_000):
        text = "".join(random.choice(bits) for _ in range(random.randrange(16)))
        assert list(pii.worded(text)) == [m.span() for m in whole.finditer(text)], text
        assert list(pii.addresses(text)) == [m.span() for m in four.finditer(text)]
    for _ in range(20_000):
        text = "".join(random.choice("1234..., x") for _ in range(random.randrange(30)))
        assert list(pii.addresses(text)) == [m.span() for m in four.finditer(text)]
