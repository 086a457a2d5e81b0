"""Disguises are undone wherever their patterns match, whatever else the text holds."""

import pytest
from twinledger.llm import pii


@pytest.mark.parametrize(
    "hidden, kind",
    [
        ("jane.doe at example.com", "email"),
        ("jane\tat  example dot\ncom", "email"),
        ("jane at example dot com", "email"),
        ("plus,four,nine,one,five,one,two,three,four,five,six,seven", "phone"),
        ("plus.four.nine.one.five.one.two.three.four.five.six.seven", "phone"),
        ("plus\tfour nine\none  five one two three four five six seven", "phone"),
        ("+49 one five one 1234567", "phone"),
        ("+49 151 12345 six seven", "phone"),
        ("plus 49 151 one 234567", "phone"),
        ("one dot one dot one dot one", "ip"),
        ("one.one.one.one", "ip"),
        ("192.168.one.1", "ip"),
        ("10 dot zero dot 0 dot one", "ip"),
        ("4111 1111 one one one one 1111", "card"),
    ],
)
def test_disguises_alone(hidden, kind):
    text = f"see {hidden}; thanks"
    start = text.index(hidden)
    assert (start, start + len(hidden), kind) in pii.find(text)[1]
    assert pii.redacted(text) == f"see [{kind.upper()}]; thanks"


@pytest.mark.parametrize(
    "text",
    [
        "one of two at three", "look at this. one two three four five six seven", "We met at 5 one day", "1.2.3 one", "room 12 nine",
        "at ten dot com", "one, two, three. Four.", "neuf cent un 3",
    ],
)
def test_clean_texts(text):
    assert pii.find(text) == ([], []) and pii.redacted(text) == text


def test_a_word_beside_a_whole_identifier_stays():
    assert pii.redacted("ping 10.0.0.1 one time") == "ping [IP] one time"
    assert pii.redacted("call +49 151 1234567 two days later") == "call [PHONE] two days later"
    assert pii.redacted("card 4111 1111 1111 1111, one of two") == "card [CARD], one of two"


def test_long_texts_end():
    for text in ("one" + " " * 20_000 + "x", "one " * 5_000, "1 one. " * 3_000, "a at " * 4_000):
        pii.find(text)
