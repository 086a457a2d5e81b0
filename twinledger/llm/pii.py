"""Personal data, also in disguise, with spans in the text as it stands.

The base kinds are found by patterns.  For disguises the text goes through transducers that keep for every character
of their output where it came from: look-alike characters and foreign digits become ASCII, spelled digits become
digits, "at" and "dot" in brackets or between words become signs.  Identifiers found in the output are mapped back.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left, bisect_right
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from twinledger.llm.common import columns_of, map_batches, small_batches

KINDS = ("email", "ip", "card", "phone")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: Numbers parted by points, as many as there are; every four of them are one match of the address pattern.
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
NUMBER = re.compile(r"[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Where digits with dots, or twelve digits, may begin: four digits or signs between them.
DIGITS = re.compile(r"[0-9][0-9.\x20-]{5}")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str):
    """Matches of the address pattern: the characters before each sign, and a domain with a dot behind it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            done = match.end()
            yield start, done
        at = text.find("@", max(done, at + 1))


def addresses(text: str):
    """Spans of four numbers parted by points, leftmost and non-overlapping."""
    for m in DOTTED.finditer(text):
        if m[0].count(".") >= 3:
            parts = [n.span() for n in NUMBER.finditer(text, *m.span())]
            for i in range(0, len(parts) - 3, 4):
                yield parts[i][0], parts[i + 3][1]


def base(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every match, leftmost and non-overlapping per kind; failing matches are dropped."""
    found = [(a, b, "email") for a, b in emails(text)] if "@" in text else []
    if DIGITS.search(text):
        for a, b in addresses(text):
            if all(len(p.lstrip("0")) < 4 and int(p[-4:]) <= 255 for p in text[a:b].split(".")):
                found.append((a, b, "ip"))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((*m.span(), "card"))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append((*m.span(), "phone"))
    return in_order(found)


def in_order(spans):
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


# Letters of other scripts and the ASCII letter that looks the same.
ALIKE = dict(zip("аеорсухіјѕԁһԛԝвкмнтАВЕКМНОРСТХІЈЅΑΒΕΖΗΙΚΜΝΟΡΤΥΧονρ", "aeopcyxijsdhqwbkmhtABEKMHOPCTXIJSABEZHIKMNOPTYXovp"))
INVISIBLE = "\u200b\u200c\u200d\u2060\ufeff\u00ad"
#: Characters that the first transducer may change.
FOREIGN = re.compile(
    "[" + "".join(ALIKE) + INVISIBLE
    + "²³¹٠-٩۰-۹०-९⁰-₉①-⑩！-～\U0001d400-\U0001d7ff]"
)

# Words for the digits from 0 to 9.
SPELLED = {
    "en": "zero one two three four five six seven eight nine",
    "de": "null eins zwei drei vier fünf sechs sieben acht neun",
    "fr": "zéro un deux trois quatre cinq six sept huit neuf",
    "es": "cero uno dos tres cuatro cinco seis siete ocho nueve",
}
DIGIT = {w: str(i) for line in SPELLED.values() for i, w in enumerate(line.split())} | {"oh": "0"}
_WORD = "|".join(sorted(DIGIT, key=lambda w: (-len(w), w)))
#: Digits and words for digits in any mixture, parted by white space and signs; identifiers found in them decide.
_PART = rf"(?:(?:{_WORD})(?!\w)|\+?[0-9]+(?!\w))"
_GAP = r"(?:[\s,-]+(?:dot|point|punkt|punto)[\s,-]+|[\s,.()-]+)"
SPELLED_RUN = re.compile(rf"(?i)(?<!\w)(?:plus[\s,.-]+)?{_PART}(?:{_GAP}{_PART})+")
SPELLED_PART = re.compile(rf"(?i)(?<!\w)(?:plus|dot|point|punkt|punto|{_WORD})(?!\w)|\+?[0-9]+")
#: Words that stand between digits without ending a run.
BETWEEN = frozenset("dot point punkt punto".split())
TOKEN = re.compile(r"\w+")

BRACKETED = re.compile(r"(?i)\s?[\[({<]\s?(at|@|dot|punkt|point|punto|\.)\s?[\])}>]\s?")
# Ends of domain names that count where "dot" stands as a plain word.
ENDS = "com|org|net|edu|gov|info|io|co|de|fr|es|uk|eu|us|ai|dev|app|biz|ch|at|it|nl|example|test"
#: Behind the sign of an address in words: names and "dot" or points up to one of these ends.
WORDED_DOMAIN = re.compile(rf"(?i)[a-z0-9-]+(?:(?:\s+dot\s+|\.)[a-z0-9-]+)*(?:\s+dot\s+|\.)(?:{ENDS})(?!\w)")
AT = re.compile(r"(?i)(?<=\s)at(?=\s)|@")
NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_%+-")
WORD_SIGN = re.compile(r"(?i)\s+(at|dot)\s+")
#: What an address in words has.
SIGN_WORD = re.compile(r"(?i)\s(?:at|dot)\s")


def _name_before(text: str, at: int, done: int) -> int | None:
    """Where the name that ends at ``at`` begins: names parted by points or "dot", behind what is neither word nor point."""
    start, end = None, at
    while True:
        here = end
        while here > done and text[here - 1] in NAME:
            here -= 1
        if here == end:
            break
        for p in range(end - 1, here - 1, -1):
            before = text[p - 1] if p else " "
            if text[p] not in "_%+-" and before != "." and before != "_" and not before.isalnum():
                start = p
        gap = here
        if gap > done and text[gap - 1] == ".":
            end = gap - 1
            continue
        while gap > done and text[gap - 1].isspace():
            gap -= 1
        if gap == here or text[max(done, gap - 3) : gap].lower() != "dot":
            break
        end = gap - 3
        while end > done and text[end - 1].isspace():
            end -= 1
        if end == gap - 3:
            break
    return start


def worded(text: str):
    """Spans of addresses with words for signs, leftmost and non-overlapping: from each sign outwards."""
    done = 0
    for m in AT.finditer(text):
        a, b = m.span()
        if m[0] != "@":
            while a > done and text[a - 1].isspace():
                a -= 1
            while b < len(text) and text[b].isspace():
                b += 1
        domain = WORDED_DOMAIN.match(text, b) if a > done and text[a - 1] in NAME else None
        if domain:
            start = _name_before(text, a, done)
            if start is not None:
                done = domain.end()
                yield start, done


class Mapped:
    """A text and, for each of its characters, the range of the source it stands for."""

    def __init__(self, text: str):
        self.text = text
        self.start = list(range(len(text)))
        self.end = list(range(1, len(text) + 1))
        self.changed = bytearray(len(text))

    def replace(self, edits: list[tuple[int, int, str]]) -> None:
        """Put texts in place of ranges, which ascend and do not overlap; each character stands for its whole range."""
        text, start, end, changed, done = [], [], [], bytearray(), 0
        for a, b, new in edits:
            text += [self.text[done:a], new]
            start += self.start[done:a] + [self.start[a]] * len(new)
            end += self.end[done:a] + [self.end[b - 1]] * len(new)
            changed += self.changed[done:a] + b"\1" * len(new)
            done = b
        self.text = "".join([*text, self.text[done:]])
        self.start, self.end = start + self.start[done:], end + self.end[done:]
        self.changed = changed + self.changed[done:]


def ascii_of(c: str) -> str:
    if c in INVISIBLE:
        return ""
    if c in ALIKE:
        return ALIKE[c]
    digit = unicodedata.digit(c, None)
    if digit is not None:
        return str(digit)
    plain = unicodedata.normalize("NFKC", c)
    return plain if plain.isascii() else c


def look_alikes(t: Mapped) -> None:
    t.replace([(m.start(), m.end(), ascii_of(m[0])) for m in FOREIGN.finditer(t.text)])


def signs(t: Mapped) -> None:
    t.replace([(*m.span(), "@" if m[1].lower() in ("at", "@") else ".") for m in BRACKETED.finditer(t.text)])
    edits = []
    for a, b in worded(t.text):
        marks = list(WORD_SIGN.finditer(t.text, a, b))
        if sum(m[1].lower() == "at" for m in marks) + t.text.count("@", a, b) == 1:
            edits += [(*m.span(), "@" if m[1].lower() == "at" else ".") for m in marks]
    t.replace(edits)


def has_spelled(text: str) -> bool:
    """Whether a word for a digit stands beside a digit or another such word."""
    tokens = [w for w in TOKEN.findall(text.lower()) if w not in BETWEEN]
    if DIGIT.keys().isdisjoint(tokens):
        return False
    kinds = [2 if w in DIGIT else 1 if w[0].isdigit() else 0 for w in tokens]
    return any(a and b and a + b > 2 for a, b in zip(kinds, kinds[1:]))


def spelled(t: Mapped) -> None:
    """Spelled digits become digits that touch their neighbours; the signs between digits stay as they are.

    A point between a digit and a spelled one stays, as it does in four spelled numbers parted by points.  One word
    beside an identifier that is whole without it is a word.
    """
    edits = []
    whole = None
    for run in SPELLED_RUN.finditer(t.text):
        text = run[0]
        parts = list(SPELLED_PART.finditer(text))
        words = [p for p in parts if p[0].lower() in DIGIT]
        if not words:
            continue
        if len(words) == 1 and len(parts) > 1:
            if whole is None:
                numbers = [(a, b) for a, b, kind in base(t.text) if kind != "email"]
                whole = [a for a, _ in numbers], list(accumulate((b for _, b in numbers), max))
            last = bisect_left(whole[0], run.end())
            if last and whole[1][last - 1] > run.start():
                continue
        gaps = [text[p.end() : q.start()] for p, q in zip(parts, parts[1:])]
        address = len(parts) == 4 and gaps == ["."] * 3
        for i, part in enumerate(parts):  # a spelled part reaches to the next one, so that the digits touch
            word = part[0].lower()
            stop = parts[i + 1].start() if i + 1 < len(parts) else part.end()
            plain = part[0][-1].isdigit()
            ahead = i + 1 < len(parts) and parts[i + 1][0][-1].isdigit()
            point = stop > part.end() and gaps[i] == "." and (address or plain != ahead)
            if plain:
                if not (ahead or point) and stop > part.end():
                    edits.append((run.start() + part.end(), run.start() + stop, ""))
                continue
            new = DIGIT.get(word, "+" if word == "plus" else ".")
            edits.append((run.start() + part.start(), run.start() + (part.end() if point else stop), new))
    t.replace(edits)


def has_signs(text: str) -> bool:
    return bool(BRACKETED.search(text) or SIGN_WORD.search(text) and next(worded(text), None))


def disguised(text: str, known: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Spans that only the transducers' output shows; a known span of its kind lies beside or properly inside it."""
    foreign = not text.isascii() and FOREIGN.search(text)
    digits = has_spelled(text)
    mark = has_signs(text)
    if not (foreign or digits or mark):
        return []
    t = Mapped(text)
    if foreign:
        look_alikes(t)
        digits, mark = has_spelled(t.text), has_signs(t.text)
    if digits:
        spelled(t)
    if mark or digits:
        signs(t)
    taken: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    for a, b, kind in known:
        taken[kind].append((a, b))
    out = []
    for a, b, kind in base(t.text):
        if any(t.changed[a:b]):
            span, spans = (t.start[a], t.end[b - 1]), taken[kind]
            # Known spans of a kind ascend and do not overlap: those that meet this one stand together.
            first = bisect_right(spans, span[0], key=lambda s: s[1])
            meets = spans[first : bisect_left(spans, span[1], key=lambda s: s[0])]
            if all(span[0] <= x and y <= span[1] and span != (x, y) for x, y in meets):
                out.append((*span, kind))
    return out


def find(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Base spans, and all spans with those of disguised identifiers, in order."""
    known = base(text)
    return known, in_order(known + disguised(text, known))


def listed(spans) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def scan(docs: DataFrame) -> DataFrame:
    """Every row's numbers of base spans per kind, and both lists of spans; null texts count as empty."""

    def work(batches):
        for batch in batches:
            doc_ids, texts = columns_of(batch, "doc_id", "text")
            out = {n: [] for n in ("doc_id", *(f"n_{k}" for k in KINDS), "base_spans", "spans")}
            for doc_id, text in zip(doc_ids, texts):
                own, spans = find(text or "")
                out["doc_id"].append(doc_id)
                for k in KINDS:
                    out[f"n_{k}"].append(sum(s[2] == k for s in own))
                out["base_spans"].append(listed(own))
                out["spans"].append(listed(spans))
            yield out

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return map_batches(docs.select("doc_id", "text"), work, f"doc_id long, {counts}, base_spans string, spans string")


def redacted(text: str) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans become the first one's kind."""
    out, done = [], 0
    merged: list[list] = []
    for a, b, kind in find(text)[1]:
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b, kind])
    for a, b, kind in merged:
        out += [text[done:a], f"[{kind.upper()}]"]
        done = b
    return "".join([*out, text[done:]]) if merged else text


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with all their columns, personal data replaced; null texts stay null."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("string")
    def work(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else redacted(t))

    return docs.withColumn(text, work(text))
