"""Personal data by anchor expansion.

An Aho-Corasick automaton walks each text once and reports anchors: at-signs, schemes,
identifier cues, plus signs and digits. At each anchor a local parser expands to the left
and right and validates the boundaries, so no pattern is ever searched over whole texts.

Base kinds (leftmost, non-overlapping per kind, a failing match is dropped and not retried):

- email  `[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`, from each at-sign
- ip     four dotted numbers, each at most 255, from the first digit of a number
- card   14 to 19 digits with single blanks or hyphens between them, passing Luhn
- phone  plus sign, 10 to 15 digits with the usual punctuation

Added kinds: `masked` ("name at host dot org" written with brackets), `login` (user and
password in a URL), `account` (value after a cue such as token, password, iban, ssn).

Null and empty texts give no spans; very long texts are read once, in linear time. Values,
users, passwords and local parts are taken whole, however long.
Positions count code points, ends are exclusive. Copies and repeated rows are each reported.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starledger.llm.base import quoted, texts_of

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "masked", "login", "account")

CUES = (
    "token", "password", "passwd", "pwd", "secret", "api_key", "apikey", "api-key", "access_key",
    "iban", "ssn", "social security", "passport", "account", "acct", "routing",
)
MASKS = ("[at]", "(at)", "{at}")

Span = tuple[str, int, int]


class SpanFinder:
    """All spans of one text; built once per task."""

    def __init__(self):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        anchors = {"@": "at", "+": "plus", "://": "scheme"}
        anchors |= dict.fromkeys("0123456789", "digit")
        anchors |= dict.fromkeys(MASKS, "mask") | dict.fromkeys(CUES, "cue")
        for word, kind in anchors.items():
            self.automaton.add_word(word, (kind, len(word)))
        self.automaton.make_automaton()
        #: Cues are found in any case; only A-Z are folded, so positions stay.
        self.lower = {c: c + 32 for c in range(65, 91)}
        self.local = re.compile(r"[A-Za-z0-9._%+-]")
        self.domain = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
        self.number = re.compile(r"[0-9]++")
        self.ip = re.compile(r"([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
        self.card = re.compile(r"[0-9](?:[ -]?[0-9])++")
        self.phone = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
        self.masked_right = re.compile(
            r" ?[A-Za-z0-9-]++(?: ?(?:\.|\[dot\]|\(dot\)|\{dot\}) ?[A-Za-z0-9-]++)++", re.I
        )
        self.login = re.compile(r"[^\s/@:]++:[^\s/@]++(?=@[A-Za-z0-9])")
        self.before_value = re.compile(
            r"(?:[ _-]?(?:number|no|num|id|key))?[ \t]*[:=#][ \t]*[\"']?(?=[A-Za-z0-9])", re.I
        )
        self.value = re.compile(r"(?:[A-Za-z0-9+/_=.-]|[ ](?=[0-9]))++", re.I)

    def spans(self, text: str) -> list[Span]:
        """Spans by start, then kind in the listed order."""
        found: list[Span] = []
        self.run = (0, -1)  # end and last digit of the latest run of value characters
        free = dict.fromkeys(KINDS, 0)  # where the next match of a kind may start
        folded = text.translate(self.lower) if not text.islower() else text
        for last, (kind, size) in self.automaton.iter(folded):
            start = last + 1 - size
            if kind == "digit":
                self._ip(text, start, free, found)
                self._card(text, start, free, found)
            elif kind == "at":
                self._email(text, start, free, found)
            elif kind == "plus":
                self._phone(text, start, free, found)
            elif kind == "mask":
                self._masked(text, start, last + 1, free, found)
            elif kind == "scheme":
                self._login(text, last + 1, free, found)
            else:
                self._account(text, start, last + 1, free, found)
        rank = {kind: i for i, kind in enumerate(KINDS)}
        return sorted(found, key=lambda span: (span[1], rank[span[0]], span[2]))

    def _email(self, text, at, free, found):
        start = at
        while start > free["email"] and self.local.match(text, start - 1):
            start -= 1
        if start == at:
            return
        domain = self.domain.match(text, at + 1)
        if domain:
            found.append(("email", start, domain.end()))
            free["email"] = domain.end()

    def _ip(self, text, at, free, found):
        if at < free["ip"]:
            return
        match = self.ip.match(text, at)
        if not match:
            free["ip"] = self.number.match(text, at).end()
            return
        free["ip"] = match.end()
        parts = [part.lstrip("0") for part in match.groups()]
        if all(len(part) <= 3 and int(part or 0) <= 255 for part in parts):
            found.append(("ip", at, match.end()))

    def _card(self, text, at, free, found):
        if at < free["card"]:
            return
        match = self.card.match(text, at)
        if not match:
            return
        free["card"] = match.end()
        digits = [int(c) for c in match[0] if c.isdigit()] if match.end() - at < 40 else []
        if 14 <= len(digits) <= 19 and _luhn(digits):
            found.append(("card", at, match.end()))

    def _phone(self, text, at, free, found):
        if at < free["phone"]:
            return
        match = self.phone.match(text, at)
        if not match:
            return
        free["phone"] = match.end()
        if 10 <= sum(c.isdigit() for c in match[0]) <= 15:
            found.append(("phone", at, match.end()))

    def _masked(self, text, start, end, free, found):
        # Masks hold brackets, so runs of local characters before two of them never overlap.
        stop = start
        for gap in "\n ":
            stop -= stop > free["masked"] and text[stop - 1] == gap
        left = stop
        while left > free["masked"] and self.local.match(text, left - 1):
            left -= 1
        right = self.masked_right.match(text, end)
        if left < stop and right:
            found.append(("masked", left, right.end()))
            free["masked"] = right.end()

    def _login(self, text, at, free, found):
        match = self.login.match(text, at)
        if match and at >= free["login"]:
            found.append(("login", match.start(), match.end()))
            free["login"] = match.end()

    def _account(self, text, start, end, free, found):
        if start < free["account"] or (start and text[start - 1].isalnum()):
            return
        before = self.before_value.match(text, end)
        if not before:
            return
        at = before.end()
        if at >= self.run[0]:
            # Read once: cues inside this run share its end and its last digit.
            stop = self.value.match(text, at).end()
            self.run = (stop, max(text.rfind(digit, at, stop) for digit in "0123456789"))
        stop, digit = self.run
        if stop - at >= 6 and digit >= at:
            found.append(("account", at, stop))
            free["account"] = stop


def _luhn(digits: list[int]) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        total += digit if i % 2 == 0 else (2 * digit if digit < 5 else 2 * digit - 9)
    return total % 10 == 0


SPAN_TYPE = "array<struct<kind:string,start:int,end:int>>"


def _span_udf():
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        finder = SpanFinder()
        kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
        for column in batches:
            found = [
                [dict(zip(("kind", "start", "end"), span)) for span in finder.spans(text)]
                for text in texts_of(column).to_pylist()
            ]
            yield pa.array(found, pa.list_(kind))

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, SPAN_TYPE)


def _redact_udf():
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        finder = SpanFinder()
        for column in batches:
            yield pa.array([_cut(text, finder) for text in column.to_pylist()], pa.string())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "string")


def _cut(text: str | None, finder: SpanFinder) -> str | None:
    if not text:
        return text
    kept, at = [], 0
    for kind, start, end in finder.spans(text):
        if end <= at:
            continue
        if start >= at:
            kept += [text[at:start], f"<{kind.upper()}>"]
        at = end
    return "".join([*kept, text[at:]])


def find_spans(documents: DataFrame, text: str = "text", into: str = "spans") -> DataFrame:
    """The rows with `into`: array<struct<kind, start, end>> of all spans, in order.

    A column that is already called `into` is replaced; other columns are kept.
    """
    return documents.withColumn(into, _span_udf()(quoted(text)))


def redact(documents: DataFrame, text: str = "text") -> DataFrame:
    """The rows with each span replaced by its kind in angle brackets; null stays null.

    Overlapping spans become one gap under the kind of the first.
    """
    return documents.withColumn(text, _redact_udf()(quoted(text)))
