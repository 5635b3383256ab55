"""Personal data with offset-preserving deobfuscation.

Base spans are found by pattern in the text itself.  Then transducers rewrite the text, each
keeping for every character the source span that it stands for: look-alike characters become
ASCII, words for digits become digits, and written-out "at", "dot" and "plus" become their
signs.  The same patterns run over the rewritten text, and what they find is mapped back to
source characters.  A method span is added where it overlaps no base span of its kind.

Transducers only change a text that holds something for them to change; then all of it is
rewritten.  Rows are independent: a scan, no shuffle.

Defined results: a null or empty text has no spans; an added span that overlaps a base span of its kind
gives way to it, spans that begin together go by kind; repeated rows get equal results; an empty
table gives no rows; the other columns stay, a new column gets another name if its name is
taken.  Patterns take time in proportion to the text, however long its runs are.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import fresh
from ledgerline.session import ship_functions

ship_functions(__name__)

KINDS = ("email", "ip", "card", "phone")

Span = tuple[int, int]

#: The parts of the base patterns.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin where a run of digits begins, so later places of the run need no try.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NOT_DIGITS = re.compile(r"[^0-9]+")

#: Characters that look like ASCII ones.
LOOK_ALIKES = str.maketrans(
    "АВЕЅІЈКМНОРСТХУаеѕіјорсухԁһԛԝ" "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧοινα" "․‐‑‒–−＿·∙•",
    "ABESIJKMHOPCTXYaesijopcyxdhqw" "ABEZHIKMNOPTYXoiva" ".-----_...",
)
LOOK_ALIKES |= {0xFF01 + i: 0x21 + i for i in range(94)}  # full width
LOOK_ALIKES |= {start + i: 0x30 + i for start in (0x660, 0x6F0, 0x966) for i in range(10)}  # other digits
LOOK_ALIKES |= {0xA0: 0x20, 0x202F: 0x20, 0x2009: 0x20}
LOOK_ALIKE = re.compile("[" + "".join(re.escape(chr(c)) for c in sorted(LOOK_ALIKES)) + "]")

#: Words for digits and signs.
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7",
    "eight": "8", "nine": "9",
}
_DIGIT = "|".join(DIGIT_WORDS)
#: Three or more digits in a row, of which at least one is a word.
SPELLED = re.compile(rf"\b(?:plus[ -]+)?(?:(?:{_DIGIT}|[0-9]+)(?:[ -]+|\s*(?:\(|\[)?(?:dot|point)(?:\)|\])?\s*))+(?:{_DIGIT}|[0-9]+)\b", re.I)
SPELLED_PART = re.compile(rf"\b(?:{_DIGIT})\b|[ -]*\(?\[?\b(?:dot|point)\b\)?\]?[ -]*|\bplus\b[ -]*|[0-9]+|[ -]+", re.I)
SPELLED_HINT = re.compile(rf"\b(?:{_DIGIT})(?:[ -]+|\s*(?:dot|point)\s*)(?:{_DIGIT}|[0-9])", re.I)

_AT = r"(?:\s*[\[({<]\s*(?:at|@)\s*[\])}>]\s*|\s+at\s+)"
_DOT = r"(?:\s*[\[({<]\s*(?:dot|\.)\s*[\])}>]\s*|\s+dot\s+)"
#: A local part, a disguised or plain at, and labels with disguised or plain dots, at least one of them disguised.
DISGUISED = re.compile(
    rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9_%+-]++(?:(?:\.|{_DOT})[A-Za-z0-9_%+-]++){{0,4}}(?:{_AT}|@)"
    rf"[A-Za-z0-9-]++(?:(?:\.|{_DOT})[A-Za-z0-9-]++){{1,6}}", re.I)
DISGUISE_HINT = re.compile(r"[\[({<]\s*(?:at|dot|@|\.)\s*[\])}>]|\sdot\s", re.I)
#: Last labels that tell an address in plain words from prose.
LAST_LABELS = frozenset("com org net edu gov mil int info biz io co ai app dev de fr es it nl be ch at eu uk us ca au jp in br mx example".split())
AT_PART, DOT_PART = re.compile(_AT, re.I), re.compile(_DOT, re.I)


def _emails(text: str) -> list[Span]:
    """Leftmost matches of a local part, @ and a domain of two labels or more, from each @ outwards."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, domain.end()))
            done = domain.end()
        at = text.find("@", max(at + 1, done))
    return found


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        value = int(d) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _small(part: str) -> bool:
    """A number of at most 255, however many zeros lead it."""
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def base_spans(text: str) -> dict[str, list[Span]]:
    """Spans of each kind by the base patterns; matches that fail their test are dropped."""
    ips = [m.span() for m in IP.finditer(text) if all(map(_small, m[0].split(".")))]
    cards = []
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(digits := NOT_DIGITS.sub("", m[0])) <= 19 and _luhn(digits):
            cards.append(m.span())
    phones = [m.span() for m in PHONE.finditer(text) if 9 <= len(NOT_DIGITS.sub("", m[0])) <= 15]
    return {"email": _emails(text), "ip": ips, "card": cards, "phone": phones}


class Tape:
    """A text with the source span of every character."""

    def __init__(self, text: str):
        self.text, self.starts, self.ends = text, range(len(text)), range(1, len(text) + 1)

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replaces parts of the current text; the characters of a replacement stand for the whole part."""
        if not edits:
            return
        parts: list[str] = []
        starts: list[int] = []
        ends: list[int] = []
        done = 0
        for start, end, new in edits:
            parts += [self.text[done:start], new]
            starts.extend(self.starts[done:start])
            ends.extend(self.ends[done:start])
            starts.extend([self.starts[start]] * len(new))
            ends.extend([self.ends[end - 1]] * len(new))
            done = end
        parts.append(self.text[done:])
        starts.extend(self.starts[done:])
        ends.extend(self.ends[done:])
        self.text, self.starts, self.ends = "".join(parts), starts, ends

    def source(self, span: Span) -> Span:
        return self.starts[span[0]], self.ends[span[1] - 1]


def _spelled_edits(text: str) -> list[tuple[int, int, str]]:
    """Digits and signs for words; the space between two words for digits goes."""
    edits = []
    for m in SPELLED.finditer(text):
        run = m[0]
        if not SPELLED_HINT.search(run):
            continue
        for p in SPELLED_PART.finditer(run):
            word = p[0].strip(" -()[]").lower()
            start, end = m.start() + p.start(), m.start() + p.end()
            if word in DIGIT_WORDS:
                edits.append((start, end, DIGIT_WORDS[word]))
            elif word in ("dot", "point"):
                edits.append((start, end, "."))
            elif word == "plus":
                edits.append((start, end, "+"))
            elif not word:
                edits.append((start, end, ""))
    return edits


def _disguise_edits(text: str) -> list[tuple[int, int, str]]:
    edits = []
    for m in DISGUISED.finditer(text):
        at, dots = AT_PART.search(m[0]), list(DOT_PART.finditer(m[0]))
        bracketed = any(p and re.search(r"[\[({<]", p[0]) for p in (at, *dots))
        last = re.split(r"[^A-Za-z0-9-]+", m[0])[-1].lower()
        if not (bracketed or dots and last in LAST_LABELS):
            continue  # the plain words are prose
        found = sorted([(p.start(), p.end(), s) for p, s in [(at, "@"), *((d, ".") for d in dots)] if p])
        edits += [(m.start() + a, m.start() + b, s) for a, b, s in found]
    return edits


def normalised(text: str) -> Tape | None:
    """The rewritten text, or None when no transducer changes it."""
    tape, changed = Tape(text), False
    if not text.isascii() and LOOK_ALIKE.search(text):
        tape.text, changed = text.translate(LOOK_ALIKES), True  # one character for one
    for hint, edits in ((SPELLED_HINT, _spelled_edits), (DISGUISE_HINT, _disguise_edits)):
        if hint.search(tape.text) and (found := edits(tape.text)):
            tape.rewrite(found)
            changed = True
    return tape if changed else None


def all_spans(text: str) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """Base spans, and those that the method adds."""
    base = base_spans(text)
    added: dict[str, list[Span]] = {k: [] for k in KINDS}
    if tape := normalised(text):
        for kind, spans in base_spans(tape.text).items():
            known = base[kind]
            for start, end in map(tape.source, spans):
                i = bisect_left(known, (start, start))
                overlaps = i < len(known) and known[i][0] < end or i > 0 and known[i - 1][1] > start
                if not overlaps:
                    added[kind].append((start, end))
    return base, added


def listed(spans: dict[str, list[Span]]) -> list[tuple[str, int, int]]:
    """By start, then by kind."""
    return sorted(((k, a, b) for k in spans for a, b in spans[k]), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
    T.StructField("base", T.BooleanType()),
]))


def find(docs: DataFrame, text_col: str = "text", name: str = "spans", masked: str | None = None) -> tuple[DataFrame, str]:
    """The frame with one more column, the spans of the text (kind, start, end, base); and its name.

    With ``masked``, the text itself is replaced by one in which every span reads as this
    format of its kind, such as "[{}]"; overlapping spans are masked as one, by the first kind.
    """
    import pyarrow as pa

    (name,) = fresh(docs, name)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, SPANS)])

    def row(text: str | None) -> tuple[list[dict], str | None]:
        base, added = all_spans(text or "")
        plain = {(k, *s) for k in base for s in base[k]}
        both = listed({k: sorted([*base[k], *added[k]]) for k in KINDS})
        return [{"kind": k, "start": a, "end": b, "base": (k, a, b) in plain} for k, a, b in both], mask(text, both, masked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            rows = [row(x.as_py()) for x in batch.column(at)]
            columns = list(batch.columns)
            if masked is not None:
                columns[at] = pa.array([text for _, text in rows], batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array([s for s, _ in rows], kind)], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, schema), name


def mask(text: str | None, spans: list[tuple[str, int, int]], form: str | None) -> str | None:
    if not text or not spans or form is None:
        return text
    parts, done, i = [], 0, 0
    while i < len(spans):
        kind, start, end = spans[i]
        i += 1
        while i < len(spans) and spans[i][1] < end:
            end = max(end, spans[i][2])
            i += 1
        parts += [text[done:start], form.format(kind.upper())]
        done = end
    return "".join([*parts, text[done:]])


def spelled_out(spans: str, base_only: bool = False):
    """kind:start:end of the spans, comma-joined."""
    kept = F.filter(spans, lambda s: s["base"]) if base_only else F.col(spans)
    return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(spans: str, kind: str):
    return F.size(F.filter(spans, lambda s: s["base"] & (s["kind"] == kind))).cast("long")
