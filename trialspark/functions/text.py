"""Token columns and lexical scores."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOKEN = "[a-z0-9]+"
WORD = r"[\p{L}\p{M}\p{N}]+"

# English function words left out of token features.
STOP_WORDS = tuple(
    """
    a about above after again all also am an and any are as at be because been before being below
    between both but by can could did do does doing down during each few for from further had has
    have having he her here hers herself him himself his how i if in into is it its itself just me
    more most my myself no nor not now of off on once only or other our ours ourselves out over own
    same she should so some such than that the their theirs them themselves then there these they
    this those through to too under until up very was we were what when where which while who whom
    why will with would you your yours yourself yourselves
    """.split()
)


def tokens(c: Column | str) -> Column:
    """Lower-case runs of ASCII letters and digits; null text has none."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(TOKEN), F.lit(0))


def word_tokens(c: Column | str) -> Column:
    """Lower-case runs of letters, marks and digits of any script; null text has none."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(WORD), F.lit(0))


def alphabetic(c: Column | str) -> Column:
    """Those without a digit."""
    c = F.col(c) if isinstance(c, str) else c
    text = F.lower(F.coalesce(c, F.lit("")))
    return F.regexp_extract_all(text, F.lit(r"(?<![\p{L}\p{M}\p{N}])[\p{L}\p{M}]++(?!\p{N})"), F.lit(0))


def not_stop(word: Column, stop_words: Iterable[str] = STOP_WORDS) -> Column:
    return ~word.isin(*stop_words)


def words(c: Column | str, stop_words: Iterable[str] = STOP_WORDS) -> Column:
    """Alphabetic tokens without stop words."""
    stop = list(stop_words)
    return F.filter(alphabetic(c), lambda t: not_stop(t, stop)) if stop else alphabetic(c)


def query_tokens(query: str) -> list[str]:
    return re.findall(TOKEN, query.lower())


def contains_token(c: Column | str, token: str) -> Column:
    """Whether a token occurs in the text, without building the token array."""
    c = F.col(c) if isinstance(c, str) else c
    return F.lower(F.coalesce(c, F.lit(""))).rlike(f"(?<![a-z0-9]){re.escape(token)}(?![a-z0-9])")


def lexical_overlap(query: str, c: Column | str) -> Column:
    """Share of query tokens (repeats counted) that the text contains."""
    counted = Counter(query_tokens(query))
    if not counted:
        return F.lit(0.0)
    found = tokens(c)
    hits = F.lit(0)
    for token, times in counted.items():
        hits = hits + F.when(F.array_contains(found, token), times).otherwise(0)
    return hits / F.lit(float(sum(counted.values())))


def clean_text(c: Column | str) -> Column:
    """Drop tags and control characters, fold runs of white space to one blank, trim."""
    c = F.col(c) if isinstance(c, str) else c
    plain = F.regexp_replace(F.coalesce(c, F.lit("")), r"<[^<>]*>", " ")
    return F.trim(F.regexp_replace(plain, r"[\x00-\x20\x7F]+", " "))


def ngrams(token_array: Column, n: int) -> Column:
    """Runs of ``n`` tokens joined by blanks."""
    def gram(i: Column) -> Column:
        parts = [p for k in range(n) for p in (F.lit(" "), F.get(token_array, i + k))][1:]
        return F.concat(*parts)

    grams = F.transform(F.sequence(F.lit(0), F.size(token_array) - n), gram)
    return F.when(F.size(token_array) >= n, grams).otherwise(F.array().cast("array<string>"))


#: Texts whose results are Python objects at one time.
TEXTS_AT_ONCE = 64
_KINDS = {"int": (T.IntegerType(), pa.int32()), "string": (T.StringType(), pa.string()), "double": (T.DoubleType(), pa.float64())}


def _rows_of(**fields: str) -> Callable[[Callable[[str | None], list[dict]]], Callable[[Column | str], Column]]:
    """Make an Arrow function, text → array of structs of the fields, from one of a single text.

    Results are handed on every few texts: as Python objects those of a whole batch take many times its size.
    The type is built, since a DDL string would need a session when the module is imported.
    """
    kind = T.ArrayType(T.StructType([T.StructField(n, _KINDS[k][0]) for n, k in fields.items()]))
    own = pa.list_(pa.struct([(n, _KINDS[k][1]) for n, k in fields.items()]))

    def wrap(of_text: Callable[[str | None], list[dict]]) -> Callable[[Column | str], Column]:
        @F.arrow_udf(kind)
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for texts in batches:
                for at in range(0, len(texts), TEXTS_AT_ONCE):
                    yield pa.array([of_text(t) for t in texts.slice(at, TEXTS_AT_ONCE).to_pylist()], own)

        return run

    return wrap


def match_spans(pattern: str, lower: bool = False):
    """Arrow function: text → array of (text, start, end) for each match, offsets in characters.

    Spark's own functions return matches without their positions, and summing lengths per row
    would be quadratic in the length of the text.
    """
    compiled = re.compile(pattern)

    @_rows_of(text="string", start="int", end="int")
    def spans(text: str | None) -> list[dict]:
        if text is None:
            return []
        return [
            {"text": m.group().lower() if lower else m.group(), "start": m.start(), "end": m.end()}
            for m in compiled.finditer(text)
        ]

    return spans


_LINE = re.compile(r"[^\r\n]+")
_LEAD = re.compile(r"(?:[\s*•\-]|\d+[.)]\s)*")
_NAME = re.compile(r"[^\W_]+")
#: Most words of a line that can be a header.
HEADER_WORDS = 8


def criteria_header(core: str, bulleted: bool, before_bullets: bool) -> tuple[str, int] | None:
    """(kind, place of what follows) of a line that starts a section of criteria, else nothing.

    A header is a line of few words that names inclusion or exclusion, up to its colon. Without a colon
    it stands before bullets, or it is the phrase ``exclusion criteria`` with at most two words before
    it and three after it; a bullet without a colon is the bare phrase. A bullet with more text after
    its colon is a clause. A header that names both kinds decides nothing: ``unknown``.
    """
    colon = core.find(":")
    words = [w.lower() for w in _NAME.findall(core[:colon] if colon >= 0 else core)]
    kinds = {w for w in words if w in ("inclusion", "exclusion")}
    if not kinds or len(words) > HEADER_WORDS:
        return None
    if colon >= 0:
        if bulleted and core[colon + 1 :].strip():
            return None
    else:
        at = next((k for k, pair in enumerate(zip(words, words[1:])) if pair[0] in kinds and pair[1] == "criteria"), None)
        bare = at is not None and at <= 2 and len(words) - at <= 5
        if not (at == 0 and len(words) == 2 if bulleted else bare or before_bullets):
            return None
    return kinds.pop() if len(kinds) == 1 else "unknown", colon + 1 if colon >= 0 else len(core)


@_rows_of(line_no="int", criterion_type="string", text="string", start="int")
def criteria_lines(text: str | None) -> list[dict]:
    """The clauses of criteria texts in order, each with its section's kind and its place; headers are left out.

    One pass over each text. Lines before any header have kind ``unknown``.
    """
    if text is None:
        return []
    lines = list(_LINE.finditer(text))
    leads = [_LEAD.match(m.group()).group() for m in lines]
    kind, out = "unknown", []
    for k, (m, lead) in enumerate(zip(lines, leads)):
        start, core = m.start() + len(lead), m.group()[len(lead) :]
        follows = k + 1 < len(lines) and bool(leads[k + 1].strip())
        header = criteria_header(core, bool(lead.strip()), follows)
        if header is not None:
            kind, skip = header
            skip += _LEAD.match(core[skip:]).end()
            start, core = start + skip, core[skip:]
        body = core.rstrip()
        if body:
            out.append({"line_no": k, "criterion_type": kind, "text": body, "start": start})
    return out


_COMPARE = re.compile(r">=|<=|≥|≤|>|<|=")
_NUMBER = r"[-+−]?(?:\d{1,3}(?:,\d{3})+(?![\d,])(?:\.\d+)?|\d+(?:[.,]\d+)?)"
_UNIT = r"(?!(?:and|or|to|but)\b)(?:x\s+[A-Za-z]+|/?[A-Za-zµ%][A-Za-z0-9µ%/^]*)"
_RIGHT = re.compile(rf"\s*({_NUMBER})(?:\s*({_UNIT}))?")
_LEFT = re.compile(rf"(?<![\w.,])({_NUMBER})(?:\s*({_UNIT}))?\s*$")
_FIELD = re.compile(r"[A-Za-z][A-Za-z0-9 _\-]*$")
_FIELD_AFTER = re.compile(r"\s*([A-Za-z][A-Za-z0-9 _\-]*)")
_JOINING = re.compile(r"^(?:(?:and|or|to|but)(?:\s+|$))+")
# A comparison read from the other side.
_FLIPPED = {">=": "<=", "<=": ">=", ">": "<", "<": ">", "=": "="}


def _number(text: str) -> float:
    plain = text.replace("−", "-")
    grouped = re.fullmatch(r"[-+]?\d{1,3}(?:,\d{3})+(?:\.\d+)?", plain)
    return float(plain.replace(",", "") if grouped else plain.replace(",", "."))


def _field(text: str) -> str:
    return _JOINING.sub("", text.strip().lower()).strip()


@_rows_of(field="string", comparator="string", value="double", unit="string", raw="string")
def comparisons(text: str | None) -> list[dict]:
    """Every comparison of each text; see :func:`trialspark.operators.textjobs.normalized_clauses`."""
    if text is None:
        return []
    marks = list(_COMPARE.finditer(text))
    out, free, last = [], 0, ""
    for k, m in enumerate(marks):
        stop = marks[k + 1].start() if k + 1 < len(marks) else len(text)
        sign = m.group().replace("≥", ">=").replace("≤", "<=")
        before = text[free : m.start()]
        right = _RIGHT.match(text, m.end(), stop)
        left = _LEFT.search(before[-80:])
        if right is not None or left is None:
            found = _FIELD.search(before[-400:])
            name = _field(found.group()) if found else ""
            value, unit = (_number(right.group(1)), right.group(2)) if right else (None, None)
            begin = free + len(before) - (len(found.group()) if found else 0)
            end = right.end() if right else stop
            free = end if right else m.end()
        else:  # the number stands before the sign: 18 <= age
            found = _FIELD_AFTER.match(text, m.end(), stop)
            name = _field(found.group(1)) if found else ""
            value, unit, sign = _number(left.group(1)), left.group(2), _FLIPPED[sign]
            begin = m.start() - (len(before[-80:]) - left.start())
            end = found.end() if found else m.end()
            free = m.end()
        last = name or last
        out.append({
            "field": last or None, "comparator": sign, "value": value,
            "unit": " ".join(unit.lower().split()) if unit else None, "raw": text[begin:end].strip(),
        })
    return out


_HASHES = re.compile(r"(#{1,6})[ \t]+(\S.*)")
#: Level of a heading that is a line ending with a colon: below those marked by number signs.
COLON_LEVEL = 7


@_rows_of(start="int", path="string")
def section_outline(text: str | None) -> list[dict]:
    """Where the sections of a text start, each with the titles that lead to it, joined by `` / ``.

    A heading is a line of one to six number signs and a title, or a line of at most eight words that ends
    with a colon. It ends the sections of its own level and deeper ones. One pass with a stack of headings.
    """
    if text is None:
        return []
    stack: list[tuple[int, str]] = []
    out = []
    for m in _LINE.finditer(text):
        line = m.group()
        marked = _HASHES.match(line)
        if marked:
            level, title = len(marked.group(1)), marked.group(2).strip()
        elif (plain := line.strip()).endswith(":") and 0 < len(_NAME.findall(plain)) <= HEADER_WORDS:
            level, title = COLON_LEVEL, plain[:-1].strip()
        else:
            continue
        while stack and stack[-1][0] >= level:
            stack.pop()
        stack.append((level, title))
        out.append({"start": m.start(), "path": " / ".join(t for _, t in stack)})
    return out
