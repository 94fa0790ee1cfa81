"""Text as Column expressions: comparison forms, folding, calendar escapes, display helpers."""

from __future__ import annotations

import html
import html.entities
import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What counts as no value.
MISSING = ["", "tbd", "t.b.d.", "tba", "to be announced", "to be determined", "n/a"]
#: Signs that compare alike, position by position; zero-width ones vanish.
LIKE_FROM, LIKE_TO, ZERO_WIDTH = "\u2013\u2014\u2018\u2019\u201c\u201d", "--''\"\"", "\u200b\u200c\u200d\ufeff"
ROOM = r"[A-Za-z]{0,2}\d{1,4}[A-Za-z]?"
#: Words that show that a text names an institution, as patterns of whole words in any case.
INSTITUTIONS = [
    "universit(y|e|at|ät|à|é)", "univ\\.?", "college", "institut(e|o|)", "school", "academy",
    "laborator(y|ies)", "lab", "centre", "center", "hospital", "foundation",
    "observatory", "museum", "academ(y|ia)", "polytechnic",
    "MIT", "NASA", "CERN", "NIH", "NIST", "INRIA", "EPFL", "ETH", "CNRS", "Quantinuum",
]
INSTITUTION = r"(?iU)\b(" + "|".join(INSTITUTIONS) + r")\b"
#: Marks and words of sentences, which no name holds; shapes of a name's first token and of further ones
#: (a class year, a particle).
SENTENCE = r"(?iU)[?!:;]|\.\s|\b(and|the|for|of|in|to|on|with|from)\b"
NAME, FURTHER = r"[A-Z][\w.'\u2019-]*", r"\*\d{2}|[a-z]{2,4}"
_APART = "\x1f"


def let(c: Column, f) -> Column:
    """f(c), with c computed once: a long expression that is used several times would be written out each time."""
    return F.element_at(F.transform(F.array(c), f), 1)


def decimals(c: Column, places: int = 1) -> Column:
    """A finite double below 10**15 with so many decimals (3 at most), of its exact binary value, ties to even. The engine's
    own format rounds the shortest decimal text and ties up: 45.15, which lies below it, would be 45.2."""
    scale = 10**places

    def said(x: Column) -> Column:
        # 26 bits of the part after the point are scaled without rounding; what is left only decides between two texts
        part = x - F.floor(x)
        high = F.floor(part * 2**26) / 2**26
        digits = F.floor(high * scale)
        n, over = F.floor(x) * scale + digits, (high * scale - digits - 0.5) + (part - high) * scale
        n = n + F.when((over > 0) | ((over == 0) & (n % 2 == 1)), 1).otherwise(0)
        whole = F.floor(n / scale).cast("string")
        return F.concat(whole, F.lit("."), F.lpad((n % scale).cast("string"), places, "0")) if places else whole

    return F.concat(F.when(c < 0, F.lit("-")).otherwise(F.lit("")), let(F.abs(c.cast("double")), said))


def collapse(c: Column) -> Column:
    """Single spaces for all white space, none at the ends. What is a single space already isn't matched, so a text that
    needs nothing is only read."""
    return F.trim(F.regexp_replace(c, r"(?U)\s{2,}|[\s&&[^ ]]", " "))


@lru_cache
def _folded() -> dict[str, str]:
    """Lower-case characters that case folding changes further."""
    each = (chr(i) for i in range(0x110000))
    return {c: c.casefold() for c in each if c == c.lower() != c.casefold()}


def casefold(c: Column) -> Column:
    """Case folding of short texts, by expressions of the engine, so within lambdas too."""
    table = _folded()
    found = F.map_from_arrays(F.split(F.lit(_APART.join(table)), _APART), F.split(F.lit(_APART.join(table.values())), _APART))
    low = F.lower(c)
    each = F.transform(F.split(low, ""), lambda x: F.coalesce(F.try_element_at(found, x), x))
    return F.when(low.rlike("[" + "".join(table) + "]"), F.array_join(each, "")).otherwise(low)


def composed(c: Column) -> Column:
    """Canonical composition (marks in canonical order, syllables of Hangul), by the library that the engine brings for
    its collations. c: not null."""
    return F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), c, F.lit(False))


def folded(c: Column) -> Column:
    """Full case folding of whole texts. c: not null."""
    return F.reflect(F.lit("com.ibm.icu.lang.UCharacter"), F.lit("foldCase"), c, F.lit(True))


def compare_form(c: Column) -> Column:
    """The form in which texts are equal: composed letters, one dash, one quote, no zero-width signs, single spaces, case
    folded. Within the engine; texts beyond ASCII are composed and folded as wholes, whatever their letters."""
    other = collapse(F.translate(folded(composed(c)), LIKE_FROM + ZERO_WIDTH, LIKE_TO))
    return F.when(c.isNull(), c).when(c.rlike(r"^[\x00-\x7F]*$"), F.lower(collapse(c))).otherwise(other)


_ALIKE = str.maketrans(LIKE_FROM, LIKE_TO, ZERO_WIDTH)
#: What (?U)\\s matches.
_SPACES = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def compare_text(value: str) -> str:
    """compare_form() of a declared value, before any plan is built."""
    return _SPACES.sub(" ", unicodedata.normalize("NFC", value).casefold().translate(_ALIKE)).strip(" ")


@F.pandas_udf(T.StringType())
def _unescaped(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


def decode_entities(c: Column) -> Column:
    """Character references of markup decoded once; no-break spaces become spaces. Only texts with an ampersand leave the
    engine."""
    got = F.when(c.contains("&"), F.coalesce(_unescaped(F.when(c.contains("&"), c)), c)).otherwise(c)
    return F.translate(got, "\u00a0", " ")


def decode_named(c: Column, *references: str) -> Column:
    """The named references decoded once, others left as they are; 'amp;?' is also read without its semicolon. Within the
    engine."""
    for r in sorted(references, key=lambda r: r.startswith("amp")):  # last, so that nothing is decoded twice
        c = F.regexp_replace(c, f"&{r}", html.entities.html5[r.rstrip("?")])
    return c


def fold(c: Column) -> Column:
    """ASCII letters and digits in lower case, all else a space."""
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))


def is_missing(c: Column) -> Column:
    return c.isNull() | F.lower(F.trim(c)).isin(MISSING)


def escape(c: Column) -> Column:
    """Backslash before commas and semicolons that have none."""
    return F.regexp_replace(c, r"(?<!\\)([,;])", r"\\$1")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"\\([,;])", "$1")


#: Stands for an escaped backslash while the other escapes are read.
HELD = "\x01"


def ics_unescape(c: Column) -> Column:
    """Calendar text: escaped line breaks, commas, semicolons and backslashes, read from the left; others stay."""
    held = F.replace(c, F.lit("\\\\"), F.lit(HELD))
    plain = F.regexp_replace(F.regexp_replace(held, r"\\[nN]", "\n"), r"\\([,;])", "$1")
    return F.replace(plain, F.lit(HELD), F.lit("\\"))


def ics_escape(c: Column) -> Column:
    return F.replace(F.regexp_replace(F.regexp_replace(c, r"([\\,;])", r"\\$1"), "\r?\n", "\\\\n"), F.lit("\r"), F.lit(""))


def ics_list(c: Column) -> Column:
    """Items between commas that aren't escaped, unescaped, without blanks."""
    held = F.replace(c, F.lit("\\\\"), F.lit(HELD))
    items = F.transform(F.split(held, r"(?<!\\),"), lambda x: F.trim(ics_unescape(F.replace(x, F.lit(HELD), F.lit("\\\\")))))
    return F.filter(items, lambda x: x != "")


def tag_key(c: Column) -> Column:
    return F.lower(F.regexp_replace(collapse(c), r"(?i) (spring|summer|fall|autumn|winter) \d{4}$", ""))


def series_spacing(c: Column) -> Column:
    return F.regexp_replace(c, r",(?=\S)", ", ")


def first_paragraph(c: Column, cap: int = 420) -> Column:
    """Text before the first blank line; nothing if it begins with a label; beyond the cap, cut after the last full stop
    before a space that lies past half of it, else with an ellipsis."""
    p = F.trim(F.element_at(F.split(c, r"\n{2,}"), 1))
    head = F.substring(p, 1, cap)
    stop = cap - F.instr(F.reverse(head), " .") - 1  # places before the last full stop
    cut = F.when((F.instr(F.reverse(head), " .") > 0) & (stop > cap / 2), F.substr(head, F.lit(1), stop + 1)).otherwise(F.concat(F.rtrim(head), F.lit("…")))
    return F.when(p.rlike(r"^[A-Z][A-Za-z ]{0,24}:"), F.lit("")).when(F.length(p) <= cap, p).otherwise(cut)


def speaker_display(speakers: Column) -> Column:
    """Names with affiliations of array<struct<name, affiliation>>, joined by '; '."""
    one = lambda s: F.when(s["affiliation"] != "", F.concat_ws(", ", s["name"], s["affiliation"])).otherwise(s["name"])
    return F.array_join(F.transform(F.filter(speakers, lambda s: s["name"] != ""), one), "; ")


def single_affiliation(speakers: Column) -> Column:
    found = F.array_distinct(F.filter(F.transform(speakers, lambda s: s["affiliation"]), lambda a: a != ""))
    return F.when(F.size(found) == 1, F.element_at(found, 1)).otherwise(F.lit(""))


def split_speaker(c: Column) -> Column:
    """Name and affiliation at the last comma, if what follows looks like an institution."""
    v = collapse(c)
    head, tail = (F.trim(F.regexp_extract(v, r"^(.*),([^,]*)$", i)) for i in (1, 2))
    ok = (head != "") & tail.rlike(INSTITUTION)
    return F.struct(F.when(ok, head).otherwise(v).alias("name"), F.when(ok, tail).otherwise(F.lit("")).alias("affiliation"))


def excerpt(c: Column, cap: int) -> Column:
    return F.when(F.length(c) > cap, F.concat(F.substring(c, 1, cap - 1), F.lit("…"))).otherwise(c)


def cell(c: Column, cap: int = 140) -> Column:
    """Text for a cell of a table: one line, bars escaped, at most `cap` characters."""
    return excerpt(F.replace(collapse(c), F.lit("|"), F.lit("\\|")), cap)


def label(word: str, n: Column) -> Column:
    """'Speaker:' for one, 'Speakers:' for more."""
    return F.when(n > 1, F.lit(f"{word}s:")).otherwise(F.lit(f"{word}:"))


def sentence(c: Column) -> Column:
    """A text with the full stop that it may lack."""
    return F.when(c.endswith("."), c).otherwise(F.concat(c, F.lit(".")))


def first_sentence(c: Column) -> Column:
    return F.trim(F.regexp_extract(collapse(c), r"^(.*?(?:[.!?](?=\s|$)|$))", 1))


def person_name_shape(c: Column, not_a_person: list[str]) -> Column:
    """Two to four tokens of a name's shape: none of a sentence's marks and words, no word that no name holds."""
    v = collapse(c)
    t = F.split(v, " ")
    bare = lambda x: casefold(F.regexp_replace(x, r"(?U)[^\w]", ""))
    shape = v.rlike(rf"(?U)^{NAME}(?: (?:{NAME}|{FURTHER}))*$")
    return F.size(t).between(2, 4) & ~v.rlike(SENTENCE) & shape & ~F.exists(t, lambda x: bare(x).isin(list(not_a_person) or [""]))
