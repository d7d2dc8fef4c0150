"""Text functions as Column builders: normal forms, sentences, words, keys."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable
from html import unescape

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from corpusloom.functions.rows import of_each

# Abbreviations whose full stop ends no sentence. (Forms with an inner stop can't match and aren't listed.)
ABBREVIATIONS = (
    "mr mrs ms dr rev prof capt col gen st ste jr sr no nos mme mlle mons herr fr hr dott sig sigg signor signora etc vs"
).split()
#: What a sentence may begin with, and the quotes that may follow its last sign.
OPENERS = "«„“\"A-ZÀ-ÖØ-ÞА-ЯЁΑ-ΩΆΈΉΊΌΎΏ"
CLOSERS = "»«”\"’"
BLANK = r"[\s\x{00a0}]"
NOT_WORD = r"[^\p{L}\p{N}_]+"
#: Letters and digits of a token, with an inner apostrophe.
TOKEN = r"[0-9A-Za-zÀ-ÖØ-öø-ÿĀ-žΑ-ωΆ-ώА-яЁё]+(?:['’][0-9A-Za-zÀ-ÖØ-öø-ÿĀ-žΑ-ωΆ-ώА-яЁё]+)?"


def _quick(signs: str) -> str:
    """A class of single signs and ranges for Java's expressions: those below 256 one by one, which are a table there, and others looked at only from 256 on."""
    found = re.findall(r"(.)-(.)|(.)", signs)
    codes = [range(ord(a or c), ord(b or c) + 1) for a, b, c in found]
    low = "".join(rf"\x{{{i:x}}}" for r in codes for i in r if i < 256)
    high = "".join(rf"\x{{{max(r[0], 256):x}}}-\x{{{r[-1]:x}}}" for r in codes if r[-1] >= 256)
    return rf"[[{low}][\x{{100}}-\x{{10ffff}}&&[{high}]]]"


#: TOKEN for Java's expressions, which tries each range of a class in turn.
_TOKEN = re.sub(r"\[([^\]'’]+)\]", lambda m: _quick(m[1]), TOKEN)

#: Classes of paragraphs by the kind of a unit.
PARAGRAPH_CLASSES = {"heading": "subhead", "continuation": "continued"}

MASK = rf"(^|[^\p{{L}}])((?i:{'|'.join(ABBREVIATIONS)})|\p{{Lu}})\."
#: MASK for Java's expressions: what no letters and a stop follow soon is passed at once, which changes no match.
_MASK = MASK.replace("((?i:", rf"(?=\p{{L}}{{1,{max(map(len, ABBREVIATIONS))}}}\.)((?i:", 1)
BOUNDARY = rf"([.!?…]+[{CLOSERS}]*){BLANK}+([{OPENERS}])"


def known(x: Column) -> Column:
    """Nothing is an empty text."""
    return F.coalesce(x, F.lit(""))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """What ``use`` makes of value, which is worked out once however often it is asked for; expressions with functions of arrays aren't shared else."""
    return F.element_at(F.transform(F.array(value), use), 1)


def fold(x: Column) -> Column:
    """Lower case in which sharp s is ss and a final sigma a sigma."""
    return F.replace(F.replace(F.lower(x), F.lit("ß"), F.lit("ss")), F.lit("ς"), F.lit("σ"))


def stripped(x: Column) -> Column:
    return F.regexp_replace(x, rf"^{BLANK}+|{BLANK}+$", "")


def normalized(x: Column) -> Column:
    """Folded words with one blank between them."""
    return F.trim(F.regexp_replace(fold(x), NOT_WORD, " "))


def squeezed(x: Column) -> Column:
    """Folded, without anything but words."""
    return F.regexp_replace(fold(x), NOT_WORD, "")


def sentences(x: Column) -> Column:
    """Sentences of a text. The stops of abbreviations are masked (twice, as matches share their borders) and put back."""
    masked = F.regexp_replace(F.regexp_replace(stripped(x), _MASK, "$1$2\u0002"), _MASK, "$1$2\u0002")
    parts = F.split(F.regexp_replace(masked, BOUNDARY, "$1\u0001$2"), "\u0001")
    return F.filter(F.transform(parts, lambda s: stripped(F.replace(s, F.lit("\u0002"), F.lit(".")))), lambda s: s != "")


def _folded(token: Column) -> Column:
    return F.replace(fold(token), F.lit("’"), F.lit("'"))


def tokens(x: Column) -> Column:
    """Folded tokens; a curly apostrophe is a straight one."""
    return F.transform(F.regexp_extract_all(x, F.lit(_TOKEN), F.lit(0)), _folded)


def tokens_among(x: Column, words: Iterable[str]) -> Column:
    """The folded tokens that are among these words, which hold neither sigmas nor apostrophes; no others are folded."""
    forms = {sign.join(w.split("ss")) for w in words for sign in ("ss", "ß")}
    return F.transform(F.filter(F.regexp_extract_all(x, F.lit(_TOKEN), F.lit(0)), lambda t: F.lower(t).isin(*sorted(forms))), _folded)


@F.arrow_udf(StringType())
def _composed(texts: pa.Array) -> pa.Array:
    return of_each(lambda t: None if t is None else unicodedata.normalize("NFKC", unescape(t)), pa.string(), texts)


def _without_marks(text: str) -> str:
    """text without combining signs; each different sign is looked up once."""
    for mark in [c for c in set(text) if unicodedata.combining(c)]:
        text = text.replace(mark, "")
    return text


@F.arrow_udf(StringType())
def _bare(texts: pa.Array) -> pa.Array:
    return of_each(lambda t: None if t is None else _without_marks(unicodedata.normalize("NFKD", t).casefold()), pa.string(), texts)


def composed(x: Column) -> Column:
    """Character references decoded, compatible forms as one (NFKC), quotes straight, white space as one blank; null is empty.

    Plain ASCII without references has nothing to decode, so Python sees the other texts only."""
    text = known(x)
    other = F.regexp_like(text, F.lit(r"[^\x00-\x7F]|&"))
    whole = F.coalesce(_composed(F.when(other, text)), text)
    quotes = (("’", "'"), ("‘", "'"), ("“", '"'), ("”", '"'))
    for curly, straight in quotes:
        whole = F.replace(whole, F.lit(curly), F.lit(straight))
    return F.trim(F.regexp_replace(whole, r"(?U)\s+", " "))


def bare(x: Column) -> Column:
    """Folded, and without the marks that letters carry (NFKD)."""
    other = F.regexp_like(x, F.lit(r"[^\x00-\x7F]"))
    return F.coalesce(_bare(F.when(other, x)), F.lower(x))


def words(x: Column) -> Column:
    """The tokens of the composed text."""
    return tokens(composed(x))


def n_words(x: Column) -> Column:
    """How many words there are, without folding them."""
    return F.regexp_count(composed(x), F.lit(_TOKEN))


def sha(x: Column) -> Column:
    return F.sha2(x, 256)


def padded(x: Column, width: int) -> Column:
    """Digits filled up with zeros; longer numbers stay whole."""
    text = x.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def unit_id(chapter: Column, ordinal: Column, width: int = 2) -> Column:
    return F.concat(F.lit("c"), padded(chapter, width), F.lit("-u"), padded(ordinal, 4))


def slug(x: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(fold(x), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def spaced(x: Column) -> Column:
    """A blank between the end of a sentence and a capital that follows it at once; runs of blanks and tabs are one."""
    return F.regexp_replace(F.regexp_replace(stripped(x), "([.!?…»”\"])([A-ZÀ-ÖØ-Þ])", "$1 $2"), "[ \\t]+", " ")


def escaped(x: Column) -> Column:
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        x = F.replace(x, F.lit(plain), F.lit(entity))
    return x


def paragraph_html(kind: Column, text: Column) -> Column:
    """A unit as an XHTML paragraph whose line ends are breaks; its class says if it is a heading or goes on from the one before."""
    body = F.replace(escaped(text), F.lit("\n"), F.lit("<br/>"))
    named = F.coalesce(*[F.when(kind == k, F.lit(f'<p class="{c}">')) for k, c in PARAGRAPH_CLASSES.items()], F.lit("<p>"))
    return F.concat(named, body, F.lit("</p>"))


def quoted(x: Column) -> Column:
    """Percent encoding for a path: blanks are %20, slashes stay."""
    return F.replace(F.replace(F.url_encode(x), F.lit("+"), F.lit("%20")), F.lit("%2F"), F.lit("/"))


def roman_value(x: Column) -> Column:
    """The value of a roman numeral, right to left: a sign below the largest one so far is taken off."""
    value = F.create_map(*[F.lit(v) for pair in {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500, "m": 1000}.items() for v in pair])
    signs = F.reverse(F.filter(F.split(F.lower(x), ""), lambda c: c != ""))
    start = F.struct(F.lit(0).alias("total"), F.lit(0).alias("most"))

    def add(state: Column, sign: Column) -> Column:
        v = F.element_at(value, sign)
        return F.struct((state["total"] + F.when(v < state["most"], -v).otherwise(v)).alias("total"), F.greatest(state["most"], v).alias("most"))

    return F.when(F.regexp_like(x, F.lit("^(?i)[ivxlcdm]+$")), F.aggregate(signs, start, add, lambda s: s["total"]))
