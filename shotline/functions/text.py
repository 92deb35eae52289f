"""Text functions on columns; all but the similarity ratio run in the JVM."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _fold_tables(stroke: bool) -> tuple[str, str]:
    """Accented letters and their bases by canonical decomposition; combining marks have no counterpart and go."""
    pairs = []
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        base = "".join(c for c in unicodedata.normalize("NFD", chr(code)) if not unicodedata.combining(c))
        if base != chr(code) and len(base) == 1:
            pairs.append((chr(code), base))
    if stroke:
        pairs += [("Đ", "D"), ("đ", "d")]
    return "".join(a for a, _ in pairs) + "".join(map(chr, range(0x300, 0x370))), "".join(b for _, b in pairs)


_FOLD = {stroke: _fold_tables(stroke) for stroke in (False, True)}


def strip_diacritics(c: Column, stroke: bool = True) -> Column:
    """Letters without their marks; ``stroke`` folds the crossed d as well.  Plain ASCII is passed through."""
    return F.when(c.rlike(r"[^\x00-\x7F]"), F.translate(c, *_FOLD[stroke])).otherwise(c)


def unaccented(c: Column) -> Column:
    """Lower-cased and without marks; the crossed d stays."""
    return strip_diacritics(F.lower(c), stroke=False)


def norm(c: Column) -> Column:
    """Only the digits and base letters, lower-cased: what two spellings of a line have in common."""
    return F.regexp_replace(F.lower(strip_diacritics(c)), "[^0-9a-z]+", "")


def collapse(c: Column) -> Column:
    """White space as single spaces, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def letter_count(c: Column) -> Column:
    return F.length(F.regexp_replace(c, r"(?U)\s", ""))


def is_allcaps(c: Column) -> Column:
    """Some letter, and no letter that isn't upper case."""
    return c.rlike(r"\p{L}") & ~c.rlike(r"[\p{Ll}\p{Lo}\p{Lt}\p{Lm}]")


# Fixed value: a word that is a number, a time, a date or a share.
DIGIT_TOKEN = "^[0-9][0-9:.,/%+-]*$"


def words(c: Column) -> Column:
    """Words between white space; none in an empty text."""
    return F.filter(F.split(collapse(c), " "), lambda w: w != "")


def merge_digit_words(a: Column, b: Column) -> Column:
    """``a`` with the words of ``b`` wherever those are numbers, if both have as many words."""
    x, y = words(a), words(b)
    merged = F.array_join(F.zip_with(x, y, lambda w, p: F.when(p.rlike(DIGIT_TOKEN), p).otherwise(w)), " ")
    return F.when(F.size(x) == F.size(y), merged).otherwise(a)


def prefer_short_line(a: Column, b: Column) -> Column:
    """``b`` where both have the same one or two words, ``a`` is all capitals and they differ; else null."""
    n = F.size(words(a))
    return F.when(n.between(1, 2) & (n == F.size(words(b))) & is_allcaps(a) & (a != b), b)


def arbitrate(text: Column, prob: Column, other: Column, other_prob: Column, least: float, ascii_only: bool = False) -> Column:
    """One line from two recognisers: ``struct(text, confidence)``, null if neither is good enough.

    Texts are trimmed; the other recogniser's line stands in where the first is unsure;
    ``ascii_only`` takes the marks off; confidences have four digits.
    """
    flat = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)^\s+|\s+$", "")
    sure = prob >= least
    a, b = flat(text), flat(other)
    line = F.when(sure, F.coalesce(prefer_short_line(a, b), merge_digit_words(a, b))).otherwise(b)
    p = F.when(sure, prob).otherwise(other_prob)
    return F.when((line != "") & (p >= least), F.struct((strip_diacritics(line) if ascii_only else line).alias("text"), F.bround(p, 4).alias("confidence")))


# Fixed value: a numbered line, "3|text", "3. text" or "3) text", with or without bars or blanks at its end.
NUMBERED = r"^\s*(\d+)\s*[|.)]\s*(.*?)[|\s]*$"


def numbered_lines(c: Column, tag: str = "") -> Column:
    """``map<int,string>`` of a numbered list: lines without a number or a text are passed over, the last of a number wins,
    an echoed tag goes.  A number too large for an int is -1.  Takes time n log n for n lines."""
    body = lambda x: F.regexp_extract(x, NUMBERED, 2)
    clean = (lambda x: F.when(body(x).startswith(tag), F.substring(body(x), len(tag) + 1, 1 << 30)).otherwise(body(x))) if tag else body
    lines = F.filter(F.split(c, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"), lambda x: x.rlike(NUMBERED) & (body(x) != ""))
    pairs = F.transform(lines, lambda x, i: F.struct(F.coalesce(F.regexp_extract(x, NUMBERED, 1).try_cast("int"), F.lit(-1)).alias("k"), i.alias("i"), clean(x).alias("v")))
    # Bound as a lambda's variable, the sorted array is made once; equal numbers stand together, the last one last.
    last = F.transform(F.array(F.array_sort(pairs)), lambda s: F.filter(s, lambda p, i: F.coalesce(F.get(s, i + 1)["k"] != p["k"], F.lit(True))))
    return F.map_from_entries(F.transform(F.get(last, 0), lambda p: F.struct(p["k"], p["v"])))


def numbers_complete(m: Column, n: Column) -> Column:
    """Whether the numbers are 1 to n, each once."""
    return F.array_sort(F.map_keys(m)) == F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))


def growth_guard(raw: Column, new: Column, truncated: Column, factor: float = 1.15, slack: int = 3) -> Column:
    """A cut-off line may not grow by much: beyond the limit the raw line stays."""
    return F.when(truncated & (letter_count(new) > letter_count(raw) * factor + slack), raw).otherwise(new)


def outcome(unmatched: Column, reverted: Column) -> Column:
    """``ok``, with the numbers of lines without a match and of cut-off lines that were put back, where there are any."""
    part = lambda n, what: F.when(n > 0, F.concat(n.cast("string"), F.lit(what)))
    return F.concat_ws("_", F.lit("ok"), part(unmatched, "unmatched"), part(reverted, "trunc"))


def numbered_prompt(lines: Column, truncated: Column, tag: str) -> Column:
    """Lines as ``1|text``, those cut off marked with the tag."""
    return F.array_join(F.transform(F.arrays_zip(lines.alias("t"), truncated.alias("c")), lambda x, i: F.concat((i + 1).cast("string"), F.lit("|"), F.when(x["c"], F.lit(tag)).otherwise(F.lit("")), x["t"])), "\n")


def valid_identifier(c: Column) -> Column:
    return F.coalesce((F.trim(c) != "") & ~c.isin(".", "..") & ~c.rlike(r"[/\\]"), F.lit(False))


def natural_key(c: Column) -> Column:
    """Sorts digit runs as numbers, before letters, and letters without case."""
    runs = F.regexp_extract_all(F.lower(c), F.lit(r"(\d+|\D+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda t: F.when(t.rlike(r"^\d+$"), F.concat(F.lit("0"), F.lpad(t, 20, "0"))).otherwise(F.concat(F.lit("1"), t))), "\x01")


def distinct_trimmed(c: Column) -> Column:
    """Non-blank strings, trimmed, the first of equal ones, in order."""
    return F.array_distinct(F.filter(F.transform(c, lambda x: F.trim(x)), lambda x: x != ""))


# Letters whose base is no canonical one, and what they are folded to.
_LETTERS = {"ø": "o", "ł": "l", "ħ": "h", "ŧ": "t", "ð": "d", "ı": "i", "ŋ": "n", "ß": "ss", "æ": "ae", "œ": "oe", "þ": "th"}


def ascii_folded(c: Column) -> Column:
    """Lower-cased Latin letters as plain ones: without marks, and ligatures and special letters spelled out."""
    low = strip_diacritics(F.lower(c))
    single = {a: b for a, b in _LETTERS.items() if len(b) == 1}
    out = F.translate(low, "".join(single), "".join(single.values()))
    for a, b in _LETTERS.items():
        if len(b) > 1:
            out = F.replace(out, F.lit(a), F.lit(b))
    return F.when(low.rlike(r"[^\x00-\x7F]"), out).otherwise(low)


def tokens(c: Column) -> Column:
    """The analyzer of both index and query: runs of letters and digits in ``ascii_folded`` form."""
    return F.regexp_extract_all(ascii_folded(c), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def stem(path: Column) -> Column:
    """File name without its last suffix."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def frame_id(path: Column) -> Column:
    """A frame's id from its path: the stem, led by the folder's name unless it already starts with it."""
    parts = F.split(path, "/")
    parent = F.coalesce(F.get(parts, F.size(parts) - 2), F.lit(""))
    return F.when(stem(path).startswith(parent), stem(path)).otherwise(F.concat_ws("_", parent, stem(path)))
