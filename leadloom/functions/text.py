"""Text normalization as Column -> Column expressions (all JVM-side)."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterable, Sequence
from functools import lru_cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadloom.rules import LEGAL_SUFFIXES, TWO_PART_SUFFIXES

# White space of Unicode-aware regular expressions plus the four ASCII separators.
SPACE = r"[\s\x1c-\x1f\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"

_HANGUL_FIRST, _HANGUL_LAST = 0xAC00, 0xD7A3
_LEADS = "".join(map(chr, range(0x1100, 0x1113)))
_VOWELS = "".join(map(chr, range(0x1161, 0x1176)))
_TAILS = "".join(map(chr, range(0x11A8, 0x11C3)))


def _char_class(points: Iterable[int]) -> str:
    """Regex character class over code points, runs folded to ranges."""
    runs: list[list[int]] = []
    for p in sorted(points):
        if runs and p == runs[-1][1] + 1:
            runs[-1][1] = p
        else:
            runs.append([p, p])
    return "[" + "".join(rf"\x{{{a:X}}}" if a == b else rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in runs) + "]"


@lru_cache(maxsize=1)
def _fold_tables() -> tuple[str, str, str, dict[str, str], str]:
    """Derive the folding tables from the Unicode data: characters that fold to one character, the
    class of combining marks, and the characters that fold to several."""
    one_src, one_dst, marks, many = [], [], [], {}
    for point in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= point <= 0xDFFF or _HANGUL_FIRST <= point <= _HANGUL_LAST:
            continue
        ch = chr(point)
        if unicodedata.combining(ch):
            marks.append(point)
            continue
        if not unicodedata.decomposition(ch):
            continue
        folded = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))
        if len(folded) == 1 and folded != ch:
            one_src.append(ch)
            one_dst.append(folded)
        elif folded != ch:
            many[ch] = folded
    many_class = _char_class([*map(ord, many), *range(_HANGUL_FIRST, _HANGUL_LAST + 1)])
    return "".join(one_src), "".join(one_dst), _char_class(marks), many, many_class


def bound(value: Column, build) -> Column:
    """``build(value)`` with the value computed once, as a lambda variable."""
    return F.transform(F.array(value), build)[0]


def fold_accents(text: Column) -> Column:
    """Compatibility-decompose and drop combining marks.

    ASCII texts pass straight through. Of the others, most are ASCII once single characters are
    translated; the mark class and the lookup of characters that fold to several only run on what is left. The look-ahead
    keeps the long classes away from ASCII characters."""
    src, dst, marks, many, many_class = _fold_tables()
    beyond = r"[^\x00-\x7F]"
    # one literal that constant folding turns into a map, not one plan node per entry
    table = F.str_to_map(F.lit("\n".join(f"{k}\t{v}" for k, v in many.items())), F.lit("\n"), F.lit("\t"))

    def expand(c: Column) -> Column:
        syllable = F.ascii(c) - _HANGUL_FIRST
        pick = lambda letters, i: F.substring(F.lit(letters), i, F.lit(1))
        tail = syllable % 28
        jamo = F.concat(
            pick(_LEADS, F.floor(syllable / 588).cast("int") + 1),
            pick(_VOWELS, F.floor((syllable % 588) / 28).cast("int") + 1),
            F.when(tail > 0, pick(_TAILS, tail)).otherwise(""),
        )
        hangul = c.between(chr(_HANGUL_FIRST), chr(_HANGUL_LAST))
        return F.when(hangul, jamo).otherwise(F.coalesce(F.try_element_at(table, c), c))

    def by_character(t: Column) -> Column:
        # the few different characters that fold to several, each replaced in the whole text at once
        met = F.array_distinct(F.regexp_extract_all(t, F.lit(f"((?={beyond}){many_class})"), F.lit(1)))
        folded = F.aggregate(met, t, lambda done, c: F.replace(done, c, expand(c)))
        return F.when(t.rlike(f"(?={beyond}){many_class}"), folded).otherwise(t)

    def by_class(t: Column) -> Column:
        return F.when(t.rlike(beyond), bound(F.regexp_replace(t, f"(?={beyond}){marks}", ""), by_character)).otherwise(t)

    return F.when(text.rlike(beyond), bound(F.translate(text, src, dst), by_class)).otherwise(text)


def squeeze(text: Column) -> Column:
    """Collapse runs of white space to one blank and trim."""
    return F.trim(F.regexp_replace(text, SPACE + "+", " "))


def strip_space(text: Column) -> Column:
    """Trim white space of any kind; most texts have none and skip the regular expression."""
    edge = F.substring(text, 1, 1), F.substring(text, -1, 1)
    clean = edge[0].between("!", "~") & edge[1].between("!", "~")
    return F.when(clean, text).otherwise(F.regexp_replace(text, rf"^{SPACE}+|{SPACE}+$", ""))


def _alternatives(words: Iterable[str]) -> str:
    escape = lambda w: "".join("\\" + ch if not ch.isalnum() and ch != " " else ch for ch in w)
    return "|".join(escape(w) for w in sorted(words, key=len, reverse=True))


def company_norm(name: Column, suffixes: Iterable[str] = LEGAL_SUFFIXES) -> Column:
    """Matching form of a company name. One anchored repetition removes stacked legal suffixes; it
    needs a blank before each, so a name that is itself a suffix survives."""
    text = F.regexp_replace(F.lower(fold_accents(name)), r"\([^)]*\)", " ")
    text = squeeze(F.translate(text, ",.", " "))
    return F.coalesce(F.trim(F.regexp_replace(text, f"(?: (?:{_alternatives(suffixes)}))+$", "")), F.lit(""))


def person_norm(name: Column) -> Column:
    return F.coalesce(squeeze(F.lower(fold_accents(name))), F.lit(""))


# scheme, authority and path of a reference, in the split of RFC 3986
_URL = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://([^/?#]*))?([^?#]*)"


def profile_url(url: Column, site: str = "linkedin.com") -> Column:
    """Canonical profile address: one host for all locale hosts, no query, no trailing slash, no
    locale segment, https."""
    def canonical(full: Column) -> Column:
        host = F.lower(F.regexp_extract(full, _URL, 1))
        host = bound(host, lambda h: F.when(h.endswith(site), F.lit(f"www.{site}")).otherwise(h))
        path = F.lower(F.regexp_replace(F.regexp_extract(full, _URL, 2), "/+$", ""))
        return F.concat(F.lit("https://"), host, F.regexp_replace(path, "^/[a-z]{2}(?=/in/)", ""))

    bare = F.translate(strip_space(url), "\t\r\n", "")
    full = bound(bare, lambda u: F.when(u.contains("://"), u).otherwise(F.concat(F.lit("https://"), u)))
    return F.when(url != "", bound(full, canonical)).otherwise(F.lit(""))


def site_label(address: Column, two_part: Iterable[str] = TWO_PART_SUFFIXES) -> Column:
    """Registrable label of a URL or domain (``www.acme.co.uk/jobs`` -> ``acme``)."""
    known = rf"\.(?:{_alternatives(two_part)})$"
    labels = lambda c: F.split(c, r"\.")

    def host_of(text: Column) -> Column:
        netloc = F.regexp_extract(text, _URL, 1)
        inner = F.when(netloc != "", netloc).otherwise(F.regexp_extract(text, _URL, 2))
        body = F.when(text.contains("://"), inner).otherwise(text)
        return F.regexp_replace(F.substring_index(body, "/", 1), r"^www\.", "")

    def label(host: Column) -> Column:
        return (
            F.when(host.rlike(known), F.element_at(labels(F.regexp_replace(host, known, "")), -1))
            .when(host.contains("."), F.element_at(labels(host), -2)).otherwise(host)
        )

    host = bound(F.lower(strip_space(address)), host_of)
    return F.when(address != "", bound(host, label)).otherwise(F.lit(""))


def _holds(text: Column, word: str, whole_words: bool) -> Column:
    if whole_words:
        return text.rlike(rf"(?<!\w){_alternatives([word])}(?!\w)")
    return text.contains(word)


def hits(text: Column, words: Iterable[str], whole_words: bool = False) -> Column:
    """The words contained in the text, in list order (substring semantics by default). Unrolled so
    that it stays inside generated code."""
    return F.array_compact(F.array(*[F.when(_holds(text, w, whole_words), F.lit(w)) for w in words]))


def has_any(text: Column, words: Iterable[str], whole_words: bool = False) -> Column:
    return reduce(lambda a, b: a | b, [_holds(text, w, whole_words) for w in words])


def fact_text(industry: Column, description: Column, specialties: Column) -> Column:
    """Lowered text that keyword rules look at: the non-empty parts, one blank between."""
    some = lambda c: F.nullif(c, F.lit(""))
    return F.lower(F.concat_ws(" ", some(industry), some(description), some(F.array_join(specialties, " "))))


def csv_list(value: Column) -> Column:
    """Comma list to trimmed non-empty items; null when nothing is left."""
    items = F.filter(F.transform(F.split(value, ","), strip_space), lambda x: x != "")
    return bound(items, lambda i: F.when(F.size(i) > 0, i))


def first_of(values: Column) -> Column:
    return F.try_element_at(values, F.lit(1))


def filled(value: Column) -> Column:
    """Empty string counts as missing."""
    return F.nullif(value, F.lit(""))


def filled_in(parts: Sequence[str], *values: Column) -> Column:
    """The fixed parts of a text with the values between them."""
    pieces = [F.lit(parts[0])]
    for value, part in zip(values, parts[1:]):
        pieces += [value, F.lit(part)]
    return F.concat(*pieces)
