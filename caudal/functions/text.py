"""String helpers: name normalisation (CLN1), mojibake repair, number formatting."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bound(c: Column, fn) -> Column:
    """``fn(c)`` with ``c`` computed once, however often ``fn`` uses it. The part inside is interpreted, not compiled: it is
    for rare cases whose code would make the whole stage too large."""
    return F.element_at(F.transform(F.array(c), fn), 1)


#: White space as Python's ``str.strip`` knows it.
WHITE_SPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def strip(c: Column | str) -> Column:
    """Text without white space of any kind (tab, CR, no-break and other Unicode spaces) at its ends."""
    return F.btrim(_c(c), F.lit(WHITE_SPACE))


@lru_cache(maxsize=1)
def decompositions() -> tuple[str, str, dict[str, str]]:
    """Canonical decompositions without their combining marks, from the Unicode data, Hangul aside.

    Characters that become one character, those characters, and a map of the few that become several or none.
    """
    from_one, to_one, to_more = [], [], {}
    for code in range(0xC0, 0x110000):
        c = chr(code)
        if 0xAC00 <= code <= 0xD7A3 or not unicodedata.decomposition(c):
            continue
        whole = unicodedata.normalize("NFD", c)
        bare = "".join(x for x in whole if unicodedata.category(x) != "Mn")
        if whole == c or bare == c:
            continue
        if len(bare) == 1:
            from_one.append(c)
            to_one.append(bare)
        elif bare:
            to_more[c] = bare
    return "".join(from_one), "".join(to_one), to_more


def _hangul(ch: Column) -> Column:
    """Jamo of a Hangul syllable by the arithmetic of its code point: leading consonant, vowel, and a final one or none."""
    def letters(first, n):
        return F.array(*[F.lit(chr(first + i)) for i in range(n)])

    s = F.ascii(ch) - 0xAC00
    finals = F.concat(F.array(F.lit("")), letters(0x11A8, 27))
    return F.concat(F.element_at(letters(0x1100, 19), F.floor(s / 588).cast("int") + 1),
                    F.element_at(letters(0x1161, 21), F.floor(s % 588 / 28).cast("int") + 1),
                    F.element_at(finals, (s % 28).cast("int") + 1))


def unaccented(c: Column | str) -> Column:
    """Canonical decomposition (NFD) without combining marks (category Mn), over all of Unicode.

    Spark has no NFD: characters that decompose into one and marks are folded with ``translate``; Hangul syllables and
    the few that decompose into several go character by character; marks that stand alone are dropped. ASCII text
    takes none of these steps.
    """
    before, after, more = decompositions()
    table = F.create_map(*[F.lit(x) for kv in more.items() for x in kv])
    several = "[\\x{AC00}-\\x{D7A3}" + "".join(more) + "]"

    def one(ch):
        return F.when(ch.between("\uac00", "\ud7a3"), _hangul(ch)).otherwise(F.coalesce(F.element_at(table, ch), ch))

    def split(x):
        return F.when(x.rlike(several), F.array_join(F.transform(F.split(x, ""), one), "")).otherwise(x)

    col = _c(c)
    bare = bound(F.translate(col, before, after), lambda x: F.regexp_replace(split(x), r"\p{Mn}", ""))
    return F.when(col.rlike(r"[^\x00-\x7F]"), bare).otherwise(col)


def normalize_name(c: Column | str) -> Column:
    """CLN1: lower case, stripped of white space, combining marks removed ("Río Negro\\r" -> "rio negro")."""
    return unaccented(strip(F.lower(_c(c))))


def repair_double_encoding(c: Column | str) -> Column:
    """Undo UTF-8 text that was decoded as Latin-1 once ("NotificaciÃ³n" -> "Notificación").

    Applied only where the tell-tale ``Ã`` occurs, the text fits Latin-1 and its bytes are UTF-8;
    any other text stays as it is ("SÃO PAULO", "NotificaciÃ³n – x").
    """
    col = _c(c)
    fits = col.contains("Ã") & col.rlike("^[\\x{0}-\\x{FF}]*$")
    fixed = F.try_validate_utf8(F.encode(F.when(fits, col), "ISO-8859-1").cast("string"))
    return F.coalesce(fixed, col)


def format_magnitude(c: Column | str) -> Column:
    """0 -> "0"; |v| >= 100 -> 1 decimal; >= 1 -> 2; >= 0.01 -> 4; else 6; null -> null."""
    v = _c(c).cast("double")
    a = F.abs(v)
    decimals = F.when(a >= 100, 1).when(a >= 1, 2).when(a >= 0.01, 4).otherwise(6)
    return F.when(v == 0, F.lit("0")).otherwise(fixed(v, decimals))


def fixed(c: Column | str, decimals: int | Column) -> Column:
    """Fixed-point text of a double, correctly rounded from its exact binary value
    (ties to even), i.e. what Python's ``f"{v:.{d}f}"`` prints.

    Java's ``%.nf`` and Spark's ``round`` round the shortest decimal form half-up,
    which differs on values such as 0.01075 (binary 0.010749999...). Here the
    product v * 10^d is computed exactly as hi + lo (Dekker's two-product, plain
    double arithmetic), so a tie in ``hi`` is resolved by the sign of ``lo``.
    Valid while |v| * 10^d < 2^52 and d <= 15.
    """
    d = F.lit(int(decimals)) if isinstance(decimals, int) else decimals
    v = _c(c).cast("double")
    split = F.lit(134217729.0)  # 2^27 + 1

    # Lambda variables bind each intermediate once; the expression stays small
    # enough for code generation wherever it is used.
    def products(x):
        s = F.pow(F.lit(10.0), x["d"].cast("double"))
        p = x["v"] * s
        t = x["v"] * split
        vh = t - (t - x["v"])
        vl = x["v"] - vh
        ts = s * split
        sh = ts - (ts - s)
        sl = s - sh
        err = ((vh * sh - p) + vh * sl + vl * sh) + vl * sl
        return F.struct(p.alias("p"), err.alias("err"), x["d"].alias("d"))

    def rounded(x):
        fl = F.floor(x["p"])
        frac = x["p"] - fl
        half = frac == F.lit(0.5)
        up = (frac > 0.5) | (half & (x["err"] > 0)) | (half & (x["err"] == 0) & (F.pmod(fl, F.lit(2)) == 1))
        return F.struct((fl + F.when(up, 1).otherwise(0)).cast("long").alias("n"), x["d"].alias("d"))

    def text(x):
        scale = F.pow(F.lit(10), x["d"]).cast("long")
        a = F.abs(x["n"])
        sign = F.when(x["n"] < 0, F.lit("-")).otherwise(F.lit(""))
        body = F.when(x["d"] == 0, a.cast("string")).otherwise(F.concat(
            (a / scale).cast("long").cast("string"), F.lit("."), F.lpad((a % scale).cast("string"), x["d"], "0")))
        return F.concat(sign, body)

    staged = F.transform(F.transform(F.transform(
        F.array(F.struct(v.alias("v"), d.cast("int").alias("d"))), products), rounded), text)
    return F.when(v.isNull() | F.isnan(v), F.lit(None).cast("string")).otherwise(F.element_at(staged, 1))
