"""Personal data by patterns, checksums and context (operator 8), in Spark functions only.

Regular expressions propose spans, validators confirm them (Luhn for cards, mod 97 for IBANs, ranges
and digit counts for the rest) and words near a span adjust its score.

The patterns run in linear time on any text.  A pattern such as ``[0-9]([ -]?[0-9])+`` backtracks, and
Java's matcher recurses once for each repetition of a group, so long inputs end in a stack overflow.
Instead each text is first marked, character for character: a space or hyphen that does not join two
digits, or a dot that does not join two labels, becomes a character no pattern holds.  A match is then
one run of a character class, at the same place as in the text.

``split`` by a pattern gives the texts between its matches, so running sums of the lengths of gaps and
matches give the places of all matches (code points).  The sums are made in groups of groups, and the words near
a span are taken from pieces of the text of a fixed length, so neither copies or counts from the start for every
match: a text with many matches takes time in proportion to its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Base kinds in the order in which equal starts are listed; added kinds follow.
KINDS = ("email", "ip", "card", "phone", "iban")
BASE = KINDS[:4]

_LOCAL, _LABEL = r"A-Za-z0-9._%+-", r"A-Za-z0-9-"
_GROUP, _PIECE = 64, 64  # matches summed one by one; code points of a piece of text
_OFF, _DOT = "\u0001", "\u0002"  # marks: not part of anything; a dot between two labels
#: Proposals, on the marked text.
EMAIL = rf"(?:(?<![{_DOT}{_LOCAL}])|\G)[{_DOT}{_LOCAL}]++@[{_LABEL}]++{_DOT}[{_DOT}{_LABEL}]++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9][0-9 -]{11,}"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
_IP_VALID = r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})){3}$"

#: Score of a confirmed span without context, and the words that raise or lower it (fixed values).
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9}
RAISE = {
    "email": r"\b(?:e-?mail|contact|write|reach|courriel|correo)\b",
    "ip": r"\b(?:ip|address|server|host|adresse)\b",
    "card": r"\b(?:card|credit|visa|mastercard|amex|payment|carte|tarjeta|karte)\b",
    "phone": r"\b(?:phone|call|tel|mobile|fax|whatsapp|telefon|t[eé]l[eé]fono?)\b",
    "iban": r"\b(?:iban|account|bank|bic|swift|konto|cuenta|compte)\b",
}
LOWER = r"\b(?:example|sample|test|dummy|version|release|isbn|order|sku|invoice)\b"


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the digits' Luhn sum is a multiple of ten."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether the number that an IBAN stands for leaves 1 when divided by 97."""
    s = F.regexp_replace(iban, " ", "")
    value = lambda c: F.ascii(c) - F.when(c.between("0", "9"), 48).otherwise(55)
    step = lambda a, c: (a * F.when(c.between("0", "9"), 10).otherwise(100) + value(c)) % 97
    return F.aggregate(F.split(F.concat(F.substring(s, 5, 64), F.substring(s, 1, 4)), ""), F.lit(0), step) == 1


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def _grouped(items: Column) -> Column:
    """An array as an array of arrays of up to ``_GROUP`` items."""
    n = F.ceil(F.size(items) / _GROUP).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.slice(items, k * _GROUP + 1, _GROUP))).otherwise(F.slice(F.array(items), 1, 0))


def _starts(sizes: Column) -> Column:
    """The sum of the sizes before each, one after the other; for few items, as each step copies what is there."""
    step = lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out"))
    return F.aggregate(sizes, F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("out")), step, lambda acc: acc["out"])


def _starts_of_many(sizes: Column) -> Column:
    """The sum of the sizes before each, by groups."""
    total = lambda g: F.aggregate(g, F.lit(0), lambda a, x: a + x)
    shifted = lambda g, at: _let(_starts(g), lambda own: F.transform(own, lambda x: x + at))
    return _let(_grouped(sizes), lambda g: F.flatten(F.zip_with(g, _starts(F.transform(g, total)), shifted)))


def _places(marked: Column, pattern: str) -> Column:
    """array<struct<start, end, found>> of all matches of ``pattern`` in the marked text; ``found`` is as in the text itself."""
    gaps = F.transform(F.split(marked, pattern, -1), lambda x: F.char_length(x))
    found = F.transform(F.regexp_extract_all(marked, F.lit(pattern), F.lit(0)), lambda x: F.translate(x, _DOT, "."))

    def placed(pair: Column) -> Column:
        size = lambda x: x["gaps"] + F.char_length(x["found"])

        def group(members: Column, at: Column) -> Column:
            one = lambda x, before: F.struct((at + before + x["gaps"]).alias("start"), (at + before + size(x)).alias("end"), x["found"].alias("found"))
            return F.zip_with(members, _starts(F.transform(members, size)), one)

        total = lambda g: F.aggregate(g, F.lit(0), lambda a, x: a + size(x))
        return _let(_grouped(pair), lambda g: F.flatten(F.zip_with(g, _starts_of_many(F.transform(g, total)), group)))

    return _let(found, lambda f: _let(F.arrays_zip(F.slice(gaps, F.lit(1), F.size(f)).alias("gaps"), f.alias("found")), placed))


def _between(pieces: Column, start: Column, end: Column) -> Column:
    """The text from ``start`` to ``end``, at most ``_PIECE`` apart, of a text cut into ``pieces``."""
    first = F.floor(start / _PIECE).cast("int")
    two = F.concat(F.coalesce(F.get(pieces, first), F.lit("")), F.coalesce(F.get(pieces, first + 1), F.lit("")))
    return F.substring(two, start - first * _PIECE + 1, end - start)


def pii_spans(docs: DataFrame, text: str = "text", into: str = "pii", context: int = 40) -> DataFrame:
    """``docs`` with ``into``: array<struct<start, rank, end, kind, score>> of the confirmed spans, sorted by
    start, then kind; places count code points, the end is exclusive.

    Per kind, matches are leftmost and do not overlap; a match that fails its validator is dropped and not
    tried again.  Null and empty texts have no spans.  All rows and all other columns are kept; ``into``
    replaces a column of that name.
    """
    raw = F.coalesce(F.col(text), F.lit(""))
    tmp = {k: f"__{into}_{k}" for k in ("text", "email", "digits", *KINDS)}
    t = F.col(tmp["text"])
    clean = F.translate(raw, _OFF + _DOT, _OFF + _OFF)
    out = docs.withColumn(tmp["text"], raw)
    email = F.when(F.contains(t, F.lit("@")), F.regexp_replace(clean, rf"(?<=[{_LABEL}])\.(?=[{_LABEL}])", _DOT)).otherwise("")
    digits = F.when(t.rlike(r"[0-9][0-9 -]{10}[0-9 -]*[0-9]"), F.regexp_replace(clean, r"(?<![0-9])[ -]|[ -](?![0-9])", _OFF)).otherwise("")
    out = out.withColumns({tmp["email"]: email, tmp["digits"]: digits})
    of = {"email": (tmp["email"], EMAIL), "ip": (tmp["text"], IP), "card": (tmp["digits"], CARD), "phone": (tmp["text"], PHONE), "iban": (tmp["text"], IBAN)}
    quick = {"ip": t.rlike(r"[0-9]\.[0-9]++\.[0-9]"), "phone": F.contains(t, F.lit("+")), "iban": t.rlike(r"[A-Z]{2}[0-9]{2}[A-Z0-9 ]{8}")}
    valid = {
        "email": lambda m: F.lit(True),
        "ip": lambda m: m.rlike(_IP_VALID),
        "card": lambda m: F.length(_digits(m)).between(12, 19) & luhn(_digits(m)),
        "phone": lambda m: F.length(_digits(m)).between(9, 15),
        "iban": lambda m: F.length(F.regexp_replace(m, " ", "")).between(15, 34) & mod97(m),
    }
    none = F.expr("cast(array() as array<struct<start:int,end:int,found:string>>)")
    proposed = {}
    for kind, (col, pattern) in of.items():
        places = _places(F.col(col), pattern)
        proposed[tmp[kind]] = F.when(quick[kind], places).otherwise(none) if kind in quick else F.when(F.col(col) != "", places).otherwise(none)
    out = out.withColumns(proposed)

    def scored(kind: str, pieces: Column) -> Column:
        def one(m: Column) -> Column:
            before = _between(pieces, F.greatest(F.lit(0), m["start"] - context), m["start"])
            near = F.lower(F.concat(before, F.lit(" "), _between(pieces, m["end"], m["end"] + context)))
            score = F.lit(PRIOR[kind]) + F.when(near.rlike(RAISE[kind]), 0.1).otherwise(0.0) - F.when(near.rlike(LOWER), 0.3).otherwise(0.0)
            return F.struct(m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), m["end"].alias("end"),
                            F.lit(kind).alias("kind"), F.least(F.lit(1.0), score).alias("score"))
        return F.transform(F.filter(F.col(tmp[kind]), lambda m: valid[kind](m["found"])), one)

    if context > _PIECE:
        raise ValueError(f"context is at most {_PIECE}")
    cut = F.when(sum((F.size(tmp[k]) for k in KINDS), F.lit(0)) > 0, F.regexp_extract_all(t, F.lit(f"(?s).{{1,{_PIECE}}}"), F.lit(0))).otherwise(F.expr("cast(array() as array<string>)"))
    spans = _let(cut, lambda pieces: F.array_sort(F.concat(*[scored(k, pieces) for k in KINDS])))
    return out.withColumn(into, spans).drop(*tmp.values())


def listed(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
