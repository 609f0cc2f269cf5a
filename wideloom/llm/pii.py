"""Personal data: patterns propose spans, checksums confirm them, context words move the score
(operator 1).

Matching is leftmost and non-overlapping for each kind. The positions of the matches (code points,
end exclusive) are running lengths of the gaps and matches of one split, summed up in blocks and then
over blocks, and a span's surroundings are put together from the parts beside it, so all of it stays in
built-in functions and is linear in the text and its matches. Possessive quantifiers and look-behinds keep
a search linear too, whatever the text holds (a million digits, a million letters without a space).

The four base kinds are found without a score. The added kinds start from the score of their pattern;
a valid checksum and a context word within ``WINDOW`` characters before or after the span raise it,
whatever other matches lie between; spans that reach ``ACCEPT`` are kept. Before a local phone number
only, an earlier match ends the context unless nothing but a list (``GLUE``) follows it: "phone
212-555-0187, part no 212-555-0187x" names one phone.

Defined cases: null text counts as empty and has no span; repeated rows give repeated results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, text_or_empty

WINDOW = 40
ACCEPT = 0.6

# The base kinds, in the order of the digest.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A text without this cannot hold the kind.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}


@dataclass(frozen=True)
class Kind:
    """An added kind: its pattern's own score, its checksum and the words that speak for it."""

    name: str
    pattern: str
    score: float
    check: str | None
    words: str
    lists: bool = False              # the words before reach past earlier matches in lists only
    least: int = 1                   # characters of its shortest match


# Added kinds; a checksum is worth 0.4, a context word 0.3.
ADDED = (
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
         0.3, "mod97", "iban|account|konto|cuenta|compte", least=12),
    Kind("short_card", r"(?<![0-9.+-])[0-9](?:[\x20-]?[0-9]){12,14}(?![0-9.-])",
         0.0, "luhn", "card|visa|amex|karte|tarjeta|carte", least=13),
    Kind("national_id", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
         0.3, None, "ssn|social|security|passport|identity", least=11),
    Kind("local_phone", r"(?<![0-9+.(-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?![0-9.-])",
         0.3, None, "phone|call|tel|mobile|fax|telefon|handy", lists=True, least=12),
)
CHECKSUM, CONTEXT = 0.4, 0.3
BLOCK = 128                          # matches whose positions are summed up together
GLUE = r"(?:[^\p{L}\p{N}]|\b(?:or|and|o|y|und|oder|et|ou)\b)*+"


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Luhn check of the digits of ``value``."""
    d = F.split(F.reverse(digits(value)), "")
    total = F.aggregate(
        F.transform(F.filter(d, lambda c: c != ""), lambda c, i: F.when(
            i % 2 == 0, c.cast("int")).otherwise(
                F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2))),
        F.lit(0), lambda s, x: s + x)
    return total % 10 == 0


def mod97(value: Column) -> Column:
    """ISO 7064 mod-97-10 check: first four characters last, letters as 10 to 35, remainder 1."""
    flat = F.regexp_replace(F.upper(value), "[^0-9A-Z]", "")
    turned = F.regexp_replace(flat, "^(.{4})(.*)$", "$2$1")
    rest = F.aggregate(
        F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0),
        lambda s, c: F.when(c >= "A", (s * 100 + F.ascii(c) - 55) % 97).otherwise((s * 10 + F.ascii(c) - 48) % 97))
    return rest == 1


CHECKS = {"luhn": luhn, "mod97": mod97}


def with_matches(df: DataFrame, text: str, name: str, pattern: str, needs: str | None) -> DataFrame:
    """``df`` with ``name``: array<struct<start, end, value>> of all matches in column ``text`` (null without
    any), and ``{name}_parts``, the matches with the gaps before them; the last one is the rest of the text."""
    col, parts = F.col(text), F.col(f"{name}_parts")
    some = col.rlike(pattern) if needs is None else F.contains(col, F.lit(needs)) & col.rlike(pattern)
    cut = F.when(some, F.arrays_zip(F.split(col, pattern, -1).alias("gap"), F.regexp_extract_all(col, F.lit(pattern), F.lit(0)).alias("value")))
    span = "struct<start:int,end:int,value:string>"
    none = F.array().cast(f"array<{span}>")

    def step(acc, p):
        start = acc["pos"] + F.char_length(p["gap"])
        end = start + F.char_length(p["value"])
        found = F.struct(start.alias("start"), end.alias("end"), p["value"].alias("value"))
        return F.struct(end.alias("pos"), F.concat(acc["spans"], F.array(found)).alias("spans"))

    def block(k):
        size = F.least(F.lit(BLOCK), F.size(parts) - 1 - k * BLOCK)
        return F.aggregate(F.slice(parts, k * BLOCK + 1, size), F.struct(F.lit(0).alias("pos"), none.alias("spans")), step)

    def shift(acc, b):
        moved = F.transform(b["spans"], lambda x: F.struct((x["start"] + acc["pos"]).alias("start"), (x["end"] + acc["pos"]).alias("end"),
                                                           x["value"].alias("value")))
        return F.struct((acc["pos"] + b["pos"]).alias("pos"), F.concat(acc["spans"], F.array(moved)).alias("spans"))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(parts) - 2) / BLOCK).cast("int")), block)
    whole = F.aggregate(blocks, F.struct(F.lit(0).alias("pos"), F.array().cast(f"array<array<{span}>>").alias("spans")), shift)
    return df.withColumn(f"{name}_parts", cut).withColumn(name, F.when(parts.isNotNull(), F.flatten(whole["spans"])))


def with_surroundings(df: DataFrame, kind: Kind, window: int) -> DataFrame:
    """``df`` whose spans of ``kind`` have ``before`` and ``after``, the ``window`` characters beside them.
    So many parts as can hold that many characters are put together, never the text."""
    parts, near = F.col(f"{kind.name}_parts"), window // kind.least + 1

    def joined(some):
        return F.array_join(F.transform(some, lambda p: F.concat(p["gap"], F.coalesce(p["value"], F.lit("")))), "")

    def wider(x, i):
        first = F.greatest(i - near, F.lit(0))
        before = F.concat(joined(F.slice(parts, first + 1, i - first)), F.get(parts, i)["gap"])
        after = joined(F.slice(parts, i + 2, near + 1))
        return F.struct(x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value"),
                        F.right(before, F.lit(window)).alias("before"), F.left(after, F.lit(window)).alias("after"))
    return df.withColumn(kind.name, F.transform(kind.name, wider))


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: F.coalesce(p.try_cast("int"), F.lit(256)) <= 255)
    n = F.char_length(digits(value))
    if kind == "card":
        return n.between(16, 19) & luhn(value)
    return n.between(8, 15) if kind == "phone" else F.lit(True)


def _near(kind: Kind, span: Column) -> Column:
    """Whether a context word lies wholly within the characters kept before the span or after it."""
    word = rf"\b(?:{kind.words})\b"
    listed = rf"(?s){word}(?:(?!{kind.pattern}).)*+(?:(?:{kind.pattern}){GLUE})*+$" if kind.lists else word
    return lower_ascii(span["before"]).rlike(listed) | lower_ascii(span["after"]).rlike(word)


def _score(kind: Kind, span: Column) -> Column:
    score = F.lit(kind.score)
    if kind.check:
        score = score + F.when(CHECKS[kind.check](span["value"]), F.lit(CHECKSUM)).otherwise(F.lit(-1.0))
    return score + F.when(_near(kind, span), F.lit(CONTEXT)).otherwise(F.lit(0.0))


def find_pii(docs: DataFrame, id_col: Column, text_col: Column, added=ADDED,
             window: int = WINDOW, accept: float = ACCEPT) -> DataFrame:
    """doc_id, base and added: arrays of (kind, start, end, value, score) in the order of the kinds."""
    df = docs.select(id_col.alias("doc_id"), text_or_empty(text_col).alias("text"))
    for name, pattern in BASE.items():
        df = with_matches(df, "text", name, pattern, NEEDS.get(name))
    for kind in added:
        df = with_surroundings(with_matches(df, "text", kind.name, kind.pattern, None), kind, window)
    none = F.array().cast("array<struct<kind:string,start:int,end:int,value:string,score:double>>")

    def rated(name, score):
        return F.coalesce(F.transform(name, lambda s: F.struct(
            F.lit(name).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
            s["value"].alias("value"), score(s).alias("score"))), none)

    def valid(name):
        return F.filter(rated(name, lambda s: F.lit(1.0)), lambda s: _valid(name, s["value"]))

    def accepted(kind):
        return F.filter(rated(kind.name, lambda s: _score(kind, s)), lambda s: s["score"] >= accept)
    return df.select("doc_id", *[valid(k).alias(k) for k in BASE],
                     F.concat(none, *[accepted(k) for k in added]).alias("added"))


def digest(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
