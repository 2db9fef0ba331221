"""Personal data: regular expressions propose, checksums confirm, context
words adjust the score.

Every kind is one pattern; matches are leftmost and non-overlapping.  Spans
come from splitting the text by the pattern: a match starts where the pieces
and matches before it end, by running sums in blocks, so the work is linear in
the matches of a text.  Card numbers must pass Luhn, account numbers (IBAN)
their country's length and mod-97, addresses and phones their range rules,
secrets (values given to a token, key or password, and keys with a known
prefix) an entropy test; candidates that fail are dropped.  Words near a span
raise its score; kinds without a checksum (``ssn``) need them.

Patterns use possessive groups and look-behinds instead of nested greedy
loops, so runs of any length are scanned in linear time without recursion.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import col, let, running_sums

WINDOW = 40          # code points of context before and after a span
THRESHOLD = 0.5      # lowest score of a reported span
CONTEXT_BONUS = 0.3
NEAR = 14            # matches that reach into a context at most (two digits and a blank each)
MIN_ENTROPY = 3.0    # bits a character of a secret

# Lengths of account numbers (IBAN) and their countries.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_IBAN = "|".join(
    rf"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{{(n - 4) // 4}}}"
    + (rf"\x20?[A-Z0-9]{{{n % 4}}}" if n % 4 else "") for n, countries in IBAN_LENGTHS.items())

_MAIL = "A-Za-z0-9._%+-"

#: kind: (pattern, a cheap test that every text with a match passes, score, context words)
KINDS = {
    "email": (rf"(?:(?<![{_MAIL}])|\G)[{_MAIL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@",
              0.9, "mail|contact|write|reach"),
    "ip": (r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", 0.6,
           "ip|host|address|server|addr"),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", "[0-9]", 0.7, "card|visa|credit|master|amex|debit"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "+", 0.6, "phone|tel|call|mobile|fax|cell"),
    "iban": (rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{_IBAN})(?![A-Za-z0-9])", "[0-9]", 0.8,
             "iban|account|bank|transfer"),
    "ssn": (r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-", 0.3,
            "ssn|social|security"),
    "secret": (r"(?<![A-Za-z0-9+/_=-])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}"
               r"|xox[abprs]-[A-Za-z0-9-]{20,}+)(?![A-Za-z0-9+/_=-])"
               r"|(?<=(?i:token|secret|key|password|passwd|pwd)[\x22']?\x20{0,2}[:=]\x20{0,2}"
               r"[\x22']?)(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+",
               "token secret key passw pwd akia ghp_ gho_ ghu_ ghs_ ghr_ xox",
               0.7, "api|auth|bearer|secret|token|credential"),
}
BASE = ("email", "ip", "card", "phone")


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Luhn check of a string of digits."""
    places = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(
        i % 2 == 0, d.cast("int")).otherwise(
        2 * d.cast("int") - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(places, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(account: Column) -> Column:
    """Mod-97 check of an account number without blanks."""
    turned = F.concat(F.substring(account, 5, 64), F.substring(account, 1, 4))
    return F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: F.when(
        c.rlike("[0-9]"), (a * 10 + F.ascii(c) - 48) % 97).otherwise(
        (a * 100 + F.ascii(c) - 55) % 97)) == 1


def entropy(value: Column) -> Column:
    """Bits a character, from the frequencies of the value's characters."""
    chars = F.split(value, "")
    shares = F.transform(F.array_distinct(chars), lambda c: F.size(
        F.filter(chars, lambda x: x == c)) / F.size(chars))
    return F.aggregate(shares, F.lit(0.0), lambda a, q: a - q * F.log2(q))


def _valid(kind: str, value: Column) -> Column:
    digits = _digits(value)
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: _small(p) <= 255)
    if kind == "card":
        return F.length(digits).between(12, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    if kind == "iban":
        plain = F.replace(value, F.lit(" "), F.lit(""))
        return mod97(plain)
    if kind == "secret":
        return (value.rlike("[0-9]") & value.rlike("[A-Za-z]")
                & (entropy(value) >= MIN_ENTROPY))
    if kind == "ssn":
        return ~value.rlike("^(000|666|9)|-00-|-0000$")
    return F.lit(True)


def _small(part: Column) -> Column:
    """Number of up to three digits after leading zeros (else 999)."""
    short = F.ltrim(part, F.lit("0"))
    return F.when(F.length(short) > 3, F.lit(999)).otherwise(
        F.coalesce(F.when(short != "", short).cast("int"), F.lit(0)))


def _spans(matches: Column, pieces: Column) -> Column:
    """``array<struct<start,end,value,i>>`` of the matches of a text and the
    pieces between them."""
    before = F.slice(pieces, F.lit(1), F.size(matches))
    steps = F.zip_with(before, matches, lambda p, m: F.length(p) + F.length(m))
    return F.transform(
        F.arrays_zip(running_sums(steps).alias("at"), before.alias("p"), matches.alias("m")),
        lambda x, i: F.struct(
            (x["at"] + F.length(x["p"])).alias("start"),
            (x["at"] + F.length(x["p"]) + F.length(x["m"])).alias("end"),
            x["m"].alias("value"), i.alias("i")))


def _around(matches: Column, pieces: Column, i: Column) -> Column:
    """``WINDOW`` code points before and after match ``i``, a blank between:
    from the pieces and matches next to it, so no text is walked from its
    start for every match."""
    def head(x: Column) -> Column:
        return F.substring(x, 1, WINDOW)

    def tail(x: Column) -> Column:
        return F.right(x, F.lit(WINDOW))

    first = F.greatest(i - NEAR, F.lit(0))
    earlier = F.zip_with(F.slice(pieces, first + 1, i - first),
                         F.slice(matches, first + 1, i - first),
                         lambda p, m: F.concat(tail(p), tail(m)))
    later = F.zip_with(F.slice(matches, i + 2, F.lit(NEAR)), F.slice(pieces, i + 3, F.lit(NEAR)),
                       lambda m, p: F.concat(head(m), head(p)))
    return F.concat(
        tail(F.concat(F.array_join(earlier, ""), tail(F.get(pieces, i)))), F.lit(" "),
        head(F.concat(head(F.get(pieces, i + 1)), F.array_join(later, ""))))


def _hint(text: Column, kind: str) -> Column:
    """The cheap test: a regular expression in brackets, or strings one of
    which occurs, in any case."""
    hint = KINDS[kind][1]
    if hint.startswith("["):
        return text.rlike(hint)
    plain = F.lower(text) if len(hint) > 1 else text
    return reduce(lambda x, y: x | y, (F.contains(plain, F.lit(h)) for h in hint.split()))


def spans(text: Column, kind: str) -> Column:
    """Confirmed spans of one kind: ``array<struct<start,end,kind,value,
    score>>``."""
    pattern, _, score, context = KINDS[kind]

    def scored(matches: Column, pieces: Column) -> Column:
        confirmed = F.filter(_spans(matches, pieces), lambda s: _valid(kind, s["value"]))

        def one(s: Column) -> Column:
            near = F.lower(_around(matches, pieces, s["i"])).rlike(rf"\b(?:{context})")
            return F.struct(
                s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind"),
                s["value"].alias("value"),
                (F.lit(score) + F.when(near, F.lit(CONTEXT_BONUS)).otherwise(F.lit(0.0)))
                .alias("score"))

        return F.transform(confirmed, one)

    found = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda matches: let(
        F.split(text, pattern, -1), lambda pieces: scored(matches, pieces)))
    none = F.array().cast("array<struct<start:int,end:int,kind:string,value:string,score:double>>")
    return F.when(_hint(text, kind) & text.rlike(pattern), found).otherwise(none)


def find(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: ``key`` and ``found``, the spans of all
    kinds with a score of at least ``THRESHOLD``, by start, then kind in the
    order of ``KINDS``.  Positions are code points, ends exclusive.  NULL is
    an empty text; repeated rows stay; an empty table gives an empty
    result."""
    body = docs.select(col(key).alias(key), F.coalesce(col(text), F.lit("")).alias("body"))
    per_kind = body.select(col(key), *(spans(F.col("body"), k).alias(f"_{k}") for k in KINDS))

    def ranked(n: int):
        return lambda s: F.struct(
            s["start"].alias("start"), F.lit(n).alias("rank"), s["end"].alias("end"),
            s["kind"].alias("kind"), s["value"].alias("value"), s["score"].alias("score"))

    merged = F.concat(*(F.transform(F.col(f"_{k}"), ranked(n)) for n, k in enumerate(KINDS)))
    kept = F.filter(merged, lambda s: (s["rank"] < len(BASE)) | (s["score"] >= THRESHOLD))
    return per_kind.select(col(key), F.array_sort(kept).alias("found"))


def redact(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` rows as ``key, text`` with every span replaced by its kind in
    brackets; where spans overlap the first stands."""
    found = find(docs.select(F.struct(col(key), col(text)).alias("row"), col(text)), text, "row")
    body = F.coalesce(F.col("row")[text], F.lit(""))
    done = F.aggregate(
        "found", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.when(s["start"] < acc["at"], acc).otherwise(F.struct(
            s["end"].alias("at"),
            F.concat(acc["out"], F.substring(body, acc["at"] + 1, s["start"] - acc["at"]),
                     F.lit("["), s["kind"], F.lit("]")).alias("out"))),
        lambda acc: F.concat(acc["out"], F.substring(body, acc["at"] + 1, F.length(body))))
    clean = F.when(F.col("row")[text].isNotNull(), done)
    return found.select(F.col("row")[key].alias(key), clean.alias(text))


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts per base kind, ``base_sha256`` and ``spans`` of ``find``."""
    def text_of(s: Column) -> Column:
        return F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))

    def of(kind: str):
        return lambda s: s["kind"] == kind

    base = F.filter("found", lambda s: s["rank"] < len(BASE))
    counts = [F.size(F.filter("found", of(k))).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select(
        col(key), *counts,
        F.sha2(F.array_join(F.transform(base, text_of), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("found", text_of), ",").alias("spans"))
