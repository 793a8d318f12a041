"""Personal data as spans, by SQL functions only.

Per kind, a regular expression proposes spans, a validator (number of digits, Luhn, mod 97,
ranges, entropy) confirms them, and words nearby raise the score. The base kinds are found whenever
their validator agrees; further kinds must reach a score.

The expressions are written so that matching stays linear in the text: runs are possessive
where what follows cannot start inside them, and a look-behind (or the end of the previous
match) keeps a run from being tried again at each of its characters.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of context on either side of a span.
NEAR = 40
#: Least score of the further kinds.
LEAST_SCORE = 0.6
#: Bits a character of a secret has at least, by how often each of its characters occurs in it.
LEAST_ENTROPY = 3.0
#: Positions are summed in blocks of so many spans.
_BLOCK = 128

#: Characters of an account number after its country and check digits, by country.
ACCOUNT_LENGTHS = {
    11: "NO",
    12: "BE",
    14: "DK FI FK FO GL NL SD",
    15: "MK SI",
    16: "AT BA EE KZ LT LU MN XK",
    17: "CH CR HR LI LV",
    18: "BG BH DE GB GE IE ME RS",
    19: "AE GI IL IQ OM SO TL",
    20: "AD CZ ES MD PK RO SA SE SK TN VG",
    21: "LY PT ST",
    22: "IS TR",
    23: "BI DJ FR GR IT MC MR SM",
    24: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    25: "BR EG PS QA UA",
    26: "JO KW MU YE",
    27: "MT SC",
    29: "RU",
    28: "LC",
}
_ACCOUNT = "|".join(f"(?:{'|'.join(c.split())})[0-9]{{2}}(?: ?[A-Z0-9]){{{n}}}" for n, c in ACCOUNT_LENGTHS.items())

_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"


@dataclass(frozen=True)
class Kind:
    """A kind of personal data; ``start`` is the score of a proposed span before its validator."""

    name: str
    pattern: str
    valid: Callable[[Column], Column]
    start: float
    confirmed: float
    context: str
    base: bool = False
    #: Text that every match has; spares the expression where it is missing.
    needs: str = ""


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _between(value: Column, low: int, high: int) -> Column:
    return (value >= low) & (value <= high)


def _luhn(match: Column) -> Column:
    return F.when(_between(F.length(_digits(match)), 13, 19), F.call_function("luhn_check", _digits(match))).otherwise(F.lit(False))


def _mod_97(match: Column) -> Column:
    """An account number's check: letters as 10 to 35, the first four characters last, remainder 1."""
    compact = F.regexp_replace(match, " ", "")
    turned = F.concat(F.substring(compact, 5, 64), F.substring(compact, 1, 4))

    def step(rest: Column, char: Column) -> Column:
        code = F.ascii(char)
        return F.when(code <= 57, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), lambda r, c: F.when(c == "", r).otherwise(step(r, c))) == 1


def _issued(match: Column) -> Column:
    """Area, group and serial numbers that are never issued do not count."""
    return ~match.rlike("^(?:000|666|9)|-00-|-0000$")


def _random(match: Column) -> Column:
    """Letters and digits, with the entropy of a key rather than of a word or a number."""
    n = F.length(match).cast("double")

    def bits(c: Column) -> Column:
        share = (n - F.length(F.replace(match, c, F.lit("")))) / n
        return -share * F.log2(share)

    chars = F.filter(F.array_distinct(F.split(match, "")), lambda c: c != "")
    entropy = F.aggregate(F.transform(chars, bits), F.lit(0.0), lambda a, x: a + x)
    return match.rlike("[0-9]") & match.rlike("[A-Za-z]") & (entropy >= LEAST_ENTROPY)


# The base expressions, ranges and order of kinds.
KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda m: F.lit(True),
        0.8,
        0.0,
        r"mail|contact|write|kontakt|correo|courriel",
        base=True,
        needs="@",
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        lambda m: m.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"),
        0.5,
        0.1,
        r"\bip\b|address|server|host|login|adresse|direcci",
        base=True,
        needs=".",
    ),
    Kind(
        "card",
        r"[0-9](?:[ -]?+[0-9])++",
        _luhn,
        0.2,
        0.6,
        r"card|visa|master|credit|debit|karte|carte|tarjeta",
        base=True,
    ),
    Kind(
        "phone",
        r"\+[0-9][ ().0-9-]+[0-9]",
        lambda m: _between(F.length(_digits(m)), 9, 15),
        0.5,
        0.2,
        r"phone|call|tel|mobile|fax|whatsapp|llam|appel",
        base=True,
        needs="+",
    ),
    Kind(
        "iban",
        # by the country's length; else (a country that is not listed) up to where capitals and digits end
        rf"(?<![A-Za-z0-9])(?:{_ACCOUNT}|[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]){{11,30}})(?![A-Za-z0-9])",
        _mod_97,
        0.2,
        0.6,
        r"iban|account|bank|konto|compte|cuenta",
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        _issued,
        0.2,
        0.2,
        r"ssn|social|security|insurance|versicherung|s[ée]cu|seguro",
        needs="-",
    ),
    Kind(
        "secret",
        r"(?<![A-Za-z0-9_/+-])[A-Za-z0-9_/+-]{20,}+={0,2}",
        _random,
        0.2,
        0.2,
        r"token|secret|password|passwd|api.?key|access.?key|private.?key|bearer|authorization|credential|passwort|contrase",
    ),
)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


_SPAN = "array<struct<start:bigint,end:bigint,score:double>>"


def _spans(text: Column, kind: Kind) -> Column:
    """Confirmed spans of one kind, ascending, in characters."""
    none = F.expr(f"cast(array() as {_SPAN})")

    def located(found: Column) -> Column:
        """What lies between the matches, and so where each is."""
        return _let(F.split(text, kind.pattern, -1), lambda between: placed(found, between))

    def placed(found: Column, between: Column) -> Column:
        lengths = F.transform(found, lambda m, i: (F.length(m) + F.length(F.get(between, i))).cast("long"))
        return _let(lengths, lambda n: _let(_block_sums(n), lambda sums: listed(found, between, n, sums)))

    def listed(found: Column, between: Column, n: Column, sums: Column) -> Column:
        def one(m: Column, i: Column) -> Column:
            begin = _sum_before(n, sums, i) + F.length(F.get(between, i))
            near = F.concat_ws(" ", F.right(F.get(between, i), F.lit(NEAR)), F.left(F.get(between, i + 1), F.lit(NEAR)))
            bonus = F.when(F.lower(near).rlike(kind.context), 0.2).otherwise(0.0)
            score = F.lit(kind.start + kind.confirmed) + bonus
            return F.struct(
                begin.alias("start"), (begin + F.length(m)).alias("end"), score.alias("score"), kind.valid(m).alias("ok")
            )

        enough = (lambda s: s["ok"]) if kind.base else (lambda s: s["ok"] & (s["score"] >= LEAST_SCORE))
        return F.transform(F.filter(F.transform(found, one), enough), lambda s: F.struct(s["start"], s["end"], s["score"]))

    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    spans = _let(found, lambda m: F.when(F.size(m) > 0, located(m).cast(_SPAN)).otherwise(none))
    return F.when(F.contains(text, F.lit(kind.needs)), spans).otherwise(none) if kind.needs else spans


def _block_sums(lengths: Column) -> Column:
    last = F.floor((F.size(lengths) - 1) / _BLOCK).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda b: _sum(F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK))))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def _sum_before(lengths: Column, sums: Column, i: Column) -> Column:
    block = F.floor(i / _BLOCK).cast("int")
    return _sum(F.slice(sums, F.lit(1), block)) + _sum(F.slice(lengths, block * _BLOCK + 1, i % _BLOCK))


def find_personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` and ``pii``: per kind (a struct field each) an array of (start, end, score).

    Positions count characters from 0, ends are exclusive; spans of a kind do not overlap and
    ascend. Null and empty texts have none. Rows are judged by themselves, so that repeated
    rows get equal spans; a column ``pii`` of ``docs`` is replaced.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    found = F.struct(*(_spans(body, kind).alias(kind.name) for kind in KINDS))
    return docs.withColumn("pii", found)


def joined(kinds: tuple[Kind, ...]) -> Column:
    """Spans of column ``pii`` as text: kind:start:end by kind and start, joined by commas."""

    def of(kind: Kind) -> Column:
        return F.transform(F.col(f"pii.{kind.name}"), lambda s: F.concat_ws(":", F.lit(kind.name), s["start"], s["end"]))

    return F.array_join(F.concat(*(of(kind) for kind in kinds)), ",")


def mask_personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in brackets.

    Overlapping spans are covered in order of their starts. Null texts stay null, texts without
    personal data stay as they are.
    """

    def tagged(kind: Kind) -> Column:
        return F.transform(
            F.col(f"pii.{kind.name}"), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(kind.name).alias("kind"))
        )

    def upto(spans: Column, count: Column) -> Column:
        """Where the first ``count`` spans end at the latest."""
        return F.aggregate(F.slice(spans, F.lit(1), count), F.lit(0).cast("long"), lambda a, s: F.greatest(a, s["end"]))

    def covered(spans: Column) -> Column:
        def part(s: Column, i: Column) -> Column:
            return _let(
                upto(spans, i),
                lambda done: F.concat(
                    F.substring(body, done + 1, F.greatest(F.lit(0), s["start"] - done)),
                    F.when(s["end"] > done, F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise(""),
                ),
            )

        rest = F.substring(body, upto(spans, F.size(spans)) + 1, F.length(body))
        return F.concat(F.array_join(F.transform(spans, part), ""), rest)

    body = F.col(text)
    names = docs.columns
    spans = F.array_sort(F.concat(*(tagged(kind) for kind in KINDS)))
    masked = _let(spans, lambda s: F.when(F.size(s) > 0, covered(s)).otherwise(body))
    return find_personal_data(docs, text).withColumn(text, masked).select(*names)
