r"""Personal data (DataFrame functions only): regular expressions propose
spans, checksum validators confirm them, context words on either side adjust a score.

Positions come from one fold over the text cut at the matches: a match starts
after all earlier pieces and matches. The patterns are written so that Java's
matcher is linear and does not recurse: a run of characters is entered at its
start only (or where the previous match ended, \G), and runs are possessive.
They find the same leftmost matches as the plain patterns in ``KINDS``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcube.llm.names import by_place, named

NEAR = 48           # characters on either side of a match that are searched for context words
PIECES = 8          # matches of one kind that can stand in so many characters
ACCEPT = 0.6        # an added kind is reported from this score on


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str        # Java, linear
    needs: str          # a cheap pattern that any text with a match has
    valid: str          # SQL over the match x.m
    score: float
    helps: str          # context words that raise the score by 0.3
    hurts: str          # context words that lower it by 0.3
    base: bool = True   # base kinds are reported at any score


_DIGITS = "regexp_replace(x.m, '[^0-9]', '')"
_LUHN = (f"(length({_DIGITS}) between 16 and 19 and aggregate(sequence(1, 19), 0, (a, i) -> a + "
         f"case when i > length({_DIGITS}) then 0 else "
         f"cast(substring(reverse({_DIGITS}), i, 1) as int) * if(i % 2 = 0, 2, 1) "
         f"- if(i % 2 = 0 and cast(substring(reverse({_DIGITS}), i, 1) as int) > 4, 9, 0) end) % 10 = 0)")
_IBAN = "regexp_replace(x.m, ' ', '')"
_MOD97 = (f"aggregate(sequence(1, length({_IBAN})), 0, (a, i) -> case "
          f"when substring(concat(substring({_IBAN}, 5), substring({_IBAN}, 1, 4)), i, 1) rlike '[0-9]' "
          f"then (a * 10 + ascii(substring(concat(substring({_IBAN}, 5), substring({_IBAN}, 1, 4)), i, 1)) - 48) % 97 "
          f"else (a * 100 + ascii(substring(concat(substring({_IBAN}, 5), substring({_IBAN}, 1, 4)), i, 1)) - 55) % 97 end) = 1")
# characters of an IBAN by country; the match ends there and leaves a following word alone
_LENGTHS = {15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
            22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
            26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
            30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}


def _iban() -> str:
    """Any country: groups of four and a rest; a known country's length is tried first."""
    known = [rf"(?:{c.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{{(n - 4) // 4}}}"
             + (rf"\x20?[A-Z0-9]{{{n % 4}}}" if n % 4 else "") + "(?![A-Za-z0-9])" for n, c in _LENGTHS.items()]
    other = r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
    return r"(?<![A-Za-z0-9])(?=[A-Z]{2}[0-9]{2})(?:" + "|".join([*known, other]) + ")"


KINDS = (
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", "true",
         0.9, "mail|contact|write|address", "example"),
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+), parts at most 255
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]",
         "forall(split(x.m, '[.]', -1), p -> p rlike '^0*+(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])?$')",
         0.6, "ip|host|server|address", "version|release|section"),
    # [0-9]([\x20-]?[0-9])+, 16 to 19 digits, Luhn
    Kind("card", r"[0-9](?:[\x20-]?+[0-9])++", r"[0-9][\x20-]?[0-9]", _LUHN, 0.8, "card|visa|credit|payment", "order|tracking|serial"),
    # \+[0-9][\x20().0-9-]+[0-9], 8 to 15 digits
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", f"length({_DIGITS}) between 8 and 15",
         0.6, "phone|call|tel|mobile|fax", "order|invoice"),
    Kind("iban", _iban(), "[A-Z]{2}[0-9]{2}",
         _MOD97, 0.8, "iban|account|bank|transfer", "serial|part", base=False),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "[0-9]{3}-[0-9]{2}-[0-9]{4}",
         "not x.m rlike '^(?:000|666|9)|-00-|-0000$'", 0.4, "ssn|social|security", "part|order", base=False),
)
BASE = tuple(k.name for k in KINDS if k.base)
_SPAN = "struct<ord:int,kind:string,start:int,end:int,score:double,match:string>"


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spans_of(order: int, kind: Kind, text: str) -> Column:
    # what stands before: the end of all text so far; behind: the pieces and matches that follow
    near = f"concat(right(concat(a.tail, right(x.p, {NEAR})), {NEAR}), '\\n', x.n)"
    score = f"{kind.score} + if({near} rlike {_sql(rf'(?i)\b(?:{kind.helps})')}, 0.3, 0.0) - if({near} rlike {_sql(rf'(?i)\b(?:{kind.hurts})')}, 0.3, 0.0)"
    score = f"cast(least(1.0, greatest(0.0, {score})) as double)"
    span = f"named_struct('ord', {order}, 'kind', '{kind.name}', 'start', a.at + length(x.p), 'end', a.at + length(x.p) + length(x.m), 'score', {score}, 'match', x.m)"
    keep = f"({kind.valid})" if kind.base else f"({kind.valid}) and {score} >= {ACCEPT}"
    pattern = _sql(kind.pattern)
    behind = (f"left(aggregate(sequence(1, {PIECES}), '', (z, k) -> if(length(z) >= {NEAR}, z, "
              f"concat(z, left(coalesce(get(s.p, i + k), ''), {NEAR}), coalesce(get(s.m, i + k), '')))), {NEAR})")
    # pieces are one more than matches: the last entry has no match
    cut = f"transform(s.p, (p, i) -> named_struct('p', p, 'm', get(s.m, i), 'n', if(get(s.m, i) is null, '', {behind})))"
    fold = (f"aggregate({cut}, named_struct('at', 0, 'tail', '', 'spans', cast(array() as array<{_SPAN}>)), "
            f"(a, x) -> named_struct('at', a.at + length(x.p) + coalesce(length(x.m), 0), "
            f"'tail', right(concat(a.tail, right(x.p, {NEAR}), coalesce(x.m, '')), {NEAR}), 'spans', "
            f"if(x.m is not null and {keep}, concat(a.spans, array({span})), a.spans)), a -> a.spans)")
    both = f"array(named_struct('p', split({text}, {pattern}, -1), 'm', regexp_extract_all({text}, {pattern}, 0)))"
    return F.expr(f"if({text} rlike {_sql(kind.needs)}, get(transform({both}, s -> {fold}), 0), cast(array() as array<{_SPAN}>))")


def with_spans(docs: DataFrame, text_col: str = "text", out: str = "pii") -> DataFrame:
    """``docs`` and ``out``: an array of (ord, kind, start, end, score, match),
    by kind in the order of ``KINDS``, then start; start and end count code
    points, end exclusive. NULL and empty texts have no spans; whole texts are
    searched; kinds may overlap. A column named ``out`` is replaced."""
    found = [_spans_of(i, k, f"`{text_col}`") for i, k in enumerate(KINDS)]
    return docs.withColumn(out, F.coalesce(F.concat(*found), F.expr(f"cast(array() as array<{_SPAN}>)")))


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with each span replaced by its kind in brackets. Overlapping
    spans are hidden together under the first one's kind. NULL and empty texts stay
    as they are; other columns may have any name."""
    docs, at = by_place(docs)
    text = at[text_col]
    hidden = (f"aggregate(array_sort(transform(__pii, s -> named_struct('start', s.start, 'end', -s.end, 'kind', s.kind))), "
              f"named_struct('at', 0, 'out', cast(array() as array<string>)), "
              f"(a, s) -> if(s.start >= a.at, named_struct('at', -s.end, 'out', concat(a.out, array(substring({text}, a.at + 1, s.start - a.at), "
              f"concat('[', upper(s.kind), ']')))), named_struct('at', greatest(a.at, -s.end), 'out', a.out)), "
              f"a -> concat(array_join(a.out, ''), substring({text}, a.at + 1)))")
    return with_spans(docs, text, "__pii") \
        .withColumn(text, F.expr(f"if(size(__pii) = 0, {text}, {hidden})")).select(*named(at))
