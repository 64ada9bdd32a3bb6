"""Format-preserving pseudonyms for personal data, in Spark SQL expressions alone.

Numbers and dates that pass the checks of their kind (Luhn for payment cards, mod 97 for IBANs, octets
for IPv4 addresses, area rules for social security numbers, a real day for dates, seven to fifteen digits
for phone numbers) are permuted by a keyed Feistel network within their own format; mail names are
permuted letter by letter and digit by digit. The permutation depends on the key and the kind alone, so
equal values stay equal in every document, and different ones stay different. What fails its checks is
left as it is. Everything around the matches is kept byte for byte.

The key comes from the session's setting ``spark.pagelattice.pii.key``. Without one, a random key is made for
the application: its pseudonyms are linked within all its jobs, but to no other run's, and nobody can undo them.

Each network is over Z_a x Z_b for its kind's two moduli (all cards of n digits, all IPv4 addresses, all
days of 400 Gregorian years ...), so its outcome is always valid and no value has to be tried again. The
round function is SHA-256 over key, kind, round and half.

Kinds: email, iban, date, ssn, phone, ipv4, card. Overlaps are settled by the regular expression: the
leftmost match wins, and at one place the first kind in this order. Numbers end where their kind's usual
grouping does (IBANs by their country's length, phones within 15 digits, cards by fours), so that a number that
stands behind them is read by itself; of a card's readings the longest that passes its checks counts.

No part of a shape repeats a group without a bound, so neither the stack nor the time grows with what a text
holds: texts are searched in linear time. Mail names are 64 characters at most, as the mail protocol has it.

Defined cases: a null text stays null, an empty one empty; repeated rows each return a row; all other
columns pass unchanged, whatever their names.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROUNDS = 8
KEY_SETTING = "spark.pagelattice.pii.key"
#: Longest name of a mail address (RFC 5321).
NAME_CHARS = 64
#: Lengths of IBANs by country (fixed values of the public registry).
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC",
}
#: Country codes of phone numbers (fixed values): one and two digits; all others have three.
DIALLED = "[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"


def _iban_shape() -> str:
    blocks = []
    for size, countries in IBAN_LENGTHS.items():
        full, rest = divmod(size - 4, 4)
        blocks.append(f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{full}}}" + (f" ?[A-Z0-9]{{{rest}}}" if rest else "") + "(?![A-Za-z0-9])")
    other = r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
    return r"(?<![A-Za-z0-9])(?=[A-Z]{2}[0-9]{2})(?:" + "|".join([*blocks, other]) + ")"


_SEP, _END = r"[ .\-]?", r"(?![0-9]|[.\-/][0-9])"
#: A group of a phone number: at most so many digits. Twelve follow the country code, so groups are few or short.
_GROUP = lambda n: rf"{_SEP}\(?[0-9]{{1,{n}}}\)?"
#: Shapes of the kinds, in order of precedence. Repeated single characters are possessive, repeated groups bounded.
SHAPES = {
    "email": r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@(?=[A-Za-z0-9\-]++\.[A-Za-z0-9\-])[A-Za-z0-9.\-]++",
    "iban": _iban_shape(),
    "date": r"(?<![0-9.\-/])(?:[0-9]{4}(?<d>[\-/.])[0-9]{2}\k<d>[0-9]{2}|[0-9]{2}(?<e>[\-/.])[0-9]{2}\k<e>[0-9]{4})(?![0-9]|[.\-/][0-9])",
    "ssn": r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    "phone": rf"(?<![0-9+])(?:\+1{_SEP}\(?[0-9]{{3}}\)?{_SEP}[0-9]{{3}}{_SEP}[0-9]{{4}}"
    rf"|\+[0-9]{{1,3}}(?:{_SEP}\(0\))?(?:(?:{_GROUP(2)}){{5,6}}{_END}|(?:{_GROUP(3)}){{4}}{_END}|(?:{_GROUP(5)}){{2,3}})(?![.\-/][0-9])"
    rf"|\([0-9]{{3}}\){_SEP}[0-9]{{3}}[ .\-][0-9]{{4}}|[0-9]{{3}}(?<p>[.\-])[0-9]{{3}}\k<p>[0-9]{{4}})(?![0-9])",
    "ipv4": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
    "card": r"(?<![0-9])(?:[0-9]{4}(?<c>[ \-])[0-9]{4}\k<c>[0-9]{4}\k<c>[0-9]{4}(?:\k<c>[0-9]{1,3}(?![0-9]|[.\-/ ][0-9]))?|[0-9](?:[ \-]?[0-9]){12,18})(?![0-9])",
}
PATTERN = "|".join(SHAPES.values())
KINDS = list(SHAPES)
#: Days of the 400 Gregorian years from 1800 on are 189 x 773.
DAYS = (189, 773)


def _quote(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _digits(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '')"


def _prf(key: str, kind: str, i: str, half: str, mod: str) -> str:
    """A keyed number below ``mod`` from the round and one half."""
    word = f"sha2(concat({_quote(key + '|' + kind + '|')}, cast({i} as string), '|', cast({half} as string), '|', cast({mod} as string)), 256)"
    return f"(cast(conv(substr({word}, 1, 15), 16, 10) as bigint) % ({mod}))"


def feistel(key: str, kind: str, a: str, b: str, mod_a: str, mod_b: str) -> str:
    """SQL for the permuted pair: a struct (a, b) of bigints below (mod_a, mod_b)."""
    left = f"(acc.a + {_prf(key, kind, 'i', 'acc.b', mod_a)}) % ({mod_a})"
    right = f"(acc.b + {_prf(key, kind, 'i', 'acc.a', mod_b)}) % ({mod_b})"
    step = f"if(i % 2 = 1, named_struct('a', {left}, 'b', acc.b), named_struct('a', acc.a, 'b', {right}))"
    return f"aggregate(sequence(1, {ROUNDS}), named_struct('a', cast({a} as bigint), 'b', cast({b} as bigint)), (acc, i) -> {step})"


def _power(n: str) -> str:
    """10 to the n as bigint."""
    return f"cast(concat('1', repeat('0', {n})) as bigint)"


def _let(value: str, name: str, body: str) -> str:
    """Evaluate ``value`` once, as ``name`` within ``body``."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def permuted_digits(key: str, kind: str, digits: str) -> str:
    """SQL for a keyed permutation of all digit strings of one length (1 to 30)."""
    hi, lo = "(length(s) div 2)", "(length(s) - length(s) div 2)"
    left = f"cast(if({hi} = 0, '0', substr(s, 1, {hi})) as bigint)"
    pair = feistel(key, kind, left, f"cast(substr(s, 1 + {hi}) as bigint)", _power(hi), _power(lo))
    return _let(digits, "s", _let(pair, "p", f"concat(if({hi} = 0, '', lpad(cast(p.a as string), {hi}, '0')), lpad(cast(p.b as string), {lo}, '0'))"))


def refill(shape: str, digits: str) -> str:
    """Put ``digits`` in the places of the digits of ``shape``, all else kept."""
    place = f"length({_digits('substr(m0, 1, j)')})"
    return _let(shape, "m0", _let(digits, "d0", f"array_join(transform(sequence(1, length(m0)), j -> if(substr(m0, j, 1) rlike '[0-9]', substr(d0, {place}, 1), substr(m0, j, 1))), '')"))


def luhn_sum(digits: str, double_last: bool) -> str:
    """Luhn sum of a digit string; ``double_last``: whether its last digit counts twice."""
    odd = 0 if double_last else 1
    digit = "cast(substr(s, length(s) - k, 1) as int)"
    term = f"if(k % 2 = {odd}, 2 * {digit} - if({digit} > 4, 9, 0), {digit})"
    return _let(digits, "s", f"aggregate(sequence(0, length(s) - 1), 0, (t, k) -> t + {term})")


def _mod97(text: str) -> str:
    """Remainder by 97 of a string of digits and capitals, capitals read as 10 to 35."""
    value = "cast(conv(substr(s, k, 1), 36, 10) as int)"
    return _let(text, "s", f"aggregate(sequence(1, length(s)), 0, (t, k) -> (t * if({value} > 9, 100, 10) + {value}) % 97)")


def _card(key: str) -> tuple[str, str]:
    """The longest reading of a match, from its first digit on, that is a card; what is left of it stays."""
    border = "substr(m, e, 1) rlike '[0-9]' and not substr(m, e + 1, 1) rlike '[0-9]'"
    read = _digits("substr(m, 1, e)")
    good = f"length({read}) >= 13 and {luhn_sum(read, False)} % 10 = 0 and {read} rlike '[1-9]'"
    ends = f"filter(sequence(length(m), 13, -1), e -> {border} and {good})"
    payload = f"substr({_digits('c')}, 1, length({_digits('c')}) - 1)"
    check = f"cast((10 - {luhn_sum('q', True)} % 10) % 10 as string)"
    new = refill("c", _let(permuted_digits(key, "card", payload), "q", f"concat(q, {check})"))
    return f"size({ends}) > 0", _let(f"element_at({ends}, 1)", "n0", _let("substr(m, 1, n0)", "c", f"concat({new}, substr(m, n0 + 1))"))


def _ipv4(key: str) -> tuple[str, str]:
    octets = "transform(split(m, '[.]'), o -> cast(o as bigint))"
    valid = f"forall({octets}, o -> o < 256)"
    pair = feistel(key, "ipv4", "o[0] * 256 + o[1]", "o[2] * 256 + o[3]", "65536", "65536")
    return valid, _let(octets, "o", _let(pair, "p", "concat_ws('.', p.a div 256, p.a % 256, p.b div 256, p.b % 256)"))


def _date(key: str) -> tuple[str, str]:
    """Year first, else day first where that's a real day, else month first."""
    iso = "(m rlike '^[0-9]{4}')"
    y = f"if({iso}, substr(m, 1, 4), substr(m, 7, 4))"
    made = lambda mo, d: f"to_date(concat({y}, '-', {mo}, '-', {d}), 'yyyy-MM-dd')"
    tried = lambda mo, d: f"try_to_date(concat({y}, '-', {mo}, '-', {d}), 'yyyy-MM-dd')"
    first, second = "if(m rlike '^[0-9]{4}', substr(m, 6, 2), substr(m, 4, 2))", "if(m rlike '^[0-9]{4}', substr(m, 9, 2), substr(m, 1, 2))"
    day_first = tried(first, second)
    month_first = tried("substr(m, 1, 2)", "substr(m, 4, 2)")
    day = f"coalesce({day_first}, if({iso}, null, {month_first}))"
    valid = f"{day} between date'1800-01-01' and date'2199-12-31'"
    number = "datediff(d, date'1800-01-01')"
    a, b = DAYS
    pair = feistel(key, "date", f"{number} div {b}", f"{number} % {b}", str(a), str(b))
    new = f"date_add(date'1800-01-01', cast(p.a * {b} + p.b as int))"
    sep = f"if({iso}, substr(m, 5, 1), substr(m, 3, 1))"
    form = lambda *parts: "concat(" + f", {sep}, ".join(parts) + ")"
    yy, mm, dd = "lpad(cast(year(n) as string), 4, '0')", "lpad(cast(month(n) as string), 2, '0')", "lpad(cast(day(n) as string), 2, '0')"
    text = f"case when {iso} then {form(yy, mm, dd)} when {day_first} is not null then {form(dd, mm, yy)} else {form(mm, dd, yy)} end"
    return valid, _let(day, "d", _let(pair, "p", _let(new, "n", text)))


def _ssn(key: str) -> tuple[str, str]:
    """Area 001 to 899 but 666, group 01 to 99, serial 0001 to 9999."""
    area, group, serial = "cast(substr(m, 1, 3) as bigint)", "cast(substr(m, 5, 2) as bigint)", "cast(substr(m, 8, 4) as bigint)"
    valid = f"{area} between 1 and 899 and {area} <> 666 and {group} > 0 and {serial} > 0"
    pair = feistel(key, "ssn", f"({area} - if({area} > 666, 2, 1)) * 99 + {group} - 1", f"{serial} - 1", str(898 * 99), "9999")
    new = "p.a div 99 + if(p.a div 99 >= 665, 2, 1)"
    return valid, _let(pair, "p", f"concat_ws('-', lpad(cast({new} as string), 3, '0'), lpad(cast(p.a % 99 + 1 as string), 2, '0'), lpad(cast(p.b + 1 as string), 4, '0'))")


def _phone(key: str) -> tuple[str, str]:
    """The country code stays; all other digits are permuted, however they are grouped."""
    head = f"regexp_extract(m, '^([+](?:{DIALLED}|[0-9]{{1,3}}))', 1)"
    rest = f"substr(m, length({head}) + 1)"
    valid = f"length({_digits('m')}) between 7 and 15 and length({_digits(rest)}) between 4 and 14"
    return valid, f"concat({head}, {refill(rest, permuted_digits(key, 'phone', _digits(rest)))})"


def _iban(key: str) -> tuple[str, str]:
    """Country and letters stay; the account's digits are permuted and the two check digits made anew."""
    plain = "replace(m, ' ', '')"
    valid = f"length({plain}) between 15 and 34 and {_mod97(f'concat(substr({plain}, 5), substr({plain}, 1, 4))')} = 1"
    account = refill(f"substr({plain}, 5)", permuted_digits(key, "iban", _digits(f"substr({plain}, 5)")))
    check = f"lpad(cast(98 - {_mod97(f'concat(z, substr({plain}, 1, 2), ' + _quote('00') + ')')} as string), 2, '0')"
    flat = _let(f"if({_digits(f'substr({plain}, 5)')} = '', substr({plain}, 5), {account})", "z", f"concat(substr({plain}, 1, 2), {check}, z)")
    place = "length(replace(substr(m, 1, j), ' ', ''))"
    return valid, _let(flat, "w", f"array_join(transform(sequence(1, length(m)), j -> if(substr(m, j, 1) = ' ', ' ', substr(w, {place}, 1))), '')")


def _email(key: str) -> tuple[str, str]:
    """The name before the @: letters a-z and digits are shifted by a Feistel network over its two halves."""
    name = "substring_index(m, '@', 1)"
    alphabet = _quote("abcdefghijklmnopqrstuvwxyz")

    def shifted(own: str, other: str) -> str:
        noise = "cast(conv(substr(h, 1 + 2 * ((j - 1) % 28), 8), 16, 10) as bigint)"
        c = f"substr({own}, j, 1)"
        low = f"substr({alphabet}, cast((locate({c}, {alphabet}) - 1 + {noise}) % 26 as int) + 1, 1)"
        high = f"upper(substr({alphabet}, cast((locate(lower({c}), {alphabet}) - 1 + {noise}) % 26 as int) + 1, 1))"
        num = f"cast((cast({c} as bigint) + {noise}) % 10 as string)"
        one = f"case when {c} rlike '[a-z]' then {low} when {c} rlike '[A-Z]' then {high} when {c} rlike '[0-9]' then {num} else {c} end"
        word = f"sha2(concat({_quote(key + '|email|')}, cast(i as string), '|', cast(length({own}) as string), '|', {other}), 256)"
        return f"if({own} = '', '', {_let(word, 'h', f'array_join(transform(sequence(1, length({own})), j -> {one}), {_quote("")})')})"

    step = f"if(i % 2 = 1, named_struct('a', {shifted('acc.a', 'acc.b')}, 'b', acc.b), named_struct('a', acc.a, 'b', {shifted('acc.b', 'acc.a')}))"
    start = "named_struct('a', substr(s, 1, length(s) div 2), 'b', substr(s, 1 + length(s) div 2))"
    new = _let(name, "s", f"aggregate(sequence(1, {ROUNDS}), {start}, (acc, i) -> {step}, acc -> concat(acc.a, acc.b))")
    return f"length({name}) <= {NAME_CHARS} and {name} rlike '[A-Za-z0-9]'", f"concat({new}, substr(m, length({name}) + 1))"


_MAKERS = {"email": _email, "iban": _iban, "date": _date, "ssn": _ssn, "phone": _phone, "ipv4": _ipv4, "card": _card}


def replacement(key: str) -> str:
    """SQL over a match ``m``: struct (kind, value); kind is null and the value unchanged if it isn't valid."""
    branches = []
    for kind, shape in SHAPES.items():
        valid, new = _MAKERS[kind](key)
        hit = f"named_struct('kind', {_quote(kind)}, 'value', {new})"
        miss = "named_struct('kind', cast(null as string), 'value', m)"
        branches.append(f"when m rlike {_quote('^(?:' + _unanchored(shape) + ')$')} then if({valid}, {hit}, {miss})")
    return "case " + " ".join(branches) + " else named_struct('kind', cast(null as string), 'value', m) end"


def _unanchored(shape: str) -> str:
    """A shape without its look-around, for a match already cut out."""
    import re

    shape = re.sub(r"^\(\?<!\[[^\]]*\]\)", "", shape)
    return re.sub(r"\(\?!(?:[^()\[\]]|\[[^\]]*\])*\)$", "", shape)


def session_key(spark: SparkSession) -> str:
    """The key of the session's setting; one is made and set for the application where there is none."""
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        key = secrets.token_hex(32)
        spark.conf.set(KEY_SETTING, key)
    return key


def pseudonymise(docs: DataFrame, key: str | None = None, text_col: str = "text", kinds_col: str | None = None) -> DataFrame:
    """``docs`` with ``text_col`` pseudonymised; ``kinds_col``: also an array of the kinds replaced, in order.

    ``key`` None: the session's.
    """
    key = key or session_key(docs.sparkSession)
    text: Column = docs[text_col].cast("string")
    taken = {c.lower() for c in docs.columns}
    work = next(n for n in (f"__pii_{k}" for k in range(len(taken) + 1)) if n not in taken)
    # few texts hold a digit or an @: only these are searched
    found = F.when(text.rlike("[0-9@]"), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)))
    cut = docs.withColumn(work, found)
    made = F.expr(f"transform({work}, m -> {replacement(key)})")
    cut = cut.withColumn(work, F.when(F.size(work) > 0, made))
    rest = F.split(text, PATTERN, -1)
    last = F.lit(None).cast("struct<kind:string,value:string>")
    joined = F.array_join(F.zip_with(rest, F.concat(work, F.array(last)), lambda t, m: F.concat(t, F.coalesce(m["value"], F.lit("")))), "")
    out = cut.withColumn(text_col, F.when(F.col(work).isNull(), text).otherwise(joined))
    if kinds_col:
        kinds = F.coalesce(F.expr(f"filter(transform({work}, x -> x.kind), k -> k is not null)"), F.array().cast("array<string>"))
        out = out.withColumn(kinds_col, kinds)
    return out.drop(work)
