"""Text functions as Spark columns: normal forms, figures, and how two readings of a text relate."""

from __future__ import annotations

import difflib
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that stand for "nothing here" (fixed values).
SENTINELS = ("not_found", "notfound", "none", "null", "n/a", "na", "-", "—", "없음", "해당없음", "해당 없음", "미표시", "미기재", "확인불가")
#: Runs of circled and bracketed numbers, first code point and how many (fixed values).
NUMBER_SIGNS = ((0x2460, 20), (0x2474, 20), (0x24F5, 10))
#: Share of a reading that may be missing or added before it counts (fixed values).
TOLERANCE, MATCH_SHARE = 0.15, 0.8

#: What relations are called (fixed values); the percentage stands between the two parts.
CUT_LABEL = ("뒷부분 잘림(", "% 소실) — 정본이 더 완전")
LABELS = {"head_drop": "앞 항목명 생략 — 값 자체는 온전", "expanded": "정본보다 많이 읽음 — 누락 회수 가능", "diverged": "정본과 내용이 다름 — 원본 확인 필요", "same": "표기 차이"}

#: Patterns of the normal forms, figures and headings (fixed values).
# single characters below 256 are looked up at once; ranges, \s and others are tried one by one for each letter that stays
STABLE_DROPS = r"[0123456789 \t\n\x0B\f\r%p.,:;·\"'`~()\[\]{}\-[Ā-￿&&[①②③④⑤⑥⑦⑧⑨⑩「」『』—]]]+"
LOWER = "0123456789abcdefghijklmnopqrstuvwxyz"
COARSE_DROPS = r"[ \t\n\x0B\f\r,.~:%()\[\]{}'\"`<>·*!?|#\-[Ā-￿&&[：「」『』※]]]"
EVAL_DROPS = r"[ \t\n\x0B\f\r,~:%()\[\]{}'\"`´<>·*|[Ā-￿&&[：『』「」〈〉【】※ㆍ■□“”‘’]]]"
EVAL_PICTURES = r"[\x{10000}-\x{10FFFF}☀-➿\x{FE0F}\x{200D}\x{FFFD}]"
# digits of any script count in figures, as text recognition also gives full-width ones
FIGURE_WITH_UNIT = r"(\p{Nd}[\p{Nd},\.]*\s*(?:%p|%|원|명|팀|개월|좌)?)"
FIGURE = r"(\p{Nd}[\p{Nd},]*(?:\.\p{Nd}+)?\s*(?:%p|%|억원|만원|천원|원|명|팀|좌|개월|년|일|회|건))"
HEADING = r"^\s*(?:제?\s?[0-9]+\s?[.조항편장절관)]|[ⅠⅡⅢⅣⅤⅥⅦⅧⅨⅩ]+\s?\.?|[가-힣]\.|\([0-9]+\)|[0-9]+\)|[□■◎○●◇◆▷▶☞]|【[^】]*】)"


def _lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def plain_numbers(x: Column) -> Column:
    """Circled and bracketed numbers as digits; texts without any pass untouched."""
    signs = [(chr(first + k), str(k + 1)) for first, n in NUMBER_SIGNS for k in range(n)]
    found = "[" + "".join(f"{chr(first)}-{chr(first + n - 1)}" for first, n in NUMBER_SIGNS) + "]"
    pairs = F.array(*[F.struct(F.lit(sign).alias("sign"), F.lit(digits).alias("digits")) for sign, digits in signs])
    return F.when(x.rlike(found), F.aggregate(pairs, x, lambda t, p: F.replace(t, p["sign"], p["digits"]))).otherwise(x)


def casefold(x: Column) -> Column:
    """Lower case with the one fold that matters to the alphabets kept here."""
    return F.replace(F.lower(x), F.lit("ß"), F.lit("ss"))


def keep(x: Column, alphabet: str) -> Column:
    """Only the characters of an alphabet. Taking them out in runs is several times faster than replacing
    single strangers by a negated class."""
    return F.array_join(F.regexp_extract_all(x, F.lit(f"[{alphabet}]+"), F.lit(0)), "")


def norm(x: Column, alphabet: str = LOWER + "가-힣") -> Column:
    """Comparison form of a reading: folded, number signs as digits, only the alphabet kept."""
    return keep(casefold(plain_numbers(x)), alphabet)


def numeric_signature(x: Column) -> Column:
    """Figures of a text in order, thousands separators dropped."""
    return F.transform(F.regexp_extract_all(x, F.lit(r"([0-9]+(?:[.,][0-9]+)*)"), F.lit(1)), lambda n: F.replace(n, F.lit(","), F.lit("")))


def numbers_differ(a: Column, b: Column) -> Column:
    """Whether figures of several characters differ, or else both have single digits and these differ."""
    sa, sb = numeric_signature(a), numeric_signature(b)
    long = lambda s: F.filter(s, lambda n: F.length(n) > 1)
    short = lambda s: F.filter(s, lambda n: F.length(n) == 1)
    return (long(sa) != long(sb)) | ((F.size(short(sa)) > 0) & (F.size(short(sb)) > 0) & (short(sa) != short(sb)))


def relation(kind, lost_head=0.0, lost_tail=0.0, gained=0.0) -> Column:
    return F.struct(
        _lit(kind).alias("kind"), _lit(lost_head).cast("double").alias("lost_head"), _lit(lost_tail).cast("double").alias("lost_tail"), _lit(gained).cast("double").alias("gained")
    )


def relation_by_containment(a: Column, b: Column) -> Column:
    """How normal form b relates to a where one holds the other; null where neither does.

    Struct (kind, lost_head, lost_tail, gained): same, tail_cut, head_drop or expanded.
    """
    la, lb = F.length(a), F.length(b)
    head = F.instr(a, b) - 1
    tail = la - head - lb
    lost_head, lost_tail, gained = head / la, tail / la, (lb - la) / lb
    return (
        F.when(a == b, relation("same"))
        .when(a == "", relation("expanded", gained=1.0))
        .when(b == "", relation("tail_cut", lost_tail=1.0))
        .when(
            F.contains(a, b),
            F.when(F.greatest(lost_head, lost_tail) < TOLERANCE, relation("same", lost_head, lost_tail))
            .when(tail >= head, relation("tail_cut", lost_head, lost_tail))
            .otherwise(relation("head_drop", lost_head, lost_tail)),
        )
        .when(F.contains(b, a), F.when(gained < TOLERANCE, relation("same", gained=gained)).otherwise(relation("expanded", gained=gained)))
    )


def longest_match(autojunk: bool = True):
    """Arrow UDF: longest common block of two texts, as (start in a, size); null texts have none.

    With ``autojunk`` frequent characters of long second texts seed no match, as in difflib's default.
    """

    @F.pandas_udf("struct<at:int,size:int>")
    def found(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        out = []
        for x, y in zip(a, b, strict=True):
            m = difflib.SequenceMatcher(None, x or "", y or "", autojunk=autojunk).find_longest_match(0, len(x or ""), 0, len(y or ""))
            out.append((m.a, m.size))
        return pd.DataFrame(out, columns=["at", "size"])

    return found


def relation_by_block(a: Column, b: Column, match: Column) -> Column:
    """Relation of two normal forms of which neither holds the other, from their longest common block."""
    la, lb = F.length(a), F.length(b)
    cut = (match["size"] >= MATCH_SHARE * lb) & ((la - lb) / la >= TOLERANCE) & (match["at"] / la < TOLERANCE)
    return F.when(cut, relation("tail_cut", 0.0, (la - match["at"] - match["size"]) / la)).otherwise(relation("diverged"))


def gated(shape: Column, ocr: Column, cand: Column) -> Column:
    """Readings of the same shape whose figures differ have diverged."""
    return F.when((shape["kind"] == "same") & numbers_differ(ocr, cand), relation("diverged")).otherwise(shape)


def relation_label(r: Column) -> Column:
    """A relation in words; what a cut lost as a whole percentage, rounded half to even."""
    cut = F.concat(F.lit(CUT_LABEL[0]), F.bround(r["lost_tail"] * 100, 0).cast("int").cast("string"), F.lit(CUT_LABEL[1]))
    return F.when(r["kind"] == "tail_cut", cut).otherwise(F.try_element_at(F.create_map(*[F.lit(x) for kv in LABELS.items() for x in kv]), r["kind"]))


def is_truncated(r: Column) -> Column:
    """Whether the candidate lost the end of the reading; a dropped head is no truncation."""
    return r["kind"] == "tail_cut"


def token_norm(x: Column) -> Column:
    return keep(casefold(x), LOWER + "가-힣.%")


def tokens(x: Column) -> Column:
    """Tokens of a claim: split at white space and ,;/·()~, each normalised, empty ones dropped."""
    parts = F.transform(F.split(x, r"[\s,;/·()~]+"), lambda t: token_norm(t))
    return F.filter(parts, lambda t: t != "")


def consistency(claim: Column, source: Column) -> Column:
    """Share of the claim's tokens that the normalised source holds; 0 without tokens."""
    # both sides are normalised once, not for each token
    once = F.array(F.struct(tokens(claim).alias("t"), token_norm(source).alias("s")))
    share = lambda v: F.when(F.size(v["t"]) == 0, F.lit(0.0)).otherwise(F.size(F.filter(v["t"], lambda w: F.contains(v["s"], w))) / F.size(v["t"]))
    return F.transform(once, share)[0]


def stable_core(x: Column) -> Column:
    """A line without what readings get wrong: digits, number signs, spaces and punctuation, the letter p."""
    return F.lower(F.regexp_replace(x, STABLE_DROPS, ""))


def coarse(x: Column) -> Column:
    """A line without spaces and punctuation, lower case."""
    return F.lower(F.regexp_replace(x, COARSE_DROPS, ""))


def squash(x: Column) -> Column:
    """White space removed."""
    return F.regexp_replace(x, r"\s+", "")


def squash_all(x: Column) -> Column:
    """White space, punctuation and symbols removed, lower case (Unicode classes)."""
    return F.lower(F.regexp_replace(x, r"(?U)[\s\W_]+", ""))


def eval_norm(x: Column) -> Column:
    """Scoring form: punctuation and pictures dropped, circled digits as 1 to 9 and 0, . and - kept between digits only."""
    x = F.regexp_replace(x, EVAL_DROPS, "")
    x = F.regexp_replace(x, r"(?<![0-9])\.|\.(?![0-9])", "")
    x = F.regexp_replace(x, EVAL_PICTURES, "")
    x = F.replace(F.replace(F.lower(F.translate(x, "①②③④⑤⑥⑦⑧⑨⑩", "1234567890")), F.lit("–"), F.lit("-")), F.lit("‧"), F.lit(""))
    return F.regexp_replace(x, r"(?<![0-9])-|-(?![0-9])", "")


def quote_norm(x: Column) -> Column:
    """Quotes and white space dropped."""
    return F.regexp_replace(x, r"[\s\"'`“”‘’]", "")


def numeric_core(x: Column) -> Column:
    """Figures with their units, separators and closing dots dropped, joined by |."""
    found = F.regexp_extract_all(quote_norm(x), F.lit(FIGURE_WITH_UNIT), F.lit(1))
    return F.array_join(F.transform(found, lambda n: F.regexp_replace(F.replace(n, F.lit(","), F.lit("")), r"\.+$", "")), "|")


def raw_figures(x: Column) -> Column:
    """Amounts, counts, periods and rates of a text as they stand there, in order."""
    return F.regexp_extract_all(x, F.lit(FIGURE), F.lit(1))


def figures(x: Column) -> Column:
    """Figures of a text, white space dropped, in order."""
    return F.transform(raw_figures(x), lambda n: squash(n))


def normal_ratio(x: Column) -> Column:
    """Share of ordinary characters: ASCII, Hangul, letters, digits, punctuation and symbols of any script."""
    good = F.regexp_count(x, F.lit(r"[가-힣ㄱ-ㆎ\p{ASCII}\p{L}\p{N}\p{P}\p{S}]"))
    return F.when(F.length(x) > 0, good / F.length(x)).otherwise(F.lit(0.0))


def is_heading(x: Column) -> Column:
    """Short paragraphs that begin with the sign of a clause or an outline."""
    return (F.length(x) <= 80) & x.rlike(HEADING)


def looks_malformed(x: Column) -> Column:
    """Braces, or an odd number of quotes of either kind."""
    odd = lambda q: (F.length(x) - F.length(F.replace(x, F.lit(q), F.lit("")))) % 2 == 1
    return x.contains("{") | x.contains("}") | odd('"') | odd("'")


def is_empty_text(x: Column) -> Column:
    """Null, blank, or one of the words for nothing; surrounding quotes don't count."""
    bare = F.lower(F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), r"^[\s\"']+|[\s\"']+$", "")))
    return (bare == "") | bare.isin(*SENTINELS)


def is_empty_value(values: Column) -> Column:
    """Null, empty, or a list of empty texts alone."""
    return F.coalesce(F.forall(values, is_empty_text), F.lit(True))


def strip_annotations(x: Column) -> Column:
    """Region ids in brackets within a text become a space."""
    return F.regexp_replace(x, r"\(\s*p[0-9]+_r[0-9]+(?:\s*,\s*p[0-9]+_r[0-9]+)*\s*\)", " ")


def strip_fences(x: Column) -> Column:
    """Content of a fenced code block, or the trimmed text."""
    inner = F.regexp_extract(x, r"(?s)^\s*```[a-zA-Z]*\s*\n?(.*?)\s*```\s*$", 1)
    return F.when(inner != "", inner).otherwise(F.trim(x))


def repaired_json(x: Column, schema: str) -> Column:
    """JSON of a fenced answer; if it doesn't parse, once more without its last backslash."""
    bare = strip_fences(x)
    at = F.length(bare) - F.instr(F.reverse(bare), "\\") + 1
    fixed = F.when(F.instr(bare, "\\") > 0, F.concat(F.substring(bare, F.lit(1), at - 1), F.substring(bare, at + 1, F.length(bare))))
    return F.coalesce(F.from_json(F.when(F.is_valid_utf8(bare), bare), schema), F.from_json(fixed, schema))


def two_places(x: Column) -> Column:
    """A share of 0 to 1 with two decimals, rounded by the double's exact value as C does (Java's format rounds its
    shortest decimal form)."""
    scaled = (x * float(1 << 62)).cast("bigint").cast("decimal(25,0)") * 100
    whole = F.floor(scaled / (1 << 62)).cast("bigint")
    rest = scaled - whole.cast("decimal(25,0)") * F.lit(1 << 62).cast("decimal(25,0)")
    half = F.lit(1 << 61).cast("decimal(25,0)")
    n = whole + F.when((rest > half) | ((rest == half) & (whole % 2 == 1)), 1).otherwise(0)
    return F.concat(F.floor(n / 100).cast("string"), F.lit("."), F.lpad((n % 100).cast("string"), 2, "0"))


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))


def first_keyword(x: Column, groups: dict[str, tuple[str, ...]]) -> Column:
    """The first group, in order, one of whose keywords the text holds."""
    out = F.lit(None).cast("string")
    for name, words in reversed(groups.items()):
        out = F.when(reduce(lambda a, b: a | b, [F.contains(x, F.lit(w)) for w in words]), name).otherwise(out)
    return out
