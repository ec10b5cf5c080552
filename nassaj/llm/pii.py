"""Format-preserving pseudonyms by keyed Feistel permutations.

Personal values are found in the text, validated, and permuted within their own format: the pseudonym
keeps separators and kinds of characters and passes the same validation, and under one key equal
values have equal pseudonyms in every document, so links between documents stay.

    email    the part before the @, and the domain's name, character by character; the ending stays
    secret   access keys behind their fixed beginning, and values after password, token, secret, api key
    ip       four numbers up to 255, as a pair of 16-bit halves
    date     yyyy-mm-dd, or dd/mm/yyyy (else mm/dd/yyyy) with / . or -, as a day of the years 1800-2199
    card     13 to 19 digits that begin with 3 to 6 and end in their check digit, unbroken, in fours or as
             4-6-5 or 4-6-4: the first digit stays, and the check digit is right again
    ssn      ddd-dd-dddd outside the ranges never issued, permuted until it is outside them again
    phone    +country code and 7 to 12 digits, or ddd ddd dddd with an area code; the country code stays

A Feistel round adds a keyed MD5 of one half to the other, in the other's own alphabet; eight rounds
permute all values of a format. The key is the caller's secret: who has it can restore all values. With ``restore`` they run backwards and give the values back (in all
formats that find themselves again). Values that fail their validation stay. No context is asked for: every date
is taken for one of a person, and four numbers up to 255 with dots, such as a long version number, for an address. An
e-mail address has at most 64 characters before the @ and labels of at most 63 after it, as its format prescribes;
patterns are bounded by such lengths, so that time grows with the length of a text, whatever it holds. Null stays null, a text
without values stays as it is. Rows are done one by one; all other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

# --- fixed values: how the formats are written -------------------------------------
EMAIL = r"(?<![A-Za-z0-9])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}+@(?:[A-Za-z0-9][A-Za-z0-9-]{0,62}+\.){1,126}[A-Za-z]{2,63}"
SECRET = (
    r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b|\bgh[pousr]_[A-Za-z0-9]{36}\b|\bsk-[A-Za-z0-9]{20,}"
    r"|(?i:password|passwd|pwd|token|secret|api[_-]?key)\s*[=:]\s*[\"']?[A-Za-z0-9_./+-]{8,}"
)
SECRET_HEAD = r"^(?:AKIA|ASIA|gh[pousr]_|sk-|(?i:password|passwd|pwd|token|secret|api[_-]?key)\s*[=:]\s*[\"']?)"
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IP = rf"(?<![0-9.]){OCTET}(?:\.{OCTET}){{3}}(?![0-9]|\.[0-9])"
DATE = (
    r"(?<![0-9])(?:1[89]|2[01])[0-9]{2}-[01][0-9]-[0-3][0-9](?![0-9])"
    r"|(?<![0-9])[0-3][0-9]([/.-])[0-3][0-9]\1(?:1[89]|2[01])[0-9]{2}(?![0-9])"
)
CARD_FORMS = [r"[3-6][0-9]{12,18}"] + [
    "|".join(form.replace("_", mark) for mark in " -")
    for form in (r"[3-6][0-9]{3}(?:_[0-9]{4}){3}_[0-9]{1,3}", r"[3-6][0-9]{3}(?:_[0-9]{4}){2}_[0-9]{1,4}", r"[3-6][0-9]{3}_[0-9]{6}_[0-9]{4,5}")
]
CARD = rf"(?<![0-9])(?:{'|'.join(CARD_FORMS)})(?![0-9])"
SSN = r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])"
PHONE = (
    r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-]?[0-9]{2,4}){2,3}(?![0-9])"
    r"|(?<![0-9])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"
)
PHONE_HEAD = r"^\+(?:1(?=[ .(-])|[0-9]{1,3}(?=[ .(-])|[0-9])[ .-]?"
KINDS = {"email": EMAIL, "secret": SECRET, "ip": IP, "date": DATE, "ssn": SSN, "phone": PHONE}
#: Every value has one of these.
SIGNS = r"[0-9@=:]|AKIA|ASIA|gh[pousr]_|sk-"
#: Of 1,000 strings in an SSN's format 111 are never issued: a value that walks on 32 times has a chance of 1 in 10^30.
WALK = 32
FIRST_DAY, WEEKS, REST = "1800-01-01", 189, 773  # 189 * 773 = 146,097 days, 400 years

ANY = "|".join(f"(?:{p})" for p in KINDS.values())


def _quoted(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


class _Sql:
    """SQL of the permutations, forwards or backwards."""

    def __init__(self, key: str, restore: bool) -> None:
        self.key, self.sign = key, "-" if restore else "+"
        self.rounds = f"sequence({ROUNDS}, 1)" if restore else f"sequence(1, {ROUNDS})"

    def mac(self, *parts: str) -> str:
        said = ", ".join((_quoted(self.key), *(f"cast({p} AS string)" for p in parts)))
        return f"cast(conv(substring(md5(concat_ws('|', {said})), 1, 12), 16, 10) AS bigint)"

    def turned(self, c: str, k: str) -> str:
        def turn(first: str, size: int) -> str:
            return f"char({ord(first)} + pmod(ascii({c}) - {ord(first)} {self.sign} {k}, {size}))"

        return (
            f"CASE WHEN {c} BETWEEN '0' AND '9' THEN {turn('0', 10)} WHEN {c} BETWEEN 'a' AND 'z' THEN {turn('a', 26)} "
            f"WHEN {c} BETWEEN 'A' AND 'Z' THEN {turn('A', 26)} ELSE {c} END"
        )

    def characters(self, s: str, kind: str) -> str:
        """A string, each character within its digits, small or capital letters."""

        def changed(half: str, other: str) -> str:
            one = self.turned("c", self.mac(f"'{kind}'", "r", "d", "i + 1"))
            return f"transform(array(md5({other})), d -> array_join(transform(split({half}, ''), (c, i) -> {one}), ''))[0]"

        start = f"named_struct('a', substring({s}, 1, length({s}) div 2), 'b', substring({s}, length({s}) div 2 + 1))"
        step = (
            f"if(r % 2 = 0, named_struct('a', {changed('h.a', 'h.b')}, 'b', h.b), "
            f"named_struct('a', h.a, 'b', {changed('h.b', 'h.a')}))"
        )
        return f"aggregate({self.rounds}, {start}, (h, r) -> {step}, h -> concat(h.a, h.b))"

    def numbers(self, a: str, b: str, size_a: int, size_b: int, kind: str) -> str:
        """A pair of numbers below its sizes, as a struct of ``a`` and ``b``."""
        one = f"pmod(h.a {self.sign} {self.mac(f"'{kind}'", 'r', 'h.b')}, {size_a}L)"
        two = f"pmod(h.b {self.sign} {self.mac(f"'{kind}'", 'r', 'h.a')}, {size_b}L)"
        start = f"named_struct('a', cast({a} AS bigint), 'b', cast({b} AS bigint))"
        step = f"if(r % 2 = 0, named_struct('a', {one}, 'b', h.b), named_struct('a', h.a, 'b', {two}))"
        return f"aggregate({self.rounds}, {start}, (h, r) -> {step})"

    def email(self, m: str) -> str:
        local, domain = f"substring_index({m}, '@', 1)", f"substring_index({m}, '@', -1)"
        ending = f"substring_index({domain}, '.', -1)"
        name = f"substring({domain}, 1, length({domain}) - length({ending}) - 1)"
        return f"concat({self.characters(local, 'local')}, '@', {self.characters(name, 'domain')}, '.', {ending})"

    def behind(self, m: str, head: str, kind: str) -> str:
        """What follows a fixed head."""
        kept = f"regexp_extract({m}, {_quoted(head)}, 0)"
        return f"concat({kept}, {self.characters(f'substring({m}, length({kept}) + 1)', kind)})"

    def ip(self, m: str) -> str:
        n = [f"cast(split({m}, '[.]')[{k}] AS bigint)" for k in range(4)]
        pair = self.numbers(f"{n[0]} * 256 + {n[1]}", f"{n[2]} * 256 + {n[3]}", 65536, 65536, "ip")
        return f"transform(array({pair}), p -> concat_ws('.', p.a div 256, p.a % 256, p.b div 256, p.b % 256))[0]"

    def date(self, m: str) -> str:
        def permuted(day: str, pattern: str) -> str:
            n = f"datediff({day}, DATE'{FIRST_DAY}')"
            pair = self.numbers(f"{n} div {REST}", f"{n} % {REST}", WEEKS, REST, "date")
            then = f"date_add(DATE'{FIRST_DAY}', cast(p.a * {REST} + p.b AS int))"
            return f"transform(array({pair}), p -> date_format({then}, {pattern}))[0]"

        mark = f"substring({m}, 3, 1)"
        patterns = ["'yyyy-MM-dd'", f"concat('dd', {mark}, 'MM', {mark}, 'yyyy')", f"concat('MM', {mark}, 'dd', {mark}, 'yyyy')"]
        days = [f"cast(try_to_timestamp({m}, {p}) AS date)" for p in patterns]
        tried = [f"WHEN {d} IS NOT NULL THEN {permuted(d, p)}" for d, p in zip(days[1:], patterns[1:], strict=True)]
        iso = f"WHEN {m} rlike '^[0-9]{{4}}' THEN coalesce({permuted(days[0], patterns[0])}, {m})"
        return f"CASE {iso} {' '.join(tried)} ELSE {m} END"

    def check_digit(self, digits: str) -> str:
        """The Luhn digit that belongs after a string of digits."""
        d = f"cast(substring({digits}, -j, 1) AS int)"
        part = f"if(j % 2 = 1, 2 * {d} - if({d} > 4, 9, 0), {d})"
        return f"pmod(-aggregate(sequence(1, length({digits})), 0, (s, j) -> s + {part}), 10)"

    def card(self, m: str) -> str:
        """Its middle is permuted; the last digit is the right one."""
        middle = self.characters(f"substring({m}, 2, length({m}) - 2)", "card")
        last = self.check_digit("regexp_replace(p, '[ -]', '')")
        return f"transform(array(concat(substring({m}, 1, 1), {middle})), p -> concat(p, cast({last} AS string)))[0]"

    def ssn(self, m: str) -> str:
        valid = f"w rlike {_quoted(f'^(?:{SSN})$')}"
        return f"aggregate(sequence(1, {WALK}), {m}, (w, k) -> if(k > 1 AND {valid}, w, {self.characters('w', 'ssn')}))"

    def patterns(self, t: str) -> str:
        """The pattern of a text's values, its cards by name: a number that is none hides nothing that begins in it."""
        found = [f"regexp_extract_all({t}, {_quoted(f'(?<![0-9])(?=({form})(?![0-9]))')}, 1)" for form in CARD_FORMS]
        digits = "regexp_replace(c, '[ -]', '')"
        right = f"{self.check_digit(f'substring({digits}, 1, length({digits}) - 1)')} = cast(substring(c, -1, 1) AS int)"
        cards = f"if({t} rlike {_quoted(CARD)}, filter(array_distinct(concat({', '.join(found)})), c -> {right}), array())"
        named = f"concat({_quoted(ANY + '|(?<![0-9])(?:')}, array_join(n, '|'), ')(?![0-9])')"
        return f"transform(array({cards}), n -> if(size(n) = 0, {_quoted(ANY)}, {named}))"

    def value(self, m: str) -> str:
        def whole(pattern: str) -> str:
            return f"{m} rlike {_quoted(f'^(?:{pattern})$')}"

        return (
            f"CASE WHEN {whole(EMAIL)} THEN {self.email(m)} "
            f"WHEN {whole(SECRET)} THEN {self.behind(m, SECRET_HEAD, 'secret')} "
            f"WHEN {whole(IP)} THEN {self.ip(m)} "
            f"WHEN {whole(DATE)} THEN {self.date(m)} "
            f"WHEN {whole(CARD)} THEN {self.card(m)} "
            f"WHEN {whole(SSN)} THEN {self.ssn(m)} "
            f"ELSE {self.behind(m, PHONE_HEAD, 'phone')} END"
        )

    def text(self, t: str) -> str:
        new = f"transform(regexp_extract_all({t}, v, 0), m -> {self.value('m')})"
        joined = f"array_join(zip_with(split({t}, v, -1), {new}, (a, b) -> concat(a, coalesce(b, ''))), '')"
        return f"if({t} rlike '{SIGNS}', transform({self.patterns(t)}, v -> {joined})[0], {t})"


def pseudonyms(text: str, key: str, restore: bool = False) -> Column:
    """A text column with its personal values permuted, or permuted back."""
    return F.expr(_Sql(key, restore).text(f"`{text}`"))


def values(text: str) -> Column:
    """The personal values found in a text, in order."""
    found = f"transform({_Sql("", False).patterns(f'`{text}`')}, v -> regexp_extract_all(`{text}`, v, 0))[0]"
    return F.expr(f"if(`{text}` rlike '{SIGNS}', {found}, array())")


def pseudonymise(df: DataFrame, text: str, key: str, restore: bool = False) -> DataFrame:
    """``df`` with the text's personal values replaced."""
    return df.withColumn(text, pseudonyms(text, key, restore))
