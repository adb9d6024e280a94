"""PII: format-preserving pseudonyms by keyed Feistel permutations. Native.

One expression finds all candidates in a text; each is validated by its kind and, if valid,
permuted within its own format by a Feistel network under a secret key:

* payment card numbers (13 to 19 digits, blanks or hyphens between them allowed, Luhn-valid): all
  digits but the last are permuted as a decimal number, the last one is the new check digit. A run
  of digit groups is searched from left to right for the longest such number that starts and ends
  at groups, those in the usual groups first, so a year or a count beside a number doesn't hide it;
* telephone numbers (``+`` and 8 to 15 digits, 11 after ``+1``): the digits after the first are
  permuted. From the eighth digit on, one ends where another candidate begins;
* US social security numbers (valid areas, groups and serials): permuted among all valid ones;
* IPv4 addresses (each part at most 255): the 32 bits are permuted;
* dates (1900-01-01 to 2099-11-12, day, month and year with ``-``, ``/`` or ``.``; ISO or
  day-first): the day number is permuted among all these days;
* e-mail addresses and hexadecimal secrets (32 digits or more): letters and digits are replaced
  within their class by a keyed hash of the lowered whole, the address ending in ``.invalid``.

Equal values get equal pseudonyms in all documents, whatever separators they are written with,
and different numbers and dates of one kind and size different ones. What isn't valid, such as a
16-digit number with a wrong check digit or a version number, stays as it is.

Defined results: a null text stays null with count 0; texts without a candidate are unchanged;
rows, other columns and repeated rows are kept as they are; texts are processed whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROUNDS = 8
#: The session setting that holds the secret key, if callers pass none.
KEY_SETTING = "spark.claimscope.pii.key"
FIRST_DAY, DAYS_A, DAYS_B = "1900-01-01", 250, 292

#: Candidates, the more specific first; fixed values. Each is bounded by what can't belong to it.
PATTERNS = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9][A-Za-z0-9-]{0,62}(?:\.[A-Za-z0-9-]{1,63}){0,6}\.[A-Za-z]{2,24}",
    "secret": r"(?<![0-9A-Za-z])[0-9A-Fa-f]{32,}+(?![0-9A-Za-z])",
    "ipv4": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iso_date": r"(?<![0-9-])(?:19|20)[0-9]{2}[-/.][0-9]{2}[-/.][0-9]{2}(?![0-9-])",
    "date": r"(?<![0-9./-])[0-9]{2}[-/.][0-9]{2}[-/.](?:19|20)[0-9]{2}(?![0-9-])",
    # a run of digit groups; its end isn't taken from an address or a date
    "card": r"(?<![0-9A-Za-z.-])(?=(?:[0-9][ -]?){12}[0-9])[0-9][0-9 -]*[0-9](?![0-9A-Za-z])(?!(?<=[ -][0-9]{1,3})[./][0-9])(?!(?<=[ -](?:19|20)[0-9]{2})[./][0-9]{2}[./][0-9]{2})",
}
_IN_RUN = "|".join(PATTERNS[k] for k in ("ssn", "iso_date", "date"))
_NEXT = "|".join([PATTERNS["ipv4"], _IN_RUN, r"[0-9](?:[ -]?[0-9]){12}"])
_PHONE = rf"(?<![0-9A-Za-z+])\+(?:1(?:[ .()-]{{0,2}}[0-9]){{10}}|[0-9](?:[ .()-]{{0,2}}[0-9]){{7}}(?:(?![ (]{{1,2}}(?:{_NEXT}))[ .()-]{{0,2}}[0-9]){{0,7}})(?![0-9])"
PATTERNS = {k: p for kind in PATTERNS for k, p in ([("phone", _PHONE)] if kind == "ipv4" else []) + [(kind, PATTERNS[kind])]}
#: How cards are printed.
USUAL = "^([0-9]{13,19}|[0-9]{4}([ -][0-9]{4}){2}[ -][0-9]{1,4}([ -][0-9]{1,3})?|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5})$"
#: The pieces of a run of digit groups.
PIECES = rf"{_IN_RUN}|[0-9]+|[ -]"
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Whole candidates of these kinds.
SHAPES = {"ssn": "^[0-9]{3}-[0-9]{2}-[0-9]{4}$", "iso_date": "^[0-9]{4}[-/.][0-9]{2}[-/.][0-9]{2}$", "date": "^[0-9]{2}[-/.][0-9]{2}[-/.][0-9]{4}$"}
#: A text without these has no candidate; a class of single characters is found fast.
HINT = r"[0-9@]|[A-Fa-f]{32}"


def _prf(key: str, kind: str, i: int, size: str, half: str) -> str:
    """60 keyed bits for one round; ``half`` is SQL."""
    return f"conv(substring(sha2(concat('{key}|{kind}|{i}|', {size}, '|', {half}), 256), 1, 15), 16, 10)"


def _decimal(digits: str, key: str, kind: str) -> str:
    """A permutation of the digit strings of one length (2 to 19): SQL from SQL."""
    left = f"cast(length({digits}) div 2 as int)"
    state = f"struct(substring({digits}, 1, {left}) as a, substring({digits}, {left} + 1) as b)"
    for i in range(ROUNDS):
        # a + F(b) modulo its own power of ten; halves are at most 10 digits
        moved = f"cast((cast(x.a as bigint) + cast({_prf(key, kind, i, 'length(x.a)', 'x.b')} as bigint)) % cast(rpad('1', length(x.a) + 1, '0') as bigint) as string)"
        state = f"transform(array({state}), x -> struct(x.b as a, lpad({moved}, length(x.a), '0') as b))[0]"
    return f"transform(array({state}), x -> concat(x.a, x.b))[0]"


def _numeric(value: str, a: int, b: int, key: str, kind: str) -> str:
    """A permutation of 0 .. a * b - 1: SQL from SQL."""
    state = f"struct(({value}) div {b} as a, ({value}) % {b} as b)"
    for i in range(ROUNDS):
        side, other, size = (("a", "b", a), ("b", "a", b))[i % 2]
        moved = f"(x.{side} + cast({_prf(key, kind, i, repr(str(size)), f'x.{other}')} as bigint)) % {size}"
        state = f"transform(array({state}), x -> struct({moved if side == 'a' else 'x.a'} as a, {moved if side == 'b' else 'x.b'} as b))[0]"
    return f"transform(array({state}), x -> x.a * {b} + x.b)[0]"


def _luhn(digits: str) -> str:
    """The Luhn sum of a digit string whose last digit is the check digit."""
    doubled = f"((length({digits}) - i) % 2) = 1"
    digit = f"cast(substring({digits}, i, 1) as int)"
    return f"aggregate(sequence(1, length({digits})), 0, (s, i) -> s + if({doubled}, if({digit} > 4, 2 * {digit} - 9, 2 * {digit}), {digit}))"


def _refill(mask: str, digits: str) -> str:
    """``mask`` with its digits replaced, in order, by ``digits``."""
    parts = f"split({mask}, '[0-9]', -1)"
    return f"concat_ws('', transform({parts}, (p, i) -> concat(p, substring({digits}, i + 1, 1))))"


def _classed(value: str, key: str, kind: str) -> str:
    """Letters and digits replaced within their class by a keyed hash of the lowered whole."""
    # 64 draws a block; from the third block on of the value's hash, so the work is linear in its length
    stream = f"transform(array(sha2(lower({value}), 512)), h -> transform(sequence(0, length({value}) div 64), k -> sha2(concat('{key}|{kind}|', cast(k as string), '|', if(k < 2, lower({value}), h)), 512)))[0]"
    letters = {"[0-9]": ("0123456789", 10), "[a-f]": ("abcdef", 6), "[A-F]": ("ABCDEF", 6)} if kind == "secret" else {"[0-9]": ("0123456789", 10), "[a-z]": ("abcdefghijklmnopqrstuvwxyz", 26), "[A-Z]": ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 26)}
    draw = "cast(conv(substring(z.s[cast(i div 64 as int)], 1 + 2 * (i % 64), 2), 16, 10) as int)"
    case = " ".join(f"when c rlike '{p}' then substring('{chars}', 1 + ({draw}) % {n}, 1)" for p, (chars, n) in letters.items())
    return f"transform(array(struct({stream} as s)), z -> concat_ws('', transform(split({value}, ''), (c, i) -> case {case} else c end)))[0]"


def _bind(name: str, value: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def _run(m: str, key: str, pseudonyms: dict[str, str]) -> str:
    """SQL for struct(s, n) of a run of digit groups: cards, and what is in ``pseudonyms`` (kind -> SQL of ``t``), replaced."""
    digits = "regexp_replace(c, '[^0-9]', '')"
    # a number starts and ends with a digit group; single separators; nothing of another kind within
    shape = "c rlike '^[0-9]+([ -][0-9]+)*$' and forall(slice(ts, i, k), t -> t rlike '^([0-9]+|[ -])$')"
    valid = _bind("c", "array_join(slice(ts, i, k), '')", f"if({shape}, " + _bind("d", digits, f"length(d) between 13 and 19 and d <> repeat('0', length(d)) and {_luhn('d')} % 10 = 0") + ", false)")
    card = _bind("d", digits, _bind("q", _decimal("substring(d, 1, length(d) - 1)", key, "card"), _refill("c", f"concat(q, cast((10 - {_luhn("concat(q, '0')")} % 10) % 10 as string))")))
    other = "case " + " ".join(f"when t rlike '{shape_}' then {pseudonyms[kind]}" for kind, shape_ in SHAPES.items()) + " else t end"
    # 19 digits have at most 18 separators between them; the longest first
    longest = "if(ts[i - 1] rlike '^[0-9]+$', try_element_at(filter(transform(sequence(0, 18), j -> 37 - 2 * j), k -> k <= size(ts) - i + 1 and {}), 1), null)"
    usual = longest.format(f"array_join(slice(ts, i, k), '') rlike '{USUAL}' and {valid}")
    # a chance number of other groups doesn't take a part of a number in the usual ones
    found = f"coalesce(us[i - 1], {longest.format(f'not exists(slice(us, i + 1, k - 1), u -> u is not null) and {valid}')})"
    one = _bind("t", "ts[i - 1]", _bind("p", other, "struct(concat(s.s, p) as s, s.n + if(p <> t, 1, 0) as n, i + 1 as at)"))
    taken = _bind("c", "array_join(slice(ts, i, k), '')", _bind("p", card, "struct(concat(s.s, p) as s, s.n + if(p <> c, 1, 0) as n, i + k as at)"))
    step = f"if(i < s.at, s, {_bind('k', found, f'if(k is null, {one}, {taken})')})"
    walk = f"aggregate(sequence(1, size(ts)), struct('' as s, 0 as n, 1 as at), (s, i) -> {step})"
    return _bind("ts", f"regexp_extract_all({m}, {_literal(PIECES)}, 0)", _bind("us", f"transform(sequence(1, size(ts)), i -> {usual})", _bind("w", walk, "struct(w.s as s, w.n as n)")))


def pseudonym(m: str, key: str) -> str:
    """SQL for struct(s, n): a candidate ``m`` (SQL) with what is valid in it replaced, and how many that are."""
    local_ = {kind: _single("t", key)[kind] for kind in SHAPES}
    one = _bind("p", _whole(m, key), f"struct(p as s, if(p <> {m}, 1, 0) as n)")
    return f"if({m} rlike '^[0-9][0-9 -]+$' and not {m} rlike '{'|'.join(['^[0-9]{32,}$', *SHAPES.values()])}', {_run(m, key, local_)}, {one})"


def _single(m: str, key: str) -> dict[str, str]:
    """kind -> SQL for the pseudonym of a candidate of that kind, or ``m`` itself where it isn't valid."""
    only = f"regexp_replace({m}, '[^0-9]', '')"
    phone = _bind("d", only, _refill(m, f"concat(substring(d, 1, 1), {_decimal('substring(d, 2)', key, 'phone')})"))
    # valid numbers are 898 areas (001 to 899 but 666) by 99 groups by 9999 serials, and are permuted among themselves
    number = lambda at, n: f"cast(substring({m}, {at}, {n}) as bigint)"
    place = f"(({number(1, 3)} - if({number(1, 3)} > 666, 2, 1)) * 99 + {number(5, 2)} - 1) * 9999 + {number(8, 4)} - 1"
    back = _bind("y", "x div 989901 + 1", "concat_ws('-', lpad(cast(y + if(y >= 666, 1, 0) as string), 3, '0'), lpad(cast(x % 989901 div 9999 + 1 as string), 2, '0'), lpad(cast(x % 9999 + 1 as string), 4, '0'))")
    ssn = f"if({m} rlike '^(?!000|666|9)[0-9]{{3}}-(?!00)[0-9]{{2}}-(?!0000)', {_bind('x', _numeric(place, 898, 989901, key, 'ssn'), back)}, {m})"
    parts = f"transform(split({m}, '[.]'), p -> cast(p as bigint))"
    ip = _bind("o", parts, "if(exists(o, p -> p > 255), " + m + ", " + _bind("n", _numeric("((o[0] * 256 + o[1]) * 256 + o[2]) * 256 + o[3]", 65536, 65536, key, "ipv4"), "concat_ws('.', cast(n div 16777216 as string), cast(n div 65536 % 256 as string), cast(n div 256 % 256 as string), cast(n % 256 as string))") + ")")

    def date(iso: str, shape: str) -> str:
        day = f"datediff(try_to_date({iso}, 'yyyy-MM-dd'), date'{FIRST_DAY}')"
        new = f"replace(date_format(date_add(date'{FIRST_DAY}', cast({_numeric('cast(y as bigint)', DAYS_A, DAYS_B, key, 'date')} as int)), '{shape}'), '-', '#')"
        # the separators are put back as they were
        sep1, sep2 = (f"substring({m}, 5, 1)", f"substring({m}, 8, 1)") if shape.startswith("y") else (f"substring({m}, 3, 1)", f"substring({m}, 6, 1)")
        return _bind("y", day, f"if(y is null or y < 0 or y >= {DAYS_A * DAYS_B}, {m}, " + _bind("f", f"split({new}, '#')", f"concat(f[0], {sep1}, f[1], {sep2}, f[2])") + ")")

    iso = date(f"concat_ws('-', substring({m}, 1, 4), substring({m}, 6, 2), substring({m}, 9, 2))", "yyyy-MM-dd")
    local = date(f"concat_ws('-', substring({m}, 7, 4), substring({m}, 4, 2), substring({m}, 1, 2))", "dd-MM-yyyy")
    mail = f"concat({_classed(f'regexp_replace({m}, {chr(39)}[.][A-Za-z]+$' + chr(39) + f', {chr(39) * 2})', key, 'email')}, '.invalid')"
    return {"email": mail, "secret": _classed(m, key, "secret"), "phone": phone, "ipv4": ip, "ssn": ssn, "iso_date": iso, "date": local}


def _whole(m: str, key: str) -> str:
    # candidates come without their surroundings, so kinds are told by their own characters
    made = _single(m, key)
    return f"""case when instr({m}, '@') > 0 then {made['email']} when {m} rlike '^[0-9A-Fa-f]{{32,}}$' then {made['secret']} when {m} rlike '^[+]' then {made['phone']}
        when {m} rlike '^([0-9]{{1,3}}[.]){{3}}[0-9]{{1,3}}$' then {made['ipv4']} {' '.join(f"when {m} rlike '{shape}' then {made[kind]}" for kind, shape in SHAPES.items())} else {m} end"""


def _literal(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def secret_key(spark: SparkSession, key: str | None = None) -> str:
    """``key``, or the session's. There is no default: who knows the key can undo the permutations."""
    found = key or spark.conf.get(KEY_SETTING, None)
    if not found:
        raise ValueError(f"a secret key is needed: pass one or set {KEY_SETTING}")
    return found.replace("\\", "\\\\").replace("'", "\\'")


def pseudonymise(df: DataFrame, text: str = "text", key: str | None = None, count: str | None = "n_replaced") -> DataFrame:
    """``df`` with valid candidates in ``text`` replaced; ``count`` names a column for their number."""
    key = secret_key(df.sparkSession, key)
    pattern = _literal(ANY)
    found = F.when(F.col(text).rlike(HINT), F.expr(f"regexp_extract_all(`{text}`, {pattern}, 0)")).otherwise(F.when(F.col(text).isNotNull(), F.array().cast("array<string>")))
    made = df.withColumn("__found", found).withColumn("__new", F.expr(f"transform(__found, m -> {pseudonym('m', key)})"))
    changed = made.withColumn("__n", F.expr("aggregate(__new, 0, (n, b) -> n + b.n)"))
    joined = F.expr(f"concat_ws('', zip_with(split(`{text}`, {pattern}, -1), __new, (a, b) -> concat(a, coalesce(b.s, ''))))")
    out = changed.withColumn(text, F.when(F.col("__n") > 0, joined).otherwise(F.col(text)))
    if count:
        out = out.withColumn(count, F.coalesce("__n", F.lit(0)).cast("long"))
    return out.drop("__found", "__new", "__n")
