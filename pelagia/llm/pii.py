"""Format-preserving pseudonyms by a keyed Feistel network, in SQL functions only.

A value is a row of digits, each in its own base (decimal digit, letter, octet,
day count). Its two halves take turns: the one is shifted, place by place and
modulo its base, by a keyed SHA-256 of the other. That is a permutation of the
format, so equal values get equal pseudonyms in every document, different ones
stay different, and the key holder can undo it.
"""

from __future__ import annotations

import secrets

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagia.llm.scratch import release, short_plans

ROUNDS = 8
#: Session setting that holds the secret key; Spark hides the values of settings named so.
KEY_SETTING = "spark.pelagia.pii.secret"

#: Characters of a bank account number, by country.
ACCOUNTS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_ACCOUNT = "|".join(rf"(?:{names.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]){{{size - 4}}}" for size, names in ACCOUNTS.items())
#: Shapes of candidates, tried in this order at each place.
_SHAPES = (
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9])",
    r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9-])",
    r"(?<![0-9/])[0-9]{4}/[0-9]{2}/[0-9]{2}(?![0-9/])",
    r"(?<![0-9.])[0-9]{2}\.[0-9]{2}\.[0-9]{4}(?!\.?[0-9])",
    r"(?<![0-9/])[0-9]{2}/[0-9]{2}/[0-9]{4}(?![0-9/])",
    r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    r"(?<![0-9-])[0-9]{3}-[0-9]{3}-[0-9]{4}(?![0-9-])",
    r"(?<![0-9A-Za-z])[0-9a-f]{32,64}(?![0-9A-Za-z])",
)
PATTERNS = (
    *_SHAPES[:7],
    rf"(?<![A-Za-z0-9])(?:{_ACCOUNT})(?![A-Za-z0-9])",
    r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    # a run of digit groups, up to a group that begins another shape
    rf"(?<![0-9+.])(?=[0-9](?:[ -]?[0-9]){{12}})(?!{'|'.join(_SHAPES)})[0-9]++(?:[ -](?!{'|'.join(_SHAPES)})[0-9]++)*+",
    _SHAPES[8],
    r"(?<![0-9A-Za-z])\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?(?:[ .-]?[0-9]{2,4}){2,3}(?![0-9])",
    r"(?<![0-9+])\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9])",
    _SHAPES[7],
)
PATTERN = "|".join(f"(?:{p})" for p in PATTERNS)
#: How card numbers are grouped, and how they begin.
USUAL = r"^(?=[3-6]|2[2-7])([0-9]{13,19}|[0-9]{4}([ -][0-9]{4}){3}([ -][0-9]{1,3})?|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5})[ -]?$"
#: A text without one of these holds no candidate.
HINT = r"[0-9][0-9.)(/ -]{0,3}[0-9]|@|[0-9a-f]{32}"


def session_key(spark: SparkSession) -> str:
    """The secret named by ``spark.pelagia.pii.secret``.

    Where it is unset the session gets a random one, so no published value can
    undo the pseudonyms; they then are linked within this session only.
    """
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        key = secrets.token_hex(32)
        spark.conf.set(KEY_SETTING, key)
    return key


def _q(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _key(key: str) -> str:
    """SQL for a key: a text, or, after a NUL, the name of the column that holds it, with what follows the colon."""
    if not key.startswith("\0"):
        return _q(key)
    name, _, use = key[1:].partition(":")
    return f"concat(`{name}`, {_q(':' + use)})"


def _feistel(values: str, bases: str, key: str) -> str:
    """SQL for the permuted array; both arguments are array<bigint> SQL of two places or more."""
    half = f"cast(size({values}) div 2 as int)"
    rest = f"size({values}) - {half}"
    start = f"named_struct('a', slice({values}, 1, {half}), 'b', slice({values}, {half} + 1, {rest}), 'p', slice({bases}, 1, {half}), 'q', slice({bases}, {half} + 1, {rest}))"
    shift = f"cast(conv(substring(sha2(concat_ws(',', {_key(key)}, r, j, array_join(s.b, '.')), 256), 1, 10), 16, 10) as bigint)"
    turn = f"named_struct('a', s.b, 'b', transform(s.a, (x, j) -> pmod(x + {shift}, s.p[j])), 'p', s.q, 'q', s.p)"
    return f"aggregate(sequence(1, {ROUNDS}), {start}, (s, r) -> {turn}, s -> concat(s.a, s.b))"


def _chars(text: str) -> str:
    return f"filter(split({text}, ''), c -> c <> '')"


def _by_class(text: str, key: str) -> str:
    """Permute letters within their case and digits; ``text`` holds nothing else."""
    own = _chars(text)
    first = "ascii(CASE WHEN c rlike '[0-9]' THEN '0' WHEN c rlike '[a-z]' THEN 'a' ELSE 'A' END)"
    values = f"transform({own}, c -> cast(ascii(c) - {first} as bigint))"
    bases = f"transform({own}, c -> cast(if(c rlike '[0-9]', 10, 26) as bigint))"
    return f"array_join(zip_with({_feistel(values, bases, key)}, {own}, (v, c) -> chr({first} + v)), '')"


def _one(char: str, key: str) -> str:
    """One letter or digit, moved within its class; a Feistel network needs two places."""
    first = f"ascii(CASE WHEN {char} rlike '[0-9]' THEN '0' WHEN {char} rlike '[a-z]' THEN 'a' ELSE 'A' END)"
    base = f"if({char} rlike '[0-9]', 10, 26)"
    shift = f"1 + cast(conv(substring(sha2({_key(key)}, 256), 1, 10), 16, 10) as bigint) % ({base} - 1)"
    return f"chr({first} + (ascii({char}) - {first} + {shift}) % {base})"


def _digits(text: str, key: str) -> str:
    values = f"transform({_chars(text)}, c -> cast(c as bigint))"
    return f"array_join({_feistel(values, f'transform({_chars(text)}, c -> 10L)', key)}, '')"


def _refill(shape: str, new: str) -> str:
    """``shape`` with its letters and digits replaced, in order, by the characters of ``new``."""
    step = f"if(c rlike '[0-9A-Za-z]', named_struct('t', concat(s.t, substring({new}, s.k + 1, 1)), 'k', s.k + 1), named_struct('t', concat(s.t, c), 'k', s.k))"
    return f"aggregate({_chars(shape)}, named_struct('t', '', 'k', 0), (s, c) -> {step}, s -> s.t)"


def _luhn(digits: str) -> str:
    """The Luhn sum of a digit string."""
    twice = "if(i % 2 = 1, if(cast(c as int) > 4, 2 * cast(c as int) - 9, 2 * cast(c as int)), cast(c as int))"
    return f"aggregate(transform(reverse({_chars(digits)}), (c, i) -> {twice}), 0, (a, x) -> a + x)"


def _mod97(text: str) -> str:
    step = "if(c rlike '[0-9]', (a * 10 + cast(c as int)) % 97, (a * 100 + ascii(c) - 55) % 97)"
    return f"aggregate({_chars(text)}, 0, (a, c) -> {step})"


def _date(day: str, pattern: str, match: str, key: str) -> str:
    """A valid day from 1900-01-01 on moves within 270 * 271 days (to 2100-05-01)."""
    values = f"array(cast({day} div 271 as bigint), cast({day} % 271 as bigint))"
    new = _feistel(values, "array(270L, 271L)", key)
    return f"transform(array({new}), d -> date_format(date_add(date'1900-01-01', cast(d[0] * 271 + d[1] as int)), {_q(pattern)}))[0]"


def _date_day_first(day: str, key: str) -> str:
    """A valid day after the 12th of its month moves among such days, so it can't be read month first: the permutation is repeated until it meets one."""
    first = f"array(cast({day} div 271 as bigint), cast({day} % 271 as bigint))"
    step = _feistel("v", "array(270L, 271L)", key)
    late = "dayofmonth(date_add(date'1900-01-01', cast(v[0] * 271 + v[1] as int))) > 12"
    new = f"aggregate(sequence(1, 64), transform(array({first}), v -> {step})[0], (v, i) -> if({late}, v, {step}))"
    return f"transform(array({new}), d -> date_format(date_add(date'1900-01-01', cast(d[0] * 271 + d[1] as int)), 'dd/MM/yyyy'))[0]"


def _pseudonym(m: str, key: str) -> str:
    """SQL for the pseudonym of match ``m``; the match itself if it is not valid."""
    number = f"regexp_replace({m}, '[^0-9]', '')"
    cases = []
    # the domain of an address stays; dots and signs of its name stay in place
    name = f"substring_index({m}, '@', 1)"
    bare = f"regexp_replace({name}, '[^0-9A-Za-z]', '')"
    cases.append((f"contains({m}, '@')", f"concat(CASE length({bare}) WHEN 0 THEN {name} WHEN 1 THEN {_refill(name, _one(bare, key + ':mail'))} ELSE {_refill(name, _by_class(bare, key + ':mail'))} END, substring({m}, instr({m}, '@')))"))
    octets = f"transform(split({m}, '[.]'), o -> cast(o as bigint))"
    valid = f"{m} rlike '^[0-9]+([.][0-9]+){{3}}$' and forall(split({m}, '[.]'), o -> length(o) <= 3 and cast(o as int) < 256)"
    cases.append((valid, f"array_join({_feistel(octets, 'array(256L, 256L, 256L, 256L)', key + ':ip')}, '.')"))
    for shape, pattern in ((r"^....-..-..$", "yyyy-MM-dd"), (r"^..../../..$", "yyyy/MM/dd"), (r"^..[.]..[.]....$", "dd.MM.yyyy"), (r"^../../....$", "MM/dd/yyyy")):
        day = f"datediff(cast(try_to_timestamp({m}, {_q(pattern)}) as date), date'1900-01-01')"
        cases.append((f"{m} rlike {_q(shape)} and coalesce({day}, -1) between 0 and 73169", _date(day, pattern, m, key + ":date")))
    day = f"datediff(cast(try_to_timestamp({m}, 'dd/MM/yyyy') as date), date'1900-01-01')"
    cases.append((f"{m} rlike '^../../....$' and coalesce({day}, -1) between 0 and 73169", _date_day_first(day, key + ":date")))
    area, group, serial = (f"cast(split_part({m}, '-', {i}) as bigint)" for i in (1, 2, 3))
    valid = f"{m} rlike '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$' and {area} between 1 and 899 and {area} <> 666 and {group} > 0 and {serial} > 0"
    new = _feistel(f"array({area} - if({area} > 666, 2, 1), {group} - 1, {serial} - 1)", "array(898L, 99L, 9999L)", key + ":ssn")
    cases.append((valid, f"transform(array({new}), v -> format_string('%03d-%02d-%04d', v[0] + if(v[0] >= 665, 2, 1), v[1] + 1, v[2] + 1))[0]"))
    # the longest start of the match, up to a blank, that is an account number
    starts = f"transform(sequence(1, size(split({m}, ' '))), n -> array_join(slice(split({m}, ' '), 1, n), ' '))"
    whole = "regexp_replace(concat(substring(x, 5), substring(x, 1, 4)), ' ', '')"
    account = f"filter({starts}, y -> length(y) > 11 and transform(array(replace(y, ' ', '')), x -> {_mod97(whole)})[0] = 1)"
    body = "substring(replace(y, ' ', ''), 5)"
    moved = _by_class(body, key + ":iban")
    check = f"lpad(cast(98 - {_mod97(f'concat(b, substring(y, 1, 2), {_q("00")})')} as string), 2, '0')"
    iban = f"transform(array({moved}), b -> concat(substring(y, 1, 2), {check}, b))[0]"
    put = f"concat(transform(array({iban}), n -> {_refill('y', 'n')})[0], substring({m}, length(y) + 1))"
    cases.append((f"{m} rlike '^[A-Z]{{2}}[0-9]{{2}}'", f"coalesce(transform(slice(reverse({account}), 1, 1), y -> {put})[0], {m})"))
    nibbles = f"transform({_chars(m)}, c -> cast(conv(c, 16, 10) as bigint))"
    hexed = f"array_join(transform({_feistel(nibbles, f'transform({_chars(m)}, c -> 16L)', key + ':hex')}, v -> lower(hex(v))), '')"
    cases.append((f"{m} rlike '^[0-9a-f]{{32,64}}$'", hexed))
    # the country code of a telephone number stays
    lead = f"regexp_extract({m}, '^[+][0-9]+', 0)"
    tail = f"substring({m}, length({lead}) + 1)"
    own = f"regexp_replace({tail}, '[^0-9]', '')"
    phone = f"concat({lead}, transform(array({_digits(own, key + ':phone')}), n -> {_refill(tail, 'n')})[0])"
    cases.append((f"({m} rlike '^[+(]' or {m} rlike '^[0-9]{{3}}-[0-9]{{3}}-[0-9]{{4}}$') and length({number}) between 7 and 15 and length({own}) > 1", phone))
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in cases) + f" ELSE {m} END"


def _cards(m: str, key: str) -> str:
    """SQL for (t, n): a run of digit groups with its card numbers replaced, and their number.

    At each group the longest card number of whole groups is taken, but none
    that reaches into one written as cards are (``USUAL``).
    """
    number = "regexp_replace(x, '[^0-9]', '')"
    inner = _digits("substring(d, 2, length(d) - 2)", key + ":card")
    card = f"transform(array(concat(substring(d, 1, 1), {inner})), p -> concat(p, cast((10 - {_luhn('concat(p, 0)')} % 10) % 10 as string)))[0]"
    new = f"transform(array({number}), d -> {card})[0]"
    most = "least(19, coalesce(get(filter(u, v -> v > i), 0), size(g) + 1) - i)"
    valid = f"transform(array({number}), d -> length(d) between 13 and 19 and {_luhn('d')} % 10 = 0)[0]"
    at = "transform(sequence(1, {most}), l -> array_join(slice(g, i, l), ''))"
    good = f"transform({at.format(most=most)}, x -> {valid})"
    longest = f"cast(array_position(reverse({good}), true) as int)"
    size = f"if({longest} = 0, 0, {most} - {longest} + 1)"
    put = f"transform(array(array_join(slice(g, i, l), '')), x -> transform(array({new}), n -> {_refill('x', 'n')})[0])[0]"
    found = f"named_struct('t', concat(s.t, {put}), 'n', s.n + 1, 'i', i + l)"
    none = "named_struct('t', concat(s.t, g[i - 1]), 'n', s.n, 'i', i + 1)"
    step = f"if(i < s.i, s, transform(array({size}), l -> if(l > 0, {found}, {none}))[0])"
    start = "named_struct('t', '', 'n', 0, 'i', 1)"
    groups = f"regexp_extract_all({m}, '[0-9]+[ -]?', 0)"
    usual = f"filter(sequence(1, size(g)), i -> exists({at.format(most='least(5, size(g) - i + 1)')}, x -> x rlike {_q(USUAL)} and {valid}))"
    return f"transform(array({groups}), g -> transform(array({usual}), u -> aggregate(sequence(1, size(g)), {start}, (s, i) -> {step}, s -> named_struct('t', s.t, 'n', s.n)))[0])[0]"


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def pseudonymize(docs: DataFrame, *, key: str, text: str = "text", count: str | None = None) -> DataFrame:
    """docs with every validated number, date, address or secret in ``text`` replaced.

    Card numbers keep their first digit and a right Luhn digit, bank account
    numbers their country and right check digits, dates stay valid days,
    network addresses valid octets, telephone numbers their country code and
    punctuation, mail addresses their domain. Numbers that fail validation stay,
    as do those that only stand beside a valid one.
    ``count`` names a column for the number of values replaced. Defined cases:
    null stays null (count 0), empty stays empty, repeated rows are treated
    alike, all other columns pass through, whatever their names; dates of years
    before 1900 or after 2100-05-01 stay.
    """
    short_plans(docs.sparkSession)
    release(docs.sparkSession)
    found, gaps, new, secret = (_free(docs, n) for n in ("_pii_found", "_pii_gaps", "_pii_new", "_pii_secret"))
    columns, given = docs.columns, docs.sparkSession.createDataFrame([(key,)], f"`{secret}` string")
    # the secret comes as data, one row, so no plan, log or user interface shows it
    docs, key = docs.join(F.broadcast(given)), "\0" + secret
    held = F.col(text).rlike(HINT)
    run = "m rlike '^[0-9][0-9 -]*$' and not m rlike '^([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{3}-[0-9]{2}-[0-9]{4}|[0-9]{3}-[0-9]{3}-[0-9]{4}|[0-9]{32,64})$'"
    other = f"transform(array({_pseudonym('m', key)}), t -> named_struct('t', t, 'n', if(t <> m, 1, 0)))[0]"
    new_one = f"if({run}, {_cards('m', key)}, {other})"
    rows = docs.withColumn(found, F.when(held, F.expr(f"regexp_extract_all(`{text}`, {_q(PATTERN)}, 0)")))
    rows = rows.withColumn(new, F.expr(f"transform({found}, m -> {new_one})"))
    some = F.coalesce(F.size(found), F.lit(0)) > 0
    rows = rows.withColumn(gaps, F.when(some, F.expr(f"split(`{text}`, {_q(PATTERN)}, -1)")))
    joined = F.expr(f"array_join(transform({gaps}, (g, i) -> if(i < size({new}), concat(g, {new}[i].t), g)), '')")
    out = {text: F.when(some, joined).otherwise(F.col(text))}
    if count:
        out[count] = F.when(some, F.expr(f"aggregate({new}, 0, (a, x) -> a + x.n)")).otherwise(0).cast("long")
    return rows.withColumns(out).select(*(f"`{c}`" for c in columns), *([count] if count else []))
