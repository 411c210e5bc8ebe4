"""Format-preserving Feistel pseudonyms for personal data (operator 5, native).

Card numbers, national numbers, phone numbers, IP addresses and dates are found by pattern,
validated, and replaced by another valid value of the same format: a keyed Feistel network over
exactly the format's values, so equal values get equal pseudonyms in all documents and different
values different ones.  E-mail addresses become keyed addresses in a reserved domain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import free_name, quoted

ROUNDS = 10
#: (kind, pattern), tried in this order at each place.  All are linear in the text: a local part can
#: only start where its run of characters does, and every repeated group is bounded, so that
#: matching neither tries a run from all its places nor recurses along it.
EDGE, STOP = r"(?<![0-9A-Za-z])", r"(?![0-9A-Za-z])"
LOCAL, LABEL = r"[A-Za-z0-9._%+-]", r"[A-Za-z0-9-]{1,63}+"
PATTERNS = (
    ("email", rf"(?<!{LOCAL}){LOCAL}++@{LABEL}(?:\.{LABEL}){{0,126}}\.[A-Za-z]{{2,63}}"),
    ("date", EDGE + r"[0-9]{4}-[0-9]{2}-[0-9]{2}" + STOP),
    ("ssn", EDGE + r"[0-9]{3}-[0-9]{2}-[0-9]{4}" + STOP),
    ("ip", r"(?<![0-9A-Za-z.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9A-Za-z])"),
    ("phone", r"\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}" + STOP),
    ("phone", EDGE + r"(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}" + STOP),
    ("card", EDGE + r"[0-9](?:[ -]?[0-9]){12,18}" + STOP),
)
KINDS = ("email", "date", "ssn", "ip", "phone", "card")
ANY = "|".join(f"(?:{p})" for _, p in PATTERNS)
#: 400 Gregorian years from 1800-01-01 are 146,097 = 27 * 5,411 days.
FIRST_DAY, DAYS = "1800-01-01", (27, 5411)


def _feistel(a: str, b: str, size_a: str, size_b: str, tag: str, key: str) -> str:
    """SQL struct (a, b): a keyed permutation of the pairs below (size_a, size_b)."""
    def f(x: str, size: str) -> str:
        return (f"pmod(cast(conv(substr(sha2(concat_ws('|', '{key}', {tag}, r, {x}), 256), 1, 15), 16, 10) "
                f"as bigint), {size})")
    start = f"named_struct('a', cast({a} as bigint), 'b', cast({b} as bigint))"
    even = f"named_struct('a', (s.a + {f('s.b', size_a)}) % ({size_a}), 'b', s.b)"
    odd = f"named_struct('a', s.a, 'b', (s.b + {f('s.a', size_b)}) % ({size_b}))"
    return f"aggregate(sequence(0, {ROUNDS - 1}), {start}, (s, r) -> if(r % 2 = 0, {even}, {odd}))"


def _permuted_digits(d: str, key: str, tag: str) -> str:
    """SQL text: the digits ``d`` permuted among all strings of that many digits (2 to 18)."""
    u, v = f"(length({d}) div 2)", f"(length({d}) - length({d}) div 2)"
    size_u, size_v = f"cast(pow(10, {u}) as bigint)", f"cast(pow(10, {v}) as bigint)"
    pair = _feistel(f"left({d}, {u})", f"right({d}, {v})", size_u, size_v, f"'{tag}', length({d})", key)
    return (f"element_at(transform(array({pair}), q -> concat(lpad(cast(q.a as string), {u}, '0'), "
            f"lpad(cast(q.b as string), {v}, '0'))), 1)")


def _luhn(d: str, doubled: int) -> str:
    """SQL sum of Luhn's weights; every second digit from the right is doubled, from ``doubled``."""
    x = f"cast(substr(reverse({d}), i, 1) as int)"
    twice = f"if({x} > 4, 2 * {x} - 9, 2 * {x})"
    return f"aggregate(sequence(1, length({d})), 0, (s, i) -> s + if(i % 2 = {doubled}, {twice}, {x}))"


def _into_mask(m: str, digits: str) -> str:
    """SQL text: the digits of ``m`` replaced by ``digits`` in order, all else left."""
    nth = f"length(regexp_replace(substr({m}, 1, i), '[^0-9]', ''))"
    return (f"array_join(transform(sequence(1, length({m})), i -> if(substr({m}, i, 1) rlike '[0-9]', "
            f"substr({digits}, {nth}, 1), substr({m}, i, 1))), '')")


def _replacement(key: str) -> str:
    """SQL struct (kind, text) for the match ``m``; the kind is NULL where it isn't valid."""
    d = "regexp_replace(m, '[^0-9]', '')"
    is_kind = {k: " or ".join(f"m rlike r'^(?:{p})$'" for kind, p in PATTERNS if kind == k) for k in KINDS}
    octets = "transform(split(m, r'[.]'), o -> cast(o as int))"
    area, group, serial = (f"cast(substr({d}, {i}, {n}) as int)" for i, n in ((1, 3), (4, 2), (6, 4)))
    valid = {
        "email": "true",
        "date": f"try_to_date(m, 'yyyy-MM-dd') between date'{FIRST_DAY}' and date'2199-12-31'",
        "ssn": f"{area} not in (0, 666) and {area} < 900 and {group} > 0 and {serial} > 0",
        "ip": f"forall({octets}, o -> o < 256)",
        "phone": f"length({d}) between 7 and 15",
        "card": f"length({d}) between 13 and 19 and {_luhn(d, 0)} % 10 = 0",
    }
    day = f"datediff(to_date(m, 'yyyy-MM-dd'), date'{FIRST_DAY}')"
    a, b = DAYS
    days = _feistel(f"{day} div {b}", f"{day} % {b}", str(a), str(b), "'date'", key)
    place = f"(({area} - 1 - if({area} > 666, 1, 0)) * 99 + {group} - 1)"
    ssn = _feistel(place, f"{serial} - 1", str(898 * 99), "9999", "'ssn'", key)
    new_area = "(q.a div 99 + 1 + if(q.a div 99 >= 665, 1, 0))"
    o = [f"element_at({octets}, {i})" for i in (1, 2, 3, 4)]
    ip = _feistel(f"{o[0]} * 256 + {o[1]}", f"{o[2]} * 256 + {o[3]}", "65536", "65536", "'ip'", key)
    tail = f"right({d}, least(length({d}), 10))"
    phone = f"concat(left({d}, greatest(length({d}) - 10, 0)), {_permuted_digits(tail, key, 'phone')})"
    body = f"left({d}, length({d}) - 1)"
    card = (f"element_at(transform(array({_permuted_digits(body, key, 'card')}), c -> concat(c, "
            f"cast((10 - {_luhn('c', 1)} % 10) % 10 as string))), 1)")

    def once(pair: str, text: str) -> str:
        return f"element_at(transform(array({pair}), q -> {text}), 1)"

    new = {
        "email": f"concat('p', substr(sha2(concat_ws('|', '{key}', 'email', lower(m)), 256), 1, 16), '@example.com')",
        "date": once(days, f"cast(date_add(date'{FIRST_DAY}', cast(q.a * {b} + q.b as int)) as string)"),
        "ssn": once(ssn, f"concat_ws('-', lpad(cast({new_area} as string), 3, '0'), "
                         "lpad(cast(q.a % 99 + 1 as string), 2, '0'), lpad(cast(q.b + 1 as string), 4, '0'))"),
        "ip": once(ip, "concat_ws('.', q.a div 256, q.a % 256, q.b div 256, q.b % 256)"),
        "phone": _into_mask("m", phone),
        "card": once(card, _into_mask("m", "q")),
    }
    rules = " ".join(
        f"when {is_kind[k]} then if({valid[k]}, named_struct('kind', '{k}', 'text', {new[k]}), "
        f"named_struct('kind', cast(null as string), 'text', m))" for k in KINDS)
    return f"case {rules} else named_struct('kind', cast(null as string), 'text', m) end"


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with pseudonyms in ``text``, and the number of replaced values of each kind.

    Whoever has ``key`` (letters and digits) can undo the pseudonyms, so there is no default.  Adds
    n_email, n_date, n_ssn, n_ip, n_phone, n_card (bigint) and keeps every other column and row; where
    ``docs`` has a column of such a name, the count's name gets an underscore before it.  Numbers and
    dates that are not valid (Luhn's digit, calendar, octets) stay as they are, and so do addresses
    with labels beyond 63 or domains beyond 127 labels.  A NULL text stays NULL with counts of 0; rows are
    treated alike however often they repeat.  Very long texts take time in proportion.
    """
    if not key.isalnum():
        raise ValueError("the key must be letters and digits")
    hits, new = free_name("_hits", docs), free_name("_new", docs)
    found = F.when(F.col("text").rlike(r"[0-9@]"), F.regexp_extract_all("text", F.lit(ANY), F.lit(0)))
    rows = docs.withColumn(hits, found).withColumn(
        new, F.expr(f"if(size({hits}) > 0, transform({hits}, m -> {_replacement(key)}), null)"))
    pieces = F.split("text", ANY, -1)
    rebuilt = F.array_join(F.transform(pieces, lambda p, i: F.concat(
        p, F.coalesce(F.get(F.col(new), i)["text"], F.lit("")))), "")
    none = F.col(new).isNull()
    counts = [F.when(none, F.lit(0).cast("bigint")).otherwise(
        F.expr(f"cast(coalesce(size(filter({new}, x -> x.kind = '{k}')), 0) as bigint)"))
        .alias(free_name(f"n_{k}", docs)) for k in KINDS]
    text = F.when(none, F.col("text")).otherwise(rebuilt).alias("text")
    return rows.select(*[text if c == "text" else F.col(q) for c, q in zip(docs.columns, quoted(docs.columns))], *counts)
