"""Personal data to format-preserving pseudonyms, by a keyed Feistel permutation.

A candidate found by pattern is validated (card: Luhn sum; IBAN: mod 97; IP:
octets; date: calendar; phone: number of digits; social security number: issued
ranges) and split into two halves, numbers below `a` and `b`. Rounds add a keyed
hash of one half to the other, modulo its size, which permutes the `a * b` values
of the format. So a pseudonym is again valid in its format (check digits are
computed anew), different values stay different, and equal values get equal
pseudonyms in every document. Separators stay where they are.

| kind | permuted | kept |
| --- | --- | --- |
| email | the mailbox, to `user` and 12 digits | domain |
| iban | digits of the account | country, letters; check digits anew |
| date | the day, 1900-01-01 to 2099-12-31 | written form |
| ip | all 32 bits | |
| ssn | area, group and serial, over issued ranges | |
| phone | the last 10 digits (8- and 9-digit numbers: all) | country code |
| card | all but the check digit, which is computed anew | length |

A mailbox is free text and has no fixed format; its 40-bit keyed hash is permuted instead.

A run of groups that may hold a card or an IBAN is cut first: every length (of an IBAN, its
country's) is tried from every group border, valid numbers are taken, and the rest is searched for
the other kinds. Of overlapping cards the usual number of digits wins (`CARD_DIGITS`).

Only built-in functions are used. Texts without a digit or `@` are not searched.
Numbers that fail their check are left as they are.

Defined cases: null and empty texts stay as they are with no finds; a null id is
an id like any other; repeated rows stay repeated; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickwatch.llm.common import free_name

#: kind and candidate pattern, tried in this order at every place of the text
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "date": r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9/-])",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?<![A-Za-z0-9+])(?:(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"
    r"|\+[0-9]{1,3}(?:[ .-]?\(?[0-9]{2,4}\)?){2,5}(?![0-9]))",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
}
KINDS = tuple(PATTERNS)
#: runs that may hold IBANs or cards among other groups; these are cut before they are judged
RUNS = PATTERNS | {
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9 ]{10,}[A-Z0-9](?![A-Za-z0-9])",
    "card": r"(?<![0-9])[0-9][0-9 -]{11,}[0-9]",
}
#: characters of an IBAN by country; of a country not listed any length from 15 to 34 is tried
IBAN_LENGTHS = (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 FK18 FO18 "
    "FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 "
    "ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 "
    "ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30"
)
#: of overlapping valid cards the one whose number of digits comes first here is taken
CARD_DIGITS = (16, 15, 14, 13, 19, 18, 17)
ROUNDS = 8
FIRST_DAY, DAYS = "1900-01-01", (17, 4297)  # 17 * 4297 days end on 2099-12-31
_HASH_DIGITS = 15


@dataclass(frozen=True)
class Pseudonyms:
    #: secret of the permutation; the same key links runs, give your own
    key: str = "clickwatch"
    rounds: int = ROUNDS


def _number(digits: Column) -> Column:
    return F.coalesce(F.nullif(digits, F.lit("")), F.lit("0")).cast("long")


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _padded(number: Column, length: Column | int) -> Column:
    length = F.lit(length) if isinstance(length, int) else length
    return F.right(F.concat(F.repeat(F.lit("0"), length), number.cast("string")), length)


def _hash(key: str, kind: str, value: Column) -> Column:
    """A keyed 60-bit hash of the text `value`."""
    digest = F.sha2(F.concat(F.lit(f"{key}:{kind}:"), value).cast("binary"), 256)
    return F.conv(F.substring(digest, 1, _HASH_DIGITS), 16, 10).cast("long")


def feistel(left: Column, right: Column, a: Column, b: Column, kind: str, how: Pseudonyms) -> Column:
    """struct(l, r): the keyed permutation of (left below a, right below b)."""

    def turn(halves: Column, i: Column) -> Column:
        l, r = halves["l"], halves["r"]
        mixed = lambda x: _hash(how.key, kind, F.concat_ws(":", i.cast("string"), a.cast("string"), b.cast("string"), x.cast("string")))
        return F.when(
            i % 2 == 1, F.struct(((l + mixed(r)) % a).alias("l"), r.alias("r"))
        ).otherwise(F.struct(l.alias("l"), ((r + mixed(l)) % b).alias("r")))

    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(how.rounds)), start, turn)


def permuted_digits(digits: Column, kind: str, how: Pseudonyms) -> Column:
    """Another digit text of the same length; of one digit or none, itself."""
    n = F.length(digits)
    half = F.floor(n / 2).cast("int")
    rest = n - half
    power = lambda k: F.pow(F.lit(10.0), k).cast("long")
    out = feistel(
        _number(F.substring(digits, F.lit(1), half)), _number(F.substring(digits, half + 1, rest)), power(half), power(rest), kind, how
    )
    return F.when(n < 2, digits).otherwise(
        F.transform(F.array(out), lambda o: F.concat(_padded(o["l"], half), _padded(o["r"], rest)))[0]
    )


def _refilled(text: Column, digits: Column) -> Column:
    """`text` with its digits replaced, in order, by those of `digits`."""
    at = lambda i: F.length(_digits(F.substring(text, F.lit(1), i + 1)))
    put = lambda c, i: F.when(c.between("0", "9"), F.substring(digits, at(i), F.lit(1))).otherwise(c)
    return F.array_join(F.transform(F.split(text, ""), put), "")


def _luhn(digits: Column) -> Column:
    """The Luhn sum of all digits, the last one undoubled."""
    n = F.length(digits)

    def weigh(c: Column, i: Column) -> Column:
        d = c.cast("int")
        return F.when((n - i) % 2 == 1, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))

    return F.aggregate(F.transform(F.split(digits, ""), weigh), F.lit(0), lambda x, y: x + y)


def _mod97(text: Column) -> Column:
    """Letters as 10..35, the number so written modulo 97."""

    def step(rest: Column, c: Column) -> Column:
        value = F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
        return (rest * F.when(value > 9, 100).otherwise(10) + value) % 97

    return F.aggregate(F.split(text, ""), F.lit(0), step)


def _card_valid(d: Column) -> Column:
    return (_luhn(d) % 10 == 0) & (_number(F.substring(d, F.lit(1), F.lit(9))) > 0)


def _iban_valid(plain: Column) -> Column:
    at = F.position(plain.substr(1, 2), F.lit(IBAN_LENGTHS))
    listed = _number(F.substring(F.lit(IBAN_LENGTHS), at + 2, F.lit(2)))
    fits = F.when(at == 0, F.length(plain).between(15, 34)).otherwise(F.length(plain) == listed)
    return fits & (_mod97(F.concat(F.substring(plain, F.lit(5), F.length(plain) - 4), F.substring(plain, 1, 4))) == 1)


def _cut(m: Column, separators: str, shape: str, lengths: range, rank: Callable[[Column], Column], valid: Callable[[Column], Column]) -> Column:
    """`m` as pieces: every valid number that begins and ends at group borders, and what lies between.

    Of overlapping ones the smallest rank is taken, then the first.
    """
    at = lambda i: F.substring(m, i, F.lit(1))
    border = lambda i: (i < 1) | (i > F.length(m)) | at(i).isin(*separators)
    starts = F.filter(F.sequence(F.lit(1), F.length(m)), lambda i: border(i - 1) & ~border(i))

    def spans(i: Column) -> Column:
        ends = F.filter(F.sequence(i + lengths.start, i + lengths.stop - 1), lambda e: (e <= F.length(m) + 1) & border(e) & ~border(e - 1))
        texts = F.transform(ends, lambda e: F.struct(i.alias("i"), e.alias("e"), F.substring(m, i, e - i).alias("t")))
        shaped = F.filter(texts, lambda x: x["t"].rlike(f"^(?:{shape})$"))
        plain = F.transform(shaped, lambda x: F.struct(x["i"], x["e"], F.translate(x["t"], separators, "").alias("t")))
        good = F.filter(plain, lambda x: valid(x["t"]))
        return F.transform(good, lambda x: F.struct(rank(x["t"]).cast("int").alias("r"), x["i"].alias("i"), x["e"].alias("e")))

    apart = lambda taken, x: ~F.exists(taken, lambda y: (y["i"] < x["e"]) & (x["i"] < y["e"]))
    none = F.array().cast("array<struct<i:int,e:int>>")
    add = lambda taken, x: F.when(apart(taken, x), F.concat(taken, F.array(F.struct(x["i"].alias("i"), x["e"].alias("e"))))).otherwise(taken)
    taken = F.aggregate(F.array_sort(F.flatten(F.transform(starts, spans))), none, add)
    edges = F.flatten(F.transform(taken, lambda x: F.array(x["i"], x["e"])))
    edges = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(1), F.length(m) + 1), edges)))
    return F.transform(F.array(edges), lambda c: F.zip_with(
        F.slice(c, F.lit(1), F.size(c) - 1), F.slice(c, F.lit(2), F.size(c) - 1), lambda i, e: F.substring(m, i, e - i)
    ))[0]


def _iban_pieces(m: Column) -> Column:
    return F.when(m.rlike(f"^(?:{RUNS['iban']})$"), _cut(m, " ", PATTERNS["iban"], range(15, 44), lambda t: -F.length(t), _iban_valid)).otherwise(F.array(m))


def _card_pieces(m: Column) -> Column:
    first = lambda t: F.array_position(F.array(*map(F.lit, CARD_DIGITS)), F.length(t))
    whole = "|".join(f"(?:{PATTERNS[k]})" for k in KINDS if k != "card")
    cut = m.rlike(RUNS["card"]) & ~m.rlike(f"^(?:{whole})$")
    return F.when(cut, _cut(m, " -", PATTERNS["card"], range(13, 38), first, _card_valid)).otherwise(F.array(m))


def _split(m: Column, kinds: tuple[str, ...]) -> Column:
    """A piece that is no number as a whole, split at the numbers of `kinds` in it."""
    others = "|".join(f"(?:{PATTERNS[k]})" for k in kinds)
    whole = "|".join(f"(?:{p})" for p in PATTERNS.values())
    news = F.concat(F.regexp_extract_all(m, F.lit(others), F.lit(0)), F.array(F.lit("")))
    parts = F.flatten(F.zip_with(F.split(m, others, -1), news, lambda p, n: F.array(p, n)))
    return F.when(m.rlike(f"^(?:{whole})$"), F.array(m)).otherwise(parts)


def _card(m: Column, how: Pseudonyms) -> tuple[Column, Column]:
    d = _digits(m)
    body = permuted_digits(F.substring(d, F.lit(1), F.length(d) - 1), "card", how)
    new = F.transform(F.array(body), lambda x: F.concat(x, ((10 - _luhn(F.concat(x, F.lit("0"))) % 10) % 10).cast("string")))[0]
    return _card_valid(d), F.transform(F.array(new), lambda x: _refilled(m, x))[0]


def _phone(m: Column, how: Pseudonyms) -> tuple[Column, Column]:
    d = _digits(m)
    n = F.length(d)
    own = F.least(n, F.lit(10))
    new = F.concat(F.substring(d, F.lit(1), n - own), permuted_digits(F.right(d, own), "phone", how))
    return n.between(8, 15), F.transform(F.array(new), lambda x: _refilled(m, x))[0]


def _ssn(m: Column, how: Pseudonyms) -> tuple[Column, Column]:
    area, group, serial = (F.split_part(m, F.lit("-"), F.lit(i)).cast("int") for i in (1, 2, 3))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    index = F.when(area > 666, area - 2).otherwise(area - 1)  # 898 areas
    out = feistel(index, (group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999), "ssn", how)

    def write(o: Column) -> Column:
        new = F.when(o["l"] >= 665, o["l"] + 2).otherwise(o["l"] + 1)
        return F.concat_ws(
            "-", _padded(new, 3), _padded(F.floor(o["r"] / 9999) + 1, 2), _padded(o["r"] % 9999 + 1, 4)
        )

    return valid, F.transform(F.array(out), write)[0]


def _ip(m: Column, how: Pseudonyms) -> tuple[Column, Column]:
    o = [F.split_part(m, F.lit("."), F.lit(i)).cast("int") for i in (1, 2, 3, 4)]
    valid = (o[0] < 256) & (o[1] < 256) & (o[2] < 256) & (o[3] < 256)
    out = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], F.lit(65536), F.lit(65536), "ip", how)
    write = lambda x: F.concat_ws(".", *[v.cast("string") for h in ("l", "r") for v in (F.floor(x[h] / 256), x[h] % 256)])
    return valid, F.transform(F.array(out), write)[0]


def _date(m: Column, how: Pseudonyms) -> tuple[Column, Column]:
    """ISO dates, dd/mm/yyyy and dd.mm.yyyy; where the day cannot be one, mm/dd/yyyy."""
    iso = m.substr(5, 1) == "-"
    month_first = (m.substr(3, 1) == "/") & (m.substr(4, 2).cast("int") > 12)
    texts = {
        "iso": m,
        "day": F.concat_ws("-", m.substr(7, 4), m.substr(4, 2), m.substr(1, 2)),
        "month": F.concat_ws("-", m.substr(7, 4), m.substr(1, 2), m.substr(4, 2)),
    }
    text = F.when(iso, texts["iso"]).when(month_first, texts["month"]).otherwise(texts["day"])
    day = F.date_diff(F.try_to_date(text, "yyyy-MM-dd"), F.lit(FIRST_DAY).cast("date"))
    a, b = DAYS
    valid = F.coalesce(day.between(0, a * b - 1), F.lit(False))
    out = feistel(F.floor(day / b), day % b, F.lit(a), F.lit(b), "date", how)

    def write(o: Column) -> Column:
        new = F.date_add(F.lit(FIRST_DAY).cast("date"), (o["l"] * b + o["r"]).cast("int")).cast("string")
        y, mo, d, mark = new.substr(1, 4), new.substr(6, 2), new.substr(9, 2), m.substr(3, 1)
        # a month-first date whose new day could be a month is still read as it was written
        return F.when(iso, new).when(month_first, F.concat(mo, mark, d, mark, y)).otherwise(F.concat(d, mark, mo, mark, y))

    return valid, F.transform(F.array(out), write)[0]


def _iban(m: Column, how: Pseudonyms) -> tuple[Column, Column]:
    plain = F.replace(m, F.lit(" "), F.lit(""))
    country, account = plain.substr(1, 2), F.substring(plain, F.lit(5), F.length(plain) - 4)
    valid = _iban_valid(plain)
    new = _refilled(account, permuted_digits(_digits(account), "iban", how))

    def write(x: Column) -> Column:
        check = _padded(98 - _mod97(F.concat(x, country, F.lit("00"))), 2)
        whole = F.concat(country, check, x)
        at = lambda i: F.length(F.replace(F.substring(m, F.lit(1), i + 1), F.lit(" "), F.lit("")))
        put = lambda c, i: F.when(c == " ", c).otherwise(F.substring(whole, at(i), F.lit(1)))
        return F.array_join(F.transform(F.split(m, ""), put), "")

    return valid, F.transform(F.array(new), write)[0]


def _email(m: Column, how: Pseudonyms) -> tuple[Column, Column]:
    mailbox, domain = F.split_part(m, F.lit("@"), F.lit(1)), F.split_part(m, F.lit("@"), F.lit(2))
    hashed = _hash(how.key, "email", F.lower(m))
    out = feistel(hashed % 1_000_000, F.floor(hashed / 1_000_000) % 1_000_000, F.lit(1_000_000), F.lit(1_000_000), "email", how)
    write = lambda o: F.concat(F.lit("user"), _padded(o["l"], 6), _padded(o["r"], 6), F.lit("@"), domain)
    return F.length(mailbox) > 0, F.transform(F.array(out), write)[0]


_OF: dict[str, Callable[[Column, Pseudonyms], tuple[Column, Column]]] = {
    "email": _email, "iban": _iban, "date": _date, "ip": _ip, "ssn": _ssn, "phone": _phone, "card": _card,
}


def _judged(m: Column, how: Pseudonyms) -> Column:
    """struct(kind, text) of one candidate: the first kind whose pattern and check hold, else null and itself."""
    kind, new = F.lit(None).cast("string"), m
    for name in reversed(KINDS):
        valid, pseudonym = _OF[name](m, how)
        fits = m.rlike(f"^(?:{PATTERNS[name]})$") & valid
        kind, new = F.when(fits, F.lit(name)).otherwise(kind), F.when(fits, pseudonym).otherwise(new)
    return F.struct(kind.alias("kind"), new.alias("text"))


def pseudonymised(docs: DataFrame, how: Pseudonyms = Pseudonyms(), text: str = "text") -> DataFrame:
    """`docs` with its texts pseudonymised, and n_<kind>, the finds of every kind.

    A count whose name `docs` already has gets a free name of its own.
    """
    anything = "|".join(f"(?:{p})" for p in RUNS.values())
    candidates, found = free_name(docs, "candidates"), free_name(docs, "found")
    searched = F.when(F.col(text).rlike("[0-9@]"), F.regexp_extract_all(F.col(text), F.lit(anything), F.lit(0)))
    rows = docs.withColumn(candidates, F.transform(F.coalesce(searched, F.array().cast("array<string>")), lambda m: F.array(m)))
    # dates and the like keep their digits from being taken for a card's; phone numbers could be part of one
    fixed, rest = (lambda m: _split(m, ("date", "ip", "ssn"))), (lambda m: _split(m, ("phone",)))
    for pieces_of in (_iban_pieces, fixed, _card_pieces, rest):
        cut = F.transform(F.col(candidates), lambda c: F.flatten(F.transform(c, pieces_of)))
        rows = rows.withColumn(candidates, F.when(F.size(candidates) > 0, cut))
    rows = rows.withColumn(found, F.transform(F.col(candidates), lambda c: F.transform(c, lambda m: _judged(m, how))))
    pieces = F.split(F.col(text), anything, -1)
    news = F.concat(F.transform(F.col(found), lambda c: F.array_join(F.transform(c, lambda x: x["text"]), "")), F.array(F.lit("")))
    new_text = F.array_join(F.zip_with(pieces, news, lambda p, n: F.concat(p, n)), "")

    def count(kind: str) -> Column:
        of_kind = F.size(F.filter(F.flatten(found), lambda x: x["kind"] == kind))
        return F.when(F.col(found).isNull(), F.lit(0)).otherwise(of_kind).cast("long")

    counts = {free_name(docs, f"n_{kind}"): count(kind) for kind in KINDS}
    kept = [
        F.when(F.col(found).isNull(), F.col(c)).otherwise(new_text).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns
    ]
    return rows.select(*kept, *[c.alias(n) for n, c in counts.items()])
