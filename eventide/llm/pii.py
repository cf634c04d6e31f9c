"""Personal data: format-preserving Feistel pseudonyms, in DataFrame functions only.

Matches of one pattern are taken out of a text, each is permuted by a keyed
Feistel network within its own format, and the text is put together again.  The
permutation works on the characters in place: digits stay digits, Latin letters
stay letters of their case, characters of other scripts stay within their block
of 32 code points, everything else stands still.  Formats with rules are kept
valid: card numbers and IBANs get new check digits (and are only taken for such
where the given ones are right), and dates, phone numbers and social-security
numbers are permuted again until valid (cycle walking, a permutation of the
valid values).  Equal values get equal pseudonyms in every document, so records
stay linked; who has the key can undo them, so it is the caller's secret.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEY_CONF = "spark.eventide.pseudonym.key"    # the session's secret, for callers that name none
ROUNDS = 8
WALK = 64              # cycle-walking steps; each leaves the walk with probability over 0.6
NEAR = 73049           # days of 1900-01-01 to 2099-12-31, which stay among themselves
FAR = 3652059          # days of 0001-01-01 to 9999-12-31

#: Characters that the permutation moves: ASCII letters and digits, all of the other scripts.
MOVES = "A-Za-z0-9\u00C0-\uFEDF\U00010000-\U0010FFFF"
#: What counts as personal data, by kind, first match first.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "secret": r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])"
              r"|(?i:(?<![A-Za-z0-9])(?:password|passwd|pwd|secret|token|api[_-]?key)[ ]?[=:][ ]?[\"']?)"
              rf"(?=[^\s\"'{MOVES}]*+[{MOVES}])[^\s\"']{{6,}}+",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?![0-9]|\.[0-9])",
    "date": r"(?<![0-9/.-])(?:(?!0000)[0-9]{4}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01])"
            r"|(?:(?:0[1-9]|[12][0-9]|3[01])([./])(?:0[1-9]|1[0-2])\1|(?:0[1-9]|1[0-2])([./])(?:1[3-9]|2[0-9]|3[01])\2)"
            r"(?!0000)[0-9]{4})(?![0-9]|[/.-][0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    "card": r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![0-9A-Za-z])"
             r"|(?<![0-9A-Za-z])\+[0-9]{8,14}(?![0-9A-Za-z])",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: A text without these holds no match; most texts end here.
HINT = r"[0-9@]|AKIA|(?i:pass|pwd|secret|token|key)"


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _shift(half: Column, stream: Column, hexa: bool) -> Column:
    """Every digit and letter of ``half`` moved on within its class by the stream's bytes."""
    def move(c, i):
        by, code = F.conv(F.substring(stream, 1 + 4 * F.pmod(i, F.lit(16)), F.lit(4)), 16, 10).cast("int"), F.ascii(c)

        def of(first, size):
            return F.char(F.lit(first) + F.pmod(code - first + by, F.lit(size)))

        if hexa:
            return F.lower(F.hex(F.pmod(F.conv(c, 16, 10).cast("int") + by, F.lit(16))))
        block = code - F.pmod(code, F.lit(32))
        other = F.decode(F.unhex(F.lpad(F.hex(block + F.pmod(code + by, F.lit(32))), 8, "0")), "UTF-32")
        return (F.when(c.between("0", "9"), of(48, 10)).when(c.between("A", "Z"), of(65, 26))
                .when(c.between("a", "z"), of(97, 26))
                .when(code.between(0xC0, 0xFEDF) | (code >= 0x10000), other).otherwise(c))
    return F.when(F.length(half) > 0, F.array_join(F.transform(F.split(half, ""), move), "")).otherwise(F.lit(""))


def feistel(value: Column, kind: str, key: str, hexa: bool = False) -> Column:
    """Keyed permutation of the strings of ``value``'s format; ``hexa``: lower-case hex digits."""
    cut = F.floor(F.length(value) / 2).cast("int")
    start = F.struct(F.substring(value, F.lit(1), cut).alias("a"),
                     F.substring(value, cut + 1, F.length(value)).alias("b"))

    def step(s, r):
        mark = F.concat(F.lit(f"{key}|{kind}|"), r.cast("string"), F.lit("|"))
        moved = let(F.sha2(F.concat(mark, s["b"]), 256), lambda stream: _shift(s["a"], stream, hexa))
        return F.struct(s["b"].alias("a"), moved.alias("b"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda s: F.concat(s["a"], s["b"]))


def _walk(value: Column, valid, permute) -> Column:
    """Permuted until valid again."""
    return F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), permute(value),
                       lambda x, _: F.when(valid(x), x).otherwise(permute(x)))


def digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _refill(shape: Column, new: Column, blank: str = "[^0-9]") -> Column:
    """``shape`` with what is not ``blank`` replaced by the characters of ``new``, in order."""
    return let(new, lambda v: F.array_join(F.transform(F.split(shape, ""), lambda c, i: F.when(
        c.rlike(blank), c).otherwise(F.substring(
            v, F.length(F.regexp_replace(F.substring(shape, F.lit(1), i + 1), blank, "")), F.lit(1)))), ""))


def luhn_digit(payload: Column) -> Column:
    """The check digit that completes ``payload``."""
    def add(total, x):
        d = F.substring(payload, -x, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(F.pmod(x, F.lit(2)) == 1, twice).otherwise(d)
    total = F.aggregate(F.sequence(F.lit(1), F.length(payload)), F.lit(0), add)
    return F.pmod(-total, F.lit(10)).cast("string")


def mod97(s: Column) -> Column:
    """The remainder by 97 of a string of digits and capital letters (A = 10)."""
    def add(rest, c):
        return F.when(c.between("0", "9"), F.pmod(rest * 10 + c.cast("int"), F.lit(97))).otherwise(
            F.pmod(rest * 100 + F.ascii(c) - 55, F.lit(97)))
    return F.aggregate(F.split(s, ""), F.lit(0), add)


def _card(m: Column, key: str) -> Column:
    def renewed(d):
        body = F.substring(d, F.lit(1), F.length(d) - 1)
        head = F.concat(F.substring(d, 1, 1), feistel(F.substring(body, F.lit(2), F.length(body)), "card", key))
        valid = F.substring(d, -1, 1) == let(body, luhn_digit)
        return F.when(valid, _refill(m, let(head, lambda h: F.concat(h, luhn_digit(h))))).otherwise(m)
    return let(digits(m), renewed)


def _iban(m: Column, key: str) -> Column:
    def renewed(flat):
        land = F.substring(flat, 1, 2)

        def checked(body):
            check = F.lpad((98 - mod97(F.concat(body, land, F.lit("00")))).cast("string"), 2, "0")
            return F.concat(land, check, body)
        body = F.substring(flat, F.lit(5), F.length(flat))
        valid = let(body, checked) == flat
        return F.when(valid, _refill(m, let(feistel(body, "iban", key), checked), " ")).otherwise(m)
    return let(F.replace(m, F.lit(" "), F.lit("")), renewed)


def _ip(m: Column, key: str) -> Column:
    flat = F.array_join(F.transform(F.split(m, r"\."), lambda o: F.lower(F.lpad(F.hex(o.cast("int")), 2, "0"))), "")
    return let(feistel(flat, "ip", key, hexa=True), lambda new: F.concat_ws(
        ".", *[F.conv(F.substring(new, 1 + 2 * i, 2), 16, 10) for i in range(4)]))


def _date(m: Column, key: str) -> Column:
    iso = m.contains("-")
    sep = F.substring(m, 3, 1)
    plain = F.when(iso, m).otherwise(F.concat_ws("-", F.substring(m, 7, 4), F.substring(m, 4, 2), F.substring(m, 1, 2)))
    swapped = F.concat_ws("-", F.substring(m, 7, 4), F.substring(m, 1, 2), F.substring(m, 4, 2))
    monthly = ~iso & (F.substring(m, 4, 2) > "12")               # month first, where only that is a date
    near, origin = F.lit("1900-01-01").cast("date"), F.lit("0001-01-01").cast("date")
    skip = F.datediff(near, origin)

    def is_day(d):
        return F.try_to_date(d, "yyyy-MM-dd").isNotNull()

    def written(d):
        y, mm, dd = F.substring(d, 1, 4), F.substring(d, 6, 2), F.substring(d, 9, 2)
        return F.when(iso, d).when(monthly, F.concat(mm, sep, dd, sep, y)).otherwise(F.concat(dd, sep, mm, sep, y))

    def day(start, number):
        return F.date_format(F.date_add(start, number.cast("int")), "yyyy-MM-dd")

    def moved(d):
        at = F.datediff(F.try_to_date(d, "yyyy-MM-dd"), origin)
        inside = at.between(skip, skip + NEAR - 1)
        # days of the two centuries that records mostly name stay there, all others among themselves
        close = _walk(F.lpad((at - skip).cast("string"), 5, "0"), lambda x: x.cast("int") < NEAR,
                      lambda x: feistel(x, "date", key))
        away = _walk(F.lpad(at.cast("string"), 7, "0"), lambda x: (x.cast("int") < FAR) & ~x.cast("int").between(
            skip, skip + NEAR - 1), lambda x: feistel(x, "day", key))
        # a day that no calendar has gets another year that does not have it
        month = F.substring(d, 5, 6)
        year = _walk(F.substring(d, 1, 4), lambda y: ~is_day(F.concat(y, month)) & (y != "0000"),
                     lambda y: feistel(y, "year", key))
        return F.when(inside, day(near, close)).when(at.isNotNull(), day(origin, away)).otherwise(F.concat(year, month))
    return let(let(F.when(monthly, swapped).otherwise(plain), moved), written)


def _phone(m: Column, key: str) -> Column:
    def valid(x):
        return x.rlike("^[2-9]..[2-9]")

    def renewed(d):
        tail = F.substring(d, F.greatest(F.length(d) - 9, F.lit(1)), F.length(d))
        front = F.substring(d, F.lit(1), F.greatest(F.length(d) - 10, F.lit(0)))
        return F.concat(front, F.when(valid(tail) & (F.length(tail) == 10), _walk(
            tail, valid, lambda x: feistel(x, "phone", key))).otherwise(feistel(tail, "phone", key)))
    return _refill(m, let(digits(m), renewed))


def _ssn(m: Column, key: str) -> Column:
    rule = "^(?!000|666|9)[0-9]{3}(?!00)[0-9]{2}(?!0000)[0-9]{4}$"
    return _refill(m, let(digits(m), lambda d: F.when(d.rlike(rule), _walk(
        d, lambda x: x.rlike(rule), lambda x: feistel(x, "ssn", key))).otherwise(feistel(d, "ssn", key))))


def _email(m: Column, key: str) -> Column:
    return F.concat(feistel(F.substring_index(m, "@", 1), "email", key), F.lit("@"),
                    feistel(F.substring_index(F.substring_index(m, "@", -1), ".", 1), "domain", key),
                    F.lit("."), F.regexp_extract(m, r"@[^.]*\.(.*)$", 1))


def _secret(m: Column, key: str) -> Column:
    named = r"^((?i:password|passwd|pwd|secret|token|api[_-]?key)[ ]?[=:][ ]?[\"']?|AKIA)"
    front = F.regexp_extract(m, named, 1)
    return F.concat(front, feistel(F.substring(m, F.length(front) + 1, F.length(m)), "secret", key))


PSEUDONYM = {"email": _email, "secret": _secret, "iban": _iban, "ip": _ip, "date": _date, "ssn": _ssn, "card": _card,
             "phone": _phone}


def pseudonym(match: Column, key: str) -> Column:
    """The pseudonym of one match; its kind is that of the first pattern that fits it whole."""
    out = None
    for kind, pattern in PATTERNS.items():
        fits, new = match.rlike(f"^(?:{pattern})$"), PSEUDONYM[kind](match, key)
        out = F.when(fits, new) if out is None else out.when(fits, new)
    return out.otherwise(match)


def pseudonymised(text: Column, key: str) -> Column:
    """Struct of ``text`` with its personal data replaced and ``n_found`` values replaced; a null text stays null."""
    none = F.array().cast("array<string>")
    found = F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(ANY), 0)).otherwise(none)

    def whole(new):
        return F.array_join(F.transform(F.split(text, ANY, -1), lambda p, i: F.concat(
            p, F.coalesce(F.get(new, i), F.lit("")))), "")

    def changes(matches, new):
        return F.aggregate(F.zip_with(matches, new, lambda a, b: (a != b).cast("long")), F.lit(0).cast("long"),
                           lambda n, x: n + x)

    def renewed(matches):
        made = let(F.transform(matches, lambda m: pseudonym(m, key)),
                   lambda new: F.struct(whole(new).alias("text"), changes(matches, new).alias("n_found")))
        return F.when(F.size(matches) > 0, made).otherwise(F.struct(
            text.alias("text"), F.lit(0).cast("long").alias("n_found")))
    return let(found, renewed)


def session_key(spark: SparkSession) -> str:
    """The session's secret (:data:`KEY_CONF`); where none is set, a random one that the session keeps.

    Pseudonyms are linked across runs only where the same secret is set.
    """
    key = spark.conf.get(KEY_CONF, "")
    if not key:
        key = secrets.token_hex(16)
        spark.conf.set(KEY_CONF, key)
    return key


def replace_pii(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` (all columns, all rows) with ``text`` pseudonymised under the secret ``key``.

    Null and empty texts stay as they are; equal rows give equal rows; an empty
    table gives none.  Other columns, whatever their names, are not touched.
    Numbers whose check digits are wrong are no cards or IBANs and stay.
    """
    return docs.withColumn("text", pseudonymised(docs["text"], key)["text"])


def pii_report(docs: DataFrame, key: str) -> DataFrame:
    """``(doc_id, n_found, text)``: values replaced and pseudonymised text of every row."""
    new = pseudonymised(F.col("text"), key)
    return docs.select("doc_id", new.alias("new")).select("doc_id", "new.n_found", "new.text")
