"""Format-preserving pseudonyms by a keyed Feistel network, in DataFrame functions only.

A text's validated numbers and dates are replaced by values of the same
format: card numbers keep their length, separators and Luhn validity, phone
and social-security numbers and addresses keep their punctuation, dates stay
real dates between 1900 and 2099, bank account numbers (IBAN) keep their
country and their check.  Each replacement is a permutation of its
format's values under the key, so equal values get equal pseudonyms in every
document and different values different ones.  The letters and digits of an
e-mail address's local part are permuted in the same way, each within its own
class, and without regard to case, which is put back in its places.  Ten
unbroken digits are a phone number if area and exchange begin with 2 to 9;
numbers with another country's code keep their first two digits.

The work is one pass over each text, without a shuffle.  Edge cases: a null
text stays null with zero counts; an empty text stays empty; what looks like a
number but fails its check stays as it is; other columns are untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import fresh

ROUNDS = 8
KEY_SETTING = "spark.strata.pii.key"
# For local sessions alone, as in tests: whoever has the key can reverse the pseudonyms.
DEFAULT_KEY = "strata-pii-development-key"


def session_key(spark: SparkSession) -> str:
    """The key from the session's ``KEY_SETTING``; only a local session may leave it unset."""
    key = spark.conf.get(KEY_SETTING, None)
    if not key and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {KEY_SETTING}: pseudonyms under a known key can be reversed")
    return key or DEFAULT_KEY

# Digits as cards are written: unbroken, 4-4-4-4, 4-6-5 and 4-6-4; and what is no part of a card, though it may follow one.
CARD = r"(?:[0-9]{13,19}|[0-9]{4}(?: [0-9]{4}){3}|[0-9]{4}(?:-[0-9]{4}){3}|[0-9]{4} [0-9]{6} [0-9]{4,5}|[0-9]{4}-[0-9]{6}-[0-9]{4,5})(?![0-9])"
OTHER = r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9])|[0-9]{4}[-/.][0-9]{2}[-/.][0-9]{2}(?![0-9])|[0-9]{2}[-/.][0-9]{2}[-/.][0-9]{4}(?![0-9])"
NUMBER = r"(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"
ABROAD = r"\+[2-9][0-9](?:[ .()-]{0,2}[0-9]){6,13}(?![0-9])"
UNBROKEN = r"(?:\+?1)?[2-9][0-9]{2}[2-9][0-9]{6}(?![0-9A-Za-z_]|[ .-][0-9])"
YEAR = "(?:19|20)[0-9]{2}"
# Candidates, tried in this order at each place; look-behinds keep a match from starting inside a longer run.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "phone": rf"(?<![0-9+]){NUMBER}|(?<![0-9A-Za-z+]){ABROAD}|(?<![0-9A-Za-z+_./-]){UNBROKEN}",
    "ssn": r"(?<![0-9])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9])",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9]|\.[0-9])",
    # A date may follow another one behind a hyphen.
    "date": rf"(?:(?<![0-9/.-])|(?<={YEAR}[-/.][0-9]{{2}}[-/.][0-9]{{2}}-)|(?<=[0-9]{{2}}[-/.][0-9]{{2}}[-/.]{YEAR}-))"
            rf"(?:{YEAR}([-/.])[0-9]{{1,2}}\1[0-9]{{1,2}}|[0-9]{{1,2}}([-/.])[0-9]{{1,2}}\2{YEAR})(?![0-9])",
    # Up to six digits may belong to what is written like a card; any other grouping goes on until a card, a date or the like begins.
    "card": rf"(?<![0-9])(?:{CARD}(?:[ -](?!{CARD}|{OTHER}|{NUMBER})[0-9]{{1,6}}(?![0-9A-Za-z_%+@/-]|[.][0-9]))?"
            rf"|[0-9](?:[0-9]|[ -](?!{CARD}|{OTHER})[0-9]){{12,18}}(?![0-9]))",
}
KINDS = tuple(PATTERNS)
ANY = "|".join(PATTERNS.values())
# Dates are permuted within 1900-01-01 to 2099-12-31: a grid that is a little larger is walked until a date comes up.
N_DAYS, DAY_ROWS, DAY_COLUMNS = 73049, 271, 270
WALKS = 32


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _hash(key: Column, *parts: Column) -> Column:
    """Hex digits of a keyed hash (nested as in HMAC, so that no value of the inner one is shown)."""
    inner = F.sha2(F.concat_ws("|", key, *parts).cast("binary"), 256)
    return F.sha2(F.concat_ws("|", key, inner).cast("binary"), 256)


def _permuted(value: Column, left: Column, right: Column, key: Column, kind: str) -> Column:
    """A keyed permutation of 0 .. left * right - 1: the two halves are shifted in turn, by a hash of the other one."""

    def shift(half: Column, size: Column, other: Column, i: Column) -> Column:
        number = F.conv(F.substring(_hash(key, F.lit(kind), i.cast("string"), size.cast("string"), other.cast("string")), 1, 15), 16, 10).cast("bigint")
        return (half + number % size) % size

    def step(s: Column, i: Column) -> Column:
        return F.when(i % 2 == 0, F.struct(shift(s["a"], left, s["b"], i).alias("a"), s["b"].alias("b"))).otherwise(
            F.struct(s["a"].alias("a"), shift(s["b"], right, s["a"], i).alias("b")))

    begin = F.struct(F.floor((value - value % right) / right).cast("bigint").alias("a"), (value % right).alias("b"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), begin, step, lambda s: s["a"] * right + s["b"])


def _long(text: Column) -> Column:
    return text.cast("bigint")


def _power(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, "0").cast("bigint")


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _refilled(match: Column, digits: Column, places: str = "[0-9]") -> Column:
    """``match`` with its digits (or other ``places``) replaced in order by ``digits``."""

    def step(s: Column, c: Column) -> Column:
        digit = c.rlike(places)
        return F.struct(F.concat(s["out"], F.when(digit, F.substring(digits, s["k"] + 1, F.lit(1))).otherwise(c)).alias("out"),
                        (s["k"] + F.when(digit, 1).otherwise(0)).alias("k"))

    return F.aggregate(F.split(match, ""), F.struct(F.lit("").alias("out"), F.lit(0).alias("k")), step, lambda s: s["out"])


def _luhn(digits: Column, doubled: int) -> Column:
    """The Luhn sum; ``doubled`` says whether the last digit (1) or the one before it (0) is the first to be doubled."""

    def step(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 1 - doubled, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), step)


def _card(match: Column, key: Column) -> Column:
    """The part that is written like a card if it passes the Luhn check, else the whole if that does."""

    def valid(text: Column) -> Column:
        n = F.length(_digits(text))
        return n.between(13, 19) & (_luhn(_digits(text), 0) % 10 == 0)

    def replaced(text: Column) -> Column:
        def body(digits: Column) -> Column:
            n = F.length(digits) - 1
            low = F.floor(n / 2).cast("int")
            number = F.lpad(_permuted(_long(F.substring(digits, F.lit(1), n)), _power(n - low), _power(low), key, "card").cast("string"), n, "0")
            return _let(number, lambda d: _refilled(text, F.concat(d, ((10 - _luhn(d, 1) % 10) % 10).cast("string"))))

        return _let(_digits(text), body)

    def parts(head: Column) -> Column:
        n = F.when((head != "") & valid(head), F.length(head)).when(valid(match), F.length(match)).otherwise(0)
        return _let(n, lambda at: F.when(at > 0, F.concat(_let(F.substring(match, F.lit(1), at), replaced), F.substring(match, at + 1, F.length(match)))).otherwise(match))

    return _let(F.regexp_extract(match, f"^{CARD}", 0), parts)


def _phone(match: Column, key: Column) -> Column:
    """The ten digits are permuted as one number; the country code 1 stays, of another country's number the first two digits."""

    def abroad(digits: Column) -> Column:
        n = F.length(digits) - 2
        low = F.floor(n / 2).cast("int")
        mixed = _permuted(_long(F.substring(digits, F.lit(3), n)), _power(n - low), _power(low), key, "phone")
        return _refilled(match, F.concat(F.substring(digits, 1, 2), F.lpad(mixed.cast("string"), n, "0")))

    def home(digits: Column) -> Column:
        value = _long(F.substring(digits, F.length(digits) - 9, F.lit(10)))
        mixed = _permuted(value, F.lit(1000000).cast("bigint"), F.lit(10000).cast("bigint"), key, "phone")
        new = _let(mixed, lambda v: F.lpad(v.cast("string"), 10, "0"))
        return _let(new, lambda d: _refilled(match, F.concat(F.when(F.length(digits) > 10, F.lit("1")).otherwise(F.lit("")), d)))

    return _let(_digits(match), lambda d: F.when(match.rlike("^[+][2-9]"), abroad(d)).otherwise(home(d)))


def _ssn(match: Column, key: Column) -> Column:
    area = _long(F.substring(match, 1, 3))
    value = (((area - F.when(area > 666, 2).otherwise(1)) * 99) + _long(F.substring(match, 5, 2)) - 1) * 9999 + _long(F.substring(match, 8, 4)) - 1
    mixed = _permuted(value, F.lit(898 * 99).cast("bigint"), F.lit(9999).cast("bigint"), key, "ssn")

    def written(v: Column) -> Column:
        area = F.floor(v / (99 * 9999))
        return F.concat_ws("-", F.lpad((area + F.when(area >= 665, 2).otherwise(1)).cast("string"), 3, "0"),
                           F.lpad((F.floor(v / 9999) % 99 + 1).cast("string"), 2, "0"), F.lpad((v % 9999 + 1).cast("string"), 4, "0"))

    return _let(mixed, written)


def _ip(match: Column, key: Column) -> Column:
    value = F.aggregate(F.split(match, "[.]"), F.lit(0).cast("bigint"), lambda v, x: v * 256 + _long(x))
    mixed = _permuted(value, F.lit(65536).cast("bigint"), F.lit(65536).cast("bigint"), key, "ip")
    return _let(mixed, lambda v: F.concat_ws(".", *[F.pmod(F.floor(v / (256 ** k)), F.lit(256)).cast("string") for k in (3, 2, 1, 0)]))


def _date(match: Column, key: Column) -> Column:
    """Year first, else day first, else month first where only that gives a date; the result is written the same way, without zeros if one is left out."""

    def body(p: Column) -> Column:
        def valid(y: Column, m: Column, d: Column) -> Column:
            leap = (y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0))
            last = F.when(m == 2, F.when(leap, 29).otherwise(28)).when(m.isin(4, 6, 9, 11), 30).otherwise(31)
            return (m >= 1) & (m <= 12) & (d >= 1) & (d <= last)

        short = match.rlike("(^|[^0-9])[0-9]([^0-9]|$)")

        def moved(y: Column, m: Column, d: Column, order: str) -> Column:
            index = F.datediff(F.make_date(y, m, d), F.lit("1900-01-01").cast("date")).cast("bigint")
            mix = lambda v: _permuted(v, F.lit(DAY_ROWS).cast("bigint"), F.lit(DAY_COLUMNS).cast("bigint"), key, "date")
            walked = F.aggregate(F.sequence(F.lit(2), F.lit(WALKS)), mix(index), lambda v, i: F.when(v < N_DAYS, v).otherwise(mix(v)))
            at = F.date_add(F.lit("1900-01-01").cast("date"), walked.cast("int"))
            text = F.when(short, F.date_format(at, order.replace("MM", "M").replace("dd", "d"))).otherwise(F.date_format(at, order))
            return _let(text, lambda text: F.replace(text, F.lit("_"), sign))

        sign = F.regexp_extract(match, "([-/.])", 1)
        a, b, c = (F.get(p, k).cast("int") for k in range(3))
        year = F.length(F.get(p, 0)) == 4
        return (F.when(year & valid(a, b, c), moved(a, b, c, "yyyy_MM_dd")).when(~year & valid(c, b, a), moved(c, b, a, "dd_MM_yyyy"))
                .when(~year & valid(c, a, b), moved(c, a, b, "MM_dd_yyyy")).otherwise(match))

    return _let(F.split(match, "[-/.]"), body)


def _scrambled(text: Column, key: Column, kind: str) -> Column:
    """The letters and digits, each within its class; even and odd places are the two halves."""
    alphabets = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789")

    def step(chars: Column, i: Column) -> Column:
        other = F.array_join(F.filter(chars, lambda c, j: j % 2 != i % 2), "")

        def shifted(mask: Column) -> Column:
            def one(c: Column, j: Column) -> Column:
                by = F.conv(F.substring(mask, j % 32 * 2 + 1, F.lit(2)), 16, 10).cast("int")
                out = c
                for letters in alphabets:
                    at = F.instr(F.lit(letters), c)
                    out = F.when(at > 0, F.substring(F.lit(letters), (at - 1 + by) % len(letters) + 1, F.lit(1))).otherwise(out)
                return F.when(j % 2 == i % 2, out).otherwise(c)

            return F.transform(chars, one)

        return _let(_hash(key, F.lit(kind), i.cast("string"), F.size(chars).cast("string"), other), shifted)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), F.split(text, ""), step, lambda s: F.array_join(s, ""))


def _email(match: Column, key: Column) -> Column:
    """The local part in lower case is scrambled; capitals stay in their places."""
    local = F.substring_index(match, "@", 1)
    mixed = F.split(_scrambled(F.lower(local), key, "email"), "")
    cased = F.zip_with(mixed, F.split(local, ""), lambda new, old: F.when(old.rlike("[A-Z]"), F.upper(new)).otherwise(new))
    return F.concat(F.array_join(cased, ""), F.lit("@"), F.substring_index(match, "@", -1))


def _iban(match: Column, key: Column) -> Column:
    """The account part is scrambled and the two check digits are reckoned anew; a last group that is not part of the number stays."""

    def rest(chars: Column) -> Column:
        def step(v: Column, c: Column) -> Column:
            n = F.conv(c, 36, 10).cast("int")
            return (v * F.when(n > 9, 100).otherwise(10) + n) % 97

        return F.aggregate(F.split(chars, ""), F.lit(0), step)

    def moved(chars: Column) -> Column:
        return F.concat(F.substring(chars, F.lit(5), F.length(chars)), F.substring(chars, 1, 4))

    def plain(text: Column) -> Column:
        return F.replace(text, F.lit(" "), F.lit(""))

    def replaced(text: Column) -> Column:
        country = F.substring(text, 1, 2)
        account = _scrambled(_let(plain(text), lambda c: F.substring(c, F.lit(5), F.length(c))), key, "iban")
        return _let(account, lambda a: _refilled(text, F.concat(country, F.lpad((98 - rest(F.concat(a, country, F.lit("00")))).cast("string"), 2, "0"), a), "[A-Z0-9]"))

    def valid(text: Column) -> Column:
        return F.length(plain(text)).between(15, 34) & (_let(moved(plain(text)), rest) == 1)

    shorter = F.regexp_replace(match, " [A-Z0-9]{1,4}$", "")
    return F.when(valid(match), _let(match, replaced)).when(valid(shorter), _let(
        shorter, lambda t: F.concat(replaced(t), F.substring(match, F.length(t) + 1, F.length(match))))).otherwise(match)


def kind_of(match: Column) -> Column:
    """Which pattern a match of them all comes from."""
    return (F.when(F.contains(match, F.lit("@")), "email").when(match.rlike("^[A-Z]"), "iban").when(match.startswith("+"), "phone").when(match.rlike(r"^[0-9]+([.][0-9]+){3}$"), "ip")
            .when(match.rlike(r"^([0-9]{4}([-/.])[0-9]{1,2}\2[0-9]{1,2}|[0-9]{1,2}([-/.])[0-9]{1,2}\3[0-9]{4})$"), "date")
            .when(match.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn")
            .when(F.length(_digits(match)) < 12, "phone").otherwise("card"))


def pseudonym(match: Column, key: Column) -> Column:
    """The pseudonym of one match; a match that fails its validation comes back as it is."""
    rules = {"email": _email, "iban": _iban, "phone": _phone, "ssn": _ssn, "ip": _ip, "date": _date, "card": _card}

    def body(kind: Column) -> Column:
        out = match
        for name, rule in rules.items():
            out = F.when(kind == name, rule(match, key)).otherwise(out)
        return out

    return _let(kind_of(match), body)


def pseudonymise(df: DataFrame, key: str, text_col: str = "text", counts: str = "replaced") -> DataFrame:
    """``df`` with the text's personal values replaced, plus ``counts``: an array of (kind, old length) of the matches in which something was replaced.

    The gaps between matches come from splitting at them, so the text is put
    together again from gaps and pseudonyms in one expression per row.
    """
    (name, work) = fresh(df.columns, counts, "work")
    text, secret = F.col(text_col), F.lit(key)
    found = F.when(text.rlike("[0-9@]"), F.struct(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)).alias("found"), F.split(text, ANY, -1).alias("gaps")))
    pairs = F.transform(F.col(work)["found"], lambda m: F.struct(m.alias("old"), pseudonym(m, secret).alias("new")))
    step = df.withColumn(work, found).withColumn(
        work, F.when(F.size(F.col(work)["found"]) > 0, F.struct(pairs.alias("pairs"), F.col(work)["gaps"].alias("gaps"))))
    rebuilt = F.concat(F.array_join(F.transform(F.col(work)["pairs"], lambda p, i: F.concat(F.get(F.col(work)["gaps"], i), p["new"])), ""),
                       F.element_at(F.col(work)["gaps"], -1))
    kinds = F.transform(F.filter(F.col(work)["pairs"], lambda p: p["old"] != p["new"]),
                        lambda p: F.struct(kind_of(p["old"]).alias("kind"), F.length(p["old"]).alias("length")))
    none = F.array().cast("array<struct<kind: string, length: int>>")
    out = [F.coalesce(rebuilt, text).alias(text_col) if c == text_col else F.col(c) for c in df.columns]
    return step.select(*out, F.coalesce(kinds, none).alias(name))
