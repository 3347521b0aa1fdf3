"""Format-preserving pseudonyms for personal data, in SQL functions only."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: For tests and examples. Give your own secret in production.
TEST_KEY = "not-a-secret"
ROUNDS = 10

OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
MONTH, DAY = "(?:0[1-9]|1[0-2])", "(?:0[1-9]|[12][0-9]|3[01])"
#: Labels of a mail domain. All labels with a dot are taken first; if no last label follows,
#: as at the end of a sentence, some are given back. A domain has at most 127.
LABEL, LAST = r"(?:[A-Za-z0-9-]{1,63}+\.)", "[A-Za-z]{2,24}+(?![A-Za-z0-9-])"
#: Length of an IBAN by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22,
    "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28,
    "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23,
    "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27,
    "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27,
    "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24,
    "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24, "SI": 19,
    "SK": 24, "SM": 27, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}
#: What stands before a secret: the beginning of known kinds of keys, or a label.
KEY_START = (r"(?:(?:sk|pk|rk)_(?:live|test)_|gh[pousr]_|github_pat_|glpat-|xox[abpr]-|npm_|pypi-"
             r"|AKIA|ASIA|AIza|hf_)")
LABELLED = (r"(?i:api[_-]?key|apikey|access[_-]?key|secret[_-]?key|client[_-]?secret|auth[_-]?token"
            r"|token|secret|password|passwd|pwd)[ \t]{0,4}[:=][ \t]{0,4}[\"']?")
#: A labelled secret has a digit, which tells it from a word of prose. What most words lack,
#: a sign behind them or the first two letters of a key, is looked for first.
SECRET = (rf"(?:(?=[A-Za-z_-]{{3,16}}+[ \t]{{0,4}}[:=]){LABELLED}(?=[^0-9\s\"']{{0,127}}[0-9])(?:[A-Za-z0-9+/_=~-]|\.(?=[A-Za-z0-9])){{8,128}}+"
          rf"|(?=[sprgxnhA][kilhopyfKSI]){KEY_START}[A-Za-z0-9_-]{{16,200}}+)")
HEX = "[0-9a-fA-F]{1,4}"


def iban_pattern() -> str:
    """Country, check digits and the rest to the country's length, with or without spaces."""
    by_length: dict[int, list[str]] = {}
    for country, length in IBAN_LENGTHS.items():
        by_length.setdefault(length, []).append(country)
    return "(?:" + "|".join(
        rf"(?:{'|'.join(own)})[0-9]{{2}}(?: ?[A-Z0-9]){{{length - 4}}}(?![0-9A-Za-z])"
        for length, own in sorted(by_length.items())) + ")"


#: What is searched, in order of precedence. Every pattern starts and ends at a boundary
#: and never backs up over a long run, so a search is linear in the text.
PATTERNS = {
    "email": rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}+@(?:{LABEL}++{LAST}|{LABEL}{{1,127}}{LAST})",
    "secret": rf"(?<![0-9A-Za-z]){SECRET}",
    "iban": rf"(?<![0-9A-Za-z])(?=[A-Z]{{2}}[0-9]{{2}}){iban_pattern()}",
    "ipv6": rf"(?<![0-9A-Za-z:])(?={HEX}:)(?:(?:{HEX}:){{7}}{HEX}|(?:{HEX}:){{2,6}}(?::{HEX}){{1,5}})(?![0-9A-Za-z:])",
    "iso_date": rf"(?<![0-9A-Za-z-])(?:19|20)[0-9]{{2}}-{MONTH}-{DAY}(?![0-9A-Za-z-])",
    "dot_date": rf"(?<![0-9A-Za-z.]){DAY}\.{MONTH}\.(?:19|20)[0-9]{{2}}(?![0-9A-Za-z])",
    "slash_date": rf"(?<![0-9A-Za-z/]){MONTH}/{DAY}/(?:19|20)[0-9]{{2}}(?![0-9A-Za-z/])",
    "ssn": r"(?<![0-9A-Za-z-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9A-Za-z-])",
    "phone": r"(?<![0-9A-Za-z])(?:\+1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])",
    "abroad": r"(?<![0-9A-Za-z])\+(?!1[ .(-])[1-9][0-9]{0,2}(?:[ .-]?(?:\([0-9]{1,4}\)|[0-9]{2,5})){2,5}(?![0-9A-Za-z])",
    "ip": rf"(?<![0-9A-Za-z.]){OCTET}(?:\.{OCTET}){{3}}(?![0-9A-Za-z]|\.[0-9])",
    "card": r"(?<![0-9A-Za-z])(?:[0-9]{13,19}+|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5})(?![0-9A-Za-z])",
}
#: Places in the middle of a word, and for numbers all but their first characters, are
#: passed over before any pattern is tried.
WORDS = ("email", "secret", "iban", "ipv6")
ANY = (rf"(?<![0-9A-Za-z])(?:{'|'.join(PATTERNS[name] for name in WORDS)}|(?=[0-9(+])(?:"
       + "|".join(p for name, p in PATTERNS.items() if name not in WORDS) + "))")

#: First and number of days of the permuted calendar: 1900-01-01 to 2099-12-31.
EPOCH, DAYS = "1900-01-01", 73_049


def keyed(key: str, kind: str, number: Column, value: Column) -> Column:
    """A number below 2 ** 60 from the key, the kind, the round and a value."""
    text = F.concat_ws("|", F.lit(key), F.lit(kind), number.cast("string"),
                       value.cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("bigint")


def permuted(key: str, kind: str, value: Column, a: Column | int, b: Column | int) -> Column:
    """A keyed permutation of 0 .. a * b - 1: a Feistel network on (value / b, value % b).

    The halves are added modulo their own size, so any product is a domain and no value
    leaves it.
    """
    a, b = (F.lit(x).cast("bigint") if isinstance(x, int) else x for x in (a, b))
    low = F.pmod(value, b)
    start = F.struct(F.round((value - low) / b).cast("bigint").alias("l"), low.alias("r"),
                     a.alias("a"), b.alias("b"))

    def step(s: Column, i: Column) -> Column:
        odd = i % 2 == 1
        return F.struct(
            F.when(odd, F.pmod(s["l"] + keyed(key, kind, i, s["r"]), s["a"]))
            .otherwise(s["l"]).alias("l"),
            F.when(odd, s["r"]).otherwise(
                F.pmod(s["r"] + keyed(key, kind, i, s["l"]), s["b"])).alias("r"),
            s["a"].alias("a"), s["b"].alias("b"))

    rounds = F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(rounds, start, step, lambda s: s["l"] * s["b"] + s["r"])


def refill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced, in order, by those of ``digits``."""
    gaps = F.split(shape, "[0-9]", -1)
    return F.concat(F.array_join(
        F.zip_with(F.slice(gaps, 1, F.length(digits)), F.split(digits, ""),
                   lambda gap, digit: F.concat(gap, digit)), ""), F.element_at(gaps, -1))


def only_digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def padded(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def luhn_sum(digits: Column, doubled_last: bool) -> Column:
    """Luhn's sum; with ``doubled_last`` the last digit counts double (no check digit)."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda c: c.try_cast("int"))

    def weight(d: Column, i: Column) -> Column:
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when(i % 2 == (0 if doubled_last else 1), twice).otherwise(d)

    return F.aggregate(F.transform(values, weight), F.lit(0), lambda s, d: s + d)


def power_of_ten(exponent: Column) -> Column:
    return F.pow(F.lit(10.0), exponent).cast("bigint")


def card(key: str, text: Column) -> Column:
    """First digit kept, the middle permuted, the check digit computed; else unchanged.

    13 to 19 digits; the middle is two halves of up to nine digits.
    """
    digits = only_digits(text)
    free = F.length(digits) - 2
    small = F.floor(free / 2)
    new = permuted(key, "card", F.substring(digits, F.lit(2), free).try_cast("bigint"),
                   power_of_ten(small), power_of_ten(free - small))
    body = F.concat(F.substring(digits, 1, 1), F.lpad(new.cast("string"), free, F.lit("0")))
    check = ((10 - luhn_sum(body, True) % 10) % 10).cast("string")
    return F.when(luhn_sum(digits, False) % 10 == 0,
                  refill(text, F.concat(body, check))).otherwise(text)


def phone(key: str, text: Column) -> Column:
    """The last ten digits permuted; a country code of 1 stays."""
    digits = only_digits(text)
    value = F.substring(digits, -10, 10).try_cast("bigint")
    number = padded(permuted(key, "phone", value, 10 ** 5, 10 ** 5), 10)
    code = F.when(F.length(digits) > 10, F.substring(digits, 1, 1)).otherwise("")
    return refill(text, F.concat(code, number))


def address(key: str, text: Column) -> Column:
    octets = F.split(text, "[.]")
    value = F.aggregate(octets, F.lit(0).cast("bigint"),
                        lambda s, o: s * 256 + o.try_cast("bigint"))
    new = permuted(key, "ip", value, 65_536, 65_536)
    return F.concat_ws(".", *[
        (F.shiftright(new, 8 * i).bitwiseAND(F.lit(255))).cast("string") for i in (3, 2, 1, 0)])


def social_number(key: str, text: Column) -> Column:
    """Areas 001-899 without 666, groups 01-99 and serials 0001-9999 are the domain."""
    parts = F.transform(F.split(text, "-"), lambda p: p.try_cast("bigint"))
    area = parts[0] - F.when(parts[0] > 666, 2).otherwise(1)
    value = (area * 99 + parts[1] - 1) * 9999 + parts[2] - 1
    new = permuted(key, "ssn", value, 898 * 99, 9999)
    front = F.floor(new / 9999)
    area = F.floor(front / 99)
    area = area + F.when(area >= 665, 2).otherwise(1)
    return F.concat_ws("-", padded(area, 3), padded(front % 99 + 1, 2),
                       padded(new % 9999 + 1, 4))


def date(key: str, text: Column, pattern: str) -> Column:
    """A date that exists goes to another day of the calendar; others stay."""
    day = F.try_to_date(text, pattern)
    value = F.datediff(day, F.lit(EPOCH).cast("date")).cast("bigint")
    new = permuted(key, "date", value, 17, DAYS // 17)
    moved = F.date_format(F.date_add(F.lit(EPOCH).cast("date"), new.cast("int")), pattern)
    return F.coalesce(moved, text)


#: Characters that move among themselves.
CLASSES = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789")
HEX_CLASSES = {"lower": ("0123456789abcdef",), "upper": ("0123456789ABCDEF",)}


def characters(key: str, kind: str, text: Column, classes: tuple[str, ...] = CLASSES) -> Column:
    """A text of the same form: characters move within their class, others stay.

    A Feistel network on the halves of the text; how far a character moves depends on its
    place and the whole other half.
    """
    half = (F.length(text) / 2).cast("int")

    def shifted(part: Column, other: Column, i: Column) -> Column:
        def move(c: Column, at: Column) -> Column:
            by = keyed(key, kind, i, F.concat_ws("|", at.cast("string"), other))
            moved = c
            for own in classes:
                place = F.instr(F.lit(own), c)
                new = F.substring(F.lit(own), F.pmod(place - 1 + by, F.lit(len(own))).cast("int") + 1,
                                  F.lit(1))
                moved = F.when((place > 0) & (c != ""), new).otherwise(moved)
            return moved

        return F.array_join(F.transform(F.split(part, ""), move), "")

    start = F.struct(F.substring(text, F.lit(1), half).alias("l"),
                     F.substring(text, half + 1, F.length(text)).alias("r"))

    def step(s: Column, i: Column) -> Column:
        odd = i % 2 == 1
        return F.struct(
            F.when(odd, shifted(s["l"], s["r"], i)).otherwise(s["l"]).alias("l"),
            F.when(odd, s["r"]).otherwise(shifted(s["r"], s["l"], i)).alias("r"))

    rounds = F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(rounds, start, step, lambda s: F.concat(s["l"], s["r"]))


def hex_or_plain(key: str, kind: str, text: Column) -> Column:
    """Hexadecimal digits stay such, in their case; other texts move by classes."""
    return (F.when(F.rlike(text, F.lit("^[0-9a-f:]+$")),
                   characters(key, kind, text, HEX_CLASSES["lower"]))
            .when(F.rlike(text, F.lit("^[0-9A-F:]+$")),
                  characters(key, kind, text, HEX_CLASSES["upper"]))
            .otherwise(characters(key, kind, text)))


def email(key: str, text: Column) -> Column:
    """The part before @, character by character within its class; the domain stays."""
    return F.concat(characters(key, "email", F.substring_index(text, "@", 1)), F.lit("@"),
                    F.substring_index(text, "@", -1))


def secret(key: str, text: Column) -> Column:
    """The label or the beginning that names the kind stays, the rest moves."""
    start = F.regexp_extract(text, rf"^(?:{LABELLED}|{KEY_START})", 0)
    return F.concat(start, hex_or_plain(
        key, "secret", F.substring(text, F.length(start) + 1, F.length(text))))


def ipv6(key: str, text: Column) -> Column:
    """Hexadecimal digits move, groups and colons stay; small letters unless all are capital."""
    upper = F.rlike(text, F.lit("[A-F]")) & ~F.rlike(text, F.lit("[a-f]"))
    return F.when(upper, characters(key, "ipv6", text, HEX_CLASSES["upper"])).otherwise(
        characters(key, "ipv6", F.lower(text), HEX_CLASSES["lower"]))


def mod97(text: Column) -> Column:
    """Remainder of a text of digits and capitals, a capital being a number from 10 to 35."""
    def add(state: Column, c: Column) -> Column:
        digit = c.try_cast("int")
        return F.when(digit.isNotNull(), (state * 10 + digit) % 97).otherwise(
            (state * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(F.split(text, ""), F.lit(0), add)


def iban(key: str, text: Column) -> Column:
    """Country kept, account moved within character classes, check digits computed.

    Unchanged if its check digits are wrong.
    """
    plain = F.regexp_replace(text, " ", "")
    country, check = F.substring(plain, 1, 2), F.substring(plain, 3, 2)
    account = F.substring(plain, F.lit(5), F.length(plain))
    valid = mod97(F.concat(account, country, check)) == 1
    new = characters(key, "iban", account)
    digits = padded(98 - mod97(F.concat(new, country, F.lit("00"))), 2)
    moved = F.concat(country, digits, new)
    gaps = F.split(text, "[^ ]", -1)
    spaced = F.concat(F.array_join(F.zip_with(
        F.slice(gaps, 1, F.length(moved)), F.split(moved, ""),
        lambda gap, c: F.concat(gap, c)), ""), F.element_at(gaps, -1))
    return F.when(valid, spaced).otherwise(text)


def abroad(key: str, text: Column) -> Column:
    """Country code kept, the digits behind it permuted; unchanged unless 8 to 15 digits.

    The country code is what stands before the first separator, of an unbroken number its
    first two digits.
    """
    digits = only_digits(text)
    lead = F.length(F.regexp_extract(text, "^[+]([0-9]{1,3})[^0-9]", 1))
    lead = F.when(lead > 0, lead).otherwise(2)
    free = F.length(digits) - lead
    small = F.floor(free / 2)
    new = permuted(key, "abroad", F.substring(digits, lead + 1, free).try_cast("bigint"),
                   power_of_ten(small), power_of_ten(free - small))
    number = F.concat(F.substring(digits, F.lit(1), lead),
                      F.lpad(new.cast("string"), free, F.lit("0")))
    return F.when(F.length(digits).between(8, 15), refill(text, number)).otherwise(text)


def pseudonym(key: str, text: Column) -> Column:
    """The pseudonym of one match of ``ANY``."""
    whole = {name: F.rlike(text, F.lit(f"^(?:{p})$")) for name, p in PATTERNS.items()}
    return (F.when(text.contains("@"), email(key, text))
            .when(whole["secret"], secret(key, text))
            .when(whole["iban"], iban(key, text))
            .when(whole["ipv6"], ipv6(key, text))
            .when(whole["iso_date"], date(key, text, "yyyy-MM-dd"))
            .when(whole["dot_date"], date(key, text, "dd.MM.yyyy"))
            .when(whole["slash_date"], date(key, text, "MM/dd/yyyy"))
            .when(whole["ssn"], social_number(key, text))
            .when(whole["phone"], phone(key, text))
            .when(whole["abroad"], abroad(key, text))
            .when(whole["ip"], address(key, text))
            .otherwise(card(key, text)))


def pseudonymize(text: Column, key: str) -> Column:
    """The text with every match replaced; text between matches is untouched.

    Equal values get equal pseudonyms wherever they occur, different ones different
    pseudonyms, and the key's owner can reverse them. Lengths and separators stay, except
    that an IPv4 address may gain or lose digits. Numbers that fail their check (Luhn, mod
    97, calendar, number ranges) are no personal data and stay. An IPv6 address written in
    two ways gets two pseudonyms. A null text stays null.
    """
    def replaced(matches: Column) -> Column:
        gaps = F.split(text, ANY, -1)
        pairs = F.zip_with(F.slice(gaps, 1, F.size(gaps) - 1), matches,
                           lambda gap, m: F.concat(gap, pseudonym(key, m)))
        return F.concat(F.array_join(pairs, ""), F.element_at(gaps, -1))

    # The matches are bound to a name, so a text without any is searched once and not split.
    matches = F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    return F.element_at(F.transform(F.array(matches), lambda found: F.when(
        F.size(found) == 0, text).otherwise(replaced(found))), 1)


def pseudonymize_rows(docs: DataFrame, key: str) -> DataFrame:
    """``docs``, all columns and rows, with ``text`` replaced by its pseudonymized form."""
    return docs.withColumn("text", pseudonymize(F.col("text"), key))
