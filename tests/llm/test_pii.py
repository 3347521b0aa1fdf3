import datetime
import hashlib
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from flowlens.llm.pii import DAYS, PATTERNS, ROUNDS, TEST_KEY, permuted, pseudonymize, pseudonymize_rows

KEY = TEST_KEY


def keyed(kind, i, value):
    digest = hashlib.sha256(f"{KEY}|{kind}|{i}|{value}".encode()).hexdigest()
    return int(digest[:15], 16)


def feistel(kind, value, a, b):
    left, right = divmod(value, b)
    for i in range(1, ROUNDS + 1):
        if i % 2:
            left = (left + keyed(kind, i, right)) % a
        else:
            right = (right + keyed(kind, i, left)) % b
    return left * b + right


def luhn(digits):
    return sum(sum(divmod(2 * int(d), 10)) if i % 2 else int(d)
               for i, d in enumerate(reversed(digits))) % 10 == 0


def refill(shape, digits):
    it = iter(digits)
    return re.sub("[0-9]", lambda _: next(it), shape)


def brute_card(text):
    d = re.sub("[^0-9]", "", text)
    if not luhn(d):
        return text
    free = len(d) - 2
    body = d[0] + str(feistel("card", int(d[1:-1]), 10 ** (free // 2), 10 ** (free - free // 2))
                      ).zfill(free)
    return refill(text, body + next(c for c in "0123456789" if luhn(body + c)))


def brute_phone(text):
    d = re.sub("[^0-9]", "", text)
    return refill(text, d[:-10] + str(feistel("phone", int(d[-10:]), 10 ** 5, 10 ** 5)).zfill(10))


def brute_ip(text):
    n = 0
    for part in text.split("."):
        n = n * 256 + int(part)
    n = feistel("ip", n, 65536, 65536)
    return ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))


def brute_date(text, pattern):
    try:
        day = datetime.datetime.strptime(text, pattern).date()
    except ValueError:
        return text
    first = datetime.date(1900, 1, 1)
    new = feistel("date", (day - first).days, 17, DAYS // 17)
    return (first + datetime.timedelta(new)).strftime(pattern)


def brute_ssn(text):
    a, g, s = map(int, text.split("-"))
    n = feistel("ssn", ((a - 1 - (a > 666)) * 99 + g - 1) * 9999 + s - 1, 898 * 99, 9999)
    front, s = divmod(n, 9999)
    a, g = divmod(front, 99)
    return f"{a + 1 + (a >= 665):03}-{g + 1:02}-{s + 1:04}"


LETTERS = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789")


def brute_characters(kind, text, classes=LETTERS):
    half = len(text) // 2

    def shift(part, other, i):
        out = ""
        for at, c in enumerate(part):
            by = keyed(kind, i, f"{at}|{other}")
            own = next((x for x in classes if c in x), None)
            out += own[(own.index(c) + by) % len(own)] if own else c
        return out

    left, right = text[:half], text[half:]
    for i in range(1, ROUNDS + 1):
        if i % 2:
            left = shift(left, right, i)
        else:
            right = shift(right, left, i)
    return left + right


def brute_email(text):
    name, domain = text.split("@")
    return f"{brute_characters('email', name)}@{domain}"


def brute_secret(text):
    m = re.match(r"""(?xi) (?:api[_-]?key | apikey | access[_-]?key | secret[_-]?key | client[_-]?secret
        | auth[_-]?token | token | secret | password | passwd | pwd) [ \t]*[:=][ \t]*["']?
        | (?-i: (?:sk|pk|rk)_(?:live|test)_ | gh[pousr]_ | github_pat_ | glpat- | xox[abpr]- | npm_
        | pypi- | AKIA | ASIA | AIza | hf_ )""", text)
    start, rest = m[0], text[m.end():]
    for own in ("0123456789abcdef", "0123456789ABCDEF"):
        if set(rest) <= set(own + ":"):
            return start + brute_characters("secret", rest, (own,))
    return start + brute_characters("secret", rest)


def brute_ipv6(text):
    if text.upper() == text and text.lower() != text:
        return brute_characters("ipv6", text, ("0123456789ABCDEF",))
    return brute_characters("ipv6", text.lower(), ("0123456789abcdef",))


def number_of(text):
    return int("".join(str(int(c, 36)) for c in text))


def brute_iban(text):
    plain = text.replace(" ", "")
    if number_of(plain[4:] + plain[:4]) % 97 != 1:
        return text
    new = brute_characters("iban", plain[4:])
    moved = iter(plain[:2] + f"{98 - number_of(new + plain[:2] + '00') % 97:02}" + new)
    return re.sub("[^ ]", lambda _: next(moved), text)


def brute_abroad(text):
    d = re.sub("[^0-9]", "", text)
    if not 8 <= len(d) <= 15:
        return text
    m = re.match(r"\+([0-9]{1,3})[^0-9]", text)
    lead = len(m[1]) if m else 2
    free = len(d) - lead
    new = feistel("abroad", int(d[lead:]), 10 ** (free // 2), 10 ** (free - free // 2))
    return refill(text, d[:lead] + str(new).zfill(free))


MOVES = {"email": brute_email, "secret": brute_secret, "iban": brute_iban, "ipv6": brute_ipv6,
         "iso_date": lambda t: brute_date(t, "%Y-%m-%d"),
         "dot_date": lambda t: brute_date(t, "%d.%m.%Y"),
         "slash_date": lambda t: brute_date(t, "%m/%d/%Y"), "ssn": brute_ssn,
         "phone": brute_phone, "abroad": brute_abroad, "ip": brute_ip, "card": brute_card}


def brute(text):
    """Leftmost match of any pattern, the earlier kind first."""
    if text is None:
        return None
    found = {name: re.compile(p) for name, p in PATTERNS.items()}
    out, at = "", 0
    while True:
        best = None
        for name, pattern in found.items():
            m = pattern.search(text, at)
            if m and (best is None or m.start() < best[1].start()):
                best = name, m
        if best is None:
            return out + text[at:]
        name, m = best
        out += text[at:m.start()] + MOVES[name](m[0])
        at = m.end()


TEXTS = [
    "card 4485 9038 9872 5250 and 4122859641637651, 4122859641637652.",
    "7536784127813050 4845168114407329|3782 822463 10005 4000000000006",
    "x9.Y-z_%+q@mail7.example.com, A@b.co; no@domain, @x.org a@@b.com",
    "+1 (743) 555-3824. (012) 555-7713; 743-555-3824 743.555.3824 17435553824",
    "227.5.221.1 256.1.1.1 1.2.3.4.5 1.2.3. 10.0.0.255:80",
    "1985-02-28 1985-02-30 1899-01-01 2099-12-31 12.11.1990 31.04.2000 02/29/2000 02/29/2001",
    "078-05-1120 000-12-1234 665-01-0001 667-99-9999 899-99-9999 900-11-1111",
    "tel:743-555-3824x v1.2.3.4b id4122859641637651", "", " ", "é227.5.221.1é",
    "FR76 3000 6000 0112 3456 7890 189 or +49 30 901820 +4930901820x fe80:1::2:3 token='a1b2c3d4'",
]


def test_equals_brute_force(spark):
    table = spark.createDataFrame([(t,) for t in TEXTS + [None]], "text string")
    rows = table.select("text", pseudonymize(F.col("text"), KEY).alias("new")).collect()
    for r in rows:
        assert r.new == brute(r.text)
    changed = [r for r in rows if r.text != r.new]
    assert len(changed) == 9


SECRETS = ["sk_" + "live_4eC39HqLyjWDarjtT1zdp7dc", "AKIA" + "IOSFODNN7EXAMPLE", "ghp_" + "a1B2" * 9]


def test_ibans_secrets_and_numbers_from_abroad(spark):
    """What must change and what must stay, written by hand."""
    moved = {
        "DE89370400440532013000": brute_iban, "DE89 3704 0044 0532 0130 00": brute_iban,
        "GB29 NWBK 6016 1331 9268 19": brute_iban, "NO9386011117947": brute_iban,
        "MT84MALT011000012345MTLCAST001S": brute_iban, "2001:db8::1": brute_ipv6,
        "2001:0db8:85a3:0000:0000:8a2e:0370:7334": brute_ipv6, "2001:DB8:0::A": brute_ipv6,
        "+49 170 1234567": brute_abroad, "+442079460958": brute_abroad,
        "+33 1 42 68 53 00": None, "+358-40-1234567": brute_abroad, "+34 (91) 123 45 67": brute_abroad,
        'token = "f3ef4d6b2755a36d7d9c25bd72c4d5f67e061fda': brute_secret,
        'TOKEN = "9233A8ECF7C5B09FE5949719B6B82BC439E9329B': brute_secret,
        "password: hunter2-X9": brute_secret, "api_key=abcDEF123456": brute_secret,
        **dict.fromkeys(SECRETS, brute_secret)}
    still = ["DE88370400440532013000", "XX89370400440532013000", "DE8937040044053201300",
             "password: something", "token = x1", "the token of 12345678", "sk_live_short", "12:34:56:78",
             "std::dec", "a:b:c", "1:2:3:4:5:6:7", "+49", "+1234", "ABCD1234567890123456"]
    rows = [(f"so {t}, ({t}) and\n{t}.", f"so {f(t)}, ({f(t)}) and\n{f(t)}.") for t, f in moved.items() if f]
    rows += [(f"so {t}, ({t}) and\n{t};", f"so {t}, ({t}) and\n{t};") for t in still]
    rows += [("DE89 3704 0044 0532 0130 00 ABCD", brute_iban("DE89 3704 0044 0532 0130 00") + " ABCD")]
    table = spark.createDataFrame(rows, "text string, wanted string")
    found = table.select("text", "wanted", pseudonymize(F.col("text"), KEY).alias("new")).collect()
    assert [(r.text, r.new) for r in found if r.new != r.wanted] == []
    for t, f in moved.items():
        if f:
            assert f(t) != t and len(f(t)) == len(t)
        if f is brute_iban:
            plain = f(t).replace(" ", "")
            assert number_of(plain[4:] + plain[:4]) % 97 == 1


def test_addresses_before_dots(spark):
    """Addresses are found by hand here: what may follow one, and long domains."""
    names = ["bob@example.com", "x.Y+7@mail.example.co", "n@" + "a." * 60 + "org"]
    ends = ["", ".", "...", ". Next", ".\n", "\n", ".\t", ".)", ".1", ".x", ". x@", "?", ".-", ".."]
    rows = [(f"to {n}{e}", f"to {brute_email(n)}{e}") for n in names for e in ends]
    rows += [(t, t) for t in ("a@" + "1." * 3000, "a@b.", "a@b.c.", "a@.com.", "@b.com.")]
    rows += [(f"a1@{'1.' * 3000}com", f"{brute_email('a1@x')[:2]}@{'1.' * 3000}com")]
    table = spark.createDataFrame(rows, "text string, wanted string")
    found = table.select("text", "wanted", pseudonymize(F.col("text"), KEY).alias("new")).collect()
    assert [r.text for r in found if r.new != r.wanted] == []


def test_query_equals_brute_force(spark, sf_dir, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    found = entry.queries()["op3_pseudonyms"](spark, sf_dir).collect()
    assert len(found) == len(texts)
    assert {r.doc_id: r.text for r in found} == {i: brute(t) for i, t in texts.items()}
    assert sum(r.text != texts[r.doc_id] for r in found) > 3


@pytest.mark.parametrize("a,b", [(17, 4297), (1, 5), (5, 1), (12, 12)])
def test_permutation(spark, a, b):
    values = spark.range(a * b).select(permuted(KEY, "t", F.col("id"), a, b).alias("v"))
    assert values.distinct().count() == a * b
    assert values.agg(F.min("v"), F.max("v")).first() == (0, a * b - 1)


def test_large_cards_are_exact(spark):
    table = spark.createDataFrame([(10 ** 17 - 1,), (10 ** 17 - 12345,)], "v bigint")
    rows = table.select("v", permuted(KEY, "card", F.col("v"), 10 ** 8, 10 ** 9).alias("n")).collect()
    for r in rows:
        assert r.n == feistel("card", r.v, 10 ** 8, 10 ** 9)


def test_odd_rows(odd_docs):
    new = pseudonymize_rows(odd_docs, KEY)
    assert new.columns == odd_docs.columns
    assert sorted(map(str, new.collect())) == sorted(map(str, odd_docs.collect()))
    assert pseudonymize_rows(odd_docs.limit(0), KEY).collect() == []
