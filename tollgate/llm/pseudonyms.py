"""Format-preserving Feistel pseudonyms for personal data, in DataFrame functions only.

Found and checked in whole texts: e-mail addresses, payment card numbers (13 to 19 digits,
Luhn), phone numbers (international or North American form, 10 to 15 digits), IPv4 addresses
(parts up to 255), social security numbers, and calendar dates from 1800 to 2199.  Each
becomes another value of the same format:

* digits and letters: a Feistel network over the two halves of the value.  A round adds to
  every character of a half a keyed SHA-256 stream of the other half, within the
  character's own class (0-9, 2-9 where a leading digit may not be 0 or 1, a-z, A-Z).  This is
  a permutation of the values of one format under the key;
* a card's last digit is computed anew, so it stays valid by Luhn;
* an IPv4 address: two 16-bit halves;
* a date: its day number in the 146097 days from 1800 to 2199, as 189 * 773.

Rounds see only the value without its separators, so "4111 1111 ..." and "4111-1111-..." give
the same digits in either layout, and equal values stay linked across documents.

Defined results: null text stays null and empty text empty; values that fail their check
stay as they are; a null doc_id and repeated rows are passed through; an empty table gives
an empty result; all other columns are kept unchanged (the query returns its own columns).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import let

ROUNDS = 8
#: The session's setting that names the key; whoever has the key can undo the pseudonyms.  The default is for trials alone.
KEY_CONF, KEY = "spark.tollgate.pseudonyms.key", "tollgate-default-key"
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
FIRST_DAY, DAYS_LEFT, DAYS_RIGHT = "1800-01-01", 189, 773

#: A domain has 127 labels at most; without that bound Java recurses once for each, and dotted text would end the task.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*+@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.){1,126}[A-Za-z]{2,}(?![A-Za-z0-9])"
IPV4 = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
DATE = r"(?<![0-9./-])(?:[0-9]{4}[-/.][0-9]{1,2}[-/.][0-9]{1,2}|[0-9]{1,2}[-/.][0-9]{1,2}[-/.][0-9]{4})(?![0-9]|[-/.][0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])"
PHONE = (r"(?<![0-9])(?:\+1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"
         r"|\+(?:[0-9][ .()-]{0,2}){7,14}[0-9](?![0-9])")
CARD_FORMS = r"[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){2}[ -][0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}"
CARD = rf"(?<![0-9])(?:{CARD_FORMS})(?![0-9])"
#: In this order: what one pattern has taken is not looked at by the next.
ANY = "|".join((EMAIL, IPV4, DATE, SSN, CARD, PHONE))


def _chars(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda c: c != "")


def _stream(key: Column, half: Column, n: Column) -> Column:
    """n pseudo-random numbers 0 to 65535 from SHA-256 of key, block and half."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor(n / 16).cast("int")), lambda b: F.sha2(F.concat_ws("|", key, b.cast("string"), half), 256))
    return let(F.array_join(blocks, ""), lambda text: F.transform(
        F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: F.conv(F.substring(text, i * 4 + 1, F.lit(4)), 16, 10).cast("int")))


def _shift(half: Column, classes: Column, stream: Column) -> Column:
    """Each character moved inside its class: 9 digits, 8 digits from 2, a lower case, A upper case."""
    def one(c: Column, k: Column, s: Column) -> Column:
        move = lambda alphabet: F.substring(F.lit(alphabet), F.pmod(F.instr(F.lit(alphabet), c) - 1 + s, F.lit(len(alphabet))) + 1, F.lit(1))
        return F.when(k == "9", move(DIGITS)).when(k == "8", move(DIGITS[2:])).when(k == "a", move(LOWER)).when(k == "A", move(UPPER)).otherwise(c)
    zipped = F.arrays_zip(_chars(half).alias("c"), _chars(classes).alias("k"), stream.alias("s"))
    return F.array_join(F.transform(F.filter(zipped, lambda z: z["c"].isNotNull()), lambda z: one(z["c"], z["k"], z["s"])), "")


def classes_of(value: Column) -> Column:
    alphabet = LOWER + UPPER + DIGITS
    return F.translate(value, alphabet, "a" * 26 + "A" * 26 + "9" * 10)


def feistel(value: Column, classes: Column, key: str) -> Column:
    """Permutes the strings with these character classes; one character alone gets a keyed shift."""
    def halves(x: Column) -> Column:
        cut = F.floor(F.length(x["v"]) / 2).cast("int")
        part = lambda s, a, b: (F.substring(s, F.lit(1), cut).alias(a), F.substring(s, cut + 1, F.length(s)).alias(b))
        return F.struct(*part(x["v"], "l", "r"), *part(x["k"], "kl", "kr"))

    def step(acc: Column, i: Column) -> Column:
        name = F.concat_ws("|", F.lit(key), i.cast("string"), acc["kl"], acc["kr"])
        shifted = lambda a, k, b: _shift(acc[a], acc[k], _stream(name, acc[b], F.length(acc[a])))
        # The halves change places each round, so one expression serves both.
        return F.struct(acc["r"].alias("l"), shifted("l", "kl", "r").alias("r"), acc["kr"].alias("kl"), acc["kl"].alias("kr"))

    start = let(F.struct(value.alias("v"), classes.alias("k")), halves)
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda acc: F.concat(acc["l"], acc["r"]))


def _pairs(left: Column, right: Column, a: int, b: int, key: str, kind: str) -> tuple[Column, Column]:
    """Feistel over numbers (left below a, right below b); returned as a struct of two longs."""
    def step(acc: Column, i: Column) -> Column:
        f = lambda x, m: F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), i.cast("string"), x.cast("string")), 256), 1, 12), 16, 10).cast("long") % m
        return F.when(i % 2 == 0, F.struct(acc["l"].alias("l"), ((acc["r"] + f(acc["l"], b)) % b).alias("r"))).otherwise(
            F.struct(((acc["l"] + f(acc["r"], a)) % a).alias("l"), acc["r"].alias("r")))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), F.struct(left.cast("long").alias("l"), right.cast("long").alias("r")), step)


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def _relay(layout: Column, digits: Column) -> Column:
    """The layout with its digits replaced, in order."""
    return F.array_join(F.transform(_chars(layout), lambda c, i: F.when(c.between("0", "9"), F.substring(
        digits, F.length(_digits(F.substring(layout, F.lit(1), i + 1))), F.lit(1))).otherwise(c)), "")


def luhn_sum(digits: Column, doubled_last: bool) -> Column:
    """Luhn sum; the last digit is doubled if the check digit is yet to come."""
    def value(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = (F.length(digits) - 1 - i) % 2 == (0 if doubled_last else 1)
        return F.when(twice, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)
    return F.aggregate(F.transform(_chars(digits), value), F.lit(0), lambda acc, x: acc + x)


def _card(v: Column, key: str) -> Column:
    def relaid(d: Column) -> Column:
        body = F.substring(d, F.lit(1), F.length(d) - 1)
        whole = let(feistel(body, classes_of(body), f"{key}|card"), lambda new: F.concat(new, F.pmod(-luhn_sum(new, True), F.lit(10)).cast("string")))
        return F.when((luhn_sum(d, False) % 10 == 0) & ~d.rlike("^0+$"), let(whole, lambda w: _relay(v, w)))
    return let(_digits(v), relaid)


def _phone(v: Column, key: str) -> Column:
    """The last ten digits are permuted; area and exchange start with 2 to 9 as before."""
    def relaid(d: Column) -> Column:
        head, tail = F.substring(d, F.lit(1), F.length(d) - 10), F.substring(d, F.length(d) - 9, F.lit(10))
        lead = lambda i: F.when(F.substring(tail, i, 1).between("2", "9"), "8").otherwise("9")
        classes = F.concat(lead(1), F.lit("99"), lead(4), F.lit("999999"))
        return F.when(F.length(d).between(10, 15), let(F.concat(head, feistel(tail, classes, f"{key}|phone")), lambda w: _relay(v, w)))
    return let(_digits(v), relaid)


def _ipv4(v: Column, key: str) -> Column:
    def moved(p: Column) -> Column:
        at = lambda i: F.get(p, F.lit(i))
        octets = lambda n: F.concat_ws(".", *[x.cast("string") for x in (F.floor(n["l"] / 256), n["l"] % 256, F.floor(n["r"] / 256), n["r"] % 256)])
        return F.when(F.forall(p, lambda x: x <= 255), let(_pairs(at(0) * 256 + at(1), at(2) * 256 + at(3), 65536, 65536, key, "ipv4"), octets))
    return let(F.transform(F.split(v, r"\."), lambda x: x.cast("long")), moved)


def _date(v: Column, key: str) -> Column:
    """Year first, else day and month in either order: month first only if the date is valid that way and the separator is /."""
    def make(y: Column, m: Column, d: Column) -> Column:
        return F.when(y.cast("int").between(1800, 2199), F.try_to_date(F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd"))

    def read(p: Column) -> Column:
        at = lambda i: F.get(p, F.lit(i))
        slash, us = F.instr(v, F.lit("/")) > 0, make(at(2), at(0), at(1))
        return (F.when(F.length(at(0)) == 4, F.struct(make(at(0), at(1), at(2)).alias("day"), F.lit("yyyy-M-d").alias("form")))
                .when(slash & us.isNotNull(), F.struct(us.alias("day"), F.lit("M-d-yyyy").alias("form")))
                .otherwise(F.struct(make(at(2), at(1), at(0)).alias("day"), F.lit("d-M-yyyy").alias("form"))))

    def moved(x: Column) -> Column:
        number = F.datediff(x["day"], F.lit(FIRST_DAY).cast("date"))
        to = let(_pairs(F.floor(number / DAYS_RIGHT), number % DAYS_RIGHT, DAYS_LEFT, DAYS_RIGHT, key, "date"),
                 lambda n: F.date_add(F.lit(FIRST_DAY).cast("date"), (n["l"] * DAYS_RIGHT + n["r"]).cast("int")))
        return F.when(x["day"].isNotNull(), let(to, lambda day: written(day, x["form"])))

    def written(day: Column, form: Column) -> Column:
        wide = F.forall(F.split(v, "[-/.]"), lambda y: F.length(y) >= 2)
        pad = lambda c: F.when(wide, F.lpad(c.cast("string"), 2, "0")).otherwise(c.cast("string"))
        sep = F.substring(F.regexp_replace(v, "[0-9]", ""), 1, 1)
        y, m, d = F.year(day).cast("string"), pad(F.month(day)), pad(F.day(day))
        join = lambda *parts: F.concat(parts[0], sep, parts[1], sep, parts[2])
        return F.when(form == "yyyy-M-d", join(y, m, d)).when(form == "M-d-yyyy", join(m, d, y)).otherwise(join(d, m, y))

    return let(F.split(v, "[-/.]"), lambda p: let(read(p), moved))


def _ssn(v: Column, key: str) -> Column:
    """Area, group and serial numbers must be ones that are given out."""
    return let(_digits(v), lambda d: F.when(~d.rlike("^(000|666|9..)") & ~d.rlike("^...00") & ~d.rlike("0000$"),
                                            let(feistel(d, classes_of(d), f"{key}|ssn"), lambda w: _relay(v, w))))


def _email(v: Column, key: str) -> Column:
    """The local part is permuted in its character classes, case aside; the domain stays."""
    low = F.translate(F.substring_index(v, "@", 1), UPPER, LOWER)
    return F.concat(let(low, lambda x: feistel(x, classes_of(x), f"{key}|email")), F.lit("@"), F.substring_index(v, "@", -1))


def kind_of(v: Column) -> Column:
    full = lambda p: v.rlike(f"^(?:{p})$")
    return (F.when(F.instr(v, "@") > 0, "email").when(full(r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}"), "ipv4")
            .when(full(r"[0-9]{4}([-/.])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-/.])[0-9]{1,2}\2[0-9]{4}"), "date")
            .when(full(r"[0-9]{3}-[0-9]{2}-[0-9]{4}"), "ssn")
            .when(full(CARD_FORMS), "card").otherwise("phone"))


def pseudonym(value: Column, key: str = KEY) -> Column:
    """Pseudonym of one found value, or null if it fails its check."""
    return let(kind_of(value), lambda k: F.when(k == "email", _email(value, key)).when(k == "ipv4", _ipv4(value, key)).when(k == "date", _date(value, key))
               .when(k == "ssn", _ssn(value, key)).when(k == "card", _card(value, key)).otherwise(_phone(value, key)))


def pseudonymise(docs: DataFrame, key: str | None = None) -> DataFrame:
    """docs with new text, and n_chars if there is one; adds n_replaced (a column of that name is replaced).
    Without a key, the session's ``KEY_CONF`` gives it.

    A text is cut at the found values; texts without any skip all further work."""
    key = key or docs.sparkSession.conf.get(KEY_CONF, KEY)
    taken = "_" * (1 + max(map(len, docs.columns)))  # longer than any name, so no column has these
    hits, gaps, news = f"{taken}found", f"{taken}gaps", f"{taken}new"
    out = docs.withColumn(hits, F.coalesce(F.regexp_extract_all("text", F.lit(f"({ANY})"), F.lit(1)), F.array().cast("array<string>")))
    some = F.size(hits) > 0
    out = out.withColumn(gaps, F.when(some, F.split("text", ANY, -1)))
    out = out.withColumn(news, F.when(some, F.transform(hits, lambda v: pseudonym(v, key))))
    text = F.array_join(F.transform(gaps, lambda g, i: F.concat(g, F.coalesce(F.get(news, i), F.get(hits, i), F.lit("")))), "")
    out = out.withColumn("text", F.when(some, text).otherwise(F.col("text")))
    out = out.withColumn("n_replaced", F.when(some, F.size(F.filter(news, lambda v: v.isNotNull()))).otherwise(0).cast("long"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(some, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.drop(hits, gaps, news)
