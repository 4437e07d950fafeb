"""Personal data: expressions propose spans, checksums and ranges confirm them, and words nearby
adjust the score. Column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .spans import blotted, count_of, listed, spans
from .text import spare

#: The expressions of the base kinds, possessive where nothing is given back.
EMAIL = (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[ -]?+[0-9])++"
PHONE = r"\+[0-9](?:[ ().-]*+[0-9])++"
#: Further kinds: account numbers (mod 97) and social security numbers (only with context).
IBAN = (r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?+[A-Z0-9]{4}){2,7}+(?: ?+[A-Z0-9]{1,3})?+(?![A-Za-z0-9])")
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
BASE, ADDED = ("email", "ip", "card", "phone"), ("iban", "ssn")
CONTEXT = {
    "email": "mail|contact|write|kontakt|correo|courriel", "ip": "ip|address|host|server|adresse",
    "card": "card|visa|credit|karte|carte|tarjeta", "phone": "phone|call|tel|fax|mobil",
    "iban": "iban|account|bank|konto|compte|cuenta", "ssn": "ssn|social security",
}
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.4, "ssn": 0.4}
NEARBY, ACCEPTED = 0.2, 0.5
#: Lengths of account numbers by country. One of another length, or of another country, is
#: accepted only near a context word, since one run of letters and digits in 97 passes the checksum.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22,
    "DK": 18, "EE": 20, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28,
    "IE": 22, "IL": 23, "IS": 26, "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27,
    "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SA": 24, "SE": 24, "SI": 19,
    "SK": 24, "SM": 27, "TR": 26, "UA": 29,
}
#: What a fitting country and length adds.
FITS = 0.4


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def small_parts(value: Column) -> Column:
    """Whether all parts between dots are at most 255."""
    return F.forall(F.split(value, r"\."), lambda part: F.regexp_replace(
        part, "^0+", "").rlike(r"^(?:25[0-5]|2[0-4][0-9]|1?[0-9]{0,2})$"))


def luhn(digits: Column) -> Column:
    """Whether the digits, every second one from the right doubled, sum to a multiple of ten."""
    places = F.sequence(F.lit(1), F.length(digits))

    def value(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        twice = F.when(d >= 5, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(places, F.lit(0), lambda total, i: total + value(i)) % 10 == 0


def mod97(value: Column) -> Column:
    """Whether the account number, its first four characters moved to the end and letters read as
    10 to 35, leaves 1 modulo 97."""
    plain = F.replace(value, F.lit(" "), F.lit(""))
    moved = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.left(plain, F.lit(4)))
    each = F.transform(F.sequence(F.lit(1), F.length(moved)), lambda i: F.instr(
        F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), F.substring(moved, i, F.lit(1))) - 1)
    return F.aggregate(each, F.lit(0), lambda rest, d: F.when(
        d < 10, rest * 10 + d).otherwise(rest * 100 + d) % 97) == 1


def _fits(value: Column) -> Column:
    """Whether the account number has the length of its country."""
    lengths = F.create_map(*[F.lit(x) for pair in IBAN_LENGTHS.items() for x in pair])
    plain = F.replace(value, F.lit(" "), F.lit(""))
    return F.coalesce(F.try_element_at(lengths, F.left(plain, F.lit(2))) == F.length(plain),
                      F.lit(False))


def _score(kind: str):
    def of(m: Column) -> Column:
        near = F.concat_ws(" ", m["before"], m["after"]).rlike(f"(?i){CONTEXT[kind]}")
        score = F.lit(PRIOR[kind]) + F.when(near, F.lit(NEARBY)).otherwise(F.lit(0.0))
        if kind == "iban":
            score = score + F.when(_fits(m["value"]), F.lit(FITS)).otherwise(F.lit(0.0))
        return score

    return of


def find(text: Column) -> Column:
    """All spans of personal data of a text, by kind and then start; none for a null text.

    Base kinds stay whatever their score; added ones need ``ACCEPTED``.
    """
    digit = text.rlike("[0-9]")

    def n_digits(m: Column, least: int, most: int) -> Column:
        return F.length(_digits(m["value"])).between(least, most)

    def accepted(kind: str):
        return lambda m: _score(kind)(m) >= ACCEPTED

    each = [
        spans(text, "email", EMAIL, F.contains(text, F.lit("@")), lambda m: F.lit(True),
              _score("email")),
        spans(text, "ip", IP, digit, lambda m: small_parts(m["value"]), _score("ip")),
        spans(text, "card", CARD, digit, lambda m: F.when(
            n_digits(m, 16, 19), luhn(_digits(m["value"]))).otherwise(F.lit(False)),
              _score("card")),
        spans(text, "phone", PHONE, F.contains(text, F.lit("+")),
              lambda m: n_digits(m, 8, 15), _score("phone")),
        spans(text, "iban", IBAN, digit, lambda m: mod97(m["value"]) & accepted("iban")(m),
              _score("iban")),
        spans(text, "ssn", SSN, digit, accepted("ssn"), _score("ssn")),
    ]
    return F.concat(*each)


def personal_data(docs: DataFrame, name: str = "__spans") -> DataFrame:
    """All columns of ``docs`` and the spans as ``name``. Every row is searched on its own, so repeated rows
    and null ids change nothing; a null text is empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    plain = spare([*docs.columns, name], "plain")
    return docs.withColumn(plain, text).withColumn(name, find(F.col(plain))).drop(plain)


def op9_pii(spark, sf_dir: str) -> DataFrame:
    """Personal data of every document, and the scores of the spans in the same order."""
    found = personal_data(
        spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    counts = [count_of(F.col("__spans"), kind).alias(f"n_{kind}") for kind in BASE]
    base = F.filter("__spans", lambda s: s["kind"].isin(*BASE))
    scores = F.transform("__spans", lambda s: F.round(s["score"], 2).cast("string"))
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"),
                        listed(F.col("__spans")).alias("spans"),
                        F.array_join(scores, ",").alias("scores"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs``, all columns, with spans of personal data in ``text`` replaced by their kinds. A null
    text stays null."""
    name = spare(docs.columns, "spans")
    return personal_data(docs, name).withColumn("text", blotted(F.col("text"), F.col(name))).drop(name)
