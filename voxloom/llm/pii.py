"""Personal data: patterns propose spans, checksums confirm them, context words adjust a score.

Every pattern proposes candidates; validators (octet range, digit count, Luhn, mod-97, mod-23, mod-11-10, CRC-32,
entropy) drop those that can't be real; kinds whose check many other numbers pass too start below the score that is
asked for, so that words near the span decide. A kind's spans are leftmost and
don't overlap each other; spans of different kinds may. Every scan is linear in the text, whatever it holds.

Defined results: null and empty texts have no spans; repeated rows are judged one by
one; texts are read whole; other columns pass through, and a column of the input named
``spans`` is replaced.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.llm.common import compact, small_batches, table

#: Kinds in the order in which spans at one place are listed.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "mac", "dni", "nir", "steuerid", "secret")
BASE_KINDS = ("email", "ip", "card", "phone")

#: Words near a span that raise (or lower) its score, by kind.
CONTEXT = {
    "email": ("mail", "email", "e-mail", "contact", "write"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "payment"),
    "phone": ("phone", "tel", "telephone", "call", "mobile", "fax"),
    "iban": ("iban", "account", "bank", "konto", "cuenta", "compte"),
    "ssn": ("ssn", "social", "security"),
    "mac": ("mac", "device", "hardware", "ethernet"),
    "dni": ("dni", "nif", "documento", "identidad", "identity"),
    "nir": ("nir", "insee", "sécurité", "sociale", "assuré", "vitale"),
    "steuerid": ("steuer", "steuer-id", "steuerid", "identifikationsnummer", "idnr", "tax"),
    "secret": ("token", "key", "secret", "password", "passwd", "pwd", "bearer", "auth", "credential", "api_key", "apikey", "access_key", "secret_key", "auth_token", "access_token", "private_key"),
}
AGAINST = ("version", "isbn", "order", "invoice", "ticket", "serial", "sku", "part")
#: Score of a confirmed span before its context counts.
PRIOR = {"email": 0.9, "ip": 0.8, "card": 0.9, "phone": 0.8, "iban": 0.95, "ssn": 0.4, "mac": 0.6, "dni": 0.4, "nir": 0.6, "steuerid": 0.3, "secret": 0.4}
CONTEXT_CHARS, STEP, ACCEPT = 48, 0.2, 0.5

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_MAC = re.compile(r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{2}(?::[0-9A-Fa-f]{2}){5}(?![0-9A-Za-z:])")
_DIGIT_RUN = re.compile(r"[0-9]+")
_DNI = re.compile(r"(?<![A-Za-z0-9])[0-9]{8}-?[A-Z](?![A-Za-z0-9])")
_NIR = re.compile(r"(?<![A-Za-z0-9])[12](?:\x20?[0-9]){14}(?![A-Za-z0-9])")
_STEUER = re.compile(r"(?<![A-Za-z0-9])[1-9][0-9](?:\x20?[0-9]){9}(?![A-Za-z0-9])")
_SECRET = re.compile(r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/=-]{20,}+")
#: Letters of the Spanish identity number by its remainder, prefixes of tokens that end in a CRC-32, and the digits of base 62. Fixed values.
DNI_LETTERS = "TRWAGMYFPDXBNJZSQVHLCKE"
SIGNED_PREFIXES = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
#: Longest run that is taken for a key, and least bits a character that one has.
SECRET_CHARS, SECRET_BITS = 512, 3.0
_WORD = re.compile(r"[^\W\d_][\w-]*")


def luhn(digits: str) -> bool:
    """The last digit checks the others: every second from the right doubles."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """ISO 7064: country and check digits moved behind, letters as 10 to 35, remainder 1."""
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def mod11_10(digits: str) -> bool:
    """ISO 7064 mod 11,10 of the German tax number, in whose first ten digits one or two repeat."""
    product = 10
    for c in digits[:-1]:
        product = (int(c) + product) % 10 or 10
        product = product * 2 % 11
    return 7 <= len(set(digits[:-1])) <= 9 and (11 - product) % 10 == int(digits[-1])


def signed(token: str) -> bool:
    """A token whose last six characters are the CRC-32 of those behind its prefix, in base 62."""
    if not token.startswith(SIGNED_PREFIXES) or len(token) != 40:
        return False
    crc, want = zlib.crc32(token[4:-6].encode()), ""
    for _ in range(6):
        crc, rest = divmod(crc, 62)
        want = BASE62[rest] + want
    return want == token[-6:]


def random_like(run: str) -> bool:
    """A run with digits and letters whose characters vary as those of a random key do."""
    if len(run) > SECRET_CHARS or not any(c.isdigit() for c in run) or not any(c.isalpha() for c in run):
        return False
    return -sum(n / len(run) * math.log2(n / len(run)) for n in Counter(run).values()) >= SECRET_BITS


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost spans of four numbers with dots between: every four of a run, which is found once."""
    for run in _DOTTED.finditer(text):
        if "." not in run[0]:
            continue
        at, parts = run.start(), run[0].split(".")
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(n := p.lstrip("0")) <= 3 and int(n or "0") <= 255 for p in four):
                yield at, end
            at = end + 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Same spans as a scan for local part and domain; it starts from each @ instead of each letter."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            yield start, m.end()
            free = m.end()
        at = text.find("@", max(at + 1, free))


def _digits(text: str) -> str:
    return "".join(_DIGIT_RUN.findall(text))


def _proposals(text: str) -> Iterator[tuple[str, int, int]]:
    for s, e in _emails(text):
        yield "email", s, e
    for s, e in _ips(text):
        yield "ip", s, e
    for m in _CARD.finditer(text):
        if 12 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            yield "card", m.start(), m.end()
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                yield "phone", m.start(), m.end()
    for m in _IBAN.finditer(text):
        body = m[0].replace(" ", "")
        if 15 <= len(body) <= 34 and mod97(body):
            yield "iban", m.start(), m.end()
    for m in _SSN.finditer(text):
        yield "ssn", m.start(), m.end()
    if ":" in text:
        for m in _MAC.finditer(text):
            yield "mac", m.start(), m.end()
    for m in _DNI.finditer(text):
        if DNI_LETTERS[int(m[0][:8]) % 23] == m[0][-1]:
            yield "dni", m.start(), m.end()
    for m in _NIR.finditer(text):
        n = _digits(m[0])
        if 97 - int(n[:13]) % 97 == int(n[13:]):
            yield "nir", m.start(), m.end()
    for m in _STEUER.finditer(text):
        if mod11_10(_digits(m[0])):
            yield "steuerid", m.start(), m.end()
    for m in _SECRET.finditer(text):
        if random_like(m[0]):
            yield "secret", m.start(), m.end()


def find(text: str | None) -> list[tuple[str, int, int, float]]:
    """Spans (kind, start, end in code points, score) by start, then kind; base kinds always stay."""
    out = []
    for kind, s, e in _proposals(text or ""):
        near = text[max(0, s - CONTEXT_CHARS) : s] + " " + text[e : e + CONTEXT_CHARS]
        words = {w.lower() for w in _WORD.findall(near)}
        prior = 0.9 if kind == "secret" and signed(text[s:e]) else PRIOR[kind]
        score = prior + STEP * bool(words.intersection(CONTEXT[kind])) - STEP * bool(words.intersection(AGAINST))
        score = round(min(1.0, max(0.0, score)), 2)
        if kind in BASE_KINDS or score >= ACCEPT:
            out.append((kind, s, e, score))
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def redact(text: str | None) -> str | None:
    """The text with each span replaced by its kind in angle brackets; overlapping spans become one."""
    if not text or not (spans := find(text)):
        return text
    out, at = [], 0
    for kind, s, e, _ in spans:
        if s >= at:
            out += [text[at:s], f"<{kind.upper()}>"]
            at = e
        else:
            at = max(at, e)
    return "".join([*out, text[at:]])


SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"


def find_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``spans``, an array of (kind, start, end, score)."""
    small_batches(docs.sparkSession)

    @F.pandas_udf(SPANS)
    def spans(texts: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(("kind", "start", "end", "score"), x, strict=True)) for x in find(t)] for t in texts], dtype=object)

    return docs.withColumn("spans", spans(F.col(f"`{text}`").cast("string")))


def redact_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """Replaces every found span in the text."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("string")
    def redacted(texts: pd.Series) -> pd.Series:
        return pd.Series([redact(t) for t in texts], dtype=object)

    return docs.withColumn(text, redacted(F.col(f"`{text}`").cast("string")))


def digest(spans: list, kinds: tuple[str, ...] = KINDS) -> str:
    return ",".join(f"{x[0]}:{x[1]}:{x[2]}" for x in spans if x[0] in kinds)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: counts of base kinds, digest of base spans, all spans."""
    found = find_pii(compact(table(spark, sf_dir, "documents").select("doc_id", "text"))).select("doc_id", "spans")
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    text = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    base = F.filter("spans", lambda x: x["kind"].isin(*BASE_KINDS))
    return found.select(
        "doc_id",
        *[count(k) for k in BASE_KINDS],
        F.sha2(F.array_join(F.transform(base, text), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", text), ",").alias("spans"),
    )
