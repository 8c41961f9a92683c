"""Personal data by anchor expansion.

One Aho-Corasick pass finds anchors: at-signs, plus signs, ``://``, digits
and identifier cues.  A deterministic local parser expands each anchor to its
boundaries and validates it.  Every kind keeps the position up to which its
text is used, so spans of a kind never overlap and each character is parsed a
bounded number of times, whatever the length of the text.

Base kinds (leftmost, non-overlapping, failing matches dropped):

* ``email``: local part, ``@``, at least two dotted labels;
* ``ip``: four dotted numbers of at most 255;
* ``card``: digits with single blanks or hyphens, 14 to 19 of them, Luhn;
* ``phone``: ``+`` and 10 to 15 digits with blanks, brackets, dots, hyphens.

Added kinds: ``url`` (around ``://`` or from ``www.``), ``iban`` (after a cue, the
length of its country, mod-97), ``account`` (an identifier after a cue such as
"account" or "passport") and ``secret`` (a value after "token", "password", "api
key", or a key of a known provider by its prefix).  Cues match in any case.  A
value holds a digit; after a secret's cue and ``:`` or ``=`` twelve letters do.
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardpulse.llm.common import arrow_map

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("url", "iban", "account", "secret")
KINDS = BASE_KINDS + ADDED_KINDS

#: Identifier cues and the kind that their value gets (fixed values).
CUES = {
    "account": "account", "acct": "account", "konto": "account", "cuenta": "account", "compte": "account",
    "kontonummer": "account", "kundennummer": "account", "customer id": "account", "user id": "account", "member id": "account",
    "passport": "account", "ssn": "account", "social security": "account", "tax id": "account", "routing": "account", "iban": "iban",
    "access key": "secret", "access_key": "secret", "private key": "secret", "private_key": "secret", "bearer": "secret", "pwd": "secret",
    "passwort": "secret", "kennwort": "secret", "contraseña": "secret", "mot de passe": "secret",
    "token": "secret", "secret": "secret", "password": "secret", "passwd": "secret", "api_key": "secret", "api key": "secret", "apikey": "secret",
}

#: Key prefixes of providers and the shape of the whole key (fixed values).
KEYS = {
    "AKIA": r"AKIA[0-9A-Z]{16}", "ASIA": r"ASIA[0-9A-Z]{16}", "AIza": r"AIza[0-9A-Za-z_-]{35}",
    "ghp_": r"ghp_[0-9A-Za-z]{36,}", "gho_": r"gho_[0-9A-Za-z]{36,}", "ghs_": r"ghs_[0-9A-Za-z]{36,}", "github_pat_": r"github_pat_[0-9A-Za-z_]{22,}",
    "glpat-": r"glpat-[0-9A-Za-z_-]{20,}", "sk_live_": r"sk_live_[0-9A-Za-z]{16,}", "rk_live_": r"rk_live_[0-9A-Za-z]{16,}",
    "xoxb-": r"xoxb-[0-9A-Za-z-]{10,}", "xoxp-": r"xoxp-[0-9A-Za-z-]{10,}", "xoxa-": r"xoxa-[0-9A-Za-z-]{10,}",
}
#: Length of an account number by country (fixed values).
IBAN_LENGTH = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "CH": 21, "CR": 22, "CY": 28, "CZ": 24,
    "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27,
    "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LI": 21, "LT": 20,
    "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29,
    "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "XK": 20,
}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])*")
_DIAL = re.compile(r"\+[0-9][ ().0-9-]+")
_LINK = re.compile(r"[A-Za-z0-9\[][^\s<>\"'`{}|\\^]*")
_GIVEN = re.compile(r"(?:[ \t]*(?:number|no|nr|is)\b\.?)?[ \t]*[:=#]?[ \t]*[\"']?", re.IGNORECASE)
_VALUE = re.compile(r"[A-Za-z0-9][A-Za-z0-9_-]{5,}")
_WORDY = re.compile(r"[A-Za-z0-9_!#$%&*+.?@^~-]{12,}")
_IBAN = {n: re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){%d}(?![A-Za-z0-9])" % (n - 4)) for n in set(IBAN_LENGTH.values())}
_KEY = {prefix.lower(): re.compile(shape + r"(?![0-9A-Za-z])") for prefix, shape in KEYS.items()}
_ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def automaton() -> ahocorasick.Automaton:
    """Anchors of a lower-cased text."""
    a = ahocorasick.Automaton()
    for d in "0123456789":
        a.add_word(d, ("digit", 1))
    a.add_word("@", ("at", 1))
    a.add_word("+", ("plus", 1))
    a.add_word("://", ("scheme", 3))
    for cue, kind in CUES.items():
        a.add_word(cue, (kind, len(cue)))
    a.add_word("www.", ("www", 4))
    for prefix in _KEY:
        a.add_word(prefix, ("key", len(prefix)))
    a.make_automaton()
    return a


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def folded(text: str) -> str:
    """The text in lower case, code point by code point, so that offsets stay."""
    low = text.lower()
    return low if len(low) == len(text) else text.translate(_ASCII_LOWER)


def iban_valid(text: str) -> bool:
    s = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def find(text: str | None, anchors: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """(start, kind index, end) in code points, sorted; [] for null or empty text."""
    spans: list[tuple[int, int, int]] = []
    if not text:
        return spans
    used = dict.fromkeys((*KINDS, "value"), 0)
    add = lambda kind, start, end: spans.append((start, KINDS.index(kind), end))
    for last, (anchor, width) in anchors.iter(folded(text)):
        at = last - width + 1
        if anchor == "digit":
            if at >= used["card"]:
                m = _DIGITS.match(text, at)
                used["card"] = m.end()
                if m.end() - at >= 14:
                    digits = m.group().replace(" ", "").replace("-", "")
                    if 14 <= len(digits) <= 19 and luhn(digits):
                        add("card", at, m.end())
            if at >= used["ip"]:
                m = _DOTTED.match(text, at)
                used["ip"] = m.end()
                parts = m.group().split(".")
                pos = at
                for i in range(0, len(parts) - 3, 4):
                    four = parts[i:i + 4]
                    end = pos + len(".".join(four))
                    if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in four):
                        add("ip", pos, end)
                    pos = end + 1
        elif anchor == "at":
            m = _DOMAIN.match(text, at + 1)
            if m:
                start = at
                while start > used["email"] and text[start - 1] in _LOCAL:
                    start -= 1
                if start < at:
                    add("email", start, m.end())
                    used["email"] = m.end()
        elif anchor == "plus":
            m = _DIAL.match(text, at) if at >= used["phone"] else None
            if m:
                body = m.group().rstrip(" ().-")
                if len(body) >= 4:
                    used["phone"] = at + len(body)
                    if 10 <= sum(c.isdigit() for c in body) <= 15:
                        add("phone", at, at + len(body))
        elif anchor == "scheme":
            m = _LINK.match(text, at + 3)
            start = at
            while start > used["url"] and text[start - 1] in _SCHEME:
                start -= 1
            if m and start < at and text[start].isalpha():
                end = at + 3 + len(m.group().rstrip(".,;:!?)]"))
                if end > at + 3:
                    add("url", start, end)
                    used["url"] = end
        elif anchor == "www":
            m = _LINK.match(text, last + 1)
            if m and at >= used["url"] and not (at and text[at - 1] in _LOCAL):
                end = last + 1 + len(m.group().rstrip(".,;:!?)]"))
                if "." in text[last + 1:end]:
                    add("url", at, end)
                    used["url"] = end
        elif anchor == "key":
            m = _KEY[text[at:last + 1].lower()].match(text, at)
            if m and at >= used["value"] and not (at and text[at - 1].isalnum()):
                add("secret", at, m.end())
                used["value"] = m.end()
        elif at >= used["value"] and not (at and text[at - 1].isalnum()):
            start = _GIVEN.match(text, last + 1).end()
            if start == last + 1:
                continue  # the cue is part of a longer word
            length = IBAN_LENGTH.get(text[start:start + 2]) if anchor == "iban" else None
            m = _IBAN[length].match(text, start) if length else None
            if m and iban_valid(m.group()):
                add("iban", start, m.end())
                used["value"] = m.end()
                continue
            m = _VALUE.match(text, start)
            if anchor == "secret" and text[last + 1:start].strip(" \t\"'").endswith((":", "=")):
                m = _WORDY.match(text, start) or m
                sure = m and (len(m.group()) >= 12)
            else:
                sure = False
            if m and (sure or any(c in "0123456789" for c in m.group())):
                add("account" if anchor == "iban" else anchor, start, m.end())
                used["value"] = m.end()
    spans.sort()
    return spans


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def redact(text: str | None, spans: list[tuple[int, int, int]]) -> str | None:
    """Each span becomes ``[KIND]``; spans that overlap become one, named after the first."""
    if not spans:
        return text
    out, at, open_until = [], 0, -1
    for start, kind, end in spans:
        if start >= open_until:
            out += [text[max(at, open_until):start], f"[{KINDS[kind].upper()}]"]
            at = open_until = end
        else:
            at = open_until = max(open_until, end)
    return "".join([*out, text[at:]])


def _mapped(docs: DataFrame, fields: str, row) -> DataFrame:
    """Adds ``fields`` computed from the text; every column of ``docs`` travels in one struct, so names can't clash."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col("text").cast("string").alias("text")) if docs.columns else docs
    schema = f"doc {whole.schema['doc'].dataType.simpleString()}, {fields}"
    names = [f.split()[0] for f in fields.split(", ")]

    def run(batches):
        anchors = automaton()
        for b in batches:
            rows = [row(t.as_py(), find(t.as_py(), anchors)) for t in b.column(1)]
            columns = [pa.array([r[i] for r in rows], pa.int64() if n.startswith("n_") else pa.string()) for i, n in enumerate(names)]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], ["doc", *names])

    return arrow_map(whole, run, schema)


def scan(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: (doc_id, n_email, n_ip, n_card, n_phone, spans, base_sha256).

    ``spans`` lists every span as kind:start:end (code points, end exclusive)
    by start, then kind; ``base_sha256`` is the hash of the same list of the
    four base kinds.  A null or empty text has no spans.  A null doc_id and
    repeated rows keep their rows; other columns are ignored.
    """

    def row(_, spans):
        base = [s for s in spans if s[1] < len(BASE_KINDS)]
        counts = [sum(k == i for _, k, _ in base) for i in range(len(BASE_KINDS))]
        return (*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans))

    found = _mapped(docs.select("doc_id", "text"), "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string", row)
    return found.select(F.col("doc.doc_id").cast("long").alias("doc_id"), "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its ``[KIND]``; ``n_chars`` follows the new text where there is such a column."""
    found = _mapped(docs, "redacted string", lambda text, spans: (redact(text, spans),))

    def column(c: str) -> Column:
        if c == "text":
            return F.col("redacted").alias(c)
        if c == "n_chars":
            changed = F.length("redacted") != F.length("doc.text")
            kind = docs.schema[c].dataType
            return F.when(changed, F.length("redacted").cast(kind)).otherwise(F.col("doc.n_chars")).alias(c)
        return F.col(f"doc.`{c}`").alias(c)

    return found.select(*[column(c) for c in docs.columns])
