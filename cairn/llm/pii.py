"""Personal data by anchor expansion.

An Aho-Corasick automaton finds the anchors: at-signs, URL schemes, plus signs,
digits and the cues that introduce identifiers (``iban``, ``account no`` and so on).
From each anchor a small deterministic parser walks to the boundaries of the span and
validates it. A span of the base kinds can't reach beyond the characters its kind is
made of, so parsing around the anchors finds just what a scan of the whole text for
the kind's pattern would find, leftmost first and without overlap, and text without
an anchor is never parsed. All parsers take time in proportion to what they walk.

Kinds, in this order: email, ip, card, phone (the base kinds, whose patterns are
fixed), then those that the anchors add: url (a scheme and a valid host), account
(IBAN with valid check digits, or a cue followed by an identifier with digits).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import pick, texts

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account")

# URL schemes and words that introduce an identifier (matched without case).
SCHEMES = ("http://", "https://", "ftp://", "www.")
CUES = (
    "iban", "account no", "account number", "account:", "acct", "a/c", "ssn", "social security",
    "passport", "tax id", "customer id", "member id", "policy no", "konto", "kontonummer",
    "compte", "cuenta",
)

LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]++")
URL = re.compile(r"[^\s<>\"'`|\\^{}]++")
HOST = re.compile(r"(?:[^/?#@\s]{0,200}+@)?([A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{1,63}+){1,20}+)")
CUED = re.compile(r"(?:\s*+(?:no\.?|number|nr\.?|id|is|[.:#=]))*+\s*+((?=[A-Za-z-]{0,6}[0-9])[A-Za-z0-9]++(?:[ -]?[A-Z0-9]++)*+)", re.I)
IBAN = re.compile(r"[A-Za-z]{2}[0-9]{2}[A-Za-z0-9]{11,30}")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def iban_valid(text: str) -> bool:
    if not IBAN.fullmatch(text):
        return False
    turned = text[4:] + text[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def automaton() -> ahocorasick.Automaton:
    """Anchors with the parsers that they start."""
    out = ahocorasick.Automaton()
    out.add_word("@", ("email", 1))
    out.add_word("+", ("phone", 1))
    for d in "0123456789":
        out.add_word(d, ("digit", 1))
    for x in SCHEMES:
        out.add_word(x, ("url", len(x)))
    for x in CUES:
        out.add_word(x, ("cue", len(x)))
    out.make_automaton()
    return out


def _email(text: str, at: int, least: int) -> tuple[int, int] | None:
    """Local part back from the sign, no further than ``least``; domain after it."""
    start = at
    while start > least and text[start - 1] in LOCAL_CHARS:
        start -= 1
    if start == at or not (m := DOMAIN.match(text, at + 1)):
        return None
    return start, m.end()


def _ip_ok(found: str) -> bool:
    return all(len(p := x.lstrip("0")) < 4 and int(p or 0) <= 255 for x in found.split("."))


def _card_ok(found: str) -> bool:
    digits = found.replace(" ", "").replace("-", "")
    return 12 <= len(digits) <= 19 and luhn(digits)


def _phone_ok(found: str) -> bool:
    return 9 <= sum(c in "0123456789" for c in found) <= 15


def _url(text: str, at: int, scheme: int) -> tuple[int, int] | None:
    host = HOST.match(text, at + scheme)  # of bounded length, so a failure costs little
    if not host or any(x[0] == "-" or x[-1] == "-" for x in host[1].split(".")):
        return None
    end = URL.match(text, at + scheme).end()
    while end > host.end() and text[end - 1] in ".,;:!?)]*_~":
        end -= 1
    return at, end


def _account(text: str, at: int) -> tuple[int, int] | None:
    """The identifier after a cue that ends at ``at``: a valid IBAN or 5 to 34 letters
    and digits, 4 digits or more. It must end within 160 characters of the cue."""
    m = CUED.match(text, at, at + 160)  # bounded, so a failure costs little
    if not m:
        return None
    start, found = m.start(1), m[1]
    plain, cuts = "", []
    for i, c in enumerate(found):
        if c not in " -":
            plain += c
            cuts.append(i + 1)
        if len(plain) == 34:
            break
    for n in range(len(plain), 14, -1):  # an IBAN may be followed by more letters
        if iban_valid(plain[:n].upper()):
            return start, start + cuts[n - 1]
    head = re.match(r"[A-Za-z0-9]+(?:[ -]?[0-9]+)*", found)[0].rstrip(" -")
    size, digits = len(re.sub("[ -]", "", head)), sum(c.isdigit() for c in head)
    return (start, start + len(head)) if 5 <= size <= 34 and digits >= 4 else None


def find(text: str, anchors: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every span, by start and then kind as listed; offsets
    count code points, ends are exclusive."""
    spans: list[tuple[str, int, int]] = []
    email_end = ip_end = card_end = phone_end = url_end = account_end = 0
    # Lower case finds schemes and cues of any case. Where lowering changes the length
    # only A-Z are lowered, so that offsets stay.
    lowered = text.lower()
    if len(lowered) != len(text):
        lowered = text.translate({c: c + 32 for c in range(65, 91)})
    for last, (kind, size) in anchors.iter(lowered):
        at = last - size + 1
        if kind == "digit":
            if at >= ip_end and (at == 0 or not "0" <= text[at - 1] <= "9"):
                if m := IP.match(text, at):
                    ip_end = m.end()
                    if _ip_ok(m.group()):
                        spans.append(("ip", at, ip_end))
                else:
                    ip_end = DIGITS.match(text, at).end()
            if at >= card_end and (m := CARD.match(text, at)):
                card_end = m.end()
                if _card_ok(m.group()):
                    spans.append(("card", at, card_end))
        elif kind == "email":
            if at >= email_end and (found := _email(text, at, email_end)):
                spans.append(("email", *found))
                email_end = found[1]
        elif kind == "phone":
            if at >= phone_end and (m := PHONE.match(text, at)):
                phone_end = m.end()
                if _phone_ok(m.group()):
                    spans.append(("phone", at, phone_end))
        elif kind == "url":
            if at >= url_end and (found := _url(text, at, size)):
                spans.append(("url", *found))
                url_end = found[1]
        elif at >= account_end and not (at and text[at - 1].isalnum()) and (found := _account(text, last + 1)):
            spans.append(("account", *found))
            account_end = found[1]
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted(spans, key=lambda x: (x[1], order[x[0]]))


def listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_url, n_account),
    one row per row of ``docs``, repeated rows too.

    ``spans`` lists all spans as kind:start:end; ``base_sha256`` is the SHA-256 of that
    list with the base kinds only. NULL and empty texts have no spans ("" and its
    digest). No documents, no rows.
    """

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = automaton()
        for batch in rows:
            found = [find(x, anchors) for x in texts(batch["text"])]
            base = [listed([s for s in x if s[0] in BASE_KINDS]).encode() for x in found]
            counts = {k: pa.array([sum(s[0] == k for s in x) for x in found], pa.int64()) for k in KINDS}
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    *[counts[k] for k in BASE_KINDS],
                    pa.array([hashlib.sha256(x).hexdigest() for x in base], pa.string()),
                    pa.array([listed(x) for x in found], pa.string()),
                    counts["url"],
                    counts["account"],
                ],
                ["doc_id", *[f"n_{k}" for k in BASE_KINDS], "base_sha256", "spans", "n_url", "n_account"],
            )

    narrow = pick(docs, doc_id=id_col, text=text_col)
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(
        run,
        f"doc_id {kind}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_url bigint, n_account bigint",
    )
