"""Personal data by anchor expansion: one automaton pass finds anchors, local parsers do the rest.

Anchors are at-signs, plus signs, digits, scheme marks and identifier cues. A parser reads a few
characters around its anchor, finds the boundaries and validates what stands between them, so
texts without anchors cost one pass. Every parser is linear in what it reads.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds, base kinds first; ties at one start are ordered so.
KINDS = ("email", "ip", "card", "phone", "url", "account", "address")
BASE = KINDS[:4]
# Cue words in the spellings that are looked for.
ACCOUNT_CUES = ("password", "passwd", "token", "api_key", "apikey", "secret", "iban", "account")
KEY_CUES = ("AKIA",)
STREET_CUES = ("Street", "Avenue", "Road", "Lane", "Boulevard", "Drive")

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_RUN = re.compile(r"[0-9]+")
_IP_REST = re.compile(r"\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_VALUE = re.compile(r"(?:[\x20\t]*[:=][\x20\t]*[\"']?)([A-Za-z0-9+/_.-]{8,})")
_IBAN = re.compile(r"[\x20\t]*[:=]?[\x20\t]*([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?)(?![A-Z0-9])")
_KEY = re.compile(r"[0-9A-Z]{16}(?![0-9A-Za-z])")
_URL = re.compile(r"[^\s\"'<>]+")
_HOST = re.compile(r"[0-9]+(?:\.[0-9]+){3}(?::[0-9]+)?")
_HOUSE = re.compile(r"(?<![0-9A-Za-z])([0-9]{1,5}[A-Za-z]?(?:\x20[A-Z][A-Za-z.'-]*){1,4}\x20)\Z")
_DIGITS = str.maketrans("", "", "\x20-().+")


def luhn(digits: str) -> bool:
    """The check sum of card numbers."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def iban(value: str) -> bool:
    """The check sum of account numbers: modulo 97 after moving four characters."""
    value = value.replace(" ", "")
    if not 15 <= len(value) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def anchors():
    """The automaton of all anchors, each with its parser's name."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for c in "0123456789":
        found.add_word(c, ("number", 1))
    found.add_word("@", ("at", 1))
    found.add_word("+", ("plus", 1))
    found.add_word("://", ("scheme", 3))
    for cue in ACCOUNT_CUES:
        for form in {cue, cue.upper(), cue.capitalize()}:
            found.add_word(form, ("iban" if cue == "iban" else "cue", len(form)))
    for cue in KEY_CUES:
        found.add_word(cue, ("key", len(cue)))
    for cue in STREET_CUES:
        found.add_word(cue, ("street", len(cue)))
    found.make_automaton()
    return found


def spans_of(text: str, automaton) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all personal data in ``text``, in order."""
    out: list[tuple[int, int, int]] = []
    email_end = ip_end = card_end = phone_end = key_end = url_end = 0
    for last, (what, n) in automaton.iter(text):
        at = last - n + 1
        if what == "number":
            if at >= ip_end:
                run_end = _RUN.match(text, at).end()
                m = _IP_REST.match(text, run_end)
                # a start inside this run of digits would end the same way
                ip_end = m.end() if m else run_end
                if m and all(int(x[-4:]) <= 255 and (len(x) < 5 or not x[:-4].strip("0")) for x in (text[at:run_end], *m.groups())):
                    out.append((at, 1, m.end()))
            if at >= card_end:
                m = _CARD.match(text, at)
                if m:
                    card_end = m.end()
                    digits = m.group().translate(_DIGITS)
                    if 12 <= len(digits) <= 19 and luhn(digits):
                        out.append((at, 2, card_end))
        elif what == "at":
            start = at
            while start > email_end and text[start - 1] in _LOCAL:
                start -= 1
            m = _DOMAIN.match(text, last + 1) if start < at else None
            if m:
                email_end = m.end()
                out.append((start, 0, email_end))
        elif what == "plus":
            m = _PHONE.match(text, at) if at >= phone_end else None
            if m:
                phone_end = m.end()
                if 9 <= len(m.group().translate(_DIGITS)) <= 15:
                    out.append((at, 3, phone_end))
        elif what == "scheme":
            start = at
            while start > 0 and text[start - 1].isascii() and text[start - 1].isalnum():
                start -= 1
            if start < at:
                # schemes of one run of characters end together, and a host ends before the next scheme
                if last + 1 >= url_end:
                    m = _URL.match(text, last + 1)
                    url_end = m.end() if m else last + 1
                slash = text.find("/", last + 1, url_end)
                host = text[last + 1 : slash if slash >= 0 else url_end]
                if "@" in host or _HOST.fullmatch(host):
                    out.append((start, 4, url_end))
        elif what in ("cue", "iban"):
            m = (_IBAN if what == "iban" else _VALUE).match(text, last + 1)
            if m and m.start(1) >= key_end and (iban(m.group(1)) if what == "iban" else any(c.isdigit() for c in m.group(1))):
                key_end = m.end(1)
                out.append((m.start(1), 5, key_end))
        elif what == "key":
            m = _KEY.match(text, last + 1)
            if m and at >= key_end and not (at and text[at - 1].isalnum()):
                key_end = m.end()
                out.append((at, 5, key_end))
        else:
            m = _HOUSE.search(text, max(0, at - 80), at)
            if m and not text[last + 1 : last + 2].isalnum():
                out.append((m.start(), 6, last + 1))
    out.sort()
    return out


def _found(batches):
    import pyarrow as pa

    automaton = anchors()
    for batch in batches:
        for lo in range(0, batch.num_rows, 512):
            part = batch.slice(lo, 512)
            rows = [spans_of(t, automaton) if t else [] for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(
                        [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in r] for r in rows],
                        pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])),
                    ),
                ],
                names=["doc", "spans"],
            )


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id and spans (kind, start, end in code points, end exclusive).

    Null and empty texts have no spans. Spans of different kinds may overlap. Repeated rows give
    repeated results; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    out = rows.mapInArrow(_found, f"doc {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>")
    return out.withColumnRenamed("doc", id_col)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, the hash of their spans, and all spans as text."""
    named = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    of = lambda kind: lambda s: s["kind"] == kind
    count = {f"n_{k}": F.size(F.filter("spans", of(k))).cast("long") for k in BASE}
    return found.withColumns(count).select(
        id_col,
        *count,
        F.sha2(F.array_join(F.transform(base, named), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", named), ",").alias("spans"),
    )


def masked(text: str, spans) -> str:
    """``text`` with every span replaced by its kind in angle brackets; overlaps are one."""
    out, at = [], 0
    for start, kind, end in sorted((s["start"], s["kind"], s["end"]) for s in spans):
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join(out) + text[at:]
