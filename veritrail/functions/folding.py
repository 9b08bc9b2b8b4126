"""Unicode compatibility forms (NFKC) and full case folding as column expressions, without Python workers.

Tables come from the interpreter's Unicode data when first used. Characters that become one other
character go through ``translate``; those that become several, and marks that join a character
before them, are looked up in maps, only in values that hold such characters.
"""

from __future__ import annotations

import functools
import json
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

_MAP = "map<string,string>"
#: Bounds of conjoining jamo and of the syllables that they make.
_LEAD, _VOWEL, _TAIL, _SYLLABLE = (0x1100, 0x1112), (0x1161, 0x1175), (0x11A7, 0x11C2), (0xAC00, 0xD7A3)


def _every():
    return (chr(n) for n in range(sys.maxunicode + 1) if not 0xD800 <= n <= 0xDFFF)


def _ranges(chars) -> str:
    """A character class of Java's regular expressions."""
    found, out = sorted(map(ord, chars)), []
    for n in found:
        if out and out[-1][1] == n - 1:
            out[-1][1] = n
        else:
            out.append([n, n])
    return "[" + "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in out) + "]"


def _split(pairs: dict[str, str]) -> tuple[str, str, dict[str, str]]:
    """Characters that become one character, what they become, and the others."""
    one = {a: b for a, b in pairs.items() if len(b) == 1}
    return "".join(one), "".join(one.values()), {a: b for a, b in pairs.items() if len(b) != 1}


@functools.cache
def _compatible_tables():
    nfkc, nfkd, order, pairs = {}, {}, {}, {}
    for c in _every():
        if c.isascii():
            continue
        if (to := unicodedata.normalize("NFKC", c)) != c:
            nfkc[c] = to
        syllable = _SYLLABLE[0] <= ord(c) <= _SYLLABLE[1]
        if not syllable and (to := unicodedata.normalize("NFKD", c)) != c:
            nfkd[c] = to
        if unicodedata.combining(c):
            order[c] = unicodedata.combining(c)
        parts = unicodedata.normalize("NFD", c) if not syllable else ""
        if len(parts) > 1 and unicodedata.normalize("NFC", c) == c:
            # the last step of its composition: everything but the last mark is composed already
            pairs[unicodedata.normalize("NFC", parts[:-1]) + parts[-1]] = c
    seconds = {p[-1] for p in pairs} | set(order) | {chr(n) for low, high in (_VOWEL, _TAIL) for n in range(low, high + 1)}
    seconds |= {c for c, to in nfkd.items() if to[0] in seconds}
    return nfkc, nfkd, order, pairs, seconds


@functools.cache
def _fold_table() -> dict[str, str]:
    return {c: c.casefold() for c in _every() if c.casefold() != c}


def _looked_up(c: Column, table: dict[str, str]) -> Column:
    held = F.from_json(F.lit(json.dumps(table)), _MAP)
    return F.array_join(F.transform(F.split(c, ""), lambda x: F.coalesce(F.try_element_at(held, x), x)), "")


def _mapped(c: Column, table: dict[str, str]) -> Column:
    """Each character by itself."""
    one, to, more = _split(table)
    single = F.translate(c, one, to)
    return F.when(c.rlike(_ranges(more)), F.translate(_looked_up(c, more), one, to)).otherwise(single) if more else single


def _composed(c: Column) -> Column:
    """NFKC of values with marks or jamo: decompose, put marks in canonical order, compose from left to right."""
    _, nfkd, order, pairs, _ = _compatible_tables()
    classes = F.from_json(F.lit(json.dumps(order)), "map<string,int>")
    joins = F.from_json(F.lit(json.dumps(pairs)), _MAP)
    chars = F.transform(F.split(_looked_up(c, nfkd), ""), lambda x: F.struct(F.coalesce(F.try_element_at(classes, x), F.lit(0)).alias("k"), x.alias("c")))
    # (how many starters so far, class, place): the canonical order of marks
    none = F.array().cast("array<struct<s:int,k:int,i:int,c:string>>")
    at = lambda acc: F.coalesce(F.try_element_at(acc, F.lit(-1))["s"], F.lit(0))
    placed = F.aggregate(
        chars,
        none,
        lambda acc, x: F.concat(
            acc, F.array(F.struct((at(acc) + F.when(x["k"] == 0, 1).otherwise(0)).alias("s"), x["k"].alias("k"), F.size(acc).alias("i"), x["c"].alias("c")))
        ),
    )
    within = lambda n, bounds: (n >= bounds[0]) & (n <= bounds[1])

    def pair(a: Column, b: Column) -> Column:
        x, y = F.ascii(a), F.ascii(b)
        two = F.when(within(x, _LEAD) & within(y, _VOWEL), _SYLLABLE[0] + ((x - _LEAD[0]) * 21 + (y - _VOWEL[0])) * 28)
        three = F.when(within(x, _SYLLABLE) & ((x - _SYLLABLE[0]) % 28 == 0) & within(y, _TAIL) & (y > _TAIL[0]), x + y - _TAIL[0])
        return F.coalesce(F.try_element_at(joins, F.concat(a, b)), F.decode(F.unhex(F.hex(F.coalesce(two, three).cast("long"))), "UTF-16BE"))

    def step(acc: Column, x: Column) -> Column:
        out, starter, marks, last = (acc[n] for n in ("out", "starter", "marks", "last"))
        both = F.when((starter != "") & ~((marks != "") & (last >= x["k"])), pair(starter, x["c"]))
        state = lambda o, s, m, k: F.struct(o.alias("out"), s.alias("starter"), m.alias("marks"), k.alias("last"))
        return (
            F.when(both.isNotNull(), state(out, both, marks, last))
            .when(x["k"] == 0, state(F.concat(out, starter, marks), x["c"], F.lit(""), F.lit(0)))
            .otherwise(state(out, starter, F.concat(marks, x["c"]), x["k"]))
        )

    start = F.struct(F.lit("").alias("out"), F.lit("").alias("starter"), F.lit("").alias("marks"), F.lit(0).alias("last"))
    return F.aggregate(F.array_sort(placed), start, step, lambda a: F.concat(a["out"], a["starter"], a["marks"]))


def compatible(c: Column) -> Column:
    """NFKC of a text; null stays null."""
    nfkc, _, _, _, seconds = _compatible_tables()
    plain = F.octet_length(c) == F.char_length(c)
    return F.when(plain | c.isNull(), c).when(c.rlike(_ranges(seconds)), _composed(c)).otherwise(_mapped(c, nfkc))


def casefolded(c: Column) -> Column:
    """Full case folding: what differs in case alone is equal; null stays null."""
    plain = F.octet_length(c) == F.char_length(c)
    return F.when(plain | c.isNull(), F.lower(c)).otherwise(_mapped(c, _fold_table()))
