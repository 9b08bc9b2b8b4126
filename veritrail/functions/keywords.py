"""A pattern that finds many words in one pass over a text."""

import re


def _class(chars) -> str:
    return "[" + "".join(re.escape(c) for c in sorted(chars)) + "]"


def _tree(words: list[str]) -> str:
    """The longest of ``words`` here: their shared beginnings are read once, many first letters told apart by halves."""
    ends, letters = "" in words, sorted({w[0] for w in words if w})
    if not letters:
        return ""
    if len(letters) > 3:
        early = letters[: len(letters) // 2]
        halves = [[w for w in words if w and (w[0] in early) == here] for here in (True, False)]
        one = f"(?:(?={_class(early)}){_tree(halves[0])}|{_tree(halves[1])})"
    else:
        ways = [re.escape(c) + _tree([w[1:] for w in words if w[:1] == c]) for c in letters]
        one = ways[0] if len(ways) == 1 else f"(?:{'|'.join(ways)})"
    return f"(?:{one})?" if ends else one


def longest_anywhere(words) -> str:
    """Group 1 of each match is the longest of ``words`` that begins at a place; matches take no room, so words may overlap.

    Words have at least two characters. Places whose first two characters begin no word are passed over.
    """
    return f"(?={_class({w[0] for w in words})}{_class({w[1] for w in words})})(?=({_tree(list(words))}))"
