"""Column functions of the cleaning and signal rules; no I/O, no Python in the plan."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .folding import casefolded, compatible
from .keywords import longest_anywhere

_SPACE = r"[\s\x1c-\x1f]"


#: All white space of Unicode, the separators U+001C to U+001F among it.
_SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))


def trimmed(c) -> Column:
    """Without Unicode white space at both ends."""
    return F.btrim(c, F.lit(_SPACES))


def squeezed(c) -> Column:
    """Trimmed, each run of white space one space."""
    return trimmed(F.regexp_replace(c, rf"(?U){_SPACE}+", " "))


def standard_name(c) -> Column:
    return F.upper(squeezed(F.coalesce(c, F.lit(""))))


def valid_email(c) -> Column:
    """A trimmed address of the accepted form; null is not valid."""
    return F.coalesce(c.rlike(fixed.EMAIL), F.lit(False))


def dialled(c, home: str) -> Column:
    """The digits of a phone number behind its international prefix; one without prefix gets the calling code ``home``.

    Null if something else than digits is left without white space, dots, dashes and brackets.
    """
    plain = F.regexp_replace(F.regexp_replace(c, r"[\s().-]", ""), r"^(?:\+|00)", "+")
    digits = F.when(plain.startswith("+"), F.substring(plain, 2, 99)).otherwise(F.concat(F.lit(home), plain))
    return F.when(digits.rlike("^[0-9]{4,30}$"), digits)


def clean_skill(c) -> Column:
    """Compatibility forms (NFKC) made plain, white space squeezed; null is empty."""
    return squeezed(compatible(F.coalesce(c, F.lit(""))))


def skill_key(c) -> Column:
    return F.lower(clean_skill(c))


def lookup_key(c) -> Column:
    """Trimmed, case folded; white space inside stays as it is."""
    return casefolded(trimmed(F.coalesce(c, F.lit(""))))


def standard_title(c) -> Column:
    """Everything but letters, digits and spaces is a space."""
    return squeezed(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)[^\w\s]|_", " "))


def is_open_end(c) -> Column:
    return F.coalesce(F.lower(trimmed(c)).isin(*fixed.PRESENT_WORDS), F.lit(False))


def month_of(c) -> Column:
    """The first day of a month given as name and year, else null."""
    text = squeezed(c)
    day = F.coalesce(F.try_to_timestamp(text, F.lit("MMMM yyyy")), F.try_to_timestamp(text, F.lit("MMM yyyy"))).cast("date")
    return F.when(F.year(day) >= 1, day)


def month_index(c) -> Column:
    return F.year(c) * 12 + F.month(c)


def location_parts(c) -> Column:
    """The comma-separated parts of a location, without a leading remote mark."""
    text = squeezed(F.coalesce(c, F.lit("")))
    text = F.regexp_replace(text, r"(?iu)^\s*remote\s*[/\-–|]?\s*", "")
    text = F.regexp_replace(text, r"^[ ,]+|[ ,]+$", "")
    return F.filter(F.transform(F.split(text, ","), trimmed), lambda p: p != "")


def is_remote(c) -> Column:
    return F.coalesce(c.rlike(r"(?iU)\bremote\b"), F.lit(False))


def city_of(parts: Column, country: Column) -> Column:
    """The city of location parts whose last part means ``country``."""
    last, second = F.try_element_at(parts, F.lit(-1)), F.try_element_at(parts, F.lit(-2))
    one = F.when(F.lower(last) == F.lower(country), F.lit("")).otherwise(last)
    city = F.when(F.size(parts) == 0, "").when(F.size(parts) == 1, one).otherwise(second)
    city = trimmed(F.regexp_replace(city, r"(?iu)\s+(office|hq|headquarters)$", ""))
    return F.when(city != "", city)


def profile_hits(low) -> Column:
    """How many of the technical words a lower-cased text holds, wherever they stand.

    One pass finds the longest word at every place; words that it begins with come along, and words
    that begin further on are found there.
    """
    words = fixed.PROFILE_WORDS
    begun = {w: [x for x in words if w.startswith(x)] for w in words}
    more = [x for w, of in begun.items() if len(of) > 1 for x in (F.lit(w), F.array(*map(F.lit, of)))]
    found = F.array_distinct(F.regexp_extract_all(low, F.lit(longest_anywhere(words)), F.lit(1)))
    every = F.flatten(F.transform(found, lambda w: F.coalesce(F.try_element_at(F.create_map(*more), w), F.array(w))))
    return F.coalesce(F.size(F.array_distinct(every)), F.lit(0))


def profile_type(low) -> Column:
    """The profile of a lower-cased text; give it as a column of its own, which is then lowered once. Null is not technical."""
    return F.when(profile_hits(low) >= fixed.PROFILE_LEAST, "technical").otherwise("non_technical")


def skill_category(c) -> Column:
    pairs = [F.lit(x) for pair in fixed.SKILL_CATEGORIES.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.lower(trimmed(F.coalesce(c, F.lit(""))))), F.lit("other"))


def _largest(c, patterns) -> Column:
    found = [F.regexp_extract_all(c, F.lit(f"(?i){p}"), F.lit(1)) for p in patterns]
    numbers = F.transform(F.flatten(F.array(*found)), lambda x: x.try_cast("double"))
    return F.coalesce(F.array_max(F.filter(numbers, lambda x: x.isNotNull())), F.lit(0.0))


def people_managed(c) -> Column:
    """The largest number of people that a description says were managed, else 0."""
    return F.coalesce(_largest(c, fixed.TEAM_PATTERNS), F.lit(0.0)).cast("long")


def budget_millions(c) -> Column:
    """The largest budget in millions that a description names, else 0."""
    return F.coalesce(_largest(c, fixed.BUDGET_PATTERNS), F.lit(0.0))


def company_name(c) -> Column:
    """Lower case, punctuation off, legal suffixes at the end off; only suffixes leave nothing."""
    text = F.lower(F.coalesce(c, F.lit("")))
    text = F.regexp_replace(F.regexp_replace(text, "[.']", ""), r"(?U)[^\w\s]|_", " ")
    suffix = "|".join(fixed.COMPANY_SUFFIXES)
    return squeezed(F.regexp_replace(F.concat(F.lit(" "), squeezed(text)), rf"(?: (?:{suffix}))+$", ""))


def name_match(a, b) -> Column:
    """exact, partial or different, by the words of two normalised names."""
    x, y = F.array_distinct(F.split(a, " ")), F.array_distinct(F.split(b, " "))
    only_x, only_y = F.size(F.array_except(x, y)), F.size(F.array_except(y, x))
    return (
        F.when((a == "") | (b == ""), "different")
        .when((only_x == 0) & (only_y == 0), "exact")
        .when((only_x == 0) | (only_y == 0), "partial")
        .otherwise("different")
    )


def first_spellings(skills: Column) -> Column:
    """Skills without blanks, each once whatever its case, first spelling and order kept."""
    clean = F.filter(F.transform(skills, trimmed), lambda s: s != "")
    empty = F.array().cast("array<string>")
    add = lambda acc, s: F.when(F.exists(acc, lambda x: F.lower(x) == F.lower(s)), acc).otherwise(F.concat(acc, F.array(s)))
    return F.aggregate(clean, empty, add)


def bare_json(c) -> Column:
    """A reply without the code fences around its JSON."""
    text = trimmed(c)
    open_fence = F.regexp_replace(F.regexp_replace(text, "```json\n?", ""), "```\n?", "")
    return F.when(text.startswith("```"), trimmed(open_fence)).otherwise(text)


def id_of_path(c) -> Column:
    return F.regexp_replace(F.element_at(F.split(c, "/"), -1), r"\.pdf$", "")
