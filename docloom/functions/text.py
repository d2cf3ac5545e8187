"""Column functions on text. All follow Unicode rules for letters and white space."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom.functions.rules import ALIASES


def collapse_space(c: Column) -> Column:
    """White space to single spaces, trimmed; null to ''."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "))


def clip(c: Column, n: int) -> Column:
    return F.substring(collapse_space(c), 1, n)


def tag(c: Column) -> Column:
    """Lower case, & as and, other marks as one underscore."""
    x = F.replace(F.lower(F.coalesce(c, F.lit(""))), F.lit("&"), F.lit("and"))
    return F.btrim(F.regexp_replace(F.regexp_replace(x, "[^a-z0-9]+", "_"), "_+", "_"), F.lit("_"))


def file_name(c: Column) -> Column:
    return F.regexp_replace(c, "[^A-Za-z0-9._-]+", "_")


def leading_number(c: Column) -> Column:
    """The number that a text begins with; 0 for none."""
    return F.coalesce(F.nullif(F.regexp_extract(c, r"^\s*([+-]?\d+)", 1), F.lit("")).try_cast("bigint"), F.lit(0)).cast("long")


def clause_number(c: Column) -> Column:
    """Leading digits without a leading zero, 1 to 80; else null."""
    n = F.nullif(F.regexp_extract(c, r"^\s*([1-9]\d*)", 1), F.lit("")).try_cast("bigint")
    return F.when(n.between(1, 80), n.cast("string"))


def letter_share(c: Column) -> Column:
    """Part of letters among characters that are not white space; 0 for none."""
    solid = F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", "")
    n = F.length(solid)
    return F.when(n > 0, F.round(F.length(F.regexp_replace(solid, r"[^\p{L}]", "")) / n, 3)).otherwise(F.lit(0.0))


def digit_share(c: Column) -> Column:
    solid = F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", "")
    n = F.length(solid)
    return F.when(n > 0, F.round(F.length(F.regexp_replace(solid, "[^0-9]", "")) / n, 3)).otherwise(F.lit(0.0))


def redacted(c: Column) -> Column:
    """Access keys and token values replaced."""
    return F.regexp_replace(F.regexp_replace(c, r"\bAKIA[0-9A-Z]{16}\b", "[redacted]"), r'token = "[0-9a-f]{16,}"', 'token = "[redacted]"')


def id_fragments(c: Column) -> Column:
    """Runs of 7 digits or more."""
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit("[0-9]{7,}"), F.lit(0))


def json_strings(c: Column) -> Column:
    """A JSON array of strings; bad text gives an empty array."""
    return F.coalesce(F.from_json(c, "array<string>"), F.array().cast("array<string>"))


# Latin letters with marks, and their bare letters.
MARKED = "àâäáãåçèéêëìíîïñòóôöõùúûüýÿ"
BARE = "aaaaaaceeeeiiiinooooouuuuyy"


def search_tokens(c: Column) -> Column:
    """Lower-case runs of letters and digits, without marks."""
    return F.filter(F.split(F.translate(F.lower(F.coalesce(c, F.lit(""))), MARKED, BARE), r"[^\p{L}\p{N}]+"), lambda x: x != "")


def expanded(question: Column) -> Column:
    """A question and what the keys in it also ask for, each once, in order."""
    asked, none = collapse_space(question), F.array().cast("array<string>")
    low = F.lower(asked)
    each = [F.when(low.contains(k.lower()), F.array(*[F.lit(x) for x in terms])).otherwise(none) for k, terms in ALIASES.items()]
    return F.array_distinct(F.filter(F.concat(F.array(asked), *each), lambda x: x != ""))
