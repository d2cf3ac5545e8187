"""A table of label rules applied to texts in one pass, and what becomes of the labels found.

A rule is a label and a pattern (Python's regular expressions, case does not matter). From each alternative of a pattern
the literals are taken that every match of it must hold. The longest ones of all rules are looked for at once by one
automaton, and where one is met with the alternative's others near it, the rule's pattern runs over as many characters as a
match can have on either side. So the cost of a
text is that of one pass and of short searches, however many rules there are and however long it is. A pattern whose
matches have no bound of WIDEST characters runs over the whole text once a literal was met; a rule with an alternative
that holds no literal always does.

Null or empty text has no labels; labels come in the order of the rules, each once; a text of any length is read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from re._parser import parse

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import rules as fixed
from docloom.functions import text as tx

MOST_RULES = 100_000  # a table of rules is sent to each task whole
LEAST = 2  # characters of a literal
WIDEST = 200  # characters of a match that is looked for around a literal
SPECIAL = set("\\^$.|?*+()[]{}")
#: Letters that match a Latin letter when case does not matter, though lower() does not give it.
ALIKE = str.maketrans({"ſ": "s", "ı": "i", "İ": "i"})


def alternatives(pattern: str) -> list[str]:
    """The pattern's top alternatives."""
    out, depth, inside, start, k = [], 0, False, 0, 0
    while k < len(pattern):
        c = pattern[k]
        if c == "\\":
            k += 1
        elif inside:
            inside = c != "]"
        elif c == "[":
            inside = True
            k += pattern[k + 1:k + 2] == "]"
        elif c in "()":
            depth += 1 if c == "(" else -1
        elif c == "|" and not depth:
            out.append(pattern[start:k])
            start = k + 1
        k += 1
    return [*out, pattern[start:]]


def expanded(branch: str, most: int = 16) -> list[str]:
    """The branch with its first plain group replaced by each of the group's alternatives, and so on; every match of the branch
    is one of these. Groups with a quantifier or a further group in them stay."""
    k = 0
    while k < len(branch):
        c = branch[k]
        if c == "\\":
            k += 2
            continue
        if c == "[":
            end = branch.find("]", k + 2)
            k = end + 1 if end >= 0 else len(branch)
            continue
        if c == "(":
            end = branch.find(")", k)
            inside = branch[k + 1:end].removeprefix("?:")
            if end > 0 and not set(inside) & set("()[]\\") and branch[end + 1:end + 2] not in tuple("?*+{"):
                options = inside.split("|")
                if len(options) > most:
                    return [branch]
                return [y for x in options for y in expanded(f"{branch[:k]}{x}{branch[end + 1:]}", most // len(options))]
            return [branch]
        k += 1
    return [branch]


def runs(branch: str) -> Iterator[str]:
    """Plain characters outside groups and classes that follow each other in every match of the branch."""
    now, depth, k = "", 0, 0
    while k < len(branch):
        c = branch[k]
        plain = None
        if c == "\\":
            k += 1
            plain = branch[k] if k < len(branch) and not branch[k].isalnum() else None
        elif c == "[":
            end = branch.find("]", k + 2)
            k = end if end >= 0 else len(branch)
        elif c in "()":
            depth += 1 if c == "(" else -1
        elif c not in SPECIAL:
            plain = c
        after = branch[k + 1:k + 2]
        if plain is not None and not depth and after not in ("?", "*", "{"):
            now += plain
            if after == "+":
                yield now
                now = ""
        elif now:
            yield now
            now = ""
        if c == "{":
            k = max(branch.find("}", k), k)
        k += 1
    if now:
        yield now


def folded(text: str) -> str:
    return text.translate(ALIKE).lower()


def literals(pattern: str) -> list[tuple[str, ...]] | None:
    """The literals of each alternative, the longest first; None if one has none. A pattern with inline flags or
    look-arounds has none."""
    if "(?" in pattern.replace("(?:", ""):
        return None
    found = []
    for branch in (x for some in alternatives(pattern) for x in expanded(some)):
        # letters beyond ASCII that have cases match in ways that lower() does not tell
        plain = ["".join(c if c.isascii() or c.lower() == c.upper() else "\0" for c in r).split("\0") for r in runs(branch)]
        sure = [folded(x) for some in plain for x in some if len(x) >= LEAST]
        if not sure:
            return None
        found.append(tuple(sorted(dict.fromkeys(sure), key=len, reverse=True)))
    return found


class Rules:
    """Rules in order, with the automaton of their literals. read counts the characters that patterns were given."""

    def __init__(self, rules: tuple[tuple[str, str], ...]):
        self.labels = [label for label, _ in rules]
        self.patterns = [re.compile(p, re.IGNORECASE) for _, p in rules]
        self.always, self.wide, self.read, met = [], {}, 0, {}
        for k, (_, p) in enumerate(rules):
            some, widest = literals(p), parse(p).getwidth()[1]
            self.wide[k] = widest if widest <= WIDEST else None
            if some is None:
                self.always.append(k)
            for first, *others in some or ():
                met.setdefault(first, set()).add((k, self.wide[k], tuple(others)))
        self.automaton = ahocorasick.Automaton()
        for x, uses in met.items():
            self.automaton.add_word(x, (len(x), tuple(sorted(uses, key=str))))
        if met:
            self.automaton.make_automaton()

    def _meets(self, k: int, text: str, begin: int = 0, end: int | None = None) -> bool:
        end = len(text) if end is None else end
        self.read += end - begin
        m = self.patterns[k].search(text, begin, end)
        if m and m.end() == end < len(text):  # what it meets may hang on where the search ended
            return self._meets(k, text)
        return m is not None

    def found(self, text: str | None) -> list[str]:
        if not text:
            return []
        low = folded(text)
        hit, whole = set(), set(self.always)
        if len(low) != len(text):
            whole.update(range(len(self.labels)))
        n, find = len(text), low.find
        for end, (size, uses) in self.automaton.iter(low) if len(self.automaton) else ():
            for k, wide, others in uses:
                if k in hit or k in whole:
                    continue
                if wide is None:
                    whole.add(k)
                    continue
                begin = end + 1 - size - wide
                begin = begin if begin > 0 else 0
                for x in others:
                    if find(x, begin, end + 1 + wide) < 0:
                        break
                else:
                    if self._meets(k, text, begin, min(end + 2 + wide, n)):
                        hit.add(k)
        hit.update(k for k in whole if self._meets(k, text))
        return list(dict.fromkeys(self.labels[k] for k in sorted(hit)))


@lru_cache(maxsize=4)
def _rules(rules: tuple[tuple[str, str], ...]) -> Rules:
    return Rules(rules)


def table_of(rules: DataFrame) -> tuple[tuple[str, str], ...]:
    """rule_no, label, pattern as rows in order; a table of rules has a bounded size."""
    rows = rules.orderBy("rule_no").limit(MOST_RULES + 1).collect()
    if len(rows) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    return tuple((r.label, r.pattern) for r in rows)


def labels(text: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    """The labels of the rules that a text meets."""
    @F.pandas_udf("array<string>")
    def found(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        use = _rules(rules)
        for some in texts:
            yield some.map(use.found)

    return found(text)


def replacements(found: Column, claim_types: Column) -> Column:
    """Labels of the context, six at most; without one, what the kind of the claims gives."""
    plain = F.when(F.array_contains(claim_types, "method") | F.array_contains(claim_types, "process"), F.array(F.lit("method_feature_extraction")))
    plain = plain.when(F.array_contains(claim_types, "system"), F.array(F.lit("system_feature_extraction")))
    plain = plain.when(F.array_contains(claim_types, "device"), F.array(F.lit("device_feature_extraction")))
    return F.slice(F.when(F.size(found) > 0, found).otherwise(F.coalesce(plain, F.array().cast("array<string>"))), 1, 6)


def of_quality(found: Column, instead: Column) -> Column:
    """The labels that say something; if none does, those of the context; if there are none, what is not denied."""
    def among(x: Column, some: tuple[str, ...]) -> Column:
        return x.isin(*some)

    left = F.filter(F.array_distinct(found), lambda x: ~among(x, fixed.DENIED))
    specific = F.filter(left, lambda x: ~among(x, fixed.LOW_VALUE) & ~x.rlike("^(core_|claimed_|safe_)"))
    return F.when(F.size(specific) > 0, specific).when(F.size(instead) > 0, instead).otherwise(left)


def labelled(docs: DataFrame, rules: DataFrame, *keep: str) -> DataFrame:
    """keep, and the labels of text by a table of rules (rule_no, label, pattern)."""
    return docs.select(*keep, labels(tx.collapse_space(F.col("text")), table_of(rules)).alias("labels"))
