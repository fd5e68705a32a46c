"""Secret redaction as an ordered chain of native regexp_replace calls."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import or_empty

MASK = "[REDACTED]"


@dataclass(frozen=True)
class Hint:
    """What any text a rule can change must contain; it only saves work.

    `literals` must all occur; of `words` (upper case) one must occur in some case.
    """

    literals: tuple[str, ...] = ()
    words: tuple[str, ...] = ()

    def holds(self, c: Column) -> Column:
        tests = [c.contains(x) for x in self.literals]
        if self.words:
            # U+0130 equals "i" when case is ignored, but is its own upper case
            found = [F.upper(c).contains(w) for w in self.words] + [c.contains("\u0130")]
            tests.append(reduce(lambda a, b: a | b, found))
        return reduce(lambda a, b: a & b, tests, F.lit(True))


@dataclass(frozen=True)
class Rule:
    """One rewrite. `pattern` and `replacement` use Java syntax ($1, ${name})."""

    name: str
    pattern: str
    replacement: str
    hint: Hint = Hint()
    flags: str = "(?iuU)"

    def rewrite(self, c: Column) -> Column:
        return F.regexp_replace(c, self.flags + self.pattern, self.replacement)

    @classmethod
    def from_python(
        cls, name: str, pattern: str, replacement: str, ignore_case: bool = False
    ) -> Rule:
        """Take a rule written for Python's `re` (\\1, \\g<name>, (?P<name>...))."""
        java = pattern.replace("(?P<", "(?<")
        java = re.sub(r"\(\?P=(\w+)\)", r"\\k<\1>", java)
        text = replacement.replace("$", r"\$")
        text = re.sub(r"\\g<(\d+)>|\\(\d+)", lambda m: "$" + (m[1] or m[2]), text)
        text = re.sub(r"\\g<(\w+)>", r"${\1}", text)
        return cls(name, java, text, flags="(?iuU)" if ignore_case else "(?U)")


# The patterns and replacements of the default rules, specific
# ones before generic ones.
DEFAULT_RULES: tuple[Rule, ...] = (
    Rule(
        "connection_string",
        r"\b([A-Za-z0-9_.$#]+)/[^/@\s]+@([A-Za-z0-9_.\-]+(?::\d+)?(?:/[A-Za-z0-9_.\-]+)?)",
        "$1/" + MASK + "@$2",
        hint=Hint(literals=("/", "@")),
    ),
    Rule(
        "identified_by",
        r"(IDENTIFIED\s+BY\s+)(?:VALUES\s+)?(?:'[^']*'|\"[^\"]*\"|[^\s;]+)",
        "$1" + MASK,
        hint=Hint(words=("IDENTIFIED",)),
    ),
    Rule(
        "password_assignment",
        r"\b(pass(?:word)?|pwd)\b\s*[:=]\s*(?:'[^']*'|\"[^\"]*\"|\S+)",
        "$1=" + MASK,
        hint=Hint(words=("PASS", "PWD")),
    ),
)


def redact(c: Column, rules: Sequence[Rule] = DEFAULT_RULES) -> Column:
    """Redacted text; null and '' give ''. Texts that no rule can change skip them all."""
    text = or_empty(c)
    if not rules:
        return text
    candidate = reduce(lambda a, b: a | b, [rule.hint.holds(text) for rule in rules])
    rewritten = reduce(lambda acc, rule: rule.rewrite(acc), rules, text)
    return F.when(candidate, rewritten).otherwise(text)


def redact_columns(
    df: DataFrame, columns: Sequence[str], rules: Sequence[Rule] = DEFAULT_RULES
) -> DataFrame:
    """Redact several columns; a text only goes through rules that may change it.

    The hints are tested once, on the text as it comes. A rule runs when its own hint
    holds or when an earlier rule ran, whose replacement it may match. One projection
    per rule: each sees the finished text of the previous one, and no expression is
    evaluated twice.
    """
    step = df.withColumns({name: or_empty(F.col(name)) for name in columns})
    step = step.withColumns(
        {f"_hint{i}_{n}": r.hint.holds(F.col(n)) for n in columns for i, r in enumerate(rules)}
    )
    for i, rule in enumerate(rules):
        rewritten = {}
        for name in columns:
            runs = reduce(lambda a, b: a | b, [F.col(f"_hint{j}_{name}") for j in range(i + 1)])
            rewritten[name] = F.when(runs, rule.rewrite(F.col(name))).otherwise(F.col(name))
        step = step.withColumns(rewritten)
    return step.drop(*[f"_hint{i}_{n}" for n in columns for i in range(len(rules))])
