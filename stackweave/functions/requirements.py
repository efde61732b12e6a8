"""Package requirement strings."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from stackweave.functions import text

# How versions mark a pre-release, and the two stability classes.
PRERELEASE_TAGS = ("a", "b", "rc")
PRERELEASE_WORDS = ("alpha", "beta", "dev")
STABLE = "stable"
EXPERIMENTAL = "experimental"


def _unconditional(requirement: Column) -> Column:
    """What stands before the environment marker."""
    return text.strip(F.substring_index(requirement, ";", 1))


def name(requirement: Column) -> Column:
    """Package name, the run of letters, digits and `_.-` in front; null when there is none."""
    return F.nullif(F.regexp_extract(_unconditional(requirement), r"^[\w.\-]+", 0), F.lit(""))


def specifier(requirement: Column) -> Column:
    """Version specifier without blanks and environment marker; an exact pin is the bare version."""
    package = name(requirement)
    rest = F.translate(F.substr(_unconditional(requirement), F.length(package) + 1), " ", "")
    exact = rest.startswith("==")
    return F.when(package.isNotNull(), F.when(exact, F.substr(rest, F.lit(3))).otherwise(rest))


def stability(version: Column) -> Column:
    """A pre-release has a tag between two digits, or names itself one."""
    lower = F.lower(version)
    tagged = [lower.rlike(f"[0-9]{tag}[0-9]") for tag in PRERELEASE_TAGS]
    named = [lower.contains(word) for word in PRERELEASE_WORDS]
    return F.when(reduce(or_, tagged + named), EXPERIMENTAL).otherwise(STABLE)


def source_link(package: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Link of the first rule a package meets.

    A rule is (`exact` or `prefix`, text, link), where `{name}` in the link stands for the
    package.
    """
    chosen = F.lit(None).cast("string")
    for kind, wanted, link in reversed(rules):
        test = package == wanted if kind == "exact" else package.startswith(wanted)
        chosen = F.when(test, F.replace(F.lit(link), F.lit("{name}"), package)).otherwise(chosen)
    return chosen
