"""Dependencies of projects and the catalogue of instrumentations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackweave.functions import requirements as req

COMMUNITY = "community"
SUPPORTED = "supported"


@dataclass(frozen=True)
class Summary:
    """A heading row that shows the version of one of the project's own requirements."""

    title: str
    package: str
    link: str
    always_stable: bool = False


def parse_requirements(rows: DataFrame, rules: Sequence[tuple[str, str, str]] = ()) -> DataFrame:
    """Requirement texts split into name, version, stability and link."""
    return rows.withColumns(
        {"name": req.name(F.col("requirement")), "version": req.specifier(F.col("requirement"))}
    ).withColumns(
        {
            "stability": req.stability(F.col("version")),
            "source_href": req.source_link(F.col("name"), rules),
        }
    )


def dependencies(
    rows: DataFrame,
    summaries: Sequence[Summary],
    rules: Sequence[tuple[str, str, str]] = (),
    package_link: str = "https://pypi.org/project/",
) -> DataFrame:
    """Per project: the heading rows, then one row per requirement.

    When a project names a package twice, the later version is the one in the heading.
    """
    parsed = parse_requirements(rows, rules)
    latest = parsed.groupBy("project").agg(
        *[
            F.max(F.when(F.col("name") == s.package, F.struct("ord", "version"))).alias(f"_{i}")
            for i, s in enumerate(summaries)
        ]
    )

    def heading(i: int, s: Summary) -> Column:
        version = F.col(f"_{i}.version")
        return F.struct(
            F.lit(i - len(summaries)).cast("long").alias("ord"),
            F.lit(s.title).alias("name"),
            version.alias("version"),
            (F.lit(req.STABLE) if s.always_stable else req.stability(version)).alias("stability"),
            F.lit(s.link).alias("source_href"),
            F.lit(None).cast("string").alias("package_href"),
        )

    headings = latest.select(
        "project", F.inline(F.array(*[heading(i, s) for i, s in enumerate(summaries)]))
    ).filter(F.col("version").isNotNull())
    direct = parsed.select(
        "project", F.col("ord").cast("long").alias("ord"), "name", "version", "stability", "source_href",
        F.concat(F.lit(package_link), "name", F.lit("/")).alias("package_href"),
    )
    return headings.unionByName(direct)


def instrumentations(manifests: DataFrame, supported: Sequence[str] = ()) -> DataFrame:
    """What each package instruments. Packages without entry points are left out; those
    that name no requirement stand for themselves."""
    wanted = F.concat(
        F.coalesce("instruments", F.array().cast("array<string>")),
        F.coalesce("instruments_any", F.array().cast("array<string>")),
    )
    named = F.transform(
        wanted, lambda r: F.struct(req.name(r).alias("component"), r.alias("supported_versions"))
    )
    itself = F.array(
        F.struct(F.col("name").alias("component"), F.lit(None).cast("string").alias("supported_versions"))
    )
    return (
        manifests.filter(F.cardinality("entry_points") > 0)
        .select(
            "name",
            F.array_sort(F.map_keys("entry_points")).alias("keys"),
            F.coalesce("description", F.lit("")).alias("description"),
            F.when(F.size(wanted) > 0, named).otherwise(itself).alias("components"),
            F.lit(req.EXPERIMENTAL).alias("stability"),
            F.when(F.col("name").isin(*supported), SUPPORTED).otherwise(COMMUNITY).alias("support")
            if supported
            else F.lit(COMMUNITY).alias("support"),
        )
    )


def catalogue(manifests: DataFrame, supported: Sequence[str] = ()) -> DataFrame:
    """Instrumentations in the order of their keys, one row per component."""
    return (
        instrumentations(manifests, supported)
        .withColumn("keys", F.array_join("keys", ","))
        .select("keys", "name", F.posexplode("components").alias("position", "_c"),
                "description", "stability", "support")
        .select("keys", "name", "position", "_c.component", "_c.supported_versions",
                "description", "stability", "support")
        .orderBy("keys", "name", "position")
    )


def counts(sections: Mapping[str, DataFrame]) -> DataFrame:
    """Number of entries in each section of an inventory."""
    total = None
    for kind, section in sections.items():
        part = section.select(F.lit(kind).alias("kind"))
        total = part if total is None else total.unionByName(part)
    return total.groupBy("kind").agg(F.count("*").alias("entries"))
