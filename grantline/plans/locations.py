"""Pipeline 2: location grants."""

from dataclasses import dataclass

from pyspark.sql import DataFrame

from grantline.operators import access, documents
from grantline.plans.governance import Governance
from grantline.sinks.shared import stage


@dataclass(frozen=True)
class LocationPlan:
    locations: DataFrame
    role_locations: DataFrame


def plan_locations(
    governance: Governance,
    locations: DataFrame,
    buckets: DataFrame | None = None,
    create_new: bool = False,
    credential_name: str | None = None,
    anchored: bool = False,
) -> LocationPlan:
    """Registered (and, if asked for, proposed) locations and the roles that reach them.

    Held paths, matches and proposals are each read by several later steps and small next to the
    governance relation, so they are computed once and staged.
    """
    patterns = stage(access.governance_patterns(governance.access, governance.path_lists))
    matches = access.pattern_locations(patterns, locations, anchored)
    if create_new:
        if buckets is None or not credential_name:
            raise ValueError("new locations need the bucket inventory and a credential name")
        matches = stage(matches)
        uncovered = stage(access.uncovered_patterns(patterns, matches))
        proposals = stage(access.proposed_locations(uncovered, buckets, credential_name))
        new = access.new_locations(proposals)
        locations = locations.select(*access.LOCATION).unionByName(new)
        # The path behind a proposal covers it even where its expression is not found in the URL.
        new_matches = access.pattern_locations(patterns, new, anchored).unionByName(proposals)
        matches = matches.unionByName(new_matches)
    return LocationPlan(locations, access.role_locations(patterns, matches))


@dataclass(frozen=True)
class LocationLabels:
    """Labels per grantee and per location, the same in all blocks that refer to one another."""

    grantees: DataFrame
    locations: DataFrame


def grant_labels(governance: Governance, role_locations: DataFrame) -> LocationLabels:
    """Both are small next to the grants and read several times, so they are computed once and staged."""
    grantees = stage(access.grantee_labels(stage(access.grantee_names(governance.access))))
    names = stage(role_locations.select(*access.LOCATION_NAME).distinct())
    return LocationLabels(grantees, stage(access.location_labels(names, grantees)))


def location_document(
    governance: Governance,
    locations: DataFrame,
    buckets: DataFrame | None = None,
    create_new: bool = False,
    credential_name: str | None = None,
    anchored: bool = False,
) -> DataFrame:
    plan = plan_locations(governance, locations, buckets, create_new, credential_name, anchored)
    role_locations = stage(plan.role_locations)  # read by every section
    labels = grant_labels(governance, role_locations)
    grants = access.location_grants(governance.access, role_locations, labels.grantees, labels.locations)
    sections = [
        documents.location_data_sources(role_locations, labels.locations),
        documents.location_grant_blocks(grants),
    ]
    if create_new:
        sections.insert(0, documents.location_resources(role_locations, labels.locations))
    return documents.assemble(*sections)
