"""The layers that the engine normalizes: one declaration for each collection and provider source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import scalar as S
from ..operators.relational import resolve
from .normalize import Layer, date_of, identity_of, number, text

#: Collections that are named but not built: asking for them is an error, not an empty result (fixed values).
PLANNED = (
    "seasonal_closures",
    "gear_restrictions",
    "harvest_regulations",
    "salmon_management_zones",
    "whale_approach_regulation_zones",
    "management_regions",
    "reporting_areas",
)

#: Routing roles: role, collection, source, the source's own type, geometry family (fixed values).
ROUTING_ROLES = (
    ("chs_separation_line", "traffic_separation_schemes", "chs_routing_layer_2", "TSELNE_L", "line"),
    ("chs_scheme_boundary", "traffic_separation_schemes", "chs_routing_layer_2", "TSSBND_L", "line"),
    ("chs_separation_zone", "traffic_separation_schemes", "chs_routing_layer_3", "TSEZNE_A", "polygon"),
    ("chs_scheme_crossing", "traffic_separation_schemes", "chs_routing_layer_3", "TSSCRS_A", "polygon"),
    ("chs_lane_part", "traffic_separation_schemes", "chs_routing_layer_4", "TSSLPT_A", "polygon"),
    ("chs_recommended_lane_part", "shipping_lanes", "chs_routing_layer_4", "RCTLPT_A", "polygon"),
    ("chs_two_way_route_part", "shipping_lanes", "chs_routing_layer_4", "TWRTPT_A", "polygon"),
    ("chs_navigation_line", "shipping_lanes", "chs_routing_layer_5", "NAVLNE_L", "line"),
    ("chs_recommended_centerline", "shipping_lanes", "chs_routing_layer_5", "RCRTCL_L", "line"),
    ("chs_recommended_track", "shipping_lanes", "chs_routing_layer_5", "RECTRC_L", "line"),
    ("noaa_traffic_lane", "traffic_separation_schemes", "noaa_routing_2026", "Traffic Lane", "polygon"),
    ("noaa_separation_zone", "traffic_separation_schemes", "noaa_routing_2026", "Separation Zone", "polygon"),
    ("noaa_fairway", "shipping_lanes", "noaa_routing_2026", "Fairway", "polygon"),
    ("noaa_two_way_route", "shipping_lanes", "noaa_routing_2026", "Two-Way Route", "polygon"),
    ("noaa_recommended_route", "shipping_lanes", "noaa_routing_2026", "Recommended Route", "polygon"),
)
#: Types of the second provider that are no routing components (fixed values).
ROUTING_SKIPPED = ("Area To Be Avoided", "Precautionary Area", "Particularly Sensitive Sea Area")

#: Programs of the protected-area inventory by source (fixed values).
MPA_PROGRAMS = {
    "noaa_mpa_inventory_2023": "NOAA Marine Protected Areas Inventory",
    "noaa_mpa_inventory_states": "State, Tribal, territorial, and local MPAs",
    "noaa_mpa_inventory_nerrs": "National Estuarine Research Reserve System",
    "noaa_mpa_inventory_boem": "Bureau of Ocean Energy Management MPAs",
    "noaa_mpa_inventory_marine_national_monuments": "Marine national monuments",
    "noaa_mpa_inventory_national_marine_sanctuaries": "National marine sanctuaries",
    "noaa_mpa_inventory_national_park_service": "National Park Service marine units",
    "noaa_mpa_inventory_national_wildlife_refuge_system": "National Wildlife Refuge System marine units",
    "noaa_mpa_inventory_national_forest_service": "National Forest Service marine units",
}

#: Sanctuaries by source: id, name, subdivision, start, subpart, square miles by regulation (fixed values).
SANCTUARIES = {
    "noaa_onms_channel_islands_boundary": ("CINMS", "Channel Islands National Marine Sanctuary", "US-CA", "1980-09-22", "G", 1470.0),
    "noaa_onms_chumash_heritage_boundary": ("CHNMS", "Chumash Heritage National Marine Sanctuary", "US-CA", "2024-11-30", "V", 4543.0),
    "noaa_onms_cordell_bank_boundary": ("CBNMS", "Cordell Bank National Marine Sanctuary", "US-CA", "1989-05-24", "K", 1286.0),
    "noaa_onms_greater_farallones_boundary": ("GFNMS", "Greater Farallones National Marine Sanctuary", "US-CA", "1981-01-16", "H", 3295.0),
    "noaa_onms_monterey_bay_boundary": ("MBNMS", "Monterey Bay National Marine Sanctuary", "US-CA", "1992-09-18", "M", 6093.0),
    "noaa_onms_olympic_coast_boundary": ("OCNMS", "Olympic Coast National Marine Sanctuary", "US-WA", "1994-07-22", "O", 3188.0),
}

#: Maritime zones by source: type, nautical miles, label (fixed values).
MARITIME_ZONES = {
    "noaa_us_territorial_sea_dynamic": ("territorial_sea", 12, "U.S. territorial sea"),
    "noaa_us_contiguous_zone_dynamic": ("contiguous_zone", 24, "U.S. contiguous zone"),
    "noaa_us_eez_dynamic": ("exclusive_economic_zone", 200, "U.S. EEZ"),
}
#: Roles of maritime lines by rule number (fixed values).
RULE_ROLES = {
    1: "international_land_boundary",
    2: "eez_outer_limit",
    3: "territorial_sea_outer_limit",
    4: "international_maritime_boundary_and_eez",
    5: "international_maritime_boundary",
    6: "unused_or_unclassified",
    7: "contiguous_zone_outer_limit",
    8: "eastern_special_area",
}

#: Reported classifications by (protected-area definition, status): role, class, status (fixed values).
CLASSIFICATIONS = {
    (1, 1): ("reported_pa_designated", "Protected area (PA)", "Designated"),
    (2, 1): ("reported_oecm_designated", "Other effective area-based conservation measure (OECM)", "Designated"),
    (3, 3): ("reported_interim_pa", "Interim - protected area (PA)", "Interim"),
    (5, 1): ("reported_not_applicable_designated", "Not applicable", "Designated"),
}
#: Types of Canadian refuges that are kept (fixed values).
REFUGE_TYPES = ("National Wildlife Area", "Marine National Wildlife Area", "Migratory Bird Sanctuary")
#: Management areas that have a subarea 0 (fixed values).
ZERO_SUBAREAS = ("21", "22", "103", "109", "110", "111")


#: Fields of the protected-area inventory that are handed on as they are, by our names (fixed values).
MPA_FIELDS = {
    "government_level": "gov_level",
    "source_subdivision_code": "State",
    "source_designation_type": "Design",
    "primary_conservation_focus": "pri_con_fo",
    "conservation_focus": "cons_focus",
    "protection_focus": "prot_focus",
    "protection_level": "prot_lvl",
    "national_system_status": "ns_full",
    "management_plan_status": "mgmt_plan",
    "permanence": "permanence",
    "constancy": "constancy",
    "fishing_restrictions": "fish_rstr",
    "vessel_restrictions": "vessel",
    "anchoring_restrictions": "anchor",
    "iucn_class": "IUCNcat",
}
#: What is said of the inventory's records (fixed values).
MPA_STATES = {
    "effective_status": "inventory_lists_existing_mpa_not_legally_reverified",
    "rule_status": "program_framework_only_site_rule_not_in_inventory",
    "purpose_status": "noaa_inventory_reference_classification",
    "activity_status": "inventory_restriction_classes_retained_not_interpreted_as_legal_rules",
    "geometry_status": "inventory_reference_polygon_not_controlling_legal_source",
}
IUCN_STATES = ("sourced_noaa_inventory_reference", "inventory_scope_uses_iucn_definition_but_category_not_sourced")
#: What is said of routing components and how their identity came about (fixed values).
ROUTING_JURISDICTION = "Published source coverage; no jurisdiction inferred"
ROUTING_IDENTITY = ("CHS object LNAM within type; chart records retained", "snapshot source record ID; no logical route equivalence inferred")
#: States of the comparison with an area by regulation (fixed values).
AREA_STATES = ("within_0_5_percent_of_current_cfr_approx_area", "outside_0_5_percent_of_current_cfr_approx_area")
SQUARE_METRES_PER_MILE = 2_589_988.110336


def _is(name: str, *values: str):
    return lambda df: F.coalesce(S.clean(resolve(df, name)).isin(*values), F.lit(False))


def _id(*parts):
    """A concatenation of constants and cleaned fields (in braces); null if a field is."""
    return lambda df: F.concat(*[S.clean(resolve(df, p[1:-1])) if p.startswith("{") else F.lit(p) for p in parts])


def _lookup(name: str, values: dict, otherwise: str):
    def of(df: DataFrame) -> Column:
        c = S.strict_int(resolve(df, name))
        return F.coalesce(*[F.when(c == k, F.lit(v)) for k, v in values.items()], F.lit(otherwise))

    return of


def _slug(*names: str):
    return lambda df: F.coalesce(F.nullif(S.slug(text(*names)(df)), F.lit("")), text(names[-1])(df))


def _pair(field: int):
    """A part of the reported classification; an unknown pair is an error."""

    def of(df: DataFrame) -> Column:
        a, b = S.required_int(resolve(df, "PA_OECM_DF"), "PA_OECM_DF"), S.required_int(resolve(df, "STATUS"), "STATUS")
        found = F.coalesce(*[F.when((a == k[0]) & (b == k[1]), F.lit(v[field])) for k, v in CLASSIFICATIONS.items()])
        return F.when(found.isNull(), F.raise_error(F.concat(F.lit("unknown classification "), a.cast("string"), F.lit("/"), b.cast("string"))).cast("string")).otherwise(found)

    return of


def _oregon_kind(df: DataFrame) -> Column:
    name = S.clean(resolve(df, "ODFW_NAME"))
    return F.when(name.contains("Marine Reserve"), "marine_reserve").when(name.contains("Seabird"), "seabird_protection_area").otherwise("marine_protected_area")


def _habitat_date(c: Column) -> Column:
    text_ = S.clean(c)
    return F.coalesce(S.effective_date(text_), S.iso_date(F.when(S.effective_date(text_).isNull(), text_)))


def _providers() -> dict[tuple[str, str], Layer]:
    out: dict[tuple[str, str], Layer] = {}

    def add(collection: str, source: str, layer: Layer) -> None:
        out[collection, source] = layer

    for source, program in MPA_PROGRAMS.items():
        agency = text("mgmt_agen")
        federal = lambda df: F.lower(text("gov_level")(df)).contains("federal")
        add("marine_protected_areas", source, Layer(
            source, ("site_id",), "MPA_", "marine_protected_area_inventory_polygon", title=("site_name", "site_label", "site_id"), authority=("mgmt_agen",),
            jurisdiction="United States", legal_url=text("url"), coverage="partial_noaa_discovery_inventory", feature_id=_id("marine_protected_area:usa:", "{site_id}"),
            fields={
                "source_record_id": text("site_id"), "designation_id": _id("USA:NOAA_MPA:", "{site_id}"), "designation_status": "active_reference_inventory",
                "country_code": "USA", "program": program, "established": lambda df: S.year(text("estab_yr")(df)), "source_date": date_of("date_gis_u"),
                "authority_id": lambda df: F.concat(F.lit("USA:AGENCY:"), F.coalesce(F.nullif(S.slug(text("mgmt_agen")(df)), F.lit("")), F.lit("unknown"))),
                "map_group": lambda df: F.when(federal(df), "us_federal_program_reference").otherwise("us_state_tribal_local_reference"),
                "marine_area_km2": number("AreaMar", "area_km_ma"), "total_area_km2": number("AreaKm", "area_km_to"), "purpose": text("pri_con_fo"),
                "established_precision": lambda df: F.when(text("estab_yr")(df).isNull(), "unknown").otherwise("year"),
                "iucn_status": lambda df: F.when(text("IUCNcat")(df).isNull(), IUCN_STATES[1]).otherwise(IUCN_STATES[0]),
                **{name: text(field) for name, field in MPA_FIELDS.items()}, **MPA_STATES,
            }, vintage=date_of("date_gis_u"),
            qc_reason="Discovery and reference geometry of an inventory; agency and program are kept, a verified rule of the site is not in it."))
    active = {"source_record_id": text("OBJECTID"), "country_code": "CAN", "authority_id": "CAN:DFO"}
    add("marine_protected_areas", "dfo_oceans_act_marine_protected_areas", Layer(
        "dfo_oceans_act_marine_protected_areas", ("OBJECTID",), "DFO_", "oceans_act_marine_protected_area_zone_polygon", required=("NAME_E", "ZONE_E"),
        title=("NAME_E", "NAME_F", "OBJECTID"), authority="Fisheries and Oceans Canada", jurisdiction="Canada", legal_authority=text("REGULATION"), legal_url=text("REGULATION", "URL_E"),
        coverage="partial_dfo_oceans_act_reference",
        feature_id=lambda df: F.concat_ws(":", F.lit("marine_protected_area:can"), _slug("NAME_E", "NAME_F", "OBJECTID")(df), text("OBJECTID")(df)),
        fields=active | {
            "designation_id": lambda df: F.concat(F.lit("CAN:DFO_OCEANS_ACT:"), _slug("NAME_E", "NAME_F", "OBJECTID")(df)), "designation_status": "active_designated",
            "zone_name": text("ZONE_E"), "program": "Oceans Act Marine Protected Area", "total_area_km2": number("KM2"),
            "rule_status": lambda df: F.when(text("REGULATION")(df).isNull(), "regulation_citation_missing_from_source_feature").otherwise("source_regulation_citation_present"),
        }))
    add("marine_protected_areas", "dfo_oceans_act_areas_of_interest", Layer(
        "dfo_oceans_act_areas_of_interest", ("OBJECTID",), "DFO_", "oceans_act_area_of_interest_point", required=("NAME_E",), title=("NAME_E", "NAME_F", "OBJECTID"),
        authority="Fisheries and Oceans Canada", jurisdiction="Canada", legal_url=text("URL_E"), legal_status="proposal_reference_geometry",
        coverage="partial_dfo_area_of_interest_points", feature_id=lambda df: F.concat(F.lit("marine_protected_area_aoi:can:"), _slug("NAME_E", "NAME_F", "OBJECTID")(df)),
        fields=active | {
            "designation_id": lambda df: F.concat(F.lit("CAN:DFO_AOI:"), _slug("NAME_E", "NAME_F", "OBJECTID")(df)), "designation_status": "area_of_interest",
            "program": "Oceans Act Marine Protected Area establishment process",
        }))
    add("marine_protected_areas", "odfw_marine_reserves_2016", Layer(
        "odfw_marine_reserves_2016", ("ODFW_RECORD_ID",), "ODFW_", "odfw_published_protected_boundary_reference", required=("ODFW_NAME",), title=("ODFW_NAME",), families="polygon",
        jurisdiction="Oregon", coverage="partial_published_oregon_reference", feature_id=_id("odfw_reference:", "{ODFW_RECORD_ID}"),
        fields={
            "source_record_id": text("ODFW_RECORD_ID"), "designation_id": _id("USA:ODFW_KML:", "{ODFW_RECORD_ID}"), "designation_status": "active_reference_inventory", "country_code": "USA",
            "authority_id": "USA:ODFW", "zone_name": text("ODFW_NAME"), "designation_type": _oregon_kind, "program": "Oregon Marine Reserves and MPAs",
        }))

    for source, (key, name, subdivision, start, subpart, miles) in SANCTUARIES.items():
        add("national_marine_sanctuaries", source, Layer(
            source, ("POLY_ID",), "ONMS_", "national_marine_sanctuary_boundary_polygon", feature_name=name, authority="NOAA Office of National Marine Sanctuaries",
            jurisdiction="United States", legal_status="binding_designation_reference_geometry", coverage="complete_current_noaa_west_coast_sanctuary_roster",
            feature_id=lambda df, key=key: F.lit("national_marine_sanctuary:" + key.lower()), families="polygon",
            fields={
                "sanctuary_id": key, "subdivision_code": subdivision, "country_code": "USA", "authority_id": "USA:NOAA:ONMS", "designation_status": "active_designated", "cfr_subpart": subpart,
                "polygon_name": text("AREA_NAME", "Name"), "area_sqmi": number("AREA_SQMI", "AREA_SM"), "cfr_area_sqmi": miles, "designated": start,
            }))
    for source in ("noaa_critical_habitat_polygon", "noaa_critical_habitat_line"):
        add("critical_habitat", source, Layer(
            source, ("OBJECTID",), "NOAA_", "critical_habitat_inventory_reference", required=("EFFECTDATE",), title=("LISTENTITY", "COMNAME"),
            authority="NOAA National Marine Fisheries Service", jurisdiction="United States reference inventory", legal_authority=text("ECFR"), legal_url=text("ECFR"),
            coverage="partial_nmfs_only", started=("EFFECTDATE",), dates=_habitat_date))
    refuge = dict(feature_type="wildlife_refuge_inventory_reference", legal=False, coverage="partial_selected_refuge_systems")
    add("wildlife_refuges", "fws_national_wildlife_refuges", Layer(
        "fws_national_wildlife_refuges", ("OBJECTID",), "FWS_", title=("ORGNAME",), required=("RSL_TYPE",), keep=_is("RSL_TYPE", "NWR"),
        jurisdiction="United States reference inventory", fields={"refuge_type": text("RSL_TYPE")}, **refuge))
    add("wildlife_refuges", "eccc_wildlife_areas_sanctuaries", Layer(
        "eccc_wildlife_areas_sanctuaries", ("OBJECTID",), "ECCC_", title=("NAME_E",), required=("TYPE_E",), keep=_is("TYPE_E", *REFUGE_TYPES),
        jurisdiction="Canada reference inventory", fields={"refuge_type": text("TYPE_E")}, **refuge))
    evidence = lambda df: F.concat(F.lit("cpcad:parent:"), S.required_int(resolve(df, "PARENT_ID"), "PARENT_ID").cast("string"), F.lit(":zone:"), S.required_int(resolve(df, "ZONE_ID"), "ZONE_ID").cast("string"))
    add("conservation_designations", "eccc_marine_classification", Layer(
        "eccc_marine_classification", ("OBJECTID",), "ECCC_", "provider_reported_marine_classification_zone", required=("BIOME", "PA_OECM_DF", "STATUS", "PARENT_ID", "ZONE_ID"),
        title=("NAME_E",), legal=False, coverage="partial_source_selected_marine_inventory", rules={"not marine": _is("BIOME", "M")}, feature_id=evidence,
        fields={"classification_role": _pair(0), "class_label": _pair(1), "status_label": _pair(2), "evidence_key": evidence}))

    segment, bounds = "international_boundary_reference_segment", "partial_authoritative_reference"
    add("international_boundaries", "noaa_us_maritime_limits", Layer(
        "noaa_us_maritime_limits", ("BOUND_ID",), "NOAA_", segment, keep=lambda df: F.coalesce(F.lower(resolve(df, "FEAT_TYPE")).contains("boundary"), F.lit(False)),
        title=("REGION", "BOUND_ID"), authority=("AOR",), jurisdiction=lambda df: F.coalesce(text("REGION")(df), F.lit("Canada-United States")), legal_authority=text("LEGAL_AUTH"),
        legal_url=text("SUPP_INFO"), coverage=bounds, otherwise=("OBJECTID",), vintage=date_of("PUB_DATE"),
        feature_id=lambda df: F.concat(F.lit("international_boundary:noaa:"), identity_of("BOUND_ID", "OBJECTID")(df)),
        fields={"boundary_id": identity_of("BOUND_ID", "OBJECTID"), "agency": text("AOR"), "status": text("STATUS"), "region": text("REGION"), "publication_date": date_of("PUB_DATE"), "approval_date": date_of("APPRV_DATE"), "source_role": "agency_boundary_reference"}))
    add("international_boundaries", "international_boundary_commission_v1_3", Layer(
        "international_boundary_commission_v1_3", ("SectionNum",), "IBC_", segment, title=("SectionEng", "SectionNum"), jurisdiction="Canada-United States", coverage=bounds,
        feature_id=_id("international_boundary:ibc:section-", "{SectionNum}"),
        fields={
            "boundary_id": _id("IBC-", "{SectionNum}"), "section_number": text("SectionNum"), "scale": text("MaxScale"), "scale_denominator": lambda df: S.scale_denominator(text("MaxScale")(df)),
            "source_role": "commission_boundary_reference",
        }))
    add("international_boundaries", "nrcan_canadian_geopolitical_boundaries_lines", Layer(
        "nrcan_canadian_geopolitical_boundaries_lines", ("UUID",), "CGB_", segment, keep=_is("TYPE_E", "INTERN"), authority=("SRC_AGENCY",), jurisdiction="Canada-United States",
        feature_name=lambda df: F.concat(F.lit("CGB international boundary "), identity_of("UUID")(df)), legal_authority=text("SRC_DESC"), coverage=bounds, otherwise=("UUID",),
        vintage=date_of("P_UPD_DATE"), feature_id=lambda df: F.concat(F.lit("international_boundary:cgb:"), identity_of("UUID")(df)),
        fields={"boundary_id": identity_of("UUID"), "agency": text("SRC_AGENCY"), "status": text("STATUS"), "publication_date": date_of("P_UPD_DATE"), "accuracy_m": number("ACCUR"), "source_role": "canadian_government_boundary_reference"}))

    for source, (zone, miles, label) in MARITIME_ZONES.items():
        add("federal_waters", source, Layer(
            source, ("BOUND_ID",), "NOAA_", zone + "_limit", authority=("AOR",), jurisdiction="United States", legal_authority=text("LEGAL_AUTH"), legal_url=text("SUPP_INFO"),
            feature_name=lambda df, label=label: F.concat(F.coalesce(text("REGION")(df), identity_of("BOUND_ID", "OBJECTID")(df)), F.lit(f" — {label} limit")),
            coverage="partial_current_dynamic_reference", otherwise=("OBJECTID",), vintage=date_of("PUB_DATE"),
            feature_id=lambda df, zone=zone: F.concat(F.lit(f"us_maritime_zone:{zone}:"), identity_of("BOUND_ID", "OBJECTID")(df)),
            fields={
                "country_code": "USA", "zone_type": zone, "zone_limit_nm": miles, "boundary_id": identity_of("BOUND_ID", "OBJECTID"), "layer_name": label, "region": text("REGION"),
                "rule_label": text("RULE", "RULE_DESC"), "agency": text("AOR"), "status": text("STATUS"),
                "zone_qc_reason": "A line of the provider's own zone layer; it is no polygon and was not buffered, nested, dissolved or turned into waters.", "rule_id": lambda df: S.strict_int(resolve(df, "RULEID")),
                "geometry_role": _lookup("RULEID", RULE_ROLES, "source_value_unknown"), "publication_date": date_of("PUB_DATE"), "approval_date": date_of("APPRV_DATE"),
                "accuracy_m": number("POS_ACC"),
            }))
    add("federal_waters", "nrcan_canadian_geopolitical_boundaries_lines", Layer(
        "nrcan_canadian_geopolitical_boundaries_lines", ("UUID",), "CGB_", "exclusive_economic_zone_limit", keep=lambda df: F.coalesce(F.upper(resolve(df, "TYPE_E")).startswith("EEZ"), F.lit(False)),
        feature_name=lambda df: F.concat(F.lit("Canadian EEZ reference limit "), identity_of("UUID")(df)), authority=("SRC_AGENCY",), jurisdiction="Canada", coverage="partial_archived_government_reference",
        legal_authority=lambda df: F.concat_ws("; ", F.lit("Canada Oceans Act"), text("SRC_DESC")(df)), otherwise=("UUID",), vintage=date_of("P_UPD_DATE"),
        feature_id=lambda df: F.concat(F.lit("can_maritime_zone:exclusive_economic_zone:"), identity_of("UUID")(df)),
        fields={
            "country_code": "CAN", "zone_type": "exclusive_economic_zone", "zone_limit_nm": 200, "boundary_id": identity_of("UUID"), "region": "Canada", "agency": text("SRC_AGENCY"),
            "status": text("STATUS"), "layer_name": "GeoBase Canadian Geopolitical Boundaries Level 1", "rule_label": lambda df: F.coalesce(F.upper(text("TYPE_E")(df)), F.lit("EEZ")),
            "zone_qc_reason": "An archived cartographic reference, no controlling legal boundary; waters inside it were not inferred.", "publication_date": date_of("P_UPD_DATE"), "accuracy_m": number("ACCUR"),
            "geometry_role": lambda df: F.when(F.upper(text("TYPE_E")(df)) == "EEZ_200", "eez_200nm_outer_limit").otherwise("eez_bilateral_or_shared_boundary"),
        }))
    add("state_provincial_waters", "boem_submerged_lands_boundary", Layer(
        "boem_submerged_lands_boundary", ("OBJECTID",), "BOEM_", "state_seaward_boundary_line", authority="Bureau of Ocean Energy Management", jurisdiction="United States coastal states",
        feature_name=lambda df: F.coalesce(text("BDRY_NAME_TEXT")(df), F.lit("Submerged Lands Act boundary")), coverage="partial_boundary_line_only", feature_id=_id("state_seaward_boundary:", "{OBJECTID}"),
        fields={"approval_date": text("BDRY_APRV_DATE"), "block_number": text("BLOCK_NUMBER")}))
    add("county_regional_boundaries", "census_counties_2025", Layer(
        "census_counties_2025", ("GEOID",), "CENSUS_", "county_equivalent_statistical_reference", title=("NAMELSAD", "NAME"), jurisdiction="United States cartographic reference", legal=False,
        legal_status="non_binding_cartographic_reference", coverage="partial_us_only_reference_inventory", rules={"not a five-digit id": lambda df: S.is_geoid(S.clean(resolve(df, "GEOID")))}))
    areas = dict(feature_type="provider_administrative_reference", legal=False, coverage="partial_source_selected_administrative_inventory", families="polygon")
    add("tribal_first_nations_areas", "bia_administrative_lar", Layer(
        "bia_administrative_lar", ("OBJECTID",), "BIA_", title=("LARNAME",), required=("LARID", "CLASSIFICATION"), feature_id=_id("bia_administrative_lar:area:", "{LARID}"),
        rules={"no area id": lambda df: text("LARID")(df).isNotNull()}, fields={"admin_role": "bia_land_area_reference", "area_id": text("LARID")}, **areas))
    add("tribal_first_nations_areas", "nrcan_indian_reserves", Layer(
        "nrcan_indian_reserves", ("OBJECTID",), "NRCAN_", title=("adminAreaNameEng",), required=("adminAreaId", "distributionTypeEng", "jurisdictionEng"),
        feature_id=_id("nrcan_indian_reserves:area:", "{adminAreaId}"),
        rules={"no area id": lambda df: text("adminAreaId")(df).isNotNull(), "outside the scope": lambda df: _is("distributionTypeEng", "Indian Reserve")(df) & _is("jurisdictionEng", "British Columbia")(df)},
        fields={"admin_role": "nrcan_indian_reserve_reference", "area_id": text("adminAreaId")}, **areas))

    add("management_areas", "wdfw_recreational_marine_areas", Layer(
        "wdfw_recreational_marine_areas", ("OBJECTID",), "WDFW_", "recreational_marine_catch_reporting_area", required=("AreaName",), authority="Washington Department of Fish and Wildlife",
        feature_name=lambda df: F.concat_ws(" — ", F.concat(F.lit("WDFW Marine Area "), text("AreaName")(df)), text("AreaTitle")(df)), jurisdiction="Washington", legal_authority=text("WAC"),
        coverage="partial_washington_recreational_only", feature_id=_id("wdfw_marine_area:", "{AreaName}"), rules={"no area": lambda df: text("AreaName")(df).isNotNull()},
        fields={"area_system": "wdfw.recreational_marine_catch_reporting", "area_level": "marine_area", "fishery_sector": "recreational", "area_code": text("AreaName"), "area_title": text("AreaTitle")}))
    six = lambda df: F.coalesce(text("STAT_AREA")(df).rlike("^[1-9][0-9]{5}$"), F.lit(False))
    add("management_areas", "adfg_groundfish_statistical_areas", Layer(
        "adfg_groundfish_statistical_areas", ("OBJECTID",), "ADFG_", "groundfish_statistical_reporting_area", required=("STAT_AREA", "GEOMETRY_START_DATE", "GEOMETRY_END_DATE"), legal=False,
        feature_name=_id("ADF&G groundfish statistical area ", "{STAT_AREA}"), coverage="partial_adfg_groundfish_reporting_only", feature_id=_id("adfg.groundfish.statistical:", "{STAT_AREA}"),
        families="polygon", rules={"not a six-digit area": six},
        fields={
            "area_system": "adfg.groundfish.statistical", "area_level": "statistical_area", "fishery_sector": "commercial_reporting", "area_code": text("STAT_AREA"),
            "area_title": text("REGISTRATION_AREA_NAME"), "valid_from": date_of("GEOMETRY_START_DATE"), "valid_to": date_of("GEOMETRY_END_DATE"),
        }))
    area, sub = (lambda df, c=c: S.strict_int(resolve(df, c)).cast("string") for c in ("MGNT_AREA", "SUBAREA_"))
    code = lambda df: F.concat(area(df), F.lit("-"), sub(df))
    add("management_areas", "dfo_pacific_fishery_management_areas", Layer(
        "dfo_pacific_fishery_management_areas", ("OBJECTID",), "DFO_PFMA_", "pacific_fishery_management_subarea_reference", required=("MGNT_AREA", "SUBAREA_", "GLOBALID"), families="polygon",
        feature_name=lambda df: F.coalesce(text("NAME")(df), F.concat(F.lit("DFO Pacific subarea "), code(df))), coverage="partial_dfo_pacific_subareas_reference",
        feature_id=lambda df: F.concat(F.lit("dfo.pacific.pfma.subarea:"), code(df)),
        rules={
            "not a positive area": lambda df: S.strict_int(resolve(df, "MGNT_AREA")) >= 1, "not a subarea": lambda df: (S.strict_int(resolve(df, "SUBAREA_")) >= 1) | ((sub(df) == "0") & area(df).isin(*ZERO_SUBAREAS)),
            "malformed global id": lambda df: S.is_uuid(F.regexp_replace(text("GLOBALID")(df), "^[{]|[}]$", "")),
        },
        fields={"area_system": "dfo.pacific.pfma.subareas", "area_level": "subarea", "parent_area": area, "area_code": code, "area_title": text("NAME"), "global_id": text("GLOBALID")}))

    for collection in ("traffic_separation_schemes", "shipping_lanes"):
        for source in {r[2] for r in ROUTING_ROLES}:
            mine = [r for r in ROUTING_ROLES if r[2] == source]
            chs = source.startswith("chs_")
            roles = {raw: role if home == collection else None for role, home, _, raw, _ in mine} | ({} if chs else dict.fromkeys(ROUTING_SKIPPED))
            raw, oid = ("MERGE_SRC", "OBJECTID") if chs else ("routeType", "SOURCE_FID")
            record = _id(f"{source}:", f"{{{oid}}}")
            logical = (lambda df, record=record: F.coalesce(_id("chs:", "{MERGE_SRC}", ":", "{LNAM}")(df), record(df))) if chs else record
            add(collection, source, Layer(
                source, (oid,), "CHS_" if chs else "NOAA_ROUTING_", "routing_component_reference", type_field=raw, types=roles, role_field="routing_role", legal=False,
                feature_name=lambda df, chs=chs: F.coalesce(text("OBJNAM" if chs else "location")(df), F.initcap(F.replace(F.col("__kind"), F.lit("_"), F.lit(" ")))),
                jurisdiction=ROUTING_JURISDICTION, coverage="partial_selected_routing_inventory", feature_id=logical,
                families={role: family for role, home, _, _, family in mine if home == collection} or None, fields={
                    "routing_source_type": text(raw),
                    "routing_identity": (lambda df: F.when(text("LNAM")(df).isNull(), ROUTING_IDENTITY[1]).otherwise(ROUTING_IDENTITY[0])) if chs else ROUTING_IDENTITY[1],
                }))
    for collection, schedule, kind, clause, knots in (
        ("exclusion_zones", "schedule2", "fixed_vessel_restriction_reference", "5-6", None),
        ("speed_restriction_zones", "schedule3", "fixed_speed_restriction_reference", "7-8", 10.0),
    ):
        add(collection, "tc_srkw_interim_order_2026", Layer(
            "tc_srkw_interim_order_2026", ("zone_id",), "TC_", kind, keep=_is("schedule", schedule), required=("schedule",), legal_status="derived_reference_geometry",
            feature_name=lambda df: S.title(F.replace(text("zone_id")(df), F.lit("_"), F.lit(" "))), legal_authority="Canada Shipping Act 2001; 2026 interim order",
            coverage="partial_named_instrument_closed_coordinate_rings", feature_id=_id("tc.2026:", "{zone_id}"), families="polygon",
            fields={
                "instrument_id": "tc.srkw.interim_order.2026", "instrument_version": "2026-05-22", "rule_clause": clause, "issuing_authority": "Minister of Transport, Canada",
                "original_quantity": (lambda df, knots=knots: F.lit(knots).cast("double")), "original_unit": "knots over ground" if knots else None,
                "effective_from": "2026-06-01", "effective_to": "2026-11-30",
            }))
    add("ports", "nga_world_port_index", Layer(
        "nga_world_port_index", ("portNumber",), "NGA_", "published_port_location_point", title=("portName",), authority="NGA World Port Index", legal=False,
        legal_status="non_binding_physical_reference", coverage="partial_published_port_inventory", feature_id=_id("nga_wpi:", "{portNumber}"), families="point"))
    guard = dict(feature_type="coast_guard_administrative_reference", legal=False, coverage="partial_app_grid_selected_administrative_units", families="polygon")
    add("coast_guard_sectors", "uscg_app_sectors", Layer("uscg_app_sectors", ("FID",), "USCG_", title=("NAME",), fields={"admin_unit_role": "uscg_sector"}, **guard))
    add("coast_guard_sectors", "ccg_western_region", Layer("ccg_western_region", ("OBJECTID_1",), "CCG_", title=("Name",), fields={"admin_unit_role": "ccg_administrative_region"}, **guard))
    return out


PROVIDERS: dict[tuple[str, str], Layer] = _providers()

#: What holds for a source of a collection that PROVIDERS doesn't name: identity, prefix, type and title.
LAYERS: dict[str, Layer] = {
    x.name: x
    for x in (
        Layer("marine_protected_areas", ("site_id",), "MPA_", "marine_protected_area", title=("site_name",), authority=("mgmt_agen",)),
        Layer("critical_habitat", ("OBJECTID",), "CH_", "critical_habitat", title=("LISTENTITY",), started=("EFFECTDATE",), dates=S.effective_date),
        Layer("national_marine_sanctuaries", ("record_id",), "ONMS_", "national_marine_sanctuary", title=("Name",), feature=("Name",)),
        Layer("wildlife_refuges", ("OBJECTID",), "FWS_", "wildlife_refuge", title=("ORGNAME",), required=("RSL_TYPE",), keep=_is("RSL_TYPE", "NWR")),
        Layer("conservation_designations", ("PARENT_ID", "ZONE_ID"), "ECCC_", "conservation_designation", title=("NAME_E",), feature=("PARENT_ID",)),
        Layer("international_boundaries", ("OBJECTID",), "IB_", "international_boundary", title=("BOUND_ID",)),
        Layer("federal_waters", ("OBJECTID",), "FW_", "maritime_limit", title=("BOUND_ID",), authority=("LEGAL_AUTH",), started=("APPRV_DATE",)),
        Layer("state_provincial_waters", ("OBJECTID",), "BOEM_", "submerged_lands_boundary", title=("BDRY_NAME_TEXT",), started=("BDRY_APRV_DATE",)),
        Layer("county_regional_boundaries", ("GEOID",), "CENSUS_", "county", title=("NAME",), required=("FUNCSTAT",)),
        Layer("tribal_first_nations_areas", ("OBJECTID",), "TRIBAL_", "tribal_area", title=("LARNAME", "adminAreaNameEng"), feature=("LARID", "adminAreaId")),
        Layer("management_areas", ("OBJECTID",), "AREA_", "fisheries_management_area", title=("AreaTitle", "AreaName"), feature=("STAT_AREA", "AreaName")),
        Layer("shipping_lanes", ("OBJECTID",), "ROUTE_", "routing_component_reference", title=("OBJNAM",), feature=("LNAM",)),
        Layer("traffic_separation_schemes", ("OBJECTID",), "ROUTE_", "routing_component_reference", title=("OBJNAM",), feature=("LNAM",)),
        Layer("exclusion_zones", ("zone_id",), "TC_", "fixed_vessel_restriction_reference", title=("label",)),
        Layer("speed_restriction_zones", ("zone_id",), "TC_", "fixed_speed_restriction_reference", title=("label",)),
        Layer("ports", ("portNumber",), "NGA_", "port", title=("portName",)),
        Layer("coast_guard_sectors", ("FID",), "CG_", "coast_guard_sector", title=("NAME",)),
    )
}


def layer_of(collection: str, source_id: str) -> Layer:
    """The declaration of a provider's source, or what holds for any other source of the collection."""
    return PROVIDERS.get((collection, source_id), LAYERS[collection])


def area_checked(features: DataFrame) -> DataFrame:
    """Sanctuaries with the area of each source's polygons together against the area by regulation.

    Adds geometry_area_sqmi, area_difference_percent and area_status, and sets qc_status and
    qc_reason by whether they agree within half a percent.
    """
    from ..operators.repair import areas

    area = features.select("source_id", areas(F.col("wkb")).alias("m2"), "cfr_area_sqmi").groupBy("source_id").agg((F.sum("m2") / SQUARE_METRES_PER_MILE).alias("geometry_area_sqmi"), F.max("cfr_area_sqmi").alias("__cfr"))
    area = area.withColumn("area_difference_percent", 100 * (F.col("geometry_area_sqmi") - F.col("__cfr")) / F.col("__cfr")).drop("__cfr")
    near = F.abs(F.col("area_difference_percent")) <= 0.5
    said = lambda a, b: F.when(near, a).otherwise(b)
    out = features.join(F.broadcast(area), "source_id").select(*features.columns, "geometry_area_sqmi", "area_difference_percent")  # a row for each configured source
    return out.withColumns(
        {
            "area_status": said(*AREA_STATES),
            "qc_status": said("passed_with_legal_source_caveat", "review_required"),
            "qc_reason": said("Polygons agree with the approximate area by regulation within 0.5%; its text and coordinates control.", "Polygons differ from the approximate area by regulation by more than 0.5%; a review of the legal boundary is required."),
        }
    )


def metric_groups(collection: str) -> dict[str, dict]:
    """Metric groups of a collection's matrix by prefix: the roles of typed collections, each within one source; else the collection as a whole."""
    typed = []
    if collection in ("shipping_lanes", "traffic_separation_schemes"):
        typed = [(role, "routing_role", source, family) for role, home, source, _, family in ROUTING_ROLES if home == collection]
    elif collection == "coast_guard_sectors":
        typed = [("uscg_sector", "admin_unit_role", "uscg_app_sectors", "polygon"), ("ccg_administrative_region", "admin_unit_role", "ccg_western_region", "polygon")]
    elif collection == "tribal_first_nations_areas":
        typed = [("bia_land_area_reference", "admin_role", "bia_administrative_lar", "polygon"), ("nrcan_indian_reserve_reference", "admin_role", "nrcan_indian_reserves", "polygon")]
    elif collection == "conservation_designations":
        typed = [(v[0], "classification_role", "eccc_marine_classification", "polygon") for v in CLASSIFICATIONS.values()]
    if not typed:
        return {collection: {"collection": collection}}
    return {f"{collection}__{role}": {"collection": collection, "role": role, "role_field": field, "source_id": source, "family": family} for role, field, source, family in typed}


def group_of(features: DataFrame, collection: str) -> DataFrame:
    """features with `group`, the prefix of their metric group; a role or source outside all groups is an error when rows are read."""
    groups = metric_groups(collection)
    if list(groups) == [collection]:
        return features.withColumn("group", F.lit(collection))
    role = F.col(next(iter(groups.values()))["role_field"])
    found = F.coalesce(*[F.when((role == g["role"]) & (F.col("source_id") == g["source_id"]), F.lit(prefix)) for prefix, g in groups.items()])
    unknown = F.raise_error(F.concat(F.lit(f"{collection}: no metric group for "), F.coalesce(role, F.lit("null")))).cast("string")
    return features.withColumn("group", F.when(found.isNull(), unknown).otherwise(found))
