"""Postcode directory (coded against some forty lookup files) and Code-Point."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quarryline.functions import casts, dates
from quarryline.functions.codes import recode_strict
from quarryline.functions.geodesy import with_lonlat
from quarryline.functions.nulls import empty_flag, sentinels_to_null
from quarryline.operators.codebook import (
    DomainWatch,
    Recode,
    lookup_entry,
    resolve_lookups,
    watched_labels,
    with_labels,
)
from quarryline.sinks import landing
from quarryline.sinks.paths import remove_folder
from quarryline.sources.files import contains_member, listing
from quarryline.sources.literal import literal_table
from quarryline.sources.text import file_order, header_of, read_csv, read_csv_sidecar

UNKNOWN = "Unknown"
# Labels of pseudo codes, by place.
PSEUDO = {
    "england": {"E99999999": "(pseudo) England (UA/MD/LB)"},
    "channel_islands": {"L99999999": "(pseudo) Channel Islands", "M99999999": "(pseudo) Isle of Man"},
    "northern_ireland": {"N99999999": "(pseudo) Northern Ireland"},
    "scotland": {"S99999999": "(pseudo) Scotland"},
    "wales": {"W99999999": "(pseudo) Wales"},
}
# Codes labelled directly.
GRID_REFERENCE_INDICATOR = {
    "1": "within the building of the matched address closest to the postcode mean",
    "2": "within the building of the matched address closest to the postcode mean, except by visual inspection of Landline maps (Scotland only)",
    "3": "approximate to within 50 metres",
    "4": "postcode unit mean (mean of matched addresses with the same postcode, but not snapped to a building)",
    "5": "imputed by ONS, by reference to surrounding postcode grid references",
    "6": "postcode sector mean, (mainly PO Boxes)",
    "8": "postcode terminated prior to Gridlink initiative, last known ONS postcode grid reference",
    "9": "no grid reference available",
}
USER_TYPE = {"0": "small_user", "1": "large_user"}
COUNTRY = {
    "E92000001": "England",
    "W92000004": "Wales",
    "S92000003": "Scotland",
    "N92000002": "Northern Ireland",
    "L93000001": "Channel Islands",
    "M83000003": "Isle of Man",
}
# Code of a cancer alliance absent from its lookup file.
EXTRA_CODES = {"calncv": {"E56000035": UNKNOWN}}

# Code columns kept beside the labels, source and output name.
CODE_COLUMNS = {
    "oscty": "county_code",
    "ced": "county_electoral_division_code",
    "oslaua": "local_authority_code",
    "osward": "ward_code",
    "parish": "parish_code",
    "oshlthau": "former_health_authority_code",
    "nhser": "national_health_service_england_region_code",
    "ctry": "country_code",
    "rgn": "region_code",
    "streg": "standard_statistical_region_code",
    "pcon": "westminster_parliamentary_constituency_code",
    "eer": "european_electoral_region_code",
    "teclec": "learning_skills_council_code",
    "ttwa": "travel_to_work_area_code",
    "pct": "primary_care_trust_code",
    "itl": "international_territorial_level_code",
    "statsward": "statistical_ward_2005_code",
    "oa01": "output_area_census_2001_code",
    "casward": "census_area_statitics_ward_code",
    "npark": "national_park_code",
    "lsoa01": "lower_layer_super_output_area_census_2001_code",
    "msoa01": "middle_layer_super_output_area_census_2001_code",
    "ur01ind": "urban_rural_indicator_census_2001_code",
    "oac01": "output_area_classification_census_2001_code",
    "oa11": "output_area_census_2011_code",
    "lsoa11": "lower_layer_super_output_area_census_2011_code",
    "msoa11": "middle_layer_super_output_area_census_2011_code",
    "wz11": "workplace_zone_census_11",
    "sicbl": "sub_integrated_health_board_location_code",
    "bua24": "built_up_area_code",
    "ru11ind": "rural_urban_indicator_census_2011_code",
    "oac11": "output_area_classification_census_2011_code",
    "lep1": "local_enterprise_partnership_code",
    "lep2": "local_enterprise_partnership_overlap_code",
    "pfa": "police_force_area_code",
    "calncv": "cancer_alliance_code",
    "icb": "integrated_care_board_code",
    "oa21": "output_area_census_2021_code",
    "lsoa21": "lower_layer_super_output_area_census_2021_code",
    "msoa21": "middle_layer_super_output_area_census_2021_code",
}


@dataclass(frozen=True)
class Coded:
    """A recoded column: its source, output, the label's position in the lookup file,
    a part of that file's name, and which codes are ``Unknown`` or pseudo codes."""

    source: str
    output: str
    position: int
    file_part: str
    blank_is_unknown: bool = False
    space_is_unknown: bool = False
    null_is_unknown: bool = False
    absent_is_unknown: bool = False
    pseudo: tuple[str, ...] = ()

    @property
    def extra_codes(self) -> dict[str, str]:
        """Codes the lookup file lacks."""
        extra = dict(EXTRA_CODES.get(self.source, {}))
        for place in self.pseudo:
            extra.update(PSEUDO[place])
        if self.blank_is_unknown:
            extra[""] = UNKNOWN
        if self.space_is_unknown:
            extra[" "] = UNKNOWN
        return extra

    @property
    def lookup_name(self) -> str:
        """Columns with the same lookup share it."""
        return "|".join([self.file_part, str(self.position), *self.extra_codes])

    def rule(self) -> Recode:
        return Recode(
            self.source,
            self.output,
            strict=True,
            fallback=UNKNOWN if self.absent_is_unknown else None,
            null_label=UNKNOWN if self.null_is_unknown else None,
        )


# Recoded columns.
RECODED = (
    Coded("oscty", "county", 1, "County names and codes UK as at", blank_is_unknown=True),
    Coded(
        "ced", "county_electoral_division", 1, "County Electoral Division names and codes EN as at",
        blank_is_unknown=True, absent_is_unknown=True, pseudo=("channel_islands", "northern_ireland", "scotland", "wales"),
    ),
    Coded("oslaua", "local_authority", 1, "LA_UA names and codes UK as at", blank_is_unknown=True),
    Coded("osward", "ward", 1, "Ward names and codes UK as at", blank_is_unknown=True, pseudo=("channel_islands",)),
    Coded(
        "parish", "parish", 1, "Parish_NCP names and codes EW as at",
        blank_is_unknown=True, absent_is_unknown=True, pseudo=("channel_islands", "northern_ireland", "scotland"),
    ),
    Coded("oshlthau", "former_health_authority", 2, "HLTHAU names and codes UK as at", blank_is_unknown=True),
    Coded(
        "nhser", "national_health_service_england_region", 2, "NHSER names and codes EN as at",
        blank_is_unknown=True, absent_is_unknown=True, pseudo=("channel_islands", "northern_ireland", "scotland", "wales"),
    ),
    Coded("rgn", "region", 2, "Region names and codes EN as at", blank_is_unknown=True),
    Coded("streg", "standard_statistical_region", 1, "SSR names and codes UK as at", null_is_unknown=True),
    Coded(
        "pcon", "westminster_parliamentary_constituency", 1, "Westminster Parliamentary Constituency names and codes UK as at",
        blank_is_unknown=True, pseudo=("channel_islands",),
    ),
    Coded("eer", "european_electoral_region", 2, "EER names and codes UK as at", blank_is_unknown=True),
    Coded("teclec", "learning_skills_council", 2, "TECLEC names and codes UK as at", blank_is_unknown=True),
    Coded("ttwa", "travel_to_work_area", 1, "TTWA names and codes UK as at", blank_is_unknown=True),
    Coded("pct", "primary_care_trust", 2, "PCT names and codes UK as at", blank_is_unknown=True),
    Coded(
        "itl", "international_territorial_level", 1, "LAD23_LAU121_ITL321_ITL221_ITL121_UK_LU",
        blank_is_unknown=True, pseudo=("channel_islands",),
    ),
    Coded(
        "statsward", "statistical_ward_2005", 1, "Statistical ward names and codes UK as at 2005",
        blank_is_unknown=True,
    ),
    Coded("casward", "census_area_statitics_ward", 1, "CAS ward names and codes UK as at", blank_is_unknown=True),
    Coded("npark", "national_park", 1, "National Park names and codes GB as at", blank_is_unknown=True),
    Coded(
        "lsoa01", "lower_layer_super_output_area_census_2001", 1, "LSOA (2001) names and codes EW & NI as at",
        blank_is_unknown=True, absent_is_unknown=True,
    ),
    Coded(
        "msoa01", "middle_layer_super_output_area_census_2001", 1, "MSOA (2001) names and codes GB as at",
        blank_is_unknown=True, pseudo=("channel_islands", "northern_ireland"),
    ),
    Coded(
        "ur01ind", "urban_rural_indicator_census_2001", 1, "Urban Rural (2001) Indicator names and codes UK",
        space_is_unknown=True,
    ),
    Coded(
        "oac01", "output_area_classification_supergroup_census_2001", 1, "2001 Census Output Area Classification Names and Codes UK",
        blank_is_unknown=True,
    ),
    Coded(
        "oac01", "output_area_classification_group_census_2001", 2, "2001 Census Output Area Classification Names and Codes UK",
        blank_is_unknown=True,
    ),
    Coded(
        "lsoa11", "lower_layer_super_output_area_census_2011", 1, "LSOA (2011) names and codes UK as at",
        blank_is_unknown=True,
    ),
    Coded(
        "msoa11", "middle_layer_super_output_area_census_2011", 1, "MSOA (2011) names and codes UK as at",
        blank_is_unknown=True,
    ),
    Coded(
        "sicbl", "sub_integrated_health_board_location", 2, "Sub_ICB Location and Local Health Board names and codes UK as at",
        blank_is_unknown=True,
    ),
    Coded(
        "bua24", "built_up_area", 1, "BUA24 names and codes EW as at",
        blank_is_unknown=True, pseudo=("channel_islands", "northern_ireland", "scotland"),
    ),
    Coded(
        "ru11ind", "rural_urban_indicator_census_2011", 1, "Rural Urban (2011) Indicator names and codes GB as at",
        blank_is_unknown=True,
    ),
    Coded(
        "oac11", "output_area_classification_supergroup_census_2011", 1, "2011 Census Output Area Classification Names and Codes UK",
        blank_is_unknown=True,
    ),
    Coded(
        "oac11", "output_area_classification_group_census_2011", 2, "2011 Census Output Area Classification Names and Codes UK",
        blank_is_unknown=True,
    ),
    Coded(
        "oac11", "output_area_classification_subgroup_census_2011", 3, "2011 Census Output Area Classification Names and Codes UK",
        blank_is_unknown=True,
    ),
    Coded(
        "lep1", "local_enterprise_partnership", 1, "LEP names and codes EN as at",
        blank_is_unknown=True, pseudo=("england", "channel_islands", "northern_ireland", "scotland", "wales"),
    ),
    Coded(
        "lep2", "local_enterprise_partnership_overlap", 1, "LEP names and codes EN as at",
        blank_is_unknown=True, pseudo=("england", "channel_islands", "northern_ireland", "scotland", "wales"),
    ),
    Coded("pfa", "police_force_area", 1, "PFA names and codes GB as at", blank_is_unknown=True),
    Coded(
        "calncv", "cancer_alliance", 1, "CALNCV names and codes EN as at",
        blank_is_unknown=True, pseudo=("channel_islands", "northern_ireland", "scotland", "wales"),
    ),
    Coded(
        "icb", "integrated_care_board", 2, "ICB names and codes UK as at",
        blank_is_unknown=True, pseudo=("channel_islands", "northern_ireland", "scotland", "wales"),
    ),
    Coded(
        "lsoa21", "lower_layer_super_output_area_census_2021", 1, "LSOA (2021) names and codes EW as at",
        blank_is_unknown=True, absent_is_unknown=True, pseudo=("channel_islands",),
    ),
    Coded(
        "msoa21", "middle_layer_super_output_area_census_2021", 1, "MSOA (2021) names and codes EW as at",
        blank_is_unknown=True, absent_is_unknown=True, pseudo=("channel_islands",),
    ),
)


def lookup_files(spark: SparkSession, folder: str) -> dict[str, str]:
    """File name part -> the one lookup file holding it; none or several is an error."""
    parts = list(dict.fromkeys(r.file_part for r in RECODED))
    files = listing(spark, folder, "*.csv")
    held = F.filter(
        F.array(*[F.when(contains_member(F.col("name"), part + _space(part)), F.lit(part)) for part in parts]),
        lambda part: part.isNotNull(),
    )
    matches: dict[str, list[str]] = {part: [] for part in parts}
    for row in files.select("path", F.explode(held).alias("part")).collect():  # as many as lookup files
        matches[row.part].append(row.path)
    for part, paths in matches.items():
        if len(paths) != 1:
            raise ValueError(f"expected exactly one lookup file for {part!r}, found {sorted(paths)}")
    return {part: paths[0] for part, paths in matches.items()}


def _space(part: str) -> str:
    # "... as at" is followed by a date: the blank keeps it from matching less.
    return " " if part.endswith("as at") else ""


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """A lookup file as text, with its row order so that a repeated code's last row wins."""
    frame = read_csv(spark, path, header_of(spark, path))
    return frame.withColumn("_row", file_order())


def lookup_rows(spark: SparkSession, files: Mapping[str, DataFrame]) -> DataFrame:
    """The rows of every lookup in one table: each file is read once for all the
    lookups it serves, and the extra codes come last."""
    names = {r.lookup_name: r for r in RECODED}
    parts = []
    for part, file in files.items():
        columns = file.columns
        order = "_row" if "_row" in columns else None
        entries = []
        for name, r in names.items():
            if r.file_part == part:
                entries.append(lookup_entry(name, columns[0], columns[r.position], 0, order))
                if r.source == "itl":  # a second level sits in the next two columns
                    entries.append(lookup_entry(name, columns[2], columns[3], 1, order))
        if entries:
            parts.append(file.selectExpr(f"inline(array({', '.join(entries)}))"))
    extras = [(name, code, label) for name, r in names.items() for code, label in r.extra_codes.items()]
    added = literal_table(spark, extras, "map string, code string, label string")
    last = "named_struct('priority', 2, 'block', CAST(0 AS BIGINT), 'row', CAST(0 AS BIGINT)) AS at"
    return reduce(DataFrame.union, [*parts, added.selectExpr("map", "code", "label", last)])


def direct_columns(downloaded: datetime | Column) -> dict[str, Column]:
    """Output columns that need no lookup."""
    blank_to_null = {c: sentinels_to_null(F.col(c), [""]) for c in ("oseast1m", "osnrth1m")}
    return {
        "postcode": F.col("pcds"),
        "postcode_7_character": F.col("pcd"),
        "postcode_8_character": F.col("pcd2"),
        "date_start": casts.strict_date(F.col("dointr"), "%Y%m"),
        "date_end": casts.clean_date(F.col("doterm"), "%Y%m"),
        "is_live": empty_flag(F.col("doterm")),
        "latitude": casts.strict(F.col("lat"), "float"),
        "longitude": casts.strict(F.col("long"), "float"),
        "easting": casts.strict(blank_to_null["oseast1m"], "int"),
        "northing": casts.strict(blank_to_null["osnrth1m"], "int"),
        "grid_reference_indicator": recode_strict(F.col("osgrdind"), GRID_REFERENCE_INDICATOR, "osgrdind"),
        "postcode_user_type": recode_strict(F.col("usertype"), USER_TYPE, "usertype"),
        "country": recode_strict(F.col("ctry"), COUNTRY, "ctry"),
        "index_of_multiple_deprivation": sentinels_to_null(casts.strict(F.col("imd"), "int"), [0]),
        "datetime_download": dates.stamp(downloaded),
    }


def clean_directory(
    raw: DataFrame,
    files: Mapping[str, DataFrame],
    downloaded: datetime | Column,
    *,
    null_island: bool = False,
    watch: DomainWatch | None = None,
) -> DataFrame:
    """The 93-column directory; ``files`` maps a lookup file part to its table.

    A strict recode proves that a code is in its lookup while its label is selected.
    With ``watch`` the codes are counted in the same pass whatever is selected, and
    ``land_directory`` refuses the result.  With ``null_island`` the placeholder
    coordinates of postcodes without a grid reference become null.
    """
    resolved = resolve_lookups(lookup_rows(raw.sparkSession, files))
    recodes = [(r.rule(), resolved.get(r.lookup_name, {})) for r in RECODED]
    joined, labels = with_labels(raw, recodes) if watch is None else watched_labels(raw, recodes, watch, {"ctry": ~F.col("ctry").isin(*COUNTRY)})
    outputs = direct_columns(downloaded)
    if null_island:
        placed = F.col("osgrdind") != "9"
        for c in ("latitude", "longitude"):
            outputs[c] = F.when(placed, outputs[c])
    outputs |= labels
    outputs |= {name: F.col(source) for source, name in CODE_COLUMNS.items()}
    return joined.select(*[c.alias(name) for name, c in outputs.items()])


def directory_columns(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, header_of(spark, path))


def land_directory(directory: DataFrame, root: str, release: str, watch: DomainWatch | None = None) -> bool:
    """Write the directory of one source release unless that release is there;
    keyed by the release alone, so a later day does not write it again.  A watched
    directory with a code outside its domain is removed again and is an error."""
    path = f"{root}/release={release}"
    if landing.is_complete(directory.sparkSession, path):
        return False
    landing.write_table(directory, path, "overwrite")
    if watch is not None:
        try:
            watch.require_none()
        except ValueError:
            remove_folder(directory.sparkSession, path)
            raise
    return True


# ---- Code-Point ------------------------------------------------------------


def read_code_point(spark: SparkSession, paths: str | Sequence[str], header_path: str) -> DataFrame:
    return read_csv_sidecar(spark, paths, header_path)


def clean_code_point(raw: DataFrame) -> DataFrame:
    """Integer grid coordinates, with longitude and latitude appended."""
    typed = raw.withColumns({c: casts.strict(F.col(c), "bigint") for c in ("Eastings", "Northings")})
    return with_lonlat(typed, "Eastings", "Northings")
