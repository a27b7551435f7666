"""Road collisions, casualties and vehicles: all-text files plus a code-book."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quarryline.functions.nulls import sentinels_to_null
from quarryline.functions.text import concat_all, header_names
from quarryline.operators import aggregates, joins, spatial
from quarryline.operators.codebook import CodeBook, read_codebook
from quarryline.operators.loader import clean_table
from quarryline.sinks import landing
from quarryline.sources.literal import literal_table
from quarryline.sources.text import header_of, read_csv


# Declared columns and kinds.  ``accident_reference`` is text and
# ``vehicle_reference`` an integer in every table, so the tables join.
SCHEMAS = {
    "vehicle": {
        "accident_index": "string",
        "accident_year": "int",
        "accident_reference": "string",
        "vehicle_reference": "int",
        "vehicle_type": "coded",
        "towing_and_articulation": "coded",
        "vehicle_manoeuvre": "coded",
        "vehicle_direction_from": "coded",
        "vehicle_direction_to": "coded",
        "vehicle_location_restricted_lane": "coded",
        "junction_location": "coded",
        "skidding_and_overturning": "coded",
        "hit_object_in_carriageway": "coded",
        "vehicle_leaving_carriageway": "coded",
        "hit_object_off_carriageway": "coded",
        "first_point_of_impact": "coded",
        "vehicle_left_hand_drive": "coded",
        "journey_purpose_of_driver": "coded",
        "sex_of_driver": "coded",
        "age_of_driver": "int",
        "age_band_of_driver": "coded",
        "engine_capacity_cc": "int",
        "propulsion_code": "coded",
        "age_of_vehicle": "int",
        "generic_make_model": "string",
        "driver_imd_decile": "int",
        "driver_home_area_type": "coded",
        "lsoa_of_driver": "string",
        "escooter_flag": "boolean",
        "dir_from_e": "string",
        "dir_from_n": "string",
        "dir_to_e": "string",
        "dir_to_n": "string",
        "driver_distance_banding": "coded",
    },
    "collision": {
        "accident_index": "string",
        "accident_year": "int",
        "accident_reference": "string",
        "location_easting_osgr": "int",
        "location_northing_osgr": "int",
        "longitude": "float",
        "latitude": "float",
        "police_force": "coded",
        "accident_severity": "coded",
        "number_of_vehicles": "int",
        "number_of_casualties": "int",
        "date": "date",
        "day_of_week": "coded",
        "time": "time",
        "local_authority_district": "coded",
        "local_authority_ons_district": "string",
        "local_authority_highway": "string",
        "first_road_class": "coded",
        "first_road_number": "int",
        "road_type": "coded",
        "speed_limit": "int",
        "junction_detail": "coded",
        "junction_control": "coded",
        "second_road_class": "coded",
        "second_road_number": "int",
        "pedestrian_crossing_human_control": "coded",
        "pedestrian_crossing_physical_facilities": "coded",
        "light_conditions": "coded",
        "weather_conditions": "coded",
        "road_surface_conditions": "coded",
        "special_conditions_at_site": "coded",
        "carriageway_hazards": "coded",
        "urban_or_rural_area": "coded",
        "did_police_officer_attend_scene_of_accident": "coded",
        "trunk_road_flag": "coded",
        "lsoa_of_accident_location": "string",
        "enhanced_severity_collision": "coded",
    },
    "casualty": {
        "accident_index": "string",
        "accident_year": "int",
        "accident_reference": "string",
        "vehicle_reference": "int",
        "casualty_reference": "int",
        "casualty_class": "coded",
        "sex_of_casualty": "coded",
        "age_of_casualty": "int",
        "age_band_of_casualty": "coded",
        "casualty_severity": "coded",
        "pedestrian_location": "coded",
        "pedestrian_movement": "coded",
        "car_passenger": "coded",
        "bus_or_coach_passenger": "coded",
        "pedestrian_road_maintenance_worker": "coded",
        "casualty_type": "coded",
        "casualty_home_area_type": "coded",
        "casualty_imd_decile": "coded",
        "lsoa_of_casualty": "string",
        "enhanced_casualty_severity": "coded",
        "casualty_distance_banding": "coded",
    },
}
FORMATS = {"vehicle": {}, "collision": {"date": "%d/%m/%Y", "time": "%H:%M"}, "casualty": {}}
# The only numeric columns in which -1 means missing.
MINUS_ONE_IS_MISSING = {
    "vehicle": ("age_of_driver",),
    "collision": ("first_road_number", "second_road_number"),
    "casualty": (),
}
SERVER = "https://data.dft.gov.uk/road-accidents-safety-data"
TABLES = tuple(SCHEMAS)


def manifest(spark: SparkSession, server: str = SERVER) -> DataFrame:
    name = "dft-road-casualty-statistics-{}-1979-latest-published-year.csv"
    rows = [(t, f"{server}/{name.format(t)}", f"{t}-1979-latest-published-year.csv") for t in TABLES]
    return literal_table(spark, rows, "table string, url string, file_name string")


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """One headered file as text, columns as its header names them."""
    return read_csv(spark, path, header_of(spark, path))


def load_codebook(book: DataFrame, table: str) -> CodeBook:
    """The code-book of one table without its missing-value codes; of a repeated
    code the row last by ``_row`` wins if the book has that column."""
    order = F.col("_row") if "_row" in book.columns else None
    return CodeBook(read_codebook(book, order).filter(F.col("table") == table), drop_missing_code=True)


def severity() -> Column:
    """``Serious - <detail>`` where a detail is known, else the plain severity."""
    plain, detail = F.col("accident_severity"), F.col("enhanced_severity_collision")
    return F.when((plain == "Serious") & detail.isNotNull(), concat_all(" - ", plain, detail)).otherwise(plain)


def clean(raw: DataFrame, table: str, codebook: CodeBook) -> DataFrame:
    """Typed and coded rows; columns outside the declaration stay text."""
    present = {c: k for c, k in SCHEMAS[table].items() if c in raw.columns}
    operations = {c: sentinels_to_null(F.col(c), [-1]) for c in MINUS_ONE_IS_MISSING[table] if c in present}
    if table == "collision":
        operations["severity"] = severity()
    return clean_table(raw, present, formats=FORMATS[table], codebook=codebook, column_operations=operations)


def derive(spark: SparkSession, raw_paths: dict[str, str], book: DataFrame, root: str) -> None:
    """Clean and write every table that has a raw file."""
    for table, path in raw_paths.items():
        cleaned = clean(read_raw(spark, path), table, load_codebook(book, table))
        landing.write_table(cleaned, f"{root}/{table}.parquet", "overwrite")


def read(
    spark: SparkSession, root: str, tables: Iterable[str] = TABLES, header_style: str = "snake"
) -> dict[str, DataFrame]:
    frames = {t: landing.read_complete(spark, f"{root}/{t}.parquet") for t in tables}
    if header_style == "snake":
        return frames
    return {t: df.withColumnsRenamed(header_names(df.columns, header_style)) for t, df in frames.items()}


# ---- analyses --------------------------------------------------------------

NO_COORDINATES = ("latitude", "longitude", "local_authority_ons_district")
NO_LOCATION = (*NO_COORDINATES, "local_authority_district")


def lacking(columns: Sequence[str]) -> Column:
    condition = F.col(columns[0]).isNull()
    for c in columns[1:]:
        condition = condition & F.col(c).isNull()
    return condition


def location_shares(collisions: DataFrame) -> DataFrame:
    """Rows and share without coordinates, and without any location, in one scan."""
    return aggregates.share(
        collisions, {"no_coordinates": lacking(NO_COORDINATES), "no_location": lacking(NO_LOCATION)}
    )


def unlocated_by_year(collisions: DataFrame) -> DataFrame:
    return (
        collisions.filter(lacking(NO_COORDINATES))
        .groupBy(
            F.col("accident_year").alias("accident_year_int"),
            F.col("accident_year").cast("string").alias("accident_year"),
            F.col("accident_severity"),
        )
        .agg(F.count("accident_index").alias("count"))
        .orderBy("accident_year_int")
    )


def district_counts(collisions: DataFrame) -> DataFrame:
    """Accidents, casualties and vehicles per district."""
    district = "local_authority_ons_district"
    return (
        collisions.filter(F.col(district).isNotNull())
        .groupBy(district)
        .agg(
            F.count("accident_index").alias("accidents"),
            aggregates.sum_or_zero(F.col("number_of_casualties")).alias("casualties"),
            aggregates.sum_or_zero(F.col("number_of_vehicles")).alias("vehicles"),
        )
    )


MEASURES = ("accidents", "casualties", "vehicles")


def district_classes(features: DataFrame, counts: DataFrame, code: str, bins: int = 6) -> DataFrame:
    """Every boundary with its counts and their equal-width class per measure; a
    boundary without collisions has null counts and classes."""
    joined = joins.left_two_keys(features, counts, code, "local_authority_ons_district")
    return aggregates.equal_width_bins(joined, {m: f"{m}_class" for m in MEASURES}, bins)


def heat_surfaces(
    collisions: DataFrame, edges: DataFrame, code: str, n: int = 200, cell: float = 0.05
) -> DataFrame:
    """Kernel density of every district's collisions on its own n-by-n grid, kept where
    the grid point lies inside the district's boundary."""
    located = collisions.filter(
        F.col("local_authority_ons_district").isNotNull() & F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    ).withColumnRenamed("local_authority_ons_district", "_district")
    surface = spatial.kernel_density(located, ["_district"], "longitude", "latitude", n)
    inside = spatial.points_in_boundaries(surface, "x", "y", edges, code, cell).filter(F.col(code) == F.col("_district"))
    return inside.select(
        code, "i", "j", F.col("y").alias("latitude"), F.col("x").alias("longitude"), F.col("density").alias("intensity")
    )
