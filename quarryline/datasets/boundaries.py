"""Statistical boundaries: a catalogue of layers, fetched in chunks of ids as GeoJSON."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quarryline.operators import calendars, quality
from quarryline.operators.generalise import simplify_neighbours
from quarryline.operators.spatial import ring_edges, rings, simplify_rings
from quarryline.sources.files import SERVICE_ROW, latest, listing, payload_rows, read_geojson
from quarryline.sources.literal import literal_table

# Rows per request, by layer where it is not the usual number.
ROWS_PER_REQUEST = 2000
DENSE_LAYERS = {
    "LAD_MAY_2024_UK_BFC": 50,
    "LPA_APR_2023_UK_BFC": 50,
    "WD_MAY_2024_UK_BFC": 200,
    "PCON_JULY_2024_UK_BFC": 50,
}
DISTRICT_PROPERTIES = "LAD24CD string, LAD24NM string"
GENERALISATION = 0.001


@dataclass(frozen=True)
class Layer:
    name: str
    short_name: str
    service: str

    @property
    def key(self) -> str:
        """Folder name of the layer's files."""
        return f"boundaries_{self.name.casefold()}"

    @property
    def rows_per_request(self) -> int:
        return DENSE_LAYERS.get(self.name, ROWS_PER_REQUEST)


# Layer, short name and service name of every published layer.
LAYERS = (
    Layer("CAUTH_MAY_2024_EN_BFC", "CAUTH24", "Combined_Authorities_May_2023_Boundaries_EN_BFC"),
    Layer("CTY_DEC_2023_EN_BFC", "CTY23", "Counties_December_2023_Boundaries_EN_BFC"),
    Layer("CTYUA_DEC_2023_UK_BFC", "CTYUA23", "Counties_and_Unitary_Authorities_December_2023_Boundaries_UK_BFC"),
    Layer("CTRY_DEC_2023_UK_BFC", "CTRY23", "Countries_December_2023_Boundaries_UK_BFC"),
    Layer("CED_MAY_2023_EN_BFC_V2", "CED23", "County_Electoral_Division_May_2023_Boundaries_EN_BFC"),
    Layer("LAD_MAY_2024_UK_BFC", "LAD24", "Local_Authority_Districts_May_2024_Boundaries_UK_BFC"),
    Layer("LPA_APR_2023_UK_BFC", "LPA23", "Local_Planning_Authorities_April_2023_Boundaries_UK_BFC"),
    Layer("PAR_MAY_2023_EW_BFC", "PAR23", "Parishes_May_2023_Boundaries_EW_BFC"),
    Layer(
        "PARNCP_DEC_2023_EW_BFC_V2", "PARNCP23", "Parishes_and_Non_Civil_Parished_Areas_December_2023_Boundaries_EW_BFC",
    ),
    Layer("RGN_DEC_2023_EN_BFC", "RGN23", "Regions_December_2023_Boundaries_EN_BFC"),
    Layer("UTLA_MCTY_DEC_2022_UK_BFC", "UTLA22", "Upper_Tier_Local_Authorities_December_2022_Boundaries_UK_BFC"),
    Layer("WD_MAY_2024_UK_BFC", "WD24", "Wards_May_2024_Boundaries_UK_BFE"),
    Layer("OA_2021_EW_BFC_V8", "OA21", "Output_Areas_2021_EW_BFC_V8"),
    Layer("LSOA_2021_EW_BFC_V10", "LSOA21", "Lower_layer_Super_Output_Areas_December_2021_Boundaries_EW_BFC_V10"),
    Layer("MSOA_2021_EW_BFC_V7", "MSOA21", "Middle_layer_Super_Output_Areas_December_2021_Boundaries_EW_BFC_V7"),
    Layer("TTWA_2011_UK_BFC_V2", "TTWA11", "Travel_to_Work_Areas_Dec_2011_FCB_in_United_Kingdom_2022"),
    Layer(
        "Workplace_Zones_Dec_2011_FCB_in_England_and_Wales", "wz11", "Workplace_Zones_Dec_2011_FCB_in_England_and_Wales_2022",
    ),
    Layer("GLTLA_DEC_2022_EW_BFC", "GLTLA22", "GLTLA_DEC_2022_EW_BFC"),
    Layer(
        "Census_Merged_Wards_Dec_2011_FEB_in_England_and_Wales", "cmwd11", "Census_Merged_Wards_Dec_2011_FEB_in_England_and_Wales_2022",
    ),
    Layer("PCON_JULY_2024_UK_BFC", "PCON24", "Westminster_Parliamentary_Constituencies_July_2024_Boundaries_UK_BFC"),
    Layer(
        "London_Assembly_Constituencies_Dec_2018_FCB_EN", "lac18", "London_Assembly_Constituencies_Dec_2018_FCB_EN_2022",
    ),
    Layer("European_Electoral_Regions_Dec_2018_FCB_UK", "eer18", "European_Electoral_Regions_Dec_2018_FCB_UK_2022"),
    Layer("GEOSTAT_Dec_2011_GEC_in_the_United_Kingdom", "grd_fixid", "GEOSTAT_Dec_2011_GEC_in_the_United_Kingdom_2022"),
    Layer("ITL1_MAY_2021_UK_BFC", "ITL121", "International_Territorial_Level_1_January_2021_UK_BFC_2022"),
    Layer("ITL2_JAN_2021_UK_BFC_V2", "ITL221", "International_Territorial_Level_2_January_2021_UK_BFC_V2_2022"),
    Layer("ITL3_JAN_2021_UK_BFC_V3", "ITL321", "International_Territorial_Level_3_January_2021_UK_BFC_V3_2022"),
    Layer(
        "NUTS_Level_1_January_2018_FCB_in_the_United_Kingdom", "nuts118", "NUTS_Level_1_January_2018_FCB_in_the_United_Kingdom_2022",
    ),
    Layer(
        "NUTS_Level_2_January_2018_FCB_in_the_United_Kingdom", "nuts218", "NUTS_Level_2_January_2018_FCB_in_the_United_Kingdom_2022",
    ),
    Layer(
        "NUTS_Level_3_January_2018_FCB_in_the_United_Kingdom", "nuts318", "NUTS_Level_3_January_2018_FCB_in_the_United_Kingdom_2022",
    ),
    Layer("LAU1_Jan_2018_FCB_in_the_UK", "lau118", "LAU1_Jan_2018_FCB_in_the_UK_2022"),
    Layer("LAU2_Dec_2014_FCB_in_England_and_Wales", "lau214", "LAU2_Dec_2014_FCB_in_England_and_Wales_2022"),
    Layer("CAL_JUL_2023_EN_BFC", "CAL23", "Cancer_Alliances_July_2023_Boundaries_EN_BFC"),
    Layer("CCG_APR_2021_EN_BFC", "CCG21", "Clinical_Commissioning_Groups_April_2021_EN_BFC_2022"),
    Layer("CIS_DEC_2020_UK_BFC", "CIS20", "Covid_Infection_Survey_Dec_2020_UK_BFC"),
    Layer("ICB_APR_2023_EN_BFC", "ICB23", "Integrated_Care_Boards_April_2023_EN_BFC"),
    Layer("SICBL_APR_2023_EN_BFC", "SICBL23", "Sub_Integrated_Care_Board_Locations_April_2023_EN_BFC"),
    Layer("NHSER_JAN_2024_EN_BFC", "NHSER24", "NHS_England_Regions_January_2024_EN_BFC"),
    Layer(
        "NHS_England_Region_Local_Office_April_2018_EN_BFC", "nhsrlo18", "NHS_England_Region_Local_Office_April_2018_EN_BFC_2022",
    ),
    Layer("STP_APR_2021_EN_BFC", "STP21", "Sustainability_and_Transformation_Partnerships_April_2021_EN_BFC_2022"),
    Layer("CSP_DEC_2023_EW_BFC", "CSP23", "Community_Safety_Partnerships_December_2023_Boundaries_EW_BFC"),
    Layer("FRA_DEC_2023_EW_BFC", "FRA23", "Fire_and_Rescue_Authorities_December_2023_EW_BFC"),
    Layer("LEP_DEC_2022_EN_BFC_V2", "LEP22", "LEP_DEC_2022_EN_BFC_V2"),
    Layer("LSIP_AUG_2023_EN_BFC", "LSIP23", "Local_Skills_Improvement_Plan_Areas_August_2023_Boundaries_EN_BFC"),
    Layer("NPARK_DEC_2022_GB_BFC_V2", "NPARK22", "National_Parks_December_2022_Boundaries_GB_BFC"),
    Layer("PFA_DEC_2023_EW_BFC", "PFA23", "Police_Force_Areas_December_2023_EW_BFC"),
    Layer("REGD_DEC_2021_EW_BFC_v2", "REGD21", "Registration_Districts_December_2021_Boundaries_EW_BFC_v2"),
)
CATALOGUE = {layer.name: layer for layer in LAYERS}


def catalogue(spark: SparkSession) -> DataFrame:
    rows = [(x.name, x.short_name, x.service, x.key, x.rows_per_request) for x in CATALOGUE.values()]
    return literal_table(
        spark, rows, "layer string, short_name string, service string, key string, rows_per_request int"
    )


def chunk_manifest(counts: DataFrame, layer: Layer, root: str, id_field: str = "OBJECTID") -> DataFrame:
    """Chunks of a layer from its declared row ``count``: id range, address, file name."""
    spread = calendars.chunks(counts, F.col("count"), layer.rows_per_request)
    where = F.format_string(f"1%%3D1+AND+{id_field}+BETWEEN+%d+AND+%d", "id_start", "id_end")
    base = f"{root}/{layer.service}/FeatureServer/0/query?outFields=*&where="
    return spread.withColumns(
        {
            "url": F.concat(F.lit(base), where, F.lit("&f=geojson")),
            "file_name": F.concat(F.lit(f"{layer.key}."), F.col("label"), F.lit(".geojson")),
        }
    )


def chunk_gaps(manifest: DataFrame, features: DataFrame, layer: Layer, id_column: str) -> DataFrame:
    """Chunks whose landed ids do not fill their declared range."""
    return quality.chunk_gaps(manifest, features, id_column, layer.rows_per_request)


def services(payloads: DataFrame, body: str) -> DataFrame:
    """``name, type, url`` of the services a server lists."""
    return payload_rows(payloads, body, "services", SERVICE_ROW)


def read_layer(spark: SparkSession, folder: str, layer: Layer, properties: str) -> DataFrame:
    """All chunk files of a layer as one table."""
    return read_geojson(spark, f"{folder}/{layer.key}.*.geojson", properties)


def read_latest(spark: SparkSession, folder: str, properties: str = DISTRICT_PROPERTIES) -> DataFrame:
    """The newest boundary file of a folder."""
    newest = latest(listing(spark, folder, "*.geojson")).first()
    if newest is None or newest.path is None:
        raise FileNotFoundError(f"no boundary file in {folder}")
    return read_geojson(spark, newest.path, properties)


def generalised_rings(features: DataFrame, code: str, tolerance: float = GENERALISATION) -> DataFrame:
    return simplify_rings(rings(features, [code]), tolerance)


def generalised_neighbours(features: DataFrame, code: str, tolerance: float = GENERALISATION) -> DataFrame:
    """Like ``generalised_rings``, but borders stay common and do not cross."""
    return simplify_neighbours(rings(features, [code]), [code, "part", "ring"], tolerance)


def edges(features: DataFrame, code: str) -> DataFrame:
    return ring_edges(rings(features, [code]), [code])


def with_counts(features: DataFrame, counts: DataFrame, code: str, count_code: str) -> DataFrame:
    """Every boundary with the counts of its code where there are any."""
    return features.join(counts, features[code] == counts[count_code], "left")


def selected(features: DataFrame, code: str, value: str | Column) -> DataFrame:
    return features.filter(F.col(code) == value)
