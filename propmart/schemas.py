"""Schema registry (S8) and the fixed names the outputs must keep.

The listing, rent, income and lookup layouts, the rent measure label, the
price sentinels and the output column names below are fixed values: they
must equal the source data and the published KPI files for the results to
line up, so they are written out as-is, in the order of the source files.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must match the source data and published outputs)
# ---------------------------------------------------------------------------

# Listing snapshot records (JSON), persistent-zone types.
LISTING_FIELDS = [
    ("propertyCode", T.IntegerType()),
    ("thumbnail", T.StringType()),
    ("externalReference", T.StringType()),
    ("numPhotos", T.ShortType()),
    ("floor", T.StringType()),
    ("price", T.IntegerType()),
    ("propertyType", T.StringType()),
    ("operation", T.StringType()),
    ("size", T.FloatType()),
    ("exterior", T.BooleanType()),
    ("rooms", T.ByteType()),
    ("bathrooms", T.ByteType()),
    ("address", T.StringType()),
    ("province", T.StringType()),
    ("municipality", T.StringType()),
    ("district", T.StringType()),
    ("country", T.StringType()),
    ("latitude", T.FloatType()),
    ("longitude", T.FloatType()),
    ("showAddress", T.BooleanType()),
    ("url", T.StringType()),
    ("distance", T.ShortType()),
    ("hasVideo", T.BooleanType()),
    ("status", T.StringType()),
    ("newDevelopment", T.BooleanType()),
    ("hasLift", T.BooleanType()),
    ("priceByArea", T.FloatType()),
    (
        "detailedType",
        T.StructType(
            [T.StructField("typology", T.StringType()), T.StructField("subTypology", T.StringType())]
        ),
    ),
    (
        "suggestedTexts",
        T.StructType(
            [T.StructField("subtitle", T.StringType()), T.StructField("title", T.StringType())]
        ),
    ),
    ("hasPlan", T.BooleanType()),
    ("has3DTour", T.BooleanType()),
    ("has360", T.BooleanType()),
    ("hasStaging", T.BooleanType()),
    ("topNewDevelopment", T.BooleanType()),
    (
        "parkingSpace",
        T.StructType(
            [
                T.StructField("hasParkingSpace", T.BooleanType()),
                T.StructField("isParkingSpaceIncludedInPrice", T.BooleanType()),
                T.StructField("parkingSpacePrice", T.FloatType()),
            ]
        ),
    ),
    ("neighborhood", T.StringType()),
]
# Present in some snapshot files only.
LISTING_OPTIONAL = ("parkingSpace", "neighborhood")

# Open-data rent table (CSV). Price stays text.
RENT_FIELDS = [
    ("Any", T.IntegerType()),
    ("Trimestre", T.ShortType()),
    ("Codi_Districte", T.ShortType()),
    ("Nom_Districte", T.StringType()),
    ("Codi_Barri", T.ShortType()),
    ("Nom_Barri", T.StringType()),
    ("Lloguer_mitja", T.StringType()),
    ("Preu", T.StringType()),
]

# Open-data income table (CSV). The index column arrives under its raw header.
INCOME_FIELDS = [
    ("Any", T.IntegerType()),
    ("Codi_Districte", T.ShortType()),
    ("Nom_Districte", T.StringType()),
    ("Codi_Barri", T.ShortType()),
    ("Nom_Barri", T.StringType()),
    ("Població", T.LongType()),
    ("Index_RFD_Barcelona_100", T.StringType()),
]
INCOME_RAW_INDEX_HEADER = "Índex RFD Barcelona = 100"

# The source types are unsigned: 8 bits for district, neighborhood and quarter
# codes, 16 for the year, 32 for the population.
RENT_RANGES = {"Any": (0, 65535), "Trimestre": (0, 255), "Codi_Districte": (0, 255), "Codi_Barri": (0, 255)}
INCOME_RANGES = {"Any": (0, 65535), "Codi_Districte": (0, 255), "Codi_Barri": (0, 255), "Població": (0, 4294967295)}

# Name-reconciliation lookup (CSV), all text.
LOOKUP_COLUMNS = [
    "district",
    "neighborhood",
    "district_n_reconciled",
    "district_n",
    "district_id",
    "neighborhood_n_reconciled",
    "neighborhood_n",
    "neighborhood_id",
]

# Rent measure kept for the payback KPI, and price texts that mean "no value".
RENT_MONTHLY_LABEL = "Lloguer mitjà mensual (Euros/mes)"
PRICE_SENTINELS = ("NA", "N/A", "--")

# Snapshot date = first 10 characters of the file name, year_month_day.
SNAPSHOT_NAME_CHARS = 10
SNAPSHOT_DATE_FORMAT = "yyyy_MM_dd"

# Link suffix of the rent files on the open-data portal.
RENT_LINK_SUFFIX = "lloguer_preu_trim.csv"

# Output column names of the published KPI files (spelling kept).
AVG_PRICE_COLUMNS = ("Neighborhood", "Average_Price")
ROI_COLUMNS = ("year", "neighborhood", "propertyCode", "ROI/Year")
INCOME_POPULATION_OUT = "populatonBCN"

# Price model: categorical and numeric inputs, label, split and window keys.
ML_CATEGORICAL = ("neighborhood", "propertyType", "floor", "status")
ML_NUMERIC = ("size", "rooms", "bathrooms")
ML_LABEL = "price"
ML_TRAIN_FRACTION = 0.8
ML_SEED = 1310
# Columns shown next to each prediction.
PREDICTION_COLUMNS = (
    "neighborhood", "district", "date", "size", "rooms", "bathrooms",
    "propertyType", "floor", "status", "hasLift", "price", "prediction",
)
SEGMENT_COLUMNS = ("neighborhood", "propertyType", "floor", "status", "size", "rooms", "bathrooms")

# ---------------------------------------------------------------------------
# Derived schemas
# ---------------------------------------------------------------------------


def struct_of(fields) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


LISTING_SCHEMA = struct_of(LISTING_FIELDS)
RENT_SCHEMA = struct_of(RENT_FIELDS)
INCOME_SCHEMA = struct_of(INCOME_FIELDS)
LOOKUP_SCHEMA = struct_of([(c, T.StringType()) for c in LOOKUP_COLUMNS])


# Formatted zone (types widened to bigint/double as the zone stores them).
FORMATTED_LISTING_SCHEMA = struct_of(
    [
        ("neighborhood", T.StringType()),
        ("district", T.StringType()),
        ("propertyCode", T.LongType()),
        ("date", T.DateType()),
        ("price", T.LongType()),
        ("size", T.DoubleType()),
        ("rooms", T.LongType()),
        ("bathrooms", T.LongType()),
        ("latitude", T.DoubleType()),
        ("longitude", T.DoubleType()),
        ("operation", T.StringType()),
        ("propertyType", T.StringType()),
        ("floor", T.StringType()),
        ("status", T.StringType()),
        ("hasLift", T.BooleanType()),
    ]
)
FORMATTED_INCOME_SCHEMA = struct_of(
    [
        ("district", T.StringType()),
        ("neighborhood", T.StringType()),
        ("year", T.LongType()),
        (INCOME_POPULATION_OUT, T.LongType()),
        ("Index_RFD_Barcelona_100", T.StringType()),
    ]
)
FORMATTED_RENT_SCHEMA = struct_of(
    [
        ("district", T.StringType()),
        ("neighborhood", T.StringType()),
        ("year", T.LongType()),
        ("Trimestre", T.LongType()),
        ("Lloguer_mitja", T.StringType()),
        ("Preu", T.StringType()),
    ]
)
AVG_PRICE_SCHEMA = struct_of([(AVG_PRICE_COLUMNS[0], T.StringType()), (AVG_PRICE_COLUMNS[1], T.DoubleType())])
ROI_SCHEMA = struct_of(
    [
        (ROI_COLUMNS[0], T.LongType()),
        (ROI_COLUMNS[1], T.StringType()),
        (ROI_COLUMNS[2], T.LongType()),
        (ROI_COLUMNS[3], T.DoubleType()),
    ]
)
