"""Declared schemas of the landing files and the stations they come from."""

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


# Names and types of the landing columns.
WEATHER_LONG = T.StructType(
    [
        *_strings("STATION", "DATE", "OBS_TIME", "ELEMENT"),
        T.StructField("DATA_VALUE", T.LongType()),
        T.StructField("parsed_date", T.DateType()),
    ]
)
AIR_LONG = T.StructType(
    _strings("location_id", "sensors_id", "location", "datetime", "lat", "lon", "parameter", "units", "value")
)
ACCIDENTS = T.StructType(
    [
        *_strings("dr_no"),
        T.StructField("date_rptd", T.TimestampType()),
        T.StructField("date_occ", T.TimestampType()),
        *_strings(
            "time_occ",
            "area",
            "area_name",
            "rpt_dist_no",
            "crm_cd",
            "crm_cd_desc",
            "mocodes",
            "vict_age",
            "vict_sex",
            "vict_descent",
            "premis_cd",
            "premis_desc",
            "location",
            "cross_street",
        ),
        T.StructField("location_1", T.StructType(_strings("latitude", "longitude", "human_address"))),
    ]
)
ENERGY = T.StructType(
    _strings("period", "respondent", "respondent-name", "type", "timezone", "value", "value-units")
)
ENERGY_RECORD = T.StructType(
    _strings(
        "period",
        "respondent",
        "respondent-name",
        "type",
        "type-name",
        "timezone",
        "timezone-description",
        "value",
        "value-units",
    )
)

# Station -> identifiers of its weather station, air station and police area.
STATIONS = {
    "long_beach": ("USW00023129", "8679", "Harbor"),
    "downtown": ("USW00093134", "7936", "Central"),
    "reseda": ("USC00049785", "2138", "West Valley"),
}

# Air parameters of the hourly table, and those each station reports in the view.
AIR_PARAMETERS = ("co", "no", "no2", "nox", "o3", "pm10", "pm25", "so2")
AIR_MEASURED = {
    "reseda": ("co", "no2", "o3", "pm25"),
    "downtown": ("co", "no2", "o3", "pm25", "so2"),
    "long_beach": ("no2", "o3", "so2"),
}


def page_schema(record: T.StructType) -> T.StructType:
    """Schema of an API page: ``response{total, data: array of record}``."""
    response = T.StructType([T.StructField("total", T.StringType()), T.StructField("data", T.ArrayType(record))])
    return T.StructType([T.StructField("response", response)])


def with_corrupt_column(schema: T.StructType, name: str = "_corrupt_record") -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(name, T.StringType())])
