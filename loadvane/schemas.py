"""Column types of every source and stored table; nothing is inferred."""

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Landed documents
DEMAND_DOCUMENT = _struct(
    series=T.ArrayType(
        _struct(
            series_id=T.StringType(),
            name=T.StringType(),
            units=T.StringType(),
            updated=T.StringType(),
            data=T.ArrayType(T.ArrayType(T.StringType())),
        )
    )
)
LIVE_DOCUMENT = _struct(
    coord=_struct(lon=T.DoubleType(), lat=T.DoubleType()),
    dt=T.LongType(),
    main=_struct(
        temp=T.DoubleType(),
        feels_like=T.DoubleType(),
        temp_min=T.DoubleType(),
        temp_max=T.DoubleType(),
        pressure=T.DoubleType(),
        humidity=T.DoubleType(),
    ),
)
# lists wherever the format may repeat an element; attributes carry an underscore
_POINT = _struct(_latitude=T.DoubleType(), _longitude=T.DoubleType())
_TEMPERATURE = _struct(value=T.ArrayType(T.StringType()))
FORECAST_DOCUMENT = _struct(
    head=_struct(product=T.StructType([T.StructField("creation-date", T.ArrayType(T.StringType()))])),
    data=T.StructType(
        [
            T.StructField("location", _struct(point=T.ArrayType(_POINT))),
            T.StructField(
                "time-layout",
                T.ArrayType(T.StructType([T.StructField("start-valid-time", T.ArrayType(T.StringType()))])),
            ),
            T.StructField("parameters", T.ArrayType(_struct(temperature=T.ArrayType(_TEMPERATURE)))),
        ]
    ),
)
STATION_LINE = _struct(
    STATION=T.StringType(),
    NAME=T.StringType(),
    DATE=T.StringType(),
    TMP=T.StringType(),
    DEW=T.StringType(),
)
STATION_SEED = T.StructType(
    [
        T.StructField("USAF", T.StringType()),
        T.StructField("WBAN", T.StringType()),
        T.StructField("STATION NAME", T.StringType()),
        T.StructField("STATE", T.StringType()),
        T.StructField("LAT", T.DoubleType()),
        T.StructField("LON", T.DoubleType()),
        T.StructField("BEGIN", T.DateType()),
        T.StructField("END", T.DateType()),
    ]
)

# Staged tables
DEMAND_DATA = _struct(timestamp=T.TimestampType(), value=T.DoubleType(), series_id=T.StringType())
DEMAND_METADATA = _struct(
    series_id=T.StringType(), name=T.StringType(), units=T.StringType(), updated=T.StringType()
)
STATION_OBSERVATIONS = _struct(
    STATION=T.StringType(),
    NAME=T.StringType(),
    DATE=T.StringType(),
    temperature_degC=T.DoubleType(),
    dew_point_degC=T.DoubleType(),
    temperature_QC=T.StringType(),
    dew_point_QC=T.StringType(),
)
LIVE_WEATHER = _struct(
    temp=T.DoubleType(),
    feels_like=T.DoubleType(),
    temp_min=T.DoubleType(),
    temp_max=T.DoubleType(),
    pressure=T.DoubleType(),
    humidity=T.DoubleType(),
    timestamp=T.TimestampType(),
    lon=T.DoubleType(),
    lat=T.DoubleType(),
)
WEATHER_FORECAST = _struct(
    forecast_time=T.TimestampType(),
    lon=T.DoubleType(),
    lat=T.DoubleType(),
    temp_F=T.LongType(),
    creation_time=T.TimestampType(),
)
DEMAND_PREDICTIONS = _struct(
    energy_timestamp_mtn=T.TimestampType(),
    predicted_energy_demand=T.DoubleType(),
    temp_f_forecast=T.DoubleType(),
    model_version=T.StringType(),
    prediction_start_date=T.TimestampType(),
    prediction_creation_date=T.TimestampType(),
)
RUN_LOG = _struct(
    run_id=T.StringType(),
    logged_at=T.TimestampType(),
    params=T.MapType(T.StringType(), T.StringType()),
    metrics=T.MapType(T.StringType(), T.DoubleType()),
)
