"""Explicit bronze schemas. Inference would keep '$1,200.00' and 't'/'f' as text anyway,
and an explicit schema avoids a full extra pass over gzip files."""

from pyspark.sql import types as T

RAW_LISTINGS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("host_id", T.LongType()),
    T.StructField("host_name", T.StringType()),
    T.StructField("neighbourhood_cleansed", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("room_type", T.StringType()),
    T.StructField("price", T.StringType()),
    T.StructField("minimum_nights", T.IntegerType()),
    T.StructField("number_of_reviews", T.LongType()),
])

RAW_CALENDAR = T.StructType([
    T.StructField("listing_id", T.LongType()),
    T.StructField("date", T.DateType()),
    T.StructField("available", T.StringType()),
    T.StructField("price", T.StringType()),
    T.StructField("adjusted_price", T.StringType()),
    T.StructField("minimum_nights", T.IntegerType()),
    T.StructField("maximum_nights", T.IntegerType()),
])

RAW_REVIEWS = T.StructType([
    T.StructField("listing_id", T.LongType()),
    T.StructField("id", T.LongType()),
    T.StructField("date", T.DateType()),
    T.StructField("reviewer_id", T.LongType()),
    T.StructField("reviewer_name", T.StringType()),
    T.StructField("comments", T.StringType()),
])

RAW_NEIGHBOURHOODS = T.StructType([
    T.StructField("neighbourhood", T.StringType()),
    T.StructField("neighbourhood_group", T.StringType()),
    T.StructField("geometry_json", T.StringType()),
])

# GeoJSON FeatureCollection; geometry kept as raw JSON text (string schema on an object).
GEOJSON_FEATURES = T.StructType([
    T.StructField("features", T.ArrayType(T.StructType([
        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
        T.StructField("geometry", T.StringType()),
    ]))),
])

# MultiPolygon coordinates: polygons -> rings -> points -> [lon, lat]
MULTIPOLYGON = T.ArrayType(T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType()))))
POLYGON = T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType())))
