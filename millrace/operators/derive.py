"""Derived features: year gap, location cluster, map points."""

from __future__ import annotations

from pyspark.ml import Estimator, Transformer
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import as_double, col
from millrace.operators.base import Configured, Fitted, Persisted, number, param, text

# Names of the domain table's columns and the class colours of its map.
REFERENCE_COLUMN = "date_recorded"
CONSTRUCTION_COLUMN = "construction_year"
AGE_COLUMN = "pump_age"
CLUSTER_COLUMN = "geo_cluster"
LATITUDE, LONGITUDE = "latitude", "longitude"
CLASS_COLOURS = {
    "functional": "#2196F3",
    "functional needs repair": "#FF9800",
    "non functional": "#F44336",
}
OTHER_COLOUR = "#999999"
MAP_POINTS = 5_000

DATE_FORMATS = ["M/d/yyyy", "yyyy/M/d"]


def parsed_date(x: Column) -> Column:
    """Text as a timestamp: ISO forms and the listed formats; null if none fits."""
    return F.coalesce(F.try_to_timestamp(x), *[F.try_to_timestamp(x, F.lit(f)) for f in DATE_FORMATS])


class YearGap(Configured, Transformer, Persisted):
    """Year of a reference date minus a construction year; negative gaps become null."""

    reference_column = param("reference_column", "date, timestamp or date text", text)
    construction_column = param("construction_column", "year, numeric or numeric text", text)
    output_column = param("output_column", "name of the added column", text)
    DEFAULTS = {
        "reference_column": REFERENCE_COLUMN,
        "construction_column": CONSTRUCTION_COLUMN,
        "output_column": AGE_COLUMN,
    }

    def _transform(self, df: DataFrame) -> DataFrame:
        reference, construction = self.get("reference_column"), self.get("construction_column")
        kind = df.schema[reference].dataType
        if isinstance(kind, T.NumericType):
            raise ValueError(
                f"'{reference}' is numeric, not a date: place the year gap before the encoder that replaced it"
            )
        date = parsed_date(col(reference)) if isinstance(kind, T.StringType) else col(reference)
        year = col(construction)
        if isinstance(df.schema[construction].dataType, T.StringType):
            year = F.trim(year).try_cast("double")
        gap = F.year(date).cast("double") - year.cast("double")
        return df.withColumn(self.get("output_column"), F.when(gap >= 0, gap))


class GeoCluster(Configured, Estimator, Persisted):
    """KMeans on two coordinates; rows missing either get a null cluster."""

    n_clusters = param("n_clusters", "number of clusters", number(1, open_low=True, whole=True))
    output_column = param("output_column", "name of the added column", text)
    lat_column = param("lat_column", "latitude", text)
    lon_column = param("lon_column", "longitude", text)
    seed = param("seed", "seed of the initial centres", number(whole=True))
    DEFAULTS = {
        "n_clusters": 20,
        "output_column": CLUSTER_COLUMN,
        "lat_column": LATITUDE,
        "lon_column": LONGITUDE,
        "seed": 42,
    }

    def _fit(self, df: DataFrame) -> GeoClusterModel:
        lat, lon = self.get("lat_column"), self.get("lon_column")
        points = df.select(as_double(lat).alias("lat"), as_double(lon).alias("lon")).dropna()
        located = VectorAssembler(inputCols=["lat", "lon"], outputCol="features").transform(points)
        fitted = KMeans(k=self.get("n_clusters"), seed=self.get("seed")).fit(located.select("features"))
        return self.model(
            GeoClusterModel,
            centres=[[float(v) for v in c] for c in fitted.clusterCenters()],
            lat=lat,
            lon=lon,
            output=self.get("output_column"),
        )


class GeoClusterModel(Fitted, Persisted):
    def _transform(self, df: DataFrame) -> DataFrame:
        lat, lon = as_double(self.learned["lat"]), as_double(self.learned["lon"])
        cluster = nearest_centre(lat, lon, self.learned["centres"])
        return df.withColumn(self.learned["output"], cluster)


def nearest_centre(x: Column, y: Column, centres: list[list[float]]) -> Column:
    """Index of the closest centre (lowest on ties), null if a coordinate is null."""
    distances = F.array(
        *[
            F.struct((x - F.lit(cx)) * (x - F.lit(cx)) + (y - F.lit(cy)) * (y - F.lit(cy)), F.lit(float(i)).alias("i"))
            for i, (cx, cy) in enumerate(centres)
        ]
    )
    return F.when(x.isNotNull() & y.isNotNull(), F.array_min(distances)["i"])


def map_sample(
    df: DataFrame,
    *,
    id_col: str,
    lat_col: str = LATITUDE,
    lon_col: str = LONGITUDE,
    max_points: int = MAP_POINTS,
    seed: int = 42,
) -> DataFrame:
    """Located rows, all columns: a seeded sample of ``max_points`` at most, the same on any partitions."""
    order = F.md5(F.concat_ws(":", col(id_col).cast("string"), F.lit(str(seed))))
    located = df.filter((as_double(lat_col) != 0) & (as_double(lon_col) != 0))
    return located.orderBy(order).limit(max_points)


def map_points(
    df: DataFrame,
    *,
    id_col: str,
    prediction_col: str = "prediction",
    lat_col: str = LATITUDE,
    lon_col: str = LONGITUDE,
    max_points: int = MAP_POINTS,
    seed: int = 42,
) -> DataFrame:
    """Located rows with predicted class and colour; a seeded sample of ``max_points`` at most."""
    lat, lon = as_double(lat_col), as_double(lon_col)
    colour = F.lit(OTHER_COLOUR)
    for label, value in CLASS_COLOURS.items():
        colour = F.when(col(prediction_col) == label, F.lit(value)).otherwise(colour)
    points = map_sample(df, id_col=id_col, lat_col=lat_col, lon_col=lon_col, max_points=max_points, seed=seed)
    return points.select(lat.alias("lat"), lon.alias("lon"), col(prediction_col).alias("prediction"), colour.alias("colour"))
