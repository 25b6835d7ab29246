"""Resource catalog: cars, boards, capabilities, and insert-if-absent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The attributes a new car and the two capabilities are given.
CAR_DESCRIPTION = "Car"
ACTIVE = "active"
CAR_LAT, CAR_LON = -23.0, -46.0
LOCATION = "current_location"
BOARD = "traffic_board"
CAPABILITY_ROWS = [
    (LOCATION, "current location", "sensor"),
    (BOARD, None, "sensor"),
]
# The catalog is a table in folders by a hash of the key.
BUCKET, BUCKETS = "bucket", 64
CAPABILITIES = "name string, description string, capability_type string"


def cars(uuids: DataFrame) -> DataFrame:
    """Catalog rows for the vehicles named in `uuid`."""
    return uuids.select(
        "uuid", F.lit(CAR_DESCRIPTION).alias("description"),
        F.array(F.lit(LOCATION)).alias("capabilities"), F.lit(ACTIVE).alias("status"),
        F.lit(CAR_LAT).alias("lat"), F.lit(CAR_LON).alias("lon"))


def boards(sites: DataFrame) -> DataFrame:
    """Catalog rows for boards at (node_id, lat, lon); the description names the node."""
    return sites.select(
        F.concat(F.lit("board-"), F.col("node_id").cast("string")).alias("uuid"),
        F.col("node_id").cast("string").alias("description"),
        F.array(F.lit(BOARD)).alias("capabilities"), F.lit(ACTIVE).alias("status"),
        F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"))


def having(catalog: DataFrame, capability: str) -> DataFrame:
    return catalog.where(F.array_contains("capabilities", capability))


def with_bucket(rows: DataFrame, key: str = "uuid", buckets: int = BUCKETS) -> DataFrame:
    """The rows with the partition of a catalog that their key belongs to."""
    return rows.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))


def absent(wanted: DataFrame, catalog: DataFrame, key: str = "uuid") -> DataFrame:
    """Rows of `wanted` whose key the catalog lacks, one per key."""
    return (wanted.where(F.col(key).isNotNull()).dropDuplicates([key])
            .join(catalog.select(key), key, "left_anti"))
