from tests.conftest import rows
from waybill.operators.silver import standardize_silver
from waybill.operators.zones import zone_lookup


def test_silver_accepts_a_stream(spark, tmp_path):
    """Silver is row-wise plus static lookups, so a stream gives what a batch gives."""
    landing = str(tmp_path / "landing")
    for n in range(3):
        spark.range(n * 10, n * 10 + 10).selectExpr(
            "id AS VendorID",
            "CAST(timestamp_seconds(1672531200 + id * 86400 * 5) AS TIMESTAMP_NTZ) AS tpep_pickup_datetime",
            "id % 3 AS PULocationID",
        ).coalesce(1).write.mode("append").parquet(landing)
    zones = zone_lookup(
        spark.createDataFrame(
            [(1, "Northside", "North Field", "Airports"), (2, "Southside", "Oak End", "Boro Zone")],
            ["LocationID", "Borough", "Zone", "service_zone"],
        )
    )
    batch = spark.read.parquet(landing)
    arguments = (zones, "yellow", "2023-01-01", "2023-05-01")
    stream = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(landing)
    query = (
        standardize_silver(stream, *arguments)
        .writeStream.format("memory")
        .queryName("silver_stream")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(120)
    assert rows(spark.table("silver_stream")) == rows(standardize_silver(batch, *arguments))
    assert spark.table("silver_stream").count() == 24
