"""Small embedded inputs: six state vectors as delivered by the position API
(one per case: NULL altitude on the ground, blank callsign, foreign
aircraft, integer 0 in a float position, a point in the VCP box, a squawk)
plus hand-made rows the sample batches never contain."""

import json

F1_ROWS = [
    ["e491a3", "TAM3574 ", "Brazil", 1768686562, 1768686563, -46.6582, -23.6264, None, True, 0.51, 329.06,
     None, None, None, None, False, 0],
    ["e48fb6", "        ", "Brazil", 1768686511, 1768686511, -46.6544, -23.6317, None, True, 6.17, 298.12,
     None, None, None, None, False, 0],
    ["4851b3", "KLM791  ", "Kingdom of the Netherlands", 1768686605, 1768686605, -46.5589, -23.3621, 2133.6,
     False, 118.86, 268.76, -0.33, None, 2217.42, None, False, 0],
    ["e49450", "TAM4736 ", "Brazil", 1769033656, 1769033656, -46.6576, -23.6301, None, True, 0, 59.06, None,
     None, None, None, False, 0],
    ["e48ac6", "AZU4270 ", "Brazil", 1769033610, 1769033610, -47.1779, -22.9762, 838.2, False, 46.41, 125.98,
     -2.28, None, 891.54, None, False, 0],
    ["e48c82", "PTSTU   ", "Brazil", 1769690835, 1769690835, -46.6571, -23.6211, None, True, 2.57, 70.31,
     None, None, None, "3674", False, 0],
]

# expected airport of each F1 row (closed box + 0.005 margin)
F1_AIRPORTS = ["CGH", "CGH", "GRU", "CGH", "VCP", "CGH"]


def document(rows) -> str:
    return json.dumps(rows)


def write_document(path: str, rows, pretty: bool = False) -> None:
    with open(path, "w") as fh:
        fh.write(json.dumps(rows, indent=2) if pretty else json.dumps(rows))


def bronze_rows(spark, rows=None, inserted_at="2026-01-30 00:00:00", start_id=1):
    """F1 rows as bronze (typed columns + processing date, id, insert time)."""
    from pyspark.sql import functions as F
    from aerolake.sources.ingest import typed_projection
    rows = rows if rows is not None else F1_ROWS
    df = spark.createDataFrame([(json.dumps(r),) for r in rows], "value string")
    typed = typed_projection(df.select(F.from_json("value", "array<string>").alias("row")))
    return (typed.withColumn("processing_date", F.lit("2026-01-30").cast("date"))
                 .withColumn("id_surrogate", F.monotonically_increasing_id() + start_id)
                 .withColumn("inserted_at", F.lit(inserted_at).cast("timestamp_ntz")))
