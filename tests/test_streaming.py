import os

from pyspark.sql import functions as F

from reqlens.operators.clean import clean_requests
from reqlens.operators.features import transform_requests
from reqlens.sources.files import read_raw_csv
from reqlens.streaming.incremental import raw_csv_stream, start_incremental_transform
from tests.fixtures import HEADERS, raw_csv_text


def test_incremental_equals_batch(spark, tmp_path):
    src = tmp_path / "incoming"
    src.mkdir()
    lines = raw_csv_text().splitlines()
    header, body = lines[0], lines[1:]
    assert "said" not in lines[1]
    body[0] = body[0].replace(",N/A,", ',"said ""no"", left",', 1)  # doubled quotes and a comma in a field
    half = len(body) // 2
    for i, chunk in enumerate((body[:half], body[half:])):
        (src / f"part{i}.csv").write_text("\n".join([header] + chunk) + "\n")

    out = str(tmp_path / "out")
    q = start_incremental_transform(
        raw_csv_stream(spark, str(src), HEADERS, max_files_per_trigger=1),
        out,
        checkpoint_location=str(tmp_path / "ckpt"),
    )
    q.awaitTermination(300)
    assert q.exception() is None
    streamed = spark.read.parquet(out)
    assert sorted(os.listdir(out)) == ["batch_id=0", "batch_id=1"]

    batch = transform_requests(clean_requests(read_raw_csv(spark, str(src))))
    cols = batch.columns
    assert sorted(streamed.select(*cols).collect(), key=repr) == sorted(batch.collect(), key=repr)
    assert streamed.where(F.col("detail") == 'said "no", left').count() == 1
    assert streamed.where(F.col("resolution_time_hours") < 0).count() == 0
