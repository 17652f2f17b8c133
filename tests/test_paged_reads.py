"""What a page of a recording costs."""

from pyarrow import parquet
from pyspark.sql import functions as F

from siftmill.sources import paged


def test_a_page_costs_one_small_row_group(spark, tmp_path, monkeypatch):
    body = F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(700)), lambda i: F.sha2(F.concat(F.col("id").cast("string"), F.lit("/"), i.cast("string")), 256)))
    rows = spark.range(120).select(F.concat(F.lit("https://a.test/"), F.col("id").cast("string")).alias("address"), F.lit(200).alias("status"), body.alias("body"))
    recording = paged.record(rows, paged.Recording(str(tmp_path / "rec"), 2))
    opened, read, opens, reads = [], [], parquet.ParquetFile.__init__, parquet.ParquetFile.read_row_group
    monkeypatch.setattr(parquet.ParquetFile, "__init__", lambda self, *a, **k: opened.append(1) or opens(self, *a, **k))
    monkeypatch.setattr(parquet.ParquetFile, "read_row_group", lambda self, *a, **k: read.append(out := reads(self, *a, **k)) or out)
    shelf = paged.Shelf(recording)
    for r in rows.collect():
        assert shelf.answer(r.address) == (200, r.body)
    assert len(opened) == 2 and len(read) == 120 and max(t.num_rows for t in read) <= 20
    assert shelf.answer("https://a.test/none") == (None, None) == paged.Recording(str(tmp_path / "rec"), 1000).answer("https://a.test/x")
