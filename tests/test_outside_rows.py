"""Broken and incomplete input fails; outputs read as the page reads them."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from skyground.functions.display import one_decimal
from skyground.schemas import DETECTIONS
from skyground.sources.landed import read_batch, read_detection_files, read_report_files


@pytest.mark.parametrize("page", [
    '{"data": [{"event_id_cnty": "A", "country": "X"}, {"event_id_', "<html><body>502</body></html>"])
def test_a_page_that_is_no_json_fails(spark, tmp_path, page):
    (tmp_path / "p1.json").write_text('{"data": [{"event_id_cnty": "A"}]}')
    assert read_report_files(spark, str(tmp_path)).count() == 1
    (tmp_path / "p2.json").write_text(page)
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        read_report_files(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("column", ["id", "latitude"])
def test_a_batch_without_a_column_fails(spark, tmp_path, column):
    rows = spark.createDataFrame([], DETECTIONS)
    rows.drop("ingested_at").write.parquet(str(tmp_path / "whole"))
    assert read_batch(spark, str(tmp_path / "whole"), DETECTIONS).columns == DETECTIONS.names
    rows.drop(column).write.parquet(str(tmp_path / "part"))
    with pytest.raises(ValueError, match=column):
        read_batch(spark, str(tmp_path / "part"), DETECTIONS)


def test_products_with_other_headers_are_read_together(spark, tmp_path):
    (tmp_path / "a.csv").write_text("latitude,longitude,frp\n1,2,3\n4,5,6\n")
    (tmp_path / "b.csv").write_text("longitude,latitude,frp,type\n20,10,30,2\n")
    (tmp_path / "c.csv").write_text("latitude,longitude,frp\n7,8,9\n")
    rows = read_detection_files(spark, [str(tmp_path / f"{n}.csv") for n in "abc"]).select(
        "latitude", "longitude", "frp", "type").collect()
    assert sorted(map(tuple, rows)) == [
        ("1", "2", "3", None), ("10", "20", "30", "2"), ("4", "5", "6", None), ("7", "8", "9", None)]


@pytest.mark.parametrize("number,text", [
    (4.45, "4.5"), (1.05, "1.1"), (2.15, "2.1"), (4.35, "4.3"), (0.25, "0.3"), (0.75, "0.8"),
    (0.05, "0.1"), (9.95, "9.9"), (9.96, "10.0"), (0.0, "0.0"), (123456.75, "123456.8"),
    (-0.25, "-0.3")])
def test_one_decimal_rounds_the_exact_value(spark, number, text):
    assert spark.range(1).select(one_decimal(F.lit(number))).first()[0] == text
