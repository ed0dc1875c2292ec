"""One JSON array in one file, from many tasks."""

import json

import pytest
from pyspark.sql import functions as F

from docmill.sources import files

ODD = 'ñ,\n\\"],'


@pytest.mark.parametrize("way", ["places", "stream"])
def test_array_in_one_file(spark, tmp_path, monkeypatch, way):
    if way == "stream":  # as on a store without places to write at
        monkeypatch.setattr(files, "_place_parts", lambda spark, whole, parts, places: files._stream_parts(spark, whole, parts))
    for n, tasks in ((0, 1), (1, 8), (9, 3), (200_000, 8)):
        df = spark.range(0, n, 1, tasks).select("id", F.concat(F.lit(ODD), "id").alias("text"), F.array("id").alias("a"))
        path = tmp_path / f"{way}-{n}.json"
        files.write_json_file(df, f"file://{path}" if n == 9 else str(path))
        assert json.loads(path.read_text("utf-8")) == [{"id": k, "text": f"{ODD}{k}", "a": [k]} for k in range(n)]
    assert sorted(p.name for p in tmp_path.iterdir()) == sorted(f"{way}-{n}.json" for n in (0, 1, 9, 200_000))


def test_a_failed_write_leaves_no_file(spark, tmp_path):
    with pytest.raises(Exception, match="stop"):
        files.write_json_file(spark.range(5).select(F.raise_error(F.lit("stop")).cast("string").alias("x")), str(tmp_path / "a.json"))
    assert not (tmp_path / "a.json").exists()
