import numpy as np
import pytest
from pyspark.sql import functions as F

from skysift import run
from skysift.sources import adapters, geotiff, vectors


def test_a_raster_from_file_to_layer(spark, tmp_path):
    class Middle:
        """Finds one building in the middle of every tile but those in the first column."""

        def predict(self, tile, targets):
            return [] if "_c0" in tile else [([10.0, 10.0, 20.0, 22.0], targets[0], 0.8)]

    bands = np.random.default_rng(1).integers(20, 180, (3, 64, 64)).astype(np.uint8)
    bands[:, :32, 32:] = 0
    (tmp_path / "scene.tif").write_bytes(geotiff.encode(bands, [0.5, 0.0, 500000.0, 0.0, -0.5, 5300000.0], 32636, 0))
    source, results = f"file://{tmp_path}/scene.tif", f"file://{tmp_path}/results"
    adapters.register("middle", Middle)
    go = lambda **more: run.run(spark, source, results, model="middle", targets=["building"], size=32, stride=32, **more)
    layer = go()
    rows = layer.collect()
    # Four tiles; the upper right one is nodata, and the left ones have no object.
    assert spark.read.parquet(f"{results}/manifest").filter("not is_valid").select("filename", "reason").collect() == [("scene_r0_c1.tif", "nodata")]
    assert [(r.tile_filename, r.label, r.confidence, r.prompt_used) for r in rows] == [("scene_r1_c1.tif", "building", 0.8, "building")]
    assert [tuple(p) for p in rows[0].ring] == [(500021.0, 5299979.0), (500026.0, 5299979.0), (500026.0, 5299973.0), (500021.0, 5299973.0)]
    assert go(skip_tiling=True, most=1).count() == 0  # the first tile is on the left
    assert go(skip_tiling=True).count() == 1 and spark.read.parquet(f"{results}/found/done").count() == 3
    truth = spark.createDataFrame([(500021.0, 5299973.0, 500026.0, 5299979.0)], "xmin double, ymin double, xmax double, ymax double")
    report = run.location_report(truth, layer).first()
    assert (report["class"], report.precision, report.recall) == ("object", 1.0, 1.0)
    assert vectors.write_layer(layer, str(tmp_path / "out.gpkg"), srs=32636) is not None
    with pytest.raises(ValueError, match="manifest is of"):
        run.run(spark, f"file://{tmp_path}/other.tif", results, model="middle", targets=["building"], skip_tiling=True)
    assert go().select(F.count(F.lit(1))).first()[0] == 1
