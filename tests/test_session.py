"""Stored intermediates and their removal."""

from pathlib import Path

from lexigrain.session import remove_stored, stored


def test_stored_tables_are_removed_on_request(spark):
    remove_stored(spark)
    frame = stored(spark.range(10), "probe")
    (path,) = {str(Path(name.removeprefix("file:")).parent) for name in frame.inputFiles()}
    assert "probe-" in path and frame.count() == 10 and Path(path).exists()
    assert remove_stored(spark) == 1 and not Path(path).exists()
    assert remove_stored(spark) == 0
