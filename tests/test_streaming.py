import json

from lamella.sources.masks import read_tile_lines
from lamella.streaming.tiles import tile_stream, type_counts


def test_counts_follow_new_files(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()

    def add(name, slide, types):
        (folder / name).write_text(json.dumps({"slide": slide, "x": 0, "y": 0, "width": 9, "height": 9, "masks": [None if t is None else {"cell_type": t} for t in types]}) + "\n")

    add("a.json", "S", ["Cancer cell", " cancer  cell", None])
    q = type_counts(tile_stream(spark, str(folder))).writeStream.outputMode("complete").format("memory").queryName("counts").option("checkpointLocation", str(tmp_path / "ck")).start()
    try:
        q.processAllAvailable()
        add("b.json", "S", ["", "Cancer cell"])
        q.processAllAvailable()
        got = sorted(map(tuple, spark.sql("select slide, cell_type, n from counts").collect()))
    finally:
        q.stop()
    assert got == [("S", "cancer cell", 3), ("S", "unknown", 1)]
    assert sorted(map(tuple, type_counts(read_tile_lines(spark, str(folder))).collect())) == got
