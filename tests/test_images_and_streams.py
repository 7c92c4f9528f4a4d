import numpy as np
import pytest
from pyspark.sql import functions as F

from quiremill.functions import images as I
from quiremill.operators import quality as Q
from quiremill.streaming import gate as G


def page(h=200, w=300):
    return np.full((h, w), 255, np.uint8)


def test_blank_stays_white():
    assert (I.restore(page(100, 100), 1) == 255).all()


def test_specks_go_and_lines_stay():
    g = page()
    g[100:106, 40:260] = 0
    g[20, 20] = g[180, 280] = 0
    g[108:110, 50] = 0
    out = I.despeckle(g)
    assert out[20, 20] == out[180, 280] == 255 and out[103, 150] == 0 and out[108, 50] == 0


def test_components_and_distance():
    m = np.array([[1, 0, 0, 1], [0, 1, 0, 1], [0, 0, 0, 0], [1, 1, 0, 0]], bool)
    labels, n = I.components(m)
    assert n == 3 and labels[0, 0] == labels[1, 1] != labels[0, 3] == labels[1, 3]
    d = I.distance(m)
    ys, xs = np.nonzero(m)
    brute = np.array([[np.sqrt(((ys - y) ** 2 + (xs - x) ** 2).min()) for x in range(4)] for y in range(4)])
    assert np.allclose(d, brute)
    assert np.isinf(I.distance(np.zeros((2, 2), bool))).all()


def test_u_shape_is_one_component():
    m = np.zeros((5, 5), bool)
    m[:, 0] = m[:, 4] = m[4, :] = True
    assert I.components(m)[1] == 1


@pytest.mark.parametrize("angle", [-1.2, 0.0, 0.8])
def test_skew(angle):
    g = page(300, 400)
    for y in range(40, 260, 20):
        g[y : y + 4, 30:370] = 0
    found = I.find_skew(I.rotate(g, angle))
    assert abs(found + angle) <= 0.08


def test_margins_rules_and_colour():
    g = np.full((500, 500), 240, np.uint8)
    g[:, 485:] = 90
    assert (I.restore(g, 2)[:, 485:] == 255).all()
    assert (I.level(g)[0, 0]) == 255
    r = page(100, 100)
    r[60, 10:40] = r[61, 10:40] = 0
    r[70, 0:90] = 0
    assert I.horizontal_rules(r) == [(60, 10, 40)]
    grey = np.repeat(page()[:, :, None], 3, axis=2)
    colour = grey.copy()
    colour[50:150, :, 0] = 0
    assert (I.is_color(page()), I.is_color(grey), I.is_color(colour)) == (False, False, True)


def test_split_shift_overlay():
    g = page(50, 200)
    g[:, 10:90] = g[:, 115:190] = 0
    left, right = I.split_spread(g)
    assert 90 <= left.shape[1] <= 115 and left.shape[1] + right.shape[1] == 200
    a = np.exp(-((np.arange(100) - 50.0) ** 2) / 20)
    b = np.exp(-((np.arange(100) - 53.4) ** 2) / 20)
    assert abs(I.subpixel_shift(a, b) - 3.4) < 0.1
    assert I.diff_overlay(page(3, 3), page(2, 4)).shape == (2, 3, 3)
    assert I.ink_extent(page()) is None and I.margin_purity(page()) == 0


def test_page_stats(spark):
    g = page(60, 80)
    g[30, 10:30] = 0
    x = spark.createDataFrame([(bytearray(g.tobytes()), 60, 80, "L")], "data binary, h int, w int, mode string")
    s = x.select(I.page_stats("data", "h", "w", "mode").alias("s")).first().s
    assert (s.is_color, s.rules, s.margin_ink, s.ink) == (False, 1, 0, [10, 30, 30, 31])


def test_stream_equals_batch(spark, tmp_path):
    schema = "job string, page int, conf double, ts timestamp"
    rows = [("j", i % 5, float(i), f"2024-01-01 0{i % 4}:00:00") for i in range(100)]
    w = spark.createDataFrame(rows, "job string, page int, conf double, ts string").withColumn("ts", F.to_timestamp("ts"))
    w.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = G.read_words(spark, str(tmp_path / "in"), schema, files_per_trigger=1)
    q = G.to_table(G.running_gate(stream, 50.0), "gate_out", "complete", str(tmp_path / "c1"))
    q.awaitTermination()
    batch = Q.quality_gate(w, 50.0).select("page", "word_count", "mean_confidence", "decision")
    assert sorted(spark.table("gate_out").select(batch.columns).collect()) == sorted(batch.collect())


def test_windows_and_once_per_page(spark, tmp_path):
    w = spark.createDataFrame([("j", 1, 50.0, "2024-01-01 00:10:00"), ("j", 1, 70.0, "2024-01-01 00:20:00"), ("j", 2, 10.0, "2024-01-01 09:00:00")], "job string, page int, conf double, ts string").withColumn("ts", F.to_timestamp("ts"))
    w.write.parquet(str(tmp_path / "in"))
    stream = G.read_words(spark, str(tmp_path / "in"), "job string, page int, conf double, ts timestamp")
    q = G.to_table(G.windowed_gate(stream, 55.0, "ts"), "window_out", "append", str(tmp_path / "c1"))
    q.awaitTermination()
    assert [(r.page, r.mean_confidence, r.decision) for r in spark.table("window_out").collect()] == [(1, 60.0, "pass")]
    q = G.to_files(G.once_per_page(stream, "ts"), str(tmp_path / "out"), str(tmp_path / "c2"))
    q.awaitTermination()
    assert spark.read.json(str(tmp_path / "out")).count() == 2
