from conftest import SF001
from farsight.operators import items as itemops, kcenter, sampling
from farsight.plans import reports
from farsight.sources import points2d, stream_items


def test_points_report_matches_operators(spark, tmp_path):
    p = points2d(spark, SF001)
    r = reports.points_report(p, 3, 10, 4)
    assert r["points"] == 1000
    assert r["radius"] == kcenter.kcenter_radius(p, kcenter.mr_fft_centers(p, 10, 4)).collect()[0]["radius"]
    text = reports.format_points_report(r, "events")
    assert "Number of sure outliers" in text and "Radius = " in text


def test_points_report_from_csv(spark, tmp_path):
    path = tmp_path / "pts.csv"
    path.write_text("\n".join(f"{i % 7}.5,{i // 7}.25" for i in range(60)) + "\n100,100\n")
    from farsight.sources import read_points_text
    r = reports.points_report(read_points_text(spark, str(path)), 3, 5, 2)
    assert r["points"] == 61 and r["sure_outliers"] >= 1


def test_items_report_matches_operators(spark):
    it = stream_items(spark, SF001)
    r = reports.items_report(it, 500, 0.05, 0.01, 0.1, 100)
    cut = itemops.stream_cutoff(it, 500, 100).select("pos", "item")
    assert r["consumed"] == 500
    assert r["true_frequent"] == sorted(x["item"] for x in itemops.frequent_exact(cut, 0.05, 500).collect())
    assert len(r["reservoir"]) == 20
    assert r["sticky_table_size"] == sampling.sticky_table(cut, 0.05, 0.01, 0.1, 500).count()
    assert "True frequent items:" in reports.format_items_report(r)


def test_stream_items_report(spark, tmp_path):
    import os
    from farsight.streaming import item_text_stream
    d = tmp_path / "lines"
    d.mkdir()
    for i in range(4):
        f = d / f"part-{i}.txt"
        f.write_text("\n".join(str(v % 9 if v % 3 else 4) for v in range(i * 50, i * 50 + 50)) + "\n")
        os.utime(f, (2_000_000 + i, 2_000_000 + i))
    r = reports.stream_items_report(spark, item_text_stream(spark, str(d)), 120, 0.2, 0.1, 0.1)
    assert r["consumed"] == 150                     # three whole files hold item 120
    assert 4 in r["true_frequent"]
    assert len(r["reservoir"]) == 5
    assert "Number of items in the Hash Table" in reports.format_items_report(r)
