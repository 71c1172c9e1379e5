import pytest

from farsight.functions.index import dense_index
from farsight.sources import read_items_text, read_points_text


def test_points_text(spark, tmp_path):
    p = tmp_path / "pts.csv"
    p.write_text("1.0,2.0\n-3.5,4.25\n0,0\n")
    rows = read_points_text(spark, str(p)).orderBy("id").collect()
    assert [(r["x"], r["y"]) for r in rows] == [(1.0, 2.0), (-3.5, 4.25), (0.0, 0.0)]


def test_bad_token_fails(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text("1.0,abc\n")
    with pytest.raises(Exception):
        read_points_text(spark, str(p)).collect()


def test_items_text_dense_positions(spark, tmp_path):
    d = tmp_path / "items"
    d.mkdir()
    (d / "a.txt").write_text("\n".join(str(i) for i in range(7)) + "\n")
    (d / "b.txt").write_text("\n".join(str(100 + i) for i in range(5)) + "\n")
    rows = read_items_text(spark, str(d)).collect()
    assert sorted(r["pos"] for r in rows) == list(range(12))


def test_dense_index_multi_partition(spark):
    df = spark.range(0, 1000, 1, 7).repartition(5)
    got = sorted(r["pos"] for r in dense_index(df, "pos").collect())
    assert got == list(range(1000))


def test_items_text_positions_follow_file_order(spark, tmp_path):
    d = tmp_path / "ordered"
    d.mkdir()
    # the second file is much larger: Spark packs it first, positions must not
    (d / "part-0.txt").write_text("\n".join(str(i) for i in range(5)) + "\n")
    (d / "part-1.txt").write_text("\n".join(str(1000 + i) for i in range(3000)) + "\n")
    (d / "part-2.txt").write_text("\n".join(str(9000 + i) for i in range(7)) + "\n")
    rows = sorted((r["pos"], r["item"]) for r in read_items_text(spark, str(d)).collect())
    want = list(range(5)) + [1000 + i for i in range(3000)] + [9000 + i for i in range(7)]
    assert [it for _, it in rows] == want
    assert [p for p, _ in rows] == list(range(len(want)))


def test_points_text_nd(spark, tmp_path):
    p = tmp_path / "pts3.csv"
    p.write_text("1,2,3\n4.5,5,6\n")
    rows = read_points_text(spark, str(p), dims=3).orderBy("id").collect()
    assert [list(r["v"]) for r in rows] == [[1.0, 2.0, 3.0], [4.5, 5.0, 6.0]]


def test_points_text_rejects_empty_fields_and_blank_lines(spark, tmp_path):
    for k, text in enumerate(("1.0,2.0\n3.0,\n", "1.0,2.0\n\n3.0,4.0\n", "1,2,3\n", "1,x\n")):
        p = tmp_path / f"bad{k}.csv"
        p.write_text(text)
        with pytest.raises(Exception):
            read_points_text(spark, str(p)).collect()


def test_items_text_accepts_padded_integers(spark, tmp_path):
    p = tmp_path / "items.txt"
    p.write_text(" 5\n7 \n-1\n")
    assert [(r["pos"], r["item"]) for r in read_items_text(spark, str(p)).orderBy("pos").collect()] == [(0, 5), (1, 7), (2, -1)]
