from gridcube.operators import cube as C
from tests.conftest import rows


def test_left_join_fan_out_and_nulls(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, x long")
    right = spark.createDataFrame([("a", 10), ("a", 11), (None, 12)], "k string, y long")
    out = sorted(rows(C.left_join_key(left, right, ["k"]), "k", "x", "y"), key=repr)
    assert out == sorted([("a", 1, 10), ("a", 1, 11), ("b", 2, None), (None, 3, None)], key=repr)
    ns = sorted(rows(C.left_join_key(left, right, ["k"], null_safe=True), "k", "x", "y"), key=repr)
    assert (None, 3, 12) in ns


def test_collision_suffixes(spark):
    a = spark.createDataFrame([("a", 1, 5)], "k string, v long, w long")
    b = spark.createDataFrame([("a", 2)], "k string, v long")
    c = spark.createDataFrame([("a", 3, 4)], "k string, v long, w long")
    frames = {"a": a, "b": b, "c": c}
    cube = C.build_cube(frames, ["a", "b", "c"], ["k"])
    assert cube.columns == ["k", "v_x", "w_x", "v_y", "v", "w_y"]
    assert C.collisions(frames, ["a", "b", "c"], ["k"]) == [("v", "a", "b"), ("w", "a", "c")]
    assert rows(cube) == [("a", 1, 5, 2, 3, 4)]


def test_cube_preserves_base_rows(spark):
    base = spark.createDataFrame([(f"d{i}", i) for i in range(30)], "k string, x long")
    side = spark.createDataFrame([(f"d{i}", i) for i in range(10)], "k string, z long")
    assert C.build_cube({"b": base, "s": side}, ["b", "s"], ["k"]).count() == 30
