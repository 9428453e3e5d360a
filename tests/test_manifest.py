import os

from canopy.sources.manifest import category_manifest, point_manifest, point_manifest_rows


def test_point_manifest(spark, tmp_root):
    p = os.path.join(tmp_root, "points.csv")
    with open(p, "w") as f:
        f.write("BIOMNAME,TABLE_NAME,OTHER\nWetland,WL_AIR_TEMP,x\nDesert,DS_SOIL_1,y\n"
                "Wetland,WL_AHUR_2-b,z\n")
    got = [r.point for r in point_manifest(spark, p, "Wetland").collect()]
    assert got == ["WL_AIR_TEMP", "WL_AHUR_2-b"]
    assert point_manifest(spark, os.path.join(tmp_root, "missing.csv"), "Wetland").count() == 0
    bad = os.path.join(tmp_root, "bad.csv")
    with open(bad, "w") as f:
        f.write("A,B\n1,2\n")
    assert point_manifest(spark, bad, "Wetland").count() == 0


def test_category_manifest_keeps_row_order(spark, tmp_root):
    p = os.path.join(tmp_root, "cats.csv")
    with open(p, "w") as f:
        f.write("Id,Table Name,Rows\ntype1,SX_B_TEMP,10\nother, SX_Z_1 ,3\ntype1,SX_A_RH,10\n")
    rows = sorted((r.category, r.ord, r.point) for r in category_manifest(spark, p).collect())
    assert rows == [("other", 1, "sx_z_1"), ("type1", 1, "sx_b_temp"), ("type1", 2, "sx_a_rh")]


def test_rejects_are_returned_beside_the_points(spark, tmp_root):
    p = os.path.join(tmp_root, "points.csv")
    with open(p, "w") as f:
        f.write('BIOMNAME,TABLE_NAME,OTHER\nWetland,A,x\nWetland\nWetland,B,"x,y"\nWetland,C\nWetland, ,z\nDesert,D,y\n')
    points, rejects = point_manifest_rows(spark, p, "Wetland")
    assert [r.point for r in points.collect()] == ["A", "B"]
    assert [(r.record, r.fields, r.expected) for r in rejects.orderBy("place").collect()] == [
        ("Wetland", 1, 3), ("Wetland,C", 2, 3), ("Wetland, ,z", 3, 3)]
    assert [r.point for r in point_manifest(spark, p, "Wetland").collect()] == ["A", "B"]
    with open(p, "a") as f:
        f.write("Wetland,E,x,too,many\n")
    assert point_manifest(spark, p, "Wetland").count() == 0     # refused as a whole
    points, rejects = point_manifest_rows(spark, p, "Wetland")
    assert points.count() == 2 and rejects.filter("fields = 5").count() == 1


def test_order_is_that_of_the_files(spark, tmp_root):
    """A file far over a split's size keeps its order; files follow their paths."""
    for k, n in (("a", 4000), ("b", 3)):
        with open(os.path.join(tmp_root, f"{k}.csv"), "w") as f:
            f.write("Id,Table Name\n" + "".join(f"other,{k}{i:05d}{'x' * 200}\n" for i in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        rows = category_manifest(spark, tmp_root).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    got = [r.point for r in sorted(rows, key=lambda r: r.ord)]
    assert got == sorted(got) and len(got) == 4003
