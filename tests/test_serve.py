
from gridcube.operators import serve as SV


def test_lookup_exact_contains_and_not_found(spark):
    cube = spark.createDataFrame([("Angul",), ("Khordha",), ("Nuapada",), ("Nawarangpur",)], "District string")
    req = spark.createDataFrame([(1, "  KHORDHA "), (2, "na"), (3, "xyz"), (4, "a.g"), (5, "ANGUL")],
                                "id long, name string")
    out = {r.request_id: r for r in SV.lookup(req, "id", "name", cube).collect()}
    assert (out[1].match, out[1].status) == ("Khordha", "exact")
    assert (out[2].match, out[2].status) == ("Nawarangpur", "contains")   # first key in key order
    assert out[3].status == "not_found" and out[3].match is None
    assert out[4].status == "not_found"                                     # literal, not a pattern
    assert out[5].status == "exact"


def test_available_keys_sorted(spark):
    cube = spark.createDataFrame([("b",), ("a",), (None,), ("a",)], "District string")
    assert [r.District for r in SV.available_keys(cube).collect()] == ["a", "b"]


def test_structured_profile_nan_to_null(spark):
    cube = spark.createDataFrame([("Angul", float("nan"), 12.5)], "District string, `Stunting_Total_%` double, "
                                                                  "`HV_Percentage` double")
    r = SV.structured_profile(cube).first()
    assert r.stunting_5_6.stunting_pct is None and r.service_delivery.home_visit_pct == 12.5
    assert r.stunting_0_5.stunting_pct is None and '"District":"Angul"' in r.raw


def test_bi_subset_and_scatter(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("b", 2.0, 3.0)],
                               "District string, `Measurement_Efficiency` double, `Stunting_Total_%` double")
    assert SV.bi_subset(df).columns == ["District", "Stunting_Total_%", "Measurement_Efficiency"]
    pts = SV.scatter_points(df).collect()
    assert [(p.District, p.x, p.y) for p in pts] == [("b", 2.0, 3.0)]


def test_lookup_over_rarest_grams_equals_contains(spark, monkeypatch):
    """Grams that all keys share are dealt over slices; short texts, texts with a
    gram no key has, blanks and repeats."""
    import random

    from gridcube.operators import serve as SV
    monkeypatch.setattr(SV, "GRAM_KEYS", 7)
    rnd = random.Random(2)
    keys = [f"District of {rnd.choice(['north', 'south', 'x'])}{i}" for i in range(60)] + [" Padded\t", "ab", "a", "", None, "Ünïcode – key"]
    asked = ["district", "istrict of n", "h1", "1", "of", "", " ", None, "north3", "zzz", "districtx", "DISTRICT OF X5", "padded", "ab", "ïco", "– k", "t of south2", "t of south2"]
    cube = spark.createDataFrame([(k,) for k in keys], "District string")
    req = spark.createDataFrame(list(enumerate(asked)), "i long, name string")
    got = {r.request_id: (r.match, r.status) for r in SV.lookup(req, "i", "name", cube).collect()}
    norm = {k: k.strip().lower() for k in keys if k is not None}
    for i, a in enumerate(asked):
        q = None if a is None else a.strip().lower()
        exact = sorted(k for k, n in norm.items() if n == q)
        part = sorted(k for k, n in norm.items() if q is not None and q in n)
        assert got[i] == ((exact[0], "exact") if exact else (part[0], "contains") if part else (None, "not_found")), a
