import pytest

from gridcube.functions import headers as H


def test_base_variant_single_pass():
    assert H.normalize_name(" Total   Active ") == "total__active"
    assert H.normalize_name("Measurement efficiency (%)") == "measurement_efficiency_(%)"


def test_variants():
    assert H.normalize_name("% of AG measured", "ag") == "pct_of_ag_measured"
    assert H.normalize_name("Active AG Measured (Height & Weight)", "ag") == "active_ag_measured_height_&_weight"
    assert H.normalize_name("NO. OF PW DUE ANC 1", "gwg") == "no_of_pw_due_anc_1"
    assert H.normalize_name("Total Children 0-6M", "lbw") == "total_children_0_6m"
    assert H.normalize_name("AWW Completed 80% of ME", "me") == "aww_completed_80pct_of_me"
    assert H.normalize_name("Total SAM with SUW Children (6m-3y)", "snp") == "total_sam_with_suw_children_6m_3y"


def test_strict_name():
    assert H.strict_name(" Measurement  (%) Rate ") == "measurement___rate"


def test_number_duplicates_and_blank():
    assert H.number_duplicates(["District", "Anaemic", "x", "Anaemic", "Anaemic"]) == \
        ["District", "Anaemic", "x", "Anaemic.1", "Anaemic.2"]
    assert H.number_duplicates(["", "CATEGORY"]) == ["Unnamed: 0", "CATEGORY"]


def test_require_columns():
    H.require_columns(["a", "b"], ["a"])
    with pytest.raises(KeyError):
        H.require_columns(["a"], ["a", "lbw"])


def test_normalize_col_matches_names(spark):
    names = [" Total   Active ", "% of AG (measured)", "NO. OF PW", "a-b"]
    df = spark.createDataFrame([(n,) for n in names], "h string")
    for v in H.VARIANTS:
        got = [r[0] for r in df.select(H.normalize_col("h", v)).collect()]
        assert got == H.normalize_names(names, v)


def test_normalize_headers_dataframe(spark):
    df = spark.createDataFrame([(1, 2)], "`A  B` long, `C (%)` long")
    assert H.normalize_headers(df, "me").columns == ["a_b", "c_(pct)"]


def test_rename_map_ignores_missing_keys():
    assert H.rename_map(["district", "anaemic", "anaemic.1"], {"anaemic": "anaemic_pw", "anaemic.1": "anaemic_lm",
                                                               "absent": "x"}) == ["district", "anaemic_pw", "anaemic_lm"]


def test_strict_and_numbered_rows_match_the_names(spark):
    names = [" Measurement  (%) Rate ", "a-b_c", "Ünï x", "__"]
    got = spark.createDataFrame([(n,) for n in names], "h string").select(H.strict_col("h")).collect()
    assert [r[0] for r in got] == [H.strict_name(n) for n in names]
    files = {"f": ["x", "x", "", "x.1", None, "x"], "g": ["x"], None: ["a", "a"]}
    df = spark.createDataFrame([(f, i, h) for f, hs in files.items() for i, h in enumerate(hs)], "file string, at int, head string").repartition(3)
    out = {}
    for r in H.number_duplicates_by(df, "file", "at", "head").collect():
        out.setdefault(r.file, {})[r.at] = (r["head"], r.label)
    assert {f: [v[1] for _, v in sorted(d.items())] for f, d in out.items()} == {f: H.number_duplicates(hs) for f, hs in files.items()}
    assert out["f"][4][0] is None
