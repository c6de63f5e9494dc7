from gridcube.operators import indicators as I


def test_growth_base_edges(spark):
    cols = ("district string, total_children long, measured_children long, stunted_severe_pct double, "
            "stunted_moderate_pct double, stunted_normal_pct double, underweight_severe_pct double, "
            "underweight_moderate_pct double, underweight_normal_pct double")
    df = spark.createDataFrame([
        (" angul ", 10, 5, 1.125, 2.0, 50.0, 0.0, 0.0, 0.0),   # zero total with zero normal -> NULL ratio
        ("KHORDHA", 0, 0, 0.0, 0.0, 40.0, 1.0, 1.0, 98.0),      # zero base -> NULL coverage, x/0 -> 0
    ], cols)
    out = {r.district: r for r in I.growth_base(df).collect()}
    a, k = out["Angul"], out["Khordha"]
    assert a.stunting_total_pct == 3.12 and a.measurement_coverage_pct == 50.0
    assert a.normal_underweight_ratio is None
    assert k.measurement_coverage_pct is None and k.normal_stunting_ratio == 0.0
    assert k.normal_underweight_ratio == 49.0


def test_anaemia_zero_denominators(spark):
    cols = ("district string, anaemic_pw long, hb_measured_pw long, anaemic_lm long, hb_measured_lm long, "
            "anaemic_child long, hb_measured_child long")
    df = spark.createDataFrame([("a", 1, 3, 0, 0, 5, 0)], cols)
    r = I.anaemia(df).first()
    assert (r.pw_anaemia_rate, r.lm_anaemia_rate, r.child_anaemia_rate) == (0.33, 0.0, 0.0)


def test_share_of_total_zero_total(spark):
    df = spark.createDataFrame([("a", 0), ("b", 0)], "district string, x long")
    assert [r.s for r in I.share_of_total(df, "x", "s").collect()] == [0.0, 0.0]
    df = spark.createDataFrame([("a", 1), ("b", 3)], "district string, x long")
    assert sorted(r.s for r in I.share_of_total(df, "x", "s").collect()) == [0.25, 0.75]


def test_readiness_rounding_order(spark):
    df = spark.createDataFrame([("a", 3, 2, 1, 1, 0)],
                               "district string, total_awc long, active_awc long, inactive_awc long, "
                               "new_awc_month long, inactive_awc_month long")
    r = I.readiness(df).first()
    assert (r.active_awc_pct, r.inactive_awc_pct) == (0.67, 0.33)
    assert r.awc_readiness_score == round(0.67 * 0.8 + (1 - 0.33) * 0.2, 3)
    assert r.awc_churn_rate == 0.333


def test_partial_coverage_branches(spark):
    base = "district string, total_ag long, ag_measured long, ag_severely_thin long, ag_thin long, " \
           "ag_hb_measured long, ag_anaemic long"
    derived = I.partial_coverage(spark.createDataFrame([("a", 4, 3, None, 1, 0, 0)], base)).first()
    assert derived.ag_measured_pct == 0.75 and derived.ag_underweight == 1 and derived.ag_anaemia_rate == 0.0
    given = I.partial_coverage(spark.createDataFrame([("a", 4, 3, "81.236", 0, 1, 2, 1)],
                                                     "district string, total_ag long, ag_measured long, "
                                                     "ag_measured_pct string, ag_severely_thin long, ag_thin long, "
                                                     "ag_hb_measured long, ag_anaemic long")).first()
    assert given.ag_measured_pct == 81.24 and given.ag_anaemia_rate == 0.5


def test_low_rate_requires_columns(spark):
    import pytest
    with pytest.raises(KeyError):
        I.low_rate(spark.createDataFrame([("a", 1)], "district string, total_children_0_6m long"))


def test_to_entity_grain_ratio_of_sums(spark):
    centres = spark.createDataFrame([("a", 1, 1, 100.0), ("a", 9, 0, 0.0), ("b", 2, 1, 50.0)],
                                    "district string, total_children_0_6m long, lbw_children_0_6m long, pct double")
    g = I.to_entity_grain(centres, ["district"])
    assert sorted(g.columns) == ["district", "lbw_children_0_6m", "total_children_0_6m"]
    rates = {r.district: r.lbw_rate_pct for r in I.low_rate(g).collect()}
    assert rates == {"A": 0.1, "B": 0.5}     # 1/10, not the mean of 1.0 and 0.0
