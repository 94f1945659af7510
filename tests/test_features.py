"""Feature windows: same values for a subset, finite on degenerate input, indifferent to the order of zones."""

import numpy as np
import pytest

from kymo.operators import features
from kymo.plans import registry
from kymo.sources import hdf5

X = np.sin(np.arange(75.0) * 0.29) + 3


def test_subset_equals_full():
    full = features.window_features(X, [X, X * 2, X[::-1]], [X, X, X])
    assert list(full) == list(features.CATALOGUE) and len(full) == 126
    for name in features.CATALOGUE:
        assert features.window_features(X, [X, X * 2, X[::-1]], [X, X, X], [name]) == {name: full[name]}


@pytest.mark.parametrize("x", [np.zeros(75), np.full(75, np.nan), np.full(75, 1e-300), np.where(np.arange(75) == 9, np.inf, 1.0)])
def test_degenerate_windows_are_finite(x):
    assert all(np.isfinite(v) for v in features.window_features(x, [x, x, x], [x, x, x]).values())


def test_zone_order_does_not_matter():
    zones = [X, X * 2 + 1, np.cos(X)]
    a, b = (features.window_features(X, z) for z in (zones, zones[::-1]))
    assert all(np.isclose(a[k], b[k]) for k in a if not k.startswith("GZONE"))
    assert np.isclose(a["GZONE1_PERIODICITY"], b["GZONE3_PERIODICITY"])


def test_ties_average_all_pairs():
    view = features.View(X, [X, X + 1, X + 2])
    assert len(view.top_pairs) == 3 and np.allclose(view.top.raw, view.green.raw)


def test_frequency_of_a_sine_at_a_bin():
    x = np.sin(2 * np.pi * 20 * features.FS / 256 * np.arange(125) / features.FS)
    view = features.Channel(x, x)
    assert abs(view.dominant - 20 * features.FS / 256) < 0.1 and view.beats and view.entropy() < 0.6
    assert view.band_energy() > 0.95


def test_common_beat_of_three_zones():
    x = np.sin(2 * np.pi * 1.17 * np.arange(125) / features.FS)
    got = features.window_features(np.full(125, 9.0), [x + 100, 2 * x + 90, 3 * x + 80])
    assert got["G_ZONE_HR_SUPPORT_RATIO"] == 1 and got["G_ZONE_PHASE_CONCENTRATION"] > 0.999 and got["G_PAIR_SPECTRAL_CONSENSUS"] > 0.999
    assert got["G_ZONE_LAG_RMS_SEC"] == 0 and got["G_PAIR_FREQ_GAP_MEDIAN_HZ"] == 0 and np.isclose(got["G_2OF3_AC_SUPPORT"], 2 / 3)
    late = features.window_features(np.full(125, 9.0), [x[:115] + 100, x[5:120] + 100, x[10:] + 100])
    assert late["G_ZONE_LAG_RMS_SEC"] > 0.1 and late["G_ZONE_PHASE_CONCENTRATION"] < 0.8


def test_motion_needs_a_recording_and_a_window_a_second():
    got = features.window_features(X, [X, X, X])
    assert all(v == 0 for k, v in got.items() if k.startswith("ACC_"))
    still = features.window_features(X, [X, X, X], [X * 0, X * 0, X * 0 + 1])
    assert still["ACC_MAG_MEAN"] == still["ACC_GRAVITY_RATIO"] == 1 and still["ACC_BP_RMS"] == 0
    with pytest.raises(ValueError):
        features.window_features(X[:20], [X, X, X])


def test_unknown_feature_is_refused(spark, sf_dir):
    with pytest.raises(ValueError):
        features.extract(spark.range(1), "id", "a", ["b", "c", "d"], requested=["nope"])


@pytest.mark.parametrize("name", ["feature_cleaning", "feature_pool", "feature_pool_selected", "gbt_threshold_eval", "tree_usage", "isotonic_calibration", "embedding_components"])
def test_rows_only_queries_run(spark, sf_dir, name):
    assert registry.QUERIES[name](spark, sf_dir).count() > 0


def test_cleaning_verdicts(spark, sf_dir):
    got = {r["feature"]: r["verdict"] for r in registry.QUERIES["feature_cleaning"](spark, sf_dir).collect()}
    assert got["constant"] == "variance" and got["holes"] == "missing" and "correlation" in (got["price"], got["price_cents"])


def test_window_names_and_reject_reasons():
    assert hdf5.parse_window_name("rec_w20_1") == (20, 1) and hdf5.parse_window_name("rec") is None
    assert [hdf5.reject_reason(*x) for x in ((None, 0), (50, 0), (25, None), (25, 9), (100, 2))] == ["missing_frequency", "invalid_frequency", "missing_ppg_config", "invalid_ppg_config", None]
