"""The outlier rule against an exact minimum covariance determinant in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from rowbridge.llm import quality

FLOOR = np.diag(np.square(quality.FLOORS))
CORE = 0.75


def features(c: dict) -> np.ndarray:
    words, chars = c["n_words"].astype(float), c["word_chars"].astype(float)
    return np.column_stack([
        np.log(chars / words), np.sqrt(c["n_symbols"] / chars),
        np.sqrt(c["n_dup_lines"] / np.maximum(c["n_lines"], 1)), np.sqrt(c["n_repeat_words"] / words), np.log10(words),
    ])


def distances(x, centre, covariance):
    return np.einsum("ij,ij->i", x - centre, np.linalg.solve(covariance, (x - centre).T).T)


def exact(x):
    """Smallest log-determinant and its distances, every core the exact nearest documents."""
    n = len(x)
    h = int(np.ceil(n * CORE))

    def step(centre, covariance):
        near = x[np.argsort(distances(x, centre, covariance), kind="stable")[:h]]
        return near.mean(0), np.cov(near.T, bias=True) + FLOOR

    quarter = np.percentile(np.round(x * 256) / 256, [25, 50, 75], axis=0)
    spread = np.sqrt(((quarter[2] - quarter[0]) / 1.349) ** 2 + np.diag(FLOOR))
    u = (x - quarter[1]) / spread
    u = u / np.sqrt((u * u).sum(1) + 1e-12)[:, None]
    direction = (u.T @ u) * np.outer(spread, spread) * x.shape[1] / n
    starts = [
        (quarter[1], np.diag(spread**2)), (quarter[1], direction + FLOOR), (x.mean(0), np.cov(x.T, bias=True) + FLOOR)
    ]
    found = []
    for now in starts:
        for _ in range(30):
            now = step(*now)
        found.append((np.linalg.slogdet(now[1])[1], now))
    logdet, (centre, covariance) = min(found, key=lambda f: f[0])
    return logdet, distances(x, centre, covariance), [f[0] for f in found]


def drawn(rng, n, planted):
    """Documents of one group; the planted ones are long-worded, full of symbols and repeats, and alike."""
    words = np.exp(rng.normal(5.6, 0.4, n)).astype(int) + 60
    counts = {
        "n_words": words, "word_chars": (words * np.exp(rng.normal(1.6, 0.12, n))).astype(int),
        "n_symbols": rng.poisson(2, n), "n_lines": rng.integers(1, 30, n), "n_dup_lines": np.zeros(n, int),
        "n_repeat_words": (words * rng.beta(2, 60, n)).astype(int),
    }
    at = slice(0, planted)
    counts["word_chars"][at] = (words[at] * rng.normal(14, 0.1, planted)).astype(int)
    counts["n_symbols"][at] = counts["word_chars"][at] // 3
    counts["n_repeat_words"][at] = words[at] * 45 // 100
    return counts


@pytest.fixture(scope="module")
def groups():
    rng = np.random.default_rng(11)
    return {
        ("en", "clean"): drawn(rng, 900, 0), ("en", "mixed"): drawn(rng, 1200, 240),
        (None, "mixed"): drawn(rng, 500, 60), ("de", None): drawn(rng, 400, 8),
    }


def as_rows(spark, groups):
    parts = {c: np.concatenate([g[c] for g in groups.values()]) for c in quality.COUNTS}
    keys = [k for k, g in groups.items() for _ in g["n_words"]]
    columns = {c: pa.array(v.astype("int64")) for c, v in parts.items()}
    columns |= {"lang": pa.array([k[0] for k in keys], pa.string()), "source": pa.array([k[1] for k in keys], pa.string())}
    columns["doc_id"] = pa.array(range(len(keys)), pa.int64())
    return spark.createDataFrame(pa.table(columns)).repartition(7, "doc_id")


def test_against_exact_determinants(spark, groups):
    counts = as_rows(spark, groups)
    fitted = quality.fit_outliers(counts, core=CORE, prior=0)
    got = {(r["grp"]["lang"], r["grp"]["source"]): r for r in fitted.collect()}
    verdicts = {r["doc_id"]: r for r in quality.judge(counts, fitted).collect()}
    assert set(got) == set(groups)
    first = 0
    for key, group in groups.items():
        x = features(group)
        logdet, d2, _ = exact(x)
        # A core is cut inside a bin by shares of the bin, which moves a determinant a little.
        assert got[key]["logdet"] == pytest.approx(logdet, abs=0.05), key
        unit = max(1.0, np.sort(d2)[(len(d2) - 1) // 2] / quality.CHI2_MEDIAN)
        limit = quality.chi_square_cutoff(1e-5)
        for i, d in enumerate(d2 / unit):
            r = verdicts[first + i]
            if abs(d / limit - 1) > 0.15:
                assert r["kept"] == (d <= limit), (key, i, d, r["distance"])
        first += len(x)


def test_planted_cluster_goes_and_the_rest_stays(spark, groups):
    counts = as_rows(spark, groups)
    kept = {r["doc_id"]: r["kept"] for r in quality.judge(counts, quality.fit_outliers(counts)).collect()}
    first = 0
    for key, planted in ((("en", "clean"), 0), (("en", "mixed"), 240), ((None, "mixed"), 60), (("de", None), 8)):
        n = len(groups[key]["n_words"])
        assert not any(kept[first + i] for i in range(planted)), key
        assert sum(kept[first + i] for i in range(planted, n)) >= 0.99 * (n - planted), key
        first += n


def test_a_step_never_raises_the_determinant(spark, groups):
    counts = as_rows(spark, groups)
    few = quality.fit_outliers(counts, most_steps=1).select("grp.*", "logdet").collect()
    many = {(r["lang"], r["source"]): r["logdet"] for r in quality.fit_outliers(counts).select("grp.*", "logdet").collect()}
    assert all(many[r["lang"], r["source"]] <= r["logdet"] + 1e-9 for r in few)


def test_small_groups_ties_and_nothing(spark):
    rng = np.random.default_rng(3)
    one, two = drawn(rng, 1, 0), drawn(rng, 2, 0)
    same = {c: np.repeat(v, 40) for c, v in drawn(rng, 1, 0).items()}
    counts = as_rows(spark, {("en", "one"): one, ("en", "two"): two, ("en", "same"): same, (None, None): one})
    judged = quality.judge(counts, quality.fit_outliers(counts)).collect()
    assert len(judged) == 44 and all(r["kept"] for r in judged)
    alone = quality.judge(counts, quality.fit_outliers(counts, prior=0)).collect()
    assert all(r["kept"] for r in alone)
    empty = counts.where("false")
    assert quality.judge(empty, quality.fit_outliers(empty)).count() == 0


def test_cutoff_is_the_chi_square_quantile():
    draws = (np.random.default_rng(5).normal(size=(400_000, 5)) ** 2).sum(1)
    assert quality.chi_square_cutoff(0.01) == pytest.approx(np.quantile(draws, 0.99), rel=0.01)
    assert quality.chi_square_cutoff(0.5) == pytest.approx(quality.CHI2_MEDIAN, abs=1e-3)
    with pytest.raises(ValueError):
        quality.chi_square_cutoff(0.0)
