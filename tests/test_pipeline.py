"""Pipeline on synthetic clip tables: invariants and incrementality (§5.6)."""

import pytest
from pyspark.sql import functions as F

from tests import synthetic
from vocalstat.operators import matrix
from vocalstat.plans import pipeline

K = ["ver", "lc", "alg", "sp"]


@pytest.fixture(scope="module")
def results(spark):
    inp = pipeline.SplitInputs(clips=synthetic.clips(spark, 6000), durations=synthetic.durations(spark, 6000),
                               specs=synthetic.specs(spark, 6000))
    ss, cs, aa = pipeline.split_statistics(inp)
    return {r["ver"] + "|" + r["lc"] + "|" + r["alg"] + "|" + r["sp"]: r for r in ss.collect()}, \
        cs.collect(), aa.collect(), ss


def test_bucket_invariants(results):
    ss, _, _, _ = results
    for key, r in ss.items():
        ver, lc, alg, sp = key.split("|")
        assert r["dem_table"][-1][-1] == r["clips"]
        if ver == "1":
            assert r["dur_total"] == -1.0 and r["dur_freq"] == []
        else:
            assert sum(r["dur_freq"]) <= r["clips"]
        if sp == "clips":
            parts = [ss.get(f"{ver}|{lc}||{b}") for b in ("validated", "invalidated", "other")]
            assert r["clips"] == sum(p["clips"] for p in parts if p)


def test_speed_and_audio(results):
    ss, cs, aa, _ = results
    # splits of version 1 have no durations and keep the empty record
    assert cs and all((r["clips"] > 0) == (r["ver"] != "1") for r in cs)
    # version 1 has no audio data either: the empty record
    assert all(r["clips"] == 0 for r in aa if r["ver"] == "1")
    assert all(r["clips"] >= r["no_vad"] for r in aa)


def test_support_matrix(spark, results):
    _, _, _, ss_df = results
    locales = ss_df.select("lc").distinct()
    cells = {(r.lc, r.ver): r.cell for r in matrix.support_cells(ss_df).collect()}
    assert all(c.split("|")[1:] == sorted(c.split("|")[1:]) for c in cells.values())
    wide = pipeline.support_matrix(ss_df, locales)
    assert wide.count() == locales.count() and "v20_0" in wide.columns


def test_incremental_equals_full(spark):
    c = synthetic.clips(spark, 3000)
    d = synthetic.durations(spark, 3000)

    def run(clips):
        ss, _, _ = pipeline.split_statistics(pipeline.SplitInputs(clips=clips, durations=d))
        return {tuple(r[k] for k in K): (r["clips"], r["dur_total"], r["v_avg"]) for r in ss.collect()}

    full = run(c)
    half1 = run(c.where(F.col("lc").isin("en", "tr")))
    half2 = run(c.where(~F.col("lc").isin("en", "tr")))
    assert {**half1, **half2} == full
