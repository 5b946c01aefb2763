"""AvailableNow incremental job: only datasets with new files are recomputed."""

import tempfile

from pyspark.sql import functions as F

from tests import synthetic
from vocalstat.sources import tsv
from vocalstat.streaming import incremental


def test_available_now_recomputes_touched(spark):
    d = tempfile.mkdtemp()
    table, out, ckpt = f"{d}/clips", f"{d}/out", f"{d}/ckpt"
    c = synthetic.clips(spark, 1500).where(F.col("alg") == "")
    tsv.write_ingested(c.where(F.col("lc") == "en"), table)
    q = incremental.start(spark, table, out, ckpt)
    q.awaitTermination(300)
    first = tsv.read_results(spark, f"{out}/splits").select("ver", "lc").distinct().collect()
    assert {r.lc for r in first} == {"en"}
    tsv.write_ingested(c.where(F.col("lc") == "tr"), table)
    seen = []
    q = incremental.start(spark, table, out, ckpt, on_batch=lambda df, e: seen.extend(
        r.lc for r in df.select("lc").distinct().collect()))
    q.awaitTermination(300)
    assert set(seen) == {"tr"}
    after = tsv.read_results(spark, f"{out}/splits").select("lc").distinct().collect()
    assert {r.lc for r in after} == {"en", "tr"}
