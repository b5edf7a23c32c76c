
import math

from quarry.operators import trials as T

# Recorded per-shard probe losses (mean, batches) for 29 shards.
SHARD_MEANS = [
    (0.693803424531, 47), (0.453742940289, 48), (0.362401590372, 48), (0.482497286672, 48),
    (1.11665043359, 48), (1.066344108433, 48), (0.93333428974, 48), (1.061625966972, 44),
    (0.735586731539, 48), (0.760145495547, 47), (0.945680828471, 38), (0.838280037045, 48),
    (0.92488850529, 48), (0.699730172753, 47), (0.789347246755, 48), (0.425116001939, 48),
    (0.961336415261, 48), (0.786465617207, 48), (0.484541753617, 48), (0.690174043489, 48),
    (0.651489735891, 48), (0.674207155903, 48), (0.571506373584, 48), (0.608339219975, 48),
    (0.519223998922, 48), (0.71970916974, 48), (0.486696433276, 48), (0.471708737159, 48),
    (0.681654675864, 48),
]


def test_shard_probe_summary(spark):
    per = spark.createDataFrame([(f"s{i:02d}", m, n) for i, (m, n) in enumerate(SHARD_MEANS)],
                                "shard string, mean double, n_batches long")
    r = T.shard_loss_summary(per).collect()[0]
    assert r.shards == 29
    assert math.isclose(r.mean, 0.710215, abs_tol=5e-7)
    assert math.isclose(r.spread, 0.754249, abs_tol=5e-7)
    assert math.isclose(r.median, 0.693803, abs_tol=5e-7)
    assert math.isclose(r.stdev, 0.204407, abs_tol=5e-7)
    assert sum(n for _, n in SHARD_MEANS) == 1375
